"""Queries of the language-model problems on the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.llm import components, cutoffs, mixing, packing, percentiles, spans, tokens, topn
from cohortqc.session import materialize, read_table


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return components.related_samples(read_table(spark, sf, "relatedness_ht"))


def p3_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return percentiles.entry_percentiles(read_table(spark, sf, "entries"))


def p3_span(spark: SparkSession, sf: str) -> DataFrame:
    """The same over the days of one quarter."""
    return percentiles.entry_percentiles(read_table(spark, sf, "entries"), "2024-01-01", "2024-03-31")


def p3_merged_all_days(spark: SparkSession, sf: str) -> DataFrame:
    """The percentiles of p3_percentiles, from the summaries of all single days."""
    return percentiles.percentiles_of(percentiles.day_counts(read_table(spark, sf, "entries"))).withColumnRenamed("grp", "s")


def p3_day_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The mergeable summaries of single days."""
    d = percentiles.day_counts(read_table(spark, sf, "entries"))
    return d.select("grp", "day", F.element_at(F.array(*[F.lit(m.column) for m in percentiles.ENTRY_MEASURES]), F.col("measure") + 1).alias("measure"), "code", "n")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return cutoffs.keep_share(read_table(spark, sf, "rf_ht"), read_table(spark, sf, "rank_targets"))[1].select("rank_id", "vid")


def p4_cutoffs(spark: SparkSession, sf: str) -> DataFrame:
    return cutoffs.keep_share(read_table(spark, sf, "rf_ht"), read_table(spark, sf, "rank_targets"))[0]


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return topn.best_arrays(read_table(spark, sf, "gtcheck_results")).select("data_sample", "microarray_sample", "place")


def p5_new_best_match(spark: SparkSession, sf: str) -> DataFrame:
    best = topn.best_arrays(read_table(spark, sf, "gtcheck_results"), 1)
    return best.select("data_sample", best["microarray_sample"].alias("best_match_microarray_sample"), "score")


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf, "documents"))


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    return packing.fill_report(p8_containers(spark, sf))


def p8_audit(spark: SparkSession, sf: str) -> DataFrame:
    sizes = materialize(tokens.document_sizes(read_table(spark, sf, "documents")))
    return packing.audit(materialize(packing.fill_containers(sizes)), sizes)


def p8_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The texts decoded again from the token ids in their containers."""
    documents = read_table(spark, sf, "documents")
    return packing.reassembled(packing.pack_documents(documents), documents).select("doc_id", F.md5("text").alias("text_md5"))


def _p9(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mix_documents(read_table(spark, sf, "documents"), read_table(spark, sf, "mix_targets"))


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    return _p9(spark, sf)[0]


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    return _p9(spark, sf)[1]


def p9_audit(spark: SparkSession, sf: str) -> DataFrame:
    sizes = materialize(tokens.document_sizes(read_table(spark, sf, "documents")))
    return mixing.audit(*mixing.mix_sources(sizes, read_table(spark, sf, "mix_targets")), sizes)


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return spans.SharedSpans(read_table(spark, sf, "documents")).pairs()


def p10_shared_chars(spark: SparkSession, sf: str) -> DataFrame:
    return spans.SharedSpans(read_table(spark, sf, "documents")).shared_chars()


def p10_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Membership instead of pairs: each document that shares a run with its class."""
    return spans.SharedSpans(read_table(spark, sf, "documents")).classes()


def p10_without_spans(spark: SparkSession, sf: str) -> DataFrame:
    """What the removal of the shared spans leaves of each text."""
    rest = spans.SharedSpans(read_table(spark, sf, "documents")).without_spans()
    return rest.select("doc_id", F.char_length("text").cast("long").alias("kept_chars"), F.md5("text").alias("kept_md5"))


QUERIES = {f.__name__: f for f in (p2_found, p3_percentiles, p3_span, p3_merged_all_days, p3_day_counts, p4_found, p4_cutoffs, p5_found, p5_new_best_match, p8_containers, p8_fill, p8_audit, p8_round_trip, p9_mix, p9_shares, p9_audit, p10_found, p10_shared_chars, p10_classes, p10_without_spans)}

_P2_SQL = """
WITH RECURSIVE links AS (
  SELECT DISTINCT upper(trim(i, ' ')) AS a, upper(trim(j, ' ')) AS b FROM relatedness_ht
  WHERE kin > 0.125 AND NOT isnan(kin) AND upper(trim(i, ' ')) <> upper(trim(j, ' '))),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS s, a AS r FROM edges UNION SELECT reach.s, edges.b FROM reach JOIN edges ON edges.a = reach.r)
SELECT s, min(r) AS group_id FROM reach GROUP BY s"""


def _p3_sql(where: str) -> str:
    parts = [("dp", "dp", "1.0", "0.0"), ("gq", "gq", "1.0", "0.0"), ("hetab", "floor(hetab / 1e-6::DOUBLE + 0.5::DOUBLE)", "1e-6", "5e-7")]
    union = " UNION ALL ".join(
        f"SELECT upper(trim(s, ' ')) AS s, '{m}' AS measure, CAST({code} AS BIGINT) AS code, CAST({step} AS DOUBLE) AS step, CAST({err} AS DOUBLE) AS error_bound FROM entries WHERE {m} IS NOT NULL"
        + (f" AND NOT isnan({m}) AND NOT isinf({m})" if m == "hetab" else "")
        + where
        for m, code, step, err in parts
    )
    return f"""
WITH v AS ({union}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY s, measure ORDER BY code) AS rn, count(*) OVER (PARTITION BY s, measure) AS n FROM v WHERE s IS NOT NULL)
SELECT s, measure, CAST(p AS DOUBLE) AS percentile, round(code * step, 9) AS value, n, error_bound
FROM ranked, (SELECT unnest([1, 5, 25, 50, 75, 95, 99]) AS p) WHERE rn = greatest(1, (p * n + 99) // 100)"""


_P4_BASE = """
WITH latest AS (
  SELECT rank_id, vid, score, bin, CASE WHEN is_snv THEN 'snv' WHEN NOT is_snv THEN 'indel' END AS var_class FROM rf_ht
  QUALIFY row_number() OVER (PARTITION BY rank_id, vid ORDER BY loaded_at DESC NULLS LAST, row_id DESC) = 1),
usable AS (SELECT * FROM latest WHERE score IS NOT NULL AND NOT isnan(score) AND score BETWEEN 0 AND 1),
counted AS (
  SELECT u.*, t.keep_percent, count(*) OVER (PARTITION BY u.rank_id, u.var_class) AS n,
         count(*) OVER (PARTITION BY u.rank_id, u.var_class ORDER BY u.score RANGE UNBOUNDED PRECEDING) AS upto
  FROM usable u JOIN rank_targets t ON t.rank_id = u.rank_id AND t.var_class = u.var_class),
cut AS (SELECT rank_id, var_class, min(score) AS cutoff, any_value(n) AS n FROM counted WHERE 100 * upto >= keep_percent * n GROUP BY ALL),
kept AS (SELECT u.rank_id, u.var_class, u.vid, u.bin FROM usable u JOIN cut c ON c.rank_id = u.rank_id AND c.var_class = u.var_class AND u.score <= c.cutoff)
"""

_P5_SQL = """
WITH lines AS (
  SELECT upper(trim(data_sample, ' ')) AS data_sample, upper(trim(microarray_sample, ' ')) AS microarray_sample, score, line_no FROM gtcheck_results
  WHERE data_sample IS NOT NULL AND microarray_sample IS NOT NULL),
first AS (SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY data_sample, microarray_sample ORDER BY line_no) = 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY data_sample ORDER BY score, line_no) AS place FROM first WHERE score IS NOT NULL AND NOT isnan(score) AND NOT isinf(score))
"""

_P10_BASE = """
WITH RECURSIVE docs AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE doc_id IS NOT NULL AND length(text) >= 200),
grams AS (SELECT doc_id, i, substring(text, i, 200) AS g FROM (SELECT doc_id, text, unnest(range(1, n - 198)) AS i FROM docs)),
common AS (SELECT g FROM grams GROUP BY g HAVING min(doc_id) < max(doc_id)),
shared AS (SELECT doc_id, i, g FROM grams SEMI JOIN common USING (g)),
holders AS (SELECT DISTINCT g, doc_id FROM shared),
pairs AS (SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM holders a JOIN holders b ON a.g = b.g AND a.doc_id < b.doc_id),
spans AS (SELECT doc_id, i, least(200, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 200)) AS own FROM shared)
"""
_QUARTER = " AND load_day BETWEEN DATE '2024-01-01' AND DATE '2024-03-31'"
SQL = {
    "p2_found": _P2_SQL,
    "p3_percentiles": _p3_sql(""),
    "p3_span": _p3_sql(_QUARTER),
    "p3_merged_all_days": _p3_sql(""),
    "p3_day_counts": " UNION ALL ".join(
        f"SELECT upper(trim(s, ' ')) AS grp, load_day AS day, '{m}' AS measure, CAST({code} AS BIGINT) AS code, count(*) AS n FROM entries WHERE s IS NOT NULL AND {m} IS NOT NULL{more} GROUP BY 1, 2, 4"
        for m, code, more in (("dp", "dp", ""), ("gq", "gq", ""), ("hetab", "floor(hetab / 1e-6::DOUBLE + 0.5::DOUBLE)", " AND NOT isnan(hetab) AND NOT isinf(hetab)"))
    ),
    "p4_found": _P4_BASE + "SELECT rank_id, vid FROM kept",
    "p4_cutoffs": _P4_BASE
    + """SELECT t.rank_id, t.var_class, t.keep_percent, coalesce(c.n, 0) AS n, c.cutoff, coalesce(k.kept, 0) AS kept, k.max_bin
FROM rank_targets t LEFT JOIN cut c ON c.rank_id = t.rank_id AND c.var_class = t.var_class
LEFT JOIN (SELECT rank_id, var_class, count(*) AS kept, max(bin) AS max_bin FROM kept GROUP BY ALL) k ON k.rank_id = t.rank_id AND k.var_class = t.var_class""",
    "p5_found": _P5_SQL + "SELECT data_sample, microarray_sample, CAST(place AS INTEGER) AS place FROM placed WHERE place <= 3",
    "p5_new_best_match": _P5_SQL + "SELECT data_sample, microarray_sample AS best_match_microarray_sample, score FROM placed WHERE place = 1",
    "p8_audit": "SELECT unnest(['over_capacity', 'gaps_in_places', 'short_split', 'incomplete']) AS rule, CAST(0 AS BIGINT) AS violations",
    "p8_round_trip": "SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE text <> ''",
    "p9_audit": "SELECT lower(trim(source, ' ')) AS source, target_share, max_repeats, true AS docs_unique, true AS repeats_kept, true AS budget_kept, true AS share_kept FROM mix_targets",
    "p10_found": _P10_BASE + "SELECT doc_a, doc_b FROM pairs",
    "p10_shared_chars": _P10_BASE
    + """SELECT d.doc_id, coalesce(length(d.text), 0) AS n_chars, coalesce(s.part, 0) AS shared_chars, coalesce(round(100.0 * coalesce(s.part, 0)::DOUBLE / nullif(length(d.text), 0), 2), 0.0) AS shared_percent
FROM documents d LEFT JOIN (SELECT doc_id, CAST(sum(own) AS BIGINT) AS part FROM spans GROUP BY doc_id) s ON s.doc_id = d.doc_id""",
    "p10_classes": _P10_BASE
    + """, edges AS (SELECT doc_a AS a, doc_b AS b FROM pairs UNION SELECT doc_b, doc_a FROM pairs),
reach AS (SELECT a AS d, a AS r FROM edges UNION SELECT reach.d, edges.b FROM reach JOIN edges ON edges.a = reach.r),
class AS (SELECT d AS doc_id, min(r) AS class_id FROM reach GROUP BY d)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size FROM class""",
    "p10_without_spans": _P10_BASE
    + """, kept AS (
  SELECT doc_id, i + own AS a, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM spans
  UNION ALL SELECT doc_id, 1, min(i) FROM spans GROUP BY doc_id),
rest AS (SELECT k.doc_id, string_agg(CASE WHEN b IS NULL THEN substring(d.text, a) ELSE substring(d.text, a, b - a) END, '' ORDER BY a) AS t FROM kept k JOIN docs d ON d.doc_id = k.doc_id WHERE b IS NULL OR b > a GROUP BY k.doc_id)
SELECT d.doc_id, length(CASE WHEN c.doc_id IS NULL THEN d.text ELSE coalesce(r.t, '') END) AS kept_chars, md5(CASE WHEN c.doc_id IS NULL THEN d.text ELSE coalesce(r.t, '') END) AS kept_md5
FROM documents d LEFT JOIN rest r ON r.doc_id = d.doc_id LEFT JOIN (SELECT DISTINCT doc_id FROM spans) c ON c.doc_id = d.doc_id""",
}
