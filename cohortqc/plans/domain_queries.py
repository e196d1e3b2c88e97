"""Queries of the cohort operators on the domain tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.functions import genetics as G
from cohortqc.operators import aggregates as A
from cohortqc.operators import filters, identity, joins, split
from cohortqc.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT contig, pos, array_to_string(alleles, '/') AS alleles, count(*) AS var_count FROM variants GROUP BY ALL HAVING count(*) > 1")
def dup_variants(spark, sf):
    d = A.duplicates(read_table(spark, sf, "variants"), ["contig", "pos", "alleles"], "var_count")
    return d.withColumn("alleles", F.array_join("alleles", "/"))


@query("SELECT s, count(*) AS s_count FROM samples GROUP BY s HAVING count(*) > 1")
def dup_samples(spark, sf):
    return A.duplicates(read_table(spark, sf, "samples"), ["s"], "s_count")


@query("SELECT s, freemix FROM samples WHERE freemix > 0.05 AND NOT isnan(freemix)")
def freemix_outliers(spark, sf):
    return filters.contaminated(read_table(spark, sf, "samples"), 0.05).select("s", "freemix")


@query("SELECT s, seq_batch FROM samples WHERE freemix IS NULL OR isnan(freemix)")
def freemix_missing(spark, sf):
    return filters.freemix_missing(read_table(spark, sf, "samples")).select("s", "seq_batch")


@query("SELECT s, freemix, row_number() OVER (ORDER BY CASE WHEN freemix IS NULL THEN 2 WHEN isnan(freemix) THEN 1 ELSE 0 END, freemix, s, arrived_at) - 1 AS idx FROM samples")
def freemix_index_all(spark, sf):
    """All samples: numbers, then NaN, then nulls."""
    order = [F.when(F.col("freemix").isNull(), 2).when(F.isnan("freemix"), 1).otherwise(0), "freemix", "s", "arrived_at"]
    return joins.row_index(read_table(spark, sf, "samples"), order).select("s", "freemix", F.col("idx").cast("long").alias("idx"))


# ---- identity ------------------------------------------------------------------------------------------------------
_PAIRS = """WITH pairs AS (SELECT data_sample, microarray_sample, line_no, CASE WHEN n_sites = 0 THEN 1000.0 ELSE discordance / n_sites END AS score FROM (
  SELECT * FROM gtcheck_results WHERE data_sample IS NOT NULL AND microarray_sample IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY data_sample, microarray_sample ORDER BY line_no) = 1) q
  WHERE n_sites = 0 OR (n_sites IS NOT NULL AND discordance IS NOT NULL AND NOT isnan(discordance) AND NOT isinf(discordance)))"""
_BEST = "best AS (SELECT data_sample, microarray_sample AS bm, score AS bs FROM pairs QUALIFY row_number() OVER (PARTITION BY data_sample ORDER BY score, line_no) = 1)"
_MAP = """mp AS (SELECT data_sample, microarray_sample, count(*) OVER (PARTITION BY data_sample) > 1 AS duplicated_wes, count(*) OVER (PARTITION BY microarray_sample) > 1 AS duplicated_microarray FROM mapping_file
  WHERE data_sample IS NOT NULL AND microarray_sample IS NOT NULL)"""


def _report(spark, sf):
    """The whole report: the first line of a pair counts, and a pair whose first line has no score is left out."""
    return read_table(spark, sf, "gtcheck_results")


def _mapping(spark, sf):
    return read_table(spark, sf, "mapping_file").where("data_sample is not null and microarray_sample is not null").select("data_sample", "microarray_sample")


@query(f"{_PAIRS} SELECT data_sample, microarray_sample, score FROM pairs")
def gtcheck_scores(spark, sf):
    return identity.prepare_report(_report(spark, sf), bad_scores="leave_out").select("data_sample", "microarray_sample", "score")


@query(f"{_PAIRS}, {_BEST} SELECT data_sample, bm AS best_match_microarray_sample, bs AS best_match_microarray_score FROM best")
def best_match_argmin(spark, sf):
    return identity.best_match(identity.prepare_report(_report(spark, sf), bad_scores="leave_out"))


@query(f"WITH {_MAP} SELECT *, duplicated_wes OR duplicated_microarray AS duplicated_id_any, duplicated_wes AND duplicated_microarray AS duplicated_id_both FROM mp")
def mark_duplicates(spark, sf):
    return identity.mark_duplicates(_mapping(spark, sf))


_VALID = f"""{_PAIRS}, {_BEST}, {_MAP}, ms AS (SELECT data_sample, bool_or(duplicated_wes OR duplicated_microarray) AS dup FROM mp GROUP BY ALL),
b2 AS (SELECT best.*, ms.data_sample IS NOT NULL AS in_map, coalesce(dup, false) AS dup, EXISTS (SELECT 1 FROM mp WHERE mp.data_sample = best.data_sample AND mp.microarray_sample = bm) AS matched FROM best LEFT JOIN ms ON ms.data_sample = best.data_sample),
v AS (SELECT data_sample, bm AS best_match_microarray_sample, NULL AS mapped_microarray_sample, NULL AS score_from_mapped, NULL AS restored_samples, CASE WHEN NOT in_map THEN 'best_match_not_exist_in_mapfile,' ELSE 'best_match_exist_in_mapfile,best_match_matched_mapfile,'
    || CASE WHEN dup THEN 'mapfile_non_unique,' ELSE 'mapfile_unique,' END || CASE WHEN bs <= 0.2 THEN 'score_passed,' ELSE 'score_failed,' END END AS validation_tags, NOT in_map OR bs <= 0.2 AS is_validation_passed
  FROM b2 WHERE matched OR NOT in_map
  UNION ALL SELECT b2.data_sample, bm, mp.microarray_sample, p.score, coalesce((SELECT string_agg(m2.data_sample, ',' ORDER BY m2.data_sample) FROM mp m2 WHERE m2.microarray_sample = bm), ''), 'best_match_exist_in_mapfile,best_match_not_matched_mapfile,' || CASE WHEN p.score IS NULL THEN 'no_mapfile_pairs_have_gtcheck,'
    ELSE 'mapfile_pairs_have_gtcheck,' || CASE WHEN p.score <= 0.2 THEN 'score_passed,' ELSE 'score_failed,' END END, coalesce(p.score <= 0.2, false)
  FROM b2 JOIN mp ON mp.data_sample = b2.data_sample LEFT JOIN pairs p ON p.data_sample = b2.data_sample AND p.microarray_sample = mp.microarray_sample WHERE in_map AND NOT matched)"""


@query(f"{_VALID} SELECT * FROM v")
def identity_tags(spark, sf):
    v = identity.validate(_report(spark, sf), _mapping(spark, sf), bad_scores="leave_out")
    return v.select("data_sample", "best_match_microarray_sample", "mapped_microarray_sample", "score_from_mapped", F.array_join("restored_samples", ",").alias("restored_samples"), "validation_tags", "is_validation_passed")


@query(f"{_VALID} SELECT validation_tags, count(*) AS n FROM v GROUP BY ALL")
def identity_tag_summary(spark, sf):
    return identity.tag_summary(identity.validate(_report(spark, sf), _mapping(spark, sf), bad_scores="leave_out"))


@query("""WITH d AS (SELECT s AS id, count(*) = 1 AS is_unique FROM samples WHERE s IS NOT NULL GROUP BY s), m AS (SELECT data_sample AS id, count(*) = 1 AS is_unique FROM mapping_file WHERE data_sample IS NOT NULL AND microarray_sample IS NOT NULL GROUP BY 1)
SELECT id, 'data_not_in_map' AS side, is_unique FROM d WHERE id NOT IN (SELECT id FROM m) UNION ALL SELECT id, 'map_not_in_data', is_unique FROM m WHERE id NOT IN (SELECT id FROM d)""")
def id_differences(spark, sf):
    data = read_table(spark, sf, "samples").where("s is not null").select(F.col("s").alias("id"))
    return identity.id_differences(data, _mapping(spark, sf).select(F.col("data_sample").alias("id")))


@query("SELECT data_sample, microarray_sample FROM mapping_file WHERE data_sample IS NOT NULL AND microarray_sample IN (SELECT microarray_sample FROM microarray_ids)")
def mapping_without_missing(spark, sf):
    return identity.without_missing_arrays(_mapping(spark, sf), read_table(spark, sf, "microarray_ids")).select("data_sample", "microarray_sample")


_UNI = lambda name, col: f"SELECT '{name}_mapping_' || CASE WHEN n = 1 THEN 'unique' ELSE 'non_unique' END AS what, count(*) AS n FROM (SELECT {col}, count(*) AS n FROM mp GROUP BY 1) GROUP BY 1"
_DIF = lambda name, col, src, sc: f"""SELECT '{name}_' || side || CASE WHEN u THEN '_unique' ELSE '_non_unique' END AS what, count(*) AS n FROM (
  SELECT 'data_not_in_map' AS side, n = 1 AS u FROM (SELECT {sc} AS id, count(*) AS n FROM {src} WHERE {sc} IS NOT NULL GROUP BY 1) WHERE id NOT IN (SELECT {col} FROM mp)
  UNION ALL SELECT 'map_not_in_data', n = 1 FROM (SELECT {col} AS id, count(*) AS n FROM mp GROUP BY 1) WHERE id NOT IN (SELECT {sc} FROM {src} WHERE {sc} IS NOT NULL)) GROUP BY 1"""  # noqa: E731


@query(
    f"WITH {_MAP} {_UNI('wes', 'data_sample')} UNION ALL {_DIF('wes', 'data_sample', 'samples', 's')} UNION ALL {_UNI('microarray', 'microarray_sample')} UNION ALL {_DIF('microarray', 'microarray_sample', 'microarray_ids', 'microarray_sample')}"
    " UNION ALL SELECT 'rows_with_repeated_ids', count(*) FROM mp WHERE duplicated_wes OR duplicated_microarray UNION ALL SELECT 'rows', count(*) FROM mp"
)
def mapping_report(spark, sf):
    data = read_table(spark, sf, "samples").where("s is not null").select("s")
    arrays = read_table(spark, sf, "microarray_ids").where("microarray_sample is not null").select("microarray_sample")
    return identity.mapping_report(data, arrays, _mapping(spark, sf))


# ---- sites ---------------------------------------------------------------------------------------------------------------
_SITES = "sites AS (SELECT contig, pos, [min(alleles[1])] || list_sort(list(DISTINCT alleles[2])) AS alleles FROM variants WHERE contig IS NOT NULL AND pos IS NOT NULL GROUP BY contig, pos, alleles[1])"


def _sites(spark, sf):
    """Unsplit sites, put together from the split variants."""
    v = read_table(spark, sf, "variants").where("contig is not null and pos is not null")
    ref = F.get("alleles", F.lit(0))
    return v.groupBy("contig", "pos", ref.alias("ref")).agg(F.array_sort(F.collect_set(F.get("alleles", F.lit(1)))).alias("alts")).select("contig", "pos", F.concat(F.array("ref"), "alts").alias("alleles"))


@query(f"WITH {_SITES} SELECT contig, pos, alleles[1] AS ref, alleles[k] AS alt, CAST(k - 1 AS INTEGER) AS a_index, len(alleles) > 2 AS was_split FROM (SELECT *, unnest(range(2, len(alleles) + 1)) AS k FROM sites) WHERE alleles[k] <> '*'")
def split_multi_rows(spark, sf):
    s = split.split_sites(_sites(spark, sf))
    return s.select("contig", "pos", F.get("alleles", F.lit(0)).alias("ref"), F.get("alleles", F.lit(1)).alias("alt"), "a_index", "was_split")


_TYPE = "CASE WHEN snvs = n AND n = 1 THEN 'snv' WHEN snvs = n AND n > 1 THEN 'multi-snv' WHEN snvs = 0 AND n = 1 THEN 'indel' WHEN snvs = 0 AND n > 1 THEN 'multi-indel' WHEN n > 1 THEN 'mixed' END"


@query(
    f"""WITH {_SITES}, t AS (SELECT *, list_contains(alleles, '*') AS has_star, len(list_filter(alleles[2:], lambda x: x <> '*')) AS n, len(list_filter(alleles[2:], lambda x: x <> '*' AND length(x) = length(alleles[1]))) AS snvs FROM sites)
SELECT contig, pos, alt, {_TYPE} AS site_type, CAST(n AS INTEGER) AS n_alt_alleles, has_star, {_TYPE} = 'mixed' AS was_mixed FROM (SELECT *, unnest(alleles[2:]) AS alt FROM t) WHERE alt <> '*'"""
)
def allele_data(spark, sf):
    d = split.allele_data(split.split_sites(_sites(spark, sf)))
    return d.select("contig", "pos", F.get("alleles", F.lit(1)).alias("alt"), "site_type", "n_alt_alleles", "has_star", "was_mixed")


@query("""SELECT count(*) AS n_entries, count(gt) AS n_called, CAST(sum(CAST(gt.a0 > 0 AS INTEGER) + CAST(gt.a1 > 0 AS INTEGER)) AS BIGINT) AS n_alt, count(*) FILTER (WHERE adj) AS n_adj,
  round(avg(CASE WHEN gt.a0 <> gt.a1 AND sum_ad <> 0 THEN CAST(ad[2] AS DOUBLE) / sum_ad END), 9) AS mean_het_ab, s FROM entries GROUP BY s""")
def entry_stats(spark, sf):
    e = read_table(spark, sf, "entries")
    n = G.n_alt("gt")
    ab = G.het_ab((F.col("gt.a0") != F.col("gt.a1")).cast("int"), F.get("ad", F.lit(1)), "sum_ad")
    return e.groupBy("s").agg(F.count("*").alias("n_entries"), F.count("gt").alias("n_called"), F.sum(n).alias("n_alt"), F.count_if("adj").alias("n_adj"), F.round(F.avg(ab), 9).alias("mean_het_ab"))


@query("SELECT rank_id, is_snv, bin, count(*) AS n, count(*) FILTER (WHERE tp) AS n_tp, count(*) FILTER (WHERE fp) AS n_fp FROM rf_ht WHERE rank_id = 'rank' GROUP BY ALL")
def rank_only_bins(spark, sf):
    r = read_table(spark, sf, "rf_ht").where("rank_id = 'rank'")
    return r.groupBy("rank_id", "is_snv", "bin").agg(F.count("*").alias("n"), F.count_if("tp").alias("n_tp"), F.count_if("fp").alias("n_fp"))
