"""Queries of the general problems on the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.operators import filling, references
from cohortqc.session import read_table
from cohortqc.sources import badrows


def _p1(spark: SparkSession, sf: str) -> DataFrame:
    pedigree, mapping = read_table(spark, sf, "pedigree"), read_table(spark, sf, "mapping_file")
    refs = (
        references.references(mapping, "microarray_sample", "microarray_ids")
        .unionByName(references.references(pedigree, "pat_id", "samples"))
        .unionByName(references.references(pedigree, "mat_id", "samples"))
    )
    targets = references.target_rows(read_table(spark, sf, "microarray_ids"), "microarray_sample", "microarray_ids").unionByName(
        references.target_rows(read_table(spark, sf, "samples"), "s", "samples")
    )
    return references.orphan_references(refs, targets)


def _p6(spark: SparkSession, sf: str) -> DataFrame:
    return filling.fill_gaps(read_table(spark, sf, "variants"))


def _p7(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    raw, terms = read_table(spark, sf, "cqfile_raw"), read_table(spark, sf, "consequence_terms")
    return raw, badrows.load_strict(raw, terms), terms


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return _p1(spark, sf)


def p1_orphan_report(spark: SparkSession, sf: str) -> DataFrame:
    return references.orphan_report(_p1(spark, sf))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return filling.filled_cells(_p6(spark, sf))


def p6_filled(spark: SparkSession, sf: str) -> DataFrame:
    f = _p6(spark, sf)
    return f.withColumns({c: F.round(c, 4 if c.endswith("_distance") else 6) for c, t in f.dtypes if t == "double"})


def p6_methods(spark: SparkSession, sf: str) -> DataFrame:
    fields = ("mq", "inbreedingcoeff", "variant_type")
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("gap_field"), F.col(f"{f}_method").alias("method")) for f in fields])).alias("c")
    return _p6(spark, sf).select(cells).groupBy("c.gap_field", "c.method").agg(F.count("*").alias("cells"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return badrows.rejected(*_p7(spark, sf)).select("line_id", "reason")


def p7_loaded(spark: SparkSession, sf: str) -> DataFrame:
    return _p7(spark, sf)[1].select("line_id", "chr", "pos", "rs", "ref", "alt", "consequence")


QUERIES = {f.__name__: f for f in (p1_found, p1_orphan_report, p6_found, p6_filled, p6_methods, p7_found, p7_loaded)}

_P1_SQL = """
WITH refs AS (
  SELECT 'microarray_sample' AS ref_field, 'a' AS target, record_id, upper(trim(microarray_sample, ' ')) AS k, coalesce(recorded_at, loaded_at) AS t FROM mapping_file
  UNION ALL SELECT 'pat_id', 's', record_id, upper(trim(pat_id, ' ')), coalesce(recorded_at, loaded_at) FROM pedigree
  UNION ALL SELECT 'mat_id', 's', record_id, upper(trim(mat_id, ' ')), coalesce(recorded_at, loaded_at) FROM pedigree),
targets AS (
  SELECT 'a' AS target, upper(trim(microarray_sample, ' ')) AS k, arrived_at, removed_at FROM microarray_ids
  UNION ALL SELECT 's', upper(trim(s, ' ')), arrived_at, removed_at FROM samples),
judged AS (
  SELECT r.ref_field, r.record_id, r.t, count(g.k) AS n,
         count(*) FILTER (WHERE g.arrived_at <= r.t AND (g.removed_at IS NULL OR g.removed_at > r.t)) AS live,
         count(*) FILTER (WHERE g.arrived_at > r.t) AS later
  FROM refs r LEFT JOIN targets g ON g.target = r.target AND g.k = r.k
  WHERE r.k IS NOT NULL AND r.k NOT IN ('', '0', 'NA')
  GROUP BY r.ref_field, r.record_id, r.t)
SELECT ref_field, record_id, CASE WHEN n = 0 THEN 'missing' WHEN later = n THEN 'late' ELSE 'deleted' END AS reason, strftime(t, '%Y-%m') AS ref_month
FROM judged WHERE live = 0"""

_P7_BASE = r"""
WITH lines AS (
  SELECT line_id, CASE WHEN ends_with(raw_line, chr(13)) THEN left(raw_line, length(raw_line) - 1) ELSE raw_line END AS line FROM cqfile_raw),
quoted AS (
  SELECT line_id, line, regexp_full_match(line, '(?s)("([^"]|"")*"|[^"\t]*)(\t("([^"]|"")*"|[^"\t]*))*') AS ok FROM lines),
cols AS (
  SELECT line_id, ok, CASE WHEN ok THEN list_transform(regexp_extract_all(chr(9) || line, '(?s)\t("(?:[^"]|"")*"|[^"\t]*)', 1),
    lambda c: CASE WHEN starts_with(c, '"') THEN replace(substring(c, 2, length(c) - 2), '""', '"') ELSE c END) END AS c FROM quoted),
terms AS (SELECT list(consequence) AS t FROM consequence_terms),
judged AS (
  SELECT line_id, c, CASE WHEN NOT ok THEN 'quoting' WHEN len(c) <> 6 THEN 'columns'
    WHEN NOT (regexp_full_match(c[2], '[0-9]+') AND coalesce(TRY_CAST(c[2] AS HUGEINT) BETWEEN 1 AND 2147483647, false)
              AND len(list_filter(string_split(c[6], '&'), lambda x: NOT list_contains(t, x))) = 0) THEN 'value' END AS reason
  FROM cols, terms)
"""

def _p6_sql() -> str:
    near = lambda v, keys: (
        f"last_value(CASE WHEN {v} IS NOT NULL AND t IS NOT NULL THEN {{'v': {v}, 't': t}} END IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY t NULLS FIRST, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p_{v}, "
        f"first_value(CASE WHEN {v} IS NOT NULL AND t IS NOT NULL THEN {{'v': {v}, 't': t}} END IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY t NULLS FIRST, row_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n_{v}"
    )
    days = lambda v: f"(epoch_us(t) - epoch_us(p_{v}.t)) / 86400000000.0::DOUBLE AS dp_{v}, (epoch_us(n_{v}.t) - epoch_us(t)) / 86400000000.0::DOUBLE AS dn_{v}"
    mode = lambda keys, name: f"{name} AS (SELECT {keys + ', ' if keys else ''}cat AS of_{name} FROM v WHERE cat IS NOT NULL GROUP BY {keys + ', ' if keys else ''}cat QUALIFY row_number() OVER ({'PARTITION BY ' + keys if keys else ''} ORDER BY count(*) DESC, cat) = 1)"
    middle = lambda v: f"list_sort(list({v}) FILTER (WHERE {v} IS NOT NULL))[CAST(ceil(0.5 * count({v})) AS BIGINT)]"

    def out(v: str, name: str) -> str:
        both = f"coalesce(dp_{v} <= 30, false) AND coalesce(dn_{v} <= 30, false)"
        case = lambda a, b, c, d, e, f, g: f"CASE WHEN {v} IS NOT NULL THEN {a} WHEN {both} THEN {b} WHEN dp_{v} <= 30 THEN {c} WHEN dn_{v} <= 30 THEN {d} WHEN k.k_{v} IS NOT NULL THEN {e} WHEN a.a_{v} IS NOT NULL THEN {f} ELSE {g} END"
        between = f"CASE WHEN dp_{v} + dn_{v} > 0 THEN p_{v}.v + (n_{v}.v - p_{v}.v) * dp_{v} / nullif(dp_{v} + dn_{v}, 0) ELSE (p_{v}.v + n_{v}.v) / 2 END"
        return (
            f"round({case(v, between, f'p_{v}.v', f'n_{v}.v', f'k.k_{v}', f'a.a_{v}', 'NULL')}, 6) AS {name}, "
            + case("'observed'", "'interpolated'", "'carried'", "'carried_back'", "'type'", "'overall'", "'none'") + f" AS {name}_method, "
            + f"round({case('0.0::DOUBLE', f'least(dp_{v}, dn_{v})', f'dp_{v}', f'dn_{v}', 'NULL', 'NULL', 'NULL')}, 4) AS {name}_distance"
        )

    return f"""
WITH v AS (SELECT row_id, coalesce(callset_id, chr(0)) AS entity, coalesce(called_at, loaded_at) AS t, contig, pos,
    CASE WHEN NOT isnan(mq) AND mq BETWEEN 0 AND 100 THEN mq END AS num0, CASE WHEN NOT isnan(inbreedingcoeff) AND inbreedingcoeff BETWEEN -1 AND 1 THEN inbreedingcoeff END AS num1,
    CASE WHEN lower(trim(variant_type, ' ')) IN ('snv', 'indel', 'multi-snv', 'multi-indel', 'mixed') THEN lower(trim(variant_type, ' ')) END AS cat FROM variants),
{mode('contig, pos', 'site')}, {mode('entity', 'ent')}, {mode('', 'al')},
c0 AS (SELECT *, {near('cat', 'entity')} FROM v), c1 AS (SELECT *, {days('cat')} FROM c0),
c2 AS (SELECT c1.*, CASE WHEN cat IS NOT NULL THEN {{'v': cat, 'm': 'observed', 'd': 0.0::DOUBLE}} WHEN of_site IS NOT NULL THEN {{'v': of_site, 'm': 'site', 'd': NULL}}
    WHEN dp_cat <= 30 AND (NOT coalesce(dn_cat <= 30, false) OR dp_cat <= dn_cat) THEN {{'v': p_cat.v, 'm': 'carried', 'd': dp_cat}} WHEN dn_cat <= 30 THEN {{'v': n_cat.v, 'm': 'carried_back', 'd': dn_cat}}
    WHEN of_ent IS NOT NULL THEN {{'v': of_ent, 'm': 'entity', 'd': NULL}} WHEN (SELECT of_al FROM al) IS NOT NULL THEN {{'v': (SELECT of_al FROM al), 'm': 'overall', 'd': NULL}} ELSE {{'v': NULL, 'm': 'none', 'd': NULL}} END AS c
  FROM c1 LEFT JOIN site ON site.contig = c1.contig AND site.pos = c1.pos LEFT JOIN ent ON ent.entity = c1.entity),
r AS (SELECT row_id, entity, t, num0, num1, c, coalesce(c.v, chr(0)) AS kind FROM c2),
n0 AS (SELECT *, {near('num0', 'entity, kind')}, {near('num1', 'entity, kind')} FROM r), n1 AS (SELECT *, {days('num0')}, {days('num1')} FROM n0),
k AS (SELECT kind, {middle('num0')} AS k_num0, {middle('num1')} AS k_num1 FROM r GROUP BY kind), a AS (SELECT {middle('num0')} AS a_num0, {middle('num1')} AS a_num1 FROM r)
SELECT row_id, {out('num0', 'mq')}, {out('num1', 'inbreedingcoeff')}, c.v AS variant_type, c.m AS variant_type_method, round(c.d, 4) AS variant_type_distance
FROM n1 LEFT JOIN k ON k.kind = n1.kind, a"""


_P6_SQL = _p6_sql()
SQL = {
    "p1_found": _P1_SQL,
    "p1_orphan_report": f"SELECT ref_field, ref_month, reason, count(*) AS orphans FROM ({_P1_SQL}) GROUP BY ALL",
    "p6_found": """
SELECT 'mq' AS gap_field, row_id FROM variants WHERE NOT coalesce(NOT isnan(mq) AND mq BETWEEN 0 AND 100, false)
UNION ALL SELECT 'inbreedingcoeff', row_id FROM variants WHERE NOT coalesce(NOT isnan(inbreedingcoeff) AND inbreedingcoeff BETWEEN -1 AND 1, false)
UNION ALL SELECT 'variant_type', row_id FROM variants
  WHERE NOT coalesce(lower(trim(variant_type, ' ')) IN ('snv', 'indel', 'multi-snv', 'multi-indel', 'mixed'), false)""",
    "p6_filled": _P6_SQL,
    "p6_methods": f"SELECT gap_field, method, count(*) AS cells FROM (SELECT unnest(['mq', 'inbreedingcoeff', 'variant_type']) AS gap_field, unnest([mq_method, inbreedingcoeff_method, variant_type_method]) AS method FROM ({_P6_SQL})) GROUP BY ALL",
    "p7_found": _P7_BASE + "SELECT line_id, reason FROM judged WHERE reason IS NOT NULL",
    "p7_loaded": _P7_BASE
    + "SELECT line_id, c[1] AS chr, CAST(c[2] AS INTEGER) AS pos, c[3] AS rs, c[4] AS ref, c[5] AS alt, c[6] AS consequence FROM judged WHERE reason IS NULL",
}
