"""A cohort derived from the star-schema tables: samples are nations, variants parts, genotype entries line items.

The texts below are valid in Spark SQL and in DuckDB alike, so that a query and its SQL start from the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")

SAMPLES = "SELECT n_nationkey AS sid, n_name AS s, r_name AS pop FROM nation JOIN region ON n_regionkey = r_regionkey"

VARIANTS = """
SELECT p_partkey AS vid,
  CASE WHEN p_partkey % 25 = 23 THEN 'chrX' WHEN p_partkey % 25 = 24 THEN 'chrY' ELSE concat('chr', CAST(1 + p_partkey % 25 % 22 AS STRING)) END AS contig,
  CAST(1000 + p_partkey * 37 AS BIGINT) AS pos,
  CASE WHEN p_size % 7 = 0 THEN 'ATAT' WHEN p_size % 5 = 0 THEN 'A' ELSE substring('ACGT', CAST(1 + p_partkey % 4 AS INT), 1) END AS ref,
  CASE WHEN p_size % 7 = 0 THEN 'A' WHEN p_size % 5 = 0 THEN 'ATA' ELSE substring('ACGT', CAST(1 + (p_partkey + 1 + p_size % 3) % 4 AS INT), 1) END AS alt,
  CASE p_type WHEN 'ECONOMY' THEN 'synonymous_variant' WHEN 'SMALL' THEN 'missense_variant' WHEN 'PROMO' THEN 'frameshift_variant'
    WHEN 'MEDIUM' THEN 'intron_variant' WHEN 'LARGE' THEN 'stop_gained&splice_region_variant' ELSE 'inframe_deletion' END AS consequence,
  CAST(p_size AS DOUBLE) / 2 AS qd, CAST((p_partkey * 17) % 100 AS DOUBLE) AS fs, CAST(20 + (p_partkey * 29) % 61 AS DOUBLE) AS mq,
  CAST((p_partkey * 7919) % 100 + 1 AS INT) AS rf_bin, CAST((p_partkey * 104729) % 10007 AS DOUBLE) / 10007 AS score,
  p_partkey % 3 = 0 AS tp, p_partkey % 5 = 0 AS fp, p_size % 11 = 0 AS was_split, p_partkey % 4 = 0 AS transmitted_singleton, CAST(p_partkey % 9 AS INT) AS freq_ac
FROM part"""

ENTRIES = """
SELECT vid, sid, dp, ad_alt, dp - ad_alt AS ad_ref, gq,
  CASE WHEN ad_alt * 5 < dp THEN 0 WHEN ad_alt * 5 <= dp * 4 THEN 1 ELSE 2 END AS gt
FROM (
  SELECT l_partkey AS vid, n_nationkey AS sid, CAST(SUM(l_quantity) AS INT) AS dp,
    CAST(SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS INT) AS ad_alt, CAST(10 * MAX(l_linenumber) + COUNT(*) AS INT) AS gq
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY l_partkey, n_nationkey) x"""

TRIOS = "SELECT concat('F', CAST(n_nationkey AS STRING)) AS fam_id, n_nationkey AS kid, n_nationkey + 1 AS dad, n_nationkey + 2 AS mom, n_nationkey % 2 = 0 AS is_female FROM nation WHERE n_nationkey % 3 = 0 AND n_nationkey <= 21"

INTERVALS = "SELECT concat('chr', CAST(1 + r_regionkey AS STRING)) AS contig, CAST(1000 + r_regionkey * 5000 AS BIGINT) AS start, CAST(20000 + r_regionkey * 9000 AS BIGINT) AS stop FROM region"

#: The same tables as common table expressions, for the SQL of each query.
WITH = f"WITH smp AS ({SAMPLES}), vars AS ({VARIANTS}), ents AS ({ENTRIES}), trios AS ({TRIOS}), ivals AS ({INTERVALS})"


@dataclass(frozen=True)
class Cohort:
    """Three scopes of a cohort and its pedigree as plain DataFrames; nothing is computed before it is used."""

    samples: DataFrame  # sid, s, pop
    variants: DataFrame  # vid, contig, pos, ref, alt, annotations
    entries: DataFrame  # vid, sid, dp, ad_ref, ad_alt, gq, gt
    trios: DataFrame  # fam_id, kid, dad, mom
    intervals: DataFrame  # contig, start, stop (0-based, half open)


def load(spark: SparkSession, sf: str) -> Cohort:
    tables = {t: spark.read.parquet(f"{sf}/{t}.parquet") for t in TABLES}
    # one shuffle, by variant, before anything else: the entries' aggregate and all that is counted per variant need no other
    tables["lineitem"] = tables["lineitem"].repartition("l_partkey")
    sql = lambda text: spark.sql(_named(text), **tables)
    return Cohort(*map(sql, (SAMPLES, VARIANTS, ENTRIES, TRIOS, INTERVALS)))


def _named(text: str) -> str:
    """Table names become parameters of spark.sql, so that no views need to be registered."""
    for t in TABLES:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t} ", f"JOIN {{{t}}} ")
    return text
