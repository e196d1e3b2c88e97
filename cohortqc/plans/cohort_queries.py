"""Queries of the cohort operators on the derived cohort, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.functions import genetics as G
from cohortqc.operators import aggregates as A
from cohortqc.operators import family, filters, grid, joins, ranks, tiers
from cohortqc.plans import plotdata
from cohortqc.plans.testcohort import WITH, Cohort, load
from cohortqc.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
METRICS = ("n_het", "n_hom_var", "n_snp", "n_insertion", "n_deletion", "r_ti_tv", "r_insertion_deletion", "r_het_hom_var", "heterozygosity_rate")
GRID = {"bins": (20, 30, 40, 50, 60, 70, 80, 90), "dps": (40, 70), "gqs": (50, 60), "abs_": (0.2, 0.4), "call_rates": (0.1, 0.3)}

# the same predicates in SQL
_SNP = "(length(ref) = 1 AND length(alt) = 1 AND ref <> alt)"
_INS, _DEL = "(length(alt) > length(ref))", "(length(alt) < length(ref))"
_KIND = f"CASE WHEN {_SNP} THEN 'snv' WHEN {_INS} OR {_DEL} THEN 'indel' ELSE 'other' END"
_TI = f"({_SNP} AND ref || '>' || alt IN ('A>G', 'G>A', 'C>T', 'T>C'))"
_AUTO = "contig NOT IN ('chrX', 'chrY')"
_AB = "CASE WHEN gt = 1 AND dp <> 0 THEN CAST(ad_alt AS DOUBLE) / dp END"
_VC = f"""vc AS (
  SELECT vid, count(gt) AS n_called, count(*) FILTER (WHERE gt = 0) AS n_hom_ref, count(*) FILTER (WHERE gt = 1) AS n_het, count(*) FILTER (WHERE gt = 2) AS n_hom_var,
    count(*) FILTER (WHERE gt > 0) AS n_non_ref, CAST(sum(gt) AS BIGINT) AS ac, 2 * count(gt) AS an, CAST(sum(gt) AS DOUBLE) / (2 * count(gt)) AS af, CAST(count(gt) AS DOUBLE) / 25 AS call_rate,
    avg(dp) AS dp_mean, avg(gq) AS gq_mean FROM ents GROUP BY vid)"""
_SQC = f"""sqc AS (
  SELECT *, CAST(n_transition AS DOUBLE) / nullif(n_transversion, 0) AS r_ti_tv, CAST(n_insertion AS DOUBLE) / nullif(n_deletion, 0) AS r_insertion_deletion,
    CAST(n_het AS DOUBLE) / nullif(n_hom_var, 0) AS r_het_hom_var, CAST(n_het AS DOUBLE) / nullif(n_called, 0) AS heterozygosity_rate
  FROM (SELECT sid, count(*) AS n_called, count(*) FILTER (WHERE gt = 0) AS n_hom_ref, count(*) FILTER (WHERE gt = 1) AS n_het, count(*) FILTER (WHERE gt = 2) AS n_hom_var, count(*) FILTER (WHERE gt > 0) AS n_non_ref,
    CAST(sum(CASE WHEN {_SNP} THEN gt ELSE 0 END) AS BIGINT) AS n_snp, CAST(sum(CASE WHEN {_TI} THEN gt ELSE 0 END) AS BIGINT) AS n_transition,
    CAST(sum(CASE WHEN {_SNP} AND NOT {_TI} THEN gt ELSE 0 END) AS BIGINT) AS n_transversion, CAST(sum(CASE WHEN {_INS} THEN gt ELSE 0 END) AS BIGINT) AS n_insertion,
    CAST(sum(CASE WHEN {_DEL} THEN gt ELSE 0 END) AS BIGINT) AS n_deletion
    FROM ents JOIN vars USING (vid) GROUP BY sid) q)"""
_MAD = f"""{_SQC}, long AS (
  SELECT * FROM (SELECT sqc.sid, pop, unnest([{', '.join(f"'{m}'" for m in METRICS)}]) AS metric, unnest([{', '.join(f'CAST({m} AS DOUBLE)' for m in METRICS)}]) AS value FROM sqc JOIN smp ON smp.sid = sqc.sid) q),
med AS (SELECT pop, metric, median(value) AS median FROM long GROUP BY ALL),
bounds AS (SELECT pop, metric, any_value(median) AS median, 1.4826::DOUBLE * median(abs(value - median)) AS mad FROM long JOIN med USING (pop, metric) GROUP BY ALL)"""
# one copy in sons, outside the pseudo-autosomal regions
_LOCUS = """CASE WHEN contig = 'chrX' AND NOT (pos BETWEEN 10001 AND 2781479 OR pos BETWEEN 155701383 AND 156030895) THEN 'X'
  WHEN contig = 'chrY' AND NOT (pos BETWEEN 10001 AND 2781479 OR pos BETWEEN 56887903 AND 57217415) THEN 'Y' END"""
_TRIO = f"""tr AS (
  SELECT t.fam_id, t.kid, t.dad, t.mom, v.vid, k.gt AS kid_gt, d.gt AS dad_gt, m.gt AS mom_gt, k.dp AS kid_dp, d.dp AS dad_dp, m.dp AS mom_dp, k.gq AS kid_gq, d.gq AS dad_gq, m.gq AS mom_gq,
    k.ad_alt AS kid_ad, d.ad_alt AS dad_ad, m.ad_alt AS mom_ad, v.hap, t.is_female
  FROM trios t CROSS JOIN (SELECT vid, {_LOCUS} AS hap FROM vars) v LEFT JOIN ents k ON k.vid = v.vid AND k.sid = t.kid LEFT JOIN ents d ON d.vid = v.vid AND d.sid = t.dad LEFT JOIN ents m ON m.vid = v.vid AND m.sid = t.mom
  WHERE k.vid IS NOT NULL OR d.vid IS NOT NULL OR m.vid IS NOT NULL)"""
_AUTO_CODE = """CASE WHEN kid_gt = 1 AND dad_gt = 2 AND mom_gt = 2 THEN 1 WHEN kid_gt = 1 AND dad_gt = 0 AND mom_gt = 0 THEN 2 WHEN kid_gt = 2 AND dad_gt = 0 AND mom_gt = 0 THEN 5
  WHEN kid_gt = 2 AND dad_gt = 0 THEN 3 WHEN kid_gt = 2 AND mom_gt = 0 THEN 4 WHEN kid_gt = 0 AND dad_gt = 2 AND mom_gt = 2 THEN 8 WHEN kid_gt = 0 AND dad_gt = 2 THEN 6 WHEN kid_gt = 0 AND mom_gt = 2 THEN 7 END"""
_CODE = f"""CASE WHEN hap = 'X' AND NOT is_female THEN CASE WHEN kid_gt = 0 AND mom_gt = 2 THEN 9 WHEN kid_gt = 2 AND mom_gt = 0 THEN 10 END
  WHEN hap = 'Y' AND NOT is_female THEN CASE WHEN kid_gt = 0 AND dad_gt = 2 THEN 11 WHEN kid_gt = 2 AND dad_gt = 0 THEN 12 END ELSE {_AUTO_CODE} END"""
_ERR = f"err AS (SELECT * FROM (SELECT *, {_CODE} AS code FROM tr) q WHERE code IS NOT NULL)"
_TU = """tu AS (
  SELECT *, CASE WHEN het > 0 AND raw_t BETWEEN 0 AND het THEN raw_t END AS t, CASE WHEN het > 0 AND raw_t BETWEEN 0 AND het THEN het - raw_t END AS u
  FROM (SELECT *, CASE WHEN dad_gt = 1 THEN 1 WHEN dad_gt IS NOT NULL THEN 0 END + CASE WHEN mom_gt = 1 THEN 1 WHEN mom_gt IS NOT NULL THEN 0 END AS het,
    kid_gt - CASE WHEN dad_gt = 2 THEN 1 WHEN dad_gt IS NOT NULL THEN 0 END - CASE WHEN mom_gt = 2 THEN 1 WHEN mom_gt IS NOT NULL THEN 0 END AS raw_t FROM tr) q)"""


_HWE = """hk AS (SELECT DISTINCT n_hom_ref, n_het, n_hom_var, n_hom_ref + n_het + n_hom_var AS hn, 2 * least(n_hom_ref, n_hom_var) + n_het AS rare FROM vc),
hl AS (SELECT *, het * ln(2) - lgamma((rare - het) // 2 + 1) - lgamma(het + 1) - lgamma(hn - het - (rare - het) // 2 + 1) AS lp FROM (SELECT *, unnest(range(rare % 2, rare + 1, 2)) AS het FROM hk WHERE hn > 0)),
hp AS (SELECT *, exp(lp - max(lp) OVER w) AS p, max(CASE WHEN het = n_het THEN lp END) OVER w - max(lp) OVER w AS ls FROM hl WINDOW w AS (PARTITION BY n_hom_ref, n_het, n_hom_var)),
hwe AS (SELECT n_hom_ref, n_het, n_hom_var, least(1.0, (coalesce(sum(p) FILTER (WHERE p < exp(ls) * (1 - 1e-9::DOUBLE)), 0) + sum(p) FILTER (WHERE abs(p - exp(ls)) <= exp(ls) * 1e-9::DOUBLE) / 2) / sum(p)) AS p_hwe FROM hp GROUP BY ALL)"""


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, Cohort], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf: f(spark, load(spark, sf))
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _n(c: Cohort) -> int:
    return c.samples.count()


# ---- filters -----------------------------------------------------------------------------------------------------
@query(f"{WITH}, {_VC} SELECT * FROM vc")
def variant_qc_counts(spark, c):
    return A.variant_counts(c.entries, _n(c))


@query(f"{WITH}, {_VC}, {_HWE} SELECT vid, n_hom_ref, n_het, n_hom_var, round(p_hwe, 9) AS p_hwe FROM vc JOIN hwe USING (n_hom_ref, n_het, n_hom_var)")
def hwe_p(spark, c):
    return A.variant_qc(c.entries, _n(c)).select("vid", "n_hom_ref", "n_het", "n_hom_var", F.round("p_hwe", 9).alias("p_hwe"))


@query(f"{WITH}, {_SQC} SELECT * FROM sqc")
def sample_qc_metrics(spark, c):
    return A.sample_qc(c.entries, c.variants)


@query(f"{WITH}, {_VC} SELECT vid FROM vars JOIN vc USING (vid) WHERE {_SNP} AND NOT was_split AND af > 0.001 AND call_rate > 0.6")
def call_rate_filter(spark, c):
    return filters.sex_check_variants(c.variants, A.variant_counts(c.entries, _n(c)), 0.001, 0.6).select("vid")


@query(f"{WITH}, {_VC} SELECT vid, af FROM vc WHERE call_rate >= 0.5 AND af >= 0.05")
def allele_freq_filter(spark, c):
    return A.variant_counts(c.entries, _n(c)).where("call_rate >= 0.5 and af >= 0.05").select("vid", "af")


@query(f"{WITH} SELECT vid, contig, pos FROM vars WHERE {_AUTO}")
def autosome_filter(spark, c):
    return filters.autosomes(c.variants).select("vid", "contig", "pos")


@query(f"{WITH} SELECT vid FROM vars WHERE {_AUTO} AND {_SNP} AND NOT was_split")
def autosomal_snv_filter(spark, c):
    return filters.autosomal_snvs(c.variants, drop_split=True).select("vid")


@query(f"{WITH} SELECT vid FROM vars WHERE {_AUTO} AND {_SNP}")
def autosomal_snvs_with_split(spark, c):
    return filters.autosomal_snvs(c.variants).select("vid")


@query(f"{WITH} SELECT vid, ref, alt FROM vars WHERE ref || alt NOT IN ('GC', 'CG', 'AT', 'TA')")
def palindrome_filter(spark, c):
    return filters.without_palindromes(c.variants).select("vid", "ref", "alt")


@query(
    f"{WITH}, {_VC}, {_HWE} SELECT vid FROM vars JOIN vc USING (vid) JOIN hwe USING (n_hom_ref, n_het, n_hom_var) WHERE {_AUTO} AND {_SNP} AND call_rate >= 0.5 AND af >= 0.05 AND p_hwe >= 0.05 AND ref || alt NOT IN ('GC', 'CG', 'AT', 'TA')"
    " AND NOT EXISTS (SELECT 1 FROM ivals i WHERE i.contig = vars.contig AND pos - 1 >= i.start AND pos - 1 < i.stop)"
)
def ld_prune_prefilter(spark, c):
    return filters.ld_prune_candidates(c.variants, A.variant_qc(c.entries, _n(c)), c.intervals, call_rate=0.5, af=0.05, p_hwe=0.05).select("vid")


@query(f"{WITH} SELECT vid, sid FROM ents WHERE dp > 60 AND gq > 50 AND (gt <> 1 OR ({_AB}) > 0.3)")
def genotype_filter(spark, c):
    return filters.strict_genotypes(c.entries, 60, 50, 0.3).select("vid", "sid")


@query(f"{WITH} SELECT avg(CASE WHEN dp > 60 AND gq > 50 AND (gt <> 1 OR ({_AB}) > 0.3) THEN 0.0 ELSE 1.0 END) AS failed_fraction FROM ents")
def genotype_failed_fraction(spark, c):
    return filters.failed_fraction(c.entries, 60, 50, 0.3)


@query(
    f"""{WITH}, good AS (SELECT * FROM ents WHERE NOT ((gt = 1 AND ({_AB}) < 0.3) OR dp < 50 OR gq < 50)),
kept AS (SELECT vid FROM good GROUP BY vid HAVING CAST(count(*) AS DOUBLE) / 25 > 0.3 AND sum(gt) > 0) SELECT vid, sid, gt FROM good WHERE vid IN (SELECT vid FROM kept)"""
)
def hard_filter(spark, c):
    return filters.hard_filtered_entries(c.entries, _n(c), filters.HardFilter(50, 50, 0.3, 0.3)).select("vid", "sid", "gt")


@query(f"{WITH} SELECT vid FROM vars WHERE ({_SNP} AND rf_bin <= 80) OR (({_INS} OR {_DEL}) AND rf_bin <= 60)")
def rf_bin_filter(spark, c):
    return filters.rf_bin_filter(c.variants, 80, 60).select("vid")


@query(f"{WITH} SELECT vid, qd < 2 OR fs > 60 OR mq < 30 AS fail_hard_filters FROM vars")
def hard_filter_flag(spark, c):
    return c.variants.select("vid", filters.fail_hard_filters().alias("fail_hard_filters"))


@query(f"{WITH} SELECT vid, sid FROM ents WHERE gq >= 20 AND dp >= 10 AND (gt <> 1 OR ({_AB}) >= 0.2)")
def adj_filter(spark, c):
    return c.entries.where(G.adj_pass()).select("vid", "sid")


@query(f"{WITH} SELECT vid FROM vars WHERE consequence IN ('synonymous_variant', 'missense_variant')")
def consequence_filter(spark, c):
    return filters.with_consequence(c.variants, ["synonymous_variant", "missense_variant"]).select("vid")


@query(f"{WITH} SELECT vid FROM vars WHERE contig = 'chr20' OR (contig = 'chr1' AND pos BETWEEN 1000 AND 30000)")
def test_interval_filter(spark, c):
    return c.variants.where(G.in_intervals(["chr20", "chr1:1000-30000"])).select("vid")


# ---- joins --------------------------------------------------------------------------------------------------------
@query(f"{WITH}, {_VC} SELECT vid, contig, af, call_rate FROM vars LEFT JOIN vc USING (vid)")
def annotate_left_join(spark, c):
    return joins.annotate(c.variants.select("vid", "contig"), A.variant_counts(c.entries, _n(c)), ["vid"], ["af", "call_rate"])


_SETS = {"hapmap": "vid % 3 = 0", "omni": "vid % 5 = 0", "kgp_phase1_hc": "vid % 7 = 0", "mills": "vid % 11 = 0"}


@query(
    f"{WITH} SELECT contig, pos, ref, alt, {', '.join(f'CASE WHEN {p} THEN true END AS {n}' for n, p in _SETS.items())} FROM vars WHERE {' OR '.join(_SETS.values())}"
)
def truth_full_outer(spark, c):
    return joins.flag_sets({n: c.variants.where(p) for n, p in _SETS.items()}, ["contig", "pos", "ref", "alt"])


@query(f"{WITH} SELECT vid, sid FROM ents WHERE sid IN (SELECT sid FROM smp WHERE pop = 'ASIA')")
def semi_join_samples(spark, c):
    return filters.in_set(c.entries.select("vid", "sid"), c.samples.where("pop = 'ASIA'"), "sid")


@query(f"{WITH} SELECT vid, sid FROM ents WHERE sid NOT IN (SELECT sid FROM smp WHERE pop = 'ASIA')")
def anti_join_samples(spark, c):
    return c.entries.select("vid", "sid").join(c.samples.where("pop = 'ASIA'").select("sid"), "sid", "left_anti")


@query(f"{WITH} SELECT vid, contig, pos FROM vars WHERE EXISTS (SELECT 1 FROM ivals i WHERE i.contig = vars.contig AND pos - 1 >= i.start AND pos - 1 < i.stop)")
def interval_semi(spark, c):
    return joins.interval_semi(c.variants.select("vid", "contig", "pos"), c.intervals)


@query(f"{WITH} SELECT vid, contig, pos FROM vars WHERE NOT EXISTS (SELECT 1 FROM ivals i WHERE i.contig = vars.contig AND pos - 1 >= i.start AND pos - 1 < i.stop)")
def interval_anti(spark, c):
    return joins.interval_anti(c.variants.select("vid", "contig", "pos"), c.intervals)


@query(f"{WITH}, {_TRIO} SELECT vid, fam_id, kid_gt, dad_gt, mom_gt FROM tr")
def trio_join(spark, c):
    return joins.trio_entries(c.entries, c.trios).select("vid", "fam_id", "kid_gt", "dad_gt", "mom_gt")


@query(f"{WITH}, asia AS (SELECT sid FROM smp WHERE pop = 'ASIA'), k AS (SELECT vid FROM ents WHERE sid IN (SELECT sid FROM asia) INTERSECT SELECT vid FROM ents WHERE sid NOT IN (SELECT sid FROM asia)) SELECT vid, sid, gt FROM ents WHERE vid IN (SELECT vid FROM k)")
def union_cols_populations(spark, c):
    """Two cohorts by population, all entries of each; the smaller lacks variants of the other because calls are missing."""
    asia = c.samples.where("pop = 'ASIA'").select("sid")
    one, two = c.entries.join(asia, "sid", "left_semi"), c.entries.join(asia, "sid", "left_anti")
    return joins.union_cols(one, two).select("vid", "sid", "gt")


@query(f"{WITH} SELECT contig, pos, count(*) AS n, string_agg(ref || '>' || alt, ',' ORDER BY ref, alt) AS alleles FROM vars GROUP BY contig, pos")
def collect_by_key(spark, c):
    k = joins.collect_by_key(c.variants.select("contig", "pos", "ref", "alt"), ["contig", "pos"])
    return k.select("contig", "pos", F.size("values").cast("long").alias("n"), F.array_join(F.transform("values", lambda x: F.concat(x["ref"], F.lit(">"), x["alt"])), ",").alias("alleles"))


# ---- aggregates ---------------------------------------------------------------------------------------------------------
@query(f"{WITH} SELECT unnest(string_split(consequence, '&')) AS term, count(*) AS n FROM vars GROUP BY 1")
def consequence_counts(spark, c):
    return A.consequence_counts(c.variants)


@query(f"{WITH} SELECT tp, fp, {_KIND} AS kind, count(*) AS n FROM vars GROUP BY ALL")
def confusion_counts(spark, c):
    return A.confusion(c.variants.withColumn("kind", G.allele_class()), ["tp", "fp", "kind"])


_SPEC = f"""spec AS (SELECT sid, ref || '>' || alt AS mutation_type, count(*) FILTER (WHERE gt = 1) + 2 * count(*) FILTER (WHERE gt = 2) AS alt_calls
  FROM ents JOIN vars USING (vid) WHERE {_AUTO} AND {_SNP} GROUP BY ALL), frac AS (SELECT *, CAST(alt_calls AS DOUBLE) / nullif(sum(alt_calls) OVER (PARTITION BY sid), 0) AS fraction FROM spec)"""
_DESC = """d AS (SELECT mutation_type, count(fraction) AS count, avg(fraction) AS mean, stddev_samp(fraction) AS std, min(fraction) AS min, quantile_cont(fraction, 0.25) AS q1, quantile_cont(fraction, 0.5) AS q2,
  quantile_cont(fraction, 0.75) AS q3, max(fraction) AS max FROM frac GROUP BY ALL), box AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM d)"""


@query(f"{WITH}, {_SPEC} SELECT sid, mutation_type, alt_calls, round(fraction, 9) AS fraction FROM frac")
def mutation_spectra(spark, c):
    return A.mutation_spectra(c.entries, c.variants).withColumn("fraction", F.round("fraction", 9))


@query(f"{WITH}, {_SPEC} SELECT sid, " + ", ".join(f"round(any_value(fraction) FILTER (WHERE mutation_type = '{a}>{b}'), 9) AS \"{a}_to_{b}\"" for a in "ACGT" for b in "ACGT" if a != b) + " FROM frac GROUP BY sid")
def pivot_spectra(spark, c):
    wide = A.pivot_spectra(A.mutation_spectra(c.entries, c.variants))
    return wide.select("sid", *[F.round(x, 9).alias(x) for x in wide.columns[1:]])


_R = lambda cols: ", ".join(f"round({x}, 8) AS {x}" for x in cols)
_BOX = ("mean", "std", "min", "q1", "q2", "q3", "max", "lower", "upper")


@query(f"{WITH}, {_SPEC}, {_DESC} SELECT mutation_type, count, {_R(_BOX)} FROM box")
def spectra_box(spark, c):
    d = A.describe_by(A.mutation_spectra(c.entries, c.variants), "mutation_type", "fraction")
    return d.select("mutation_type", "count", *[F.round(x, 8).alias(x) for x in _BOX])


@query(f"{WITH}, {_SPEC}, {_DESC} SELECT sid, mutation_type FROM frac JOIN box USING (mutation_type) WHERE fraction < lower OR fraction > upper")
def spectra_iqr_outliers(spark, c):
    return A.iqr_outliers(A.mutation_spectra(c.entries, c.variants), "mutation_type", "fraction").select("sid", "mutation_type")


def _stratified(c: Cohort) -> DataFrame:
    return A.sample_qc(c.entries, c.variants).join(c.samples.select("sid", "pop"), "sid")


@query(f"{WITH}, {_MAD} SELECT pop, metric, round(median, 8) AS median, round(mad, 8) AS mad, round(median - 4 * mad, 8) AS lower, round(median + 4 * mad, 8) AS upper FROM bounds")
def mad_bounds(spark, c):
    wide = _stratified(c).select("pop", *[F.col(m).cast("double").alias(m) for m in METRICS])
    return A.mad_bounds(wide, "pop", METRICS).select("pop", "metric", *[F.round(x, 8).alias(x) for x in ("median", "mad", "lower", "upper")])


@query(f"""{WITH}, {_MAD} SELECT sid, pop, coalesce(string_agg(metric, ',' ORDER BY metric) FILTER (WHERE value < median - 1.5 * mad OR value > median + 1.5 * mad), '') AS failed,
  CASE WHEN count(*) FILTER (WHERE value < median - 1.5 * mad OR value > median + 1.5 * mad) = 0 THEN 'Pass' ELSE 'Fail' END AS status FROM long JOIN bounds USING (pop, metric) GROUP BY sid, pop""")
def mad_outliers(spark, c):
    out = A.pass_fail(A.mad_outliers(_stratified(c), "pop", METRICS, 1.5))
    return out.select("sid", "pop", F.array_join("qc_metrics_filters", ",").alias("failed"), "status")


@query(f"{WITH} SELECT CAST(least(20, floor(qd * 20 / 25) + 1) AS INTEGER) AS bin, count(*) AS n FROM vars WHERE qd BETWEEN 0 AND 25 GROUP BY 1")
def hist_metric(spark, c):
    return A.histogram(c.variants, "qd", 0.0, 25.0, 20)


@query(f"{WITH} SELECT count(*) FILTER (WHERE qd < 5) AS below, count(*) FILTER (WHERE qd > 20) AS above FROM vars")
def below_above(spark, c):
    return A.below_above(c.variants, "qd", 5.0, 20.0)


@query(f"{WITH} SELECT vid, round(avg({_AB}), 9) AS mean_het_ab FROM ents GROUP BY vid")
def hetab_mean(spark, c):
    return A.mean_het_ab(c.entries).withColumn("mean_het_ab", F.round("mean_het_ab", 9))


@query(f"{WITH} SELECT vid, CAST(coalesce(sum(gt), 0) AS BIGINT) AS ac_raw, CAST(coalesce(sum(gt) FILTER (WHERE gq >= 20 AND dp >= 10 AND (gt <> 1 OR ({_AB}) >= 0.2)), 0) AS BIGINT) AS ac_adj FROM ents GROUP BY vid")
def allele_counts(spark, c):
    return A.allele_counts(c.entries)


@query(f"{WITH}, {_VC} SELECT vid, an - ac AS ac_ref, ac AS ac_alt, an, n_hom_ref, n_hom_var FROM vc")
def call_stats(spark, c):
    s = A.call_stats(c.entries)
    return s.select("vid", s["ac"][0].alias("ac_ref"), s["ac"][1].alias("ac_alt"), "an", s["homozygote_count"][0].alias("n_hom_ref"), s["homozygote_count"][1].alias("n_hom_var"))


@query(f"{WITH}, {_VC} SELECT vid, round(1 - n_het / nullif(2 * af * (1 - af) * n_called, 0), 8) AS inbreeding_coeff FROM vc")
def inbreeding_coef(spark, c):
    return A.inbreeding(c.entries).withColumn("inbreeding_coeff", F.round("inbreeding_coeff", 8))


def _class_sql() -> str:
    cols = []
    for name, (kind, terms) in A.CLASSES.items():
        t = f"gt > 0 AND {_KIND} = '{kind}' AND consequence IN ({', '.join(repr(x) for x in terms)})"
        cols += [f"count(*) FILTER (WHERE {t}) AS {name}_all", f"count(*) FILTER (WHERE {t} AND freq_ac < 5) AS {name}_rare"]
    return f"cc AS (SELECT smp.sid, {', '.join(cols)} FROM smp LEFT JOIN ents ON ents.sid = smp.sid LEFT JOIN vars ON vars.vid = ents.vid GROUP BY smp.sid)"


@query(f"{WITH}, {_class_sql()} SELECT * FROM cc")
def per_sample_class_counts(spark, c):
    return A.class_counts(c.entries, c.variants, c.samples)


_CLASS_COLS = [f"{n}_{k}" for n in A.CLASSES for k in ("all", "rare")]


@query(f"{WITH}, {_class_sql()} SELECT class, median(n) AS median_n FROM (SELECT unnest([{', '.join(repr(x) for x in _CLASS_COLS)}]) AS class, unnest([{', '.join(_CLASS_COLS)}]) AS n FROM cc) GROUP BY class")
def median_class_counts(spark, c):
    return A.median_class_counts(A.class_counts(c.entries, c.variants, c.samples))


@query(f"{WITH} SELECT sid, CAST(count(gt) AS DOUBLE) / (SELECT count(*) FROM vars) AS call_rate FROM ents GROUP BY sid")
def sample_call_rate(spark, c):
    return A.sample_call_rate(c.entries, c.variants.count())


@query(f"{WITH} SELECT vid, coalesce(q, (SELECT median(qd) FROM vars v2 WHERE {_KIND.replace('ref', 'v2.ref').replace('alt', 'v2.alt')} = kind AND v2.qd >= 3)) AS qd, q IS NULL AS qd_imputed FROM (SELECT vid, {_KIND} AS kind, CASE WHEN qd >= 3 THEN qd END AS q FROM vars) x")
def median_impute(spark, c):
    from cohortqc.operators.model import median_impute as impute

    v = c.variants.select("vid", G.allele_class().alias("kind"), F.when(F.col("qd") >= 3, F.col("qd")).alias("qd"))
    return impute(v, "kind", ["qd"]).select("vid", "qd", "qd_imputed")


# ---- ranks and bins ---------------------------------------------------------------------------------------------------------
_RANK = f"""rk AS (SELECT *, {_SNP} AS is_snv, row_number() OVER (PARTITION BY {_SNP} ORDER BY score, vid) - 1 AS rank,
  CASE WHEN NOT was_split THEN count(*) FILTER (WHERE NOT was_split) OVER (PARTITION BY {_SNP} ORDER BY score, vid ROWS UNBOUNDED PRECEDING) - 1 END AS biallelic_rank,
  CASE WHEN transmitted_singleton THEN count(*) FILTER (WHERE transmitted_singleton) OVER (PARTITION BY {_SNP} ORDER BY score, vid ROWS UNBOUNDED PRECEDING) - 1 END AS singleton_rank FROM vars)"""
_BINS = f"""{_RANK}, lr AS (SELECT * FROM (SELECT *, unnest(['rank', 'biallelic_rank', 'singleton_rank']) AS rank_id, unnest([rank, biallelic_rank, singleton_rank]) AS r FROM rk) q WHERE r IS NOT NULL),
bn AS (SELECT * FROM (SELECT *, CAST(ceil((r + 1) / nullif(floor(count(*) OVER (PARTITION BY rank_id, is_snv) / 100), 0)) AS INTEGER) AS bin FROM lr) q WHERE bin IS NOT NULL)"""
_SUB = {"biallelic_rank": "not was_split", "singleton_rank": "transmitted_singleton"}
_NAMES = ["rank", *_SUB]


def _ranked(c: Cohort) -> DataFrame:
    return ranks.add_ranks(c.variants, "score", _SUB)


@query(f"{WITH}, {_RANK} SELECT vid, is_snv, rank, biallelic_rank, singleton_rank FROM rk")
def rank_snv_indel(spark, c):
    return _ranked(c).select("vid", "is_snv", "rank", "biallelic_rank", "singleton_rank")


@query(f"{WITH}, {_RANK} SELECT rank_id, is_snv, count(r) AS n FROM (SELECT is_snv, unnest(['rank', 'biallelic_rank', 'singleton_rank']) AS rank_id, unnest([rank, biallelic_rank, singleton_rank]) AS r FROM rk) GROUP BY ALL")
def rank_counts(spark, c):
    return ranks.rank_counts(_ranked(c), _NAMES)


@query(f"{WITH}, {_BINS} SELECT vid, rank_id, bin FROM bn")
def bin_assign(spark, c):
    return ranks.binned(_ranked(c), _NAMES).select("vid", "rank_id", "bin")


def _bins(c: Cohort) -> DataFrame:
    return ranks.bin_aggregate(ranks.binned(_ranked(c), _NAMES).withColumn("fail_hard_filters", filters.fail_hard_filters()).withColumn("omni", F.col("tp")))


@query(f"""{WITH}, {_BINS} SELECT rank_id, contig, is_snv AS snv, biallelic_rank IS NOT NULL AS bi_allelic, transmitted_singleton AS singleton, singleton_rank IS NOT NULL AS trans_singletons, bin,
  min(score) AS min_score, max(score) AS max_score, count(*) AS n, count(*) FILTER (WHERE {_INS}) AS n_ins, count(*) FILTER (WHERE {_DEL}) AS n_del, count(*) FILTER (WHERE {_TI}) AS n_ti, count(*) FILTER (WHERE {_SNP} AND NOT {_TI}) AS n_tv,
  count(*) FILTER (WHERE abs(length(ref) - length(alt)) = 1) AS n_1bp_indel, count(*) FILTER (WHERE abs(length(ref) - length(alt)) % 3 = 0) AS n_mod3bp_indel, count(*) FILTER (WHERE transmitted_singleton) AS n_singleton,
  count(*) FILTER (WHERE tp) AS n_omni, count(*) FILTER (WHERE qd < 2 OR fs > 60 OR mq < 30) AS fail_hard_filters, count(*) FILTER (WHERE (qd < 2 OR fs > 60 OR mq < 30) AND {_SNP}) AS fail_hard_filters_snvs FROM bn GROUP BY ALL""")
def bin_aggregate(spark, c):
    keep = ["rank_id", "contig", "snv", "bi_allelic", "singleton", "trans_singletons", "bin", "min_score", "max_score", "n", "n_ins", "n_del", "n_ti", "n_tv", "n_1bp_indel", "n_mod3bp_indel", "n_singleton", "n_omni", "fail_hard_filters", "fail_hard_filters_snvs"]
    return _bins(c).select(*keep)


@query(f"{WITH}, {_BINS}, per AS (SELECT rank_id, bin, CAST(count(*) FILTER (WHERE {_TI}) AS BIGINT) AS ti, CAST(count(*) FILTER (WHERE {_SNP} AND NOT {_TI}) AS BIGINT) AS tv FROM bn GROUP BY ALL) SELECT rank_id, bin, CAST(ti AS DOUBLE) / nullif(tv, 0) AS non_cumul, CAST(sum(ti) OVER w AS DOUBLE) / nullif(sum(tv) OVER w, 0) AS cumul FROM per WINDOW w AS (PARTITION BY rank_id ORDER BY bin)")
def bin_cumulative(spark, c):
    return ranks.ratio_curve(ranks.coarser(_bins(c)), "rank_id", "bin", "n_ti", "n_tv")


# annotations that a cohort gets from its families and truth sets, made up from the identifier
_ANN = {
    "p_de_novo": "CASE WHEN vid % 7 < 3 THEN CAST(vid % 101 AS DOUBLE) / 101 END", "confidence": "CASE vid % 5 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'LOW' END", "t": "CAST(vid % 4 AS BIGINT)", "u": "CAST(vid % 3 AS BIGINT)",
    "mendel_errors": "CAST(vid % 2 AS BIGINT)", "unrelated_ac": "CAST(vid % 3 AS BIGINT)", "ac_raw": "CAST(vid % 5 AS BIGINT)", "population_af": "CASE WHEN vid % 6 <> 0 THEN CAST(vid % 10 AS DOUBLE) / 20 END",
    "variant_transmitted_singletons": "CAST(vid % 2 AS BIGINT)", "variant_untransmitted_singletons": "CAST(vid % 3 AS BIGINT)", "omni": "tp", "mills": "vid % 7 = 0", "hapmap": "vid % 8 = 0", "kgp_phase1_hc": "CASE WHEN vid % 9 = 0 THEN true END",
    "fail_hard_filters": "qd < 2 OR fs > 60 OR mq < 30",
}
_COND = {
    "singleton_rank": "transmitted_singleton", "biallelic_rank": "NOT was_split", "biallelic_singleton_rank": "NOT was_split AND transmitted_singleton", "de_novo_high_quality_rank": "p_de_novo > 0.9", "de_novo_medium_quality_rank": "p_de_novo > 0.5",
    "de_novo_synonymous_rank": "consequence = 'synonymous_variant'",
}
_AL = ["rank", *_COND]
_ALL_RANKS = f"""an AS (SELECT *, {', '.join(f'{x} AS {n}' for n, x in _ANN.items())} FROM vars), ar AS (SELECT *, {_SNP} AS is_snv, row_number() OVER (PARTITION BY {_SNP} ORDER BY score, vid) - 1 AS rank,
  {', '.join(f"CASE WHEN {x} THEN count(*) FILTER (WHERE {x}) OVER (PARTITION BY {_SNP} ORDER BY score, vid ROWS UNBOUNDED PRECEDING) - 1 END AS {n}" for n, x in _COND.items())} FROM an),
al AS (SELECT * FROM (SELECT *, unnest([{', '.join(repr(n) for n in _AL)}]) AS rank_id, unnest([{', '.join(_AL)}]) AS r FROM ar) q WHERE r IS NOT NULL),
ab AS (SELECT * FROM (SELECT *, CAST(ceil((r + 1) / nullif(floor(count(*) OVER (PARTITION BY rank_id, is_snv) / 100), 0)) AS INTEGER) AS bin FROM al) q WHERE bin IS NOT NULL)"""


def _all_bins(c: Cohort) -> DataFrame:
    v = c.variants.withColumns({n: F.expr(x) for n, x in _ANN.items()})
    return ranks.binned(ranks.add_ranks(v, "score", ranks.subrank_flags()), _AL)


@query(f"{WITH}, {_ALL_RANKS} SELECT vid, is_snv, {', '.join(_AL)} FROM ar")
def rank_all_subranks(spark, c):
    return ranks.add_ranks(c.variants.withColumns({n: F.expr(x) for n, x in _ANN.items()}), "score", ranks.subrank_flags()).select("vid", "is_snv", *_AL)


def _measures_sql() -> str:
    syn, single = "consequence = 'synonymous_variant'", "ac_raw < 3 AND unrelated_ac = 1"
    count = lambda n, x: f"count(*) FILTER (WHERE {x}) AS {n}"
    total = lambda n, v, x: f"CAST(coalesce(sum({v}) FILTER (WHERE {x}), 0) AS BIGINT) AS {n}"
    return ", ".join([
        "min(score) AS min_score, max(score) AS max_score, count(*) AS n", count("n_ins", _INS), count("n_del", _DEL), count("n_ti", _TI), count("n_tv", f"{_SNP} AND NOT {_TI}"), count("n_1bp_indel", "abs(length(ref) - length(alt)) = 1"),
        count("n_mod3bp_indel", "abs(length(ref) - length(alt)) % 3 = 0"), count("n_singleton", "transmitted_singleton"), count("n_high_quality_de_novos", "p_de_novo > 0.99"), count("n_medium_quality_de_novos", "p_de_novo > 0.5"),
        count("n_high_confidence_de_novos", "confidence = 'HIGH'"), total("n_de_novo", "mendel_errors", "unrelated_ac = 0"), count("n_high_quality_de_novos_synonymous", f"p_de_novo > 0.99 AND {syn}"),
        count("n_trans_singletons_synonymous_algorithm", "variant_transmitted_singletons = 1"), count("n_untrans_singletons_synonymous_algorithm", "variant_untransmitted_singletons = 1"), count("n_de_novo_sites", "unrelated_ac = 0 AND mendel_errors > 0"),
        total("n_trans_singletons", "t", single), total("n_untrans_singletons", "u", single), total("n_trans_singletons_synonymous", "t", f"{single} AND {syn}"), total("n_untrans_singletons_synonymous", "u", f"{single} AND {syn}"),
        count("n_train_trans_singletons", "unrelated_ac = 1 AND t = 1"), total("n_trans_common", "t", "population_af >= 0.1"), total("n_untrans_common", "u", "population_af >= 0.1"), count("n_trans_singletons_synonymous_tdt", f"{syn} AND t = 1 AND u = 0"),
        count("n_untrans_singletons_synonymous_tdt", f"{syn} AND t = 0 AND u = 1"), count("n_omni", "omni"), count("n_mills", "mills"), count("n_hapmap", "hapmap"), count("n_kgp_high_conf_snvs", "kgp_phase1_hc"),
        count("fail_hard_filters", "fail_hard_filters"), count("fail_hard_filters_snvs", f"fail_hard_filters AND {_SNP}"), count("fail_hard_filters_indels", f"fail_hard_filters AND ({_INS} OR {_DEL})"),
    ])


_ALL_BINS = f"""{_ALL_RANKS}, am AS (SELECT rank_id, contig, is_snv AS snv, biallelic_rank IS NOT NULL AS bi_allelic, transmitted_singleton AS singleton, singleton_rank IS NOT NULL AS trans_singletons,
  de_novo_high_quality_rank IS NOT NULL AS de_novo_high_quality, de_novo_medium_quality_rank IS NOT NULL AS de_novo_medium_quality, de_novo_synonymous_rank IS NOT NULL AS de_novo_synonymous, bin, {_measures_sql()} FROM ab GROUP BY ALL)"""


@query(f"{WITH}, {_ALL_BINS} SELECT * FROM am")
def bin_aggregate_all(spark, c):
    """All measures per all ten keys."""
    return ranks.bin_aggregate(_all_bins(c))


def _curves_sql() -> str:
    part = lambda n, d, x: f"CAST({n}{x} AS DOUBLE) / nullif({d}{x}, 0)" if d else f"CAST({n}{x} AS DOUBLE)"
    need = sorted({x for n, d in plotdata.BIN_CURVES.values() for x in (n, d) if x})
    per = f"pb AS (SELECT rank_id, snv, bin, {', '.join(f'CAST(sum({x}) AS BIGINT) AS {x}' for x in need)} FROM am GROUP BY ALL)"
    up = f"pu AS (SELECT *, {', '.join(f'sum({x}) OVER w AS {x}_up' for x in need)} FROM pb WINDOW w AS (PARTITION BY rank_id, snv ORDER BY bin))"
    each = " UNION ALL ".join(f"SELECT '{m}' AS metric, rank_id, snv, bin, round({part(n, d, '')}, 9) AS value, round({part(n, d, '_up')}, 9) AS cumulative, n FROM pu" for m, (n, d) in plotdata.BIN_CURVES.items())
    return f"{per}, {up} {each}"


@query(f"{WITH}, {_ALL_BINS}, {_curves_sql()}")
def bin_curves(spark, c):
    """All sixteen curves over the bins."""
    return plotdata.bin_curves(ranks.bin_aggregate(_all_bins(c))).withColumns({x: F.round(x, 9) for x in ("value", "cumulative")})


_T = ranks.threshold_range(60)


@query(f"{WITH} SELECT t AS threshold, 100.0 * count(*) FILTER (WHERE tp AND rf_bin <= t) / count(*) FILTER (WHERE tp) AS tp_pc, 100.0 * count(*) FILTER (WHERE fp AND rf_bin <= t) / count(*) FILTER (WHERE fp) AS fp_pc FROM vars, (SELECT unnest({_T}) AS t) GROUP BY t")
def threshold_sweep(spark, c):
    return ranks.threshold_sweep(c.variants.withColumn("bin", F.col("rf_bin")), _T)


# ---- families -----------------------------------------------------------------------------------------------------------------------
def _trio(c: Cohort, fields=("gt",)) -> DataFrame:
    return joins.trio_entries(c.entries, c.trios, fields)


@query(f"{WITH}, {_TRIO}, {_ERR} SELECT vid, count(*) AS errors FROM err GROUP BY vid")
def mendel_per_variant(spark, c):
    return family.mendel_per_variant(family.mendel_errors(family.with_haploid(_trio(c), c.variants, c.trios)))


@query(f"{WITH}, {_TRIO}, {_ERR} SELECT sid, count(*) AS errors FROM (SELECT kid AS sid FROM err UNION ALL SELECT dad FROM err WHERE code IN (1, 2, 3, 6, 11, 12) UNION ALL SELECT mom FROM err WHERE code IN (1, 2, 4, 7, 9, 10)) GROUP BY sid")
def mendel_per_sample(spark, c):
    return family.mendel_per_sample(family.mendel_errors(family.with_haploid(_trio(c), c.variants, c.trios)))


@query(f"{WITH}, {_TRIO}, {_ERR}, r AS (SELECT CAST((SELECT count(*) FROM err WHERE err.kid = trios.kid) AS DOUBLE) / (SELECT count(*) FROM vars) AS r FROM trios) SELECT round(avg(r), 9) AS mendelian_error_mean, round(stddev_pop(r), 9) AS mendelian_error_std FROM r")
def mendel_proband_rate(spark, c):
    r = family.proband_error_rate(family.with_haploid(_trio(c), c.variants, c.trios), c.trios, c.variants.count())
    return r.select(*[F.round(x, 9).alias(x) for x in r.columns])


@query(f"{WITH}, {_TRIO}, {_TU}, s AS (SELECT vid, CAST(coalesce(sum(t), 0) AS BIGINT) AS t, CAST(coalesce(sum(u), 0) AS BIGINT) AS u FROM tu GROUP BY vid) SELECT vid, t, u, CAST((t - u) * (t - u) AS DOUBLE) / nullif(t + u, 0) AS chi_sq FROM s")
def tdt_counts(spark, c):
    return family.tdt(_trio(c), p_value=False)


# 1 - erf(sqrt(x / 2)) as a power series, which is exact enough for the few trios here
_TAIL = "1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 120), lambda k: power(-1.0::DOUBLE, k) * exp((2 * k + 1) * ln(sqrt(chi_sq / 2)) - lgamma(k + 1)) / (2 * k + 1)))"


@query(
    f"""{WITH}, {_TRIO}, {_TU}, s AS (SELECT vid, CAST(coalesce(sum(t), 0) AS BIGINT) AS t, CAST(coalesce(sum(u), 0) AS BIGINT) AS u FROM tu GROUP BY vid), c AS (SELECT vid, t, u, CAST((t - u) * (t - u) AS DOUBLE) / nullif(t + u, 0) AS chi_sq FROM s)
  SELECT *, round(CASE WHEN chi_sq = 0 THEN 1.0 WHEN chi_sq > 0 THEN {_TAIL} END, 9) AS p_value FROM c"""
)
def tdt_p(spark, c):
    p = F.nanvl("p_value", F.lit(None).cast("double"))
    return family.tdt(_trio(c)).withColumn("p_value", F.round(p, 9))


def _trio_stats_sql() -> str:
    adj = {r: f"({r}_gq >= 20 AND {r}_dp >= 10 AND ({r}_gt <> 1 OR CAST({r}_ad AS DOUBLE) / {r}_dp >= 0.2))" for r in ("kid", "dad", "mom")}
    out = []
    for name, ok in (("raw", False), ("adj", True)):
        every = " AND ".join(adj.values()) if ok else "true"
        one = lambda r: adj[r] if ok else "true"  # noqa: B023, E731
        ac = lambda r: f"coalesce(sum({r}_gt) FILTER (WHERE {one(r)}), 0)"  # noqa: B023, E731
        an = lambda r: f"2 * count({r}_gt) FILTER (WHERE {one(r)})"  # noqa: B023, E731
        out += [f"CAST(coalesce(sum(t) FILTER (WHERE {every}), 0) AS BIGINT) AS n_transmitted_{name}", f"CAST(coalesce(sum(u) FILTER (WHERE {every}), 0) AS BIGINT) AS n_untransmitted_{name}",
                f"count(*) FILTER (WHERE kid_gt = 1 AND dad_gt = 0 AND mom_gt = 0 AND {every}) AS n_de_novos_{name}", f"CAST({ac('dad')} + {ac('mom')} AS BIGINT) AS ac_parents_{name}", f"{an('dad')} + {an('mom')} AS an_parents_{name}",
                f"CAST({ac('kid')} AS BIGINT) AS ac_children_{name}", f"{an('kid')} AS an_children_{name}"]
    return f"SELECT vid, {', '.join(out)} FROM tu GROUP BY vid"


@query(f"{WITH}, {_TRIO}, {_TU} {_trio_stats_sql()}")
def trio_stats(spark, c):
    return family.trio_stats(_trio(c, ("gt", "gq", "dp", "ad_alt")))


_TAC = "tac AS (SELECT vid, sum(gt) AS ac FROM ents WHERE sid IN (SELECT kid FROM trios UNION SELECT dad FROM trios UNION SELECT mom FROM trios) GROUP BY vid)"


@query(
    f"""{WITH}, {_TRIO}, {_TAC}, f AS (SELECT vid, fam_id, count(*) FILTER (WHERE ac = 2 AND kid_gt > 0 AND (dad_gt > 0 OR mom_gt > 0)) AS yes, count(*) FILTER (WHERE ac = 1 AND kid_gt = 0 AND (dad_gt > 0 OR mom_gt > 0)) AS no
  FROM tr JOIN tac USING (vid) WHERE vid IN (SELECT vid FROM vars WHERE consequence = 'synonymous_variant') GROUP BY ALL)
SELECT vars.vid, count(*) FILTER (WHERE yes = 1) AS variant_transmitted_singletons, count(*) FILTER (WHERE no = 1) AS variant_untransmitted_singletons FROM vars LEFT JOIN f ON f.vid = vars.vid GROUP BY vars.vid"""
)
def singleton_transmission(spark, c):
    members = c.trios.select(F.explode(F.array("kid", "dad", "mom")).alias("sid")).distinct()
    ac = c.entries.join(members, "sid", "left_semi").groupBy("vid").agg(F.sum("gt").alias("ac"))
    return family.singleton_transmission(_trio(c), c.variants, ac)


@query(
    f"""{WITH}, {_TRIO}, {_TU}, fac AS (SELECT vid FROM ents WHERE sid IN (SELECT dad FROM trios UNION SELECT mom FROM trios) AND sid NOT IN (SELECT kid FROM trios) GROUP BY vid HAVING sum(gt) = 1),
  s AS (SELECT CAST(coalesce(sum(t), 0) AS BIGINT) AS trans, CAST(coalesce(sum(u), 0) AS BIGINT) AS untrans FROM tu WHERE vid IN (SELECT vid FROM fac)) SELECT trans, untrans, CASE WHEN untrans > 0 THEN CAST(trans AS DOUBLE) / untrans ELSE -1 END AS ratio FROM s"""
)
def transmission_ratio(spark, c):
    return family.transmission_ratio(c.entries, c.trios, c.variants)


# ---- tiers and grid -----------------------------------------------------------------------------------------------------------------------
def _tier_sql() -> str:
    tags = []
    for t in tiers.TIERS:
        def one(kind, test, t=t):
            x = tiers.EXAMPLE[kind][t]
            return f"({test} AND rf_bin <= {x['bin']} AND dp >= {x['dp']} AND gq >= {x['gq']} AND ((gt = 1 AND ({_AB}) >= {x['ab']}) OR gt = 0 OR gt = 2))"
        tags.append(f"CASE WHEN {one('snp', _SNP)} OR {one('indel', f'({_INS} OR {_DEL})')} THEN 'Pass' ELSE 'Fail' END AS {t}_filters")
    return f"tg AS (SELECT vid, sid, gt, {_KIND} AS kind, {', '.join(tags)} FROM ents JOIN vars USING (vid))"


def _retag_sql() -> str:
    out = []
    for t in tiers.TIERS:
        need = f"count(*) FILTER (WHERE {t}_filters = 'Pass') OVER (PARTITION BY vid) > 25 * CASE kind WHEN 'snv' THEN {tiers.EXAMPLE['snp'][t]['call_rate']} WHEN 'indel' THEN {tiers.EXAMPLE['indel'][t]['call_rate']} END"
        out.append(f"CASE WHEN {need} THEN {t}_filters ELSE 'Fail' END AS {t}_filters")
    return f"rt AS (SELECT vid, sid, gt, kind, {', '.join(out)} FROM tg)"


_TIER_COLS = [f"{t}_filters" for t in tiers.TIERS]


@query(f"{WITH}, {_tier_sql()} SELECT vid, sid, {', '.join(_TIER_COLS)} FROM tg")
def tier_filters(spark, c):
    return tiers.tag(c.entries, c.variants).select("vid", "sid", *_TIER_COLS)


@query(f"{WITH}, {_tier_sql()}, {_retag_sql()} SELECT vid, sid, {', '.join(_TIER_COLS)} FROM rt")
def missingness_retag(spark, c):
    return tiers.retag(tiers.tag(c.entries, c.variants), _n(c)).select("vid", "sid", *_TIER_COLS)


def _tier_ac_sql() -> str:
    out = []
    for t in tiers.TIERS:
        ok = f"FILTER (WHERE {t}_filters = 'Pass')"
        ac, hom = f"CAST(coalesce(sum(gt) {ok}, 0) AS BIGINT)", f"count(*) FILTER (WHERE {t}_filters = 'Pass' AND gt = 2)"
        out += [f"count(*) {ok} AS {t}_pass_count", f"CAST(count(*) {ok} AS DOUBLE) / 25 AS fraction_pass_{t}_filters", f"2 * count(gt) {ok} AS {t}_AN", f"{ac} AS {t}_AC", f"2 * {hom} AS {t}_AC_Hom", f"{ac} - 2 * {hom} AS {t}_AC_Het"]
    return f"ta AS (SELECT vid, {', '.join(out)} FROM rt GROUP BY vid)"


@query(f"{WITH}, {_tier_sql()}, {_retag_sql()}, {_tier_ac_sql()} SELECT * FROM ta")
def tier_ac(spark, c):
    n = _n(c)
    return tiers.annotate(tiers.retag(tiers.tag(c.entries, c.variants), n), n)


@query(
    f"""{WITH}, {_tier_sql()}, {_retag_sql()}, {_tier_ac_sql()}, ex AS (SELECT tier, unnest(string_split(consequence, '&')) AS term FROM (
  SELECT 'unfiltered' AS tier, consequence FROM vars UNION ALL """
    + " UNION ALL ".join(f"SELECT '{t}', consequence FROM vars JOIN ta USING (vid) WHERE {t}_pass_count > 0" for t in tiers.TIERS)
    + f""")), cn AS (SELECT tier, term, count(*) AS n FROM ex WHERE term IN ({', '.join(repr(x) for x in A.CODING + A.NON_CODING)}) GROUP BY ALL)
SELECT * FROM cn UNION ALL SELECT tier, CASE WHEN term IN ({', '.join(repr(x) for x in A.CODING)}) THEN 'total_coding' ELSE 'total_noncoding' END, CAST(sum(n) AS BIGINT) FROM cn GROUP BY 1, 2"""
)
def consequence_by_tier(spark, c):
    n = _n(c)
    ac = tiers.annotate(tiers.retag(tiers.tag(c.entries, c.variants), n), n)
    return A.consequence_by_tier(joins.annotate(c.variants.select("vid", "consequence"), ac, ["vid"], [f"{t}_pass_count" for t in tiers.TIERS]))


_GRID_SQL = """g AS (SELECT *, CAST(row_number() OVER (ORDER BY bin, pdp, pgq, pab, pcr) AS INTEGER) AS pid, printf('bin_%03d_DP_%02d_GQ_%02d_AB_%.2f_missing_%.2f', bin, pdp, pgq, pab, pcr) AS point FROM
  (SELECT unnest([20, 30, 40, 50, 60, 70, 80, 90]) AS bin), (SELECT unnest([40, 70]) AS pdp), (SELECT unnest([50, 60]) AS pgq), (SELECT unnest([0.2::DOUBLE, 0.4::DOUBLE]) AS pab), (SELECT unnest([0.1::DOUBLE, 0.3::DOUBLE]) AS pcr))"""
_PASSES = f"NOT ((gt = 1 AND ({_AB}) < pab) OR dp < pdp OR gq < pgq)"
_KEPT = f"""{_GRID_SQL}, ev AS (SELECT e.*, rf_bin FROM ents e JOIN vars USING (vid)), kp AS (SELECT point, vid FROM ev JOIN g ON rf_bin <= bin AND {_PASSES} GROUP BY point, vid, pcr HAVING CAST(count(*) AS DOUBLE) / 25 > pcr AND sum(gt) > 0)"""


def _grid(spark, c: Cohort) -> tuple[DataFrame, DataFrame]:
    from cohortqc.session import materialize

    g = grid.points(spark, **GRID)
    return g, materialize(grid.surviving(c.entries, c.variants, g, _n(c)))


@query(f"{WITH}, {_KEPT} SELECT g.point, count(kp.vid) AS n_variants, count(*) FILTER (WHERE tp AND kp.vid IS NOT NULL) AS tp, count(*) FILTER (WHERE fp AND kp.vid IS NOT NULL) AS fp FROM g LEFT JOIN kp ON kp.point = g.point LEFT JOIN vars ON vars.vid = kp.vid GROUP BY g.point")
def hard_filter_grid(spark, c):
    g, kept = _grid(spark, c)
    return grid.tp_fp(kept, c.variants, g)


@query(
    f"""{WITH}, {_KEPT}, pe AS (SELECT point, vid, sid, gt FROM ents JOIN g ON {_PASSES} WHERE sid <= 23), tr AS (
  SELECT k.point, k.vid, t.kid, k.gt AS kid_gt, d.gt AS dad_gt, m.gt AS mom_gt, t.is_female, lc.hap FROM trios t JOIN pe k ON k.sid = t.kid JOIN (SELECT vid, {_LOCUS} AS hap FROM vars) lc ON lc.vid = k.vid LEFT JOIN pe d ON d.point = k.point AND d.vid = k.vid AND d.sid = t.dad
  LEFT JOIN pe m ON m.point = k.point AND m.vid = k.vid AND m.sid = t.mom),
  er AS (SELECT tr.point, kid, count(*) AS errors FROM tr JOIN kp ON kp.point = tr.point AND kp.vid = tr.vid WHERE ({_CODE}) IS NOT NULL GROUP BY ALL), nv AS (SELECT point, count(*) AS n FROM kp GROUP BY point),
  rt AS (SELECT g.point, CAST(coalesce(er.errors, 0) AS DOUBLE) / nullif(nv.n, 0) AS r FROM g CROSS JOIN trios t LEFT JOIN er ON er.point = g.point AND er.kid = t.kid LEFT JOIN nv ON nv.point = g.point)
  SELECT point, round(avg(r), 9) AS mendelian_error_mean, round(stddev_pop(r), 9) AS mendelian_error_std FROM rt GROUP BY point"""
)
def grid_mendel(spark, c):
    g, kept = _grid(spark, c)
    m = grid.mendel(c.entries, c.trios, kept, g, c.variants)
    return m.select("point", F.round("mendelian_error_mean", 9).alias("mendelian_error_mean"), F.round("mendelian_error_std", 9).alias("mendelian_error_std"))


@query(
    f"""{WITH}, {_KEPT.replace('point, vid', 'pid, vid')}, fe AS (SELECT vid, sid, gt, dp, gq, ad_alt FROM ents WHERE sid <= 23 AND vid IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY')),
  pe AS (SELECT g.pid, fe.vid, sid, gt FROM fe JOIN g ON {_PASSES} SEMI JOIN kp ON kp.pid = g.pid AND kp.vid = fe.vid),
  tr AS (SELECT pid, vid, sid // 3 AS fam, max(gt) FILTER (WHERE sid % 3 = 0) AS kid_gt, max(gt) FILTER (WHERE sid % 3 = 1) AS dad_gt, max(gt) FILTER (WHERE sid % 3 = 2) AS mom_gt,
    sum(gt) FILTER (WHERE sid % 3 <> 0) AS parents FROM pe GROUP BY ALL), sg AS (SELECT pid, vid FROM tr GROUP BY ALL HAVING sum(parents) = 1),
  {_TU.replace("FROM tr)", "FROM tr SEMI JOIN sg ON sg.pid = tr.pid AND sg.vid = tr.vid)")}, s AS (SELECT pid, coalesce(sum(t), 0) AS t, coalesce(sum(u), 0) AS u FROM tu GROUP BY pid)
  SELECT g.point, CASE WHEN u > 0 THEN CAST(t AS DOUBLE) / u ELSE -1 END AS t_u_ratio FROM g LEFT JOIN s ON s.pid = g.pid"""
)
def grid_transmission(spark, c):
    g, kept = _grid(spark, c)
    return grid.transmission(c.entries, c.trios, c.variants, kept, g)


@query(f"""{WITH}, {_KEPT}, ct AS (SELECT vid FROM vars WHERE tp), ts AS (SELECT g.point, e.vid FROM ents e JOIN g ON {_PASSES} JOIN kp ON kp.point = g.point AND kp.vid = e.vid WHERE sid = 3 AND gt > 0),
  n AS (SELECT point, count(*) AS test, count(*) FILTER (WHERE vid IN (SELECT vid FROM ct)) AS tp FROM ts GROUP BY point)
  SELECT g.point, coalesce(CAST(tp AS DOUBLE) / nullif(test, 0), -1) AS prec, CAST(coalesce(tp, 0) AS DOUBLE) / (SELECT count(*) FROM ct) AS recall FROM g LEFT JOIN n ON n.point = g.point""")
def grid_precision_recall(spark, c):
    g, kept = _grid(spark, c)
    return grid.grid_precision_recall(c.entries, kept, c.variants.where("tp").select("vid"), 3, g)


@query(f"""{WITH}, {_KEPT}, r AS (SELECT g.point, count(*) FILTER (WHERE tp AND kp.vid IS NOT NULL) AS tp, count(*) FILTER (WHERE fp AND kp.vid IS NOT NULL) AS fp FROM g LEFT JOIN kp ON kp.point = g.point LEFT JOIN vars ON vars.vid = kp.vid GROUP BY g.point)
  SELECT point, bin, pdp AS "DP", pgq AS "GQ", pab AS "AB", pcr AS call_rate, 100.0 * r.tp / (SELECT count(*) FROM vars WHERE tp) AS "TP_percent", 100.0 * r.fp / (SELECT count(*) FROM vars WHERE fp) AS "FP_percent" FROM r JOIN g USING (point)""")
def grid_metrics(spark, c):
    g, kept = _grid(spark, c)
    m = grid.filter_metrics(grid.tp_fp(kept, c.variants, g), c.variants)
    return m.select("point", "bin", "DP", "GQ", "AB", "call_rate", "TP_percent", "FP_percent")


@query(f"""{WITH}, ct AS (SELECT vid, {_KIND} AS kind, consequence, tp AS c, vid % 4 = 0 AS t FROM vars WHERE tp OR vid % 4 = 0), s AS (SELECT 'all' AS subset, c, t FROM ct UNION ALL SELECT 'frameshift', c, t FROM ct WHERE consequence = 'frameshift_variant'
  UNION ALL SELECT 'inframe', c, t FROM ct WHERE consequence IN ('inframe_deletion', 'inframe_insertion')), n AS (SELECT subset, count(*) FILTER (WHERE c AND t) AS tp, count(*) FILTER (WHERE t AND NOT c) AS fp, count(*) FILTER (WHERE c AND NOT t) AS fn FROM s GROUP BY subset)
  SELECT subset, tp, fp, fn, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), -1) AS "precision", coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), -1) AS recall FROM n""")
def precision_recall(spark, c):
    subsets = {"frameshift": F.col("consequence") == "frameshift_variant", "inframe": F.col("consequence").isin("inframe_deletion", "inframe_insertion")}
    return grid.precision_recall(c.variants.where("tp"), c.variants.where("vid % 4 = 0"), ["vid"], subsets)



# ---- calls as text and with likelihoods ------------------------------------------------------------------------------------
@query(
    f"""{WITH}, cells AS (SELECT v.vid, string_agg(coalesce(CASE gt WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' WHEN 2 THEN '1/1' END || ':' || dp || ':' || gq, './.:.:.'), chr(9) ORDER BY s.sid) AS calls
  FROM (SELECT vid FROM vars) v CROSS JOIN (SELECT sid FROM smp) s LEFT JOIN ents e ON e.vid = v.vid AND e.sid = s.sid GROUP BY v.vid)
SELECT vid, contig || chr(9) || pos || chr(9) || '.' || chr(9) || ref || chr(9) || alt || chr(9) || '.' || chr(9) || '.' || chr(9) || 'rf_bin=' || rf_bin || CASE WHEN tp THEN ';tp' ELSE '' END || chr(9) || 'GT:DP:GQ' || chr(9) || calls AS line FROM vars JOIN cells USING (vid)"""
)
def vcf_export_lines(spark, c):
    from cohortqc.sources.vcf import vcf_lines

    sites = c.variants.select("vid", "contig", "pos", F.array("ref", "alt").alias("alleles"), "rf_bin", "tp")
    call = F.struct((F.col("gt") == 2).cast("int").alias("a0"), (F.col("gt") > 0).cast("int").alias("a1"), F.lit(False).alias("phased"))
    entries = c.entries.join(sites.select("vid", "contig", "pos", "alleles"), "vid").select("contig", "pos", "alleles", F.col("sid").cast("string").alias("s"), call.alias("gt"), "dp", "gq")
    lines = vcf_lines(sites, entries, [str(k) for k in range(25)], ["rf_bin", "tp"], ["gt", "dp", "gq"])
    return lines.join(sites.select("vid", "contig", "pos", "alleles"), ["contig", "pos", "alleles"]).select("vid", "line")


_PL = "CASE gt WHEN 0 THEN [0, gq, 2 * gq] WHEN 1 THEN [gq, 0, gq] ELSE [2 * gq, gq, 0] END"
_POST = lambda r, k: f"(power(10.0::DOUBLE, -{r}_pl[{k + 1}] / 10.0::DOUBLE) / (power(10.0::DOUBLE, -{r}_pl[1] / 10.0::DOUBLE) + power(10.0::DOUBLE, -{r}_pl[2] / 10.0::DOUBLE) + power(10.0::DOUBLE, -{r}_pl[3] / 10.0::DOUBLE)))"


@query(
    f"""{WITH}, {_VC}, pe AS (SELECT vid, sid, gt, gq, dp, ad_alt, {_PL} AS pl FROM ents), q AS (
  SELECT k.vid, t.kid, CAST(k.ad_alt AS DOUBLE) / k.dp AS kid_ab, CAST(k.dp AS DOUBLE) / (d.dp + m.dp) AS dp_ratio, ac, k.dp AS kid_dp, k.pl AS kid_pl, d.pl AS dad_pl, m.pl AS mom_pl, {_SNP} AS is_snv,
    greatest(CAST(ac - 1 AS DOUBLE) / (an - 1), CAST(freq_ac AS DOUBLE) / 1000, 100 / 3e7) AS prior
  FROM trios t JOIN pe k ON k.sid = t.kid AND k.gt = 1 JOIN pe d ON d.vid = k.vid AND d.sid = t.dad AND d.gt = 0 JOIN pe m ON m.vid = k.vid AND m.sid = t.mom AND m.gt = 0 JOIN vars ON vars.vid = k.vid JOIN vc ON vc.vid = k.vid
  WHERE k.gq >= 20 AND CAST(d.ad_alt AS DOUBLE) / d.dp <= 0.2 AND CAST(m.ad_alt AS DOUBLE) / m.dp <= 0.2),
  r AS (SELECT *, {_POST('dad', 0)} * {_POST('mom', 0)} * {_POST('kid', 1)} / 3e7 AS n, ({_POST('dad', 1)} * {_POST('mom', 0)} + {_POST('dad', 0)} * {_POST('mom', 1)}) * {_POST('kid', 1)} * (1 - power(1 - prior, 4)) AS x FROM q WHERE kid_ab >= 0.2 AND dp_ratio >= 0.1),
  f AS (SELECT *, n / (n + x) AS p FROM r) SELECT vid, kid, round(p, 9) AS p_de_novo,
  CASE WHEN CASE WHEN is_snv THEN (p > 0.99 AND kid_ab > 0.3 AND dp_ratio > 0.2) OR (p > 0.99 AND kid_ab > 0.3 AND ac = 1) OR (p > 0.5 AND kid_ab > 0.3 AND ac = 1 AND kid_dp > 10) ELSE p > 0.99 AND kid_ab > 0.3 AND ac = 1 END THEN 'HIGH'
    WHEN p > 0.5 AND kid_ab > 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM f WHERE p >= 1e-9"""
)
def de_novo(spark, c):
    """Likelihoods are made from the calls and their quality; the limits are wide, as the made-up reads are noisy."""
    g = F.col("gq")
    pl = F.when(F.col("gt") == 0, F.array(F.lit(0), g, 2 * g)).when(F.col("gt") == 1, F.array(g, F.lit(0), g)).otherwise(F.array(2 * g, g, F.lit(0)))
    trio = joins.trio_entries(c.entries.withColumn("pl", pl).withColumn("ad", F.array("ad_ref", "ad_alt")), c.trios, ("gt", "gq", "pl", "ad"))
    sites = A.variant_counts(c.entries, 25).select("vid", "ac", "an").join(c.variants.select("vid", (F.col("freq_ac").cast("double") / 1000).alias("pop_af"), G.is_snp().alias("is_snv")), "vid")
    found = family.de_novo(trio, sites, min_p=1e-9, max_parent_ab=0.2)
    return found.select("vid", "kid", F.round("p_de_novo", 9).alias("p_de_novo"), "confidence")


@query(f"{WITH} SELECT bin, count(*) AS n, count(*) FILTER (WHERE tp) AS n_tp, min(score) AS min_score, max(score) AS max_score FROM (SELECT *, rf_bin AS bin FROM vars) GROUP BY bin")
def bin_summary(spark, c):
    return c.variants.groupBy(F.col("rf_bin").alias("bin")).agg(F.count("*").alias("n"), F.count_if("tp").alias("n_tp"), F.min("score").alias("min_score"), F.max("score").alias("max_score"))


# ---- tables behind plots, comparisons and features ---------------------------------------------------------------------------
_RANGES = {"qd": (0.0, 25.0), "fs": (0.0, 60.0), "mq": (20.0, 80.0)}


@query(f"{WITH} " + " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST(least(50, floor(({m} - {lo}::DOUBLE) * 50 / {hi - lo}::DOUBLE) + 1) AS INTEGER) AS bin, count(*) AS n FROM vars WHERE {m} BETWEEN {lo} AND {hi} GROUP BY 2" for m, (lo, hi) in _RANGES.items()))
def variant_histograms(spark, c):
    return plotdata.variant_histograms(c.variants, _RANGES)


@query(f"""{WITH}, {_MAD}, b AS (SELECT pop, metric, median - 4 * mad AS lower, median + 4 * mad AS upper FROM bounds), sp AS (SELECT pop, metric, min(value) AS lo, max(value) AS hi FROM long WHERE value IS NOT NULL GROUP BY ALL),
  k AS (SELECT pop, metric, value, lower, upper, CAST(least(30, floor(coalesce((value - lo) * 30 / nullif(hi - lo, 0), 0)) + 1) AS INTEGER) AS bin FROM long JOIN sp USING (pop, metric) JOIN b USING (pop, metric) WHERE value IS NOT NULL)
  SELECT pop, metric, bin, count(*) AS n, CAST(sum(count(*) FILTER (WHERE value < lower)) OVER w AS BIGINT) AS below, CAST(sum(count(*) FILTER (WHERE value > upper)) OVER w AS BIGINT) AS above FROM k GROUP BY pop, metric, bin WINDOW w AS (PARTITION BY pop, metric)""")
def stratified_histograms(spark, c):
    wide = _stratified(c).select("pop", *[F.col(m).cast("double").alias(m) for m in METRICS])
    return plotdata.stratified_histograms(wide, "pop", METRICS, A.mad_bounds(wide, "pop", METRICS)).drop("lower", "upper")


SQL["kinship_histogram"] = ("SELECT CAST(least(50, floor((kin + 0.5::DOUBLE) * 50 / 1.0::DOUBLE) + 1) AS INTEGER) AS bin, count(*) AS n FROM relatedness_ht WHERE kin BETWEEN -0.5 AND 0.5 AND NOT isnan(kin) GROUP BY 1")
QUERIES["kinship_histogram"] = lambda spark, sf: plotdata.kinship_histogram(read_table(spark, sf, "relatedness_ht"))


@query(f"{WITH} SELECT sid, s, pop, call_rate FROM smp LEFT JOIN (SELECT sid, CAST(count(gt) AS DOUBLE) / (SELECT count(*) FROM vars) AS call_rate FROM ents GROUP BY sid) USING (sid)")
def sample_lookup(spark, c):
    return joins.annotate(c.samples, A.sample_call_rate(c.entries, c.variants.count()), ["sid"], ["call_rate"])


@query(f"{WITH}, o AS (SELECT vid, sid, gt, CAST(gq + CASE WHEN vid % 7 = 0 THEN 1 ELSE 0 END AS INTEGER) AS gq FROM ents WHERE NOT (vid % 11 = 0 AND sid = 3)), b AS (SELECT e.vid, e.sid, e.gt AS gt1, e.gq AS gq1, o.gt AS gt2, o.gq AS gq2 FROM ents e LEFT JOIN o ON o.vid = e.vid AND o.sid = e.sid)"
  " SELECT vid, sid, 'gq' AS \"column\", CAST(gq1 AS VARCHAR) AS \"left\", CAST(gq2 AS VARCHAR) AS \"right\" FROM b WHERE gq1 IS DISTINCT FROM gq2 UNION ALL SELECT vid, sid, 'gt', CAST(gt1 AS VARCHAR), CAST(gt2 AS VARCHAR) FROM b WHERE gt1 IS DISTINCT FROM gt2")
def entry_differences(spark, c):
    """The cohort against a copy with changed and missing cells."""
    other = c.entries.where("not (vid % 11 = 0 and sid = 3)").withColumn("gq", (F.col("gq") + F.when(F.col("vid") % 7 == 0, 1).otherwise(0)).cast("int"))
    return joins.differences(c.entries, other, ["vid", "sid"], ["gt", "gq"])


@query(
    f"""{WITH}, {_VC}, {_TRIO}, {_TU}, st AS (SELECT vid, CAST(coalesce(sum(t), 0) AS BIGINT) AS n_transmitted_raw FROM tu GROUP BY vid),
f AS (SELECT v.vid, {_KIND} AS kind, CASE WHEN qd >= 3 THEN qd END AS qd, fs, mq, tp, fp, tp OR vid % 7 = 0 AS truth, coalesce(qd < 2 OR fs > 60 OR mq < 30, false) AS hard, coalesce(n_transmitted_raw = 1 AND ac = 2, false) AS single FROM vars v LEFT JOIN vc USING (vid) LEFT JOIN st USING (vid)),
m AS (SELECT kind, median(qd) AS qd FROM f GROUP BY kind) SELECT f.vid, f.kind, coalesce(f.qd, m.qd) AS qd, f.qd IS NULL AS qd_imputed, f.fs, truth AS tp, coalesce(CASE WHEN f.qd IS NULL THEN fs > 60 OR mq < 30 OR NULL ELSE hard END, false) AS fp, single AS transmitted_singleton FROM f JOIN m ON m.kind = f.kind"""
)
def forest_features(spark, c):
    """Features from side tables, labels and filled gaps."""
    from cohortqc.plans.steps import forest_features as step

    v = c.variants.select("vid", G.allele_class().alias("kind"), F.when(F.col("qd") >= 3, F.col("qd")).alias("qd"), "fs", "mq")
    t, _ = family.transmissions()
    tables = {
        "stats": A.variant_counts(c.entries, 25).select("vid", F.col("ac").alias("ac_raw")),
        "trios": _trio(c).groupBy("vid").agg(F.coalesce(F.sum(t), F.lit(0)).alias("n_transmitted_raw")),
        "truth": c.variants.select("vid", F.col("tp").alias("omni"), (F.col("vid") % 7 == 0).alias("mills"), F.lit(False).alias("kgp_phase1_hc"), F.lit(False).alias("hapmap")),
    }
    return step(v, tables, ["qd"], "kind").select("vid", "kind", "qd", "qd_imputed", "fs", "tp", "fp", "transmitted_singleton")
