"""Queries of the statistical kernels. Their SQL gives the same rows, or quantities that do not depend on the signs and
rotations of components; forests have none but for the choice of their training rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.functions import genetics as G
from cohortqc.functions.ids import norm_id
from cohortqc.operators import aggregates as A
from cohortqc.operators import filters, model, structure
from cohortqc.plans.cohort_queries import _AUTO, _HWE, _LOCUS, _SNP, _VC
from cohortqc.plans.testcohort import WITH, load
from cohortqc.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_FEATURES = ("kind", "qd", "fs", "mq")


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _greedy(nodes: str, edges: str) -> str:
    """The greedy independent set. ``nodes``: (node, k), k = 1, 2, ... by priority; ``edges``: (a, b) in either order."""
    return f"""ord AS ({nodes}), ed AS ({edges}),
adj AS (SELECT o.k, list(p.k) FILTER (WHERE p.k IS NOT NULL) AS earlier FROM ord o LEFT JOIN (SELECT a, b FROM ed UNION SELECT b, a FROM ed) e ON e.a = o.node LEFT JOIN ord p ON p.node = e.b AND p.k < o.k GROUP BY o.k),
st AS (SELECT 0 AS k, CAST([] AS BIGINT[]) AS kept, false AS own UNION ALL
  SELECT adj.k, CASE WHEN list_has_any(kept, coalesce(earlier, [])) THEN kept ELSE list_append(kept, adj.k) END, NOT list_has_any(kept, coalesce(earlier, [])) FROM st JOIN adj ON adj.k = st.k + 1)"""


# ---- sex ---------------------------------------------------------------------------------------------------------------
_SEX = f"""x AS (SELECT e.vid, e.sid, e.gt FROM ents e JOIN vars v ON v.vid = e.vid WHERE ({_LOCUS}) = 'X' AND gt IS NOT NULL), site AS (SELECT vid, CAST(sum(gt) AS DOUBLE) / (2 * count(*)) AS p, 2 * count(*) AS an FROM x GROUP BY vid),
xe AS (SELECT vid, 1 - 2 * p * (1 - p) * an / (an - 1) AS e FROM site WHERE p > 0.05 AND p < 0.95),
per AS (SELECT sid, count(*) AS n_called, count(*) FILTER (WHERE gt <> 1) AS observed_homs, sum(e) AS expected_homs FROM x JOIN xe USING (vid) GROUP BY sid), fs AS (SELECT *, (observed_homs - expected_homs) / nullif(n_called - expected_homs, 0) AS f FROM per)"""


@query(f"""{WITH}, {_SEX} SELECT sid, n_called, observed_homs, round(expected_homs, 8) AS expected_homs, round(f, 8) AS f_stat, CASE WHEN f < 0.4 THEN true WHEN f > 0.8 THEN false END AS is_female,
  CASE WHEN f < 0.4 THEN 'female' WHEN f > 0.8 THEN 'male' ELSE 'undefined' END AS imputed_sex FROM fs""")
def impute_sex_f(spark, sf):
    c = load(spark, sf)
    return structure.impute_sex(c.entries, c.variants).withColumns({x: F.round(x, 8) for x in ("expected_homs", "f_stat")})


@query(f"""{WITH}, {_SEX} SELECT fs.sid, CASE WHEN fs.sid % 2 = 0 THEN ' Male' ELSE 'FEMALE' END AS self_reported_sex FROM fs WHERE (f < 0.4 AND fs.sid % 2 = 0) OR (f > 0.8 AND fs.sid % 2 = 1)""")
def sex_conflicts(spark, sf):
    c = load(spark, sf)
    told = c.samples.select("sid", F.when(F.col("sid") % 2 == 0, " Male").otherwise("FEMALE").alias("self_reported_sex"))
    return filters.sex_conflicts(structure.impute_sex(c.entries, c.variants).join(told, "sid")).select("sid", "self_reported_sex")


@query(f"{WITH}, {_SEX} SELECT sid FROM fs WHERE f > 0.2 AND f < 0.9")
def sex_outliers(spark, sf):
    c = load(spark, sf)
    return filters.sex_outliers(structure.impute_sex(c.entries, c.variants), 0.2, 0.9).select("sid")


# ---- linkage and relatedness -----------------------------------------------------------------------------------------------
_LD = f"""g AS (SELECT e.vid, sid, CAST(gt AS BIGINT) AS gt, contig, pos FROM ents e JOIN vars v ON v.vid = e.vid WHERE {_AUTO} AND {_SNP} AND gt IS NOT NULL),
sums AS (SELECT a.vid AS a, b.vid AS b, count(*) AS n, sum(a.gt) AS sx, sum(b.gt) AS sy, sum(a.gt * b.gt) AS sxy, sum(a.gt * a.gt) AS sxx, sum(b.gt * b.gt) AS syy
  FROM g a JOIN g b ON a.contig = b.contig AND a.sid = b.sid AND (a.pos < b.pos OR (a.pos = b.pos AND a.vid < b.vid)) AND b.pos - a.pos <= 1000000 GROUP BY a.vid, b.vid),
ld AS (SELECT a, b, CAST((n * sxy - sx * sy) * (n * sxy - sx * sy) AS DOUBLE) / nullif(CAST((n * sxx - sx * sx) * (n * syy - sy * sy) AS DOUBLE), 0) AS r2 FROM sums)"""
_LD_SET = _greedy("SELECT vid AS node, row_number() OVER (ORDER BY -least(p, 1 - p), md5(CAST(vid AS VARCHAR)), vid) AS k FROM (SELECT vid, CAST(sum(gt) AS DOUBLE) / (2 * count(*)) AS p FROM ents WHERE gt IS NOT NULL AND vid IN (SELECT vid FROM g) GROUP BY vid)", "SELECT a, b FROM ld WHERE r2 > 0.2")


@query(f"{WITH.replace('WITH', 'WITH RECURSIVE', 1)}, {_LD}, {_LD_SET} SELECT vid, contig, pos FROM st JOIN ord ON ord.k = st.k JOIN vars ON vars.vid = ord.node WHERE own")
def ld_prune(spark, sf):
    c = load(spark, sf)
    return structure.ld_prune(c.entries, filters.autosomal_snvs(c.variants)).select("vid", "contig", "pos")


@query(f"{WITH}, {_LD} SELECT a, b, round(r2, 9) AS r2 FROM ld WHERE r2 > 0.2")
def ld_correlated(spark, sf):
    c = load(spark, sf)
    return structure.ld_pairs(c.entries, filters.autosomal_snvs(c.variants)).withColumn("r2", F.round("r2", 9))


_KIN = _greedy(
    "SELECT a AS node, row_number() OVER (ORDER BY count(*), md5(a), a) AS k FROM (SELECT a, b FROM lk UNION SELECT b, a FROM lk) GROUP BY a",
    "SELECT a, b FROM lk",
)


@query(f"""WITH RECURSIVE lk AS (SELECT DISTINCT upper(trim(i, ' ')) AS a, upper(trim(j, ' ')) AS b FROM relatedness_ht WHERE kin > 0.125 AND NOT isnan(kin) AND upper(trim(i, ' ')) <> upper(trim(j, ' '))), {_KIN}
SELECT node AS s, own AS kept FROM st JOIN ord ON ord.k = st.k""")
def independent_set(spark, sf):
    r = read_table(spark, sf, "relatedness_ht").select(norm_id("i").alias("i"), norm_id("j").alias("j"), "kin")
    return structure.unrelated_samples(r)


# ---- components --------------------------------------------------------------------------------------------------------------
_Z = """fq AS (SELECT vid, CAST(sum(gt) AS DOUBLE) / (2 * count(*)) AS p, min(gt) < max(gt) AS varies FROM ents WHERE gt IS NOT NULL GROUP BY vid),
z AS (SELECT e.vid, e.sid, (gt - 2 * p) / sqrt(2 * p * (1 - p)) AS z FROM ents e JOIN fq ON fq.vid = e.vid WHERE gt IS NOT NULL AND p > 0 AND p < 1),
gram AS (SELECT s.sid AS i, t.sid AS j, coalesce(sum(a.z * b.z), 0) AS g FROM smp s CROSS JOIN smp t LEFT JOIN z a ON a.sid = s.sid LEFT JOIN z b ON b.sid = t.sid AND b.vid = a.vid GROUP BY ALL)"""


def _products(scores: DataFrame) -> DataFrame:
    """(i, j, g): the products of all samples' scores, which no sign and no rotation of the components changes."""
    one, two = scores.select(F.col("sid").alias("i"), F.col("scores").alias("a")), scores.select(F.col("sid").alias("j"), F.col("scores").alias("b"))
    dot = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return one.join(F.broadcast(two)).select("i", "j", (F.round(dot, 6) + F.lit(0.0)).alias("g"))  # 25 samples


@query(f"{WITH}, {_Z} SELECT i, j, round(g / (SELECT count(*) FROM fq WHERE varies), 6) + 0.0 AS g FROM gram")
def pca_gram(spark, sf):
    c = load(spark, sf)
    return _products(structure.pca(c.entries, 25)[0])


@query(f"{WITH}, {_Z} SELECT i, j, round(g / (SELECT count(*) FROM fq WHERE p > 0 AND p < 1), 6) + 0.0 AS g FROM gram")
def pc_projection_gram(spark, sf):
    """Samples projected onto their own loadings come to lie where they were."""
    c = load(spark, sf)
    return _products(structure.pc_project(c.entries, structure.pca(c.entries, 25)[2]))


@query()
def pca_scores(spark, sf):
    c = load(spark, sf)
    return structure.pca(c.entries, 4)[0]


@query()
def pc_projection(spark, sf):
    c = load(spark, sf)
    return structure.pc_project(c.entries, structure.pca(c.entries, 4)[2])


@query()
def pc_relate(spark, sf):
    c = load(spark, sf)
    return structure.pc_relate(c.entries, structure.pca(c.entries, 4)[0])


@query(
    f"""{WITH}, fq AS (SELECT vid, CAST(sum(gt) AS DOUBLE) / (2 * count(*)) AS p FROM ents WHERE gt IS NOT NULL GROUP BY vid), e AS (SELECT e.vid, e.sid, gt, p FROM ents e JOIN fq ON fq.vid = e.vid WHERE gt IS NOT NULL AND least(p, 1 - p) >= 0.05),
kn AS (SELECT a.sid AS i, b.sid AS j, sum((a.gt - 2 * a.p) * (b.gt - 2 * b.p)) / (4 * sum(a.p * (1 - a.p))) AS kin FROM e a JOIN e b ON a.vid = b.vid GROUP BY ALL), f AS (SELECT i AS sid, 2 * kin - 1 AS f FROM kn WHERE i = j),
d AS (SELECT e.vid, e.sid, p * (1 - p) AS v, CASE gt WHEN 0 THEN p WHEN 1 THEN 0 ELSE 1 - p END - p * (1 - p) * (1 + f) AS d FROM e JOIN f ON f.sid = e.sid),
ib AS (SELECT a.sid AS i, b.sid AS j, sum(a.d * b.d) / sum(a.v * b.v) AS ibd2 FROM d a JOIN d b ON a.vid = b.vid AND a.sid < b.sid GROUP BY ALL)
SELECT kn.i, kn.j, round(kin, 8) AS kin, round(ibd2, 8) AS ibd2 FROM kn JOIN ib ON ib.i = kn.i AND ib.j = kn.j WHERE kin >= -0.02"""
)
def pc_relate_one_ancestry(spark, sf):
    """Without components all samples have the cohort's frequencies. The made-up samples are unrelated, hence the low limit."""
    c = load(spark, sf)
    none = c.samples.select("sid", F.array().cast("array<double>").alias("scores"))
    return structure.pc_relate(c.entries, none, -0.02).withColumns({x: F.round(x, 8) for x in ("kin", "ibd2")})


# ---- forests -------------------------------------------------------------------------------------------------------------------
@query()
def population_rf(spark, sf):
    c = load(spark, sf)
    scores = structure.pca(c.entries, 4)[0]
    known = c.samples.select("sid", F.when(F.col("sid") % 5 != 0, F.col("pop")).alias("known_pop"))
    return model.assign_populations(scores.withColumn("sid", F.col("sid").cast("int")).join(known, "sid"))


@query()
def rf_scores(spark, sf):
    c = load(spark, sf)
    v = model.training_rows(c.variants.withColumn("kind", G.allele_class()))
    fitted = model.train(v, _FEATURES, ["kind"])
    return model.apply(fitted, v, _FEATURES, ["kind"]).select("vid", "rf_label", "rf_train", "rf_prediction", "score")


_ROWS = f"""{WITH}, lb AS (SELECT vid, contig, CASE WHEN tp AND NOT fp THEN 'TP' WHEN fp AND NOT tp THEN 'FP' END AS rf_label, CAST(('0x' || substr(md5(vid || ':42'), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS luck FROM vars),
nn AS (SELECT count(*) FILTER (WHERE rf_label = 'TP') AS n_tp, count(*) FILTER (WHERE rf_label = 'FP') AS n_fp FROM lb WHERE contig <> 'chr20'),
tr AS (SELECT vid, rf_label, coalesce(contig <> 'chr20' AND luck < CASE rf_label WHEN 'TP' THEN least(1.0::DOUBLE, n_fp::DOUBLE / n_tp) WHEN 'FP' THEN least(1.0::DOUBLE, n_tp::DOUBLE / n_fp) END, false) AS rf_train FROM lb, nn)"""


@query(f"{_ROWS} SELECT * FROM tr")
def rf_training_rows(spark, sf):
    return model.training_rows(load(spark, sf).variants).select("vid", "rf_label", "rf_train")


@query(f"{_ROWS} SELECT tp, fp, rf_train, tr.rf_label, count(*) AS n FROM tr JOIN vars USING (vid) GROUP BY ALL")
def rf_label_counts(spark, sf):
    return model.label_counts(model.training_rows(load(spark, sf).variants))


@query(f"{WITH}, {_VC}, {_HWE} SELECT vid, af, call_rate, round(p_hwe, 9) AS p_hwe FROM vc JOIN hwe USING (n_hom_ref, n_het, n_hom_var) WHERE call_rate >= 0.5 AND af >= 0.05 AND p_hwe >= 1e-5")
def variant_hwe_filter(spark, sf):
    c = load(spark, sf)
    return filters.quality_variants(A.variant_qc(c.entries, c.samples.count()), 0.5, 0.05, 1e-5).select("vid", "af", "call_rate", F.round("p_hwe", 9).alias("p_hwe"))


@query("SELECT count(*) FILTER (WHERE isfinite(qd)) AS n, count(*) FILTER (WHERE qd IS NULL OR NOT isfinite(qd)) AS n_missing, round(avg(qd) FILTER (WHERE isfinite(qd)), 9) AS mean, round(stddev_pop(qd) FILTER (WHERE isfinite(qd)), 9) AS stdev, min(qd) FILTER (WHERE isfinite(qd)) AS min, round(median(qd) FILTER (WHERE isfinite(qd)), 9) AS median, max(qd) FILTER (WHERE isfinite(qd)) AS max FROM variants")
def numeric_summary(spark, sf):
    return A.summary(read_table(spark, sf, "variants"), "qd").withColumns({x: F.round(x, 9) for x in ("mean", "stdev", "median")})
