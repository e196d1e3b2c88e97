"""Tables behind the pipeline's plots. Drawing is left to whoever shows them."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortqc.operators import aggregates as A
from cohortqc.operators import ranks

#: Ratios per bin: name -> (numerator, denominator); None divides by the number of variants.
BIN_CURVES: dict[str, tuple[str, str | None]] = {
    "n_variants": ("n", None), "ti_tv": ("n_ti", "n_tv"), "proportion_ti_tv": ("n_ti", "n"), "ins_del": ("n_ins", "n_del"), "singletons": ("n_singleton", "n"), "de_novo_per_variant": ("n_de_novo", "n"),
    "de_novo_sites": ("n_de_novo_sites", "n"), "high_quality_de_novos": ("n_high_quality_de_novos", None), "transmission": ("n_trans_singletons", "n_untrans_singletons"),
    "transmission_synonymous": ("n_trans_singletons_synonymous", "n_untrans_singletons_synonymous"), "transmission_common": ("n_trans_common", "n_untrans_common"), "omni": ("n_omni", "n"), "mills": ("n_mills", "n"),
    "hapmap": ("n_hapmap", "n"), "kgp_high_confidence": ("n_kgp_high_conf_snvs", "n"), "fail_hard_filters": ("fail_hard_filters", "n"),
}


def bin_curves(bins: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """(metric, rank_id, snv, bin, value, cumulative, n): each ratio within the bin and up to it."""
    need = sorted({c for n, d in BIN_CURVES.values() for c in (n, d) if c})
    per = bins.groupBy("rank_id", "snv", "bin").agg(*[F.sum(c).alias(c) for c in need])
    run = W.partitionBy("rank_id", "snv").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    up = per.select("*", *[F.sum(c).over(run).alias(f"{c}_up") for c in need])
    ratio = lambda n, d, up="": F.try_divide(F.col(n + up).cast("double"), F.col(d + up).cast("double")) if d else F.col(n + up).cast("double")
    each = [F.struct(F.lit(m).alias("metric"), ratio(*BIN_CURVES[m]).alias("value"), ratio(*BIN_CURVES[m], "_up").alias("cumulative")) for m in (names or BIN_CURVES)]
    return up.select("rank_id", "snv", "bin", "n", F.explode(F.array(*each)).alias("x")).select("x.metric", "rank_id", "snv", "bin", "x.value", "x.cumulative", "n")


def point_sizes(df: DataFrame, n: str = "n", by: str | None = "log", smallest: float = 1.0, largest: float = 16.0, mean: float = 4.0) -> DataFrame:
    """Adds size: all ``mean`` without ``by``, else between both limits by the number itself, its root ('radius') or its log."""
    if by is None:
        return df.withColumn("size", F.lit(mean))
    v = {"area": F.col(n).cast("double"), "radius": F.sqrt(F.col(n).cast("double")), "log": F.log(F.greatest(F.col(n), F.lit(1)).cast("double"))}[by]
    lo, hi = F.min(v).over(W.partitionBy(F.lit(0))), F.max(v).over(W.partitionBy(F.lit(0)))  # a few hundred points
    return df.withColumn("size", F.coalesce(F.try_divide(v - lo, hi - lo), F.lit(0.0)) * (largest - smallest) + smallest)


def pca_points(scores: DataFrame, label: str = "known_pop", components: int | None = None) -> DataFrame:
    """(sid, label, x, y, vx, vy): a point per sample and pair of components."""
    k = components if components is not None else scores.agg(F.min(F.size("scores"))).first()[0] or 0
    pairs = [F.struct(F.lit(a + 1).alias("x"), F.lit(b + 1).alias("y"), F.get("scores", F.lit(a)).alias("vx"), F.get("scores", F.lit(b)).alias("vy")) for a, b in itertools.combinations(range(k), 2)]
    return scores.select("sid", F.coalesce(label, F.lit("study")).alias("label"), F.explode(F.array(*pairs) if pairs else F.array().cast("array<struct<x:int,y:int,vx:double,vy:double>>")).alias("p")).select("sid", "label", "p.*")


def expand_array(df: DataFrame, column: str, prefix: str, k: int | None = None, one_based: bool = True) -> DataFrame:
    """The first k elements (the shortest length by default) of an array as columns of their own."""
    k = k if k is not None else df.agg(F.min(F.size(column))).first()[0] or 0
    return df.select("*", *[F.get(column, F.lit(i)).alias(f"{prefix}{i + one_based}") for i in range(k)])


def variant_histograms(variants: DataFrame, ranges: Mapping[str, tuple[float, float]], bins: int = 50) -> DataFrame:
    """(metric, bin from 1, n) of several columns in one pass; values outside a column's range are not counted."""
    each = []
    for c, (lo, hi) in ranges.items():
        v = F.col(c).cast("double")
        k = F.least(F.lit(bins), (F.floor((v - lo) * bins / (hi - lo)) + 1).cast("int"))
        each.append(F.struct(F.lit(c).alias("metric"), F.when(v.between(lo, hi), k).alias("bin")))
    return variants.select(F.explode(F.array(*each)).alias("_x")).select("_x.*").where("bin is not null").groupBy("metric", "bin").agg(F.count("*").alias("n"))


def stratified_histograms(samples: DataFrame, stratum: str, metrics: Sequence[str], bounds: DataFrame, bins: int = 30) -> DataFrame:
    """(stratum, metric, bin, n, lower, upper, below, above) per population and metric; bins span the observed range."""
    long_ = samples.select(stratum, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot([stratum], list(metrics), "metric", "value").where("value is not null")
    span = long_.groupBy(stratum, "metric").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    j = long_.join(span, [stratum, "metric"]).join(bounds.select(stratum, "metric", "lower", "upper"), [stratum, "metric"])
    k = F.least(F.lit(bins), (F.floor(F.coalesce(F.try_divide((F.col("value") - F.col("lo")) * bins, F.col("hi") - F.col("lo")), F.lit(0.0))) + 1).cast("int"))
    per = j.groupBy(stratum, "metric", "lower", "upper", k.alias("bin")).agg(F.count("*").alias("n"), F.count_if(F.col("value") < F.col("lower")).alias("b"), F.count_if(F.col("value") > F.col("upper")).alias("a"))
    every = W.partitionBy(stratum, "metric")
    return per.select(stratum, "metric", "bin", "n", "lower", "upper", F.sum("b").over(every).alias("below"), F.sum("a").over(every).alias("above"))


def kinship_histogram(pairs: DataFrame, bins: int = 50) -> DataFrame:
    return A.histogram(pairs, "kin", -0.5, 0.5, bins)


def grid_points(metrics: DataFrame, axes: str) -> DataFrame:
    """A scatter of two metrics; ``axes`` names them as 'kind-x-y'."""
    _, x, y = axes.split("-", 2)
    return metrics.select("point", F.col(x).alias("x"), F.col(y).alias("y"), *[c for c in ("bin", "DP", "GQ", "AB", "call_rate") if c in metrics.columns])


threshold_curve = ranks.threshold_sweep
