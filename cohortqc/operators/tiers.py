"""Tiered genotype filters: relaxed, medium and stringent, for SNVs and indels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortqc.functions import genetics as G

TIERS = ("relaxed", "medium", "stringent")
#: Thresholds per kind and tier; an example, meant to be replaced by a run's own choice.
EXAMPLE = {
    "snp": {"relaxed": {"bin": 92, "dp": 5, "gq": 10, "ab": 0.2, "call_rate": 0.0}, "medium": {"bin": 80, "dp": 40, "gq": 40, "ab": 0.2, "call_rate": 0.3}, "stringent": {"bin": 60, "dp": 60, "gq": 50, "ab": 0.3, "call_rate": 0.5}},
    "indel": {"relaxed": {"bin": 80, "dp": 5, "gq": 10, "ab": 0.2, "call_rate": 0.0}, "medium": {"bin": 70, "dp": 40, "gq": 40, "ab": 0.3, "call_rate": 0.3}, "stringent": {"bin": 50, "dp": 60, "gq": 50, "ab": 0.3, "call_rate": 0.5}},
}


def _passes(limits: Mapping[str, Mapping[str, float]]) -> Column:
    """Whether an entry passes one tier; unknown where a value that decides it is."""

    def kind(test: Column, t: Mapping[str, float]) -> Column:
        call = (G.is_het() & (G.het_ab() >= t["ab"])) | G.is_hom_ref() | G.is_hom_var()
        return test & (F.col("rf_bin") <= t["bin"]) & (F.col("dp") >= t["dp"]) & (F.col("gq") >= t["gq"]) & call

    return kind(F.col("is_snv"), limits["snp"]) | kind(F.col("is_indel"), limits["indel"])


def tag(entries: DataFrame, variants: DataFrame, filters: Mapping = EXAMPLE) -> DataFrame:
    """Adds <tier>_filters: Pass, Fail, or null where the condition is unknown."""
    kinds = variants.select("vid", "rf_bin", G.is_snp().alias("is_snv"), G.is_indel().alias("is_indel"))
    e = entries.join(kinds, "vid")
    for t in TIERS:
        ok = _passes({k: filters[k][t] for k in ("snp", "indel")})
        e = e.withColumn(f"{t}_filters", F.when(ok, "Pass").when(~ok, "Fail"))
    return e


def retag(tagged: DataFrame, n_samples: int, filters: Mapping = EXAMPLE) -> DataFrame:
    """A tier stays Pass only at variants where more than call_rate of all samples pass it; elsewhere all entries fail.

    The counts are an aggregate per variant (joined back), not a window: the partial counts cross the shuffle.
    """
    counts = tagged.groupBy("vid").agg(*[F.count_if(F.col(f"{t}_filters") == "Pass").alias(f"_{t}") for t in TIERS])
    e = tagged.join(counts, "vid")
    for t in TIERS:
        need = lambda k, t=t: F.col(f"_{t}") > n_samples * filters[k][t]["call_rate"]
        good = (F.col("is_snv") & need("snp")) | (F.col("is_indel") & need("indel"))
        e = e.withColumn(f"{t}_filters", F.when(good, F.col(f"{t}_filters")).otherwise("Fail"))
    return e.drop(*[f"_{t}" for t in TIERS])


def annotate(tagged: DataFrame, n_samples: int) -> DataFrame:
    """Per variant and tier: pass_count, fraction_pass and AN, AC, AC_Hom (2 per homozygote) and AC_Het of what passes."""
    out = []
    for t in TIERS:
        ok = F.col(f"{t}_filters") == "Pass"
        gt = F.when(ok, F.col("gt"))
        ac, hom = F.coalesce(F.sum(gt), F.lit(0)).cast("long"), F.count_if(ok & G.is_hom_var())
        out += [F.count_if(ok).alias(f"{t}_pass_count"), (F.count_if(ok).cast("double") / n_samples).alias(f"fraction_pass_{t}_filters"), (2 * F.count(gt)).alias(f"{t}_AN"), ac.alias(f"{t}_AC"), (2 * hom).alias(f"{t}_AC_Hom"), (ac - 2 * hom).alias(f"{t}_AC_Het")]
    return tagged.groupBy("vid").agg(*out)
