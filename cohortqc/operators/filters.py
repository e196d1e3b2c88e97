"""Row, column and entry filters of a cohort.

A comparison with an unknown value is unknown, and unknown never passes: every filter states what is kept, so a null
drops the row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortqc.functions import genetics as G


def autosomes(variants: DataFrame) -> DataFrame:
    return variants.where(G.in_autosome())


def without_palindromes(variants: DataFrame) -> DataFrame:
    return variants.where(~G.is_palindromic())


def autosomal_snvs(variants: DataFrame, drop_split: bool = False) -> DataFrame:
    """Autosomal SNVs. ``drop_split`` also removes the parts of split multi-allelic sites, which is what a biallelic
    filter promises; the default keeps them, as the established pipeline does in effect."""
    kept = variants.where(G.in_autosome() & G.is_snp())
    return kept.where(~F.col("was_split")) if drop_split else kept


def quality_variants(stats: DataFrame, call_rate: float = 0.99, af: float = 0.05, p_hwe: float = 1e-5) -> DataFrame:
    """Variants whose statistics reach all three thresholds (inclusive)."""
    return stats.where((F.col("call_rate") >= call_rate) & (F.col("af") >= af) & (F.col("p_hwe") >= p_hwe))


def sex_check_variants(variants: DataFrame, stats: DataFrame, af: float = 0.001, call_rate: float = 0.99) -> DataFrame:
    """Biallelic SNVs more frequent than ``af`` and called in more than ``call_rate`` of the samples (both strict)."""
    return variants.where(G.is_snp() & ~F.col("was_split")).join(stats.where((F.col("af") > af) & (F.col("call_rate") > call_rate)).select("vid"), "vid", "left_semi")


def fail_hard_filters(qd: float = 2.0, fs: float = 60.0, mq: float = 30.0) -> Column:
    return (F.col("qd") < qd) | (F.col("fs") > fs) | (F.col("mq") < mq)


def rf_bin_filter(variants: DataFrame, snv_bin: int, indel_bin: int) -> DataFrame:
    return variants.where((G.is_snp() & (F.col("rf_bin") <= snv_bin)) | (G.is_indel() & (F.col("rf_bin") <= indel_bin)))


def strict_genotypes(entries: DataFrame, dp: float = 0, gq: float = 0, vaf: float = 0) -> DataFrame:
    """Entries above all thresholds (strict; the allele balance only of heterozygous calls). All 0: no filter."""
    if not (dp or gq or vaf):
        return entries
    return entries.where(strict_pass(dp, gq, vaf))


def strict_pass(dp: float, gq: float, vaf: float) -> Column:
    good = (F.col("dp") > dp) & (F.col("gq") > gq)
    return good & (~G.is_het() | (G.het_ab() > vaf))


def failed_fraction(entries: DataFrame, dp: float, gq: float, vaf: float) -> DataFrame:
    return entries.agg(F.avg(F.when(strict_pass(dp, gq, vaf), 0.0).otherwise(1.0)).alias("failed_fraction"))


@dataclass(frozen=True)
class HardFilter:
    dp: int
    gq: int
    ab: float
    call_rate: float


def passes(dp, gq, ab) -> Column:
    """Neither depth nor quality too low, nor a heterozygous call out of balance; unknown if one of them is."""
    return ~((G.is_het() & (G.het_ab() < ab)) | (F.col("dp") < dp) | (F.col("gq") < gq))


def hard_filtered_entries(entries: DataFrame, n_samples: int, f: HardFilter) -> DataFrame:
    """Passing entries of variants that pass in more than ``call_rate`` of all samples and still have a non-reference
    call. One shuffle by variant: the counts come from a window over the passing entries."""
    good = entries.where(passes(f.dp, f.gq, f.ab))
    per = good.groupBy("vid").agg(F.count("*").alias("pass_count"), F.sum(F.greatest(F.col("gt"), F.lit(0))).alias("alts"))
    kept = per.where((F.col("pass_count").cast("double") / n_samples > f.call_rate) & (F.col("alts") > 0))
    return good.join(kept.select("vid"), "vid", "left_semi")


def sex_outliers(samples: DataFrame, low: float, high: float) -> DataFrame:
    return samples.where((F.col("f_stat") > low) & (F.col("f_stat") < high))


def sex_conflicts(samples: DataFrame) -> DataFrame | None:
    """Imputed male or female that contradicts a self-reported male or female; None without a self-reported column."""
    if "self_reported_sex" not in samples.columns:
        return None
    told, seen = F.lower(F.trim("self_reported_sex")), F.col("imputed_sex")
    return samples.where(((told == "male") & (seen == "female")) | ((told == "female") & (seen == "male")))


def contaminated(samples: DataFrame, threshold: float) -> DataFrame:
    return samples.where((F.col("freemix") > threshold) & ~F.isnan("freemix"))


def freemix_missing(samples: DataFrame) -> DataFrame:
    return samples.where(F.col("freemix").isNull() | F.isnan("freemix"))


def in_set(df: DataFrame, ids: DataFrame, column: str = "s") -> DataFrame:
    return df.join(ids.select(column), column, "left_semi")


def with_consequence(variants: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Exact match of the whole string; joined terms do not count as their parts."""
    return variants.where(F.col("consequence").isin(*terms))


def ld_prune_candidates(variants: DataFrame, stats: DataFrame, long_range: DataFrame, **thresholds: float) -> DataFrame:
    """Autosomal SNVs of good quality, outside the given intervals, that are not palindromic."""
    from cohortqc.operators.joins import interval_anti

    good = quality_variants(stats, **thresholds).select("vid")
    return without_palindromes(interval_anti(autosomal_snvs(variants).join(good, "vid", "left_semi"), long_range))
