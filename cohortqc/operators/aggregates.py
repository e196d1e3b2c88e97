"""Counts and statistics per variant, per sample and over all."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from cohortqc.functions import genetics as G


def duplicates(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Keys that stand more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).where(F.col(name) > 1)


#: Terms of the exact test that are held at once.
HWE_TERMS = 4_000_000


def hwe_midp(n_ref: np.ndarray, n_het: np.ndarray, n_var: np.ndarray) -> np.ndarray:
    """Exact tests of Hardy-Weinberg equilibrium with the mid-p correction: the probabilities of all numbers of
    heterozygotes that are less likely than the observed one, and half of those as likely (0.5 without variation, NaN
    without calls). All tests are done at once, in pieces of HWE_TERMS terms."""
    n_ref, n_het, n_var = (np.atleast_1d(np.asarray(x, np.int64)) for x in (n_ref, n_het, n_var))
    n, rare = n_ref + n_het + n_var, 2 * np.minimum(n_ref, n_var) + n_het
    out = np.full(len(n), np.nan)
    log_factorial = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n.max(initial=0) + 1)))])
    terms = rare // 2 + 1
    piece = np.cumsum(terms) // HWE_TERMS
    for k in np.unique(piece):
        at = np.flatnonzero((piece == k) & (n > 0))
        if not len(at):
            continue
        size = terms[at]
        start = np.cumsum(size) - size
        step = np.arange(size.sum()) - np.repeat(start, size)  # number of rare homozygotes, from none
        test = np.repeat(at, size)
        het = rare[test] - 2 * step
        # log of n! / (hom! het! hom!) * 2^het, up to a constant
        logp = het * math.log(2) - (log_factorial[step] + log_factorial[het] + log_factorial[n[test] - het - step])
        seen = start + (rare[at] - n_het[at]) // 2
        p = np.exp(logp - np.repeat(np.maximum.reduceat(logp, start), size))
        mine = np.repeat(p[seen], size)
        same = np.isclose(p, mine, rtol=1e-9, atol=0)
        less = np.where((p < mine) & ~same, p, 0) + np.where(same, p / 2, 0)
        out[at] = np.minimum(1.0, np.add.reduceat(less, start) / np.add.reduceat(p, start))
    return out


@F.pandas_udf(T.DoubleType())
def hwe_p(it: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for counts in it:
        keys, code = np.unique(np.stack([c.to_numpy(np.int64) for c in counts], 1), axis=0, return_inverse=True)  # the same counts recur
        yield pd.Series(hwe_midp(keys[:, 0], keys[:, 1], keys[:, 2])[code.reshape(-1)])


def count_if(cond: Column) -> Column:
    return F.count_if(cond)


def variant_counts(entries: DataFrame, n_samples: int) -> DataFrame:
    """Call counts per variant in one pass; call rate against all samples, not against the entries that are there."""
    called = F.count("gt")
    ac = F.coalesce(F.sum("gt"), F.lit(0)).cast("long")
    return (
        entries.groupBy("vid")
        .agg(
            called.alias("n_called"), count_if(G.is_hom_ref()).alias("n_hom_ref"), count_if(G.is_het()).alias("n_het"), count_if(G.is_hom_var()).alias("n_hom_var"),
            count_if(G.is_non_ref()).alias("n_non_ref"), ac.alias("ac"), F.avg("dp").alias("dp_mean"), F.avg("gq").alias("gq_mean"),
        )
        .withColumn("an", F.col("n_called") * 2)
        .withColumn("af", F.try_divide(F.col("ac").cast("double"), F.col("an").cast("double")))
        .withColumn("call_rate", F.col("n_called").cast("double") / n_samples)
    )


def variant_qc(entries: DataFrame, n_samples: int) -> DataFrame:
    return variant_counts(entries, n_samples).withColumn("p_hwe", hwe_p("n_hom_ref", "n_het", "n_hom_var"))


def call_stats(entries: DataFrame) -> DataFrame:
    """Per variant AC, AF and homozygote counts as arrays with the reference allele first, and AN."""
    c = entries.groupBy("vid").agg(F.count("gt").alias("n"), F.coalesce(F.sum("gt"), F.lit(0)).cast("long").alias("alt"), count_if(G.is_hom_ref()).alias("h0"), count_if(G.is_hom_var()).alias("h2"))
    an = F.col("n") * 2
    share = lambda x: F.try_divide(x.cast("double"), an.cast("double"))
    return c.select(
        "vid", F.array(an - F.col("alt"), F.col("alt")).alias("ac"), F.array(share(an - F.col("alt")), share(F.col("alt"))).alias("af"), an.alias("an"), F.array("h0", "h2").alias("homozygote_count")
    )


def sample_qc(entries: DataFrame, variants: DataFrame) -> DataFrame:
    """Per sample: calls by kind, alternative alleles by class and the usual ratios."""
    kinds = variants.select("vid", G.allele_type().alias("kind"), G.is_transition().alias("ti"))
    e = entries.join(kinds, "vid").where("gt is not null")
    alt = F.col("gt").cast("long")
    total = lambda cond: F.coalesce(F.sum(F.when(cond, alt)), F.lit(0))
    per = e.groupBy("sid").agg(
        F.count("*").alias("n_called"), count_if(G.is_hom_ref()).alias("n_hom_ref"), count_if(G.is_het()).alias("n_het"), count_if(G.is_hom_var()).alias("n_hom_var"), count_if(G.is_non_ref()).alias("n_non_ref"),
        total(F.col("kind") == "snv").alias("n_snp"), total((F.col("kind") == "snv") & F.col("ti")).alias("n_transition"), total((F.col("kind") == "snv") & ~F.col("ti")).alias("n_transversion"),
        total(F.col("kind") == "ins").alias("n_insertion"), total(F.col("kind") == "del").alias("n_deletion"),
    )
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    return per.select(
        "*", ratio("n_transition", "n_transversion").alias("r_ti_tv"), ratio("n_insertion", "n_deletion").alias("r_insertion_deletion"),
        ratio("n_het", "n_hom_var").alias("r_het_hom_var"), ratio("n_het", "n_called").alias("heterozygosity_rate"),
    )


def mean_het_ab(entries: DataFrame) -> DataFrame:
    return entries.groupBy("vid").agg(F.avg(G.het_ab()).alias("mean_het_ab"))


def allele_counts(entries: DataFrame) -> DataFrame:
    """Alternative alleles per variant, of all calls and of high-quality ones."""
    return entries.groupBy("vid").agg(
        F.coalesce(F.sum("gt"), F.lit(0)).cast("long").alias("ac_raw"), F.coalesce(F.sum(F.when(G.adj_pass(), F.col("gt"))), F.lit(0)).cast("long").alias("ac_adj")
    )


def inbreeding(entries: DataFrame) -> DataFrame:
    """Per site 1 - observed / expected heterozygotes; null where none are expected."""
    c = entries.groupBy("vid").agg(count_if(G.is_het()).alias("het"), F.count("gt").alias("n"), F.sum("gt").alias("ac"))
    p = F.col("ac").cast("double") / (2 * F.nullif("n", F.lit(0)))
    return c.select("vid", (1 - F.try_divide(F.col("het").cast("double"), 2 * p * (1 - p) * F.col("n"))).alias("inbreeding_coeff"))


def sample_call_rate(entries: DataFrame, n_variants: int) -> DataFrame:
    return entries.groupBy("sid").agg((F.count("gt").cast("double") / n_variants).alias("call_rate"))


def consequence_counts(variants: DataFrame, terms: Sequence[str] | None = None) -> DataFrame:
    """Variants per consequence term; joined terms count for each of their parts."""
    each = variants.select(F.explode(F.split("consequence", "&")).alias("term"))
    return (each.where(F.col("term").isin(*terms)) if terms else each).groupBy("term").agg(F.count("*").alias("n"))


def confusion(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def mutation_spectra(entries: DataFrame, variants: DataFrame) -> DataFrame:
    """(sid, mutation_type, alt_calls, fraction): autosomal SNVs; the fractions of a sample add up to 1."""
    snvs = variants.where(G.in_autosome() & G.is_snp()).select("vid", F.concat("ref", F.lit(">"), "alt").alias("mutation_type"))
    calls = entries.join(snvs, "vid").groupBy("sid", "mutation_type").agg((count_if(G.is_het()) + 2 * count_if(G.is_hom_var())).alias("alt_calls"))
    whole = F.sum("alt_calls").over(W.partitionBy("sid"))  # a row per kind of exchange, at most twelve
    return calls.withColumn("fraction", F.try_divide(F.col("alt_calls").cast("double"), whole.cast("double")))


def pivot_spectra(spectra: DataFrame) -> DataFrame:
    kinds = [f"{a}>{b}" for a in "ACGT" for b in "ACGT" if a != b]
    wide = spectra.groupBy("sid").pivot("mutation_type", kinds).agg(F.first("fraction"))
    return wide.select("sid", *[F.col(f"`{k}`").alias(k.replace(">", "_to_")) for k in kinds])


def describe_by(df: DataFrame, key: str, value: str, k: float = 1.5) -> DataFrame:
    """count, mean, std, min, quartiles (interpolated), max and the whiskers q1 - k iqr, q3 + k iqr per key."""
    v = F.col(value)
    d = df.groupBy(key).agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.percentile(v, [0.25, 0.5, 0.75]).alias("q"), F.max(v).alias("max")
    )
    q1, q3 = F.get("q", F.lit(0)), F.get("q", F.lit(2))
    return d.select(key, "count", "mean", "std", "min", q1.alias("q1"), F.get("q", F.lit(1)).alias("q2"), q3.alias("q3"), "max", (q1 - k * (q3 - q1)).alias("lower"), (q3 + k * (q3 - q1)).alias("upper"))


def iqr_outliers(df: DataFrame, key: str, value: str, k: float = 1.5) -> DataFrame:
    stats = describe_by(df, key, value, k).select(key, "lower", "upper")
    return df.join(stats, key).where((F.col(value) < F.col("lower")) | (F.col(value) > F.col("upper"))).drop("lower", "upper")


#: Makes the median absolute deviation estimate the standard deviation of normal data (fixed value).
MAD_SCALE = 1.4826


def mad_bounds(samples: DataFrame, stratum: str, metrics: Sequence[str], n_mad: float = 4.0) -> DataFrame:
    """(stratum, metric, median, mad, lower, upper); exact medians of one row per sample and metric."""
    long_ = samples.unpivot([stratum], list(metrics), "metric", "value")
    med = long_.groupBy(stratum, "metric").agg(F.median("value").alias("median"))
    dev = long_.join(med, [stratum, "metric"]).groupBy(stratum, "metric", "median").agg((MAD_SCALE * F.median(F.abs(F.col("value") - F.col("median")))).alias("mad"))
    return dev.select("*", (F.col("median") - n_mad * F.col("mad")).alias("lower"), (F.col("median") + n_mad * F.col("mad")).alias("upper"))


def mad_outliers(samples: DataFrame, stratum: str, metrics: Sequence[str], n_mad: float = 4.0, ident: str = "sid") -> DataFrame:
    """Each sample with the sorted array of metrics that lie outside its stratum's bounds (strict), empty if none."""
    wide = samples.select(ident, stratum, *[F.col(m).cast("double").alias(m) for m in metrics])
    bounds = mad_bounds(wide.drop(ident), stratum, metrics, n_mad)
    long_ = wide.unpivot([ident, stratum], list(metrics), "metric", "value").join(bounds, [stratum, "metric"])
    out = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return long_.groupBy(ident, stratum).agg(F.sort_array(F.collect_set(F.when(out, F.col("metric")))).alias("qc_metrics_filters"))


def pass_fail(outliers: DataFrame) -> DataFrame:
    """Pass without, Fail with a failed metric, and an empty text where the metrics are unknown."""
    n = F.size("qc_metrics_filters")
    return outliers.withColumn("status", F.when(n == 0, "Pass").when(n > 0, "Fail").otherwise(""))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """(bin from 1, n): equal widths from ``low`` to ``high``, the last bin closed; values outside are not counted."""
    v = F.col(value).cast("double")
    k = F.least(F.lit(bins), (F.floor((v - low) * bins / (high - low)) + 1).cast("int"))
    return df.where(v.between(low, high)).groupBy(k.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def summary(df: DataFrame, value: str) -> DataFrame:
    """(n, n_missing, mean, stdev, min, median, max) of a number column; NaN and infinite values count as missing."""
    v = F.when(F.abs(F.col(value).cast("double")) < float("inf"), F.col(value).cast("double"))
    return df.select(v.alias("v")).agg(
        F.count("v").alias("n"), F.count_if(F.col("v").isNull()).alias("n_missing"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("stdev"), F.min("v").alias("min"), F.median("v").alias("median"), F.max("v").alias("max")
    )


def below_above(df: DataFrame, value: str, low: float, high: float) -> DataFrame:
    return df.agg(F.count_if(F.col(value) < low).alias("below"), F.count_if(F.col(value) > high).alias("above"))


CLASSES: dict[str, tuple[str, tuple[str, ...]]] = {
    "synonymous": ("snv", ("synonymous_variant",)),
    "missense": ("snv", ("missense_variant",)),
    "nonsense": ("snv", ("stop_gained",)),
    "splice": ("snv", ("splice_acceptor_variant", "splice_donor_variant")),
    "frameshift": ("indel", ("frameshift_variant",)),
    "in_frame": ("indel", ("inframe_deletion", "inframe_insertion")),
    "coding_snv": ("snv", ("synonymous_variant", "missense_variant", "stop_gained", "splice_acceptor_variant", "splice_donor_variant", "start_lost", "stop_lost")),
    "coding_indel": ("indel", ("frameshift_variant", "inframe_deletion", "inframe_insertion")),
}


def class_counts(entries: DataFrame, variants: DataFrame, samples: DataFrame, rare_below: int = 5) -> DataFrame:
    """Per sample the non-reference calls of eight functional classes, all and rare; samples without any have zeros."""
    v = variants.select("vid", G.allele_class().alias("kind"), "consequence", (F.col("freq_ac") < rare_below).alias("rare"))
    e = entries.where("gt > 0").join(v, "vid")
    cols = []
    for name, (kind, terms) in CLASSES.items():
        here = (F.col("kind") == kind) & F.col("consequence").isin(*terms)
        cols += [F.count_if(here).alias(f"{name}_all"), F.count_if(here & F.col("rare")).alias(f"{name}_rare")]
    return samples.select("sid").join(e.groupBy("sid").agg(*cols), "sid", "left").fillna(0)


def median_class_counts(counts: DataFrame) -> DataFrame:
    names = [c for c in counts.columns if c != "sid"]
    return counts.unpivot(["sid"], names, "class", "n").groupBy("class").agg(F.median("n").alias("median_n"))


# fixed values: the terms counted as coding and as non-coding
CODING = (
    "frameshift_variant", "missense_variant", "splice_acceptor_variant", "splice_donor_variant", "start_lost_variant", "start_retained_variant",
    "stop_retained_variant", "stop_gained_variant", "stop_lost_variant", "inframe_deletion_variant", "inframe_insertion_variant", "synonymous_variant",
)
NON_CODING = ("3_prime_utr_variant", "5_prime_utr_variant", "downstream_gene_variant", "intergenic_variant", "intron_variant", "upstream_gene_variant")


def consequence_by_tier(variants: DataFrame, tiers: Sequence[str] = ("relaxed", "medium", "stringent")) -> DataFrame:
    """(tier, term, n) and the totals of coding and non-coding terms, before filtering and for each tier's variants."""
    kept = F.array_compact(F.array(F.lit("unfiltered"), *[F.when(F.col(f"{t}_pass_count") > 0, F.lit(t)) for t in tiers]))
    each = variants.select(F.explode(kept).alias("tier"), "consequence")
    terms = each.select("tier", F.explode(F.split("consequence", "&")).alias("term")).where(F.col("term").isin(*CODING, *NON_CODING))
    counts = terms.groupBy("tier", "term").agg(F.count("*").alias("n"))
    group = F.when(F.col("term").isin(*CODING), "total_coding").otherwise("total_noncoding")
    return counts.unionByName(counts.groupBy("tier", group.alias("term")).agg(F.sum("n").alias("n")))
