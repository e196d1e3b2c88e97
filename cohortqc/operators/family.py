"""Family statistics over the trio table of joins.trio_entries: Mendel errors, transmission, de novo calls."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortqc.functions import genetics as G
from cohortqc.operators.joins import trio_entries
from cohortqc.session import materialize


def mendel_code(kid: str = "kid_gt", dad: str = "dad_gt", mom: str = "mom_gt", haploid: Column | None = None) -> Column:
    """The usual code of an impossible combination of calls (null if it is possible or cannot be told).

    ``haploid``: 'X' or 'Y' where a son's call comes from one parent only, null elsewhere; no error can be told where it is another text.
    """
    k, d, m = F.col(kid), F.col(dad), F.col(mom)
    auto = (
        F.when((k == 1) & (d == 2) & (m == 2), 1).when((k == 1) & (d == 0) & (m == 0), 2)
        .when((k == 2) & (d == 0) & (m == 0), 5).when((k == 2) & (d == 0), 3).when((k == 2) & (m == 0), 4)
        .when((k == 0) & (d == 2) & (m == 2), 8).when((k == 0) & (d == 2), 6).when((k == 0) & (m == 2), 7)
    )
    if haploid is None:
        return auto
    x = F.when((k == 0) & (m == 2), 9).when((k == 2) & (m == 0), 10)
    y = F.when((k == 0) & (d == 2), 11).when((k == 2) & (d == 0), 12)
    return F.when(haploid == "X", x).when(haploid == "Y", y).when(haploid.isNull(), auto)


def haploid_of(contig: Column | str = "contig", pos: Column | str = "pos", is_female: Column | str = "is_female") -> Column:
    """'X' or 'Y' where the child has one copy only (sons outside the pseudo-autosomal regions), '?' there if the sex is
    unknown, else null."""
    female = F.col(is_female) if isinstance(is_female, str) else is_female
    x, y = G.in_x_nonpar(contig, pos), G.in_y_nonpar(contig, pos)
    return F.when((x | y) & female.isNull(), "?").when(x & ~female, "X").when(y & ~female, "Y")


def with_haploid(trio: DataFrame, variants: DataFrame, trios: DataFrame) -> DataFrame:
    """Adds ``haploid`` to a trio table, from the variants' loci (vid, contig, pos) and the children's sex (is_female in
    ``trios``). Only variants of the sex chromosomes and one row per child are looked up. Without the children's sex all
    calls count as diploid."""
    if "is_female" not in trios.columns:
        return trio.withColumn("haploid", F.lit(None).cast("string"))
    sex = variants.where(G.in_x_nonpar() | G.in_y_nonpar()).select("vid", "contig", "pos")
    kids = trios.groupBy("fam_id", "kid", "dad", "mom").agg(F.max("is_female").alias("is_female"))
    j = trio.join(sex, "vid", "left").join(kids, ["fam_id", "kid", "dad", "mom"], "left")
    return j.withColumn("haploid", haploid_of()).drop("contig", "pos", "is_female")


def mendel_errors(trio: DataFrame, haploid: Column | None = None) -> DataFrame:
    """Trio rows with an error and its code. A column ``haploid`` (:func:`with_haploid`) is heeded if there is one."""
    if haploid is None and "haploid" in trio.columns:
        haploid = F.col("haploid")
    return trio.withColumn("mendel_code", mendel_code(haploid=haploid)).where("mendel_code is not null")


def mendel_per_variant(errors: DataFrame) -> DataFrame:
    return errors.groupBy("vid").agg(F.count("*").alias("errors"))


def mendel_per_sample(errors: DataFrame) -> DataFrame:
    """(sid, errors): an error counts for every member it implicates."""
    c = F.col("mendel_code")
    who = F.array_compact(
        F.array(F.col("kid"), F.when(c.isin(1, 2, 3, 6, 11, 12), F.col("dad")), F.when(c.isin(1, 2, 4, 7, 9, 10), F.col("mom")))
    )
    return errors.select(F.explode(who).alias("sid")).groupBy("sid").agg(F.count("*").alias("errors"))


def mendel_per_family(errors: DataFrame) -> DataFrame:
    return errors.groupBy("fam_id", "dad", "mom").agg(F.count_distinct("kid").alias("children"), F.count("*").alias("errors"))


def proband_error_rate(trio: DataFrame, trios: DataFrame, n_variants: int) -> DataFrame:
    """(mean, std) of the probands' Mendel errors per variant; a proband without error counts with 0."""
    per = mendel_errors(trio).groupBy("kid").agg(F.count("*").alias("errors"))
    rate = trios.where("kid is not null and dad is not null and mom is not null").select("kid").distinct().join(per, "kid", "left").select((F.coalesce("errors", F.lit(0)).cast("double") / n_variants).alias("r"))
    return rate.agg(F.avg("r").alias("mendelian_error_mean"), F.stddev_pop("r").alias("mendelian_error_std"))


def transmissions(kid: str = "kid_gt", dad: str = "dad_gt", mom: str = "mom_gt") -> tuple[Column, Column]:
    """Alleles transmitted and not transmitted by heterozygous parents; null where the calls contradict each other.

    A homozygous-variant parent passes one alternative allele for certain, so the heterozygous parents passed what is
    left of the child's.
    """
    k, d, m = F.col(kid), F.col(dad), F.col(mom)
    het = (d == 1).cast("int") + (m == 1).cast("int")
    t = k - (d == 2).cast("int") - (m == 2).cast("int")
    fine = (het > 0) & t.between(F.lit(0), het)
    return F.when(fine, t), F.when(fine, het - t)


@F.pandas_udf(T.DoubleType())
def chi2_p(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Upper tail of chi-square with one degree of freedom; a batch's different values are few, as they come from counts."""
    for chi in it:
        values, code = np.unique(chi.to_numpy(float), return_inverse=True)
        yield pd.Series(np.array([math.erfc(math.sqrt(x / 2)) if x == x else math.nan for x in values.tolist()], float)[code])


def tdt(trio: DataFrame, p_value: bool = True) -> DataFrame:
    """(vid, t, u, chi_sq, p_value) over all trios; variants without an informative trio have t = u = 0."""
    t, u = transmissions()
    per = trio.groupBy("vid").agg(F.coalesce(F.sum(t), F.lit(0)).cast("long").alias("t"), F.coalesce(F.sum(u), F.lit(0)).cast("long").alias("u"))
    out = per.withColumn("chi_sq", F.try_divide(((F.col("t") - F.col("u")) * (F.col("t") - F.col("u"))).cast("double"), (F.col("t") + F.col("u")).cast("double")))
    return out.withColumn("p_value", chi2_p("chi_sq")) if p_value else out


def trio_stats(trio: DataFrame) -> DataFrame:
    """The 14 counters per variant, raw and of high-quality calls; needs gt, gq, dp and ad_alt of each member."""
    t, u = transmissions()
    adj = {r: G.adj_pass(f"{r}_gt", f"{r}_gq", f"{r}_dp", G.het_ab(f"{r}_gt", f"{r}_ad_alt", f"{r}_dp")) for r in ("kid", "dad", "mom")}
    all_adj = adj["kid"] & adj["dad"] & adj["mom"]
    k, d, m = F.col("kid_gt"), F.col("dad_gt"), F.col("mom_gt")
    novo = (k == 1) & (d == 0) & (m == 0)
    out = []
    for name, ok in (("raw", None), ("adj", adj)):
        on = lambda c, cond: c if ok is None else F.when(cond, c)  # noqa: B023, E731
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
        count = lambda c: F.count(c).cast("long") * 2
        out += [total(on(t, all_adj)).alias(f"n_transmitted_{name}"), total(on(u, all_adj)).alias(f"n_untransmitted_{name}"), F.count_if(novo if ok is None else novo & all_adj).alias(f"n_de_novos_{name}")]
        dd, mm, kk = on(d, adj["dad"]), on(m, adj["mom"]), on(k, adj["kid"])
        out += [(total(dd) + total(mm)).alias(f"ac_parents_{name}"), (count(dd) + count(mm)).alias(f"an_parents_{name}"), total(kk).alias(f"ac_children_{name}"), count(kk).alias(f"an_children_{name}")]
    return trio.groupBy("vid").agg(*out)


def singleton_transmission(trio: DataFrame, variants: DataFrame, trio_ac: DataFrame) -> DataFrame:
    """(vid, variant_transmitted_singletons, variant_untransmitted_singletons): synonymous variants whose
    allele count over all trio members is 2 (passed on) or 1 (not passed on), counted in families with exactly one."""
    syn = variants.where("consequence = 'synonymous_variant'").select("vid")
    parent = (F.col("dad_gt") > 0) | (F.col("mom_gt") > 0)
    t = trio.join(syn, "vid", "left_semi").join(trio_ac.select("vid", "ac"), "vid")
    per = t.groupBy("vid", "fam_id").agg(
        F.count_if((F.col("ac") == 2) & (F.col("kid_gt") > 0) & parent).alias("yes"), F.count_if((F.col("ac") == 1) & (F.col("kid_gt") == 0) & parent).alias("no")
    )
    found = per.groupBy("vid").agg(F.count_if(F.col("yes") == 1).alias("variant_transmitted_singletons"), F.count_if(F.col("no") == 1).alias("variant_untransmitted_singletons"))
    return variants.select("vid").join(found, "vid", "left").fillna(0)


def founder_singletons(entries: DataFrame, trios: DataFrame) -> DataFrame:
    """Variants with exactly one alternative allele among the founders (members who are never a child)."""
    members = trios.select(F.explode(F.array("kid", "dad", "mom")).alias("sid")).where("sid is not null").distinct()
    founders = members.join(trios.select(F.col("kid").alias("sid")), "sid", "left_anti")
    return entries.join(F.broadcast(founders), "sid", "left_semi").groupBy("vid").agg(F.sum("gt").alias("ac")).where("ac = 1").select("vid")


def transmission_ratio(entries: DataFrame, trios: DataFrame, variants: DataFrame) -> DataFrame:
    """(trans, untrans, ratio) over founder singletons of ``variants``; the ratio is -1 without untransmitted ones."""
    members = trios.select(F.explode(F.array("kid", "dad", "mom")).alias("sid")).distinct()
    some = materialize(entries.join(variants.select("vid"), "vid", "left_semi").join(members, "sid", "left_semi").select("vid", "sid", "gt"))  # used twice
    single = founder_singletons(some, trios)
    counts = tdt(trio_entries(some.join(single, "vid", "left_semi"), trios), p_value=False)
    both = counts.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("trans"), F.coalesce(F.sum("u"), F.lit(0)).alias("untrans"))
    return both.withColumn("ratio", F.when(F.col("untrans") > 0, F.col("trans").cast("double") / F.nullif("untrans", F.lit(0))).otherwise(-1.0))


#: Prior of a new mutation per site, and the smallest allele frequency assumed (fixed values of the published method).
DE_NOVO_PRIOR = 1 / 3e7
MIN_POP_PRIOR = 100 / 3e7


def de_novo(trio: DataFrame, sites: DataFrame, min_gq: int = 20, min_p: float = 0.05, max_parent_ab: float = 0.05, min_child_ab: float = 0.2, min_dp_ratio: float = 0.1) -> DataFrame:
    """Candidates for new mutations with p_de_novo and confidence (published Bayesian method for trios).

    ``trio``: gt, gq, pl, ad (array ref, alt) of each member; ``sites``: vid, ac, an, pop_af, is_snv. The child is
    heterozygous and both parents homozygous for the reference. The alternative explanation is an unseen heterozygous
    parent, whose prior comes from the larger of the cohort's frequency without this child and the population's.
    """
    s = trio.join(sites.select("vid", "ac", "an", "pop_af", "is_snv"), "vid").where("kid_gt = 1 and dad_gt = 0 and mom_gt = 0")

    def posterior(role: str, k: int) -> Column:
        pl = F.transform(F.col(f"{role}_pl"), lambda x: F.pow(F.lit(10.0), -x.cast("double") / 10))
        return F.get(pl, F.lit(k)) / F.aggregate(pl, F.lit(0.0), lambda a, x: a + x)

    depth = lambda role: F.aggregate(F.col(f"{role}_ad"), F.lit(0), lambda a, x: a + x)
    share = lambda role: F.try_divide(F.get(f"{role}_ad", F.lit(1)).cast("double"), depth(role).cast("double"))
    site = F.greatest((F.col("ac") - 1).cast("double") / F.nullif(F.col("an") - 1, F.lit(0)), F.coalesce("pop_af", F.lit(0.0)), F.lit(MIN_POP_PRIOR))
    s = s.withColumns(
        {"prior": site, "kid_ab": share("kid"), "dad_ab": share("dad"), "mom_ab": share("mom"), "dp_ratio": F.try_divide(depth("kid").cast("double"), (depth("dad") + depth("mom")).cast("double"))}
    )
    new = posterior("dad", 0) * posterior("mom", 0) * posterior("kid", 1) * DE_NOVO_PRIOR
    missed = (posterior("dad", 1) * posterior("mom", 0) + posterior("dad", 0) * posterior("mom", 1)) * posterior("kid", 1) * (1 - F.pow(1 - F.col("prior"), F.lit(4)))
    p = F.col("p_de_novo")
    s = s.withColumn("p_de_novo", F.try_divide(new, new + missed))
    s = s.where((F.col("kid_gq") >= min_gq) & (F.col("kid_ab") >= min_child_ab) & (F.col("dad_ab") <= max_parent_ab) & (F.col("mom_ab") <= max_parent_ab) & (F.col("dp_ratio") >= min_dp_ratio) & (p >= min_p))
    single, balanced = F.col("ac") == 1, F.col("kid_ab") > 0.3
    high_snv = ((p > 0.99) & balanced & (F.col("dp_ratio") > 0.2)) | ((p > 0.99) & balanced & single) | ((p > 0.5) & balanced & single & (depth("kid") > 10))
    high_indel = (p > 0.99) & balanced & single
    level = F.when(F.when(F.col("is_snv"), high_snv).otherwise(high_indel), "HIGH").when((p > 0.5) & balanced, "MEDIUM").otherwise("LOW")
    return s.select("vid", "fam_id", "kid", "dad", "mom", "prior", "p_de_novo", level.alias("confidence"))
