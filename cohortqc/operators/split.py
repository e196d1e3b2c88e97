"""Splitting multi-allelic sites into one row per alternative allele."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortqc.functions import genetics as G

#: Entry fields and the types they must have.
ENTRY_TYPES = {"gt": "struct<a0:int,a1:int,phased:boolean>", "pgt": "struct<a0:int,a1:int,phased:boolean>", "ad": "array<int>", "dp": "int", "gq": "int", "pl": "array<int>", "pid": "string"}


def split_sites(sites: DataFrame, keep_star: bool = False) -> DataFrame:
    """One row per alternative allele: alleles becomes [ref, alt]; adds a_index (from 1), was_split and old_alleles."""
    alts = F.slice("alleles", 2, F.greatest(F.lit(0), F.size("alleles") - 1))
    each = sites.select("*", F.posexplode(alts).alias("_k", "_alt"))
    if not keep_star:
        each = each.where("_alt <> '*'")
    return (
        each.withColumn("old_alleles", F.col("alleles")).withColumn("a_index", F.col("_k") + 1).withColumn("was_split", F.size("alleles") > 2)
        .withColumn("alleles", F.array(F.get("alleles", F.lit(0)), "_alt")).drop("_k", "_alt")
    )


def _downcoded(call: Column, i: Column) -> Column:
    """The call with allele i as 1 and every other as 0; unphased calls have the smaller allele first."""
    a, b = (call["a0"] == i).cast("int"), (call["a1"] == i).cast("int")
    first = F.when(call["phased"], a).otherwise(F.least(a, b))
    second = F.when(call["phased"], b).otherwise(F.greatest(a, b))
    return F.when(call.isNotNull(), F.struct(first.alias("a0"), second.alias("a1"), call["phased"].alias("phased")))


def _downcoded_pl(pl: Column, i: Column, n: Column) -> Column:
    """Likelihood of 0, 1 and 2 copies of allele i: the smallest among the genotypes with so many copies."""
    # genotypes j/k in their order: 0/0, 0/1, 1/1, 0/2, ...
    genotypes = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.transform(F.sequence(F.lit(0), k), lambda j: F.struct(j.alias("j"), k.alias("k")))))

    def least(copies: int) -> Column:
        some = F.filter(genotypes, lambda g: (g["j"] == i).cast("int") + (g["k"] == i).cast("int") == copies)
        return F.array_min(F.transform(some, lambda g: F.get(pl, G.genotype_index(g["j"], g["k"]))))

    return F.when(pl.isNotNull(), F.array(least(0), least(1), least(2)))


def check_types(entries: DataFrame) -> None:
    have = {f.name: f.dataType.simpleString() for f in entries.schema.fields}
    bad = [f"'{c}': found {have[c]}, expected {t}" for c, t in ENTRY_TYPES.items() if c in have and have[c] != t]
    if bad:
        raise TypeError("entry fields of a wrong type: " + "; ".join(bad))


def split_entries(entries: DataFrame, split: DataFrame, key: str = "site", recalculate_gq: bool = False) -> DataFrame:
    """Entries of split sites: calls and likelihoods per allele, AD as [all other, this], DP, PID and GQ as they were.

    GQ comes from the new likelihoods with ``recalculate_gq`` (from the old GQ where they are missing).
    """
    check_types(entries)
    e = entries.join(split.select(key, "a_index", F.size("old_alleles").alias("_n")), key)
    i = F.col("a_index")
    out = {}
    for c in ("gt", "pgt"):
        if c in entries.columns:
            out[c] = _downcoded(F.col(c), i)
    if "ad" in entries.columns:
        this = F.get("ad", i)
        out["ad"] = F.when(F.col("ad").isNotNull(), F.array((F.aggregate("ad", F.lit(0), lambda a, x: a + x) - this), this))
    if "pl" in entries.columns:
        out["pl"] = _downcoded_pl(F.col("pl"), i, F.col("_n"))
    e = e.withColumns(out)
    if "pl" in out and "gq" in entries.columns and recalculate_gq:
        # from the finished column: the lambdas above must not be evaluated twice in one projection
        e = e.withColumn("gq", F.coalesce(G.gq_from_pl("pl"), F.col("gq")))
    return e.drop("_n")


def allele_data(sites: DataFrame) -> DataFrame:
    """Facts of the whole site for each of its split alleles: nonsplit_alleles, has_star, variant_type, n_alt_alleles,
    allele_type and was_mixed. ``sites`` are split rows with old_alleles."""
    old = F.col("old_alleles")
    return sites.select(
        "*", old.alias("nonsplit_alleles"), F.exists(old, lambda a: a == "*").alias("has_star"), G.variant_type(old).alias("site_type"),
        F.size(F.filter(F.slice(old, 2, F.greatest(F.lit(0), F.size(old) - 1)), lambda a: a != "*")).alias("n_alt_alleles"),
        G.allele_type(F.get("alleles", F.lit(0)), F.get("alleles", F.lit(1))).alias("allele_type"), (G.variant_type(old) == "mixed").alias("was_mixed"),
    )
