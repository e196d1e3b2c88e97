"""Column functions on alleles, calls and loci. Every predicate is null where an input is null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

AUTOSOMES = [f"chr{k}" for k in range(1, 23)]
CONTIGS = [*AUTOSOMES, "chrX", "chrY"]
#: Pseudo-autosomal regions of chrX in build 38 (fixed values, 1-based, inclusive).
X_PAR = ((10_001, 2_781_479), (155_701_383, 156_030_895))
#: The same of chrY.
Y_PAR = ((10_001, 2_781_479), (56_887_903, 57_217_415))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---- alleles -------------------------------------------------------------------------------------------------
def is_star(alt: Column | str) -> Column:
    return _c(alt) == "*"


def differing_bases(ref: Column | str, alt: Column | str) -> Column:
    """Number of positions at which two alleles of one length differ."""
    r, a = _c(ref), _c(alt)
    at = F.sequence(F.lit(1), F.greatest(F.lit(1), F.char_length(r)))
    return F.size(F.filter(at, lambda k: F.substr(r, k, F.lit(1)) != F.substr(a, k, F.lit(1))))


def is_snp(ref: Column | str = "ref", alt: Column | str = "alt") -> Column:
    """Same length, exactly one base differs."""
    r, a = _c(ref), _c(alt)
    one = (F.char_length(r) == 1) & (F.char_length(a) == 1) & (r != a) & (a != "*")
    return one | ((F.char_length(r) > 1) & (F.char_length(r) == F.char_length(a)) & (differing_bases(r, a) == 1))


def is_insertion(ref: Column | str = "ref", alt: Column | str = "alt") -> Column:
    r, a = _c(ref), _c(alt)
    return (F.char_length(a) > F.char_length(r)) & (F.left(r, F.lit(1)) == F.left(a, F.lit(1))) & (a != "*")


def is_deletion(ref: Column | str = "ref", alt: Column | str = "alt") -> Column:
    r, a = _c(ref), _c(alt)
    return (F.char_length(a) < F.char_length(r)) & (F.left(r, F.lit(1)) == F.left(a, F.lit(1))) & (a != "*")


def is_indel(ref: Column | str = "ref", alt: Column | str = "alt") -> Column:
    return is_insertion(ref, alt) | is_deletion(ref, alt)


def is_transition(ref: Column | str = "ref", alt: Column | str = "alt") -> Column:
    """A<->G or C<->T of a single-base exchange."""
    return is_snp(ref, alt) & F.concat(_c(ref), F.lit(">"), _c(alt)).isin("A>G", "G>A", "C>T", "T>C")


def is_transversion(ref: Column | str = "ref", alt: Column | str = "alt") -> Column:
    return is_snp(ref, alt) & ~is_transition(ref, alt)


def is_palindromic(ref: Column | str = "ref", alt: Column | str = "alt") -> Column:
    """The pair of alleles is the same on either strand."""
    return F.concat(_c(ref), _c(alt)).isin("GC", "CG", "AT", "TA")


def allele_class(ref: Column | str = "ref", alt: Column | str = "alt") -> Column:
    """snv, indel or other."""
    return F.when(is_snp(ref, alt), "snv").when(is_indel(ref, alt), "indel").otherwise("other")


def allele_type(ref: Column | str = "ref", alt: Column | str = "alt") -> Column:
    """snv, ins, del, star or complex."""
    return (
        F.when(is_star(alt), "star").when(is_snp(ref, alt), "snv").when(is_insertion(ref, alt), "ins").when(is_deletion(ref, alt), "del").otherwise("complex")
    )


def indel_length(ref: Column | str = "ref", alt: Column | str = "alt") -> Column:
    return F.abs(F.char_length(_c(ref)) - F.char_length(_c(alt)))


def variant_type(alleles: Column | str) -> Column:
    """snv, multi-snv, indel, multi-indel or mixed of all alternative alleles of a site (star alleles aside)."""
    a = _c(alleles)
    alts = F.filter(F.slice(a, 2, F.greatest(F.lit(0), F.size(a) - 1)), lambda x: x != "*")
    ref = F.get(a, F.lit(0))
    snvs = F.size(F.filter(alts, lambda x: F.char_length(x) == F.char_length(ref)))
    n = F.size(alts)
    return (
        F.when((snvs == n) & (n == 1), "snv").when((snvs == n) & (n > 1), "multi-snv").when((snvs == 0) & (n == 1), "indel").when((snvs == 0) & (n > 1), "multi-indel").when(n > 1, "mixed")
    )


# ---- calls (gt: number of alternative alleles of an unphased diploid call) -----------------------------------------
def is_hom_ref(gt: Column | str = "gt") -> Column:
    return _c(gt) == 0


def is_het(gt: Column | str = "gt") -> Column:
    return _c(gt) == 1


def is_hom_var(gt: Column | str = "gt") -> Column:
    return _c(gt) == 2


def is_non_ref(gt: Column | str = "gt") -> Column:
    return _c(gt) > 0


def n_alt(call: Column | str) -> Column:
    """Alternative alleles of struct(a0, a1, phased); null if there is no call."""
    c = _c(call)
    return (c["a0"] > 0).cast("int") + (c["a1"] > 0).cast("int")


def downcode(call: Column | str, allele: Column | int) -> Column:
    """Copies of one alternative allele in struct(a0, a1, phased)."""
    c, i = _c(call), allele if isinstance(allele, Column) else F.lit(allele)
    return (c["a0"] == i).cast("int") + (c["a1"] == i).cast("int")


def genotype_index(j: Column, k: Column) -> Column:
    """Position of the unphased genotype j/k (j <= k) in a list of likelihoods."""
    return (k * (k + 1) / 2).cast("int") + j


def gq_from_pl(pl: Column | str) -> Column:
    """The second smallest likelihood less the smallest, at most 99."""
    s = F.sort_array(F.filter(_c(pl), lambda x: x.isNotNull()))
    gap = F.get(s, F.lit(1)) - F.get(s, F.lit(0))
    return F.when(gap.isNotNull(), F.least(F.lit(99), gap))


def het_ab(gt: Column | str = "gt", ad_alt: Column | str = "ad_alt", sum_ad: Column | str = "dp") -> Column:
    """Allele balance of heterozygous calls; null for all others and where no read was counted."""
    s = _c(sum_ad)
    return F.when(is_het(gt) & (s != 0), _c(ad_alt).cast("double") / F.nullif(s, F.lit(0)))


def adj_pass(gt: Column | str = "gt", gq: Column | str = "gq", dp: Column | str = "dp", ab: Column | None = None) -> Column:
    """High-quality genotype: GQ >= 20, DP >= 10 and, if heterozygous, allele balance >= 0.2."""
    ab = het_ab(gt) if ab is None else ab
    return (_c(gq) >= 20) & (_c(dp) >= 10) & (~is_het(gt) | (ab >= 0.2))


# ---- loci -------------------------------------------------------------------------------------------------------
def contig_idx(contig: Column | str = "contig") -> Column:
    """1..22 for autosomes, 23 X, 24 Y, 25 M; null for any other."""
    name = F.regexp_replace(_c(contig), "^chr", "")
    number = F.try_to_number(F.when(name.rlike("^[0-9]{1,2}$"), name), F.lit("99")).cast("int")
    return F.when(number.between(1, 22), number).when(name == "X", 23).when(name == "Y", 24).when(name.isin("M", "MT"), 25)


def in_autosome(contig: Column | str = "contig") -> Column:
    return contig_idx(contig).between(1, 22)


def in_x_nonpar(contig: Column | str = "contig", pos: Column | str = "pos") -> Column:
    return (contig_idx(contig) == 23) & ~reduce(lambda a, b: a | b, [_c(pos).between(lo, hi) for lo, hi in X_PAR])


def in_y_nonpar(contig: Column | str = "contig", pos: Column | str = "pos") -> Column:
    return (contig_idx(contig) == 24) & ~reduce(lambda a, b: a | b, [_c(pos).between(lo, hi) for lo, hi in Y_PAR])


def parse_interval(text: str) -> tuple[str, int | None, int | None]:
    """'chr20' or 'chr20:100-200' as (contig, first, last)."""
    contig, _, span = text.partition(":")
    if not span:
        return contig, None, None
    first, _, last = span.replace(",", "").partition("-")
    return contig, int(first), int(last)


def in_intervals(intervals: str | list[str], contig: Column | str = "contig", pos: Column | str = "pos") -> Column:
    """Whether any of a few given intervals holds the locus (for tables of intervals see operators.joins)."""
    tests = []
    for name, lo, hi in map(parse_interval, [intervals] if isinstance(intervals, str) else intervals):
        here = _c(contig) == name
        tests.append(here if lo is None else here & _c(pos).between(lo, hi))
    return reduce(lambda a, b: a | b, tests, F.lit(False))
