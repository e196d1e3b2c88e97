"""Export of tier-filtered cohorts as VCF, one folder per contig, in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortqc.functions.genetics import CONTIGS
from cohortqc.operators.tiers import TIERS
from cohortqc.sources import vcf


def describe(filters: Mapping, tier: str) -> str:
    """The thresholds of one tier in words, for the header."""
    text = []
    for kind, name in (("snp", "SNPs"), ("indel", "Indels")):
        t = filters[kind][tier]
        text.append(f"{name}: RF bin<={t['bin']} & DP>={t['dp']} & GQ>={t['gq']} & HetAB>={t['ab']} & Call_Rate>={t['call_rate']}")
    return ", ".join(text)


def info_fields(filters: Mapping, model_id: str, tiers: Sequence[str] = TIERS) -> list[vcf.Field]:
    out = []
    for t in tiers:
        out += [vcf.Field(f"{t}_AN", "1", "Integer", f"Alleles in called genotypes that pass the {t} filters")]
        out += [vcf.Field(f"{t}_{m}", "A", "Integer", f"Alternative alleles {where} that pass the {t} filters") for m, where in (("AC", "in genotypes"), ("AC_Hom", "in homozygous genotypes"), ("AC_Het", "in heterozygous genotypes"))]
        out += [vcf.Field(f"fraction_pass_{t}_filters", "A", "Float", f"Fraction of genotypes that pass the {t} filters: {describe(filters, t)}")]
    return [*out, vcf.Field("rf_bin", "A", "Integer", f"Bin of the random forest, model {model_id}"), vcf.Field("rf_score", "A", "Float", f"Score of the random forest, model {model_id}"), vcf.Field("consequence", "A", "String", "Consequence")]


def _formats(names: Sequence[str]) -> list[vcf.Field]:
    known = {"gt": ("1", "String", "Genotype"), "dp": ("1", "Integer", "Depth"), "gq": ("1", "Integer", "Genotype quality"), "ad": ("R", "Integer", "Depth per allele")}
    return [vcf.Field(n.upper(), *known.get(n, ("1", "String", f"{n} of this genotype"))) for n in names]


def _write(variants: DataFrame, entries: DataFrame, samples: Sequence[str], fields: Sequence[vcf.Field], formats: Sequence[str], path: str, contigs: Sequence[str]) -> None:
    info = [f for f in fields if f.name in variants.columns]
    lines = vcf.vcf_lines(variants, entries, samples, [f.name for f in info], formats)
    vcf.write_by_contig(lines, vcf.header_lines(samples, contigs, info, _formats(formats)), path, contigs, blocks=True)


def export_tiers(variants: DataFrame, entries: DataFrame, samples: Sequence[str], filters: Mapping, model_id: str, path: str, contigs: Sequence[str] = CONTIGS) -> None:
    """All variants of which some genotype passes the relaxed filters; each genotype carries its three tags.

    ``variants``: contig, pos, alleles and the columns of tiers.annotate; ``entries``: contig, pos, alleles, s, gt (a
    call), dp, gq and <tier>_filters. A tag that is unknown is written as missing.
    """
    kept = variants.where(F.col("fraction_pass_relaxed_filters") > 0)
    _write(kept, entries, samples, info_fields(filters, model_id), ["gt", "dp", "gq", *[f"{t}_filters" for t in TIERS]], path, contigs)


def export_stringent(variants: DataFrame, entries: DataFrame, samples: Sequence[str], filters: Mapping, model_id: str, path: str, contigs: Sequence[str] = CONTIGS) -> None:
    """Only variants and genotypes that pass the stringent filters; all other genotypes are missing."""
    kept = variants.where(F.col("fraction_pass_stringent_filters") > 0)
    passing = entries.where(F.col("stringent_filters") == "Pass")
    _write(kept, passing, samples, info_fields(filters, model_id, ["stringent"]), ["gt", "dp", "gq"], path, contigs)
