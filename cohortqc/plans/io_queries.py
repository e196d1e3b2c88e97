"""Queries of the readers and writers: what is written and read back must equal the SQL over the tables it came from."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.functions import genetics as G
from cohortqc.operators import split
from cohortqc.plans.domain_queries import _SITES, _sites
from cohortqc.plans.testcohort import WITH, load
from cohortqc.session import read_table, scratch
from cohortqc.sources import sinks, text, vcf

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _written(spark: SparkSession, lines: DataFrame, name: str, header: str | None = None) -> str:
    """A text file with one line per row of (value), and with ``header`` as the first line of each of its parts."""
    path = scratch(spark, name)
    if header is None:
        lines.select("value").write.text(path)
    else:
        columns = [F.split_part("value", F.lit("\t"), F.lit(k + 1)).alias(c) for k, c in enumerate(header.split("\t"))]
        lines.select(*columns).write.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def _tabbed(*columns) -> F.Column:
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c, F.lit("")) for c in columns]).alias("value")


# ---- VCF -----------------------------------------------------------------------------------------------------------------
def _cohort_vcf(spark: SparkSession, sf: str) -> tuple[list[str], vcf.Header]:
    """The derived cohort as VCF files, one folder per contig."""
    c = load(spark, sf)
    sites = c.variants.select("vid", "contig", "pos", F.array("ref", "alt").alias("alleles"), "rf_bin", "qd", "tp")
    call = F.struct((F.col("gt") == 2).cast("int").alias("a0"), (F.col("gt") > 0).cast("int").alias("a1"), F.lit(False).alias("phased"))
    entries = c.entries.join(sites.select("vid", "contig", "pos", "alleles"), "vid").select("contig", "pos", "alleles", F.col("sid").cast("string").alias("s"), call.alias("gt"), F.array("ad_ref", "ad_alt").alias("ad"), "dp", "gq")
    info = [vcf.Field("rf_bin", "1", "Integer"), vcf.Field("qd", "1", "Float"), vcf.Field("tp", "0", "Flag")]
    formats = [vcf.Field("GT", "1", "String"), vcf.Field("AD", "R", "Integer"), vcf.Field("DP", "1", "Integer"), vcf.Field("GQ", "1", "Integer")]
    samples = [str(k) for k in range(25)]
    path = scratch(spark, "cohort")
    vcf.write_by_contig(vcf.vcf_lines(sites, entries, samples, ["rf_bin", "qd", "tp"], ["gt", "ad", "dp", "gq"]), vcf.header_lines(samples, G.CONTIGS, info, formats), path, blocks=True)
    folders = [f for f in vcf.list_files(spark, path, "contig=")]
    return folders, vcf.read_header(spark, folders[0])


@query(f"{WITH} SELECT contig, pos, ref, alt, CAST(sid AS VARCHAR) AS s, CAST(gt = 2 AS INTEGER) AS a0, CAST(gt > 0 AS INTEGER) AS a1, ad_ref, ad_alt, dp, gq FROM ents JOIN vars USING (vid)")
def vcf_entries_round_trip(spark, sf):
    folders, header = _cohort_vcf(spark, sf)
    e = vcf.explode_entries(vcf.read_sites(spark, folders, header), header).where("gt is not null")
    return e.select("contig", "pos", e["alleles"][0].alias("ref"), e["alleles"][1].alias("alt"), "s", "gt.a0", "gt.a1", e["ad"][0].alias("ad_ref"), e["ad"][1].alias("ad_alt"), "dp", "gq")


@query(f"{WITH} SELECT contig, CAST(pos AS INTEGER) AS pos, ref, alt, rf_bin, qd, tp FROM vars")
def vcf_sites_round_trip(spark, sf):
    folders, header = _cohort_vcf(spark, sf)
    v = vcf.read_sites(spark, folders, header, split_samples=False)
    return v.select("contig", "pos", v["alleles"][0].alias("ref"), v["alleles"][1].alias("alt"), "info.rf_bin", "info.qd", "info.tp")


# ---- PLINK ---------------------------------------------------------------------------------------------------------------
@query(f"""{WITH} SELECT contig || ':' || pos || ':' || ref || ':' || alt AS name, count(gt) FILTER (WHERE gt = 2) AS hom_var, count(gt) FILTER (WHERE gt = 1) AS het, count(gt) FILTER (WHERE gt = 0) AS hom_ref, 25 - count(gt) AS missing
  FROM vars LEFT JOIN ents USING (vid) GROUP BY ALL""")
def plink_round_trip(spark, sf):
    c = load(spark, sf)
    path = sinks.path_local(scratch(spark, "cohort"))
    sinks.write_plink(c.entries, c.variants.withColumn("contig_idx", G.contig_idx()), list(range(25)), path)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content").to_pylist():
                raw = np.frombuffer(content, np.uint8)[3:].reshape(-1, 7)
                code = np.stack([raw >> k & 3 for k in (0, 2, 4, 6)], 2).reshape(len(raw), -1)[:, :25]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(raw))), *[pa.array((code == k).sum(1)) for k in (0, 2, 3, 1)]], ["k", "hom_var", "het", "hom_ref", "missing"])

    bed = spark.read.format("binaryFile").load(f"file://{path}.bed").select("content").mapInArrow(counts, "k long, hom_var long, het long, hom_ref long, missing long")
    bim = spark.read.text(f"file://{path}.bim", wholetext=True).select(F.posexplode(F.split(F.rtrim("value"), "\n")).alias("k", "line"))
    return bim.join(bed, "k").select(F.split_part("line", F.lit("\t"), F.lit(2)).alias("name"), "hom_var", "het", "hom_ref", "missing")


# ---- text ----------------------------------------------------------------------------------------------------------------
@query(f'{WITH} SELECT contig, start, "stop" FROM ivals')
def bed_round_trip(spark, sf):
    return text.bed(spark, _written(spark, load(spark, sf).intervals.select(_tabbed("contig", "start", "stop", F.lit("region"))), "x.bed"))


@query(f"{WITH} SELECT fam_id, CAST(kid AS VARCHAR) AS kid, CAST(dad AS VARCHAR) AS dad, CAST(mom AS VARCHAR) AS mom, is_female FROM trios")
def fam_round_trip(spark, sf):
    t = load(spark, sf).trios
    line = lambda s, dad, mom, sex: t.select(_tabbed("fam_id", s, dad, mom, sex, F.lit("-9")))
    lines = line("kid", "dad", "mom", F.when(F.col("is_female"), "2").otherwise("1")).unionByName(line("dad", F.lit("0"), F.lit("0"), F.lit("1"))).unionByName(line("mom", F.lit("0"), F.lit("0"), F.lit("2")))
    return text.trios_of(text.fam(spark, _written(spark, lines, "x.fam")))


@query("SELECT coalesce(data_sample, '') AS data_sample, coalesce(microarray_sample, '') AS microarray_sample, coalesce(discordance, -1) AS discordance, n_sites, n_matching_genotypes FROM gtcheck_results WHERE n_sites IS NOT NULL")
def gtcheck_round_trip(spark, sf):
    r = read_table(spark, sf, "gtcheck_results").where("n_sites is not null")
    lines = r.select(_tabbed("dcv2", "data_sample", "microarray_sample", F.coalesce("discordance", F.lit(-1.0)), "average_logp", "n_sites", "n_matching_genotypes"))
    back = text.gtcheck(spark, _written(spark, lines, "gtcheck.txt"))
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("data_sample", "microarray_sample")], "discordance", "n_sites", "n_matching_genotypes")


@query("SELECT s, round(freemix, 9) AS freemix FROM samples WHERE s IS NOT NULL AND freemix IS NOT NULL")
def freemix_round_trip(spark, sf):
    s = read_table(spark, sf, "samples").where("s is not null and freemix is not null")
    header = "#SEQ_ID\tRG\tCHIP_ID\t#SNPS\t#READS\tAVG_DP\tFREEMIX"
    path = _written(spark, s.select(_tabbed("s", F.lit("NA"), F.lit("NA"), F.lit(1), F.lit(2), F.lit(3.5), "freemix")), "x.selfSM", header)
    return text.freemix(spark, path).select("s", F.round("freemix", 9).alias("freemix"))


@query("SELECT upper(trim(s, ' ')) AS s, lower(trim(self_reported_sex, ' ')) AS self_reported_sex FROM samples WHERE s IS NOT NULL AND self_reported_sex IS NOT NULL")
def sex_round_trip(spark, sf):
    s = read_table(spark, sf, "samples").where("s is not null and self_reported_sex is not null")
    return text.reported_sex(spark, _written(spark, s.select(_tabbed("s", "self_reported_sex")), "sex.tsv", "sample_id\tself_reported_sex"))


@query("SELECT '1kg-' || s AS s, known_pop FROM samples WHERE s IS NOT NULL AND known_pop IS NOT NULL")
def populations_round_trip(spark, sf):
    s = read_table(spark, sf, "samples").where("s is not null and known_pop is not null")
    return text.reference_populations(spark, _written(spark, s.select(_tabbed("s", "known_pop")), "pop.tsv", "Sample name\tSuperpopulation code"), "1kg-")


@query("SELECT coalesce(data_sample, '') AS data_sample, coalesce(microarray_sample, '') AS microarray_sample FROM mapping_file WHERE data_sample IS NOT NULL")
def mapping_round_trip(spark, sf):
    """Absent arrays and the text NA stay text."""
    m = read_table(spark, sf, "mapping_file").where("data_sample is not null")
    return text.mapping(spark, _written(spark, m.select(_tabbed("data_sample", "microarray_sample")), "map.tsv", "WES_ID\tMicroarray_ID"))


@query("SELECT DISTINCT rtrim(microarray_sample, ' ') AS s FROM microarray_ids WHERE trim(microarray_sample, ' ') <> ''")
def id_list_round_trip(spark, sf):
    path = scratch(spark, "ids.txt")
    sinks.write_ids(read_table(spark, sf, "microarray_ids").where("microarray_sample is not null").select("microarray_sample"), path)
    return text.id_list(spark, path).where("trim(s) <> ''").distinct()


@query(f"{WITH} SELECT contig, CAST(pos AS INTEGER) AS pos, ref, alt, consequence FROM vars")
def consequences_round_trip(spark, sf):
    v = load(spark, sf).variants
    c = text.consequences(spark, _written(spark, v.select(_tabbed("contig", "pos", F.lit("."), "ref", "alt", "consequence")), "csq.tsv"))
    return c.select("contig", "pos", c["alleles"][0].alias("ref"), c["alleles"][1].alias("alt"), "consequence")


@query(f"{WITH} SELECT vid, ref || ',' || alt AS alleles, qd, tp FROM vars")
def tsv_export_round_trip(spark, sf):
    """A table with a nested column, written as text with header and read with inferred types."""
    path = scratch(spark, "t.tsv")
    sinks.write_tsv(load(spark, sf).variants.select("vid", F.array("ref", "alt").alias("alleles"), "qd", "tp"), path, files=None)
    back = text.tsv(spark, path, infer=True)
    return back.select(F.col("vid").cast("long").alias("vid"), F.array_join(F.from_json("alleles", "array<string>"), ",").alias("alleles"), F.col("qd").cast("double").alias("qd"), "tp")


@query(f"{WITH} SELECT vid, sid, gt FROM ents")
def table_round_trip(spark, sf):
    """Native tables: written sorted, in folders by genotype, and read back."""
    path = scratch(spark, "entries")
    sinks.write_table(load(spark, sf).entries.select("vid", "sid", "gt"), path, ["gt"], ["vid"])
    back = sinks.checkpoint(spark.read.parquet(path), scratch(spark, "again"))
    return back.select("vid", "sid", F.col("gt").cast("int").alias("gt"))


# ---- entries of split sites ------------------------------------------------------------------------------------------------
# calls, depths and likelihoods of three samples at every site, made up from its position
_MULTI = f"""{_SITES}, m AS (SELECT contig, pos, alleles, CAST(len(alleles) AS BIGINT) AS n, s FROM sites, (SELECT unnest([0, 1, 2]) AS s)),
c AS (SELECT *, least((pos + s) % n, (pos // 7 + 2 * s) % n) AS a0, greatest((pos + s) % n, (pos // 7 + 2 * s) % n) AS a1 FROM m),
al AS (SELECT * FROM (SELECT *, unnest(range(1, n)) AS i FROM c) WHERE alleles[i + 1] <> '*'),
gl AS (SELECT al.contig, al.pos, al.alleles, s, i, (pos * ((k * (k + 1)) // 2 + j + 2 + s)) % 97 AS l, CAST(j = i AS INTEGER) + CAST(k = i AS INTEGER) AS copies FROM al, (SELECT unnest(range(0, 40)) AS k) ks, (SELECT unnest(range(0, 40)) AS j) js WHERE k < n AND j <= k),
pl AS (SELECT contig, pos, alleles, s, i, min(l) FILTER (WHERE copies = 0) AS l0, min(l) FILTER (WHERE copies = 1) AS l1, min(l) FILTER (WHERE copies = 2) AS l2 FROM gl GROUP BY ALL)"""


@query(
    f"""WITH {_MULTI} SELECT al.contig, al.pos, al.alleles[1] AS ref, al.alleles[al.i + 1] AS alt, al.s, CAST(al.i AS INTEGER) AS a_index, least(CAST(a0 = al.i AS INTEGER), CAST(a1 = al.i AS INTEGER)) AS a0, greatest(CAST(a0 = al.i AS INTEGER), CAST(a1 = al.i AS INTEGER)) AS a1,
  list_sum(list_transform(range(0, n), lambda k: (al.pos * (k + 3)) % 50)) - (al.pos * (al.i + 3)) % 50 AS ad_other, (al.pos * (al.i + 3)) % 50 AS ad_this, l0, l1, l2, least(99, list_sort([l0, l1, l2])[2] - list_sort([l0, l1, l2])[1]) AS gq
  FROM al JOIN pl ON pl.contig = al.contig AND pl.pos = al.pos AND pl.alleles = al.alleles AND pl.s = al.s AND pl.i = al.i"""
)
def split_entries(spark, sf):
    sites = _sites(spark, sf).withColumn("site", F.struct("contig", "pos", "alleles"))
    n, pos = F.size("alleles"), F.col("pos").cast("long")
    e = sites.select("site", "pos", "alleles", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("s"))
    x, y = (pos + F.col("s")) % n, (F.floor(pos / 7) + 2 * F.col("s")) % n
    call = F.struct(F.least(x, y).cast("int").alias("a0"), F.greatest(x, y).cast("int").alias("a1"), F.lit(False).alias("phased"))
    ad = F.transform(F.sequence(F.lit(0), n - 1), lambda k: ((pos * (k + 3)) % 50).cast("int"))
    pl = F.transform(F.sequence(F.lit(0), (n * (n + 1) / 2).cast("int") - 1), lambda k: ((pos * (k + 2 + F.col("s"))) % 97).cast("int"))
    e = e.select("site", "s", call.alias("gt"), ad.alias("ad"), pl.alias("pl"), F.lit(0).alias("gq"))
    rows = split.split_sites(sites)
    out = split.split_entries(e, rows.select("site", "a_index", "old_alleles"), recalculate_gq=True)
    alleles = F.col("site.alleles")
    big = lambda c: c.cast("long")
    return out.select(
        "site.contig", "site.pos", alleles[0].alias("ref"), F.get(alleles, F.col("a_index")).alias("alt"), "s", "a_index", "gt.a0", "gt.a1", big(F.col("ad")[0]).alias("ad_other"), big(F.col("ad")[1]).alias("ad_this"),
        *[big(F.col("pl")[k]).alias(f"l{k}") for k in range(3)], big(F.col("gq")).alias("gq"),
    )
