"""Readers of delimited text, one per kind of file, all with explicit schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.functions.ids import norm_id

#: VerifyBamID selfSM report.
SELFSM = (
    "`#SEQ_ID` string, RG string, CHIP_ID string, `#SNPS` int, `#READS` int, AVG_DP double, FREEMIX double, FREELK1 double, FREELK0 double, FREE_RH string, FREE_RA string, "
    "CHIPMIX string, CHIPLK1 string, CHIPLK0 string, CHIP_RH string, CHIP_RA string, DPREF string, RDPHET string, RDPALT string"
)
GTCHECK = "dcv2 string, data_sample string, microarray_sample string, discordance double, average_logp double, n_sites long, n_matching_genotypes long"
#: Layouts of headerless consequence files by purpose.
CONSEQUENCES = {
    "consequence": "chr string, pos int, rs string, ref string, alt string, consequence string",
    "gene": "chr string, pos int, rs string, ref string, alt string, csq string, consequence string, gene string, hgnc_id string",
    "control": "chr string, pos int, rs string, ref string, alt string, consequence string, impact string, misc string",
}


def tsv(spark: SparkSession, path: str | list[str], schema: str | None = None, header: bool = True, infer: bool = False, **options: str) -> DataFrame:
    """Tab-separated text. Without a schema all columns are strings (or inferred). Nothing is taken for null but what
    ``nullValue`` says: "NA" and empty fields stay text."""
    reader = spark.read.option("sep", "\t").option("header", header).option("emptyValue", "").option("quote", "").options(**options)
    if schema:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    df = reader.csv(path)
    if not header and schema is None:
        df = df.toDF(*[f"f{k}" for k in range(len(df.columns))])
    if not infer:  # an empty field is the empty string, not null
        df = df.fillna("", [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"])
    return df


def csv_text(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A table with header in which "NA" and empty fields stay text."""
    return spark.read.option("sep", sep).option("header", True).option("emptyValue", "").csv(path).fillna("")


def id_list(spark: SparkSession, path: str, column: str = "s") -> DataFrame:
    return spark.read.text(path).select(F.rtrim("value").alias(column)).where(F.col(column) != "")


def bed(spark: SparkSession, path: str) -> DataFrame:
    """(contig, start, stop), 0-based and half open; comment and track lines are skipped."""
    lines = spark.read.text(path).where("not value rlike '^(#|track|browser|\\\\s*$)'")
    c = F.split("value", "\t|\\s+")
    return lines.select(F.get(c, F.lit(0)).alias("contig"), F.get(c, F.lit(1)).cast("long").alias("start"), F.get(c, F.lit(2)).cast("long").alias("stop"))


def fam(spark: SparkSession, path: str) -> DataFrame:
    """(fam_id, s, pat_id, mat_id, is_female, is_case); 0 is no parent, and sex and state other than 1 and 2 are unknown."""
    c = F.split(F.trim("value"), "\\s+")
    raw = spark.read.text(path).where("not value rlike '^\\\\s*(#|$)'")
    some = lambda k: F.when(F.get(c, F.lit(k)) != "0", F.get(c, F.lit(k)))
    two = lambda k: F.when(F.get(c, F.lit(k)) == "2", True).when(F.get(c, F.lit(k)) == "1", False)
    return raw.select(some(0).alias("fam_id"), F.get(c, F.lit(1)).alias("s"), some(2).alias("pat_id"), some(3).alias("mat_id"), two(4).alias("is_female"), two(5).alias("is_case"))


def trios_of(pedigree: DataFrame) -> DataFrame:
    """Complete trios of a pedigree: (fam_id, kid, dad, mom, is_female)."""
    kept = pedigree.where("pat_id is not null and mat_id is not null")
    return kept.select("fam_id", F.col("s").alias("kid"), F.col("pat_id").alias("dad"), F.col("mat_id").alias("mom"), *(["is_female"] if "is_female" in pedigree.columns else []))


def pedigree_members(pedigree: DataFrame) -> DataFrame:
    return pedigree.select(F.explode(F.array("s", "pat_id", "mat_id")).alias("s")).where("s is not null").distinct()


def founders(pedigree: DataFrame) -> DataFrame:
    """Members that are nobody's child in a complete trio."""
    return pedigree_members(pedigree).join(trios_of(pedigree).select(F.col("kid").alias("s")), "s", "left_anti")


def freemix(spark: SparkSession, path: str) -> DataFrame:
    return tsv(spark, path, SELFSM).withColumnsRenamed({"#SEQ_ID": "s", "FREEMIX": "freemix", "#SNPS": "n_snps", "#READS": "n_reads"})


def reported_sex(spark: SparkSession, path: str) -> DataFrame:
    return tsv(spark, path).select(norm_id("sample_id").alias("s"), F.lower(F.trim("self_reported_sex")).alias("self_reported_sex"))


def reference_populations(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    t = tsv(spark, path)
    return t.select(F.concat(F.lit(prefix), F.col("Sample name")).alias("s"), F.col("Superpopulation code").alias("known_pop"))


def mapping(spark: SparkSession, path: str, data_column: str = "WES_ID", array_column: str = "Microarray_ID") -> DataFrame:
    t = tsv(spark, path)
    return t.select(F.col(data_column).alias("data_sample"), F.col(array_column).alias("microarray_sample"))


def gtcheck(spark: SparkSession, path: str) -> DataFrame:
    """The report's seven columns and line_no, the order of its lines (a report is one file)."""
    lines = spark.read.text(path).where("value not like '#%'")
    parsed = lines.select(F.monotonically_increasing_id().alias("line_no"), F.from_csv("value", GTCHECK, {"sep": "\t"}).alias("r"))
    return parsed.select("line_no", "r.*")


def consequences(spark: SparkSession, path: str | list[str], layout: str = "consequence") -> DataFrame:
    """A headerless consequence file keyed by contig, pos and alleles."""
    t = tsv(spark, path, CONSEQUENCES[layout], header=False)
    return t.select(F.col("chr").alias("contig"), "pos", F.array("ref", "alt").alias("alleles"), *[c for c in t.columns if c not in ("chr", "pos", "ref", "alt")])


def variants_table(df: DataFrame, rename: Mapping[str, str] | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    out = df.withColumnsRenamed(dict(rename or {}))
    return out.select(*keep) if keep else out
