"""An extension: cohort tables that grow from a folder into which VCF lines are dropped.

Each file is taken once (the checkpoint knows which); its lines are parsed as in a batch scan and appended to a table
partitioned by batch, so that a repeated batch replaces itself and nothing is stored twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortqc.sources.vcf import Header, call_struct


def parse_stream(lines: DataFrame, header: Header) -> DataFrame:
    """(contig, pos, alleles, s, gt) of each sample's call in lines of text."""
    cols = F.split("value", "\t")
    at = lambda k: F.get(cols, F.lit(k))
    names = F.array(*[F.lit(s) for s in header.samples])
    calls = F.slice(cols, 10, F.greatest(F.lit(0), F.size(cols) - 9))
    rows = lines.where("value not like '#%' and value <> ''").select(at(0).alias("contig"), at(1).cast("int").alias("pos"), F.concat(F.array(at(3)), F.split(at(4), ",")).alias("alleles"), F.posexplode(calls).alias("k", "call"))
    return rows.select("contig", "pos", "alleles", F.get(names, F.col("k")).alias("s"), call_struct(F.split_part("call", F.lit(":"), F.lit(1))).alias("gt"))


def ingest(spark: SparkSession, folder: str, header: Header, table: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Takes what is in the folder now and ends; to be run again for later files."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)

    def store(batch: DataFrame, number: int) -> None:
        parse_stream(batch, header).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(table)

    return lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def call_counts(spark: SparkSession, table: str) -> DataFrame:
    """Calls per variant of all batches so far; a call delivered again counts once."""
    e = spark.read.parquet(table).groupBy("contig", "pos", "alleles", "s").agg(F.max_by("gt", "batch").alias("gt"))
    return e.groupBy("contig", "pos", "alleles").agg(F.count("gt").alias("n_called"), F.count_if((F.col("gt.a0") > 0) | (F.col("gt.a1") > 0)).alias("n_non_ref"))
