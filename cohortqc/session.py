"""Session helpers: shared-folder materialisation and table access."""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[tuple[SparkSession, str]] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which every executor sees.

    Only where the session names none (single-machine tests) a temporary folder is set.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not (spark.sparkContext.master or "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="cohortqc-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table to the shared folder and read it back.

    This cuts the lineage, survives the loss of executors (the files are not theirs), and lets an
    intermediate result be used several times without being computed again. Columnar files also take
    much less disk than row checkpoints. They are removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if not _WRITTEN:
        atexit.register(clear_tables)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed with the materialised tables."""
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}/{name}"
    if not _WRITTEN:
        atexit.register(clear_tables)
    _WRITTEN.append((spark, path.rsplit("/", 1)[0]))
    return path


def release(*dfs: DataFrame) -> None:
    """Remove materialised tables that no later plan reads."""
    for df in dfs:
        files = set(df.inputFiles())
        for spark, path in list(_WRITTEN):
            if any(path.rsplit("/", 1)[-1] in f for f in files):
                _delete(spark, path)
                _WRITTEN.remove((spark, path))


def free_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs removed now, not when the driver happens to collect its garbage."""
    for _ in range(2):  # a finished job is held until its last event has been handled
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear_tables() -> None:
    """Remove all materialised tables; for long sessions, once their results have been used."""
    for spark, path in _WRITTEN:
        try:
            _delete(spark, path)
        except Exception:  # the session may have ended before
            pass
    _WRITTEN.clear()


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Rows of a table that must stay small; raises instead of cutting it off."""
    rows = df.take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows")
    return rows
