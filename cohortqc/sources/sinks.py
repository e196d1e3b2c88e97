"""Writers of tables, lists, JSON and PLINK files, and small registries."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Callable, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort: Sequence[str] = ()) -> None:
    """Parquet, replaced; sorted within files so that row-group statistics prune scans by locus."""
    out = df.sortWithinPartitions(*sort) if sort else df
    out.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def checkpoint(df: DataFrame, path: str) -> DataFrame:
    """Write a table and go on from the file."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    nested = ("array", "struct", "map")
    return df.select(*[F.to_json(c).alias(c) if t.startswith(nested) else F.col(f"`{c}`") for c, t in df.dtypes])


def write_tsv(df: DataFrame, path: str, compression: str = "gzip", header: bool = True, files: int | None = 1) -> None:
    """Tab-separated text without quoting. ``files``: 1 for reports; None keeps the partitions of large tables."""
    out = flat(df)
    (out if files is None else out.coalesce(files)).write.mode("overwrite").option("sep", "\t").option("header", header).option("quote", "").option("compression", compression).csv(path)


def write_ids(df: DataFrame, path: str) -> None:
    """One id per line."""
    df.select(F.col(df.columns[0]).cast("string").alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_values(values: Sequence[float], path: str) -> None:
    """One value per line, such as eigenvalues."""
    Path(path_local(path)).write_text("".join(f"{v}\n" for v in values))


#: Columns of a table of grid metrics and what they are called in the file.
_METRICS = {
    "point": "filter", "bin": "bin", "DP": "DP", "GQ": "GQ", "AB": "AB", "call_rate": "call_rate", "TP_percent": "TP", "FP_percent": "FP", "mendelian_error_mean": "mendelian_error_mean",
    "mendelian_error_std": "mendelian_error_std", "prec": "precision", "recall": "recall",
}
_MORE = {"snv": {"t_u_ratio": "t_u_ratio"}, "indel": {f"{m}_{k}": f"{n}_{k}" for k in ("frameshift", "inframe") for m, n in (("prec", "precision"), ("recall", "recall"))}}


def filter_metrics_table(metrics: DataFrame, kind: str) -> DataFrame:
    """The metrics of a grid in the order of its file; which columns follow depends on the kind of variants. A metric that
    was not computed is left empty."""
    names = _METRICS | _MORE[kind]
    return metrics.select(*[(F.col(c) if c in metrics.columns else F.lit(None).cast("double")).alias(n) for c, n in names.items()])


def write_filter_metrics(metrics: DataFrame, path: str, kind: str) -> None:
    write_tsv(filter_metrics_table(metrics, kind), path, compression="none")


def write_globals(values: dict, path: str) -> None:
    Path(path_local(path)).parent.mkdir(parents=True, exist_ok=True)
    Path(path_local(path)).write_text(json.dumps(values, indent=2, sort_keys=True))


def read_json(path: str) -> dict:
    """A registry's content, empty if there is none yet."""
    p = Path(path_local(path))
    return json.loads(p.read_text()) if p.exists() else {}


def add_run(path: str, model_id: str, run: dict) -> dict:
    """Adds one run to the registry of model runs; earlier runs stay."""
    runs = read_json(path) | {model_id: run}
    write_globals(runs, path)
    return runs


# ---- cached results per grid point -------------------------------------------------------------------------------------
def cached(folder: str, var_type: str, name: str, compute: Callable[[], dict]) -> dict:
    """A result kept as <var_type>_hardfilters_<name>.json holding {name: result}; computed only if the file is not there."""
    path = Path(path_local(folder)) / f"{var_type}_hardfilters_{name}.json"
    if path.exists():
        return json.loads(path.read_text())[name]
    result = compute()
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({name: result}))
    return result


def missing_points(grid: DataFrame, results: DataFrame | None) -> DataFrame:
    """Grid points without a stored result, for a table of results that only grows."""
    return grid if results is None else grid.join(results.select("point"), "point", "left_anti")


# ---- PLINK ---------------------------------------------------------------------------------------------------------------
def write_plink(entries: DataFrame, variants: DataFrame, samples: Sequence, path: str, batch: int = 1024) -> None:
    """path.bed, .bim and .fam in genomic order; family, individual and sample id are the same.

    Variants are packed (two bits a call) where they are; every task writes its range of variants as a segment to a folder
    beside the files, and the segments are joined in order, as the format demands one file. ``path`` must be a
    folder that all executors see.
    """
    at = {s: k for k, s in enumerate(samples)}
    width = (len(at) + 3) // 4
    calls = entries.where("gt between 0 and 2").groupBy("vid").agg(F.collect_list(F.struct("sid", "gt")).alias("calls"))
    rows = variants.join(calls, "vid", "left").select("vid", "contig", "contig_idx", "pos", "ref", "alt", "calls")
    parts = max(1, int(variants.count() // (batch * 64)))
    order = ("contig_idx", "pos", "ref", "alt")
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    local = path_local(path)
    os.makedirs(os.path.dirname(local) or ".", exist_ok=True)
    segments = f"{local}.segments"
    shutil.rmtree(segments, ignore_errors=True)
    os.makedirs(segments)
    known = pa.array(list(at), entries_type(entries))

    def pack(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        code = np.array([3, 2, 0], np.uint8)  # by number of alternative alleles; the first allele is the alternative one
        name, n = os.path.join(segments, f"{task.partitionId():08d}"), 0
        own = f"{name}.{task.taskAttemptId()}"
        with open(f"{own}.bed", "wb") as bed, open(f"{own}.bim", "w") as bim:
            for b in batches:
                g = np.full((b.num_rows, width * 4), 1, np.uint8)
                g[:, len(at) :] = 0
                lists = b.column("calls")
                flat = lists.flatten()
                row = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy())) if not lists.null_count else np.repeat(np.arange(b.num_rows), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
                place = pc.index_in(flat.field("sid"), value_set=known)
                keep = place.is_valid().to_numpy(zero_copy_only=False)
                g[row[keep], place.fill_null(0).to_numpy()[keep]] = code[flat.field("gt").to_numpy(zero_copy_only=False)[keep].astype(int)]
                q = g.reshape(b.num_rows, width, 4)
                bed.write((q[:, :, 0] | q[:, :, 1] << 2 | q[:, :, 2] << 4 | q[:, :, 3] << 6).tobytes())
                for contig, pos, ref, alt in zip(*(b.column(c).to_pylist() for c in ("contig", "pos", "ref", "alt")), strict=True):
                    bim.write(f"{contig.removeprefix('chr')}\t{contig}:{pos}:{ref}:{alt}\t0\t{pos}\t{alt}\t{ref}\n")
                n += b.num_rows
        for end in ("bim", "bed"):  # a repeated attempt replaces the same content
            os.replace(f"{own}.{end}", f"{name}.{end}")
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    ordered.mapInArrow(pack, "n long").agg(F.sum("n")).collect()
    for end, magic in (("bed", bytes([0x6C, 0x1B, 0x01])), ("bim", b"")):
        with open(f"{local}.{end}", "wb") as out:
            out.write(magic)
            for name in sorted(f for f in os.listdir(segments) if f.count(".") == 1 and f.endswith(end)):
                with open(os.path.join(segments, name), "rb") as part:
                    shutil.copyfileobj(part, out)
    shutil.rmtree(segments)
    with open(f"{local}.fam", "w") as f:
        f.writelines(f"{s}\t{s}\t0\t0\t0\t-9\n" for s in samples)


def entries_type(entries: DataFrame) -> pa.DataType:
    """The Arrow type of the samples' ids."""
    return {"int": pa.int32(), "bigint": pa.int64(), "smallint": pa.int16(), "tinyint": pa.int8()}.get(dict(entries.dtypes)["sid"], pa.string())


# ---- paths and folders ---------------------------------------------------------------------------------------------------
def resolve(spark: SparkSession, path: str) -> str:
    """The full URI of a path on whatever file system its scheme, or the session's default, names."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    given = jvm.org.apache.hadoop.fs.Path(path)
    return str(given.getFileSystem(conf).makeQualified(given).toString())


def path_local(path: str) -> str:
    """The name under which this machine knows a file: URI or plain path; other schemes have none."""
    scheme, _, rest = path.rpartition(":") if "://" in path or path.startswith("file:") else ("", "", path)
    if scheme not in ("", "file"):
        raise ValueError(f"not a local path: {path}")
    return "/" + rest.lstrip("/") if scheme else rest


def clear_folder(path: str) -> None:
    """Empties a temporary folder, only if it is given as file:// URI."""
    if path.startswith("file://"):
        shutil.rmtree(path_local(path), ignore_errors=True)


def make_folders(root: str, names: Sequence[str]) -> list[str]:
    made = [os.path.join(path_local(root), n) for n in names]
    for m in made:
        os.makedirs(m, exist_ok=True)
    return made


def model_path(rf_dir: str, data: str = "rf_result", model_id: str | None = None) -> str:
    """Where a run keeps its 'training' rows, its 'model' or its 'rf_result'."""
    if not model_id:
        raise ValueError("a model id is needed")
    return os.path.join(rf_dir, model_id, "rf.model" if data == "model" else f"{data}.parquet")


def audit(spark: SparkSession, path: str, step: str, note: str = "") -> DataFrame:
    """Adds a row to an append-only trail of analysis steps and returns the trail."""
    row = spark.createDataFrame([(step, note)], "step string, note string").withColumn("at", F.current_timestamp())
    row.write.mode("append").parquet(path)
    return spark.read.parquet(path).orderBy("at")
