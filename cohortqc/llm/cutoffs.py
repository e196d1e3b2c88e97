"""Score cutoff per source that keeps a target fraction (problem 4).

Multi-sequence selection: every task turns its rows into locally sorted score arrays, one or more per source,
which are written once. Rounds then narrow each source's range: the arrays' own medians within the range,
weighted by their lengths, give pivots; a searchsorted of the pivots in every array and one sum per source give
the pivots' global ranks; ranges shrink to the gap between two pivots that holds the target rank, until a pivot
itself does. Nothing is sorted globally; what travels is a few numbers per source and array.

State on the driver is one small record per row of the target table (14 in this project; TARGETS at most).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortqc.functions.ids import is_number
from cohortqc.session import bounded_rows, materialize, release

TARGETS = 100_000
#: Scores of one sorted array.
ARRAY_SCORES = 250_000
#: Pivots per source and round.
PIVOTS = 7


def _sorted_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: dict[str, list[np.ndarray]] = {}
    held: dict[str, int] = {}

    def flush(source: str) -> pa.RecordBatch:
        scores = np.sort(np.concatenate(waiting.pop(source)))
        del held[source]
        return pa.RecordBatch.from_arrays([pa.array([source]), pa.array([scores.tobytes()], pa.binary()), pa.array([len(scores)], pa.int64())], ["source", "scores", "n"])

    for batch in batches:
        if not batch.num_rows:
            continue
        code, names = pd.factorize(batch.column("source").to_pandas())
        order = np.argsort(code, kind="stable")
        scores = batch.column("score").to_numpy(zero_copy_only=False)[order]
        for name, part in zip(names, np.split(scores, np.cumsum(np.bincount(code))[:-1]), strict=True):
            waiting.setdefault(name, []).append(part)
            held[name] = held.get(name, 0) + len(part)
            if held[name] >= ARRAY_SCORES:
                yield flush(name)
    for name in list(waiting):
        yield flush(name)


def _active(scores: np.ndarray, lo: float, hi: float) -> np.ndarray:
    return scores[np.searchsorted(scores, lo, "right") : np.searchsorted(scores, hi, "left")]


def _candidates(bounds: dict[str, tuple[float, float]]):
    """Of each array, scores inside (lo, hi), spaced so that each stands for about as many scores in any array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, values = [], []
            for name, raw in zip(batch.column("source").to_pylist(), batch.column("scores"), strict=True):
                if name in bounds:
                    live = _active(np.frombuffer(raw.as_buffer(), np.float64), *bounds[name])
                    step = max(1, min(ARRAY_SCORES // 64, len(live) // (PIVOTS + 1)))
                    values += (picked := live[step // 2 :: step].tolist())
                    names += [name] * len(picked)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.float64())], ["source", "value"])

    return run


def _ranks(pivots: dict[str, np.ndarray]):
    """Of each array, the number of scores below and not above each pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, raw in zip(batch.column("source").to_pylist(), batch.column("scores"), strict=True):
                if name in pivots:
                    scores = np.frombuffer(raw.as_buffer(), np.float64)
                    both = np.stack([np.searchsorted(scores, pivots[name], "left"), np.searchsorted(scores, pivots[name], "right")])
                    total[name] = total.get(name, 0) + both
        rows = [(n, k, int(t[0, k]), int(t[1, k])) for n, t in total.items() for k in range(t.shape[1])]
        cols = list(zip(*rows, strict=True)) or [[], [], [], []]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["source", "k", "below", "upto"])

    return run


def select_ranks(rows: DataFrame, targets: dict[str, int | float]) -> dict[str, tuple[float, int]]:
    """Of each source, the smallest occurring score c with 100 * #(score <= c) >= percent * n; and n.

    ``rows``: (source string, score double), scores finite.
    """
    arrays = materialize(rows.select("source", "score").where(F.col("source").isin(*targets)).mapInArrow(_sorted_arrays, "source string, scores binary, n long"))
    sizes = {r["source"]: r["n"] for r in arrays.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    want = {s: max(1, math.ceil(Fraction(targets[s]) * n / 100)) for s, n in sizes.items()}
    open_ = {s: (-math.inf, math.inf) for s in sizes if want[s] <= sizes[s]}
    done: dict[str, tuple[float, int]] = {}
    while open_:
        pivots_of = F.expr(f"percentile_approx(value, array({', '.join(str((k + 1) / (PIVOTS + 1)) for k in range(PIVOTS))}), 1000)")
        chosen = arrays.mapInArrow(_candidates(dict(open_)), "source string, value double").groupBy("source").agg(pivots_of.alias("pivots"))
        pivots = {r["source"]: np.unique(r["pivots"]) for r in chosen.collect()}
        counted = arrays.mapInArrow(_ranks(pivots), "source string, k int, below long, upto long")
        for r in counted.groupBy("source", "k").agg(F.sum("below").alias("below"), F.sum("upto").alias("upto")).collect():
            s, p = r["source"], float(pivots[r["source"]][r["k"]])
            if r["below"] < want[s] <= r["upto"]:
                done[s] = (p, sizes[s])
                open_.pop(s, None)
            elif s in open_:
                lo, hi = open_[s]
                open_[s] = (max(lo, p), hi) if r["upto"] < want[s] else (lo, min(hi, p))
    release(arrays)
    return done


def latest_records(rf: DataFrame) -> DataFrame:
    """Of several rows of one (rank_id, vid) the one loaded last (then the largest row_id); with its source."""
    last = rf.groupBy("rank_id", "vid").agg(F.max_by(F.struct("score", "is_snv", "bin"), F.struct("loaded_at", "row_id")).alias("r"))
    kind = F.when(F.col("r.is_snv"), "snv").when(~F.col("r.is_snv"), "indel")
    return last.select("rank_id", "vid", kind.alias("var_class"), F.col("r.score").alias("score"), F.col("r.bin").alias("bin"))


def keep_share(rf: DataFrame, rank_targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cutoffs per source and the kept records.

    Cutoffs: (rank_id, var_class, keep_percent, n, cutoff, kept, max_bin), one row per target; records: (rank_id,
    vid, var_class, score, bin).

    Defined results: records whose score is null, NaN or outside 0 to 1 are left out after the latest row was
    chosen (a null loaded_at is the earliest); records of a source without target (also a null rank_id or is_snv)
    are not kept; a source without records has a null cutoff and keeps none, as does a target above 100 percent;
    ties at the cutoff are all kept; other columns are not looked at.
    """
    goals = bounded_rows(
        rank_targets.where("rank_id is not null and var_class is not null and keep_percent is not null").select("rank_id", "var_class", "keep_percent").distinct(),
        TARGETS,
        "targets",
    )
    spark = rf.sparkSession
    source = lambda: F.concat_ws("/", "rank_id", "var_class")
    records = materialize(latest_records(rf).where(is_number("score") & F.col("score").between(0.0, 1.0) & F.col("var_class").isNotNull() & F.col("rank_id").isNotNull()))
    found = select_ranks(records.select(source().alias("source"), "score"), {f"{g['rank_id']}/{g['var_class']}": g["keep_percent"] for g in goals})
    rows = [(g["rank_id"], g["var_class"], g["keep_percent"], *reversed(found.get(f"{g['rank_id']}/{g['var_class']}", (None, 0)))) for g in goals]
    cutoffs = spark.createDataFrame(rows, "rank_id string, var_class string, keep_percent int, n long, cutoff double")
    small = F.broadcast(cutoffs.select("rank_id", "var_class", "cutoff"))  # at most TARGETS rows
    kept = records.join(small, ["rank_id", "var_class"]).where("score <= cutoff").drop("cutoff")
    report = kept.groupBy("rank_id", "var_class").agg(F.count("*").alias("kept"), F.max("bin").alias("max_bin"))
    return cutoffs.join(report, ["rank_id", "var_class"], "left").fillna(0, ["kept"]), kept
