"""Top N items within every group (problem 5).

Simultaneous per-group bisection: every row has an order-preserving code, its score's bits followed by its
identifier. All groups of a task keep one interval each; a pass counts, for all groups at once, the rows not above
the interval's midpoint and halves the interval, until the cutoff admits exactly N rows.

Scale: the task that first sees a part of a group (after copies fell together, where rows are spread by pair, not
by group) already cuts it to N rows. A group with a third of all rows therefore reaches the second step with at
most N rows per task, and no hot group needs to be known. No group is sorted and none is collected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortqc.functions.ids import is_finite, norm_id


#: Rows that a task gathers before it cuts them.
CUT_ROWS = 2_000_000
#: Rows that a task of the second step should get at most.
TASK_ROWS = 1_000_000


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """int64 codes that order as the doubles do (-0.0 as 0.0)."""
    bits = (np.asarray(x, np.float64) + 0.0).view(np.int64)
    return np.where(bits < 0, np.int64(-(2**63)) - bits, bits)


def _halve(group: np.ndarray, code: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Of each group, the smallest cutoff c with at least want rows of code <= c; groups hold enough rows.

    A row above its group's interval, or not above it, has been decided and leaves the scan.
    """
    n = len(want)
    lo, hi = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(lo, group, code)
    np.maximum.at(hi, group, code)
    below = np.zeros(n, np.int64)
    while len(group):
        mid = (lo & hi) + ((lo ^ hi) >> 1)  # floor of the mean without overflow
        under = code <= mid[group]
        count = below + np.bincount(group[under], minlength=n)
        enough = count >= want
        hi = np.where(enough, mid, hi)
        below = np.where(enough, below, count)
        lo = np.where(enough, lo, np.minimum(mid, hi - 1) + 1)
        stay = (under == enough[group]) & (lo[group] < hi[group])
        group, code = group[stay], code[stay]
    return hi


def bisect_top(group: np.ndarray, score: np.ndarray, ident: np.ndarray, n: int) -> np.ndarray:
    """Mask of the n rows of each group with the smallest (score, ident); ident is unique within a group."""
    size = np.bincount(group)
    want = np.minimum(size, n)
    if (size <= n).all():
        return np.ones(len(group), bool)
    code = ordered_bits(score)
    cut = _halve(group, code, want)[group]  # score part of the cutoff
    keep = code < cut
    tied = np.flatnonzero(code == cut)
    rest = want - np.bincount(group[keep], minlength=len(want))
    at = group[tied]
    keep[tied] = ident[tied] <= _halve(at, ident[tied], rest)[at]  # identifier part, among the ties
    return keep


def _cut(n: int, last: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for batch in batches:  # cutting on the way bounds the memory: what was cut cannot come back
            parts.append(batch)
            rows += batch.num_rows
            if rows > CUT_ROWS:
                kept = _kept(pa.Table.from_batches(parts), n)
                if not last and kept.num_rows > CUT_ROWS // 2:  # mostly small groups: they are decided in the next step
                    yield from kept.to_batches(max_chunksize=100_000)
                    kept = kept.slice(0, 0)
                parts, rows = kept.to_batches(), kept.num_rows if not last else 0
        if parts:
            kept = _kept(pa.Table.from_batches(parts), n)
            yield from (_placed(kept) if last else kept).to_batches(max_chunksize=100_000)

    return run


def _groups(table: pa.Table) -> np.ndarray:
    return pd.factorize(table["grp"].to_pandas())[0]


def _kept(table: pa.Table, n: int) -> pa.Table:
    if not table.num_rows:
        return table
    return table.filter(pa.array(bisect_top(_groups(table), table["score"].to_numpy(), table["ident"].to_numpy(), n)))


def _placed(table: pa.Table) -> pa.Table:
    """Numbers the at most n rows left of each group."""
    group = _groups(table)
    order = np.lexsort((table["ident"].to_numpy(), ordered_bits(table["score"].to_numpy()), group))
    group = group[order]
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][: len(group)])
    place = np.arange(len(group)) - np.repeat(start, np.diff(np.r_[start, len(group)])) + 1
    return table.take(pa.array(order)).append_column("place", pa.array(place, pa.int64()))


def top_n(rows: DataFrame, n: int, upper_rows: int | None = None) -> DataFrame:
    """The n rows with the lowest score of each grp, the lower ident first on a tie, with their place from 1.

    ``rows``: (grp string, item string, score double, ident long), score finite, ident unique in a group, already
    spread over the partitions. Groups of fewer than n rows come out whole. ``upper_rows``: a bound of the number of
    rows, which sizes the exchange by group (a task holds its groups' best rows of all tasks before).
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    kinds = "grp string, item string, score double, ident long"
    rows = rows.select("grp", "item", "score", "ident")
    size = rows.count() if upper_rows is None else upper_rows
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(size / TASK_ROWS))
    return rows.mapInArrow(_cut(n), kinds).repartition(tasks, "grp").mapInArrow(_cut(n, last=True), kinds + ", place long")


def best_arrays(gtcheck: DataFrame, n: int = 3) -> DataFrame:
    """(data_sample, microarray_sample, place, score, line_no) of each data sample's n best arrays.

    Defined results: lines with a null id are left out, an empty id is an id; of several lines of a pair the one
    with the smallest line_no counts (a null line_no last), even if its score is unusable; then null, NaN and
    infinite scores are left out, and so are lines without line_no; ties go by line_no; an empty table gives no
    rows; other columns are not looked at.
    """
    pair = ["grp", "item"]
    lines = gtcheck.select(norm_id("data_sample").alias("grp"), norm_id("microarray_sample").alias("item"), "score", "line_no").where(
        "grp is not null and item is not null"
    )
    first = lines.groupBy(*pair).agg(F.min("line_no").alias("ident"), F.min_by("score", "line_no").alias("score"))
    usable = first.where(is_finite("score") & F.col("ident").isNotNull())
    best = top_n(usable, n, gtcheck.count())  # Parquet files know their number of rows
    return best.select(
        F.col("grp").alias("data_sample"), F.col("item").alias("microarray_sample"), F.col("place").cast("int").alias("place"), "score", F.col("ident").alias("line_no")
    )
