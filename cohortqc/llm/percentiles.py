"""Percentiles of very large numeric columns (problem 3).

Exact bisection: every group and percentile keeps an interval of values; a pass counts the rows not above the
midpoints and halves the intervals until every target rank is resolved. Percentile p of n values is the value of
rank ceil(p * n / 100), at least 1, in ascending order.

Mergeable days: the input of the bisection is not rows but counts per (group, day, measure, code), which add up
over any set of days. Codes are whole numbers: value / step, rounded. dp and gq are whole already (error 0); hetab
has a step of 1e-6, so every percentile is within half a step. A day's counts are therefore bounded by
the number of codes, whatever its number of rows.

Scale: one pass over the group column finds the groups of more than HOT_ROWS rows. All other rows are shuffled once, by
group; a task that holds whole groups finishes all their passes by itself. Hot groups are never brought together: their
rows become counts where they are, one per code, whatever the number of days. A hot group's counts then go to one
task like any other group's, or, if it has more than HOT_CODES different codes, stay spread by code and are bisected
across tasks, one job for all such groups per pass, with several midpoints per interval.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortqc.functions.ids import is_finite, norm_id
from cohortqc.session import materialize

PERCENTILES = (1, 5, 25, 50, 75, 95, 99)
#: A group of more rows is counted where its rows are. Beyond HOT_ROWS * HOT_GROUPS rows in all, the limit is rows / HOT_GROUPS.
HOT_ROWS = 1_000_000
HOT_GROUPS = 100_000
#: A hot group of more different codes is bisected across tasks; likewise for ACROSS_GROUPS.
HOT_CODES = 4_000_000
ACROSS_GROUPS = 512
#: Rows of counts that one task of the local bisection should hold.
TASK_ROWS = 1_000_000
#: Midpoints per interval in a pass over the hot groups.
MIDPOINTS = 15


@dataclass(frozen=True)
class Measure:
    column: str
    step: float = 1.0
    whole: bool = True

    @property
    def error(self) -> float:
        return 0.0 if self.whole else self.step / 2


ENTRY_MEASURES = (Measure("dp"), Measure("gq"), Measure("hetab", 1e-6, whole=False))


def _codes(measures: Sequence[Measure]):
    """array of (measure, code) of a row's usable values."""
    coded = []
    for k, m in enumerate(measures):
        c = F.col(m.column)
        code = c.cast("long") if m.whole else F.floor(c / m.step + 0.5).cast("long")
        usable = c.isNotNull() if m.whole else is_finite(c)
        coded.append(F.when(usable, F.struct(F.lit(k).alias("measure"), code.alias("code"))))
    return F.filter(F.array(*coded), lambda x: x.isNotNull())


def _rows(df: DataFrame, measures: Sequence[Measure], group: str, day: str, span: tuple | None) -> DataFrame:
    rows = df.select(norm_id(group).alias("grp"), F.col(day).alias("day"), *[m.column for m in measures]).where("grp is not null")
    if span:
        rows = rows.where(F.col("day").between(F.lit(span[0]).cast("date"), F.lit(span[1]).cast("date")))
    return rows


def day_counts(df: DataFrame, measures: Sequence[Measure] = ENTRY_MEASURES, group: str = "s", day: str = "load_day") -> DataFrame:
    """(grp, day, measure, code, n): the mergeable summary; adding n over days gives the summary of the span.

    ``measure`` is the position in ``measures``. Null, NaN and infinite values and rows without a group are left
    out; rows without a day keep a null day.
    """
    rows = _rows(df, measures, group, day, None).select("grp", "day", F.explode(_codes(measures)).alias("x"))
    return rows.groupBy("grp", "day", "x.measure", "x.code").agg(F.count("*").alias("n"))


def bisect(group: np.ndarray, code: np.ndarray, n: np.ndarray, shares: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
    """Of each group 0..g-1, the code at each share's rank (g x shares) and the group's total, all groups at once.

    ``n`` counts the rows of each (group, code). A pass counts, for every group and share, the rows not above the
    midpoint.
    """
    size = int(group.max()) + 1
    total = np.bincount(group, weights=n, minlength=size).astype(np.int64)
    start = np.full(size, np.iinfo(np.int64).max)
    stop = np.full(size, np.iinfo(np.int64).min)
    np.minimum.at(start, group, code)
    np.maximum.at(stop, group, code)
    out = np.empty((size, len(shares)), np.int64)
    for k, share in enumerate(shares):
        want = _rank(total, share)
        lo, hi, below = start.copy(), stop.copy(), np.zeros(size, np.int64)
        g, c, w = group, code, n
        while True:
            mid = (lo & hi) + ((lo ^ hi) >> 1)
            under = c <= mid[g]
            count = below + np.bincount(g[under], weights=w[under], minlength=size).astype(np.int64)
            enough = count >= want
            hi = np.where(enough, mid, hi)
            below = np.where(enough, below, count)
            lo = np.where(enough, lo, mid + 1)
            stay = (under == enough[g]) & (lo[g] < hi[g])
            g, c, w = g[stay], c[stay], w[stay]
            lo = np.where(lo > hi, hi, lo)
            if not len(g):
                break
        out[:, k] = hi
    return out, total


def _rank(total, share):
    """ceil(share * total / 100), at least 1; shares are whole numbers or tenths of them."""
    return np.maximum(1, -(-(np.asarray(total) * round(share * 1000)) // 100_000))


def _local(shares: Sequence[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        name, names = pd.factorize(table["grp"].to_pandas())
        measure = table["measure"].to_numpy()
        kinds = int(measure.max()) + 1
        key, group = np.unique(name * kinds + measure, return_inverse=True)
        codes, total = bisect(group, table["code"].to_numpy(), table["n"].to_numpy(), shares)
        grp = pa.array(names, pa.string())
        for k in range(0, len(key), 50_000):
            s = slice(k, k + 50_000)
            flat = codes[s].reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(shares)), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([grp.take(pa.array(key[s] // kinds)), pa.array((key[s] % kinds).astype(np.int32)), lists, pa.array(total[s])], ["grp", "measure", "codes", "total"])

    return run


def _across(counts: DataFrame, shares: Sequence[float]) -> list[tuple]:
    """(grp, measure, codes, total) of the hot groups: bisection with one job per pass for all of them.

    The state is one interval per hot group, measure and percentile: at most ACROSS_GROUPS groups.
    """
    spark = counts.sparkSession
    first = counts.groupBy("grp", "measure").agg(F.min("code").alias("lo"), F.max("code").alias("hi"), F.sum("n").alias("n")).collect()
    total = {(r["grp"], r["measure"]): r["n"] for r in first}
    state = {(r["grp"], r["measure"], k): (r["lo"], r["hi"]) for r in first for k in range(len(shares))}
    want = {key: int(_rank(total[key[:2]], shares[key[2]])) for key in state}
    while open_ := {key: b for key, b in state.items() if b[0] < b[1]}:
        mids = {key: sorted({lo + (hi - lo) * j // (MIDPOINTS + 1) for j in range(1, MIDPOINTS + 1)} - {hi}) for key, (lo, hi) in open_.items()}
        rows = [(g, m, k, mid) for (g, m, k), each in mids.items() for mid in each]
        sorted_mids: dict[tuple, set[int]] = {}
        for (g, m, _), each in mids.items():
            sorted_mids.setdefault((g, m), set()).update(each)
        points = F.broadcast(spark.createDataFrame(rows, "grp string, measure int, k int, mid long").groupBy("grp", "measure").agg(F.array_sort(F.collect_set("mid")).alias("mids")))
        # each row of counts falls into one gap between midpoints; sums over gaps give the counts below each
        gap = F.size(F.filter("mids", lambda x: x < F.col("code")))
        found = counts.join(points, ["grp", "measure"]).groupBy("grp", "measure", gap.alias("gap")).agg(F.sum("n").alias("n")).collect()
        per: dict[tuple, dict[int, int]] = {}
        for r in found:
            per.setdefault((r["grp"], r["measure"]), {})[r["gap"]] = r["n"]
        below: dict[tuple, dict[int, int]] = {}
        for (g, m), gaps in per.items():
            run = 0
            below[g, m] = {}
            for j, mid in enumerate(sorted(sorted_mids[g, m])):
                run += gaps.get(j, 0)
                below[g, m][mid] = run
        for key, each in mids.items():
            lo, hi = state[key]
            for mid in each:
                if below[key[:2]][mid] >= want[key]:
                    hi = min(hi, mid)
                else:
                    lo = max(lo, mid + 1)
            state[key] = (lo, hi)
    return [(g, m, [state[g, m, k][1] for k in range(len(shares))], n) for (g, m), n in total.items()]


def _named(got: DataFrame, measures: Sequence[Measure], shares: Sequence[float]) -> DataFrame:
    pick = lambda values, c: F.element_at(F.array(*[F.lit(v) for v in values]), c + 1)
    each = got.select("grp", "measure", "total", F.posexplode("codes").alias("k", "code"))
    return each.select(
        "grp",
        pick([m.column for m in measures], F.col("measure")).alias("measure"),
        pick([float(s) for s in shares], F.col("k")).alias("percentile"),
        F.round(F.col("code") * pick([float(m.step) for m in measures], F.col("measure")), 9).alias("value"),
        F.col("total").alias("n"),
        pick([m.error for m in measures], F.col("measure")).alias("error_bound"),
    )


_FOUND = "grp string, measure int, codes array<long>, total long"


def _larger(sizes: DataFrame, least: int, groups: int) -> tuple[DataFrame | None, int]:
    """The groups of more than ``least`` rows (raised so that there are at most ``groups``), to be broadcast, and the number of rows."""
    total = sizes.agg(F.sum("n").alias("n")).first()["n"] or 0
    if total <= least:
        return None, total
    found = materialize(sizes.where(F.col("n") > max(least, total // groups)).select("grp"))
    return (F.broadcast(found) if found.count() else None), total


def _solve(cold: DataFrame, hot: DataFrame | None, shares: Sequence[float]) -> DataFrame:
    """``cold``: counts whose groups lie in one partition each; ``hot``: counts of hot groups, one per code, in any order."""
    local = lambda d: d.select("grp", "measure", "code", "n").mapInArrow(_local(shares), _FOUND)
    got = local(cold)
    if hot is None:
        return got
    some = materialize(hot)
    wide, rows = _larger(some.groupBy("grp").agg(F.count("*").alias("n")), HOT_CODES, ACROSS_GROUPS)
    rest = some if wide is None else some.join(wide, "grp", "left_anti")
    got = got.unionByName(local(rest.repartition(_tasks(some, rows), "grp")))
    if wide is not None:
        got = got.unionByName(cold.sparkSession.createDataFrame(_across(some.join(wide, "grp", "left_semi"), shares), _FOUND))
    return got


def _tasks(df: DataFrame, rows: int) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS))


def percentiles_of(counts: DataFrame, measures: Sequence[Measure] = ENTRY_MEASURES, shares: Sequence[float] = PERCENTILES) -> DataFrame:
    """(grp, measure, percentile, value, n, error_bound) from stored counts of any set of days (:func:`day_counts`)."""
    hot, total = _larger(counts.groupBy("grp").agg(F.count("*").alias("n")), HOT_ROWS, HOT_GROUPS)
    cold = counts if hot is None else counts.join(hot, "grp", "left_anti")
    cold = cold.repartition(_tasks(counts, total), "grp")
    many = None if hot is None else counts.join(hot, "grp", "left_semi").groupBy("grp", "measure", "code").agg(F.sum("n").alias("n"))
    return _named(_solve(cold, many, shares), measures, shares)


def percentiles(
    df: DataFrame, measures: Sequence[Measure] = ENTRY_MEASURES, group: str = "s", day: str = "load_day", span: tuple | None = None, shares: Sequence[float] = PERCENTILES
) -> DataFrame:
    """The same as ``percentiles_of(day_counts(df))`` over ``span`` (first day, last day), with one shuffle of the rows.

    The rows are shuffled by group; their counts and the bisection then need no other exchange.
    """
    rows = _rows(df, measures, group, day, span).drop("day")
    hot, total = _larger(rows.groupBy("grp").agg(F.count("*").alias("n")), HOT_ROWS, HOT_GROUPS)

    def counted(part: DataFrame) -> DataFrame:
        return part.select("grp", F.explode(_codes(measures)).alias("x")).groupBy("grp", "x.measure", "x.code").agg(F.count("*").alias("n"))

    cold = rows if hot is None else rows.join(hot, "grp", "left_anti")
    cold = counted(cold.repartition(_tasks(df, total * len(measures)), "grp"))
    return _named(_solve(cold, None if hot is None else counted(rows.join(hot, "grp", "left_semi")), shares), measures, shares)


def entry_percentiles(entries: DataFrame, first_day=None, last_day=None) -> DataFrame:
    """(s, measure, percentile, value, n, error_bound) of dp, gq and hetab per sample, over all or a span of days.

    Defined results: null and NaN are left out (infinite hetab too); a sample without any value of a measure has
    no row for it; a cell that was delivered twice counts twice; null samples are left out; an empty table gives no
    rows; other columns are not looked at.
    """
    span = None if first_day is None and last_day is None else (first_day or "0001-01-01", last_day or "9999-12-31")
    return percentiles(entries, span=span).withColumnRenamed("grp", "s")
