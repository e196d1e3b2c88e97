"""Evaluation of a grid of genotype hard filters in a fixed number of jobs, whatever the number of grid points.

The entry-level thresholds (depth, quality, allele balance) are monotone, so an entry is described by the tightest
level it passes in each dimension. Entries are counted once per variant and level cell; what a grid point admits
is the sum over the cells at or above it. The points only meet these cells (at most levels^3 per variant), not the
entries: a grid of 128 points costs hardly more than one of 2.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortqc.functions import genetics as G
from cohortqc.operators import family
from cohortqc.operators.joins import trio_entries
from cohortqc.session import bounded_rows, materialize

#: Points of one grid.
MAX_POINTS = 10_000
#: Pairs of a point and a level cell that are broadcast.
BROADCAST_CELLS = 200_000

POINT = "bin int, dp int, gq int, ab double, call_rate double, point string"


def point_name(bin_: int, dp: int, gq: int, ab: float, call_rate: float) -> str:
    return f"bin_{bin_:03d}_DP_{dp:02d}_GQ_{gq:02d}_AB_{ab:.2f}_missing_{call_rate:.2f}"


def parse_point(name: str) -> dict[str, float]:
    v = name.split("_")
    return {"bin": int(v[1]), "dp": int(v[3]), "gq": int(v[5]), "ab": float(v[7]), "call_rate": float(v[9])}


def points(spark, bins: Sequence[int], dps: Sequence[int], gqs: Sequence[int], abs_: Sequence[float], call_rates: Sequence[float], unfiltered: bool = False) -> DataFrame:
    rows = list(itertools.product(bins, dps, gqs, abs_, call_rates))
    if unfiltered:
        rows.append((100, 0, 0, 0.0, 0.0))
    return spark.createDataFrame([(*r, point_name(*r)) for r in rows], POINT)


def _level(value: Column, thresholds: Sequence[float]) -> Column:
    """How many of the ascending thresholds a value reaches; null if it is unknown."""
    return F.when(value.isNotNull(), sum((F.when(value >= t, 1).otherwise(0) for t in thresholds), F.lit(0)))


def _levels(grid: DataFrame) -> dict[str, list]:
    """The distinct thresholds of each dimension (the grid is a list of parameters)."""
    rows = grid.select("dp", "gq", "ab").distinct().collect()
    return {c: sorted({r[c] for r in rows}) for c in ("dp", "gq", "ab")}


def _with_levels(entries: DataFrame, levels: dict[str, list]) -> DataFrame:
    """Adds l_dp, l_gq, l_ab. Calls that are not heterozygous pass every balance; an unknown level drops the entry."""
    ab = F.when(G.is_het(), _level(G.het_ab(), levels["ab"])).when(F.col("gt").isNotNull(), F.lit(len(levels["ab"])))
    return entries.withColumns({"l_dp": _level(F.col("dp"), levels["dp"]), "l_gq": _level(F.col("gq"), levels["gq"]), "l_ab": ab}).where("l_dp is not null and l_gq is not null and l_ab is not null")


def _admitting(grid: DataFrame, levels: dict[str, list]) -> DataFrame:
    """The points that each level cell meets: (l_dp, l_gq, l_ab, point, bin, call_rate, p_dp, p_gq, p_ab).

    Points and cells meet by equality. They are broadcast up to BROADCAST_CELLS rows, which are counted beforehand, and
    shuffled by cell beyond that.
    """
    names = ("dp", "gq", "ab")
    rows = bounded_rows(grid, MAX_POINTS, "grid points")
    low = [[sum(r[c] >= t for t in levels[c]) for c in names] for r in rows]
    size = sum(math.prod(len(levels[c]) + 1 - k for k, c in zip(own, names, strict=True)) for own in low)
    table = grid.sparkSession.createDataFrame([(*own, r["point"], r["bin"], r["call_rate"]) for own, r in zip(low, rows, strict=True)], "p_dp int, p_gq int, p_ab int, point string, bin int, call_rate double")
    for c in names:
        table = table.withColumn(f"l_{c}", F.explode(F.sequence(F.col(f"p_{c}"), F.lit(len(levels[c])))))
    table = table.select(*[f"l_{c}" for c in names], "point", "bin", "call_rate", *[f"p_{c}" for c in names])
    return F.broadcast(table) if size <= BROADCAST_CELLS else table


_CELL = ["l_dp", "l_gq", "l_ab"]


def surviving(entries: DataFrame, variants: DataFrame, grid: DataFrame, n_samples: int) -> DataFrame:
    """(point, vid): variants that each point keeps: their bin is allowed, more than call_rate of all samples pass
    and a passing call is not the reference."""
    levels = _levels(grid)
    cells = _with_levels(entries.join(variants.select("vid", "rf_bin"), "vid"), levels).groupBy("vid", "rf_bin", "l_dp", "l_gq", "l_ab").agg(F.count("*").alias("n"), F.count_if(F.col("gt") > 0).alias("alts"))
    admitted = cells.join(_admitting(grid, levels), _CELL).where("rf_bin <= bin")
    per = admitted.groupBy("point", "call_rate", "vid").agg(F.sum("n").alias("n"), F.sum("alts").alias("alts"))
    return per.where((F.col("n").cast("double") / n_samples > F.col("call_rate")) & (F.col("alts") > 0)).select("point", "vid")


def tp_fp(kept: DataFrame, variants: DataFrame, grid: DataFrame) -> DataFrame:
    """(point, n_variants, tp, fp); a point that keeps nothing has zeros."""
    per = kept.join(variants.select("vid", "tp", "fp"), "vid").groupBy("point").agg(F.count("*").alias("n_variants"), F.count_if("tp").alias("tp"), F.count_if("fp").alias("fp"))
    return grid.select("point").join(per, "point", "left").fillna(0)


def mendel(entries: DataFrame, trios: DataFrame, kept: DataFrame, grid: DataFrame, variants: DataFrame | None = None) -> DataFrame:
    """(point, mendelian_error_mean, mendelian_error_std) over the probands, per variant that the point keeps.

    With ``variants`` (vid, contig, pos) and the children's sex in ``trios``, sons have one copy of the sex chromosomes.

    A filtered parent's call is unknown, which can change an error into another or into none. Each erroneous or
    possible trio is therefore judged per point, but only trios with an error under some filter are expanded.
    """
    levels = _levels(grid)
    fields = ("gt", "l_dp", "l_gq", "l_ab")
    trio = trio_entries(_with_levels(entries, levels), trios, fields)
    # without a parent's call fewer errors can be told, so an error needs one with either parent's call at hand
    k, d, m = F.col("kid_gt"), F.col("dad_gt"), F.col("mom_gt")
    suspect = trio.where(((k == 2) & ((d == 0) | (m == 0))) | ((k == 0) & ((d == 2) | (m == 2))) | ((k == 1) & (((d == 2) & (m == 2)) | ((d == 0) & (m == 0)))))
    if variants is not None:
        suspect = family.with_haploid(suspect, variants, trios)
    p = _admitting(grid, levels).select(*[F.col(c).alias(f"kid_{c}") for c in _CELL], "point", "p_dp", "p_gq", "p_ab")
    ok = lambda r: (F.col(f"{r}_l_dp") >= F.col("p_dp")) & (F.col(f"{r}_l_gq") >= F.col("p_gq")) & (F.col(f"{r}_l_ab") >= F.col("p_ab"))
    judged = suspect.join(p, [f"kid_{c}" for c in _CELL]).join(kept, ["point", "vid"], "left_semi")
    judged = judged.withColumns({f"{r}_gt": F.when(ok(r), F.col(f"{r}_gt")) for r in ("dad", "mom")})
    errors = family.mendel_errors(judged).groupBy("point", "kid").agg(F.count("*").alias("errors"))
    sums = errors.groupBy("point").agg(F.sum("errors").alias("e"), F.sum(F.col("errors") * F.col("errors")).alias("ee"))
    sizes = kept.groupBy("point").agg(F.count("*").cast("double").alias("n"))
    kids = max(1, trios.select("kid").distinct().count())
    # probands without an error count with 0, so the moments need only their number
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double") / kids
    spread = F.sqrt(F.greatest(F.lit(0.0), zero("ee") - zero("e") * zero("e")))
    return grid.select("point").join(sizes, "point", "left").join(sums, "point", "left").select(
        "point", F.try_divide(zero("e"), F.col("n")).alias("mendelian_error_mean"), F.try_divide(spread, F.col("n")).alias("mendelian_error_std")
    )


def transmission(entries: DataFrame, trios: DataFrame, variants: DataFrame, kept: DataFrame, grid: DataFrame) -> DataFrame:
    """(point, t_u_ratio): transmitted / untransmitted founder singletons among the synonymous variants each point
    keeps, -1 without untransmitted ones. Entries of trio members at such variants are few; they are judged per point."""
    levels = _levels(grid)
    syn = variants.where("consequence = 'synonymous_variant'").select("vid")
    members = trios.select(F.explode(F.array("kid", "dad", "mom")).alias("sid")).distinct()
    founders = members.join(trios.select(F.col("kid").alias("sid")), "sid", "left_anti").withColumn("founder", F.lit(True))
    e = _with_levels(entries.join(syn, "vid", "left_semi").join(F.broadcast(members), "sid", "left_semi"), levels)
    p = _admitting(grid, levels).select(*_CELL, "point")
    admitted = materialize(e.join(p, _CELL).join(kept, ["point", "vid"], "left_semi").select("point", "vid", "sid", "gt"))
    single = admitted.join(F.broadcast(founders), "sid").groupBy("point", "vid").agg(F.sum("gt").alias("ac")).where("ac = 1").select("point", "vid")
    some = admitted.join(single, ["point", "vid"], "left_semi").select(F.struct("point", "vid").alias("vid"), "sid", "gt")
    t, u = family.transmissions()
    per = trio_entries(some, trios).groupBy(F.col("vid.point").alias("point")).agg(F.coalesce(F.sum(t), F.lit(0)).alias("t"), F.coalesce(F.sum(u), F.lit(0)).alias("u"))
    ratio = F.when(F.col("u") > 0, F.col("t").cast("double") / F.nullif("u", F.lit(0))).otherwise(-1.0)
    return grid.select("point").join(per, "point", "left").select("point", ratio.alias("t_u_ratio"))


def precision_recall(control: DataFrame, test: DataFrame, keys: Sequence[str] = ("vid",), subsets: dict[str, Column] | None = None) -> DataFrame:
    """(subset, tp, fp, fn, precision, recall) of two sets of variants; -1 where a denominator is 0.

    One full outer pass for all subsets; ``subsets`` are conditions on columns that both tables have.
    """
    subsets = {"all": F.lit(True)} | (subsets or {})
    names = list(subsets)
    mark = lambda d, side: d.select(*keys, F.lit(side).alias("side"), F.array(*[F.when(c, F.lit(n)) for n, c in subsets.items()]).alias("of"))
    each = mark(control, "c").unionByName(mark(test, "t")).select(*keys, "side", F.explode(F.filter("of", lambda x: x.isNotNull())).alias("subset"))
    both = each.groupBy("subset", *keys).agg(F.bool_or(F.col("side") == "c").alias("c"), F.bool_or(F.col("side") == "t").alias("t"))
    n = both.groupBy("subset").agg(F.count_if(F.col("c") & F.col("t")).alias("tp"), F.count_if(~F.col("c") & F.col("t")).alias("fp"), F.count_if(F.col("c") & ~F.col("t")).alias("fn"))
    base = control.sparkSession.createDataFrame([(x,) for x in names], "subset string").join(n, "subset", "left").fillna(0)
    share = lambda other: F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col(other)).cast("double")), F.lit(-1.0))
    return base.withColumn("precision", share("fp")).withColumn("recall", share("fn"))


def grid_precision_recall(entries: DataFrame, kept: DataFrame, control: DataFrame, sample: int, grid: DataFrame) -> DataFrame:
    """(point, prec, recall) of one sample's non-reference variants against a control set."""
    levels = _levels(grid)
    own = _with_levels(entries.where((F.col("sid") == sample) & (F.col("gt") > 0)), levels)
    p = _admitting(grid, levels).select(*_CELL, "point")
    test = own.join(p, _CELL).join(kept, ["point", "vid"], "left_semi").select("point", "vid")
    hit = test.join(control.select("vid", F.lit(1).alias("in_control")), "vid", "left").groupBy("point").agg(F.count("in_control").alias("tp"), F.count("*").alias("test"))
    share = lambda of: F.coalesce(F.try_divide(F.col("tp").cast("double"), of.cast("double")), F.lit(-1.0))
    return grid.select("point").join(hit, "point", "left").fillna(0).select("point", share(F.col("test")).alias("prec"), share(F.lit(control.count())).alias("recall"))


def filter_metrics(results: DataFrame, variants: DataFrame) -> DataFrame:
    """The results with TP and FP as percentages of all, and the parameters read back from the point's name."""
    total = variants.agg(F.count_if("tp").alias("tp"), F.count_if("fp").alias("fp")).first()
    part = lambda k: F.split_part("point", F.lit("_"), F.lit(k))
    pc = lambda k: F.try_divide(100.0 * F.col(k), F.lit(float(total[k])))
    named = {"bin": part(2).cast("int"), "DP": part(4).cast("int"), "GQ": part(6).cast("int"), "AB": part(8).cast("double"), "call_rate": part(10).cast("double"), "TP_percent": pc("tp"), "FP_percent": pc("fp")}
    return results.withColumns(named)
