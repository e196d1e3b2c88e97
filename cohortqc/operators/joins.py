"""Keyed lookups, set joins, interval joins and the trio join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Interval tables of up to so many rows are broadcast; larger ones are joined by tile.
BROADCAST_INTERVALS = 100_000
TILE = 100_000


def first_of(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key: the first in ``order``. An aggregate, so a hot key is combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def annotate(df: DataFrame, table: DataFrame, keys: Sequence[str], columns: Sequence[str], prefix: str = "") -> DataFrame:
    """Left lookup of several columns in one join; the table must hold a key once."""
    side = table.select(*keys, *[F.col(c).alias(prefix + c) for c in columns])
    return df.join(side, list(keys), "left")


def flag_sets(sets: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer union of key sets: one row per key, true for the sets that hold it and null for the others.

    One shuffle for any number of sets: union and one aggregate instead of a chain of outer joins.
    """
    names = list(sets)
    parts = [d.select(*keys, F.lit(n).alias("_set")) for n, d in sets.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy(*keys).agg(*[F.bool_or(F.when(F.col("_set") == n, True)).alias(n) for n in names])


def _by_interval(df: DataFrame, intervals: DataFrame, how: str, contig: str, pos: str) -> DataFrame:
    """Point in interval; intervals are (contig, start, stop), 0-based and half open, positions 1-based."""
    spans = intervals.select(F.col("contig").alias("_contig"), F.col("start").alias("_start"), F.col("stop").alias("_stop"))
    inside = (F.col(pos) - 1 >= F.col("_start")) & (F.col(pos) - 1 < F.col("_stop"))
    if spans.limit(BROADCAST_INTERVALS + 1).count() <= BROADCAST_INTERVALS:
        return df.join(F.broadcast(spans), (F.col(contig) == F.col("_contig")) & inside, how)
    tiles = F.sequence(F.floor(F.col("_start") / TILE), F.floor((F.col("_stop") - 1) / TILE))
    spans = spans.where("_stop > _start").withColumn("_tile", F.explode(tiles))
    tile = F.floor((F.col(pos) - 1) / TILE)
    return df.join(spans, (F.col(contig) == F.col("_contig")) & (tile == F.col("_tile")) & inside, how)


def interval_semi(df: DataFrame, intervals: DataFrame, contig: str = "contig", pos: str = "pos") -> DataFrame:
    return _by_interval(df, intervals, "left_semi", contig, pos)


def interval_anti(df: DataFrame, intervals: DataFrame, contig: str = "contig", pos: str = "pos") -> DataFrame:
    return _by_interval(df, intervals, "left_anti", contig, pos)


def trio_entries(entries: DataFrame, trios: DataFrame, fields: Sequence[str] = ("gt",)) -> DataFrame:
    """(vid, fam_id, kid, dad, mom, kid_*, dad_*, mom_*) of complete trios; a member without entry has nulls.

    One shuffle by variant: entries of trio members are tagged with family and role (a child can be a parent in
    another family) and brought together by an aggregate, instead of joining the entries three times.
    """
    roles = F.explode(
        F.array(*[F.struct(F.col(r).alias("sid"), F.lit(r).alias("role")) for r in ("kid", "dad", "mom")])
    ).alias("m")
    members = trios.where("kid is not null and dad is not null and mom is not null").select("fam_id", "kid", "dad", "mom", roles).select("fam_id", "kid", "dad", "mom", "m.sid", "m.role")
    tagged = entries.select("vid", "sid", *fields).join(members, "sid")
    simple = ("tinyint", "smallint", "int", "bigint", "double", "boolean")
    kinds = dict(entries.dtypes)
    # a member has one entry per variant, so the largest is it; of plain types it is kept in a hash aggregate
    pick = lambda r, f: (F.max if kinds[f] in simple else lambda c: F.any_value(c, True))(F.when(F.col("role") == r, F.col(f)))
    return tagged.groupBy("vid", "fam_id", "kid", "dad", "mom").agg(*[pick(r, f).alias(f"{r}_{f}") for r in ("kid", "dad", "mom") for f in fields])


def union_cols(left: DataFrame, right: DataFrame, key: str = "vid") -> DataFrame:
    """Entries of two cohorts side by side, restricted to the variants that both have."""
    common = left.select(key).distinct().join(right.select(key).distinct(), key, "left_semi")
    return left.unionByName(right).join(common, key, "left_semi")


def collect_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a key as a sorted array of structs; for keys of a known small multiplicity (alleles of a site, families)."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*rest))).alias("values"))


def row_index(df: DataFrame, order: Sequence, name: str = "idx") -> DataFrame:
    """0-based position in a total order of the rows. ``order``: columns or names; ranges of it are numbered in parallel."""
    from cohortqc.operators.ranks import prefix_counts

    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    names = [f"_o{k}" for k in range(len(keys))]
    marked = df.select("*", *[k.alias(n) for k, n in zip(keys, names, strict=True)], F.lit(0).alias("_all"))
    return prefix_counts(marked, "_all", names, {name: "true"}).drop("_all", *names)


def differences(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: float = 1e-9) -> DataFrame:
    """(keys, column, left, right) of cells that two tables do not share; numbers agree within a relative tolerance, NaN
    agrees with NaN and null with null. A row that only one table has differs in every column that it fills."""
    kinds = dict(left.dtypes)
    both = left.select(*keys, *[F.col(c).alias(f"_l_{c}") for c in columns]).join(right.select(*keys, *[F.col(c).alias(f"_r_{c}") for c in columns]), list(keys), "full")

    def differ(c: str):
        a, b = F.col(f"_l_{c}"), F.col(f"_r_{c}")
        if kinds[c] in ("double", "float"):
            near = (F.isnan(a) & F.isnan(b)) | (F.abs(a - b) <= tolerance * F.greatest(F.lit(1.0), F.abs(a), F.abs(b)))
            return ~F.coalesce(near, a.isNull() & b.isNull())
        return ~a.eqNullSafe(b)

    text = lambda c: F.col(c).cast("string")
    cells = [F.when(differ(c), F.struct(F.lit(c).alias("column"), text(f"_l_{c}").alias("left"), text(f"_r_{c}").alias("right"))) for c in columns]
    cell = F.col("_cell")  # field by field: "_cell.*" could also name a table alias of the input
    return both.select(*keys, F.explode(F.array_compact(F.array(*cells))).alias("_cell")).select(*keys, *[cell[c].alias(c) for c in ("column", "left", "right")])
