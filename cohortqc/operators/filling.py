"""Filling missing values from similar records (problem 6).

Time-ordered filling per entity: numerics are interpolated between the observed neighbours of the same
call set and variant type, categories come from the same site or are carried from the nearest neighbour of the
call set, both within a gap limit. Each filled cell is marked with its method and distance.

Scale: an entity, or one moment of it, may hold a third of all rows, so rows are parted by ranges of (entity, time, row),
of equal size whatever the entities. Each part is scanned once, in order; only the first and last observation of
the few entities that cross a part's border travel to the parts before and behind. The parts stay as they are for both
passes, so categories and numerics need one sort each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortqc.functions.ids import is_number
from cohortqc.session import bounded_rows, materialize, release

VARIANT_TYPES = ("snv", "indel", "multi-snv", "multi-indel", "mixed")
#: Neighbours further away than this many days are not used.
GAP_DAYS = 30.0
#: Rows of one part of the scan.
PART_ROWS = 500_000
#: Cells that a field's range is cut into to find its medians; only values of the medians' cells are ordered.
MEDIAN_CELLS = 4096
#: Tables with one row per entity are broadcast up to this size.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class Numeric:
    """A numeric field; usable are numbers from ``low`` to ``high``."""

    column: str
    low: float
    high: float

    def usable(self) -> Column:
        c = F.col(self.column)
        return F.when(is_number(c) & c.between(self.low, self.high), c.cast("double"))


@dataclass(frozen=True)
class Category:
    """A categorical field; usable are ``values`` after trimming spaces and lower-casing."""

    column: str
    values: Sequence[str]

    def usable(self) -> Column:
        c = F.lower(F.trim(F.col(self.column)))
        return F.when(c.isin(*self.values), c)


VARIANT_NUMERICS = (Numeric("mq", 0.0, 100.0), Numeric("inbreedingcoeff", -1.0, 1.0))
VARIANT_CATEGORY = Category("variant_type", VARIANT_TYPES)


def _scan(entity: Sequence[str], values: Sequence[str]):
    """A part's rows in order -> of each row without a value the rows observed before and behind it inside the part, and
    marks of the first (1) and last (2) observation of an entity in the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts).combine_chunks()
        n = table.num_rows
        fresh = np.zeros(n, bool)
        fresh[0] = True
        for e in (*entity, "pid"):
            code = table[e].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            fresh[1:] |= code[1:] != code[:-1]
        group = np.cumsum(fresh) - 1
        at = np.arange(n)
        timed = table["t"].is_valid().to_numpy()
        for v in values:
            obs = table[v].is_valid().to_numpy() & timed
            last = np.maximum.accumulate(np.where(obs, at, -1))
            before = np.r_[-1, last[:-1]]
            before[(before >= 0) & (group[before] != group)] = -1
            next_ = np.minimum.accumulate(np.where(obs, at, n)[::-1])[::-1]
            after = np.r_[next_[1:], n]
            after[(after < n) & (group[np.minimum(after, n - 1)] != group)] = n
            edge = np.where(obs & (before < 0), 1, 0) + np.where(obs & (after == n), 2, 0)
            for name, index, none in (("p", before, before < 0), ("n", after, after == n)):
                index = pa.array(np.where(none, 0, index), mask=none | obs | ~timed)
                taken = pa.StructArray.from_arrays([table[v].combine_chunks().take(index), table["t"].combine_chunks().take(index)], ["v", "t"], mask=pa.array(none | obs | ~timed))
                table = table.append_column(f"{name}_{v}", taken)
            table = table.append_column(f"e_{v}", pa.array(edge.astype(np.int32)))
        yield from table.to_batches(max_chunksize=50_000)

    return run


def _neighbours(df: DataFrame, entity: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Adds, of each value, p_<value> and n_<value>: struct(v, t) of the observed rows before and after in (t, row_id)
    order, for rows that lack the value and have a time. Rows with one pid lie together, ordered by entity, t and row_id."""
    kinds = dict(df.dtypes)
    more = ", ".join(f"p_{v} struct<v:{kinds[v]},t:{kinds['t']}>, n_{v} struct<v:{kinds[v]},t:{kinds['t']}>, e_{v} int" for v in values)
    inside = materialize(df.mapInArrow(_scan(entity, values), ", ".join(f"{c} {t}" for c, t in df.dtypes) + ", " + more))
    obs = {v: F.struct(F.col(v).alias("v"), F.col("t").alias("t")) for v in values}
    bit = lambda v, b: F.when(F.col(f"e_{v}").bitwiseAND(b) > 0, obs[v])
    # an entity that lies in one part has nothing to carry; two at most cross each border
    spans = inside.groupBy(*entity).agg(F.min("pid").alias("one"), F.max("pid").alias("two")).where("one < two")
    spans = F.broadcast(spans.select(*entity))
    null_safe = lambda a, b: [a[e].eqNullSafe(b[e]) for e in entity]
    crossing = inside.join(spans, null_safe(inside, spans), "left_semi")
    ends = crossing.groupBy("pid", *entity).agg(*[F.max(bit(v, 1)).alias(f"first_{v}") for v in values], *[F.max(bit(v, 2)).alias(f"last_{v}") for v in values])
    ahead = W.partitionBy(*entity).orderBy("pid").rowsBetween(W.unboundedPreceding, -1)
    back = W.partitionBy(*entity).orderBy(F.desc("pid")).rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(
        *[F.col(c).alias(f"_{c}") for c in ("pid", *entity)],
        *[F.last(f"last_{v}", True).over(ahead).alias(f"k_{v}") for v in values],
        *[F.last(f"first_{v}", True).over(back).alias(f"l_{v}") for v in values],
    )
    carried = F.broadcast(carried)
    lacks = lambda v: F.col(v).isNull() & F.col("t").isNotNull()
    joined = inside.join(carried, [inside[c].eqNullSafe(carried[f"_{c}"]) for c in ("pid", *entity)], "left")
    out = [F.coalesce(f"p_{v}", F.when(lacks(v), F.col(f"k_{v}"))).alias(f"p_{v}") for v in values] + [F.coalesce(f"n_{v}", F.when(lacks(v), F.col(f"l_{v}"))).alias(f"n_{v}") for v in values]
    return joined.select(*df.columns, *out)


def _small(table: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if it is no longer than BROADCAST_ROWS: then a hot key needs no shuffle."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _medians(rows: DataFrame, values: Sequence[str], numerics: Sequence[Numeric]) -> dict[tuple[str | None, str], float]:
    """The exact median, of rank ceil(n / 2), of each (kind, value), and of (None, value) for all kinds together.

    Rows become counts per value; cells of the range find the one that holds the rank, and only its values are ordered.
    """
    cell = lambda v, n: F.coalesce(F.floor(F.try_divide(F.col(v) - n.low, F.lit(float(n.high - n.low))) * MEDIAN_CELLS), F.lit(0)).cast("int")
    each = F.array(*[F.struct(F.lit(v).alias("field"), F.col(v).alias("value"), cell(v, n).alias("cell")) for v, n in zip(values, numerics, strict=True)])
    counts = rows.select("kind", F.explode(each).alias("x")).select("kind", "x.*").where("value is not null").groupBy("kind", "field", "cell", "value").agg(F.count("*").alias("n"))
    counts = materialize(counts)
    whole = counts.groupBy("field", "cell", "value").agg(F.sum("n").alias("n")).select(F.lit("").alias("kind"), "field", "cell", "value", "n", F.lit(True).alias("whole"))
    counts_of = counts.withColumn("whole", F.lit(False)).unionByName(whole)
    keys = ["whole", "kind", "field"]

    def holding(table: DataFrame, order: str, rank: Column) -> DataFrame:
        """The row within which the rank falls; before: the count of the earlier rows of its group."""
        counted = table.withColumn("before", F.sum("n").over(W.partitionBy(*keys).orderBy(order)) - F.col("n")).withColumn("rank", rank)
        return counted.where("before < rank and rank <= before + n")

    cells = counts_of.groupBy(*keys, "cell").agg(F.sum("n").alias("n"))
    hit = holding(cells, "cell", F.ceil(F.sum("n").over(W.partitionBy(*keys)) / 2)).select(*keys, "cell", (F.col("rank") - F.col("before")).alias("left"))
    found = holding(counts_of.join(F.broadcast(hit), [*keys, "cell"]), "value", F.col("left"))  # hit: a row per kind and value
    medians = {(None if r["whole"] else r["kind"], r["field"]): r["value"] for r in bounded_rows(found.select(*keys, "value"), 10_000, "medians")}
    release(counts)
    return medians


def _days(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(86_400_000_000.0)


def _pick(*options: tuple[Column, Column, Column, str]) -> Column:
    """The first option (condition, value, distance, method) that holds, as a struct."""
    choice = None
    for cond, value, distance, method in options:
        made = F.struct(value.alias("value"), F.lit(method).alias("method"), distance.cast("double").alias("distance"))
        choice = F.when(cond, made) if choice is None else choice.when(cond, made)
    return choice


def fill_gaps(
    df: DataFrame,
    numerics: Sequence[Numeric] = VARIANT_NUMERICS,
    category: Category = VARIANT_CATEGORY,
    entity: str = "callset_id",
    site: Sequence[str] = ("contig", "pos"),
    gap_days: float = GAP_DAYS,
) -> DataFrame:
    """row_id and, of each field, <field>, <field>_method and <field>_distance (days).

    Methods: ``observed`` (usable as it was); categories ``site`` (the most frequent usable value of the same
    site, the smaller on a tie), ``carried`` / ``carried_back`` (nearest neighbour of the call set within
    ``gap_days``), ``entity`` and ``overall`` (most frequent value); numerics ``interpolated`` (between both
    neighbours of the same call set and, after filling, variant type), ``carried`` / ``carried_back`` (only one
    neighbour within the limit), ``type`` and ``overall`` (exact median, the lower one of an even number); ``none`` where nothing is known.

    Defined results: time is called_at, or loaded_at if that is null; rows without time take the fallbacks; rows
    of the same time are ordered by row_id; rows with a null entity form an entity of their own; repeated rows
    come out as often as they stand; an empty table gives no rows. Other columns are not looked at.
    """
    names = [n.column for n in numerics]
    base = df.select(
        "row_id",
        F.coalesce(F.col(entity).cast("string"), F.lit("\0")).alias("entity"),
        F.coalesce("called_at", "loaded_at").alias("t"),
        *[F.col(c).alias(f"site{k}") for k, c in enumerate(site)],
        category.usable().alias("cat"),
        *[n.usable().alias(f"num{k}") for k, n in enumerate(numerics)],
    )
    parts = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / PART_ROWS))
    ranged = base.repartitionByRange(parts, "entity", "t", "row_id").withColumn("pid", F.spark_partition_id())

    # categories: only rows with a gap meet the site and entity tables
    near = _neighbours(ranged.sortWithinPartitions("entity", "t", "row_id"), ["entity"], ["cat"])
    base = near
    sites = [f"site{k}" for k in range(len(site))]
    tally = base.where("cat is not null")

    def most_frequent(keys: list[str], name: str) -> DataFrame:
        counted = tally.where(" and ".join([f"{k} is not null" for k in keys] or ["true"])).groupBy(*keys, "cat").agg(F.count("*").alias("n"))
        return counted.groupBy(*keys).agg(F.min_by("cat", F.struct(-F.col("n"), "cat")).alias(name))

    of_all = most_frequent([], "of_all").first()  # one value
    gaps = (
        near.where("cat is null")
        .join(most_frequent(sites, "of_site"), sites, "left")
        .join(_small(materialize(most_frequent(["entity"], "of_entity"))), "entity", "left")
        .withColumn("of_all", F.lit(of_all["of_all"] if of_all else None).cast("string"))
    )
    p, n = F.col("p_cat"), F.col("n_cat")
    dp, dn = _days(F.col("t"), p["t"]), _days(n["t"], F.col("t"))
    near_p, near_n = F.coalesce(dp <= gap_days, F.lit(False)), F.coalesce(dn <= gap_days, F.lit(False))
    none = F.lit(None).cast("double")
    filled = gaps.withColumn(
        "c",
        _pick(
            (F.col("of_site").isNotNull(), F.col("of_site"), none, "site"),
            (near_p & (~near_n | (dp <= dn)), p["v"], dp, "carried"),
            (near_n, n["v"], dn, "carried_back"),
            (F.col("of_entity").isNotNull(), F.col("of_entity"), none, "entity"),
            (F.col("of_all").isNotNull(), F.col("of_all"), none, "overall"),
            (F.lit(True), F.lit(None).cast("string"), none, "none"),
        ),
    )
    keep = ["row_id", "entity", "t", "pid", *[f"num{k}" for k in range(len(names))]]
    known = base.where("cat is not null").select(*keep, _pick((F.lit(True), F.col("cat"), F.lit(0.0), "observed")).alias("c"))
    rows = materialize(known.unionByName(filled.select(*keep, "c")).withColumn("kind", F.coalesce(F.col("c")["value"], F.lit("\0"))))

    values = [f"num{k}" for k in range(len(names))]
    order = ["pid", "entity", "kind", "t", "row_id"]
    near = _neighbours(rows.repartitionById(parts, F.col("pid")).sortWithinPartitions(*order), ["entity", "kind"], values)
    # at most a row per kind (a closed list), and one
    medians = _medians(rows, values, numerics)
    kinds = sorted({kind for kind, _ in medians if kind is not None})
    of_kind = df.sparkSession.createDataFrame([(kind, *[medians.get((kind, v)) for v in values]) for kind in kinds], ", ".join(["kind string", *[f"of_kind_{v} double" for v in values]]))
    near = near.join(F.broadcast(of_kind), "kind", "left")
    near = near.withColumns({f"of_all_{v}": F.lit(medians.get((None, v))).cast("double") for v in values})
    done = []
    for v, name in zip(values, names, strict=True):
        p, n = F.col(f"p_{v}"), F.col(f"n_{v}")
        dp, dn = _days(F.col("t"), p["t"]), _days(n["t"], F.col("t"))
        near_p, near_n = F.coalesce(dp <= gap_days, F.lit(False)), F.coalesce(dn <= gap_days, F.lit(False))
        between = F.when(dp + dn > 0, p["v"] + (n["v"] - p["v"]) * dp / F.nullif(dp + dn, F.lit(0.0))).otherwise((p["v"] + n["v"]) / 2)
        got = _pick(
            (F.col(v).isNotNull(), F.col(v), F.lit(0.0), "observed"),
            (near_p & near_n, between, F.least(dp, dn), "interpolated"),
            (near_p, p["v"], dp, "carried"),
            (near_n, n["v"], dn, "carried_back"),
            (F.col(f"of_kind_{v}").isNotNull(), F.col(f"of_kind_{v}"), none, "type"),
            (F.col(f"of_all_{v}").isNotNull(), F.col(f"of_all_{v}"), none, "overall"),
            (F.lit(True), none, none, "none"),
        )
        done.append((name, got))
    done.append((category.column, F.col("c")))
    return near.select("row_id", *[g.alias(name) for name, g in done]).select(
        "row_id",
        *[c for name, _ in done for c in (F.col(name)["value"].alias(name), F.col(name)["method"].alias(f"{name}_method"), F.col(name)["distance"].alias(f"{name}_distance"))],
    )


def filled_cells(filled: DataFrame, fields: Sequence[str] = ("mq", "inbreedingcoeff", "variant_type")) -> DataFrame:
    """(gap_field, row_id): one row per cell that had no usable value."""
    marks = F.array(*[F.when(F.col(f"{f}_method") != "observed", F.lit(f)) for f in fields])
    return filled.select(F.explode(F.filter(marks, lambda m: m.isNotNull())).alias("gap_field"), "row_id")
