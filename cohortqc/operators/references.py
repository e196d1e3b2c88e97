"""References to records that do not exist (problem 1).

Skew-aware split: references are first aggregated per key and period; the few keys that hold a large
share of all references are resolved against a broadcast whose size is bounded and checked; all other
keys go through an ordinary shuffle join; both orphan sets are united.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortqc.functions.ids import NO_REFERENCE, norm_id
from cohortqc.session import materialize

#: A key is heavy if it holds more references than a task should get, or than 1 / HEAVY_KEYS of all: at most HEAVY_KEYS keys are.
HEAVY_MIN = 100_000
HEAVY_KEYS = 100_000
#: The heavy keys' target spans and months are broadcast only up to this number; beyond it they meet in SALT parts per key.
BROADCAST_SPANS = 200_000
SALT = 64
_OPEN = "9999-12-31 00:00:00"


def references(df: DataFrame, field: str, target: str) -> DataFrame:
    """(ref_field, target, record_id, ref_key, t) of one referring column; values that are no reference are left out."""
    return df.select(
        F.lit(field).alias("ref_field"),
        F.lit(target).alias("target"),
        F.col("record_id"),
        norm_id(field).alias("ref_key"),
        F.coalesce("recorded_at", "loaded_at").alias("t"),
    ).where(F.col("ref_key").isNotNull() & ~F.col("ref_key").isin(*NO_REFERENCE))


def target_rows(df: DataFrame, key: str, target: str) -> DataFrame:
    return df.select(F.lit(target).alias("target"), norm_id(key).alias("ref_key"), "arrived_at", "removed_at").where(
        F.col("ref_key").isNotNull()
    )


def _merge_spans(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Unite overlapping or touching [a, e) of each key."""
    order = W.partitionBy(*keys).orderBy("a", "e")
    reach = F.max("e").over(order.rowsBetween(W.unboundedPreceding, -1))
    marked = spans.withColumn("_new", F.when(F.col("a") <= reach, 0).otherwise(1)).withColumn("_island", F.sum("_new").over(order))
    return marked.groupBy(*keys, "_island").agg(F.min("a").alias("a"), F.max("e").alias("e")).drop("_island")


def target_spans(targets: DataFrame) -> DataFrame:
    """One row per target key: its live spans [a, e), united, and its first arrival.

    Copies fall together in the partial aggregation; spans are then united per key and month of arrival
    and only their unions per key, so that a hot key's rows are never all in one group.
    A row removed no later than it arrived was never live but still shows that the key existed.
    """
    known = targets.groupBy("target", "ref_key").agg(
        F.min("arrived_at").alias("first_arrival"), F.max(F.col("arrived_at").isNull()).alias("undated")
    )
    end = F.coalesce(F.col("removed_at"), F.lit(_OPEN).cast("timestamp_ntz"))
    live = (
        targets.select("target", "ref_key", F.col("arrived_at").alias("a"), end.alias("e"))
        .where(F.col("a") < F.col("e"))
        .groupBy("target", "ref_key", "a")
        .agg(F.max("e").alias("e"))
        .withColumn("_month", F.date_trunc("month", "a"))
    )
    live = _merge_spans(_merge_spans(live, ["target", "ref_key", "_month"]).drop("_month"), ["target", "ref_key"])
    spans = live.groupBy("target", "ref_key").agg(F.sort_array(F.collect_list(F.struct("a", "e"))).alias("spans"))
    return known.join(spans, ["target", "ref_key"], "left").withColumn(
        "spans", F.coalesce("spans", F.array().cast("array<struct<a:timestamp_ntz,e:timestamp_ntz>>"))
    )


def _live_at(lo, hi):
    return F.exists("spans", lambda s: (s["a"] <= lo) & (s["e"] > hi))


def _verdict() -> F.Column:
    """Of a whole (key, month): ok, one reason, or 'mixed' if its records must be looked at singly."""
    touched = F.exists("spans", lambda s: (s["a"] <= F.col("t_hi")) & (s["e"] > F.col("t_lo")))
    return (
        F.when(F.col("first_arrival").isNull() & F.col("undated").isNull(), "missing")
        .when(F.col("t_lo").isNull(), "deleted")
        .when(_live_at(F.col("t_lo"), F.col("t_hi")), "ok")
        .when(~F.col("undated") & (F.col("first_arrival") > F.col("t_hi")), "late")
        .when(~touched & (F.col("undated") | (F.col("first_arrival") <= F.col("t_lo"))), "deleted")
        .otherwise("mixed")
    )


def _resolve(refs: DataFrame, per: DataFrame, spans: DataFrame, broadcast: bool, salt: int = 1) -> DataFrame:
    """``salt``: parts that the references of a key are spread over, each of which meets a copy of the key's judgements."""
    side = F.broadcast if broadcast else (lambda d: d)
    judged = per.join(side(spans), ["target", "ref_key"], "left").withColumn("verdict", _verdict()).where("verdict <> 'ok'")
    judged = judged.select(
        "target", "ref_key", F.col("ref_month").alias("_m"), "verdict", "first_arrival", "undated", F.when(F.col("verdict") == "mixed", F.col("spans")).alias("spans")
    )
    judged = judged.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))) if salt > 1 else F.lit(0))
    refs = refs.withColumn("_salt", F.pmod(F.xxhash64("record_id", "t"), F.lit(salt)).cast("int"))
    on = (refs["target"] == judged["target"]) & (refs["ref_key"] == judged["ref_key"]) & refs["ref_month"].eqNullSafe(judged["_m"])
    if salt > 1:
        on = on & (refs["_salt"] == judged["_part"])
    single = (
        F.when(F.col("verdict") != "mixed", F.col("verdict"))
        .when(_live_at(F.col("t"), F.col("t")), "ok")
        .when(~F.col("undated") & (F.col("first_arrival") > F.col("t")), "late")
        .otherwise("deleted")
    )
    return refs.join(side(judged), on).select("ref_field", "record_id", single.alias("reason"), "ref_month").where("reason <> 'ok'")


def orphan_references(
    refs: DataFrame, targets: DataFrame, heavy_keys: int = HEAVY_KEYS, heavy_min: int = HEAVY_MIN, broadcast_spans: int = BROADCAST_SPANS
) -> DataFrame:
    """One row per reference without a target row that is live at the record's time.

    ``refs``: (ref_field, target, record_id, ref_key, t) as of :func:`references`, united over the referring
    columns; ``targets``: as of :func:`target_rows`. Result: (ref_field, record_id, reason, ref_month).

    Defined results: a null or empty reference is no reference; a record without any time is ``missing`` if its
    key has no row and else ``deleted``, with a null month; a target row without arrived_at is never live but
    exists; repeated records come out as often as they stand in the input; empty tables give no rows (no
    references) or ``missing`` throughout (no targets). Other columns of the inputs are not looked at.
    """
    refs = refs.withColumn("ref_month", F.date_format("t", "yyyy-MM"))
    per = refs.groupBy("target", "ref_key", "ref_month").agg(F.count("*").alias("n"), F.min("t").alias("t_lo"), F.max("t").alias("t_hi"))
    spans = target_spans(targets)
    least = max(heavy_min, refs.count() // heavy_keys)
    keys = materialize(per.groupBy("target", "ref_key").agg(F.sum("n").alias("n")).where(F.col("n") > least).select("target", "ref_key"))
    if not keys.count():
        return _resolve(refs, per, spans, False)
    heavy = F.broadcast(keys)  # at most heavy_keys rows
    pick = lambda d, how: d.join(heavy, ["target", "ref_key"], how)
    heavy_spans = pick(spans, "left_semi")
    small = (heavy_spans.agg(F.sum(F.size("spans"))).first()[0] or 0) <= broadcast_spans
    hot_per = pick(per, "left_semi")
    small = small and hot_per.count() <= broadcast_spans  # a row per heavy key and month
    hot = _resolve(pick(refs, "left_semi"), hot_per, heavy_spans, small, 1 if small else SALT)
    return hot.unionByName(_resolve(pick(refs, "left_anti"), pick(per, "left_anti"), spans, False))


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans per referring column, month and reason."""
    return orphans.groupBy("ref_field", "ref_month", "reason").agg(F.count("*").alias("orphans"))
