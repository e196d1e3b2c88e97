"""Mixing sources to target weights (problem 9).

Subset-sum budget fitting: documents are counted by exact token length per source; whole copies of the source
take what they can of its budget; of the rest every length first gives its proportional number of documents, and
a bounded-knapsack dynamic program over the lengths still available hits the remaining budget exactly, or comes as
near from below as these lengths allow. Which documents of a length are taken is decided by a seeded hash.

Scale: the program works on counts by length, one source per task, however many documents there are. The
selection ranks documents only within (source, length, hash bucket); a length that many documents share is
divided into buckets of about BUCKET_DOCS, taken whole but for the last.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortqc.llm.tokens import VOCABULARY, document_sizes
from cohortqc.session import bounded_rows, materialize

#: Rows of the table of targets.
SOURCES = 10_000
BUCKET_DOCS = 20_000
#: Budgets up to this are left to the dynamic program (more, if no proportional choice comes so near).
PROGRAM_TOKENS = 16_384
#: Plans of up to so many (source, length) rows are broadcast.
BROADCAST_PLAN = 500_000


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take (at most ``counts``) for the largest possible sum not above ``budget``.

    Counts are split into powers of two; for each sum the item that first reached it is remembered, which had
    to be added to a sum reached by earlier items, so that following it back uses no item twice.
    """
    taken = np.zeros(len(lengths), np.int64)
    if budget <= 0:
        return taken
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    by = np.full(budget + 1, -1, np.int64)
    items: list[tuple[int, int]] = []
    for k in np.argsort(-lengths, kind="stable"):
        length, left, size = int(lengths[k]), int(counts[k]), 1
        left = min(left, budget // length)
        while left and not reached[budget]:
            size_now = min(size, left)
            weight = length * size_now
            fresh = np.flatnonzero(reached[: budget + 1 - weight] & ~reached[weight:]) + weight
            by[fresh] = len(items)
            reached[fresh] = True
            items.append((int(k), size_now))
            left -= size_now
            size *= 2
        if reached[budget]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        k, size = items[by[at]]
        taken[k] += size
        at -= int(lengths[k]) * size
    return taken


def choose(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Number of documents of each length whose total is ``budget``, in proportion to the counts as far as possible."""
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    exact = [int(c) * budget for c in counts]
    take = np.array([e // total for e in exact], np.int64)
    rest = budget - int((lengths * take).sum())
    parts = np.array([(e % total) / total for e in exact])
    for k in np.argsort(-parts, kind="stable"):  # largest remainders first, until the program can do the rest
        if rest <= PROGRAM_TOKENS:
            break
        if parts[k] > 0 and lengths[k] <= rest and take[k] < counts[k]:
            take[k] += 1
            rest -= int(lengths[k])
    for k in np.argsort(lengths, kind="stable"):  # the shortest are decided anew: they fit most remainders
        back = min(2, int(take[k]))
        if rest + back * int(lengths[k]) > 2 * PROGRAM_TOKENS:
            break
        take[k] -= back
        rest += back * int(lengths[k])
    return take + knapsack(lengths, counts - take, rest)


def budgets(available: dict[str, int], targets: dict[str, tuple[Fraction, int]], total: int | None = None) -> dict[str, int]:
    """Tokens per source: the largest total that all sources can fill (or ``total``, if smaller), split by share.

    Sources without tokens cannot reach any share; the others then divide the total in proportion.
    """
    live = {s: (share, most) for s, (share, most) in targets.items() if available.get(s, 0) > 0 and share > 0 and most > 0}
    weight = sum((share for share, _ in live.values()), Fraction(0))
    if not live:
        return {}
    largest = min(math.floor(Fraction(most * available[s]) / (share / weight)) for s, (share, most) in live.items())
    largest = largest if total is None else min(total, largest)
    exact = {s: largest * share / weight for s, (share, _) in live.items()}
    out = {s: math.floor(e) for s, e in exact.items()}
    for s in sorted(exact, key=lambda s: (out[s] - exact[s], s))[: largest - sum(out.values())]:
        out[s] = min(out[s] + 1, live[s][1] * available[s])
    return out


def mix_sources(sizes: DataFrame, mix_targets: DataFrame, total: int | None = None, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """The documents to use with their number of copies, and the report of shares.

    Documents: (doc_id, source, tokens, copies). Report: (source, target_share, max_repeats, available, budget,
    tokens, actual_share, docs, most_copies), one row per target.

    Defined results: documents of a null source or one without target are not used; null or negative shares and
    repeats count as 0; repeated rows are documents of their own; an empty table gives no documents and shares of
    null; other columns are not looked at.
    """
    spark = sizes.sparkSession
    rows = bounded_rows(mix_targets.select(F.lower(F.trim("source")).alias("source"), "target_share", "max_repeats").where("source is not null"), SOURCES, "targets")
    targets = {r["source"]: (max(Fraction(0), Fraction(str(r["target_share"] or 0))), max(0, r["max_repeats"] or 0)) for r in rows}
    sizes = sizes.select("doc_id", "source", "tokens").where("tokens > 0 and source is not null")
    lengths = sizes.groupBy("source", "tokens").agg(F.count("*").alias("docs"))
    lengths = materialize(lengths.join(F.broadcast(spark.createDataFrame([(s,) for s in targets], "source string")), "source"))
    available = {r["source"]: int(r["t"]) for r in lengths.groupBy("source").agg(F.sum(F.col("tokens") * F.col("docs")).alias("t")).collect()}
    goal = budgets(available, targets, total)

    def plan(rows: pd.DataFrame) -> pd.DataFrame:
        source = rows["source"].iloc[0]
        rows = rows.sort_values("tokens")
        length, count = rows["tokens"].to_numpy(), rows["docs"].to_numpy()
        budget = goal.get(source, 0)
        whole = min(budget // available[source], targets[source][1])
        part = choose(length, count, budget - whole * available[source]) if whole < targets[source][1] else np.zeros(len(rows), np.int64)
        return pd.DataFrame({"source": source, "tokens": length, "docs": count, "whole": whole, "extra": part})

    kinds = "source string, tokens long, docs long, whole long, extra long"
    plans = materialize(lengths.groupBy("source").applyInPandas(plan, kinds))
    small = plans.count() <= BROADCAST_PLAN
    buckets = F.greatest(F.lit(1), F.ceil(F.col("docs") / BUCKET_DOCS))
    luck = F.xxhash64("doc_id", F.lit(seed))
    known = sizes.join(F.broadcast(plans) if small else plans, ["source", "tokens"]).where("whole > 0 or extra > 0")
    known = known.withColumn("luck", luck).withColumn("bucket", F.pmod("luck", buckets))
    # lengths of which some but not all documents are taken once more
    some = (F.col("extra") > 0) & (F.col("extra") < F.col("docs"))
    per = known.where(some).groupBy("source", "tokens", "bucket").agg(F.count("*").alias("n"), F.first("extra").alias("extra"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("source", "tokens").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    per = per.select("source", "tokens", "bucket", F.greatest(F.lit(0), F.least("n", F.col("extra") - before)).alias("quota"), "n")
    rank = F.row_number().over(W.partitionBy("source", "tokens", "bucket").orderBy("luck", "doc_id"))
    ranked = known.where(some).join(per, ["source", "tokens", "bucket"])
    cut = ranked.where("quota > 0 and quota < n").withColumn("rank", rank).withColumn("more", (F.col("rank") <= F.col("quota")).cast("long")).drop("rank")
    full = ranked.where("quota = 0 or quota = n").withColumn("more", (F.col("quota") > 0).cast("long"))
    plain = known.where(~some).withColumn("more", (F.col("extra") > 0).cast("long"))
    cols = ["doc_id", "source", "tokens", (F.col("whole") + F.col("more")).cast("long").alias("copies")]
    used = plain.select(*cols).unionByName(full.select(*cols)).unionByName(cut.select(*cols)).where("copies > 0")

    report_rows = [(s, float(share), most, available.get(s, 0), goal.get(s, 0)) for s, (share, most) in sorted(targets.items())]
    base = spark.createDataFrame(report_rows, "source string, target_share double, max_repeats int, available long, budget long")
    got = used.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("docs"), F.max("copies").alias("most_copies"))
    report = base.join(got, "source", "left").fillna(0, ["tokens", "docs", "most_copies"])
    whole = F.sum("tokens").over(W.partitionBy(F.lit(0)))  # one row per target
    report = report.withColumn("actual_share", F.try_divide(F.col("tokens").cast("double"), F.nullif(whole, F.lit(0)).cast("double")))
    return used, report.select("source", "target_share", "max_repeats", "available", "budget", "tokens", "actual_share", "docs", "most_copies")


def audit(used: DataFrame, report: DataFrame, sizes: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, docs_unique, repeats_kept, budget_kept, share_kept) per target: every document
    stands once in ``used`` and at most max_repeats times in the mixture; tokens and copies add up to the report and
    to no more than the budget, and no document of the source that could be used once more fits into what is left of it;
    the share is off by no more than what is left of all budgets, and a token per source. doc_id must be unique."""
    per = used.groupBy("source").agg(F.count("*").alias("rows"), F.count_distinct("doc_id").alias("ids"), F.max("copies").alias("most"), F.sum(F.col("tokens") * F.col("copies")).alias("sum"))
    limit = report.select("source", F.least(F.col("max_repeats"), F.floor(F.try_divide(F.col("budget").cast("double"), F.col("available").cast("double"))) + 1).alias("limit"))
    spare = sizes.where("tokens > 0").join(F.broadcast(limit), "source").join(used.select("doc_id", "copies"), "doc_id", "left")
    spare = spare.where(F.coalesce("copies", F.lit(0)) < F.col("limit")).groupBy("source").agg(F.min("tokens").alias("spare"))
    j = report.join(per, "source", "left").join(spare, "source", "left").fillna(0, ["rows", "ids", "most", "sum"])
    whole = report.agg(F.sum("tokens").alias("all"), F.sum(F.col("budget") - F.col("tokens")).alias("left"), F.count("*").alias("sources"), F.sum(F.when(F.col("budget") > 0, F.col("target_share"))).alias("live"))
    j = j.crossJoin(F.broadcast(whole))  # one row
    left = F.col("budget") - F.col("tokens")
    off = F.abs(F.coalesce("actual_share", F.lit(0.0)) - F.when(F.col("budget") > 0, F.try_divide("target_share", "live")).otherwise(0.0))
    return j.select(
        "source", "target_share", "max_repeats",
        (F.col("rows") == F.col("ids")).alias("docs_unique"), (F.col("most") <= F.col("max_repeats")).alias("repeats_kept"),
        ((F.col("sum") == F.col("tokens")) & (left >= 0) & (F.col("spare").isNull() | (F.col("spare") > left))).alias("budget_kept"),
        (off <= F.coalesce(F.try_divide((F.col("left") + F.col("sources")).cast("double"), F.col("all").cast("double")), F.lit(0.0))).alias("share_kept"),
    )


def mix_documents(documents: DataFrame, mix_targets: DataFrame, vocabulary: str = VOCABULARY, **options) -> tuple[DataFrame, DataFrame]:
    return mix_sources(materialize(document_sizes(documents, vocabulary)), mix_targets, **options)
