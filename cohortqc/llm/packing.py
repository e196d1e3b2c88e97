"""Filling fixed-capacity containers with items (problem 8).

Mixture-controlled packing: every source has a queue of items. A container (window) is filled by deficit
round-robin: with each container every source is credited its target share of the capacity; the source with the
largest credit gives its largest item that still fits, until no queue has one; what a source is ahead or behind is
carried to the next container. Only an item longer than a container is split: into full containers and one rest,
which is queued like any item.

Scale: items are spread over shards of about SHARD_TOKENS by a hash of their identifier, so a source or a
group of copies is never in one task. A shard's first deficits are what the shards before it leave over; since
a shard packs all its items, that is known from the totals per shard and source alone (a table in long form, however
many sources there are) and needs no order of execution.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortqc.llm.tokens import VOCABULARY, decoder, document_sizes, encoder
from cohortqc.session import materialize, release

CAPACITY = 2048
SHARD_TOKENS = 4_000_000
#: The deficits that shards start with are broadcast up to so many rows (shard, source).
BROADCAST_STARTS = 500_000
_PLACED = "container_id long, place int, doc_id long, part int, first_token long, tokens long, source string"


class Queue:
    """Items by size: the largest size not above r is found with one shift of a bit set."""

    def __init__(self, sizes: np.ndarray, items: np.ndarray):
        self.by_size: dict[int, list[int]] = {}
        for size, item in zip(sizes.tolist(), items.tolist(), strict=True):
            self.by_size.setdefault(size, []).append(item)
        self.bits = sum(1 << size for size in self.by_size)

    def fit(self, room: int) -> int:
        return (self.bits & ((2 << room) - 1)).bit_length() - 1

    def take(self, size: int) -> int:
        left = self.by_size[size]
        item = left.pop()
        if not left:
            self.bits ^= 1 << size
        return item


def pack(sizes: np.ndarray, sources: np.ndarray, shares: np.ndarray, deficits: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Containers as lists of item numbers; sizes are 1..capacity, sources 0..len(shares)-1."""
    order = np.argsort(sources, kind="stable")
    cuts = np.flatnonzero(np.diff(sources[order])) + 1
    queues = {int(sources[at[0]]): Queue(sizes[at], at) for at in np.split(order, cuts) if len(at)}
    behind = {s: float(deficits[s]) for s in queues}
    share = {s: float(shares[s]) for s in queues}
    containers = []
    while queues:
        room, held = capacity, []
        waiting = [(-behind[s] - share[s] * capacity, s) for s in queues]
        heapq.heapify(waiting)
        while room and waiting:
            credit, s = waiting[0]
            size = queues[s].fit(room)
            if size <= 0:  # nothing of this source fits any more: room only shrinks
                heapq.heappop(waiting)
                continue
            held.append(queues[s].take(size))
            behind[s] -= size
            room -= size
            if queues[s].bits:
                heapq.heapreplace(waiting, (credit + size, s))
            else:
                heapq.heappop(waiting)
                del queues[s]
        for s in queues:
            behind[s] += share[s] * (capacity - room)
        containers.append(held)
    return containers


def _packer(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts).to_pandas()
        for shard, rows in table.groupby("shard", sort=True):
            rows = rows.sort_values(["order", "doc_id", "part"])
            _, at, code = np.unique(rows["source_key"].to_numpy(str), return_index=True, return_inverse=True)
            first = rows.iloc[at]
            containers = pack(rows["tokens"].to_numpy(), code, first["share"].to_numpy(), first["deficit"].to_numpy(), capacity)
            at = np.fromiter((i for c in containers for i in c), np.int64)
            length = np.array([len(c) for c in containers])
            number = np.repeat(np.arange(len(containers)), length)
            place = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
            out = rows.iloc[at]
            yield pa.RecordBatch.from_pandas(
                pd.DataFrame(
                    {"container_id": int(shard) * 2**32 + number, "place": place.astype("int32"), "doc_id": out["doc_id"].to_numpy(), "part": out["part"].to_numpy().astype("int32"), "first_token": out["first_token"].to_numpy(), "tokens": out["tokens"].to_numpy(), "source": out["source"].to_numpy()}
                ),
                preserve_index=False,
            )

    return run


def fill_containers(
    sizes: DataFrame, capacity: int = CAPACITY, target_shares: dict[str | None, float] | None = None, shard_tokens: int = SHARD_TOKENS, seed: int = 0
) -> DataFrame:
    """(container_id, place, doc_id, part, first_token, tokens, source): where every token of every item went.

    ``sizes``: (doc_id, source, tokens). ``target_shares``: share per source; by default the sources' own shares,
    so that all queues run dry together and each container looks like the whole. Sources without a given share get 0
    and fill what room is left.

    Defined results: items of size null or below 1 are left out; a null source is a source of its own; repeated
    rows are packed as often as they stand; an empty table gives no rows; other columns are not looked at.
    """
    sizes = sizes.select("doc_id", "source", "tokens").where("tokens > 0")
    # whole containers of long items come first; the rest (all of a short item) is queued
    whole = F.floor((F.col("tokens") - 1) / capacity).cast("int")
    cut = sizes.withColumn("shard_hash", F.xxhash64("doc_id", F.lit(seed))).select(
        "doc_id", "source", "shard_hash", F.explode(F.sequence(F.lit(0), whole)).alias("part"), F.col("tokens").alias("all")
    )
    cut = cut.select(
        "doc_id", "source", "shard_hash", "part", (F.col("part").cast("long") * capacity).alias("first_token"),
        F.least(F.lit(capacity), F.col("all") - F.col("part").cast("long") * capacity).cast("long").alias("tokens"),
    )
    items = cut.withColumn("order", F.xxhash64("doc_id", F.lit(seed + 1))).withColumn("source_key", _source_key())
    everything = sizes.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    shards = max(1, math.ceil(everything / shard_tokens))
    items = items.withColumn("shard", F.pmod("shard_hash", F.lit(shards))).drop("shard_hash")
    # tokens per shard and source; the sums over the shards before are the deficits a shard starts with
    per = materialize(items.groupBy("shard", "source_key").agg(F.sum("tokens").alias("t")))
    before = W.rowsBetween(W.unboundedPreceding, -1)
    whole = per.groupBy("shard").agg(F.sum("t").alias("all")).withColumn("all", F.coalesce(F.sum("all").over(before.orderBy("shard")), F.lit(0)))  # one short row per shard
    own = per.withColumn("own", F.coalesce(F.sum("t").over(before.partitionBy("source_key").orderBy("shard")), F.lit(0)))
    if target_shares is None:
        share = per.groupBy("source_key").agg((F.sum("t").cast("double") / max(1, everything)).alias("share"))
    else:
        share = sizes.sparkSession.createDataFrame([(n, float(x)) for n, x in target_shares.items()], "source string, share double").select(_source_key().alias("source_key"), "share")
    first = own.join(whole, "shard").join(share, "source_key", "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    first = materialize(first.select("shard", "source_key", "share", (F.col("share") * F.col("all") - F.col("own")).alias("deficit")))
    release(per)
    tasks = min(shards, max(sizes.sparkSession.sparkContext.defaultParallelism, shards // 4))
    spread = items.repartition(tasks, "shard")
    if first.count() <= BROADCAST_STARTS:
        joined = spread.join(F.broadcast(first), ["shard", "source_key"])
    else:  # a shard and source have at most a shard's items
        joined = items.join(first, ["shard", "source_key"]).repartition(tasks, "shard")
    return joined.mapInArrow(_packer(capacity), _PLACED)


def _source_key() -> Column:
    """A source's name, and for a null source one that no name can be."""
    return F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source"))


def pack_documents(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, **options) -> DataFrame:
    return fill_containers(materialize(document_sizes(documents, vocabulary)), capacity, **options)


def container_tokens(placed: DataFrame, documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(container_id, place, doc_id, part, ids): the token ids of every piece. A document is encoded once, whatever its parts.

    ``doc_id`` must be unique in ``documents``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows = []
            for doc, ids, parts in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist()), batch.column("parts").to_pylist(), strict=True):
                rows += [(p["container_id"], p["place"], doc, p["part"], ids[p["first_token"] : p["first_token"] + p["tokens"]]) for p in parts]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["container_id", "place", "doc_id", "part", "ids"])

    parts = placed.groupBy("doc_id").agg(F.collect_list(F.struct("container_id", "place", "part", "first_token", "tokens")).alias("parts"))  # of one document
    texts = documents.select("doc_id", "text").where("text is not null").join(parts, "doc_id")
    return texts.mapInArrow(run, "container_id long, place int, doc_id long, part int, ids array<int>")


def reassembled(placed: DataFrame, documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text): each document decoded again from the pieces in its containers. ``doc_id`` must be unique in ``documents``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = decoder(vocabulary)
        for batch in batches:
            texts = [decode([i for p in sorted(pieces, key=lambda p: p["part"]) for i in p["ids"]]) for pieces in batch.column("pieces").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    pieces = container_tokens(placed, documents, vocabulary).groupBy("doc_id").agg(F.collect_list(F.struct("part", "ids")).alias("pieces"))  # of one document
    return pieces.mapInArrow(run, "doc_id long, text string")


def audit(placed: DataFrame, sizes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(rule, violations): containers beyond the capacity, short items that were split, items of which tokens are missing
    or stand twice, and gaps in the places of a container. ``doc_id`` must be unique in ``sizes``."""
    per = placed.groupBy("container_id").agg(F.sum("tokens").alias("t"), F.count("*").alias("n"), F.max("place").alias("last"), F.count_distinct("place").alias("places"))
    per = per.agg(F.count_if(F.col("t") > capacity).alias("over_capacity"), F.count_if((F.col("last") + 1 != F.col("n")) | (F.col("places") != F.col("n"))).alias("gaps_in_places"))
    end = F.col("first_token") + F.col("tokens")
    docs = placed.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("tokens").alias("t"), F.max(end).alias("last"), F.count_distinct("first_token").alias("starts"))
    docs = sizes.where("tokens > 0").select("doc_id", "tokens").join(docs, "doc_id", "full")
    docs = docs.agg(
        F.count_if(F.coalesce((F.col("n") > 1) & (F.col("tokens") <= capacity), F.lit(False))).alias("short_split"),
        F.count_if(~F.coalesce((F.col("t") == F.col("tokens")) & (F.col("last") == F.col("tokens")) & (F.col("starts") == F.col("n")), F.lit(False))).alias("incomplete"),
    )
    rules = ["over_capacity", "gaps_in_places", "short_split", "incomplete"]
    return per.crossJoin(docs).unpivot([], rules, "rule", "violations")  # one row each


def fill_report(placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(fill_percent, containers, items, tokens): how full the containers are, by whole percents."""
    per = placed.groupBy("container_id").agg(F.sum("tokens").alias("t"), F.count("*").alias("items"))
    return per.groupBy(F.floor(F.col("t") * 100 / capacity).cast("int").alias("fill_percent")).agg(F.count("*").alias("containers"), F.sum("items").alias("items"), F.sum("t").alias("tokens"))
