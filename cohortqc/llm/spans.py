"""Long exact spans shared between records (problem 10).

Suffix automata of reference shards: the texts' matching statistics against an automaton give the maximal spans
above the length threshold, the automaton's states tell which records share a span, and the spans are removed.

Sending every shard's automaton to every document would be quadratic, so documents and shards are brought together by
anchors first, without loss. An anchor is the smallest hash of half a span within any MIN_SPAN characters
(winnowing): two texts with a common run of MIN_SPAN characters both select the same anchor inside it. Only
anchors of at least two different texts go on, each with the window of text around it that any run of MIN_SPAN
characters holding the anchor must touch. The distinct windows of one anchor belong to one reference shard; its
automaton is built in the task that streams the shard's windows through it. The state of a window's last
MIN_SPAN characters stands for exactly this string, so windows that meet in a state share it, character for character.

Scale: whole copies are represented by one of them until the pairs are written; equal windows of an anchor are
one window. An anchor with more than SHARD_WINDOWS distinct windows (a standing text in ever new surroundings) is
too much for one automaton: its windows are parted by longer anchors, each the old one with characters of the window to
its left or its right, one of which every common run must hold. This repeats for anchors that are still too
frequent, at most until an anchor is a whole run. Hashes only route; every span comes from an automaton.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortqc.llm.components import connected_groups
from cohortqc.session import materialize, release

MIN_SPAN = 200
#: Characters hashed as a unit when texts are processed; longer texts are cut with overlap.
BLOCK_CHARS = 400_000
#: Characters of one reference shard.
SHARD_CHARS = 60_000
#: Distinct windows of one anchor that one shard takes.
SHARD_WINDOWS = 48
#: Key lists of up to so many rows are broadcast.
BROADCAST_KEYS = 300_000
#: A key of more rows is met by broadcast in any case; there are at most rows / HEAVY_ROWS of them.
HEAVY_ROWS = 1_000_000
#: Members of a group that one task pairs with all others.
PAIR_BLOCK = 2_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Winnower:
    """Selects anchors of texts; the powers of the hash's base are computed once."""

    def __init__(self, span: int = MIN_SPAN, block: int = BLOCK_CHARS):
        self.k = span // 2
        self.w = span - self.k + 1
        self.span, self.block = span, max(block, 4 * span)
        ones = np.uint64(1)
        n = self.block + 1
        self.up = np.cumprod(np.concatenate([[ones], np.full(n, _BASE)]), dtype=np.uint64)
        self.down = np.cumprod(np.concatenate([[ones], np.full(n, _INVERSE)]), dtype=np.uint64)

    def _slide(self, x: np.ndarray, pick) -> np.ndarray:
        step = 1
        while step * 2 <= self.w:
            x = pick(x[:-step], x[step:])
            step *= 2
        rest = self.w - step
        return pick(x[:-rest], x[rest:]) if rest else x

    def select(self, chars: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the anchors of concatenated texts; room[i]: characters from i to its text's end."""
        n = len(chars)
        if n < self.span:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        total = np.concatenate([[np.uint64(0)], np.cumsum(_mix(chars.astype(np.uint64) + np.uint64(1)) * self.up[:n], dtype=np.uint64)])
        h = _mix((total[self.k :] - total[: -self.k]) * self.down[: n - self.k + 1])
        least = self._slide(h, np.minimum)
        least[room[: len(least)] < self.span] = 0  # the window would leave its text
        pad = np.zeros(self.w - 1, np.uint64)
        largest = self._slide(np.concatenate([pad, least, pad]), np.maximum)[: len(h)]
        at = np.flatnonzero((largest == h) & (h != 0))
        return at, h[at]

    def texts(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text number, position, hash) of the anchors of many texts, in pieces."""
        piece: list[tuple[int, int, np.ndarray]] = []
        held = 0
        for number, text in enumerate(texts):
            chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            for start in range(0, max(1, len(chars) - self.span + 1), self.block - self.span + 1):
                part = chars[start : start + self.block]
                if held + len(part) > self.block:
                    yield self._piece(piece)
                    piece, held = [], 0
                piece.append((number, start, part))
                held += len(part)
        if piece:
            yield self._piece(piece)

    def _piece(self, piece):
        size = np.array([len(p) for _, _, p in piece])
        end = np.cumsum(size)
        room = np.repeat(end, size) - np.arange(end[-1])
        at, h = self.select(np.concatenate([p for _, _, p in piece]), room)
        which = np.searchsorted(end, at, "right")
        number = np.array([n for n, _, _ in piece])[which]
        start = np.array([s for _, s, _ in piece])[which]
        return number, at - (end - size)[which] + start, h


def _anchors(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnower = Winnower(span)
        for batch in batches:
            doc, tk = batch.column("doc_id"), batch.column("text_key")
            for number, at, h in winnower.texts(batch.column("text").to_pylist()):
                rows = pa.array(number)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), tk.take(rows), doc.take(rows), pa.array(at.astype(np.int32))], ["key", "text_key", "doc_id", "pos"])

    return run


_ROW = "key long, doc_id long, start int, core int, size int, window string"


def _slices(span: int):
    """(doc_id, text, hits) -> the windows around a text's anchors; the text is passed once, whatever their number."""
    half = span // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _ROW.split(", ")]
        for batch in batches:
            hits = batch.column("hits")
            ends = hits.offsets.to_numpy()
            flat = hits.flatten()
            key, pos = flat.field("key"), flat.field("pos").to_numpy(zero_copy_only=False)
            base = ends[0]
            for k, text in enumerate(batch.column("text").to_pylist()):
                a, b = ends[k] - base, ends[k + 1] - base
                at = pos[a:b]
                start = np.maximum(0, at - (span - half)).astype(np.int32)
                windows = [text[x : y + span] for x, y in zip(start.tolist(), at.tolist(), strict=True)]
                doc = pa.repeat(batch.column("doc_id")[k], b - a)
                cols = [key[a:b], doc, pa.array(start), pa.array((at - start).astype(np.int32)), pa.repeat(pa.scalar(half, pa.int32()), b - a), pa.array(windows, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


class Automaton:
    """Suffix automaton of several texts, built online."""

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, text: str) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for c in text:
            q = nxt[last].get(c)
            if q is not None and length[q] == length[last] + 1:
                last = q
                continue
            if q is None:
                cur = len(nxt)
                nxt.append({})
                length.append(length[last] + 1)
                link.append(0)
                p = last
                while p != -1 and c not in (at := nxt[p]):
                    at[c] = cur
                    p = link[p]
                if p == -1:
                    last = cur
                    continue
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                    last = cur
                    continue
            else:
                cur, p = -1, last
            clone = len(nxt)
            nxt.append(nxt[q].copy())
            length.append(length[p] + 1)
            link.append(link[q])
            while p != -1 and nxt[p].get(c) == q:
                nxt[p][c] = clone
                p = link[p]
            link[q] = clone
            if cur >= 0:
                link[cur] = clone
                last = cur
            else:
                last = clone

    def stream(self, text: str, least: int) -> list[int]:
        """Matching statistics of a text, cut to ``least``: of each end position the state that holds exactly the last
        ``least`` characters, or -1 if they do not occur."""
        nxt, link, length = self.next, self.link, self.length
        state, matched, out = 0, 0, []
        for c in text:
            while state and c not in nxt[state]:
                state = link[state]
                matched = length[state]
            follow = nxt[state].get(c)
            if follow is None:
                out.append(-1)
                continue
            state, matched = follow, matched + 1
            while length[link[state]] >= least:  # shorter suffixes of at least ``least`` characters
                state = link[state]
                matched = length[state]
            out.append(state if matched >= least else -1)
        return out


def shared_spans(windows: list[str], owners: list[tuple[int, int]], span: int = MIN_SPAN) -> tuple[list[frozenset[int]], list[list[tuple[int, int]]]]:
    """Of windows and the smallest and largest of the documents that hold each: the sets of windows that share a run of
    ``span`` characters between at least two documents, and each window's spans [from, to) of such runs."""
    automaton = Automaton()
    for w in windows:
        automaton.add(w)
    streams = [automaton.stream(w, span) for w in windows]
    holders: dict[int, set[int]] = {}
    for k, states in enumerate(streams):
        for s in set(states):
            if s >= 0:
                holders.setdefault(s, set()).add(k)
    common = {s: frozenset(h) for s, h in holders.items() if min(owners[k][0] for k in h) < max(owners[k][1] for k in h)}
    sets = sorted(set(common.values()), key=len, reverse=True)
    maximal: list[frozenset[int]] = []
    of: dict[int, list[frozenset[int]]] = {}
    for s in sets:
        if not any(s <= m for m in of.get(min(s), [])):
            maximal.append(s)
            for k in s:
                of.setdefault(k, []).append(s)
    spans = []
    for states in streams:
        found: list[tuple[int, int]] = []
        for end, s in enumerate(states, 1):
            if s in common:
                if found and end - span <= found[-1][1]:
                    found[-1] = (found[-1][0], end)
                else:
                    found.append((end - span, end))
        spans.append(found)
    return maximal, spans


_WINDOW = ("key", "w1", "w2", "window", "least_doc", "most_doc")
_SOLVED = "key long, w1 long, w2 long, groups array<long>, starts array<int>, ends array<int>"


def _shards(span: int):
    """Rows of _WINDOW, the windows of a key in one task -> groups and spans of each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(keys: list[tuple[int, int, int]], windows: list[str], owners: list[tuple[int, int]]) -> pa.RecordBatch:
            sets, spans = shared_spans(windows, owners, span)
            groups: list[list[int]] = [[] for _ in windows]
            for s in sets:
                name = hashlib.blake2b(repr(sorted(keys[k] for k in s)).encode(), digest_size=8).digest()
                for k in s:
                    groups[k].append(int.from_bytes(name, "little", signed=True))
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
            cols = [*([k[i] for k in keys] for i in range(3)), groups, [[a for a, _ in x] for x in spans], [[b for _, b in x] for x in spans]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], [c.split()[0] for c in _SOLVED.split(", ")])

        keys: list[tuple[int, int, int]] = []
        windows: list[str] = []
        owners: list[tuple[int, int]] = []
        held, before = 0, None
        for batch in batches:
            for key, w1, w2, window, *owner in zip(*(batch.column(c).to_pylist() for c in _WINDOW), strict=True):
                if held >= SHARD_CHARS and key != before:
                    yield solve(keys, windows, owners)
                    keys, windows, owners, held = [], [], [], 0
                keys.append((key, w1, w2))
                owners.append(tuple(owner))
                windows.append(window)
                held += len(window)
                before = key
        if keys:
            yield solve(keys, windows, owners)

    return run


def _meet(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join with a written table of distinct keys and their number n of rows; no key's rows come together in a task.

    A short table is broadcast whole, a long one only with its heavy keys, and the other rows are shuffled.
    """
    if table.count() <= BROADCAST_KEYS:
        return rows.join(F.broadcast(table.drop("n")), keys)
    heavy, light = table.where(F.col("n") > HEAVY_ROWS).drop("n"), table.where(F.col("n") <= HEAVY_ROWS).drop("n")
    rest = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(heavy), keys).unionByName(rest.join(light, keys))


def _longer(rows: DataFrame, span: int) -> DataFrame:
    """Each window under two longer anchors, one of which every run of ``span`` characters around the old anchor holds.

    A run has s = span - size characters beyond the anchor. It has h = ceil(s / 2) or more of them on the left, or else
    s - h + 1 or more on the right.
    """
    s = F.lit(span) - F.col("size")
    h = F.ceil(s / 2).cast("int")
    left = rows.where((F.col("size") < span) & (F.col("core") >= h)).select(
        "key", "doc_id", "start", (F.col("core") - h).alias("core"), (F.col("size") + h).alias("size"), F.substr("window", F.lit(1), F.col("core") + F.col("size") + s - h).alias("window"), F.lit(0).alias("side")
    )
    cut = F.greatest(F.lit(0), F.col("core") - h + 1)
    right = rows.where((F.col("size") < span) & (F.char_length("window") >= F.col("core") + F.col("size") + s - h + 1)).select(
        "key", "doc_id", (F.col("start") + cut).alias("start"), (F.col("core") - cut).alias("core"), (F.col("size") + s - h + 1).alias("size"), F.substr("window", cut + 1).alias("window"), F.lit(1).alias("side")
    )
    both = left.unionByName(right)
    return both.withColumn("key", F.xxhash64("key", "side", F.substr("window", F.col("core") + 1, F.col("size")))).drop("side")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, cuts) -> the text without its [a, b)."""
    for batch in batches:
        out = []
        for text, cuts in zip(batch.column("text").to_pylist(), batch.column("cuts").to_pylist(), strict=True):
            if text is None or not cuts:
                out.append(text)
                continue
            kept, end = [], 0
            for c in sorted(cuts, key=lambda c: (c["a"], c["b"])):
                if c["a"] > end:
                    kept.append(text[end : c["a"]])
                end = max(end, c["b"])
            out.append("".join([*kept, text[end:]]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])


class SharedSpans:
    """The results over one pass: :meth:`pairs`, :meth:`groups`, :meth:`classes`, :meth:`shared_chars` and :meth:`without_spans`.

    ``documents``: (doc_id long, text string). Defined results: null texts and texts shorter than ``span`` share
    nothing; rows with the same doc_id are one document and make no pair; length counts code points; other columns
    are not looked at; an empty table gives no rows.
    """

    def __init__(self, documents: DataFrame, span: int = MIN_SPAN):
        self.span = span
        self.docs = documents.select("doc_id", "text")
        long_ = self.docs.where(F.col("doc_id").isNotNull() & (F.char_length("text") >= span)).select("doc_id", F.xxhash64("text").alias("text_key"), F.md5("text").alias("text_md5"), "text")
        copies = self._copies(long_.drop("text"))
        self.copies = copies.select("doc_id", "rep").distinct()
        # the smallest doc_id stands for all copies of a text, so different texts are different documents from here on
        others = materialize(copies.where("doc_id <> rep").select("doc_id", "text_key", "text_md5"))
        reps = long_.join(F.broadcast(others) if others.count() <= BROADCAST_KEYS else others, ["doc_id", "text_key", "text_md5"], "left_anti").select("doc_id", "text_key", "text")
        self.members, self.spans = self._resolve(self._windows(reps))
        release(others)

    def _copies(self, docs: DataFrame) -> DataFrame:
        """(doc_id, text_key, text_md5, rep) of every document whose whole text stands in several; rep is the smallest of them."""
        key = ["text_key", "text_md5"]
        groups = docs.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("rep < last")
        groups = materialize(groups.drop("last"))
        return materialize(_meet(docs, groups, key))

    def _windows(self, docs: DataFrame) -> DataFrame:
        """Rows of _ROW: the windows around the anchors that several texts hold."""
        found = materialize(docs.mapInArrow(_anchors(self.span), "key long, text_key long, doc_id long, pos int"))
        shared = materialize(found.groupBy("key").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"), F.count("*").alias("n")).where("x < y").select("key", "n"))
        hits = _meet(found, shared, ["key"]).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("key", "pos")).alias("hits"))  # of one text, fewer than its characters
        hits = materialize(hits)  # a written table has a known size: while it is small the texts need no shuffle
        rows = materialize(docs.join(hits, ["doc_id", "text_key"]).select("doc_id", "text", "hits").mapInArrow(_slices(self.span), _ROW))
        release(found, shared, hits)
        return rows

    def _resolve(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(grp, doc_id) of representatives that share a run, and (doc_id, a, b) of their shared spans."""
        spark, span = rows.sparkSession, self.span
        key = ["key", "w1", "w2"]
        members, spans = [], []
        while True:
            rows = rows.withColumns({"w1": F.xxhash64("window"), "w2": F.xxhash64(F.lit(1), "window")})
            distinct = materialize(rows.groupBy(*key).agg(F.first("window").alias("window"), F.min("doc_id").alias("least_doc"), F.max("doc_id").alias("most_doc"), F.count("*").alias("n"), F.min("size").alias("size")))
            per = materialize(distinct.groupBy("key").agg(F.count("*").alias("kinds"), F.sum("n").alias("n"), F.min("size").alias("size")).withColumn("much", (F.col("kinds") > SHARD_WINDOWS) & (F.col("size") < span)))
            few = _meet(distinct.drop("n", "size"), per.where("not much").select("key", F.col("kinds").alias("n")), ["key"]).select(*_WINDOW)
            tasks = max(spark.sparkContext.defaultParallelism * 2, per.count() // 10_000)
            solved = few.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(_shards(span), _SOLVED).where(F.size("groups") > 0)
            solved = materialize(solved.join(distinct.select(*key, "n"), key))
            placed = _meet(rows.select(*key, "doc_id", "start"), solved, key)
            members.append(placed.select(F.explode("groups").alias("grp"), "doc_id"))
            at = placed.select("doc_id", "start", F.explode(F.arrays_zip("starts", "ends")).alias("s"))
            spans.append(at.select("doc_id", (F.col("start") + F.col("s.starts")).alias("a"), (F.col("start") + F.col("s.ends")).alias("b")))
            much = materialize(per.where("much").select("key", "n"))
            if not much.count():
                break
            rows = materialize(_longer(_meet(rows.drop("w1", "w2"), much, ["key"]), span))
            shared = materialize(rows.groupBy("key").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"), F.count("*").alias("n")).where("x < y").select("key", "n"))
            rows = _meet(rows, shared, ["key"])
        united = lambda parts: functools.reduce(DataFrame.unionByName, parts)
        return united(members).distinct(), united(spans).distinct()

    def groups(self) -> DataFrame:
        """(grp, doc_id): sets of documents that share a run, each of them with each; copies stand behind their
        smallest doc_id (``copies``: doc_id, rep). Every pair of :meth:`pairs` lies in a group or is one of copies."""
        members = materialize(self.members)
        # a long passage makes many groups of the same documents; one of them is enough
        sign = members.groupBy("grp").agg(
            F.count("*").alias("n"), F.min("doc_id").alias("x"), F.max("doc_id").alias("y"),
            F.bit_xor(F.xxhash64("doc_id")).alias("h"), F.bit_xor(F.xxhash64("doc_id", F.lit(1))).alias("g"),
        ).where("x < y")
        chosen = materialize(sign.groupBy("n", "x", "y", "h", "g").agg(F.min("grp").alias("grp")).select("grp", "n", F.col("n").alias("size")))
        return materialize(_meet(members, chosen, ["grp"]))

    def pairs(self) -> DataFrame:
        """(doc_a, doc_b), doc_a < doc_b: every pair of documents with a common run of at least ``span`` characters.

        A large group is paired in blocks of PAIR_BLOCK members, so that no task makes all of its pairs.
        """
        members = self.groups().withColumn("blocks", F.ceil(F.col("size") / PAIR_BLOCK).cast("int"))
        left = members.select("grp", F.col("doc_id").alias("a"), F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("block"))
        right = members.select("grp", F.col("doc_id").alias("b"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        reps = left.join(right, ["grp", "block"]).where("a < b").select("a", "b").distinct()
        one, two = self.copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("ca")), self.copies.select(F.col("rep").alias("b"), F.col("doc_id").alias("cb"))
        across = reps.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
        within = one.join(two, one["a"] == two["b"]).where("ca < cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        every = across.unionByName(within).select(F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b"))
        return every.distinct()

    def classes(self) -> DataFrame:
        """(doc_id, class_id, class_size): every document that shares a run, with the smallest document that it is linked to
        directly or through others, without making pairs."""
        members = self.groups()
        first = members.groupBy("grp", F.pmod(F.xxhash64("doc_id"), F.lit(64)).alias("part")).agg(F.min("doc_id").alias("a")).groupBy("grp").agg(F.min("a").alias("a"), F.count("*").alias("n"))
        edges = _meet(members, materialize(first), ["grp"]).select("a", F.col("doc_id").alias("b")).unionByName(self.copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
        # texts of one length that order as the numbers do
        code = lambda c: F.lpad((F.col(c).cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"), 20, "0")
        number = lambda c: (F.col(c).cast("decimal(20,0)") - F.lit(str(2**63)).cast("decimal(20,0)")).cast("long")
        found = materialize(connected_groups(edges.select(code("a").alias("a"), code("b").alias("b"))).select(number("v").alias("doc_id"), number("group_id").alias("class_id")))
        size = materialize(found.groupBy("class_id").agg(F.count("*").alias("n")).withColumn("class_size", F.col("n")))
        return _meet(found, size, ["class_id"]).select("doc_id", "class_id", "class_size")

    def shared_chars(self) -> DataFrame:
        """(doc_id, n_chars, shared_chars, shared_percent) of every document: characters inside runs that stand elsewhere."""
        order = W.partitionBy("doc_id").orderBy("a", "b")  # the spans of one document
        reach = F.max("b").over(order.rowsBetween(W.unboundedPreceding, -1))
        spans = self.spans.withColumn("reach", F.coalesce(reach, F.lit(0)))
        per = spans.groupBy("doc_id").agg(F.sum(F.greatest(F.lit(0), F.col("b") - F.greatest("a", "reach"))).alias("part"))
        docs = self.docs.select("doc_id", F.coalesce(F.char_length("text"), F.lit(0)).alias("n_chars")).groupBy("doc_id").agg(F.max("n_chars").alias("n_chars"))
        # a copied text stands elsewhere as a whole
        full = self.copies.select("doc_id", F.lit(True).alias("copied"))
        all_ = docs.join(per, "doc_id", "left").join(full, "doc_id", "left")
        shared = F.when(F.col("copied"), F.col("n_chars")).otherwise(F.coalesce("part", F.lit(0))).cast("long")
        percent = F.coalesce(F.round(F.try_divide(F.lit(100.0) * shared, F.nullif("n_chars", F.lit(0))), 2), F.lit(0.0))
        return all_.select("doc_id", "n_chars", shared.alias("shared_chars"), percent.alias("shared_percent"))

    def without_spans(self) -> DataFrame:
        """(doc_id, text) of every row: the texts without the spans that stand elsewhere too; of a copied text nothing is left."""
        whole = self.copies.select("doc_id", F.lit(0).alias("a"), F.lit(2**31 - 1).alias("b"))
        cuts = self.spans.unionByName(whole).groupBy("doc_id").agg(F.collect_list(F.struct("a", "b")).alias("cuts"))  # of one document
        return self.docs.join(cuts, "doc_id", "left").select("doc_id", "text", "cuts").mapInArrow(_cut, "doc_id long, text string")
