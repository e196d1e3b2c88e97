"""Sex, linkage pruning, principal components, relatedness and independent sets.

Matrices of samples by samples are small (MAX_SAMPLES, checked); everything that grows with the number of variants
stays distributed. Sums over variants are taken by all tasks at once, tile by tile, and added up in executors; the
driver gets one matrix, whatever the number of partitions.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cohortqc.functions import genetics as G
from cohortqc.session import bounded_rows, free_shuffles, materialize, release

#: Dense matrices of samples by samples are made up to this size.
MAX_SAMPLES = 4096
#: Samples of one side of a tile of such a matrix.
TILE_SAMPLES = 1024
#: Blocks to a window of linkage pruning, and pairs of variants that a task of it holds at once.
LD_BLOCKS = 4
LD_CELLS = 1_000_000
#: Calls of a region of linkage pruning, with the windows beside it, where it is longer than a window.
LD_REGION = 4_000_000


def impute_sex(entries: DataFrame, variants: DataFrame, aaf: float = 0.05, female_below: float = 0.4, male_above: float = 0.8) -> DataFrame:
    """(sid, n_called, observed_homs, expected_homs, f_stat, is_female, imputed_sex) from chrX outside the
    pseudo-autosomal regions; variants of a minor allele frequency up to ``aaf`` are left out."""
    x = entries.where("gt is not null").join(variants.where(G.in_x_nonpar()).select("vid"), "vid", "left_semi")
    site = x.groupBy("vid").agg(F.sum("gt").alias("ac"), (2 * F.count("*")).alias("an"))
    site = site.withColumn("p", F.col("ac").cast("double") / F.col("an")).where((F.col("p") > aaf) & (F.col("p") < 1 - aaf))
    # unbiased expectation of a homozygous call
    site = site.select("vid", (1 - 2 * F.col("p") * (1 - F.col("p")) * F.col("an") / (F.col("an") - 1)).alias("e"))
    per = x.join(site, "vid").groupBy("sid").agg(F.count("*").alias("n_called"), F.count_if(F.col("gt") != 1).alias("observed_homs"), F.sum("e").alias("expected_homs"))
    f = F.try_divide(F.col("observed_homs") - F.col("expected_homs"), F.col("n_called") - F.col("expected_homs"))
    female = F.when(F.col("f_stat") < female_below, True).when(F.col("f_stat") > male_above, False)
    sex = F.when(F.col("is_female"), "female").when(~F.col("is_female"), "male").otherwise("undefined")
    return per.withColumn("f_stat", f).withColumn("is_female", female).withColumn("imputed_sex", sex)


def independent_set(edges: DataFrame, priority: DataFrame) -> DataFrame:
    """(node, kept): the greedy independent set by ascending priority, computed in parallel rounds.

    ``edges``: (a, b), undirected, each pair in any order; ``priority``: (node, p), p totally ordered. A node that
    comes before all of its undecided neighbours is kept and its neighbours are dropped; this repeats until no edge is
    left. The result is that of taking the nodes one by one, and it is maximal. Where many priorities agree, ties must be
    broken by a hash (:func:`tie`): then the expected number of rounds is logarithmic, even on long chains.
    """
    both = edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct()
    pa_, pb = priority.select(F.col("node").alias("a"), F.col("p").alias("pa")), priority.select(F.col("node").alias("b"), F.col("p").alias("pb"))
    open_ = materialize(both.join(pa_, "a").join(pb, "b"))
    dropped = None
    while open_.limit(1).count():
        first = open_.groupBy("a").agg(F.min("pb").alias("least"), F.first("pa").alias("pa")).where("pa < least").select("a")
        gone = open_.join(first, "a", "left_semi").select(F.col("b").alias("node")).distinct()
        gone = materialize(gone)
        rest = open_.join(first, "a", "left_anti").join(gone.select(F.col("node").alias("a")), "a", "left_anti").join(gone.select(F.col("node").alias("b")), "b", "left_anti").select("a", "b", "pa", "pb")
        rest = materialize(rest)
        release(open_)
        open_, dropped = rest, gone if dropped is None else dropped.unionByName(gone)
    release(open_)
    if dropped is None:
        return priority.select("node", F.lit(True).alias("kept"))
    return priority.select("node").join(dropped.distinct().withColumn("_gone", F.lit(True)), "node", "left").select("node", F.col("_gone").isNull().alias("kept"))


def tie(c: str) -> Column:
    """Orders ids as if by lot, but always alike."""
    return F.md5(F.col(c).cast("string"))


def unrelated_samples(relatedness: DataFrame, min_kin: float = 0.125) -> DataFrame:
    """(s, kept) of every sample in a pair above ``min_kin``: those with few relatives first; ties by lot."""
    edges = relatedness.where((F.col("kin") > min_kin) & ~F.isnan("kin") & (F.col("i") != F.col("j"))).select(F.col("i").alias("a"), F.col("j").alias("b"))
    both = edges.union(edges.select("b", "a")).distinct()
    degree = both.groupBy("a").agg(F.count("*").alias("degree")).select(F.col("a").alias("node"), F.struct("degree", tie("a"), "a").alias("p"))
    return independent_set(edges, degree).withColumnRenamed("node", "s")


def ld_pairs(entries: DataFrame, variants: DataFrame, window_bp: int = 1_000_000, r2: float = 0.2) -> DataFrame:
    """(a, b, r2): pairs of variants of one contig within ``window_bp`` whose squared correlation exceeds ``r2``.

    Variants are cut into blocks of a LD_BLOCKS-th of the window; every two blocks that the window can span meet in one
    task, which takes the sums over the samples that have both calls as matrix products. Only the correlated pairs
    leave it, so what is shuffled grows with the calls, not with the pairs. A sample has at most one call per variant.
    """
    width = max(1, -(-window_bp // LD_BLOCKS))
    reach = -(-window_bp // width)
    v = variants.where("contig is not null and pos is not null").select("vid", "contig", F.col("pos").cast("long").alias("pos"))
    calls = entries.where("gt is not null").select("vid", "sid", F.col("gt").cast("byte").alias("gt")).join(v, "vid").groupBy("vid", "contig", "pos").agg(F.collect_list(F.struct("sid", "gt")).alias("calls"))
    block = F.floor(F.col("pos") / width).cast("long")
    # as the first of the blocks block .. block + reach, and as the second of block - reach .. block - 1
    meets = F.transform(F.sequence(F.lit(-reach), F.lit(reach)), lambda d: F.struct((block + F.least(d, F.lit(0))).alias("one"), (block + F.greatest(d, F.lit(0))).alias("two"), (d < 0).alias("second")))
    sides = calls.withColumn("m", F.explode(meets)).select("vid", "contig", "pos", "calls", F.col("m.one").alias("one"), F.col("m.two").alias("two"), F.col("m.second").alias("second"))
    kind = entries.schema["vid"].dataType

    def correlated(table: pa.Table) -> pa.Table:
        table = table.sort_by([("pos", "ascending"), ("vid", "ascending")]).combine_chunks()
        vid, pos, second = table["vid"].combine_chunks(), table["pos"].to_numpy(), table["second"].to_numpy()
        lists = table["calls"].combine_chunks()
        flat = lists.flatten()
        sid = flat.field("sid").dictionary_encode()
        row, col = np.repeat(np.arange(len(vid)), np.diff(lists.offsets.to_numpy())), sid.indices.to_numpy()
        g, called = np.zeros((len(vid), len(sid.dictionary))), np.zeros((len(vid), len(sid.dictionary)))
        g[row, col], called[row, col] = flat.field("gt").to_numpy(zero_copy_only=False), 1
        same = table["one"][0].as_py() == table["two"][0].as_py()
        left, right = (np.arange(len(vid)),) * 2 if same else (np.flatnonzero(~second), np.flatnonzero(second))
        y, cy = g[right].T, called[right].T
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
        step = max(1, LD_CELLS // max(1, len(right)))
        for at in range(0, len(left) if len(right) else 0, step):
            own = left[at : at + step]
            x, cx = g[own], called[own]
            n, sx, sy = cx @ cy, x @ cy, cx @ y
            cov = n * (x @ y) - sx * sy
            var = (n * ((x * x) @ cy) - sx * sx) * (n * (cx @ (y * y)) - sy * sy)
            with np.errstate(invalid="ignore", divide="ignore"):
                r = np.where(var != 0, cov * cov / var, np.nan)
            near = pos[right][None, :] - pos[own][:, None] <= window_bp
            i, j = np.nonzero((r > r2) & near & (own[:, None] < right[None, :]))
            found.append((own[i], right[j], r[i, j]))
        i, j, r = map(np.concatenate, zip(*found, strict=True))
        return pa.table({"a": vid.take(pa.array(i)), "b": vid.take(pa.array(j)), "r2": pa.array(r)})

    return sides.groupBy("contig", "one", "two").applyInArrow(correlated, f"a {kind.simpleString()}, b {kind.simpleString()}, r2 double")


def ld_prune(entries: DataFrame, variants: DataFrame, window_bp: int = 1_000_000, r2: float = 0.2) -> DataFrame:
    """Variants of the greedy independent set of the correlated pairs of :func:`ld_pairs`; the more frequent minor allele
    is kept first, ties by lot. A vid has one place.

    No pairs are written. A task holds the calls of one region of a contig and of the windows on both sides of it, and takes
    the variants by priority: one that is kept drops what is correlated with it. What lies in the windows beside a region
    also depends on variants outside, so neither it nor what it might drop is decided there, unless a kept variant drops
    it. Undecided and kept variants go through another round, with the borders in other places; the first undecided one
    is decided in every round. A contig of up to LD_REGION cells is one region and needs one round.
    """
    width = max(1, window_bp)
    p = F.sum("gt").cast("double") / (2 * F.count("*"))
    # calls are written and shuffled as plain rows: lists that a partial aggregate makes of one call each take twice as much
    known = materialize(entries.where("gt is not null").select("vid", "sid", F.col("gt").cast("byte").alias("gt")))
    free_shuffles(entries.sparkSession)
    calls = known.repartition("vid").groupBy("vid").agg(F.collect_list(F.struct("sid", "gt")).alias("calls"), p.alias("p"))
    order = [(-F.least("p", 1 - F.col("p"))).alias("maf"), F.unhex(tie("vid")).alias("tie")]
    # written first, as a filter of variants by what follows from their vid would else be inferred for every row behind entries
    place = materialize(variants.select("vid", "contig", F.col("pos").cast("long").alias("pos")).distinct())
    state = materialize(calls.join(place, "vid").select("vid", "contig", "pos", *order, "calls", (F.col("contig").isNull() | F.col("pos").isNull()).alias("kept")))
    release(place, known)
    full = state.groupBy("contig", F.floor(F.col("pos") / width)).agg(F.count("*").alias("n"), F.max(F.size("calls")).alias("s")).agg(F.max("n").alias("n"), F.max("s").alias("s")).first()
    core = width * max(1, LD_REGION // max(1, (full["n"] or 0) * (full["s"] or 0)) - 2)
    columns = state.columns

    def decided(table: pa.Table) -> pa.Table:
        table = table.sort_by([("pos", "ascending"), ("vid", "ascending")]).combine_chunks()
        count, pos = len(table), table["pos"].to_numpy()
        by_rank = pc.sort_indices(table, [("maf", "ascending"), ("tie", "ascending"), ("vid", "ascending")]).to_numpy()
        rank = np.empty(count, int)
        rank[by_rank] = np.arange(count)
        lists = table["calls"].combine_chunks()
        flat = lists.flatten()
        sid = flat.field("sid").dictionary_encode()
        row, col, n = np.repeat(np.arange(count), np.diff(lists.offsets.to_numpy())), sid.indices.to_numpy(), len(sid.dictionary)
        gt = flat.field("gt").to_numpy(zero_copy_only=False)
        m = np.zeros((count, 3 * n), np.int8)  # called, calls and their squares
        m[row, col], m[row, n + col], m[row, 2 * n + col] = 1, gt, gt * gt
        kept, inside = (table[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("kept", "inside"))
        # what is open may be dropped by an earlier one; what is unsure has an earlier one that is not decided
        open_, kept, unsure, final = ~kept, kept.copy(), ~inside & ~kept, kept.copy()
        lows, highs = np.searchsorted(pos, pos - window_bp), np.searchsorted(pos, pos + window_bp, "right")
        sums = np.zeros((3 * n, 6))
        for u in by_rank:
            if not (open_[u] or final[u]):
                continue
            if open_[u] and not unsure[u]:
                kept[u], open_[u] = True, False
            near = slice(lows[u], highs[u])
            later = lows[u] + np.flatnonzero(open_[near] & (rank[near] > rank[u]))
            if not kept[u]:
                later = later[~unsure[later]]
            if not len(later):
                continue
            c, x, xx = m[u, :n], m[u, n : 2 * n], m[u, 2 * n :]
            sums[:n, 0], sums[:n, 1], sums[:n, 2], sums[n : 2 * n, 3], sums[n : 2 * n, 4], sums[2 * n :, 5] = c, x, xx, c, x, c
            size, sx, sxx, sy, sxy, syy = (m[later].astype(float) @ sums).T
            cov, var = size * sxy - sx * sy, (size * sxx - sx * sx) * (size * syy - sy * sy)
            with np.errstate(invalid="ignore", divide="ignore"):
                hit = later[(var != 0) & (cov * cov / var > r2)]
            if kept[u]:
                open_[hit] = False
            else:
                unsure[hit] = True
        out = table.set_column(table.schema.get_field_index("kept"), "kept", pa.array(kept))
        return out.filter(pa.array(inside & (kept | open_))).select(columns)

    for shift in itertools.cycle((0, core // 2)):
        at = F.col("pos") + shift
        region = lambda by, at=at: F.floor((at + by) / core).cast("long")
        sides = state.where("contig is not null and pos is not null").withColumn("region", F.explode(F.sequence(region(-width), region(width)))).withColumn("inside", F.col("region") == region(0))
        after = materialize(sides.groupBy("contig", "region").applyInArrow(decided, state.schema).unionByName(state.where("contig is null or pos is null")))
        release(state)
        state = after
        if not state.where("not kept").limit(1).count():
            return variants.join(state.select("vid"), "vid", "left_semi")


def _arrow(entries: DataFrame) -> pa.DataType:
    return to_arrow_type(entries.schema["sid"].dataType)


def _sample_index(entries: DataFrame) -> list:
    return sorted(r[0] for r in bounded_rows(entries.select("sid").distinct(), MAX_SAMPLES, "samples of a dense matrix"))


def _rows_by_variant(entries: DataFrame) -> DataFrame:
    """One row per variant: its calls as (sid, gt) lists, at most one per sample."""
    return entries.where("gt is not null").groupBy("vid").agg(F.collect_list(F.struct("sid", "gt")).alias("calls"))


def _matrix(batch: pa.RecordBatch, sids: pa.Array) -> np.ndarray:
    m = np.full((batch.num_rows, len(sids)), np.nan)
    calls = batch.column("calls")
    row = np.repeat(np.arange(batch.num_rows), np.diff(calls.offsets.to_numpy()))
    flat = calls.flatten()
    m[row, pc.index_in(flat.field("sid"), value_set=sids).to_numpy()] = flat.field("gt").to_numpy(zero_copy_only=False)
    return m


def _gram(rows: DataFrame, kernel: Callable[[pa.RecordBatch], list[np.ndarray]], n: int, count: int) -> list[np.ndarray]:
    """Of each of ``count`` matrices (variants x samples) that ``kernel`` makes of a batch, the sum of M^T M over all batches.

    A task adds up its own variants and hands on the upper tiles; a second step adds each tile up in one task.
    """
    cuts = list(range(0, n, TILE_SAMPLES)) + [n]
    tiles = [(k, i, j) for k in range(count) for i in range(len(cuts) - 1) for j in range(i, len(cuts) - 1)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                sums = [m.T @ m for m in kernel(b)]
                total = sums if total is None else [t + s for t, s in zip(total, sums, strict=True)]
        if total is not None:
            for t, (k, i, j) in enumerate(tiles):
                part = np.ascontiguousarray(total[k][cuts[i] : cuts[i + 1], cuts[j] : cuts[j + 1]])
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["t", "g"])

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for t, g in zip(b.column("t").to_pylist(), b.column("g"), strict=True):
                part = np.frombuffer(g.as_buffer())
                held[t] = held[t] + part if t in held else part.copy()
        for t, g in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([g.tobytes()], pa.binary())], ["t", "g"])

    out = [np.zeros((n, n)) for _ in range(count)]
    for r in rows.mapInArrow(add, "t int, g binary").repartitionById(len(tiles), F.col("t")).mapInArrow(unite, "t int, g binary").collect():  # at most MAX_SAMPLES^2 numbers
        k, i, j = tiles[r["t"]]
        part = np.frombuffer(r["g"]).reshape(cuts[i + 1] - cuts[i], -1)
        out[k][cuts[i] : cuts[i + 1], cuts[j] : cuts[j + 1]] = part
        out[k][cuts[j] : cuts[j + 1], cuts[i] : cuts[i + 1]] = part.T
    return out


def _standardised(m: np.ndarray) -> np.ndarray:
    """(g - 2p) / sqrt(2p(1-p)); missing calls and constant variants become 0."""
    p = np.nanmean(m, 1, keepdims=True) / 2
    sd = np.sqrt(2 * p * (1 - p))
    with np.errstate(invalid="ignore", divide="ignore"):
        z = (m - 2 * p) / sd
    return np.where(np.isfinite(z), z, 0.0)


def pca(entries: DataFrame, k: int = 10) -> tuple[DataFrame, np.ndarray, DataFrame]:
    """Scores (sid, scores), eigenvalues and loadings (vid, af, loadings) of the standardised genotypes.

    Tasks sum their variants' contribution to the samples' Gram matrix. Signs are fixed so that each component's
    largest score in absolute value is positive. Components beyond the matrix's rank have zero scores and loadings.
    """
    spark = entries.sparkSession
    sids = _sample_index(entries)
    known = pa.array(sids, _arrow(entries))
    rows = materialize(_rows_by_variant(entries))
    # constant variants count for nothing
    n = entries.where("gt is not null").groupBy("vid").agg(F.min("gt").alias("a"), F.max("gt").alias("b")).where("a < b").count()
    (total,) = _gram(rows, lambda b: [_standardised(_matrix(b, known))], len(sids), 1)
    k = min(k, len(sids))
    values, vectors = np.linalg.eigh(total / max(1, n))
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    # the rows of standardised calls add up to 0, so at least one value is 0 but for rounding, on either side of it
    real = values > len(sids) * np.finfo(float).eps * max(values[0], 0.0)
    values = np.where(real, values, 0.0)
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(k)])
    scores = vectors * np.sqrt(np.maximum(values, 0))
    score_df = spark.createDataFrame([(s, [float(x) for x in scores[i]]) for i, s in enumerate(sids)], f"sid {entries.schema['sid'].dataType.simpleString()}, scores array<double>")
    weight = np.where(real, vectors, 0.0) / np.sqrt(np.where(real, values, 1.0) * max(1, n))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                m = _matrix(b, known)
                loading = _standardised(m) @ weight
                yield pa.RecordBatch.from_arrays([b.column("vid"), pa.array(np.nanmean(m, 1) / 2), pa.array(list(loading), pa.list_(pa.float64()))], ["vid", "af", "loadings"])

    return score_df, values, rows.mapInArrow(load, "vid long, af double, loadings array<double>")


def pc_project(entries: DataFrame, loadings: DataFrame) -> DataFrame:
    """(sid, scores): projection of samples onto loadings; variants are scaled by the reference frequency."""
    m = loadings.where("af > 0 and af < 1")
    size = m.agg(F.count("*").alias("m"), F.max(F.size("loadings")).alias("k")).first()
    z = (F.col("gt") - 2 * F.col("af")) / F.sqrt(2 * F.col("af") * (1 - F.col("af")) * size["m"])
    j = entries.where("gt is not null").join(m, "vid")
    sums = [F.sum(F.get("loadings", F.lit(i)) * z).alias(f"s{i}") for i in range(size["k"] or 0)]
    return j.groupBy("sid").agg(*sums).select("sid", F.array(*[F.col(f"s{i}") for i in range(size["k"] or 0)]).alias("scores"))


def pc_relate(entries: DataFrame, scores: DataFrame, min_kinship: float = 0.05, min_individual_maf: float = 0.05) -> DataFrame:
    """(i, j, kin, ibd2): kinship and the chance of sharing both alleles, given ancestry (published method).

    Each variant's frequency is fitted per individual by regression on the principal components; cells with a
    fitted minor allele frequency below the limit are left out. Variants are summed where they are.
    """
    spark = entries.sparkSession
    sids = _sample_index(entries)
    known = pa.array(sids, _arrow(entries))
    pcs = {r["sid"]: r["scores"] for r in bounded_rows(scores, MAX_SAMPLES, "scores")}
    design = np.column_stack([np.ones(len(sids)), np.array([pcs[s] for s in sids], float).reshape(len(sids), -1)])
    hat = design @ np.linalg.pinv(design)
    n = len(sids)

    def fitted(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        filled = np.where(np.isnan(m), np.nanmean(m, 1, keepdims=True), m)
        mu = np.clip(filled @ hat.T / 2, 0, 1)
        ok = ~np.isnan(m) & (np.minimum(mu, 1 - mu) >= min_individual_maf)
        return np.where(ok, m, 0.0), mu, ok

    def kinship(b: pa.RecordBatch) -> list[np.ndarray]:
        g, mu, ok = fitted(_matrix(b, known))
        return [np.where(ok, g - 2 * mu, 0.0), np.where(ok, np.sqrt(mu * (1 - mu)), 0.0)]

    rows = materialize(_rows_by_variant(entries))
    num, den = _gram(rows, kinship, n, 2)
    with np.errstate(invalid="ignore", divide="ignore"):
        kin = num / (4 * den)
    inbreeding = 2 * np.nan_to_num(np.diag(kin)) - 1

    def both(b: pa.RecordBatch) -> list[np.ndarray]:
        g, mu, ok = fitted(_matrix(b, known))
        v = mu * (1 - mu)
        dominance = np.where(g == 0, mu, np.where(g == 1, 0.0, 1 - mu)) - v * (1 + inbreeding)
        return [np.where(ok, dominance, 0.0), np.where(ok, v, 0.0)]

    num, den = _gram(rows, both, n, 2)
    with np.errstate(invalid="ignore", divide="ignore"):
        ibd2 = num / den
    release(rows)
    a, b = np.triu_indices(n, 1)
    keep = np.nan_to_num(kin[a, b]) >= min_kinship
    out = pd.DataFrame({"i": [sids[x] for x in a[keep]], "j": [sids[x] for x in b[keep]], "kin": kin[a, b][keep], "ibd2": ibd2[a, b][keep]})
    kind = entries.schema["sid"].dataType.simpleString()
    return spark.createDataFrame(list(out.itertuples(index=False, name=None)), f"i {kind}, j {kind}, kin double, ibd2 double")
