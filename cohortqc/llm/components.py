"""Consolidating pairwise matches into groups (problem 2).

Two-dimensional grid: vertices are hashed into blocks and every edge lies in the cell (block of one end, block
of the other). Each round runs a local union-find in every cell, then the rows and columns of the grid exchange
the representatives that one vertex got in different cells: its smallest representative becomes its parent, and
the others become edges of the next, smaller round. Once no edge is left the parents are stable, and the rounds'
parent tables are composed backwards.

Scale: a cell with more than CELL_EDGES edges (a hub's edges lie in one row of cells) is cut into parts by a hash of
the edge, each a local union-find of its own; a task holds one part at a time. A vertex has at most one representative
per part of the cells of its row and column. Neither edges nor components ever come to the driver; it only sees
each round's number of edges. Parents of very many vertices are met by broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortqc.functions.ids import is_number, norm_id
from cohortqc.session import materialize, release

#: Edges that one cell should hold; more edges make a finer grid.
CELL_EDGES = 500_000
#: The first round uses at least this many blocks a side.
MIN_BLOCKS = 3
#: A round's table of parents is broadcast up to this size.
BROADCAST_PARENTS = 500_000
#: Parents of more vertices are broadcast in any case; there are at most vertices / HOT_CHILDREN of them.
HOT_CHILDREN = 1_000_000


def local_roots(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Union-find over edges (u, v) of vertices 0..n-1: the smallest vertex of each vertex's component.

    Vectorised hooking and compression: the larger root is hooked under the smaller, then paths are halved
    until every vertex points at a root.
    """
    parent = np.arange(n)
    while True:
        a, b = parent[u], parent[v]
        open_ = a != b
        if not open_.any():
            return parent
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, part, a, b), ordered by cell and part -> (vertex, root) of each part of a cell, one after the other."""
    held: list[pa.RecordBatch] = []
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cell, part = batch.column("cell").to_numpy(), batch.column("part").to_numpy()
        cuts = np.flatnonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1])) + 1
        for x, y in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            key = (cell[x], part[x])
            if held and key != before:
                yield from _roots(held)
                held = []
            held.append(batch.slice(x, y - x))
            before = key
    if held:
        yield from _roots(held)


def _roots(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(parts)
    ends = pd.concat([table["a"].to_pandas(), table["b"].to_pandas()], ignore_index=True)
    code, names = pd.factorize(ends, sort=True)
    del ends
    half = table.num_rows
    root = local_roots(code[:half], code[half:], len(names))
    names = pa.array(names, pa.string())
    for k in range(0, len(names), 100_000):
        top = pa.array(root[k : k + 100_000])
        yield pa.RecordBatch.from_arrays([names[k : k + 100_000], names.take(top)], ["v", "root"])


def grid_blocks(edges: int, cell_edges: int = CELL_EDGES, least: int = 1) -> int:
    return max(least, math.ceil(math.sqrt(2 * edges / cell_edges)))


def connected_groups(pairs: DataFrame, cell_edges: int = CELL_EDGES, min_blocks: int = MIN_BLOCKS) -> DataFrame:
    """(v, group_id) of each vertex of ``pairs`` (a string, b string): the smallest vertex it is linked to.

    Defined results: pairs with a null end or of a vertex with itself are no links; repeated pairs and both
    orders count once; an empty table gives no rows; other columns are not looked at.
    """
    edges = (
        pairs.select("a", "b")
        .where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    edges = materialize(edges)
    left, least, parents = edges.count(), min_blocks, []
    while left:
        k = grid_blocks(left, cell_edges, least)
        least = 1
        block = lambda c, k=k: F.pmod(F.xxhash64(c), F.lit(k))
        row, col = F.least(block("a"), block("b")), F.greatest(block("a"), block("b"))
        cells = edges.select((row * k + col).cast("long").alias("cell"), "a", "b")
        if left > cell_edges:  # else no cell can hold too many
            # there are at most edges / cell_edges cells to be cut
            heavy = cells.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > cell_edges).select("cell", F.ceil(F.col("n") / cell_edges).alias("parts"))
            part = F.pmod(F.xxhash64("a", "b"), F.coalesce("parts", F.lit(1)))
            cells = cells.join(F.broadcast(heavy), "cell", "left").select("cell", part.cast("int").alias("part"), "a", "b")
        else:
            cells = cells.select("cell", F.lit(0).alias("part"), "a", "b")
        cells = cells.repartition(max(k * (k + 1) // 2, math.ceil(left / cell_edges)), "cell", "part").sortWithinPartitions("cell", "part")
        roots = materialize(cells.mapInArrow(_cells, "v string, root string"))
        parent = materialize(roots.groupBy("v").agg(F.min("root").alias("parent")))
        parents.append(parent)
        release(edges)
        if k == 1 and left <= cell_edges:  # one cell: the parents are final
            release(roots)
            break
        # a vertex has at most one root per cell; only those that differ from its parent go on
        edges = materialize(
            roots.join(parent, "v").where("root <> parent").select(F.col("parent").alias("a"), F.col("root").alias("b")).distinct()
        )
        release(roots)
        left = edges.count()
        if not left:
            release(edges)
    if not parents:
        release(edges)
        return pairs.select(F.col("a").alias("v"), F.col("a").alias("group_id")).where("false")
    size = parents[-1].count()
    done = parents.pop().select("v", F.col("parent").alias("group_id"))
    while parents:
        upper = done.select(F.col("v").alias("parent"), F.col("group_id").alias("final"))
        lower = parents.pop()
        rows = lower.count()
        if size <= BROADCAST_PARENTS:
            done = lower.join(F.broadcast(upper), "parent", "left")
        else:  # a parent of very many vertices does not bring them into one task
            upper = materialize(upper)  # it is read twice
            many = F.broadcast(materialize(lower.groupBy("parent").agg(F.count("*").alias("n")).where(F.col("n") > HOT_CHILDREN).select("parent")))
            hot = F.broadcast(materialize(upper.join(many, "parent", "left_semi")))
            done = lower.join(many, "parent", "left_anti").join(upper, "parent", "left").unionByName(lower.join(many, "parent", "left_semi").join(hot, "parent", "left"))
        size = rows
        done = done.select("v", F.coalesce("final", "parent").alias("group_id"))
    return done


def related_samples(relatedness: DataFrame, min_kin: float = 0.125) -> DataFrame:
    """(s, group_id) of every sample with a link: kin a number greater than ``min_kin``, two different samples."""
    links = relatedness.where(is_number("kin") & (F.col("kin") > min_kin)).select(norm_id("i").alias("a"), norm_id("j").alias("b"))
    return connected_groups(links).select(F.col("v").alias("s"), "group_id")
