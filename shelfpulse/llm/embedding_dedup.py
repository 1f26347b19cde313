"""Near-duplicate vectors by collision counting on sorted one-dimensional projections.

Unit vectors are projected on `PROJECTIONS` random directions. Two vectors at the threshold
differ by a normal deviate of known spread in each, so a window around the query of `WIDTH`
spreads to either side holds a true partner with known probability; a pair is verified only if it
collides in so many windows that `RECALL` of the pairs at the threshold do (closer pairs more
often). Verification computes the cosine in double precision.

The first projection also deals out the work. Vectors are sorted by it into cells as wide as its
window (a wider one, `REACH` spreads), so partners are in the same or the next cell; crowded
cells are dealt to blocks of a bounded size. Each pair of blocks is one group with bounded
memory, and each pair of vectors is in exactly one. Vectors with equal components count as one
with a weight, so thousands of copies cost nothing.

Work grows with the number of vectors per cell, as it must for a direction-free set: projections
cannot separate vectors that are spread over the whole sphere more sharply.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpulse.llm.common import Scratch
from shelfpulse.llm.components import components

COSINE = 0.9
PROJECTIONS = 16
WIDTH = 2.0
REACH = 3.5
RECALL = 0.999
#: Vectors per block of a cell, about.
BLOCK = 4096


def needed_collisions(projections: int, width: float, recall: float) -> int:
    """The largest count that a pair at the threshold reaches with probability `recall`."""
    p = erf(width / sqrt(2))
    chance = [comb(projections, k) * p**k * (1 - p) ** (projections - k) for k in range(projections + 1)]
    return max((c for c in range(1, projections + 1) if sum(chance[c:]) >= recall), default=1)


def directions(dimension: int, projections: int) -> np.ndarray:
    """Fixed random unit vectors, by column."""
    found = np.random.default_rng(dimension).normal(size=(dimension, projections))
    return found / np.linalg.norm(found, axis=0)


def spread(dimension: int, cosine: float) -> float:
    """Standard deviation of the difference of two unit vectors at `cosine`, projected."""
    return sqrt(2 - 2 * cosine) / sqrt(dimension)


def usable(vector: Column) -> Column:
    """Neither null nor empty, all components finite, not all zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _place(cosine: float):
    """Adds dimension and cell: the place on the first projection in windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy().astype(np.float64)
            begin = np.concatenate(([0], np.cumsum(sizes)))
            cell = np.zeros(len(sizes), dtype=np.int64)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                x = flat[begin[rows, None] + np.arange(size)]
                x = unit(x)
                width = min(REACH * spread(size, cosine), sqrt(2 - 2 * cosine))
                cell[rows] = np.floor(x @ directions(size, 1)[:, 0] / width)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes.astype(np.int32)), pa.array(cell)],
                [*batch.schema.names, "dimension", "cell"],
            )

    return run


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, also where squares would overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_pairs(x: np.ndarray, y: np.ndarray | None, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of x, row of y) of unit vectors at least at `cosine`; y None: pairs within x."""
    within = y is None
    y = x if within else y
    dimension = x.shape[1]
    axes = directions(dimension, PROJECTIONS)
    window = WIDTH * spread(dimension, cosine)
    needed = needed_collisions(PROJECTIONS, WIDTH, RECALL)
    # Projections in steps of a 256th of the window; a collision is a small difference.
    kind = np.int16 if 2 * 256 / window < 1 << 15 else np.int32
    of_x, of_y = (np.round(v @ axes * (256 / window)).T.astype(kind, order="C") for v in (x, y))
    limit = 256
    rows, columns = [], []
    for low in range(0, len(x), 128):
        part = of_x[:, low : low + 128]
        first = low + 1 if within else 0
        other = of_y[:, first:]
        counts = np.zeros((part.shape[1], other.shape[1]), dtype=np.uint8)
        for k in range(PROJECTIONS):
            counts += np.abs(part[k, :, None] - other[k]) <= limit
        i, j = np.nonzero(counts >= needed)
        i, j = i + low, j + first
        if within:
            i, j = i[i < j], j[i < j]
        near = np.einsum("ij,ij->i", x[i], y[j]) >= cosine
        rows.append(i[near])
        columns.append(j[near])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate(rows or [none]), np.concatenate(columns or [none])


def _compare(cosine: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, cell, block, other_cell, other_block = (k.as_py() for k in key)
        side = table.column("side").to_numpy()
        node, weight = (table.column(c).to_numpy() for c in ("node", "weight"))
        vectors = table.column("vector").combine_chunks()
        x = vectors.flatten().to_numpy().astype(np.float64).reshape(len(side), -1)
        x = unit(x)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if (cell, block) == (other_cell, other_block):
            i, j = near_pairs(x[left], None, cosine)
            a, b = left[i], left[j]
        else:
            i, j = near_pairs(x[left], x[right], cosine)
            a, b = left[i], right[j]
        # Links are counted here; on go one row per vector and a spanning forest.
        links = np.zeros(len(side), dtype=np.int64)
        np.add.at(links, a, weight[b])
        np.add.at(links, b, weight[a])
        parent = np.arange(len(side))

        def root(k: int) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        ends = []
        for p, q in zip(a.tolist(), b.tolist(), strict=True):
            p, q = root(p), root(q)
            if p != q:
                parent[max(p, q)] = min(p, q)
                ends.append((p, q))
        linked = np.flatnonzero(links)
        pairs = np.array(ends, dtype=np.int64).reshape(-1, 2)
        zero = np.zeros(len(pairs), dtype=np.int64)
        return pa.table(
            {
                "a": np.concatenate((node[linked], node[pairs[:, 0]])),
                "b": np.concatenate((node[linked], node[pairs[:, 1]])),
                "links_a": np.concatenate((links[linked], zero)),
            }
        )

    return run


def link(nodes: DataFrame, scratch: Scratch, cosine: float) -> DataFrame:
    """nodes: node, vector, weight; vectors usable and distinct. Rows (a, b, links_a): a links
    `links_a` rows within one group (a = b), or a and b are in one component (links_a = 0)."""
    placed = nodes.mapInArrow(
        _place(cosine),
        f"node bigint, vector {dict(nodes.dtypes)['vector']}, weight bigint, dimension int, cell bigint",
    )
    placed = scratch.table(placed, "placed")
    crowd = placed.groupBy("dimension", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    crowd = scratch.table(crowd, "cells")
    next_cell = crowd.select("dimension", (F.col("cell") - 1).alias("cell"), F.col("blocks").alias("next"))
    last_cell = crowd.select("dimension", (F.col("cell") + 1).alias("cell"), F.col("blocks").alias("last"))
    at = ["dimension", "cell"]
    dealt = placed.join(crowd, at).join(next_cell, at, "left").join(last_cell, at, "left")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")

    def pairing(low_cell: Column, low: Column, high_cell: Column, high: Column, side: Column) -> Column:
        return F.struct(low_cell.alias("c1"), low.alias("b1"), high_cell.alias("c2"), high.alias("b2"), side.alias("side"))

    def numbers(n: Column) -> Column:
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    cell = F.col("cell")
    groups = F.concat(
        F.transform(  # blocks of the same cell, each pair once, a block with itself too
            numbers(F.col("blocks")),
            lambda k: pairing(cell, F.least(own, k), cell, F.greatest(own, k), (own > k).cast("int")),
        ),
        F.transform(
            numbers(F.coalesce("next", F.lit(0))), lambda k: pairing(cell, own, cell + 1, k, F.lit(0))
        ),
        F.transform(
            numbers(F.coalesce("last", F.lit(0))), lambda k: pairing(cell - 1, k, cell, own, F.lit(1))
        ),
    )
    dealt = dealt.select("dimension", "node", "vector", "weight", F.explode(groups).alias("g"))
    dealt = dealt.select("dimension", "node", "vector", "weight", "g.*")
    return dealt.groupBy("dimension", "c1", "b1", "c2", "b2").applyInArrow(
        _compare(cosine), "a bigint, b bigint, links_a bigint"
    )


def near_duplicates(vectors: DataFrame, scratch: Scratch, cosine: float = COSINE) -> DataFrame:
    """One row per row of `vectors` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Unusable vectors (see `usable`) link with nothing and are their own component. Vectors of
    different dimension never link. A row with a null vec_id is linked and counted; it has the
    smallest id of its component, or null, and is never kept. Repeated rows count as rows.
    """
    rows = vectors.select("vec_id", F.col("embedding").alias("vector"))
    good = scratch.table(rows.filter(usable(F.col("vector"))), "usable")
    nodes = good.groupBy("vector").agg(F.min("vec_id").alias("low"), F.count("*").alias("weight"))
    # A set of rows without any id still needs a name: one below every id.
    name = F.coalesce("low", -F.abs(F.xxhash64("vector") % (1 << 40)) - (1 << 41))
    nodes = scratch.table(nodes.select("vector", "weight", name.alias("node")), "nodes")
    found = scratch.table(link(nodes.select("node", "vector", "weight"), scratch, cosine), "links")
    counts = found.filter("a = b").groupBy("a").agg(F.sum("links_a").alias("others"))
    component = components(found.filter("a <> b").select("a", "b"), scratch)
    classes = (
        nodes.join(counts, nodes.node == counts.a, "left")
        .join(component, "node", "left")
        .select(
            "vector",
            (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", nodes.node).alias("component_id"),
        )
    )
    linked = good.join(classes, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.coalesce(usable(F.col("vector")), F.lit(False))).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    every = linked.unionByName(alone)
    component_id = F.when(F.col("component_id") > -(1 << 41), F.col("component_id"))
    return every.select(
        "vec_id",
        "n_links",
        component_id.alias("component_id"),
        F.coalesce(F.col("vec_id") == component_id, F.lit(False)).alias("kept"),
    )
