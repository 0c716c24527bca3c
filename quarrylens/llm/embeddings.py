"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors at cosine ``c`` or more are at squared distance ``2 - 2c`` or less.  A fixed random
rotation spreads this distance over blocks of a few dimensions; if it is within the budget as a
whole, at least one block is within its proportional share.  So a range join per block finds
every link, and each candidate is verified exactly on the whole vectors.

In a block, the first two coordinates form a grid with cells twice the block's radius wide.  A
vector lives in its home cell and visits the neighbours within the radius that sort before it, so
two vectors within the radius meet in exactly one cell.  A link is counted in the first block
that admits it, hence once.  Cells with many rows are compared tile by tile.  Tasks return sums
and one edge per linked vector, never the pairs.

A few blocks at a time are searched, so that the copies of the vectors that lie on disk at once
are few however many blocks there are.
"""

from __future__ import annotations

from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.llm.common import components, map_arrow, stored
from quarrylens.operators.partitions import stored_bytes

COSINE = 0.93
BLOCK_DIMS = 8
GRID_DIMS = 2
TILE_ROWS = 16384
# Pairs whose distances in a block are held at once.
PAIRS = 1 << 21
# Copies of vectors that are shuffled at once take about so many bytes, and those of one block at least.
SHUFFLED = 256 << 20
# Cells that a vector lives in or visits in one block, about.
VISITS = 5
SLACK = 1e-9
# Distances in a block are first worked out in single precision, where they are off by less.
SINGLE_SLACK = 1e-5


@lru_cache(maxsize=4)
def rotation(dims: int) -> np.ndarray:
    """Orthogonal matrix, the same in every task."""
    return np.linalg.qr(np.random.default_rng(dims).normal(size=(dims, dims)))[0]


def blocks(dims: int) -> list[slice]:
    count = max(1, round(dims / BLOCK_DIMS))
    ends = [dims * (i + 1) // count for i in range(count)]
    return [slice(a, b) for a, b in zip([0, *ends], ends)]


def budgets(dims: int, cosine: float) -> np.ndarray:
    """Squared distance that each block may have, with room for rounding."""
    sizes = np.array([b.stop - b.start for b in blocks(dims)])
    return (2 - 2 * cosine) * sizes / dims + SLACK


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in the rotated space; each row is worked out alone, so all tasks agree."""
    unit = vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    return np.einsum("ij,jk->ik", unit, rotation(vectors.shape[1]), optimize=False)


def cells(vectors: np.ndarray, cosine: float, numbers: range) -> tuple[np.ndarray, ...]:
    """(row, block, cell x, cell y, home) of every cell that the vectors live in or visit, in the blocks of these numbers."""
    dims = vectors.shape[1]
    at, everyone = rotated(vectors), np.arange(len(vectors))
    none = np.zeros(0, np.int64)
    out = [(none, none, none, none, none.astype(bool))]
    for number, (block, budget) in enumerate(zip(blocks(dims), budgets(dims, cosine))):
        if number not in numbers:
            continue
        radius = np.sqrt(budget)
        place = at[:, block][:, :GRID_DIMS] / (2 * radius)
        if place.shape[1] < GRID_DIMS:
            place = np.hstack([place, np.zeros((len(place), GRID_DIMS - place.shape[1]))])
        home = np.floor(place).astype(np.int64)
        for dx in (-1, 0, 1):
            for dy in (-1, 0, 1):
                if (dx, dy) > (0, 0):
                    continue
                near = np.ones(len(vectors), bool)
                for axis, step in enumerate((dx, dy)):
                    inside = place[:, axis] - home[:, axis]
                    # Within half a cell, the radius, of the border on that side.
                    near &= {-1: inside <= 0.5 + SLACK, 0: True, 1: inside >= 0.5 - SLACK}[step]
                rows = everyone[near]
                target = home[near] + (dx, dy)
                own = np.full(len(rows), (dx, dy) == (0, 0))
                out.append((rows, np.full(len(rows), number), target[:, 0], target[:, 1], own))
    return tuple(np.concatenate(part) for part in zip(*out))


def _roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of each pair; ``root`` points to a smaller index of the same group."""

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for x, y in np.unique(np.stack([root[a], root[b]], axis=1), axis=0):
        x, y = top(x), top(y)
        if x != y:
            root[max(x, y)] = min(x, y)


def compare_tile(
    vectors: np.ndarray, home: np.ndarray, chunk: np.ndarray, weight: np.ndarray, block: int, two: bool, cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """Per row of one tile: weight of its links counted here, and a row of its group.

    ``two``: the tile holds two chunks and only pairs across them count.
    """
    dims, n = vectors.shape[1], len(vectors)
    parts, limits = blocks(dims), budgets(dims, cosine)
    at, norms = rotated(vectors), np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    mine = at[:, parts[block]]
    squares, ones = np.einsum("ij,ij->i", mine, mine)[:, None], np.ones((n, 1))
    # Products of these rows are squared distances; every pair that they admit is checked exactly.
    left, right = (np.hstack(x).astype(np.float32) for x in ([-2 * mine, squares, ones], [mine, ones, squares]))
    links, root = np.zeros(n, np.int64), np.arange(n)
    first = np.flatnonzero(chunk == chunk.min()) if two else np.arange(n)
    second = np.flatnonzero(chunk != chunk.min()) if two else first
    right = right[second]
    step = max(1, min(256, PAIRS // max(1, len(second))))
    for begin in range(0, len(first), step):
        rows, begin = first[begin : begin + step], 0 if two else begin
        close = left[rows] @ right[begin:].T <= limits[block] + SINGLE_SLACK
        ours, theirs = np.nonzero(close)
        ours, theirs = rows[ours], second[begin + theirs]
        counts = (home[ours] | home[theirs]) & (two | (ours < theirs))
        ours, theirs = ours[counts], theirs[counts]
        for k in range(0, len(ours), 20_000):
            a, b = ours[k : k + 20_000], theirs[k : k + 20_000]
            same = np.einsum("ij,ij->i", vectors[a], vectors[b]) >= cosine * norms[a] * norms[b]
            a, b = a[same], b[same]
            apart = np.add.reduceat((at[a] - at[b]) ** 2, [p.start for p in parts], axis=1)
            owner = np.argmax(apart <= limits, axis=1) == block
            a, b = a[owner], b[owner]
            if len(a):
                np.add.at(links, a, weight[b])
                np.add.at(links, b, weight[a])
                _roots(root, a, b)
    for i in range(n):
        root[i] = root[root[i]]
    return links, root


def _usable(vector: Column) -> Column:
    """No null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def embedding_components(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE
) -> DataFrame:
    """``id_col, n_links, component_id, kept`` for every row.

    Vectors link when their labels are equal and not null and their cosine is at least
    ``cosine``.  Null, zero or non-finite vectors, vectors of different lengths and null ids link
    with nothing.  Equal vectors of one label are one node of the search, however many there are.
    Rows that repeat an id are vectors of their own.  An empty table gives an empty result.
    """
    given = F.col(vector_col)
    # Single precision is kept where it is given: half the bytes to move, and the same numbers.
    kept = given if rows.schema[vector_col].dataType.simpleString() == "array<float>" else given.cast("array<double>")
    clean = rows.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), given.cast("array<double>").alias("vector"), kept.alias("kept")
    )
    clean = clean.withColumn(
        "valid", _usable(F.col("vector")) & F.col("label").isNotNull() & F.col("id").isNotNull()
    )
    keyed = clean.withColumn("k1", F.xxhash64("vector")).withColumn("k2", F.xxhash64(F.lit(1), "vector"))
    group = ["label", "k1", "k2"]
    nodes = keyed.where("valid").groupBy(*group).agg(
        F.min("id").alias("node"), F.count("*").alias("n"), F.first("kept").alias("vector")
    )
    nodes = stored(nodes.withColumn("dims", F.size("vector")), "embedding-nodes")
    links = _links(nodes.select("label", "dims", "node", "n", "vector"), cosine)

    sums = links.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")), "embedding")
    found = (
        nodes.select(*group, "node", "n")
        .join(sums, "node", "left")
        .join(groups.withColumnRenamed("id", "node"), "node", "left")
        .select(
            *group,
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component_id", "node").alias("component_id"),
        )
    )
    found = stored(found, "embedding-groups")
    marked = keyed.select("id", "valid", *[F.when(F.col("valid"), F.col(c)).alias(c) for c in group])
    out = marked.where("valid").join(found, group).select("id", "n_links", "component_id")
    alone = marked.where("not valid").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return out.union(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _links(nodes: DataFrame, cosine: float) -> DataFrame:
    """``node, links, root``, stored: per tile and linked node, weight of its links and a linked node."""
    most = nodes.agg(F.max("dims")).first()[0]
    count = len(blocks(most)) if most else 1
    together = max(1, SHUFFLED // (VISITS * max(1, stored_bytes(nodes))))
    passes = [range(a, min(a + together, count)) for a in range(0, count, together)]
    return reduce(DataFrame.union, [stored(_block_links(nodes, cosine, numbers), "embedding-links") for numbers in passes])


def _block_links(nodes: DataFrame, cosine: float, numbers: range) -> DataFrame:
    """The links that blocks of these numbers admit first."""
    label = nodes.schema["label"].dataType.simpleString()
    node = nodes.schema["node"].dataType.simpleString()
    vector = nodes.schema["vector"].dataType.simpleString()

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        dims = batch.column(1).to_numpy()
        found = []
        for size in np.unique(dims):
            rows = np.flatnonzero(dims == size)
            vectors = batch.column(4).take(pa.array(rows)).flatten().to_numpy().astype(np.float64).reshape(-1, size)
            row, *rest = cells(vectors, cosine, numbers)
            found.append((rows[row], *rest))
        row, block, x, y, home = (np.concatenate(part) for part in zip(*found))
        columns = [c.take(pa.array(row)) for c in batch.columns]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(block.astype(np.int32)), pa.array(x), pa.array(y), pa.array(home)],
            names=[*batch.schema.names, "block", "x", "y", "home"],
        )

    schema = f"label {label}, dims int, node {node}, n bigint, vector {vector}, block int, x bigint, y bigint, home boolean"
    copies = map_arrow(nodes, spread, schema, 1 << 20)
    cell = ["label", "dims", "block", "x", "y"]
    # Rows of crowded cells are dealt into chunks; each pair of chunks is one tile.
    places = map_arrow(nodes, _without_vector(spread), schema.replace(f"vector {vector}, ", ""), 1 << 20)
    crowded = places.groupBy(*cell).agg(F.count("*").alias("rows")).where(F.col("rows") > TILE_ROWS)
    crowded = stored(crowded.withColumn("chunks", F.ceil(F.col("rows") / TILE_ROWS).cast("int")).drop("rows"), "embedding-cells")
    dealt = copies.join(crowded, cell, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.withColumn("low", F.least("chunk", "other")).withColumn("high", F.greatest("chunk", "other"))

    def tile(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        dims = group["dims"][0].as_py()
        vectors = group["vector"].combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, dims)
        low, high = group["low"][0].as_py(), group["high"][0].as_py()
        links, root = compare_tile(
            vectors,
            group["home"].to_numpy(),
            group["chunk"].to_numpy(),
            group["n"].to_numpy(),
            group["block"][0].as_py(),
            low != high,
            cosine,
        )
        hit = np.flatnonzero(links)
        return pa.table(
            {"node": group["node"].take(pa.array(hit)), "links": pa.array(links[hit]), "root": group["node"].take(pa.array(root[hit]))}
        )

    needed = dealt.select(*cell, "low", "high", "node", "n", "vector", "home", "chunk")
    return needed.groupBy(*cell, "low", "high").applyInArrow(tile, f"node {node}, links bigint, root {node}")


def _without_vector(fn):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = fn(batch)
        keep = [name for name in out.schema.names if name != "vector"]
        return out.select(keep)

    return run
