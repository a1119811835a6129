"""Near-duplicate embeddings through binary codes of a random rotation.

Vectors are scaled to length one and rotated. The code of a vector is the signs
of its rotated coordinates; stored next to it is the cosine `own` between the
vector and its code, which corrects the estimate of an inner product:
<vector, other> is about <code, other> / own, without bias. With the angle
between a vector and its code known, the angle to another vector lies within
(sum, difference) of two known angles; a pair is computed exactly only if that
sure bound reaches the threshold, so no link is lost.

Which pairs meet. Vectors that link have a midpoint close to both. Its first
sign bits name a cell; a vector visits every cell that such a midpoint could
have, which depends only on the squares of its small coordinates, and a pair
counts in the cell of its own midpoint alone. The number of bits follows the
number of vectors of a label. Cells are dealt out as pairs of blocks of bounded
size, so a crowded cell is spread over many tasks. Copies are folded before all
this. Tasks return numbers of links and one star of links per component of a
block pair, never the pairs.

Defined results. Vectors that are null or zero or hold null or non-finite
components, and rows with a null label, link with nothing. Vectors of different
length do not link. Repeated rows are other vectors and link. A null vec_id is
never a component's smallest. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.components import components
from plantpulse.llm.tables import kept

THRESHOLD = 0.98
#: Vectors of a block, and the seed of the rotation.
BLOCK = 1024
SEED = 20240607
#: Room for rounding in the sure bounds.
SLACK = 1e-6


@lru_cache
def rotation(size: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares must not overflow
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long lists as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def visited_cells(coordinates: np.ndarray, reach: float) -> list[int]:
    """Cells of all points within the square root of `reach`, by sign bits."""
    own = sum(1 << n for n, x in enumerate(coordinates) if x >= 0)
    cells = [(own, 0.0)]
    for n, x in enumerate(coordinates):
        cost = float(x) * float(x)
        if cost <= reach:
            cells += [(cell ^ 1 << n, spent + cost) for cell, spent in cells if spent + cost <= reach]
    return [cell for cell, _ in cells]


def _celled(bits: int, threshold: float):
    reach = (1 - threshold) / 2 + SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                part = batch.take(pa.array(rows))
                turned = unit(matrix(part.column("embedding"))) @ rotation(int(size)).T[:, :bits]
                cells = [visited_cells(x, reach) for x in turned]
                owner = np.repeat(np.arange(len(rows)), [len(c) for c in cells])
                out = part.take(pa.array(owner))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array([c for own in cells for c in own], pa.int64())], names=[*out.schema.names, "cell"]
                )

    return run


def linked_pairs(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs at `threshold` or more, out of two tables of unit vectors."""
    turn = rotation(left.shape[1]).T
    code = np.where(left @ turn >= 0, 1.0, -1.0) / math.sqrt(left.shape[1])
    own = np.clip((code * (left @ turn)).sum(axis=1), 0, 1)[:, None]
    seen = np.clip(code.astype(np.float32) @ (right @ turn).astype(np.float32).T, -1, 1)
    # cos(x - y) for the angles to the code: no pair can be closer than this.
    bound = own * seen + np.sqrt(1 - own * own) * np.sqrt(1 - seen * seen)
    i, j = np.nonzero(bound >= threshold - 1e-3)  # the estimates are in single precision
    exact = np.empty(len(i))
    for at in range(0, len(i), 1 << 16):
        part = slice(at, at + (1 << 16))
        exact[part] = np.einsum("ij,ij->i", left[i[part]], right[j[part]])
    good = exact >= threshold
    return i[good], j[good]


def smallest_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of each of n nodes, the smallest node reachable by the links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compared(bits: int, threshold: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, weight, block = (table.column(c).to_numpy() for c in ("node", "copies", "block"))
        units = unit(matrix(table.column("embedding").combine_chunks()))
        low, high, cell = (table.column(c)[0].as_py() for c in ("low_block", "high_block", "cell"))
        a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
        i, j = linked_pairs(units[a], units[b], threshold) if len(a) and len(b) else (np.empty(0, int), np.empty(0, int))
        i, j = a[i], b[j]
        if low == high:
            i, j = i[i < j], j[i < j]
        if len(i):
            turned = units @ rotation(units.shape[1]).T[:, :bits]
            middle = ((turned[i] + turned[j] >= 0) << np.arange(bits)).sum(axis=1) if bits else np.zeros(len(i), int)
            i, j = i[middle == cell], j[middle == cell]
        links = np.bincount(i, weight[j], len(node)) + np.bincount(j, weight[i], len(node))
        root = smallest_linked(len(node), i, j)
        touched = np.flatnonzero(links)
        return pa.table({"node": node[touched], "links": links[touched].astype(np.int64), "root": node[root[touched]]})

    return run


def usable(embedding: str):
    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))

    return F.forall(embedding, finite) & F.exists(embedding, lambda x: x != 0)


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Every row's vec_id, n_links, component_id and kept."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    good = rows.filter(F.col("label").isNotNull() & usable("embedding"))
    distinct = kept(
        good.groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
        .withColumn("size", F.size("embedding"))
    )
    most = distinct.groupBy("label", "size").count().agg(F.max("count")).first()[0] or 1
    narrowest = distinct.agg(F.min("size")).first()[0] or 0
    bits = min(narrowest, max(0, math.ceil(math.log2(most / block))))
    columns = "label, size, node, copies, embedding"
    schema = f"label {dict(rows.dtypes)['label']}, size int, node long, copies long, embedding array<double>, cell long"
    celled = kept(distinct.selectExpr(*columns.split(", ")).mapInArrow(_celled(bits, threshold), schema))
    cell = ["label", "size", "cell"]
    sizes = celled.groupBy(*cell).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    blocked = celled.join(sizes, cell).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    paired = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *cell, "node", "copies", "embedding", "block",
        F.least("block", "other").alias("low_block"), F.greatest("block", "other").alias("high_block"),
    )
    found = kept(
        paired.groupBy(*cell, "low_block", "high_block").applyInArrow(
            _compared(bits, threshold), "node long, links long, root long"
        )
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = (
        distinct.join(links, "node", "left")
        .join(grouped, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .withColumn("links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
    )
    smallest = known.groupBy("component").agg(F.min("first").alias("component_id"))
    answers = known.join(smallest, "component").select("label", "embedding", "links", F.col("component_id"), F.lit(True).alias("known"))
    joined = rows.join(answers, ["label", "embedding"], "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
