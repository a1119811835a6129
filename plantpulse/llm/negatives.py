"""Hard negatives through a multiway hyperplane tree with distance ranges.

The tree is fitted on a bounded sample of the rows: a tree node holds up to FANOUT
split points far from each other, and a row belongs to the nearest. All rows are
then dealt to the leaves, and for every two siblings i and j the smallest and
largest distance from split point i to any row of subtree j is kept, with the
range of the rows' norms. Both come from every row, so they bound every row.

A query asks for the rows whose inner product with its anchor lies in a window.
In a subtree whose norms are known, such rows lie in an annulus around the
anchor. If for one split point the annulus of distances that follows from it
misses the stored range of a sibling, no row of that subtree can answer. Leaves
that remain are compared exactly, in blocks of bounded size on both sides, so
a leaf or a copy that holds a third of all rows is spread over many tasks.

An anchor's positives are its best rows of the same label; its negatives, for
each positive, the best rows of another label whose score lies in a share of
the positive's. The sample tells beforehand a score that the k-th best cannot
fall below, which narrows the windows; results do not depend on it.

Defined results. Rows with a null label or vector or a null component take no
part. Only vectors of the same length meet: the tree serves the commonest
length of the sample, the rows of any other length are one leaf of their own.
Repeated rows are other rows: each is an anchor and each can be found. A null
vec_id is never an anchor and loses every tie. Inner products are exact, and
clipped to 64 bits. Without anchors, or without positives, the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.llm.tables import LAST, kept, longs

#: Rows that the tree is fitted on, split points of a tree node, rows that a leaf should have.
SAMPLE = 4096
FANOUT = 12
LEAF = 1024
#: Rows of a block on either side, and products that are looked at together.
BLOCK = 2048
CELLS = 1 << 20
SEED = 20240607
POSITIVES, NEGATIVES = 5, 3
#: Percent of the positive's score that a negative's must have at least and may have at most.
SHARES = (50, 95)
EXACT = 1 << 53

ROWS = "node long, vec_id long, label long, vector array<long>"


@dataclass(frozen=True)
class TreeNode:
    points: np.ndarray
    #: Of each split point the tree node below it, or -1 - leaf.
    below: tuple[int, ...]


@dataclass(frozen=True)
class Tree:
    """Split points, and per tree node the ranges [point, child] that all rows obey."""

    size: int
    nodes: tuple[TreeNode, ...] = ()
    low: tuple[np.ndarray, ...] = ()
    high: tuple[np.ndarray, ...] = ()
    #: Per tree node the least and largest squared norm below each child.
    least: tuple[np.ndarray, ...] = ()
    most: tuple[np.ndarray, ...] = ()


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows, clipped to 64 bits."""
    size = left.shape[1]
    most = [max((abs(int(x)) for x in (m.min(initial=0), m.max(initial=0))), default=0) for m in (left, right)]
    if most[0] * most[1] * size < EXACT:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    found = left.astype(object) @ right.astype(object).T
    return np.clip(found, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    rows, points = rows.astype(np.float64), points.astype(np.float64)
    squared = (rows * rows).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None, :] - 2 * rows @ points.T
    return np.sqrt(np.maximum(squared, 0))


def split_points(rows: np.ndarray, fanout: int, rng: np.random.Generator) -> np.ndarray:
    """Rows far from each other: each is the farthest of a few candidates from those chosen before."""
    candidates = rows[rng.permutation(len(rows))[: 3 * fanout]]
    chosen = [0]
    nearest = distances(candidates, candidates[:1])[:, 0]
    while len(chosen) < fanout and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(candidates, candidates[chosen[-1:]])[:, 0])
    return candidates[chosen]


def grow(sample: np.ndarray, total: int, fanout: int, leaf: int) -> tuple[TreeNode, ...]:
    """Tree nodes for `total` rows that are spread like the sample."""
    rng = np.random.default_rng(SEED)
    nodes: list[TreeNode | None] = []
    leaves = 0

    def below(rows: np.ndarray, expected: float) -> int:
        nonlocal leaves
        points = split_points(rows, fanout, rng) if expected > leaf and len(rows) >= 2 * fanout else rows[:0]
        if len(points) < 2:
            leaves += 1
            return -leaves
        at = len(nodes)
        nodes.append(None)
        nearest = distances(rows, points).argmin(axis=1)
        share = expected / len(rows)
        nodes[at] = TreeNode(points, tuple(below(rows[nearest == i], share * (nearest == i).sum()) for i in range(len(points))))
        return at

    if len(sample):
        below(sample, total)
    return tuple(nodes)


def _descended(nodes: tuple[TreeNode, ...], rows: np.ndarray):
    """(leaf of each row, visits): a visit is a tree node, row numbers, distances and chosen children."""
    leaf = np.zeros(len(rows), dtype=np.int64)
    visits = []
    waiting = [(0, np.arange(len(rows)))] if nodes else []
    while waiting:
        at, who = waiting.pop()
        far = distances(rows[who], nodes[at].points)
        nearest = far.argmin(axis=1)
        visits.append((at, who, far, nearest))
        for child, down in enumerate(nodes[at].below):
            part = who[nearest == child]
            if len(part):
                if down < 0:
                    leaf[part] = -1 - down
                else:
                    waiting.append((down, part))
    return leaf, visits


def _placed(nodes: tuple[TreeNode, ...], size: int):
    """Appends the leaf: one of the tree's, or below zero one of another vector length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False).astype(np.int64)
            leaf = -1 - sizes
            own = np.flatnonzero(sizes == size)
            if len(own):
                leaf[own] = _descended(nodes, matrix(batch.column("vector").take(pa.array(own)), size))[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

    return run


def _ranges(nodes: tuple[TreeNode, ...], size: int):
    """Per task: distance ranges of every split point to every sibling's rows, and their norms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = [np.full((len(n.points),) * 2, np.inf) for n in nodes]
        high = [np.full((len(n.points),) * 2, -np.inf) for n in nodes]
        least = [np.full(len(n.points), np.inf) for n in nodes]
        most = [np.full(len(n.points), -np.inf) for n in nodes]
        for batch in batches:
            rows = matrix(batch.column("vector"), size).astype(np.float64)
            norms = (rows * rows).sum(axis=1)
            for at, who, far, nearest in _descended(nodes, rows)[1]:
                for child in np.unique(nearest):
                    inside = nearest == child
                    low[at][:, child] = np.minimum(low[at][:, child], far[inside].min(axis=0))
                    high[at][:, child] = np.maximum(high[at][:, child], far[inside].max(axis=0))
                    least[at][child] = min(least[at][child], norms[who[inside]].min())
                    most[at][child] = max(most[at][child], norms[who[inside]].max())
        out = [
            (at, i, j, low[at][i, j], high[at][i, j], least[at][j], most[at][j])
            for at, node in enumerate(nodes)
            for i in range(len(node.points))
            for j in range(len(node.points))
            if high[at][i, j] >= 0
        ]
        names = ["at", "i", "j", "low", "high", "least", "most"]
        kinds = [pa.int32()] * 3 + [pa.float64()] * 4
        columns = list(zip(*out, strict=True)) or [()] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _fitted(placed: DataFrame, nodes: tuple[TreeNode, ...], size: int) -> Tree:
    """The tree with the ranges of all rows; what comes to the driver is as large as the tree."""
    shapes = [len(n.points) for n in nodes]
    low = tuple(np.full((n, n), np.inf) for n in shapes)
    high = tuple(np.full((n, n), -np.inf) for n in shapes)
    least, most = tuple(np.full(n, np.inf) for n in shapes), tuple(np.full(n, -np.inf) for n in shapes)
    if nodes:
        parts = placed.filter("leaf >= 0").select("vector").mapInArrow(
            _ranges(nodes, size), "at int, i int, j int, low double, high double, least double, most double"
        )
        found = parts.groupBy("at", "i", "j").agg(F.min("low"), F.max("high"), F.min("least"), F.max("most"))
        for at, i, j, *bounds in found.collect():
            low[at][i, j], high[at][i, j], least[at][j], most[at][j] = bounds
    return Tree(size, nodes, low, high, least, most)


def surviving(tree: Tree, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(leaf, numbers of anchors) that may hold a score in [low, high]; one row of windows per anchor.

    A score s and the norms tell the distance: d^2 = |a|^2 + |x|^2 - 2 s.
    """
    if not tree.nodes:
        return [(0, np.arange(len(anchors)))]
    anchors = anchors.astype(np.float64)
    norms = (anchors * anchors).sum(axis=1)
    found, waiting = [], [(0, np.arange(len(anchors)))]
    with np.errstate(invalid="ignore", over="ignore"):
        while waiting:
            at, who = waiting.pop()
            node = tree.nodes[at]
            far = distances(anchors[who], node.points)[:, None, :]  # anchor, window, split point
            for child, down in enumerate(node.below):
                if tree.most[at][child] < 0:
                    continue  # no row came here
                slack = 1e-6 * (np.sqrt(norms[who]) + np.sqrt(tree.most[at][child]) + 1)[:, None]
                outer = norms[who][:, None] + tree.most[at][child] - 2 * low[who]
                inner = norms[who][:, None] + tree.least[at][child] - 2 * high[who]
                reach = (np.sqrt(np.maximum(outer, 0)) + slack)[:, :, None]
                hole = (np.sqrt(np.maximum(inner, 0)) - slack)[:, :, None]
                meets = (tree.low[at][:, child] <= far + reach) & (tree.high[at][:, child] >= np.maximum(far - reach, hole - far))
                alive = meets.all(axis=2) & (outer >= -slack * slack) & (low[who] <= high[who])
                part = who[alive.any(axis=1)]
                if len(part):
                    if down < 0:
                        found.append((-1 - down, part))
                    else:
                        waiting.append((down, part))
    return found


def best(scores: np.ndarray, good: np.ndarray, most: int) -> np.ndarray:
    """Numbers of the `most` best among the good, earlier first in ties."""
    at = np.flatnonzero(good)
    if len(at) > most:
        least = np.partition(scores[at], len(at) - most)[len(at) - most]
        at = at[scores[at] >= least]
    return at[np.argsort(-scores[at], kind="stable")][:most]


@dataclass(frozen=True)
class Sample:
    node: np.ndarray
    label: np.ndarray
    vector: np.ndarray


def _kth(scores: np.ndarray, good: np.ndarray, k: int, otherwise) -> np.ndarray:
    """Per row of scores the k-th best of the good ones, else `otherwise`."""
    out = np.array(np.broadcast_to(otherwise, len(scores)), dtype=np.float64)
    for n in np.flatnonzero(good.sum(axis=1) >= k):
        out[n] = max(out[n], np.partition(scores[n][good[n]], -k)[-k])
    return out


def _windows(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores asked for, per query and window, as doubles; missing windows are empty ones."""
    low, high = np.full((batch.num_rows, width), np.inf), np.full((batch.num_rows, width), -np.inf)
    for n, windows in enumerate(batch.column("windows").to_pylist()):
        for w, window in enumerate(windows):
            low[n, w], high[n, w] = window["low"], window["high"]
    return low, high


def _routed(tree: Tree, sample: Sample, same: bool, width: int, k: int):
    """Queries, once for each leaf that may answer one of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                sizes = pa.compute.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False).astype(np.int64)
                own = np.flatnonzero(sizes == tree.size)
                other = np.flatnonzero(sizes != tree.size)
                who, leaf = [other], [-1 - sizes[other]]
                if len(own):
                    part = batch.take(pa.array(own))
                    rows, node, label = matrix(part.column("vector"), tree.size), longs(part, "node"), longs(part, "label")
                    low, high = _windows(part, width)
                    scores = products(rows, sample.vector)
                    fits = (sample.label == label[:, None]) == same
                    fits &= sample.node != node[:, None]
                    for w in range(width):
                        inside = fits & (scores >= low[:, [w]]) & (scores <= high[:, [w]])
                        low[:, w] = _kth(scores, inside, k, low[:, w])
                    for at, asking in surviving(tree, rows, low, high):
                        who.append(own[asking])
                        leaf.append(np.full(len(asking), at))
                taken = batch.take(pa.array(np.concatenate(who)))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(np.concatenate(leaf))], names=[*taken.schema.names, "leaf"]
                )

    return run


FOUND = "asking long, window int, node long, vec_id long, score long"
_FOUND = pa.schema([("asking", pa.int64()), ("window", pa.int32()), ("node", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _searched(same: bool, most: int):
    """The best rows of a block for each window of the queries that met it."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if rows.num_rows and queries.num_rows:
            ids = rows.column("vec_id").combine_chunks().fill_null(LAST).to_numpy()
            order = pa.array(np.lexsort((rows.column("node").to_numpy(), ids)))
            rows = rows.take(order)
            node, label = rows.column("node").to_numpy(), rows.column("label").to_numpy()
            ids = rows.column("vec_id").to_pylist()
            size = len(rows.column("vector")[0])
            vectors = matrix(rows.column("vector").combine_chunks(), size)
            step = max(1, CELLS // len(vectors))
            for start in range(0, queries.num_rows, step):
                part = queries.slice(start, step)
                asking, own = part.column("node").to_numpy(), part.column("label").to_numpy()
                scores = products(matrix(part.column("vector").combine_chunks(), size), vectors)
                for n, windows in enumerate(part.column("windows").to_pylist()):
                    fits = ((label == own[n]) == same) & (node != asking[n])
                    for w, window in enumerate(windows):
                        good = fits & (scores[n] >= window["low"]) & (scores[n] <= window["high"])
                        for at in best(scores[n], good, most).tolist():
                            out.append((int(asking[n]), w, int(node[at]), ids[at], int(scores[n][at])))
        columns = list(zip(*out, strict=True)) or [()] * 5
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND)

    return run


def search(placed: DataFrame, queries: DataFrame, tree: Tree, sample: Sample, same: bool, width: int, k: int, block: int = BLOCK) -> DataFrame:
    """(asking, window, node, vec_id, score, rank): the k best rows in each window of every query.

    A query has node, label, vector and windows of scores. Only rows of the same
    label answer it, or only rows of others.
    """
    routed = kept(queries.mapInArrow(_routed(tree, sample, same, width, k), f"{ROWS}, windows array<struct<low:long,high:long>>, leaf long"))
    blocks = F.ceil(F.count("*") / block).cast("int")
    left = placed.groupBy("leaf").agg(blocks.alias("row_blocks"))
    right = routed.groupBy("leaf").agg(blocks.alias("query_blocks"))
    sizes = left.join(right, "leaf")

    def dealt(df: DataFrame, own: str, other: str, name: str, facing: str) -> DataFrame:
        return (
            df.join(sizes, "leaf")
            .withColumn(name, F.pmod(F.xxhash64("node"), F.col(own)).cast("int"))
            .withColumn(facing, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .drop("row_blocks", "query_blocks")
        )

    met = ["leaf", "row_block", "query_block"]
    rows = dealt(placed, "row_blocks", "query_blocks", "row_block", "query_block")
    asked = dealt(routed, "query_blocks", "row_blocks", "query_block", "row_block")
    found = rows.groupBy(*met).cogroup(asked.groupBy(*met)).applyInArrow(_searched(same, k), FOUND)
    first = Window.partitionBy("asking", "window").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "node")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, shares: tuple[int, int] = SHARES,
    sample_rows: int = SAMPLE, fanout: int = FANOUT, leaf: int = LEAF, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    `rows` has vec_id, label, vector (whole numbers) and anchor (boolean).
    """
    usable = F.col("label").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
    known = kept(
        rows.filter(usable).select(
            F.monotonically_increasing_id().alias("node"), F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"), F.col("vector").cast("array<long>").alias("vector"),
            (F.coalesce("anchor", F.lit(False)) & F.col("vec_id").isNotNull()).alias("anchor"),
        )
    )
    picked = known.orderBy(F.xxhash64("node"), "node").limit(sample_rows).collect()
    lengths = [len(r.vector) for r in picked]
    size = max(sorted(set(lengths)), key=lengths.count, default=0)
    picked = [r for r in picked if len(r.vector) == size]
    vectors = np.array([r.vector for r in picked], dtype=np.int64).reshape(len(picked), size)
    sample = Sample(np.array([r.node for r in picked], dtype=np.int64), np.array([r.label for r in picked], dtype=np.int64), vectors)
    nodes = grow(vectors, known.count(), fanout, leaf)
    placed = kept(known.mapInArrow(_placed(nodes, size), f"{ROWS}, anchor boolean, leaf long"))
    tree = _fitted(placed, nodes, size)

    anchors = placed.filter("anchor").select("node", "vec_id", "label", "vector")
    placed = placed.select("node", "vec_id", "label", "vector", "leaf")
    window = F.struct(F.lit(-(1 << 63)).cast("long").alias("low"), F.lit((1 << 63) - 1).alias("high"))
    asked = anchors.withColumn("windows", F.array(window))
    near = kept(search(placed, asked, tree, sample, True, 1, positives, block))
    low, high = shares
    # Whole scores s with low * p <= 100 * s <= high * p.
    allowed = F.struct(
        F.expr(f"cast(ceil(cast(score as decimal(20,0)) * {low} / 100) as long)").alias("low"),
        F.expr(f"cast(floor(cast(score as decimal(20,0)) * {high} / 100) as long)").alias("high"),
    )
    lists = near.groupBy(F.col("asking").alias("node")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score", allowed.alias("allowed")))).alias("near")
    )
    asked = anchors.join(lists, "node").withColumn("windows", F.col("near.allowed")).drop("near")
    far = search(placed, asked, tree, sample, False, positives, negatives, block)
    named = near.select(
        "asking", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return (
        far.join(named, ["asking", "window"])
        .join(anchors.select(F.col("node").alias("asking"), F.col("vec_id").alias("anchor_id")), "asking")
        .select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
