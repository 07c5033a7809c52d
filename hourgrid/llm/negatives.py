"""Hard negatives by a GNAT-style multiway hyperplane tree.

Every split point of a node takes the rows that lie nearer to it than to its siblings.  For each pair of siblings i, j the
tree stores the range of distances from split point i to all rows below j, and the range of norms below j.  A query asks
for the rows whose score lies in a window.  With |x| known by its range, a score window is an annulus of distances about the
query, and a subtree goes if for some split point the annulus cannot meet the stored range.  What is left are leaves, in
which scores are worked out exactly.

The tree's split points come from a sample of at most SAMPLE rows, the ranges from all rows.  Ranges, and so the search, are
exact whatever the sample; the sample also gives each window a first lower bound, as the scores of rows that it holds
already bound the result from below.  Leaves and the queries that visit them meet in cells of at most CELL rows and CELL
queries, so no leaf, and no row that all queries visit, is one task's work.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.llm.common import col, kept

SAMPLE = 8192  # rows that split points are taken from
ARMS = 8  # split points of a node
LEAF = 64  # rows of the sample in a leaf
CELL = 4096  # rows, and queries, compared at once
POSITIVES = 5
NEGATIVES = 10
EXACT = 1 << 53  # integers below are exact as doubles
SLACK = 1e-6  # of a distance, for rounding


@dataclass
class Node:
    """A split: its points, what is below each, and the ranges of distances and norms below each."""

    points: np.ndarray
    below: list["Node | int"]
    near: np.ndarray = field(default=None)
    far: np.ndarray = field(default=None)
    shortest: np.ndarray = field(default=None)
    longest: np.ndarray = field(default=None)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between the rows of a and of b."""
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _spread(rows: np.ndarray, arms: int) -> np.ndarray:
    """Split points far from each other: each the row farthest from those before it."""
    chosen = [0]
    gap = distances(rows, rows[:1])[:, 0]
    while len(chosen) < arms and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, distances(rows, rows[chosen[-1:]])[:, 0])
    return rows[chosen]


class Tree:
    """Split points of a bounded sample; ranges are put in later, from all rows."""

    def __init__(self, sample: np.ndarray, arms: int = ARMS, leaf: int = LEAF):
        self.nodes: list[Node] = []
        self.leaves = 0
        self.width = sample.shape[1]
        self.top = self._grown(sample, arms, leaf)

    def _grown(self, rows: np.ndarray, arms: int, leaf: int) -> Node | int:
        points = _spread(rows, arms) if len(rows) > leaf else rows[:1]
        if len(points) < 2:
            self.leaves += 1
            return self.leaves - 1
        node = Node(points, [])
        self.nodes.append(node)
        home = distances(rows, points).argmin(axis=1)
        node.below = [self._grown(rows[home == k], arms, leaf) for k in range(len(points))]
        return node

    def placed(self, rows: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, float, float]]]:
        """Leaf of each row, and the ranges (node, i, j, lowest, highest) that the rows give; i is -1 for norms."""
        leaf, ranges = np.zeros(len(rows), np.int32), []
        norms = np.sqrt((rows * rows).sum(axis=1))
        todo = [(self.top, np.arange(len(rows)))]
        number = {id(n): k for k, n in enumerate(self.nodes)}
        while todo:
            at, some = todo.pop()
            if not isinstance(at, Node):
                leaf[some] = at
                continue
            gaps = distances(rows[some], at.points)
            home = gaps.argmin(axis=1)
            for j, below in enumerate(at.below):
                mine = home == j
                if mine.any():
                    low, high = gaps[mine].min(axis=0), gaps[mine].max(axis=0)
                    ranges += [(number[id(at)], i, j, float(low[i]), float(high[i])) for i in range(len(at.points))]
                    ranges.append((number[id(at)], -1, j, float(norms[some[mine]].min()), float(norms[some[mine]].max())))
                    todo.append((below, some[mine]))
        return leaf, ranges

    def ranged(self, ranges: list[tuple[int, int, int, float, float]]) -> None:
        for node in self.nodes:
            n = len(node.points)
            node.near, node.far = np.full((n, n), np.inf), np.full((n, n), -np.inf)
            node.shortest, node.longest = np.full(n, np.inf), np.full(n, -np.inf)
        for k, i, j, low, high in ranges:
            if i < 0:
                self.nodes[k].shortest[j], self.nodes[k].longest[j] = low, high
            else:
                self.nodes[k].near[i, j], self.nodes[k].far[i, j] = low, high

    def visited(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query number, leaf) for every leaf that may hold a row whose score with the query is from ``low`` to ``high``."""
        own = (queries * queries).sum(axis=1)
        found, todo = [], [(self.top, np.flatnonzero(low <= high))]
        while todo:
            at, some = todo.pop()
            if not isinstance(at, Node):
                found.append((some, np.full(len(some), at, np.int32)))
                continue
            gaps = distances(queries[some], at.points)
            for j, below in enumerate(at.below):
                if at.shortest[j] > at.longest[j]:
                    continue  # no row lies here
                inner = np.sqrt(np.maximum(own[some] + at.shortest[j] ** 2 - 2 * high[some], 0))
                outer = np.sqrt(np.maximum(own[some] + at.longest[j] ** 2 - 2 * low[some], 0))
                room = SLACK * (1 + outer + at.longest[j] + np.sqrt(own[some]))
                closest = np.maximum(at.near[:, j] - gaps, gaps - at.far[:, j]).max(axis=1)
                farthest = (gaps + at.far[:, j]).min(axis=1)
                stays = (closest <= outer + room) & (farthest >= inner - room)
                if stays.any():
                    todo.append((below, some[stays]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return tuple(np.concatenate(x) for x in zip(*found))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of a and b (whole numbers as doubles), exact; as Python numbers where doubles are not."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1]) < EXACT:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in a], object) @ np.array([[int(x) for x in row] for row in b], object).T
    return exact.astype(np.int64)  # an overflow is an error, not a wrong score


def whole_numbers(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(``id``, ``label``, ``vec``) of the rows that take part, components as floor(256 x).

    Left out are rows with a null label, identifier, vector or component, or a component that is not finite.  Of rows that
    share an identifier the first by label and vector stands.
    """
    vec = col(vector_col).cast("array<double>")
    given = rows.select(col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), vec.alias("x")).where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    given = given.where(F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    # floor of a double stays a double here: components may be larger than a long
    whole = F.transform("x", lambda x: F.when(F.abs(x) < float(1 << 45), F.floor(x * 256).cast("double")).otherwise(x * 256))
    one = given.select("id", F.struct("label", whole.alias("vec")).alias("row")).groupBy("id").agg(F.min("row").alias("row"))
    return one.select("id", "row.label", "row.vec")


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows of equal width, filled up with zeros."""
    sizes = column.value_lengths().to_numpy().astype(np.int64)
    flat = column.flatten().to_numpy()
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


@dataclass
class Index:
    """The rows by leaf, the tree, and the sample with its labels."""

    rows: DataFrame  # leaf, block, id, label, vec
    tree: Tree
    blocks: list[int]  # of each leaf, that its rows are dealt to
    sample: tuple[np.ndarray, np.ndarray, np.ndarray]


def indexed(rows: DataFrame, sample_rows: int = SAMPLE) -> Index:
    """Every row under its leaf; the tree is grown from ``sample_rows`` rows at most, those with the lowest hash of their identifier."""
    rows = kept(rows)
    spark = rows.sparkSession
    width = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).toArrow().combine_chunks()
    batch = picked.to_batches()[0] if picked.num_rows else None
    ids, labels = (batch.column(k).to_numpy() if batch else np.zeros(0, np.int64) for k in (0, 1))
    vectors = _matrix(batch.column(2), width) if batch else np.zeros((0, width))
    tree = Tree(vectors if len(vectors) else np.zeros((1, width)))
    shared = spark.sparkContext.broadcast(tree)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, _ = shared.value.placed(_matrix(batch.column(2), width))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], names=["leaf", "id", "label", "vec"])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, found = shared.value.placed(_matrix(batch.column(0), width))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=["node", "i", "j", "low", "high"])

    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
    ranges = rows.select("vec").mapInArrow(measured, "node int, i int, j int, low double, high double")
    tree.ranged([tuple(r) for r in ranges.groupBy("node", "i", "j").agg(F.min("low"), F.max("high")).collect()])  # bounded by the tree
    leaves = kept(rows.mapInArrow(placed, "leaf int, id long, label long, vec array<double>"))
    blocks = _cells(leaves, tree.leaves)
    block = F.pmod(F.xxhash64("id"), _of_leaf(blocks)).cast("int").alias("block")
    return Index(leaves.select("*", block), tree, blocks, (ids, labels, vectors))


def _cells(rows: DataFrame, leaves: int) -> list[int]:
    """Cells that the rows of each leaf are dealt to, one number per leaf of the tree."""
    found = {r["leaf"]: -(-r["count"] // CELL) for r in rows.groupBy("leaf").count().collect()}
    return [found.get(k, 0) for k in range(leaves)]


def _of_leaf(numbers: list[int]) -> Column:
    """The number of the row's leaf."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<int>")[F.col("leaf")]


QUERY = "id long, label long, vec array<double>, same boolean, low array<long>, high array<long>, n int"


def searched(queries: DataFrame, index: Index) -> DataFrame:
    """Best rows of every query: (``id``, ``window``, ``found``, ``score``), ``n`` or fewer per window, in no order.

    A query looks among the other rows of its label (``same``) or the rows of other labels, and has windows of scores
    from ``low[k]`` to ``high[k]``; higher scores come first, ties by smaller identifier.
    """
    tree, width = index.tree, index.tree.width
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast((tree, index.sample))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, (ids, labels, vectors) = shared.value
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                own, label, same, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 3, 6))
                vec = _matrix(batch.column(2), width)
                lows, highs = batch.column(4).to_pylist(), batch.column(5).to_pylist()
                known = scores(vec, vectors)
                for q in range(len(own)):
                    fit = (labels == label[q]) & (ids != own[q]) if same[q] else labels != label[q]
                    best = np.sort(known[q][fit])[::-1]
                    for w, (low, high) in enumerate(zip(lows[q], highs[q])):
                        inside = best[(best >= low) & (best <= high)]
                        if len(inside) >= n[q]:
                            lows[q][w] = int(inside[n[q] - 1])
                low = np.array([min(x, default=1) for x in lows], float)
                high = np.array([max(x, default=0) for x in highs], float)
                query, leaf = tree.visited(vec, low, high)
                at = pa.array(query)
                columns = [batch.column(k).take(at) for k in range(7)]
                columns[4] = pa.array([lows[k] for k in query.tolist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), *columns], names=["leaf", "id", "label", "vec", "same", "low", "high", "n"])

    visits = kept(queries.mapInArrow(routed, f"leaf int, {QUERY}"))
    parts = _of_leaf(_cells(visits, tree.leaves))
    asked = visits.where(_of_leaf(index.blocks) > 0).withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), _of_leaf(index.blocks) - 1)))
    held = index.rows.where(parts > 0).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("window", T.IntegerType()), T.StructField("found", T.LongType()), T.StructField("score", T.LongType())])

    def compared(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if queries.num_rows and rows.num_rows:
            q, r = (t.combine_chunks() for t in (queries, rows))
            column = lambda t, name: t[name].chunk(0)
            own, label, same, n = (column(q, c).to_numpy(zero_copy_only=False) for c in ("id", "label", "same", "n"))
            ids, labels = (column(r, c).to_numpy() for c in ("id", "label"))
            by = np.argsort(ids, kind="stable")
            ids, labels, vectors = ids[by], labels[by], _matrix(column(r, "vec"), width)[by]
            vec, lows, highs = _matrix(column(q, "vec"), width), column(q, "low").to_pylist(), column(q, "high").to_pylist()
            for first in range(0, len(own), 256):
                known = scores(vec[first : first + 256], vectors)
                for k in range(len(known)):
                    at = first + k
                    fit = np.flatnonzero((labels == label[at]) & (ids != own[at]) if same[at] else labels != label[at])
                    fit = fit[known[k][fit] >= min(lows[at])]
                    fit = fit[np.argsort(-known[k][fit], kind="stable")]  # rows are in the order of their identifiers
                    sunk = -known[k][fit]
                    for w, (low, high) in enumerate(zip(lows[at], highs[at])):
                        start, stop = np.searchsorted(sunk, -high), np.searchsorted(sunk, -low, "right")
                        some = fit[start : min(stop, start + n[at])]
                        for c, values in zip(out, (np.full(len(some), own[at]), np.full(len(some), w), ids[some], known[k][some])):
                            c.append(values)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.array(np.concatenate(c) if c else [], k) for c, k in zip(out, kinds)], names=schema.names)

    key = ["leaf", "block", "part"]
    return asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInArrow(compared, schema)


def _best(found: DataFrame, n: int) -> DataFrame:
    """The first ``n`` of each query and window, with their ``rank`` from 1."""
    order = Window.partitionBy("id", "window").orderBy(F.col("score").desc(), "found")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
    every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = 30, highest: int = 90, sample_rows: int = SAMPLE,
) -> DataFrame:
    """Per anchor and positive the best rows of other labels whose score lies between two shares of the positive's.

    ``anchor_id``, ``positive_id``, ``rank`` from 1, ``negative_id``, ``positive_score``, ``negative_score``.  Anchors are the
    rows whose identifier is divisible by ``every``; the shares are in percent.  Scores are integer inner products of
    floor(256 x); higher ones come first, ties by smaller identifier.

    - Rows with a null label, identifier, vector or component, or one that is not finite, take no part; of rows that share
      an identifier the first by label and vector stands.  An empty table gives no row.
    - Of vectors of different lengths the missing components are zero; empty vectors have score zero with all.
    - A window without a row, as that of a negative positive score is, gives none.  A score beyond a long is an error.
    """
    given = whole_numbers(rows, id_col, vector_col, F.col("label") if label is None else label)
    index = indexed(given, sample_rows)
    least, most = -(1 << 62), 1 << 62
    anchors = kept(index.rows.where(F.col("id") % every == 0).select("id", "label", "vec"))
    window = lambda value: F.array(F.lit(value).cast("long"))
    first = anchors.select("*", F.lit(True).alias("same"), window(least).alias("low"), window(most).alias("high"), F.lit(positives).alias("n"))
    share = F.col("score").cast("decimal(20,0)")
    pairs = kept(_best(searched(first, index), positives).select(
        "id", (F.col("rank") - 1).alias("window"), F.col("found").alias("positive_id"), F.col("score").alias("positive_score"),
        # whole scores inside: the lowest rounded up, the highest down
        F.ceil(share * lowest / 100).cast("long").alias("low"),
        F.floor(share * highest / 100).cast("long").alias("high"),
    ))
    windows = pairs.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("window", "low", "high"))).alias("w"))
    second = anchors.join(windows, "id").select("id", "label", "vec", F.lit(False).alias("same"), F.col("w.low").alias("low"), F.col("w.high").alias("high"), F.lit(negatives).alias("n"))
    found = _best(searched(second, index), negatives).join(pairs.select("id", "window", "positive_id", "positive_score"), ["id", "window"])
    return found.select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
