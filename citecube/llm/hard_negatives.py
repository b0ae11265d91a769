"""Hard-negative mining with a GNAT-style multiway hyperplane tree.

A node of the tree has several split points, and a row belongs to the child of
its nearest one, so children are separated by hyperplanes.  For every split
point and every sibling's subtree the node stores the range of their distances,
and the range of the subtree's norms.  A window of scores is an annulus of
distances around the anchor: by the triangle inequality the split points' known
distances bound what a subtree can score, and a subtree whose bounds miss all of
the anchor's windows is eliminated with everything below it.  What is left are
leaves, which are searched exactly.

Split points come from a bounded sample (SAMPLE rows), so the tree stays small
and travels with the tasks; every row is indexed, and the ranges are taken over
all rows.  A leaf is cut into chunks of bounded size, dealt out by row number,
so that neither a large leaf nor many equal rows meet in one task.

Positives are found first: the k-th best row of the anchor's label within the
sample bounds the window from below.  Their scores make the windows of the
negatives."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .cap_filters import matrix
from .common import materialize
from .topk import LONG_MAX, scaled

SAMPLE = 4096       # rows from which split points are taken
LEAF = 32           # sample rows below which a node is not split
WAYS = 8            # split points of a node
CHUNK = 16384       # rows of a tile
GROUP = 4096        # anchors of a tile
EXACT = 2.0**50     # inner products below it are whole numbers in float64


def far_points(x: np.ndarray) -> np.ndarray:
    """Split points: each the farthest from those before it, among the first
    3 * WAYS rows; fewer where no others differ."""
    rows = x[:3 * WAYS]
    chosen, far = [0], distances(rows, rows[:1])[:, 0]
    while len(chosen) < WAYS and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, distances(rows, rows[chosen[-1:]])[:, 0])
    return rows[chosen]


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None, :] - 2 * (x @ points.T)
    return np.sqrt(np.maximum(square, 0.0))


class Tree:
    """Split points and children of each node; a negative child is the leaf -1 - child."""

    def __init__(self, sample: np.ndarray):
        self.points: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.ranges: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, float, float]] = {}
        self.root = self._grow(sample)

    def _grow(self, x: np.ndarray) -> int:
        points = far_points(x) if len(x) > LEAF else x[:1]
        if len(points) < 2:
            self.leaves += 1
            return -self.leaves
        node = len(self.points)
        self.points.append(points)
        self.children.append([])
        nearest = distances(x, points).argmin(axis=1)
        for j in range(len(points)):
            self.children[node].append(self._grow(x[nearest == j]))
        return node

    def descend(self, x: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(node, child, rows, distances to the node's points) down to the leaves."""
        todo = [(self.root, np.arange(len(x)))] if self.root >= 0 else []
        while todo:
            node, rows = todo.pop()
            apart = distances(x[rows], self.points[node])
            nearest = apart.argmin(axis=1)
            for j, child in enumerate(self.children[node]):
                mine = nearest == j
                if mine.any():
                    yield node, j, rows[mine], apart[mine]
                    if child >= 0:
                        todo.append((child, rows[mine]))

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(x), np.int64)
        for node, j, rows, _ in self.descend(x):
            leaf[rows] = -1 - self.children[node][j]
        return leaf

    def search(self, query: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[int]:
        """Leaves that may hold a row whose score lies in one of the windows."""
        own, found = float(query @ query), []
        todo = [self.root]
        while todo:
            node = todo.pop()
            if node < 0:
                found.append(-1 - node)
                continue
            away = distances(query[None, :], self.points[node])[0]
            for j, child in enumerate(self.children[node]):
                if (node, j) not in self.ranges:
                    continue       # no row lies there
                near, far, least, most = self.ranges[node, j]
                inner = max(0.0, (away - far).max(), (near - away).max())
                outer = (away + far).min()
                slack = 1.0 + 1e-9 * (own + most + outer * outer)      # of float64 distances
                if ((low <= (own + most - inner * inner) / 2 + slack) & (high >= (own + least - outer * outer) / 2 - slack)).any():
                    todo.append(child)
        return found


def vectors_of(lists: pa.ListArray | pa.ChunkedArray, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, whole components) by length; components beyond float64 are Python ints."""
    for at, x in matrix(lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists):
        yield at, scaled(x, scale)


def is_small(x: np.ndarray) -> np.ndarray:
    """Rows whose inner products are exact in float64."""
    if x.dtype != object:
        return np.abs(x).max(axis=1, initial=0.0) ** 2 * max(x.shape[1], 1) < EXACT
    return np.array([max(map(abs, r), default=0) ** 2 * max(x.shape[1], 1) < EXACT for r in x.tolist()], bool)


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whole inner products, clipped to a long."""
    if not len(queries) or not len(rows):
        return np.zeros((len(queries), len(rows)), np.int64)
    if is_small(queries).all() and is_small(rows).all():
        return (queries.astype(float) @ rows.astype(float).T).astype(np.int64)
    whole = [[int(v) for v in r] for r in rows.tolist()]
    return np.array([[max(-LONG_MAX - 1, min(LONG_MAX, sum(int(a) * b for a, b in zip(q, r)))) for r in whole]
                     for q in queries.tolist()], np.int64)


class Index:
    """The trees of all vector lengths and the chunks of their cells.  Of a
    length's cells, 0 has the rows too large for exact distances, which are never
    eliminated, and 1, 2, ... are the leaves."""

    def __init__(self, lengths: list[int], sample: list[tuple[int, int, list[float]]], scale: int):
        self.scale, self.trees, self.sample = scale, {}, {}
        for d in lengths:
            mine = [r for r in sample if len(r[2]) == d]
            x = scaled(np.array([r[2] for r in mine], float).reshape(len(mine), d), scale)
            keep = is_small(x)
            x = x[keep].astype(float)
            ids, labels = (np.array([r[c] for r in mine], np.int64)[keep] for c in (0, 1))
            self.trees[d], self.sample[d] = Tree(x), (ids, labels, x)
        self.chunks: dict[int, int] = {}

    def cell(self, d: int, leaf: np.ndarray | int) -> np.ndarray | int:
        return d * 2**32 + 1 + leaf

    def cells_of(self, x: np.ndarray) -> np.ndarray:
        d, small = x.shape[1], is_small(x)
        out = np.full(len(x), d * 2**32, np.int64)
        if small.any():
            out[small] = self.cell(d, self.trees[d].leaf_of(x[small].astype(float)))
        return out

    def routes(self, query: np.ndarray, low: list[int], high: list[int]) -> Iterator[tuple[int, int]]:
        """(cell, chunk) of all that may hold a score in one of the windows."""
        d = len(query)
        if is_small(query[None, :])[0]:
            leaves = self.trees[d].search(query.astype(float), np.array(low, float), np.array(high, float))
        else:
            leaves = range(self.trees[d].leaves)
        for cell in (d * 2**32, *(self.cell(d, leaf) for leaf in leaves)):
            for chunk in range(self.chunks.get(cell, 0)):
                yield cell, chunk

    def bound(self, own: int, label: int, query: np.ndarray, k: int) -> int:
        """A score that at least ``k`` other rows of the label reach."""
        ids, labels, x = self.sample[len(query)]
        found = scores(query[None, :], x[(labels == label) & (ids != own)])[0]
        return int(np.partition(found, len(found) - k)[len(found) - k]) if len(found) >= k else -LONG_MAX - 1


def ranges(rows: DataFrame, index: Index) -> DataFrame:
    """(d, node, child, point, near, far) over all rows; point -1 has the
    range of the squared norms."""
    def run(batches):
        found: dict[tuple[int, int, int], list[np.ndarray]] = {}
        for batch in batches:
            for _, x in vectors_of(batch.column("vector"), index.scale):
                x = x[is_small(x)].astype(float)
                square = (x * x).sum(axis=1)
                for node, j, at, apart in index.trees[x.shape[1]].descend(x):
                    seen = np.column_stack([square[at], apart])
                    lo, hi = found.setdefault((x.shape[1], node, j), [seen[0], seen[0]])
                    found[x.shape[1], node, j] = [np.minimum(lo, seen.min(axis=0)), np.maximum(hi, seen.max(axis=0))]
        out = [(*key, i - 1, float(lo[i]), float(hi[i])) for key, (lo, hi) in found.items() for i in range(len(lo))]
        names = ["d", "node", "child", "point", "near", "far"]
        kinds = [pa.int64()] * 4 + [pa.float64()] * 2
        columns = list(zip(*out)) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return (rows.mapInArrow(run, "d long, node long, child long, point long, near double, far double")
            .groupBy("d", "node", "child", "point").agg(F.min("near").alias("near"), F.max("far").alias("far")))


def build(rows: DataFrame, scale: int) -> tuple[Index, DataFrame]:
    """The index of the rows (id, label, vector, row, ...), and the rows with
    their cell and chunk."""
    lengths = [r.d for r in rows.select(F.size("vector").alias("d")).distinct().collect()]
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("id", "label", "vector").collect()
    index = Index(lengths, [tuple(r) for r in sample], scale)

    def place(batches):
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int64)
            for at, x in vectors_of(batch.column("vector"), scale):
                cell[at] = index.cells_of(x)
            yield batch.append_column("cell", pa.array(cell))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", cell long"
    placed = materialize(rows.mapInArrow(place, schema), "gn-rows")
    for key in ranges(placed, index).groupBy("d", "node", "child").agg(
            F.sort_array(F.collect_list(F.struct("point", "near", "far"))).alias("r")).collect():    # as many as the tree has points
        near, far = (np.array([r[c] for r in key.r]) for c in ("near", "far"))
        index.trees[key.d].ranges[key.node, key.child] = (near[1:], far[1:], near[0], far[0])
    counts = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()                      # as many as leaves
    index.chunks = {r.cell: math.ceil(r.n / CHUNK) for r in counts}
    sizes = rows.sparkSession.createDataFrame(list(index.chunks.items()) or [(0, 0)], "cell long, chunks long")
    return index, (placed.join(F.broadcast(sizes), "cell")
                   .withColumn("chunk", F.pmod(F.xxhash64("row"), "chunks")).drop("chunks"))


def best(score: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` first of the places, by score from above, then by id."""
    if len(at) > k:      # ties with the k-th stay for the ids to decide
        at = at[score[at] >= np.partition(score[at], len(at) - k)[len(at) - k]]
    return at[np.lexsort((ids[at], -score[at]))[:k]]


def positives(placed: DataFrame, anchors: DataFrame, index: Index, groups: int, k: int) -> DataFrame:
    """(anchor_id, label, vector, positive, positive_id, positive_score): each
    anchor's ``k`` first other rows of its label, numbered."""
    def route(batches):
        for batch in batches:
            out = []
            ids, labels = (batch.column(c).to_numpy() for c in ("anchor_id", "label"))
            for at, x in vectors_of(batch.column("vector"), index.scale):
                for p, q in zip(at.tolist(), x):
                    low = index.bound(int(ids[p]), int(labels[p]), q, k)
                    out += [(p, cell, chunk, low) for cell, chunk in index.routes(q, [low], [LONG_MAX])]
            where = np.array(out, np.int64).reshape(-1, 4).T
            taken = batch.take(pa.array(where[0]))
            for name, column in zip(("cell", "chunk", "low"), where[1:]):
                taken = taken.append_column(name, pa.array(column))
            yield taken

    def tile(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        for at, x, ids, labels, ask, score in met(rows, asked, index.scale):
            own, want, low = (asked.column(c).to_numpy() for c in ("anchor_id", "label", "low"))
            for p, s in zip(ask.tolist(), score):
                hits = np.flatnonzero((labels == want[p]) & (ids != own[p]) & (s >= low[p]))
                out += [(int(own[p]), int(ids[h]), int(s[h])) for h in best(s, ids, hits, k)]
        return table(out, ["anchor_id", "positive_id", "positive_score"])

    asks = spread(anchors).mapInArrow(route, "anchor_id long, label long, vector array<double>, grp long, cell long, chunk long, low long")
    found = tiles(placed, asks, groups).applyInArrow(tile, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return materialize(found.withColumn("positive", F.row_number().over(order)).where(F.col("positive") <= k), "gn-positives")


def spread(anchors: DataFrame) -> DataFrame:
    """Few rows, much work each: as many tasks as a shuffle has."""
    return anchors.repartition(shuffle_partitions(anchors.sparkSession), "anchor_id")


def table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def tiles(placed: DataFrame, asks: DataFrame, groups: int):
    """Every chunk of rows beside the anchors of a group that search it."""
    key = ["cell", "chunk", "grp"]
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    return placed.select("cell", "chunk", "id", "label", "vector", every.alias("grp")).groupBy(*key).cogroup(asks.groupBy(*key))


def met(rows: pa.Table, asked: pa.Table, scale: int) -> Iterator[tuple]:
    """(places, vectors, ids, labels, anchors, scores) of a tile, some anchors at a time."""
    if not rows.num_rows or not asked.num_rows:
        return
    all_ids, all_labels = (rows.column(c).to_numpy() for c in ("id", "label"))
    by_length = {x.shape[1]: (at, x) for at, x in vectors_of(asked.column("vector"), scale)}
    for at, x in vectors_of(rows.column("vector"), scale):
        asking, questions = by_length.get(x.shape[1], (np.empty(0, np.int64), x[:0]))
        small = is_small(questions)
        for part in (np.flatnonzero(small), np.flatnonzero(~small)):     # few large ones must not slow the rest down
            for lo in range(0, len(part), 256):
                some = part[lo:lo + 256]
                yield at, x, all_ids[at], all_labels[at], asking[some], scores(questions[some], x)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, n_positives: int = 5, n_negatives: int = 5,
                   low: int = 80, high: int = 100, scale: int = 256, id_col: str = "vec_id",
                   vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for every row where ``is_anchor`` holds, and each of its
    ``n_positives`` first other rows of the same label, the ``n_negatives`` first
    rows of another label with low * positive_score <= 100 * negative_score <=
    high * positive_score.

    A score is the inner product of the vectors' components floor(scale * x);
    higher ones come first, ties by the smaller id.  ``label`` is a whole
    number.  A null id, label or vector, or a null or non-finite component,
    keeps a row out.  Vectors meet those of their own length.  Rows that repeat
    an id are candidates each, but never for their own id; as an anchor an id
    counts once, by its smallest vector.  Scores beyond a long are clipped to it.
    Fewer candidates give fewer rows; an empty table gives none; extra columns
    are ignored."""
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = materialize(
        vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), is_anchor.alias("asks"),
                       F.col(vector_col).cast("array<double>").alias("vector"))
        .where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(usable)
        .withColumn("row", F.monotonically_increasing_id()), "gn-vectors")
    index, placed = build(rows, scale)
    anchors = (rows.where("asks").groupBy("id").agg(F.min(F.struct("vector", "label")).alias("v"))
               .select(F.col("id").alias("anchor_id"), "v.label", "v.vector"))
    groups = max(1, math.ceil(anchors.count() / GROUP))
    anchors = materialize(anchors.withColumn("grp", F.pmod(F.xxhash64("anchor_id"), F.lit(groups).cast("long"))), "gn-anchors")
    found = positives(placed, anchors, index, groups, n_positives)
    mine = found.groupBy("anchor_id").agg(F.sort_array(F.collect_list(
        F.struct("positive", "positive_id", "positive_score"))).alias("positives"))       # n_positives at most
    windows = materialize(anchors.join(mine, "anchor_id")
                          .select("*", F.col("positives.positive").cast("array<long>").alias("p"),
                                  F.col("positives.positive_score").alias("s")).drop("positives"), "gn-windows")

    def window(score: int) -> tuple[int, int]:
        return -(-low * score // 100), high * score // 100

    def route(batches):
        for batch in batches:
            out = []
            wanted = batch.column("s").to_pylist()
            for at, x in vectors_of(batch.column("vector"), index.scale):
                for p, q in zip(at.tolist(), x):
                    bounds = [w for w in map(window, wanted[p]) if w[0] <= w[1]]
                    if bounds:
                        out += [(p, cell, chunk) for cell, chunk in index.routes(q, *map(list, zip(*bounds)))]
            where = np.array(out, np.int64).reshape(-1, 3).T
            taken = batch.take(pa.array(where[0]))
            yield taken.append_column("cell", pa.array(where[1])).append_column("chunk", pa.array(where[2]))

    def tile(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        number, wanted = asked.column("p").to_pylist(), asked.column("s").to_pylist()
        own, mine = asked.column("anchor_id").to_numpy(), asked.column("label").to_numpy()
        for at, x, ids, labels, ask, score in met(rows, asked, index.scale):
            for p, s in zip(ask.tolist(), score):
                other = (labels != mine[p]) & (ids != own[p])
                for place, positive in zip(number[p], wanted[p]):
                    lo, hi = (max(-LONG_MAX - 1, min(LONG_MAX, w)) for w in window(positive))
                    hits = np.flatnonzero(other & (s >= lo) & (s <= hi))
                    out += [(int(own[p]), place, int(ids[h]), int(s[h])) for h in best(s, ids, hits, n_negatives)]
        return table(out, ["anchor_id", "positive", "negative_id", "negative_score"])

    asks = spread(windows).mapInArrow(route, "anchor_id long, label long, vector array<double>, grp long, p array<long>, s array<long>, "
                                     "cell long, chunk long")
    hits = tiles(placed, asks, groups).applyInArrow(tile, "anchor_id long, positive long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive").orderBy(F.desc("negative_score"), "negative_id")
    first = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
    return (first.join(found, ["anchor_id", "positive"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
