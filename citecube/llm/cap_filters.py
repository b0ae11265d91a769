"""Embedding near-dedup by spherical-cap filters.

A filter is a direction; it keeps the vectors whose inner product with it
exceeds a threshold, a cap of the sphere.  The directions form random product
codes: after a random rotation the space is cut into blocks, each with its own
random words, and every combination of one word a block is a direction.  So the
millions of directions need not be tried: a vector's filters are list-decoded,
block by block, dropping a partial combination as soon as the best words of the
blocks to come cannot lift it over the threshold.  Several codes, each with a
rotation of its own, even out how many filters a pair shares.

Vectors join on their filters.  A filter's members first meet with 256-bit sign
sketches only, and most end there; the others bring their vectors and are
verified in double precision.  Caps get smaller as the vectors get more, so that
a filter keeps a few dozen of unrelated ones at any size; a filter that holds
more (copies of one vector) is cut into strips which meet in pairs, each pair of
strips in a task's bounded memory.  No pair is ever emitted: a tile returns for
each member how many it is linked with and the smallest member it hangs
together with there.  A pair that shares several filters counts in its smallest."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .graph import components

BLOCKS = 2          # of a product code
CODES = 24          # product codes, each after a rotation of its own, so that none decides over a pair
BUCKET = 32         # unrelated members aimed at per filter
WIDEST = 0.02       # share of all directions in a cap at most (small tables)
SHARED = 16.0       # filters that a pair at the threshold shares on average
STRIP = 2048        # members of a tile's side
SKETCH = 256        # bits
DEVIATIONS = 5.0    # a pair at the threshold fails the sketch test with a chance under 1e-6
KEY = ["filter", "i", "j"]


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@lru_cache(4)
def rotations(d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A random rotation of ``d`` dimensions into 60 or more, the signs that
    each code gives to the turned coordinates, the rotation that follows, and
    the sketch's directions."""
    rng = np.random.default_rng([11, d])
    wide = -(-max(d, 60) // BLOCKS) * BLOCKS
    first, second = (np.linalg.qr(rng.standard_normal((wide, wide)))[0] for _ in range(2))
    return first[:d], rng.choice([-1.0, 1.0], (CODES, wide)), second, rng.standard_normal((d, SKETCH))


@lru_cache(4)
def codes(d: int, words: int) -> np.ndarray:
    """(code, block, word, coordinate): the words of the product codes."""
    part = rotations(d)[2].shape[1] // BLOCKS
    found = np.random.default_rng([12, d, words]).standard_normal((CODES, BLOCKS, words, part))
    return found / np.linalg.norm(found, axis=3, keepdims=True) / math.sqrt(BLOCKS)


def decode(x: np.ndarray, words: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, direction) for every direction whose inner product with the unit
    row is ``least`` or more."""
    first, signs, second, _ = rotations(x.shape[1])
    turned, rows, directions = x @ first, [], []
    for c, blocks in enumerate(codes(x.shape[1], words)):
        inner = [y @ w.T for y, w in zip(np.split(turned * signs[c] @ second, BLOCKS, axis=1), blocks)]
        best = [y.max(axis=1) for y in inner]
        row, found, total = np.arange(len(x)), np.full(len(x), c), np.zeros(len(x))
        for b, y in enumerate(inner):
            part = total[:, None] + y[row]
            at, word = np.nonzero(part >= (least - sum(best[b + 1:], np.zeros(len(x))))[row][:, None])
            row, found, total = row[at], found[at] * words + word, part[at, word]
        rows.append(row)
        directions.append(found)
    row, found = np.concatenate(rows), np.concatenate(directions)
    order = np.argsort(row, kind="stable")
    return row[order], found[order]


def settings(d: int, vectors: int, percent: int) -> tuple[int, float]:
    """(words per block, threshold) for so many vectors: the caps' size follows
    from their number; words are added until the pairs of a fixed sample, each
    right at the threshold of similarity, share SHARED filters on average and
    one at least."""
    share, pairs = min(WIDEST, BUCKET / max(vectors, 1)), 1000
    least = NormalDist().inv_cdf(1 - share) / math.sqrt(rotations(d)[2].shape[1])
    rng, cosine = np.random.default_rng([13, d]), percent / 100
    x = units(rng.standard_normal((pairs, d)))
    y = rng.standard_normal((pairs, d))
    y = units(y - (x * y).sum(axis=1, keepdims=True) * x) if d > 1 else x
    y = units(cosine * x + math.sqrt(1 - cosine**2) * y)
    words = max(2, int((SHARED / share / CODES) ** (1 / BLOCKS)))
    while True:
        met = np.zeros(pairs, int)
        both = [row * words**BLOCKS * CODES + found for row, found in (decode(z, words, least) for z in (x, y))]
        np.add.at(met, np.intersect1d(*both) // (words**BLOCKS * CODES), 1)
        if met.mean() >= SHARED and met.min() >= 1:
            return words, least
        words = math.ceil(words * 1.1)


def most_bits(percent: int) -> int:
    """Bits in which the sketches of a pair at the threshold differ at most."""
    p = math.acos(percent / 100) / math.pi
    return math.ceil(SKETCH * p + DEVIATIONS * math.sqrt(SKETCH * p * (1 - p)))


def matrix(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, rows) of equally long vectors."""
    sizes, flat = np.asarray(lists.value_lengths()), np.asarray(lists.flatten())
    starts = np.cumsum(sizes) - sizes
    for d in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == d)
        yield at, flat[starts[at][:, None] + np.arange(d)]


def runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys of sorted batches."""
    held: list[pa.Table] = []
    at = None
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in key]
        if not batch.num_rows:
            continue
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        cuts = [0, *new.tolist(), batch.num_rows]
        table = pa.Table.from_batches([batch])
        for lo, hi in zip(cuts, cuts[1:]):
            mine = tuple(c[lo] for c in columns)
            if mine != at and held:
                yield pa.concat_tables(held)
                held = []
            at = mine
            held.append(table.slice(lo, hi - lo))
    if held:
        yield pa.concat_tables(held)


def decoded(classes: DataFrame, chosen: dict[int, tuple[int, float]]) -> DataFrame:
    """(node, filters, s0, ...): the filters of each vector and its sketch."""
    names = [f"s{i}" for i in range(SKETCH // 64)]

    def run(batches):
        for batch in batches:
            for at, x in matrix(batch.column("vector")):
                node, d = batch.column("node").to_numpy()[at], x.shape[1]
                words, least = chosen[d]
                for lo in range(0, len(x), 128):
                    y = units(x[lo:lo + 128])
                    row, found = decode(y, words, least)
                    signs = np.packbits(y @ rotations(d)[3] > 0, axis=1).view(np.int64)
                    ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(y))))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node[lo:lo + 128]),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(found * 2**16 + d)),   # no two lengths share a filter
                         *map(pa.array, signs.T)], ["node", "filters", *names])

    return classes.select("node", "vector").mapInArrow(
        run, "node long, filters array<long>, " + ", ".join(f"{n} long" for n in names))


def _sides(tile: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    strip, i, j = (tile.column(c).to_numpy() for c in ("strip", "i", "j"))
    return np.flatnonzero(strip == i), np.flatnonzero(strip == j)


def possible(tiles: DataFrame, most: int) -> DataFrame:
    """Members that may have a link in their tile, by the sketches."""
    names = [f"s{i}" for i in range(SKETCH // 64)]
    out = [*KEY, "strip", "node"]

    def run(batches):
        for tile in runs(batches, KEY):
            a, b = _sides(tile)
            # numpy counts the bits of a signed number's absolute value, hence unsigned
            bits = np.stack([tile.column(c).to_numpy().view(np.uint64) for c in names])
            near = np.zeros(tile.num_rows, bool)
            for lo in range(0, len(a), 256):
                part = a[lo:lo + 256]
                apart = sum(np.bitwise_count(s[part][:, None] ^ s[b][None, :]).astype(np.int16) for s in bits)
                close = (apart <= most) & (part[:, None] != b[None, :])
                near[part] |= close.any(axis=1)
                near[b] |= close.any(axis=0)
            if near.any():
                yield from tile.select(out).filter(pa.array(near)).combine_chunks().to_batches()

    return (tiles.repartition(*KEY).sortWithinPartitions(*KEY)
            .mapInArrow(run, "filter long, i long, j long, strip long, node long"))


def counted(a: np.ndarray, b: np.ndarray, linked: np.ndarray, filters: list[np.ndarray], this: int) -> np.ndarray:
    """``linked`` without the pairs that share a filter smaller than this one."""
    lower = [f[f < this] for f in filters]
    owner = np.repeat(np.arange(len(lower)), [len(f) for f in lower])
    flat = np.concatenate(lower) if lower else np.empty(0, np.int64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    place_a, place_b = np.full(len(filters), -1), np.full(len(filters), -1)
    place_a[a], place_b[b] = np.arange(len(a)), np.arange(len(b))
    cuts = np.concatenate(([0], np.flatnonzero(flat[1:] != flat[:-1]) + 1, [len(flat)]))
    for k in np.flatnonzero(np.diff(cuts) > 1).tolist():
        who = owner[cuts[k]:cuts[k + 1]]
        x, y = place_a[who], place_b[who]
        linked[np.ix_(x[x >= 0], y[y >= 0])] = False
    return linked


def joined(a: np.ndarray, b: np.ndarray, linked: np.ndarray, many: int) -> np.ndarray:
    """For each member the smallest place it hangs together with."""
    label = np.arange(many)
    while True:
        old = label.copy()
        left = np.where(linked, label[b][None, :], many).min(axis=1, initial=many)
        np.minimum.at(label, a, left)
        right = np.where(linked, label[a][:, None], many).min(axis=0, initial=many)
        np.minimum.at(label, b, right)
        label = label[label]
        if (label == old).all():
            return label


def links(members: DataFrame, cosine: float) -> DataFrame:
    """(node, links, root) per tile for the members (filter, i, j, strip, node,
    vector, filters, copies) that have a link which counts there."""
    def run(batches):
        for tile in runs(batches, KEY):
            a, b = _sides(tile)
            vectors = tile.column("vector").combine_chunks()
            ((_, x),) = matrix(vectors)      # a filter holds vectors of one length
            x = units(x)
            linked = (x[a] @ x[b].T >= cosine) & (a[:, None] != b[None, :])
            if linked.any():
                lists = tile.column("filters").combine_chunks()
                flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
                linked = counted(a, b, linked, np.split(flat, ends[1:-1]), tile.column("filter")[0].as_py())
            if not linked.any():
                continue
            node, copies = tile.column("node").to_numpy(), tile.column("copies").to_numpy()
            total = np.zeros(len(node), np.int64)
            np.add.at(total, a, (linked * copies[b][None, :]).sum(axis=1))
            if len(a) and not np.array_equal(a, b):
                np.add.at(total, b, (linked * copies[a][:, None]).sum(axis=0))
            at = np.flatnonzero(total)
            root = joined(a, b, linked, len(node))
            yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(total[at]), pa.array(node[root[at]])],
                                             ["node", "links", "root"])

    return members.repartition(*KEY).sortWithinPartitions(*KEY).mapInArrow(run, "node long, links long, root long")


def near_vectors(vectors: DataFrame, percent: int = 90, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept), one row per input row: two vectors are
    linked when their cosine is ``percent`` / 100 or more.

    ``n_links`` counts the other rows linked directly, equal vectors included;
    ``component_id`` is the smallest id reachable, the row's own included;
    ``kept`` says that it is the row's own.  A vector that is null, empty or
    zero, or that has a null or non-finite component, links with nothing; so
    does a row with a null id, whose component and ``kept`` are null.  Rows that
    repeat an id are vectors each.  Vectors of different lengths are never
    linked.  Extra columns are ignored; an empty table gives no rows.

    Of the pairs right at the threshold fewer than one in 10,000 share no filter,
    and the chance falls fast above it; no pair below it is ever linked."""
    raw = F.col(vector_col).cast("array<double>")
    usable: Column = (F.col("id").isNotNull() & F.exists("vector", lambda x: x != 0)
                      & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = materialize(vectors.select(F.col(id_col).alias("id"), raw.alias("vector"))
                       .withColumn("row", F.monotonically_increasing_id())
                       .withColumn("vector", F.when(usable, F.col("vector")))
                       .withColumn("a", F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(1), "vector")))
                       .withColumn("b", F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(2), "vector"))), "cf-rows")
    classes = materialize(rows.where("a IS NOT NULL").groupBy("a", "b")
                          .agg(F.min("row").alias("node"), F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")),
                          "cf-classes")
    one = materialize(classes.join(rows.select(F.col("row").alias("node"), "vector"), "node")
                      .select("node", "vector", "copies"), "cf-vectors")
    chosen = {r.d: settings(r.d, r.n, percent)
              for r in one.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    cover = materialize(decoded(one, chosen), "cf-filters")
    placed = cover.select(F.explode("filters").alias("filter"), "node", *[f"s{i}" for i in range(SKETCH // 64)])
    shared = materialize(placed.groupBy("filter").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                         .select("filter", F.ceil(F.col("n") / STRIP).alias("strips")), "cf-shared")
    tiles = (placed.join(shared, "filter").withColumn("strip", F.pmod(F.xxhash64("filter", "node"), "strips"))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("strips") - 1)))
             .withColumn("i", F.least("strip", "other")).withColumn("j", F.greatest("strip", "other")))
    open_ = materialize(possible(tiles.drop("strips", "other"), most_bits(percent)), "cf-possible")
    members = open_.join(one.join(cover.select("node", "filters"), "node"), "node")
    found = materialize(links(members, percent / 100), "cf-links")
    total = materialize(found.groupBy("node").agg(F.sum("links").alias("links")), "cf-totals")
    whole = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    reach = whole.join(classes.select(F.col("node").alias("id"), "rep"), "id")
    least = materialize(reach.groupBy("component").agg(F.min("rep").alias("least")), "cf-least")
    reach = whole.join(least, "component").select(F.col("id").alias("node"), "least")
    labels = materialize(classes.join(total, "node", "left").join(reach, "node", "left")
                         .select("a", "b", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                                 F.coalesce("least", "rep").alias("component")), "cf-labels")
    return (rows.select("id", "a", "b").join(labels, ["a", "b"], "left")
            .select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.coalesce("component", "id").alias("component_id"),
                    (F.coalesce("component", "id") == F.col("id")).alias("kept")))
