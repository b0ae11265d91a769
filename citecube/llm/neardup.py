"""MinHash near-dedup with fast similarity sketching.

A document's shingle set is sketched in rounds of hashed bin placement: in
round i every element throws the value i + fraction into one hashed bin and
each bin keeps its minimum; rounds from ``t`` on visit bin i - t, so after 2t
rounds at most every bin of a non-empty set is filled.  The coordinates are
banded, and documents that share a band are verified on their full sets.

A shared bucket is not expanded into pairs.  First all its members are compared
with two leaders, drawn by a hash for each bucket, so that a large group of
copies meets many different leaders, and what links is united.
Members that end outside their bucket's leading component, the stragglers, are
then met with the bucket's other components.  Both joins drop pairs whose sizes
rule a link out or whose sketches differ by five standard deviations more than
a link's would; for the stragglers' join the few documents concerned get a
second, sharper sketch.  So every pair of a bucket is in one component, or
compared, or as good as certainly no link."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .common import blocks, gram_hashes, materialize, materialize_texts, mix64, pair_hash, settle, shingle_set, signed, text_bytes  # noqa: F401
from .graph import components

COORDINATES = 256   # bins of a sketch
MISS = 1e-5         # chance at most that a pair right at the threshold shares no band
BITS = 2            # of each coordinate, kept for comparing sketches in joins
LONGS = COORDINATES * BITS // 64
SHARP = 4096        # coordinates of the second sketch, of which one bit each is kept
DEVIATIONS = 5.0    # beyond them a pair at the threshold is missed with a chance under 1e-6
EMPTY = np.uint64(2**64 - 1)


def band_rows(percent: int) -> int:
    """Most coordinates a band may have for ``MISS``: 7 at 85 percent, 6 at 80."""
    fits = [r for r in range(1, 17) if (1 - (percent / 100) ** r) ** (COORDINATES // r) <= MISS]
    return max(fits, default=1)


def most_bits(percent: int, coordinates: int = COORDINATES, bits: int = BITS) -> int:
    """Bits in which the sketches of a pair at the threshold differ at most."""
    j = percent / 100
    apart = coordinates * (1 - j)
    spread = apart * bits / 4 + (bits / 2) ** 2 * coordinates * j * (1 - j)
    return math.ceil(apart * bits / 2 + DEVIATIONS * math.sqrt(spread))


def sketches(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """One row of ``t`` values (a power of two) per non-empty set: the round
    above a fraction."""
    places = t.bit_length() - 1
    bin_shift, round_shift = np.uint64(64 - places), np.uint64(62 - places)
    fraction = np.uint64((1 << (62 - places)) - 1)
    out = np.full(len(sets) * t, EMPTY)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets), dtype=np.int64), [len(s) for s in sets])
    look = 0
    for i in range(2 * t):
        drawn = mix64(values + np.uint64((i + 1) * 0x9E3779B97F4A7C15 % 2**64))
        place = (drawn >> bin_shift).astype(np.int64) if i < t else np.int64(i - t)
        place = owner * t + place
        free = out[place] == EMPTY    # a bin of an earlier round keeps its smaller value
        np.minimum.at(out, place[free], (np.uint64(i) << round_shift) | (drawn[free] & fraction))
        if i < look:                  # further rounds never change a filled bin, so not every one need look
            continue
        look = i + 1 + i // 8
        filled = (out.reshape(-1, t) != EMPTY).all(axis=1)
        if filled.any():
            left = ~filled[owner]
            values, owner = values[left], owner[left]
            if not len(values):
                break
    return out.reshape(-1, t)


def bands(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One hash per document and band; the band's number is part of the hash."""
    many = COORDINATES // rows
    part = sketch[:, :many * rows].reshape(len(sketch), many, rows)
    h = np.broadcast_to(mix64(np.arange(1, many + 1, dtype=np.uint64)), part.shape[:2])
    for r in range(rows):
        h = pair_hash(h, part[:, :, r])
    return h


def low_bits(sketch: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The last bits of each coordinate, packed into longs."""
    each = ((sketch[:, :, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(each.reshape(len(sketch), sketch.shape[1] * bits), axis=1).view(np.int64)


def sketch_documents(docs: DataFrame, words: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, key, bands, bits): set size, 128-bit key of the set, band hashes,
    low bits of the sketch.  Sets without shingles have nulls."""
    def run(batches):
        for batch in batches:
            for part in blocks(batch, "text"):
                sets = [shingle_set(t.lower(), words) for t in part.column("text").to_pylist()]
                some = [s for s in sets if len(s)]
                sketch = sketches(some) if some else np.empty((0, COORDINATES), np.uint64)
                hashes, low = iter(signed(bands(sketch, rows))), iter(low_bits(sketch))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(map(len, sets), pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                     pa.array([next(hashes) if len(s) else None for s in sets], pa.list_(pa.int64())),
                     pa.array([next(low) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                    ["id", "n", "key", "bands", "bits"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, n long, key binary, bands array<long>, bits array<long>"))


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(id, shingles binary) of the given (id, text) rows."""
    def run(batches):
        for batch in batches:
            for part in blocks(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"),
                     pa.array([shingle_set(t.lower(), words).tobytes() for t in part.column("text").to_pylist()], pa.binary())],
                    ["id", "shingles"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, shingles binary")


def sharp_sketches(sets: DataFrame) -> DataFrame:
    """(id, s0, s1, ...): one bit per coordinate of a sketch of SHARP
    coordinates, for the (id, shingles) rows."""
    names = [f"s{i}" for i in range(SHARP // 64)]

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                found = sketches([np.frombuffer(x, np.uint64) for x in part.column("shingles").to_pylist()], SHARP)
                columns = low_bits(found, 1).T
                yield pa.RecordBatch.from_arrays([part.column("id"), *[pa.array(c, pa.int64()) for c in columns]],
                                                 ["id", *names])

    kind = sets.schema["id"].dataType.simpleString()
    # little data, much work: as many tasks as a shuffle has
    return (sets.repartition(shuffle_partitions(sets.sparkSession), "id")
            .mapInArrow(run, f"id {kind}, " + ", ".join(f"{n} long" for n in names)))


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets satisfy 100 * |A and B| >= percent * |A or B|."""
    def run(batches):
        for batch in batches:
            keep = []
            for part in blocks(batch, "sa", 1 << 20):
                for x, y in zip(part.column("sa").to_pylist(), part.column("sb").to_pylist()):
                    p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, f"a {kind}, b {kind}")


def _possible(percent: int, left: str, right: str, longs: list[str], most: int) -> Column:
    """Sizes and sketches allow a link between the rows aliased so."""
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    apart = sum((F.bit_count(F.col(f"{left}.{c}").bitwiseXOR(F.col(f"{right}.{c}"))) for c in longs), F.lit(0))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (apart <= most)


def _pairs(joined: DataFrame) -> DataFrame:
    x, y = F.col("x.id"), F.col("y.id")
    return materialize(joined.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct(), "nd-pairs")


def _links(members: DataFrame, sets: DataFrame, bands_of: DataFrame, percent: int) -> DataFrame:
    """(id, component) of what is linked among the members (bucket, id, n, b0...);
    ``bands_of`` has all buckets of each id."""
    coarse, fine = [f"b{i}" for i in range(LONGS)], [f"s{i}" for i in range(SHARP // 64)]
    row = F.struct(F.xxhash64("bucket", "id").alias("draw"), "id", "n", *coarse)
    leaders = materialize(members.groupBy("bucket").agg(F.min(row).alias("lo"), F.max(row).alias("hi"))
                          .select("bucket", F.explode(F.array("lo", "hi")).alias("l")).select("bucket", "l.*").drop("draw"),
                          "nd-leaders")
    star = _pairs(members.alias("x").join(leaders.alias("y"), (F.col("x.bucket") == F.col("y.bucket"))
                                          & (F.col("x.id") != F.col("y.id"))
                                          & _possible(percent, "x", "y", coarse, most_bits(percent))))
    links = materialize_texts(verify(star, sets, percent), "nd-links")
    found = components(links).select("id", F.col("component").alias("_c"))
    # Sizes of linked documents lie in one or in neighbouring classes.
    size = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)).cast("int") if percent < 100 else F.lit(0)
    rows = materialize(members.select("bucket", "id", "n").join(found, "id", "left")
                       .withColumn("comp", F.coalesce("_c", "id")).withColumn("size", size).drop("_c"), "nd-active")
    heads = materialize(leaders.join(found, "id", "left").groupBy("bucket")
                        .agg(F.min(F.coalesce("_c", "id")).alias("head")), "nd-heads")
    apart = rows.join(heads, "bucket").where("comp != head").drop("head")
    unsettled = materialize(apart.select("bucket").distinct(), "nd-unsettled")
    rows = materialize(rows.join(unsettled, "bucket", "left_semi").join(heads, "bucket"), "nd-open")
    sharp = materialize(sharp_sketches(sets.join(rows.select("id").distinct(), "id", "left_semi")), "nd-sharp")
    rows = materialize(rows.join(sharp, "id").join(bands_of, "id"), "nd-open")
    # A pair that shares several buckets counts in the least of them only.
    once = F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.bucket")
    near = (rows.where("comp != head")
            .withColumn("size", F.explode(F.array(*[F.col("size") + d for d in (-1, 0, 1)]))))
    late = _pairs(near.alias("x").join(rows.alias("y"), (F.col("x.bucket") == F.col("y.bucket"))
                                       & (F.col("x.size") == F.col("y.size")) & (F.col("x.comp") != F.col("y.comp"))
                                       & _possible(percent, "x", "y", fine, most_bits(percent, SHARP, 1)) & once))
    late = materialize(late.join(star, ["a", "b"], "left_anti"), "nd-late")
    return components(links.union(verify(late, sets, percent)))


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per input row: (id, n_shingles, component_id, kept).

    Texts are lower-cased (A-Z only: ``bytes.lower``); words end at ASCII white
    space.  Documents are linked when their sets of ``words``-word shingles reach a
    Jaccard similarity of ``percent`` / 100; the component is the smallest id
    reachable.  With fewer words the whole sequence is the one shingle; a null,
    empty or blank text has no shingles and links with nothing.  Rows that
    repeat an id are judged each by their own text.  An empty table gives no
    rows; extra columns of any name are ignored."""
    rows = band_rows(percent)
    sk = materialize_texts(sketch_documents(docs, words, rows, id_col, text_col), "nd-sketch")
    classes = materialize(sk.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("rep")), "nd-classes")
    reps = materialize(sk.join(classes, (sk["key"] == classes["key"]) & (F.col("id") == F.col("rep")))
                       .select("id", "n", "bands", *[F.col("bits")[i].alias(f"b{i}") for i in range(LONGS)]), "nd-reps")
    buckets = reps.select("id", F.explode("bands").alias("bucket"))
    shared = materialize(buckets.groupBy("bucket").agg(F.min("id").alias("x"), F.max("id").alias("y"))
                         .where("x < y").select("bucket"), "nd-shared")
    members = materialize(buckets.join(shared, "bucket", "left_semi").join(reps.drop("bands"), "id"), "nd-members")
    needed = materialize(members.select("id").distinct(), "nd-needed")
    sets = materialize_texts(shingle_sets(docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
                                          .join(needed, "id", "left_semi"), words), "nd-sets")
    found = _links(members, sets, reps.select("id", "bands"), percent)
    labels = materialize(classes.join(found, classes["rep"] == found["id"], "left")
                         .select("key", F.coalesce("component", "rep").alias("component")), "nd-labels")
    return (sk.select("id", "n", "key").join(labels, "key", "left")
            .select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"),
                    (F.coalesce("component", "id") == F.col("id")).alias("kept")))


def drop_near(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component one row, with its
    smallest id.  Each row is judged by its own text; rows with a null id all
    stay."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = materialize(docs.select(whole.alias("doc")).withColumn("row", F.monotonically_increasing_id()), "nd-rows")
    keyed = rows.select("row", F.col(f"doc.`{id_col}`").alias("id"), F.col(f"doc.`{text_col}`").alias("text"))

    def dropped_rows() -> DataFrame:
        found = materialize(near_groups(keyed, words, percent, "row", "text").select(F.col("id").alias("row"), "component_id")
                            .join(keyed.select("row", "id", F.xxhash64("text").alias("h")), "row"), "nd-found")
        first = materialize(found.where("id IS NOT NULL").groupBy("component_id")
                            .agg(F.min(F.struct("id", "h", "row"))["row"].alias("first"), F.count(F.lit(1)).alias("c"))
                            .where("c > 1").select("component_id", "first"), "nd-first")
        return found.where("id IS NOT NULL").join(first, "component_id").where("row != first").select("row")

    dropped = settle(docs, dropped_rows, "nd-dropped")
    return rows.join(dropped, "row", "left_anti").select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
