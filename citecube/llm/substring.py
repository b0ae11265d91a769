"""Substring dedup on a sampled De Bruijn graph.

Nodes are the token k-mers that a minimiser rule selects: of the k-mers in any
window of W words, the one of least hash (the leftmost of equals).  Equal
windows select the same k-mer at the same offset, and every window holds a
selected k-mer, so a window can repeat only if the k-mer it picks does.  Edges
join a document's consecutive nodes and carry the hash of the words from the
start of one to the end of the next.

A node whose occurrences all have the same in-edge and the same out-edge does
not branch.  Wherever one node of a run of nonbranching nodes occurs, the whole
run does.  No table of such paths is built: the flag of each node is joined back,
and a running count of flags in a document tells whether a branch lies inside a
window, which is all that is asked of a path.  So a window that lies inside a run
repeats exactly if the k-mer it picks does, and every document that holds it
sees that.  The other candidate windows (around branches and at the ends of runs) are
compared by 128-bit hashes of their words, with their source coordinates.
Counting nodes and joining what is known of them back are Spark aggregates and
joins; words are read in narrow steps only."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, gram_hashes, materialize, materialize_texts, mix64, pair_hash, settle, signed, text_bytes, word_hashes

NODE_WORDS = 12
# A row's id, in a struct so that joins find a null one too, and the hash of its text, so that rows repeating an id stay apart.
KEY = ["id", "h"]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """((id, h, text), schema of the key)."""
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.struct(F.col(id_col).alias("id")).alias("id"),
                        F.xxhash64(F.col(text_col)).alias("h"), text_bytes(text_col).alias("text")),
            f"id struct<id: {kind}>, h long")


def least_places(grams: np.ndarray, span: int) -> np.ndarray:
    """Place of the least gram of every ``span`` consecutive ones (leftmost of
    equals, judged by the upper half of the hash)."""
    low = np.uint64(0xFFFFFFFF)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    have = 1
    while have < span:
        step = min(have, span - have)
        key = np.minimum(key[:len(key) - step], key[step:])
        have += step
    return (key & low).astype(np.int64)


def select_nodes(grams: np.ndarray, span: int) -> np.ndarray:
    """The distinct places that ``least_places`` picks; they never step back."""
    place = least_places(grams, span)
    return place[np.concatenate(([True], place[1:] != place[:-1]))]


def run_hashes(starts: np.ndarray, ends: np.ndarray, grams: np.ndarray, k: int) -> np.ndarray:
    """Hash of the words from each start to each end, for runs that k-mers at
    most k apart cover: the k-mers at both ends, the one midway, and the length."""
    last = ends - k
    mid = (starts + last) // 2
    return pair_hash(pair_hash(grams[starts], grams[mid]), pair_hash(grams[last], (ends - starts).astype(np.uint64)))


def graph_rows(words: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, edges) of a document: per node the hash of its in-edge and its
    out-edge, where the ends of a document count as edges of their own."""
    if len(words) < window:
        none = np.empty(0, np.uint64)
        return none, none
    grams = gram_hashes(words, k)
    at = select_nodes(grams, window - k + 1)
    steps = np.zeros(len(at) + 1, np.uint64)
    steps[1:-1] = run_hashes(at[:-1], at[1:] + k, grams, k)
    return grams[at], pair_hash(steps[:-1], steps[1:])


def judge_windows(words: np.ndarray, flags: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(certain, open) start places of windows.  ``flags`` holds per node 0
    (occurs once), 1 (repeated) or 3 (repeated and nonbranching)."""
    grams = gram_hashes(words, k)
    least = least_places(grams, window - k + 1)                      # one per window
    at = least[np.concatenate(([True], least[1:] != least[:-1]))]
    starts = np.arange(len(words) - window + 1)
    first = np.searchsorted(at, starts)                              # first node inside the window
    last = np.searchsorted(at, starts + (window - k), "right") - 1   # last node inside
    branching = np.concatenate(([0], np.cumsum(flags != 3)))
    possible = flags[np.searchsorted(at, least)] > 0                 # another text may pick other nodes besides
    inner = (first > 0) & (last + 1 < len(at))
    sure = inner & (branching[last + 1] == branching[first])
    return starts[possible & sure], starts[possible & ~sure]


def covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Mask of the words that windows at ``starts`` cover."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    return np.cumsum(steps[:n]) > 0


def _first_pass(docs: DataFrame, window: int, k: int, kind: str) -> DataFrame:
    """(id, h, n, whole, nodes, edges): word count, key of the word sequence
    (null below ``window`` words), and the graph of each document."""
    def run(batches):
        for batch in batches:
            for part in blocks(batch, "text", 1 << 20):
                words = [word_hashes(t) for t in part.column("text").to_pylist()]
                graphs = [graph_rows(w, window, k) for w in words]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("h"), pa.array(map(len, words), pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(w.tobytes()) if len(w) >= window else None for w in words],
                              pa.binary()),
                     pa.array([signed(g[0]) for g in graphs], pa.list_(pa.int64())),
                     pa.array([signed(g[1]) for g in graphs], pa.list_(pa.int64()))],
                    [*KEY, "n", "whole", "nodes", "edges"])

    return docs.mapInArrow(run, f"{kind}, n long, whole binary, nodes array<long>, edges array<long>")


def _second_pass(flagged: DataFrame, window: int, k: int, kind: str) -> DataFrame:
    """From (id, text, weight, flags): the certain windows and the open ones
    with their hashes."""
    def run(batches):
        for batch in batches:
            for part in blocks(batch, "text", 1 << 20):
                sure, open_, x, y = [], [], [], []
                for text, flags in zip(part.column("text").to_pylist(), part.column("flags").to_pylist()):
                    words = word_hashes(text)
                    at = select_nodes(gram_hashes(words, k), window - k + 1)
                    level = np.zeros(len(at), np.int8)
                    for f in flags:
                        level[f["i"]] = 3 if f["straight"] else 1
                    a, b = judge_windows(words, level, window, k)
                    sure.append(a.astype(np.int32))
                    open_.append(b.astype(np.int32))
                    x.append(signed(gram_hashes(words, window)[b]))
                    y.append(signed(gram_hashes(mix64(words ^ np.uint64(0x5851F42D4C957F2D)), window)[b]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("h"), part.column("weight"), pa.array(sure, pa.list_(pa.int32())),
                     pa.array(open_, pa.list_(pa.int32())), pa.array(x, pa.list_(pa.int64())),
                     pa.array(y, pa.list_(pa.int64()))],
                    [*KEY, "weight", "sure", "open", "x", "y"])

    return flagged.mapInArrow(run, f"{kind}, weight long, sure array<int>, open array<int>, "
                                   "x array<long>, y array<long>")


def repeated_windows(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text",
                     node_words: int = NODE_WORDS) -> tuple[DataFrame, DataFrame]:
    """((id, h, starts array<int>), (id, h)): the start places of every window of
    ``window`` words whose word sequence starts anywhere else as well, and the
    keys of documents that are repeated whole (all their windows are)."""
    k = min(window, max(node_words, -(-(window + 1) // 3)))   # two k-mers and one midway cover an edge
    texts, kind = _texts(docs, id_col, text_col)
    base = materialize_texts(_first_pass(texts, window, k, kind), "sub-graph")
    # Whole documents that repeat: one row stands for all, with weight 2.
    key = F.struct(*KEY)
    wholes = materialize(base.where("whole IS NOT NULL").groupBy("whole")
                         .agg(F.min(key).alias("rep"), F.count(F.lit(1)).alias("c")).where("c > 1"), "sub-wholes")
    copies = materialize(base.select(*KEY, "whole").join(wholes, "whole")
                         .select(*KEY, key.eqNullSafe(F.col("rep")).alias("rep")).distinct(), "sub-copies")
    # Nodes: repeated or not, branching or not.
    repeated = materialize(base.select(F.explode(F.arrays_zip("nodes", "edges")).alias("e"))
                           .groupBy(F.col("e.nodes").alias("node"))
                           .agg(F.count(F.lit(1)).alias("c"), F.min("e.edges").alias("x"), F.max("e.edges").alias("y"))
                           .where("c > 1").select("node", (F.col("x") == F.col("y")).alias("straight")), "sub-nodes")
    hits = materialize(base.select(*KEY, F.posexplode("nodes").alias("i", "node")).join(repeated, "node")
                       .select(*KEY, "i", "straight"), "sub-hits")
    flags = (hits.join(copies.where("NOT rep").select(*KEY), KEY, "left_anti")
             .groupBy(*KEY).agg(F.collect_list(F.struct("i", "straight")).alias("flags")))
    reps = copies.where("rep").select(*KEY, F.lit(2).cast("long").alias("weight"))
    flags = materialize(flags.join(reps, KEY, "left")
                        .select(*KEY, F.coalesce("weight", F.lit(1).cast("long")).alias("weight"), "flags"), "sub-flags")
    judged = materialize_texts(_second_pass(texts.join(flags, KEY).select(*KEY, "text", "weight", "flags"), window, k, kind),
                               "sub-judged")
    # Open windows are compared by the hashes of all their words.
    opened = (judged.select(*KEY, "weight", F.explode(F.arrays_zip("open", "x", "y")).alias("w"))
              .select(*KEY, "weight", "w.*"))
    again = materialize(opened.groupBy("x", "y").agg(F.sum("weight").alias("c")).where("c > 1").select("x", "y"), "sub-again")
    found = materialize(opened.join(again, ["x", "y"], "left_semi").select(*KEY, "open"), "sub-open")
    late = found.groupBy(*KEY).agg(F.collect_list("open").alias("late"))
    starts = (judged.select(*KEY, "sure").join(late, KEY, "left")
              .select(*KEY, F.concat("sure", F.coalesce("late", F.array().cast("array<int>"))).alias("starts"))
              .where(F.size("starts") > 0))
    return materialize(starts, "sub-starts"), copies.select(*KEY)


def _gone(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(id, h, starts, whole): what each document that loses words loses."""
    def lost() -> DataFrame:
        starts, copies = repeated_windows(docs, window, id_col, text_col)
        return (starts.join(copies, KEY, "left_anti").select(*KEY, "starts", F.lit(False).alias("whole"))
                .union(copies.select(*KEY, F.array().cast("array<int>"), F.lit(True))))

    return settle(docs, lost, "sub-gone")


def _remaining(text: bytes, at: list[int] | None, whole: bool | None, window: int) -> tuple[int, list[bytes]]:
    """(number of words, words that stay)."""
    words = text.split()
    if whole:
        return len(words), []
    if at is None or not len(at):
        return len(words), words
    mask = covered(len(words), np.array(at, np.int64), window).tolist()
    return len(words), [w for w, m in zip(words, mask) if not m]


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id, n_words, n_removed, kept_sha256).

    Words are separated by ASCII white space and compared unchanged.  Every
    word is removed that lies in a window of ``window`` words whose sequence
    also starts elsewhere, in the same document or another; windows are judged
    on the input.  The kept words are joined by one space.  Null, empty and
    shorter texts lose nothing.  Rows that repeat an id are documents of their
    own; if they repeat the text too, they are whole copies; so are rows with a
    null id.  An empty table gives no rows; extra columns of any name are ignored."""
    texts, kind = _texts(docs, id_col, text_col)
    gone = _gone(docs, window, id_col, text_col)

    def run(batches):
        for batch in batches:
            for part in blocks(batch, "text", 1 << 20):
                n, removed, sha = [], [], []
                for row in zip(*(part.column(c).to_pylist() for c in ("text", "starts", "whole"))):
                    many, words = _remaining(*row, window)
                    n.append(many)
                    removed.append(many - len(words))
                    sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())],
                    ["id", "n_words", "n_removed", "kept_sha256"])

    return (texts.join(gone, KEY, "left").select("id", "text", "starts", "whole")
            .mapInArrow(run, f"{kind.split(', h')[0]}, n_words long, n_removed long, kept_sha256 string")
            .select("id.id", "n_words", "n_removed", "kept_sha256"))


def cut_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text",
                size_col: str = "n_chars") -> DataFrame:
    """``docs`` with the repeated words cut out of its texts, all columns kept.
    Texts that lose nothing are left as they are; of the others the kept words
    are joined by one space, ``size_col`` (where there is one) follows, and
    rows of which no word is left are dropped.  Rows with a null id are evidence
    for the others, but stay as they are: no stage before has made them unique."""
    gone = _gone(docs, window, id_col, text_col)
    lost = gone.where("id.id IS NOT NULL").select(F.col("id.id").alias("_id"), F.col("h").alias("_h"), "starts", "whole")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_id0"),
                       F.xxhash64(F.col(text_col)).alias("_h0"))
    joined = rows.join(lost, (F.col("_id0") == F.col("_id")) & (F.col("_h0") == F.col("_h")), "left")

    @F.pandas_udf("string")
    def rest(text: pd.Series, starts: pd.Series, whole: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else b" ".join(_remaining(t.encode(), a, w, window)[1]).decode()
                          for t, a, w in zip(text, starts, whole)], dtype=object)

    # Else the filter below gets a call of its own: each task then holds two Python workers, and all of
    # them live on and take their share of memory in the steps that follow.
    rest = rest.asNondeterministic()
    hit = F.col("_id").isNotNull()
    cut = joined.withColumn("_cut", rest(F.when(hit, F.col(f"_row.{text_col}")), "starts", "whole"))
    changed = {text_col: F.when(hit, F.col("_cut")).otherwise(F.col(f"_row.{text_col}"))}
    if size_col in docs.columns:
        size = F.length("_cut").cast(docs.schema[size_col].dataType)
        changed[size_col] = F.when(hit, size).otherwise(F.col(f"_row.{size_col}"))
    return cut.where(~hit | (F.col("_cut") != "")).select(
        *[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
