"""Prefix trie of conversations by van Emde Boas recursion.

A sequence is cut at half depth; equal upper halves get one name; the upper
trie and the forests that hang below the named cuts are then cut in the same
way, all of them in one round.  A round knows a piece by the hash of its 2^k
items, made bottom-up from pairs of neighbouring pieces, and by the name of the
prefix that it hangs from.  A prefix's name is its smallest member.  So the
rounds are as many as the logarithm of the longest sequence, and each handles
at most 1/2^k of all items.

Only prefixes with at least two members go through the rounds: below a prefix
with a single member there is one path, whose nodes are known as they are.

Totals are grafted upward in the opposite order: forests of 2^k levels know
their sums, and the sums of the trees that hang from a cut are added to the
cut's ancestors in the trie above it, which doubles the levels.

No sequence, node or group is ever gathered in a row or a task: items are rows
throughout, joins meet written tables, sums are aggregated before they move."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import dense_ids
from .common import SPACE, materialize

WORD = SPACE.replace("[", "[^", 1)[:-1] + "+"


def _hashes(*cols: str | Column) -> list[Column]:
    """128 bits as two longs."""
    return [F.xxhash64(F.lit(seed), *cols).alias(name) for seed, name in ((1, "a"), (2, "b"))]


def order_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """(conv, pos, n, a, b, words): every turn with its position from 1, its
    conversation's number of turns, the hash of (role, text) and the number of
    words of its text.

    Turns are ordered by ``turn_col``, null first; equal turns by their hash,
    and rows that repeat a turn word for word all count.  A null role or text is
    empty; rows with a null conversation take no part."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(conversations.where(F.col(id_col).isNotNull())
                       .select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                               *_hashes(role, text), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")), "pt-turns")
    placed = dense_ids(rows, ["conv", "turn", "a", "b"], "place")
    sizes = materialize(placed.groupBy("conv").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")), "pt-sizes")
    return (placed.join(sizes, "conv")
            .select("conv", (F.col("place") - F.col("first") + 1).alias("pos"), "n", "a", "b", "words"))


def rebuild(turns: DataFrame, share: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): every conversation c becomes the first h turns of
    conversation c - c % share (all if fewer, none if absent) and then its own
    turns after its first h; h = crc32(decimal c) % most.

    ``turns`` is (conv, depth, last, a, b, words) with depth from 1;
    ``conversations`` is (conv, length), with length 0 if nothing is left."""
    turns = materialize(turns, "pt-placed")
    sizes = turns.where("pos = 1").select("conv", "n")
    donors = sizes.select(F.col("conv").alias("donor"), F.col("n").alias("has"))
    convs = (sizes.withColumn("h", F.crc32(F.col("conv").cast("string")) % most)
             .withColumn("donor", F.col("conv") - F.col("conv") % share).join(donors, "donor", "left")
             .withColumn("taken", F.least("h", F.coalesce("has", F.lit(0))))
             .withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    convs = materialize(convs.select("conv", "donor", "h", "taken", "length"), "pt-convs")
    heads = turns.where(F.col("pos") < most).select(F.col("conv").alias("donor"), F.col("pos").alias("depth"), "a", "b", "words")
    lent = convs.where("taken > 0").join(heads, "donor").where("depth <= taken")
    own = (turns.join(convs, "conv").where("pos > h").withColumn("depth", F.col("taken") + F.col("pos") - F.col("h")))
    columns = ["conv", "depth", (F.col("depth") == F.col("length")).alias("last"), "a", "b", "words"]
    return materialize(lent.select(*columns).union(own.select(*columns)), "pt-rebuilt"), convs.select("conv", "length")


def _pieces(turns: DataFrame, levels: int) -> list[DataFrame]:
    """For each k the hashes of all whole pieces of 2^k items: (conv, block, a, b)."""
    found = [turns.select("conv", (F.col("depth") - 1).alias("block"), "a", "b")]
    for _ in range(levels):
        half = F.col("block") % 2
        sides = [F.max(F.when(half == side, F.col(c))).alias(f"{c}{side}") for side in (0, 1) for c in "ab"]
        found.append(materialize(found[-1].groupBy("conv", F.floor(F.col("block") / 2).alias("block")).agg(*sides)
                                 .where("a1 IS NOT NULL").select("conv", "block", *_hashes("a0", "b0", "a1", "b1")), "pt-pieces"))
    return found


def shared_prefixes(turns: DataFrame, longest: int) -> DataFrame:
    """(conv, depth, name, members) for every prefix with two members or more:
    one row per member; the name is the smallest member."""
    levels = max(longest - 1, 0).bit_length()
    pieces = _pieces(turns, levels)
    shared = None
    for k in range(levels, -1, -1):      # cuts at odd multiples of 2^k, of all tries at once
        cut = (pieces[k].where("block % 2 = 0")
               .select("conv", "a", "b", ((F.col("block") + 1) * 2**k).alias("depth"), (F.col("block") * 2**k).alias("above")))
        rooted = cut.where("above = 0").withColumn("root", F.lit(0).cast("long"))
        if shared is not None:
            up = shared.select("conv", F.col("depth").alias("above"), F.col("name").alias("root"))
            rooted = rooted.unionByName(cut.where("above > 0").join(up, ["conv", "above"]))
        same = ["depth", "root", "a", "b"]
        groups = materialize(rooted.groupBy(*same).agg(F.min("conv").alias("name"), F.count(F.lit(1)).alias("members"))
                             .where("members > 1"), "pt-groups")
        named = materialize(rooted.join(groups, same).select("conv", "depth", "name", "members"), "pt-named")
        shared = named if shared is None else shared.union(named)
    return shared


def _graft(tree: DataFrame, paths: DataFrame) -> DataFrame:
    """``tree`` (name, depth, parent, ..., leaves, saved) with both sums taken
    over whole subtrees; ``paths`` (conv, depth, name) has the ancestors."""
    deepest = tree.agg(F.max("depth")).first()[0] or 0
    size = 1
    while size < deepest:
        hung = (tree.where((F.col("depth") - 1) % (2 * size) == size)
                .groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("cut"))
                .agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")))
        above = paths.withColumn("cut", (F.floor((F.col("depth") - 1) / size) + 1) * size)
        more = above.join(hung, ["conv", "cut"]).groupBy("name", "depth").agg(F.sum("l").alias("l"), F.sum("s").alias("s"))
        tree = materialize(tree.join(more, ["name", "depth"], "left")
                           .withColumn("leaves", F.col("leaves") + F.coalesce("l", F.lit(0)))
                           .withColumn("saved", F.col("saved") + F.coalesce("s", F.lit(0))).drop("l", "s"), "pt-grafted")
        size *= 2
    return tree


def trie(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie of all prefixes: (nodes, ends).

    ``turns`` is (conv, depth, last, a, b, words): the items of each sequence
    with depth from 1, the mark of its last one, the item's 128-bit hash and its
    weight; ``convs`` is (conv, length), empty sequences included, ids unique.

    ``nodes``: conv_id (smallest member), depth, parent_conv_id (null for the
    root), n_convs, n_children, n_leaves (childless nodes of the subtree),
    saved_tokens (over the subtree, (n_convs - 1) * weight of the last item).
    ``ends``: (conv_id, depth, member), where each sequence ends.  Without
    sequences both are empty: a root needs a member."""
    first, total, longest = convs.agg(F.min("conv"), F.count(F.lit(1)), F.max("length")).first()
    shared = shared_prefixes(turns, longest or 0)
    up = shared.select("conv", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"), F.col("members").alias("above"))
    rows = turns.join(shared, ["conv", "depth"], "left").join(up, ["conv", "depth"], "left")
    nodes = materialize(
        rows.where(F.coalesce("name", "conv") == F.col("conv"))
        .select(F.col("conv").alias("name"), "depth", "last", "words", F.coalesce("members", F.lit(1)).alias("members"),
                F.when(F.col("depth") == 1, F.lit(first)).otherwise(F.coalesce("parent", "conv")).alias("parent"),
                ((F.col("depth") == 1) | F.col("above").isNotNull()).alias("under_shared")), "pt-nodes")
    kids = materialize(nodes.where("under_shared").groupBy(F.col("parent").alias("name"), (F.col("depth") - 1).alias("depth"))
                       .agg(F.count(F.lit(1)).alias("n_children"), F.sum((F.col("members") == 1).cast("long")).alias("single")),
                       "pt-kids")
    none = F.lit(0).cast("long")
    tree = materialize(nodes.where("members > 1").join(kids, ["name", "depth"], "left")
                       .select("name", "depth", "parent", "members", F.coalesce("n_children", none).alias("n_children"),
                               F.coalesce("single", F.lit(1).cast("long")).alias("leaves"),
                               ((F.col("members") - 1) * F.col("words")).alias("saved")), "pt-tree")
    heads = tree.select(F.col("name").alias("conv")).distinct()
    tree = _graft(tree, materialize(shared.join(heads, "conv", "left_semi").select("conv", "depth", "name"), "pt-paths"))

    spark = turns.sparkSession
    children, single = kids.where("depth = 0").select("n_children", "single").first() or (0, 1)
    leaves, saved = tree.where("depth = 1").agg(F.coalesce(F.sum("leaves"), none), F.coalesce(F.sum("saved"), none)).first()
    columns = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
               "saved_tokens long")
    root = spark.createDataFrame([(first, 0, None, total, children, leaves + single, saved)] if total else [], columns)
    alone = (nodes.where("members = 1")
             .select("name", "depth", "parent", F.lit(1).cast("long"), (~F.col("last")).cast("long"), F.lit(1).cast("long"), none))
    found = alone.union(tree.select("name", "depth", "parent", "members", "n_children", "leaves", "saved")).union(root)
    last = turns.where("last").join(shared, ["conv", "depth"], "left")
    ends = (last.select(F.coalesce("name", "conv").alias("conv_id"), "depth", F.col("conv").alias("member"))
            .union(convs.where("length = 0").select(F.lit(first).alias("conv_id"), none, "conv")))
    return found.toDF(*[c.split()[0] for c in columns.split(", ")]), ends


def end_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256): SHA-256 of the decimal ids, ascending and
    comma-joined, of the members that end at a node.

    Sorted ranges first join what they hold of a node into texts; a node's texts
    then pass one after the other through its digest, so that no list is ever
    held whole."""
    key = ["depth", "conv_id"]

    def join(batches):
        for batch in batches:
            depth, node, member = (batch.column(c).to_numpy() for c in (*key, "member"))
            if not len(depth):
                continue
            cuts = np.flatnonzero((depth[1:] != depth[:-1]) | (node[1:] != node[:-1])) + 1
            lo, hi = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(depth)]))
            ids = list(map(str, member.tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(depth[lo]), pa.array(node[lo]), pa.array(member[lo]),
                 pa.array([",".join(ids[x:y]) for x, y in zip(lo.tolist(), hi.tolist())], pa.string())],
                [*key, "start", "ids"])

    def digest(batches):
        at = state = None
        for batch in batches:
            done = []
            for depth, node, ids in zip(*(batch.column(c).to_pylist() for c in (*key, "ids"))):
                if (depth, node) == at:
                    state.update(b"," + ids.encode())
                    continue
                if at:
                    done.append((*at, state.hexdigest()))
                at, state = (depth, node), hashlib.sha256(ids.encode())
            yield table(done)
        yield table([(*at, state.hexdigest())] if at else [])

    def table(rows):
        columns = list(zip(*rows)) if rows else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int64(), pa.string()))],
                                          [*key, "ends_sha256"])

    texts = (ends.repartitionByRange(*key, "member").sortWithinPartitions(*key, "member")
             .mapInArrow(join, "depth long, conv_id long, start long, ids string"))
    return (texts.repartition(*key).sortWithinPartitions(*key, "start")
            .mapInArrow(digest, "depth long, conv_id long, ends_sha256 string"))
