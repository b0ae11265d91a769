"""Record chunks of XML files: splittable reading, whole records, places.

A file is cut at the text that opens a record's key attribute.  That text can
also stand where it opens nothing: in a title, a CDATA section, a comment (which
may hide whole records), or in the start tag of an element that is no record.
``whole_records`` joins such pieces to the record that they belong to.

Which mode (plain, comment, CDATA, instruction) a chunk starts in depends on all
chunks before it, so it is found as a prefix over places: chunks without a
delimiter keep the mode; the few others are maps from mode to mode, composed
within a split, then over a file's splits (one row each).  Only narrow rows
(place, mode, open tag) are shuffled; the texts of the chunks that need no
stitching stay where they are."""

from __future__ import annotations

from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import join_side, materialize

PLACE = ["src", "block", "place"]
# The modes: plain, and inside each of these, with the text that ends it.
OPENERS = ["", "<!--", "<![CDATA[", "<?"]
CLOSERS = ["", "-->", "]]>", "?>"]
# One sign that all begin with: other places are passed over without trying each alternative.
_COMPLETE = r"(?s)<(?:!--.*?-->|!\[CDATA\[.*?\]\]>|\?.*?\?>|[/A-Za-z][^<>]*+>)"
_COMMENTS = r"(?s)(?=<)(?:(<!\[CDATA\[.*?\]\]>)|<!--.*?(?:-->|\z))"


def read_chunks(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(file, src, block, place, chunk, marked, tag): the pieces of all files under
    ``path`` between the separators, with the split that they start in and their
    order in it; whether they hold a delimiter of a comment or the like, and the
    element whose start tag they end in.  Written once: the places stay, and the
    dump is read a single time."""
    raw = spark.read.option("lineSep", sep).text(path)
    return place_chunks(raw.select(F.col("_metadata.file_path").alias("file"),
                                   F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("chunk")))


def place_chunks(raw: DataFrame) -> DataFrame:
    """The same for (file, block, chunk) rows as a text scan delivers them."""
    return materialize(raw.select("file", F.xxhash64("file").alias("src"), "block",
                                  F.monotonically_increasing_id().alias("place"), "chunk",
                                  reduce(or_, [F.col("chunk").contains(d) for d in (*OPENERS[1:], *CLOSERS[1:])]).alias("marked"),
                                  _open_tag(F.col("chunk")).alias("tag")), "xml-chunks")


def _open_tag(text: Column) -> Column:
    """Name of the start tag that a text without comments and the like ends in."""
    last = F.substring_index(text, "<", -1)
    return F.when(text.contains("<"), F.regexp_extract(last, r"^([A-Za-z][\w.:-]*)[^>]*\z", 1)).otherwise("")


def _left(mode: int) -> Column:
    """What is not whole in a chunk that starts in ``mode``; null where the mode
    does not end."""
    text = F.regexp_replace(F.concat(F.lit(OPENERS[mode]), F.col("chunk")), _COMPLETE, "")
    return F.when(F.col("chunk").contains(CLOSERS[mode]), text) if mode else text


def _after(mode: int, left: Column) -> Column:
    """(mode, open tag) behind that chunk."""
    opener = F.regexp_extract(left, r"<!--|<!\[CDATA\[|<\?", 0)
    found = F.when(left.isNull(), mode).otherwise(F.array_position(F.array(*map(F.lit, OPENERS)), opener) - 1).cast("int")
    return F.struct(found.alias("mode"), F.when(found == 0, _open_tag(left)).otherwise("").alias("tag"))


def _compose(split: pd.DataFrame) -> pd.DataFrame:
    """For the marked chunks of a split, whose maps are written with a decimal
    digit a mode: the maps from the split's start to before and behind them."""
    split = split.sort_values("place")
    maps = [[int(d) for d in f"{m:04d}"] for m in split["map"]]
    now, before, after = "0123", [], []
    for m in maps:
        before.append(int(now))
        now = "".join(str(m[int(d)]) for d in now)
        after.append(int(now))
    return split[PLACE].assign(before=before, after=after)


def _digit(number: str, mode: str) -> Column:
    return F.substring(F.lpad(F.col(number).cast("string"), len(OPENERS), "0"), F.col(mode) + 1, F.lit(1)).cast("int")


def _carry(splits: pd.DataFrame) -> pd.DataFrame:
    """The mode and the open tag that each split of a file starts with."""
    splits = splits.sort_values("block")
    mode, tag, modes, tags = 0, None, [], []
    for ends, last, marked in zip(splits["ends"], splits["last"], splits["last_tags"]):
        modes.append(mode)
        tags.append(tag)
        start = mode
        if ends == ends and ends is not None:
            mode = int(f"{int(ends):04d}"[start])
        tag = marked[start] if marked is not None else (last if mode == 0 else "")
    return splits[["src", "block"]].assign(mode_in=modes, tag_in=tags)


def judge_chunks(chunks: DataFrame, records: tuple[str, ...]) -> DataFrame:
    """(src, block, place, marked, mode, opened, head, owner_block, owner_place):
    the mode that each chunk starts in, the element whose start tag its separator
    stands in, whether a record starts there (or a file), and the chunk that
    holds the start of the record that it belongs to."""
    marks = chunks.select(*PLACE, "marked", "tag")
    modes = range(len(OPENERS))
    # generators keep a text from being searched once per use of what is left of it
    left = chunks.where("marked").select(*PLACE, F.inline(F.array(F.struct(*[_left(m).alias(f"left{m}") for m in modes]))))
    outs = F.array(*[_after(m, F.col(f"left{m}")) for m in modes])
    events = materialize(left.select(*PLACE, F.inline(F.array(F.struct(outs.alias("outs")))))
                         .select(*PLACE, F.concat_ws("", F.transform("outs", lambda o: o["mode"].cast("string"))).cast("int").alias("map"),
                                 F.col("outs.tag").alias("tags")), "xml-events")
    maps = (events.select(*PLACE, "map").groupBy("src", "block")
            .applyInPandas(_compose, "src long, block long, place long, before int, after int"))
    maps = materialize(maps.join(join_side(events.select(*PLACE, "tags")), PLACE), "xml-modes")
    # a chunk's tags are by the mode that it starts in itself; here by the mode that its split starts in
    own_tags = F.transform(F.sequence(F.lit(1), F.lit(len(OPENERS))), lambda k: F.element_at(
        "tags", F.substring(F.lpad(F.col("before").cast("string"), len(OPENERS), "0"), k, F.lit(1)).cast("int") + 1))
    ends = maps.groupBy("src", "block").agg(F.max_by("after", "place").alias("ends"), F.max("place").alias("p"),
                                            F.max_by(own_tags, "place").alias("t"))
    splits = (marks.groupBy("src", "block").agg(F.max("place").alias("end"), F.max_by("tag", "place").alias("last"))
              .join(ends, ["src", "block"], "left")
              .select("src", "block", "last", "ends", F.when(F.col("p") == F.col("end"), F.col("t")).alias("last_tags")))
    starts = materialize(splits.groupBy("src").applyInPandas(
        _carry, "src long, block long, mode_in int, tag_in string"), "xml-splits")      # a row per split
    known = (maps.join(starts, ["src", "block"])
             .select(*PLACE, _digit("before", "mode_in").alias("own"), _digit("after", "mode_in").alias("after"), "tags")
             .withColumn("open", F.element_at("tags", F.col("own") + 1)).drop("tags"))
    order = Window.partitionBy("src", "block").orderBy("place")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = (marks.join(known, PLACE, "left").join(starts, ["src", "block"])
            .withColumn("mode", F.coalesce("own", F.last("after", True).over(earlier), "mode_in"))
            .withColumn("open", F.coalesce("open", F.when(F.col("mode") == 0, F.col("tag")).otherwise("")))
            .withColumn("opened", F.when(F.row_number().over(order) == 1, F.col("tag_in")).otherwise(F.lag("open").over(order)))
            .withColumn("head", F.col("opened").isNull() | ((F.col("mode") == 0) & F.col("opened").isin(*records))))
    rows = with_owners(rows.select(*PLACE, "marked", "mode", "opened", "head"))
    return rows


def with_owners(rows: DataFrame) -> DataFrame:
    """Pieces (src, block, place, head, ...) with the place of the head at or
    before each, in its split or in an earlier one of the file."""
    order = Window.partitionBy("src", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = materialize(rows.withColumn("own_head", F.last(F.when(F.col("head"), F.col("place")), True).over(order)), "pieces")
    heads = rows.groupBy("src", "block").agg(F.max("own_head").alias("p"))
    before = Window.partitionBy("src").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)     # over splits
    carried = heads.select("src", "block", F.last(F.when(F.col("p").isNotNull(), F.struct("block", "p")), True)
                           .over(before).alias("c"))
    return (rows.join(carried, ["src", "block"])
            .withColumn("owner_block", F.when(F.col("own_head").isNotNull(), F.col("block")).otherwise(F.col("c.block")))
            .withColumn("owner_place", F.coalesce("own_head", "c.p")).drop("own_head", "c"))


def join_pieces(chunks: DataFrame, loose: DataFrame, sep: str) -> DataFrame:
    """(file, src, block, place, chunk): the chunks without the loose pieces (src,
    block, place, owner_block, owner_place, drop), which are put behind their
    owners or dropped.  Only owners and loose pieces are moved, unless they are too
    many to be sent to every executor: then the chunks are moved by their places."""
    owners = materialize(loose.where("NOT drop").select(
        "src", F.col("owner_block").alias("block"), F.col("owner_place").alias("place")).distinct(), "owners")
    pieces = (loose.where("NOT drop").select(*PLACE, "owner_block", "owner_place")
              .unionByName(owners.withColumn("owner_block", F.col("block")).withColumn("owner_place", F.col("place"))))
    joined = (chunks.join(join_side(pieces), PLACE).groupBy("src", "owner_block", "owner_place")
              .agg(F.min("file").alias("file"),
                   F.sort_array(F.collect_list(F.struct("block", "place", "chunk"))).alias("parts"))    # of one record
              .select("file", "src", F.col("owner_block").alias("block"), F.col("owner_place").alias("place"),
                      F.array_join(F.transform("parts", lambda p: p["chunk"]), sep).alias("chunk")))
    plain = chunks.join(join_side(loose.select(*PLACE)), PLACE, "left_anti").join(join_side(owners), PLACE, "left_anti")
    return plain.select("file", *PLACE, "chunk").unionByName(joined)


def whole_records(chunks: DataFrame, judged: DataFrame, sep: str) -> DataFrame:
    """The chunks with every record whole in the chunk in which it starts;
    comments are taken out."""
    in_comment = F.col("mode").isin(1, 3) & ~F.col("marked")       # nothing of it is outside
    loose = materialize(judged.where(~F.col("head")).withColumn("drop", in_comment), "xml-loose")
    clean = F.when(F.col("chunk").contains("<!--"), F.regexp_replace("chunk", _COMMENTS, "$1")).otherwise(F.col("chunk"))
    return join_pieces(chunks, loose, sep).withColumn("chunk", clean)


def number_by_place(rows: DataFrame, id_col: str = "seq") -> DataFrame:
    """Rows (file, src, block, place, sub, ...) numbered from 1 in the order in
    which they stand in the dump: files by name, splits by start, places.

    A split's rows are ranked among themselves, which one task can hold, and
    shifted by the number of rows in the splits before it; rows are neither
    range-partitioned nor sorted by their contents."""
    sizes = rows.groupBy("src", "block").agg(F.min("file").alias("file"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)      # a row per split
    offsets = sizes.select("src", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("src", "block").orderBy("place", "sub"))
    return (rows.withColumn("_rank", rank).join(offsets, ["src", "block"])
            .withColumn(id_col, (F.col("offset") + F.col("_rank")).cast("long")).drop("_rank", "offset"))
