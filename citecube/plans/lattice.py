"""The cube as a lattice of cuboids: distinct counts, routing, refresh by segments.

Dimensions: author, time (year, which rolls up to decade), type, venue.  A cuboid
is named by the levels that it keeps; their attributes (names, year, decade) are
columns, so a question reads one folder and joins nothing.

*Distinct publications.*  A publication has one year, one type and one venue, but
several authors, and an author may stand on it twice.  So there are two kinds of
cuboids.  Those without author are summed from one row per publication, those
with author from one row per (publication, author): counts and citations take a
publication once, per author or at all, and stay mergeable by sum.  A question
that rolls the author up is never answered from a cuboid that keeps it.  For
year, decade and type the publications themselves are kept too, as bitmaps over
their dense ids: these merge by OR, count any roll-up, and show whether two
segments hold the same publication.

*Choice.*  All cuboids are sized in one pass (distinct counts by sketch); the two
finest are always stored, others greedily by the rows that they save per row that
they cost, up to a budget.  ``answer`` takes the smallest stored cuboid that
covers a question, else the fact.

*Refresh.*  Each load is a segment: its cuboids come from its own rows alone and
lie beside those of earlier segments.  Answers merge segments; ``compact`` merges
them for good.  A manifest names the live segments, so a load or a compaction
becomes visible at once, and a failed one never does."""

from __future__ import annotations

import itertools
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import join_side, materialize
from .olap import AUTHOR_ID, AUTHOR_NAME, TOP_K, YEAR

_L, _S = T.LongType(), T.StringType()
# Columns of each level; the first identifies it, the others are its attributes.
LEVELS: dict[str, dict[str, T.DataType]] = {
    "author": {"author_id": _L, "author_name": _S},
    "year": {"year": _L, "decade": _L},
    "decade": {"decade": _L},
    "type": {"type_id": _L, "type_name": _S},
    "venue": {"venue_series_id": _L, "venue_name": _S},
}
# Author places, publications, citations counted per publication and per author place, most citations.
MEASURES = {"n_links": F.sum, "n_pubs": F.sum, "sum_citings": F.sum, "link_citings": F.sum, "max_citings": F.max}
WRITERS = 4        # cuboids written side by side
BITMAPS = "publications"       # of these levels:
BITMAP_LEVELS = ("year", "type")
OPEN = "all"                   # name of the cuboid that keeps nothing


def cuboids() -> list[tuple[str, ...]]:
    """All cuboids: each dimension absent or at one of its levels."""
    choices = [("", "author"), ("", "decade", "year"), ("", "type"), ("", "venue")]
    return [tuple(level for level in combo if level) for combo in itertools.product(*choices)]


def name_of(levels: tuple[str, ...]) -> str:
    return "-".join(levels) or OPEN


def levels_of(name: str) -> tuple[str, ...]:
    return () if name == OPEN else tuple(name.split("-"))


def columns_of(levels: tuple[str, ...]) -> list[str]:
    return list(dict.fromkeys(c for level in levels for c in LEVELS[level]))


def covers(cuboid: tuple[str, ...], levels: set[str]) -> bool:
    """The cuboid keeps the levels, and the author only if they do."""
    kept = set(cuboid) | ({"decade"} if "year" in cuboid else set())
    return levels <= kept and ("author" in cuboid) == ("author" in levels)


def merged(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.groupBy(*columns).agg(*[f(m).cast("long").alias(m) for m, f in MEASURES.items()])


def star_rows(tables: dict[str, DataFrame], fact: DataFrame | None = None) -> DataFrame:
    """Fact rows with all attributes of their dimensions; ids without a row in
    the dimension (-1) stay, with null attributes."""
    rows, names = star_keys(tables, fact)
    for of_ids in names.values():       # the authors first: a condition on them leaves few rows for the other joins
        rows = rows.join(of_ids, of_ids.columns[0], "left")
    return rows


def star_keys(tables: dict[str, DataFrame], fact: DataFrame | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The same rows without the names, and the names: column -> (id, name), one
    row per id.  A load given so is grouped by ids alone, and the names are
    joined to its cuboids instead of its fact rows; many names are not broadcast."""
    fact = tables["publication"] if fact is None else fact
    t = tables["timeinfo"].select("time_id", "year", "decade")
    rows = (fact.select("publication_id", "author_id", "time_id", "type_id", "venue_series_id", "citings_dblp")
            .join(t, "time_id", "left"))
    names = {"author_name": tables["author"].select("author_id", F.col("name").alias("author_name")),
             "type_name": tables["document_type"].select("type_id", F.col("name").alias("type_name")),
             "venue_name": tables["venue_series"].select("venue_series_id", F.col("name").alias("venue_name"))}
    return rows, {column: join_side(of_ids) for column, of_ids in names.items()}


def finest(rows: DataFrame, names: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The two finest cuboids and the bitmaps of a set of fact rows; ``names``
    holds the attributes that the rows lack."""
    names = names or {}

    def given(levels: tuple[str, ...]) -> list[str]:
        return [c for c in columns_of(levels) if c not in names]

    def named(grouped: DataFrame, levels: tuple[str, ...]) -> DataFrame:
        measures = [c for c in grouped.columns if c not in columns_of(levels)]
        for column in columns_of(levels):
            if column in names:
                grouped = grouped.join(names[column], names[column].columns[0], "left")
        return grouped.select(*columns_of(levels), *measures)

    rest = given(("year", "type", "venue"))
    pairs = materialize(rows.groupBy("publication_id", *given(("author",)), *rest)
                        .agg(F.count(F.lit(1)).alias("n_links"), F.max("citings_dblp").alias("c")), "lattice-pairs")
    pubs = materialize(pairs.groupBy("publication_id", *rest).agg(F.sum("n_links").alias("n_links"), F.max("c").alias("c")),
                       "lattice-pubs")

    def cuboid(grain: DataFrame, levels: tuple[str, ...]) -> DataFrame:
        return named(grain.groupBy(*given(levels)).agg(
            F.sum("n_links").cast("long").alias("n_links"), F.count(F.lit(1)).alias("n_pubs"),
            F.sum("c").cast("long").alias("sum_citings"), F.sum(F.col("n_links") * F.col("c")).cast("long").alias("link_citings"),
            F.max("c").cast("long").alias("max_citings")), levels)

    bits = named(pubs.groupBy(*given(BITMAP_LEVELS), F.bitmap_bucket_number("publication_id").alias("bucket"))
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position("publication_id")).alias("bits")), BITMAP_LEVELS)
    return {name_of(FINEST[0]): cuboid(pairs, FINEST[0]), name_of(FINEST[1]): cuboid(pubs, FINEST[1]), BITMAPS: bits}


FINEST = (("author", "year", "type", "venue"), ("year", "type", "venue"))


def choose(sizes: dict[tuple[str, ...], int], budget: float) -> list[tuple[str, ...]]:
    """The finest cuboids, then those that save most rows read per row stored,
    until ``budget`` times the finest cuboids' rows are spent."""
    stored, left = list(FINEST), budget * sum(sizes[c] for c in FINEST)

    def cost(question: tuple[str, ...], among: list[tuple[str, ...]]) -> int:
        return min(sizes[c] for c in among if covers(c, set(question)))

    while True:
        gains = {}
        for c in sizes:
            if c not in stored and sizes[c] <= left:
                saved = sum(max(0, cost(q, stored) - sizes[c]) for q in sizes if covers(c, set(q)))
                gains[c] = saved / max(1, sizes[c])
        if not gains or max(gains.values()) <= 0:
            return stored
        best = max(gains, key=lambda c: (gains[c], c))
        stored.append(best)
        left -= sizes[best]


def measure_sizes(base: dict[str, DataFrame]) -> dict[tuple[str, ...], int]:
    """Rows of every cuboid, by distinct-count sketches over the finest ones."""
    out = {}
    for fine in FINEST:
        mine = [c for c in cuboids() if ("author" in c) == ("author" in fine)]
        row = base[name_of(fine)].agg(*[F.approx_count_distinct(F.struct(*[LEVELS_KEY[k] for k in c]) if c else F.lit(1), 0.02)
                                        .alias(name_of(c)) for c in mine]).first()
        out |= {c: row[name_of(c)] for c in mine}
    return out


LEVELS_KEY = {level: next(iter(columns)) for level, columns in LEVELS.items()}


@dataclass
class Lattice:
    """A stored lattice under ``root``; ``fact_rows`` (as ``star_rows``) answers
    what no cuboid covers."""
    spark: SparkSession
    root: str
    budget: float = 0.5
    fact_rows: DataFrame | None = None

    MANIFEST = T.StructType([T.StructField("kind", _S), T.StructField("name", _S), T.StructField("rows", _L),
                             T.StructField("generation", _L)])

    # -- manifest: a small table per generation --------------------------------
    def _manifest(self) -> tuple[int, list[str], dict[str, int]]:
        """(generation, live segments, rows of each stored cuboid)."""
        folder = os.path.join(self.root, "manifest")
        self.spark.createDataFrame([], self.MANIFEST).drop("generation").write.mode("ignore").parquet(
            os.path.join(folder, "generation=0"))
        rows = self.spark.read.schema(self.MANIFEST).parquet(folder)
        last = rows.agg(F.max("generation")).first()[0] or 0
        live = rows.where(F.col("generation") == last).collect()         # segments and cuboids, not data
        return (last, sorted(r.name for r in live if r.kind == "segment"),
                {r.name: r.rows for r in live if r.kind == "cuboid"})

    @cached_property
    def state(self) -> tuple[int, list[str], dict[str, int]]:
        return self._manifest()

    def _publish(self, segments: list[str], stored: dict[str, int]) -> None:
        rows = [("segment", s, None) for s in segments] + [("cuboid", c, n) for c, n in stored.items()]
        (self.spark.createDataFrame(rows, T.StructType(self.MANIFEST.fields[:3])).coalesce(1).write.mode("overwrite")
         .parquet(os.path.join(self.root, "manifest", f"generation={self.state[0] + 1}")))
        del self.state

    # -- cuboids -----------------------------------------------------------------
    def _schema(self, name: str) -> T.StructType:
        levels = BITMAP_LEVELS if name == BITMAPS else levels_of(name)
        fields = [T.StructField(c, kind) for level in levels for c, kind in LEVELS[level].items()]
        measures = ([T.StructField("bucket", _L), T.StructField("bits", T.BinaryType())] if name == BITMAPS
                    else [T.StructField(m, _L) for m in MEASURES])
        return T.StructType([*fields, *measures, T.StructField("segment", _S)])

    def read(self, name: str) -> DataFrame:
        """The live segments' rows of a stored cuboid: one folder."""
        rows = self.spark.read.schema(self._schema(name)).parquet(os.path.join(self.root, name))
        return rows.where(F.col("segment").isin(self.state[1]))

    def _write(self, name: str, rows: DataFrame, segment: str) -> None:
        keys = [c for c in rows.columns if c not in MEASURES and c != "bits"]
        if keys:
            rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        rows.write.mode("overwrite").parquet(os.path.join(self.root, name, f"segment={segment}"))

    def _write_all(self, frames: dict[str, DataFrame], segment: str) -> None:
        with ThreadPoolExecutor(WRITERS) as pool:
            list(pool.map(lambda name: self._write(name, frames[name], segment), frames))

    def add_segment(self, rows: DataFrame, segment: str, names: dict[str, DataFrame] | None = None) -> None:
        """Add a load of fact rows (as ``star_rows``, or without the columns in
        ``names``, as ``star_keys``).  Nothing but these rows, the names
        and the bitmaps of earlier loads, is read.  The first load decides which
        cuboids are stored.  A publication that an earlier segment holds is an
        error; adding a segment again under its name replaces it."""
        base = finest(rows, names)
        base = {name: materialize(df, "lattice-finest") for name, df in base.items()}
        others = [s for s in self.state[1] if s != segment]
        stored = self.state[2]
        if not stored:
            sizes = measure_sizes(base)
            stored = {name_of(c): sizes[c] for c in choose(sizes, self.budget)}
        if others:
            earlier = self.read(BITMAPS).where(F.col("segment") != segment).select("bucket", "bits")
            if _held(earlier) + _held(base[BITMAPS]) != _held(earlier.union(base[BITMAPS].select("bucket", "bits"))):
                raise ValueError(f"segment {segment} repeats publications of earlier segments")

        def cuboid(name: str) -> DataFrame:
            levels = levels_of(name)
            fine = base[name_of(FINEST[0] if "author" in levels else FINEST[1])]
            return fine if levels in FINEST else merged(fine, columns_of(levels))

        self._write_all({name: cuboid(name) for name in stored} | {BITMAPS: base[BITMAPS]}, segment)
        self._publish([*others, segment], stored)

    def compact(self, segment: str) -> None:
        """Merge all live segments into one of a new name."""
        if segment in self.state[1]:
            raise ValueError(f"segment {segment} is live")
        bits = self.read(BITMAPS).groupBy(*columns_of(BITMAP_LEVELS), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        whole = {name: merged(self.read(name), columns_of(levels_of(name))) for name in self.state[2]}
        self._write_all(whole | {BITMAPS: bits}, segment)
        self._publish([segment], self.state[2])

    # -- questions ----------------------------------------------------------------
    def route(self, levels: set[str]) -> str | None:
        """Name of the smallest stored cuboid that covers the levels."""
        fits = {name: rows for name, rows in self.state[2].items()
                if covers(levels_of(name), levels)}
        return min(fits, key=lambda n: (fits[n], n)) if fits else None

    def answer(self, by: tuple[str, ...] = (), measures: tuple[str, ...] = tuple(MEASURES), **where) -> DataFrame:
        """Measures by the columns ``by`` (ids and attributes of LEVELS) of the
        rows whose columns equal the values ``where``.

        ``n_links`` counts author places, ``n_pubs`` distinct publications;
        ``sum_citings`` adds each publication's citations once, ``link_citings``
        once per author place.  Where only some authors are asked for, but not by
        author, distinct publications come from the fact."""
        used = [*by, *where]
        levels = {_level(c) for c in used}
        if {"year", "decade"} <= levels:
            levels.discard("decade")
        condition = [F.col(c) == v for c, v in where.items()]
        once = set(measures) & {"n_pubs", "sum_citings"}
        loose = "author" in levels and once and not ({"author_id"} & set(used))
        name = None if loose else self.route(levels)
        if name is None:
            return self._from_fact(by, measures, condition)
        rows = self.read(name)
        for c in condition:
            rows = rows.where(c)
        return _total(rows.groupBy(*by).agg(*[MEASURES[m](m).cast("long").alias(m) for m in measures]), by, measures)

    def _from_fact(self, by, measures, condition) -> DataFrame:
        if self.fact_rows is None:
            raise ValueError("no stored cuboid covers the question, and there is no fact to fall back on")
        rows = self.fact_rows
        for c in condition:
            rows = rows.where(c)
        # per group and publication first: then everything is a plain sum
        pubs = rows.groupBy(*by, "publication_id").agg(F.count(F.lit(1)).alias("n_links"), F.lit(1).alias("n_pubs"),
                                                       F.max("citings_dblp").alias("sum_citings"))
        pubs = (pubs.withColumn("max_citings", F.col("sum_citings"))
                .withColumn("link_citings", F.col("n_links") * F.col("sum_citings")))
        return _total(pubs.groupBy(*by).agg(*[MEASURES[m](m).cast("long").alias(m) for m in measures]), by, measures)

    def distinct_publications(self, *by: str) -> DataFrame:
        """(by..., n_pubs) for columns of year and type: bits of the merged sets."""
        sets = self.read(BITMAPS).groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        return _total(sets.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).cast("long").alias("n_pubs")), by, ("n_pubs",))


def _level(column: str) -> str:
    return "decade" if column == "decade" else next(k for k, columns in LEVELS.items() if column in columns)


def _total(rows: DataFrame, by: tuple[str, ...], measures: tuple[str, ...]) -> DataFrame:
    """A total over no rows counts zero."""
    zero: dict[str, Column] = {m: F.coalesce(m, F.lit(0).cast("long")) for m in measures if m != "max_citings"}
    return rows if by else rows.withColumns(zero)


def _held(bitmaps: DataFrame) -> int:
    sets = bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return sets.agg(F.sum(F.bitmap_count("bits"))).first()[0] or 0


# -- the ten analysis queries through the router --------------------------------
def _ranked(rows: DataFrame) -> DataFrame:
    return (rows.select("author_name", F.col("n_links").alias("num_pubs"))
            .orderBy(F.desc("num_pubs"), "author_name"))


def _count(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("n_links").alias("num_pubs"))


_AUTHOR = ("author_id", "author_name")


def _top(cube: Lattice, k: int = TOP_K) -> DataFrame:
    return (cube.answer(_AUTHOR, ("link_citings",)).orderBy(F.desc("link_citings"), "author_id").limit(k)
            .select("author_name", F.col("link_citings").alias("max_c")))


QUERIES = {
    "q1_pubs_per_author": lambda c: _ranked(c.answer(_AUTHOR, ("n_links",))),
    "q2_pubs_per_author_year": lambda c: _ranked(c.answer(_AUTHOR, ("n_links",), year=YEAR)),
    "q3_max_cites_per_author": lambda c: c.answer(_AUTHOR, ("max_citings",)).drop("author_id"),
    "q4_top_cited_authors": _top,
    "q5_pubs_of_author": lambda c: _count(c.answer((), ("n_links",), author_id=AUTHOR_ID)),
    "q6_pubs_of_author_year": lambda c: _count(c.answer((), ("n_links",), author_id=AUTHOR_ID, year=YEAR)),
    "q7_max_cites_of_author": lambda c: c.answer((), ("max_citings",), author_id=AUTHOR_ID),
    "q8_sum_cites_of_author": lambda c: c.answer((), ("link_citings",), author_id=AUTHOR_ID)
    .select(F.col("link_citings").alias("sum_citings")),
    "q9_pubs_of_author_name": lambda c: _count(c.answer((), ("n_links",), author_name=AUTHOR_NAME)),
    "q10_pubs_of_author_name_year": lambda c: _count(c.answer((), ("n_links",), author_name=AUTHOR_NAME, year=YEAR)),
}
