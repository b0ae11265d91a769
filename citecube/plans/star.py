"""Star schema from staged bibliographic records.

Grain of the fact table: one row per (publication, author list item).  The
build keeps the reference semantics:

* publications sharing a key collapse to the one with the smallest id (the
  citation count is attached per key and merged with an inner join);
* every dimension lookup emits each fact row once with the first matching
  id, or -1;
* the venue key has ``ref:`` cut as in ``clean_key``; cited keys too.

Plan shape (what Catalyst/AQE should produce at scale):

* ``title`` ids: the staged record ids (one title row per record), so the
  publications are not shuffled for them;
* surviving publications: one hash shuffle by key with ``min_by`` partially
  aggregated map-side (a hot duplicated key collapses before the shuffle),
  co-partitioned with the citation counts (also aggregated by key before
  the shuffle), so that join adds no exchange;
* time, type, venue and author lookups join a written dimension: Spark sizes
  the join, and both inputs are plain scans, so AQE splits a hot key.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_key, decade
from ..operators.dedup import union_distinct
from ..operators.keys import dense_ids
from ..operators.lookup import dim_lookup, merge_column
from ..schemas import FACT_DEFAULTS, TYPE_DESCRIPTION
from ..session import join_side, materialize
from ..sources.adapter import Staged


@dataclass
class StarSchema:
    timeinfo: DataFrame
    venue_series: DataFrame
    title: DataFrame
    author: DataFrame
    document_type: DataFrame
    publication: DataFrame
    bridge: DataFrame
    citing: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        out = {"timeinfo": self.timeinfo, "venue_series": self.venue_series, "title": self.title,
               "author": self.author, "document_type": self.document_type,
               "publication": self.publication, "publication_author_map": self.bridge}
        if self.citing is not None:
            out["publication_citing_map"] = self.citing
        return out


def time_dimension(st: Staged) -> DataFrame:
    years = st.publications.select("year").distinct()
    return dense_ids(years, ["year"], "time_id").select(
        "time_id", F.col("year").cast("long").alias("year"), F.lit(1).cast("long").alias("month"),
        F.lit(1).cast("long").alias("day"), decade("year").alias("decade"))


def type_dimension(st: Staged) -> DataFrame:
    names = union_distinct([st.publications, st.collections], "type")
    return dense_ids(names, ["type"], "type_id").select(
        "type_id", F.col("type").alias("name"), F.lit(TYPE_DESCRIPTION).alias("description"))


def venue_dimension(st: Staged) -> DataFrame:
    return dense_ids(st.collections.select("id", "key", "title"), ["key", "title", "id"],
                     "venue_series_id").select(
        "venue_series_id", F.col("title").alias("name"), F.col("key").alias("dblp_key"))


def title_ids(st: Staged) -> DataFrame:
    """Title dimension rows carrying the source publication columns
    (id, type, key, title, year, venue, title_id).  The dimension is one row
    per staged record, so the record's own unique id is its key: no range
    shuffle or snapshot of the whole publication table is needed."""
    return st.publications.withColumn("title_id", F.col("id").cast("long"))


def title_dimension(titled: DataFrame) -> DataFrame:
    return titled.select("title_id", "title", F.col("key").alias("source_key"))


def author_dimension(st: Staged) -> DataFrame:
    names = st.authors.select("author").distinct()
    return dense_ids(names, ["author"], "author_id").select(
        "author_id", F.col("author").alias("name"))


def surviving_publications(titled: DataFrame, cites: DataFrame) -> DataFrame:
    """One row per distinct publication key: the first publication with its
    citation count (number of citations of that key)."""
    firsts = (titled.groupBy("key")
              .agg(F.min_by(F.struct("id", "title_id", "type", "year", "venue"), F.col("id")).alias("p"))
              .select("key", "p.*"))
    counts = (cites.select(clean_key("cite").alias("key"))
              .groupBy("key").agg(F.count(F.lit(1)).alias("citings_dblp")))
    return (firsts.join(counts, "key", "left")
            .withColumn("citings_dblp", F.coalesce(F.col("citings_dblp"), F.lit(0)).cast("long")))


def author_links(st: Staged, author_dim: DataFrame) -> DataFrame:
    """(id, author_id) per author list item; a name missing from the
    dimension maps to -1."""
    return dim_lookup(st.authors.select("id", "author"), "author", author_dim, "name",
                      "author_id", "author_id",
                      unique=True).select("id", "author_id")


def fact_table(survivors: DataFrame, links: DataFrame, timeinfo: DataFrame,
               doc_type: DataFrame, venues: DataFrame) -> DataFrame:
    f = survivors.withColumn("venue_key", clean_key("venue"))
    f = dim_lookup(f, "year", timeinfo, "year", "time_id", "time_id", unique=True)
    f = dim_lookup(f, "type", doc_type, "name", "type_id", "type_id", unique=True)
    f = dim_lookup(f, "venue_key", venues, "dblp_key", "venue_series_id", "venue_series_id")
    d = FACT_DEFAULTS
    f = f.withColumn("author_id", F.lit(d["author_id"]).cast("long"))
    f = merge_column(f, "id", links, "id", "author_id", "author_id")
    return f.select(
        F.col("id").alias("publication_id"), "title_id", "type_id", "time_id", "venue_series_id",
        "citings_dblp", F.lit(d["ignore1"]).cast("long").alias("ignore1"),
        F.lit(d["citings_acm"]).cast("long").alias("citings_acm"),
        F.lit(d["ignore3"]).cast("long").alias("ignore3"), "author_id",
        F.lit(d["ignore4"]).alias("ignore4"))


def bridge_table(links: DataFrame) -> DataFrame:
    """N:M publication-author bridge: distinct id pairs over all staged
    publications (partial aggregation before the shuffle)."""
    return (links.select(F.col("id").alias("publication_id"), "author_id")
            .distinct())


def citing_bridge(st: Staged) -> DataFrame:
    """N:M citation bridge of the normalised schema variant: distinct
    (citing publication, cited publication) pairs; a cited key resolves to
    the first publication with that key, unresolved keys are dropped.
    The first publications are written before the join: its inputs are then
    plain scans, and AQE can split a hot cited key."""
    firsts = materialize(st.publications.groupBy("key").agg(F.min("id").alias("cited_publication_id")), "cited")
    cites = st.cites.select(F.col("id").alias("publication_id"), clean_key("cite").alias("key"))
    return cites.join(join_side(firsts), "key").select("publication_id", "cited_publication_id").distinct()


def build_star(st: Staged, parallel: int = 5, dims: dict[str, DataFrame] | None = None) -> StarSchema:
    """The five dimensions are independent jobs; they are submitted from
    threads so that the scheduler can run them side by side.  ``dims`` gives
    dimensions whose ids exist already (by table name)."""
    dims = dims or {}
    builders = {"timeinfo": time_dimension, "document_type": type_dimension, "venue_series": venue_dimension,
                "title": title_ids, "author": author_dimension}
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        timeinfo, doc_type, venues, titled, authors = pool.map(
            lambda name: dims[name] if name in dims else builders[name](st), builders)
    # written once: the fact and the bridge both read the (id, author_id)
    # links, which would otherwise repeat the author join (a shuffle of all
    # author rows by name when the dimension is too large to broadcast)
    links = materialize(author_links(st, authors), "links")
    survivors = surviving_publications(titled, st.cites)
    fact = fact_table(survivors, join_side(links), timeinfo, doc_type, venues)
    return StarSchema(timeinfo, venues, title_dimension(titled), authors, doc_type, fact,
                      bridge_table(links), citing_bridge(st))
