"""The ten analysis queries on the star-schema base tables.

Author-level questions aggregate the fact on ``author_id`` first and attach
names afterwards, so the join sees one row per author instead of one per
fact row.  A year filter reaches the fact through at most one dimension row
(years are distinct), which is broadcast; a name filter is a semi-join with
the ids of that name, however many there are.
Author ids are ranks of the names, so ordering by id equals ordering by
name and a top-k can be cut before the names are joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parameters of the analysis workload on the adapter tables.
YEAR = 1997
AUTHOR_ID = 7
AUTHOR_NAME = "Supplier#000000007"
TOP_K = 10


@dataclass
class Tables:
    publication: DataFrame
    author: DataFrame
    timeinfo: DataFrame


def _year_filter(fact: DataFrame, timeinfo: DataFrame, year: int) -> DataFrame:
    # Distinct years: the filtered time dimension has at most one row.
    t = F.broadcast(timeinfo.filter(F.col("year") == year).select("time_id"))
    return fact.join(t, "time_id", "left_semi")


def name_filter(rows: DataFrame, author: DataFrame, name: str) -> DataFrame:
    """Rows of all author ids that bear the name."""
    return rows.join(author.filter(F.col("name") == name).select("author_id"), "author_id", "left_semi")


def _with_names(per_author: DataFrame, author: DataFrame) -> DataFrame:
    return per_author.join(author.select("author_id", F.col("name").alias("author_name")), "author_id")


def _pubs_per_author(fact: DataFrame, author: DataFrame) -> DataFrame:
    per = fact.groupBy("author_id").agg(F.count("publication_id").alias("num_pubs"))
    return (_with_names(per, author).select("author_name", "num_pubs")
            .orderBy(F.desc("num_pubs"), "author_name"))


def q1_pubs_per_author(t: Tables) -> DataFrame:
    return _pubs_per_author(t.publication, t.author)


def q2_pubs_per_author_year(t: Tables, year: int = YEAR) -> DataFrame:
    return _pubs_per_author(_year_filter(t.publication, t.timeinfo, year), t.author)


def q3_max_cites_per_author(t: Tables) -> DataFrame:
    per = t.publication.groupBy("author_id").agg(F.max("citings_dblp").alias("max_citings"))
    return _with_names(per, t.author).select("author_name", "max_citings")


def q4_top_cited_authors(t: Tables, k: int = TOP_K, year: int | None = None) -> DataFrame:
    """The ``k`` most cited authors, of one year's publications where given."""
    fact = t.publication if year is None else _year_filter(t.publication, t.timeinfo, year)
    per = fact.groupBy("author_id").agg(F.sum("citings_dblp").cast("long").alias("max_c"))
    top = per.orderBy(F.desc("max_c"), "author_id").limit(k)  # at most k rows: broadcast is bounded
    return (_with_names(F.broadcast(top), t.author).select("author_name", "max_c")
            .orderBy(F.desc("max_c"), "author_name"))


def _count(f: DataFrame) -> DataFrame:
    return f.agg(F.count("publication_id").alias("num_pubs"))


def q5_pubs_of_author(t: Tables, author_id: int = AUTHOR_ID) -> DataFrame:
    return _count(t.publication.filter(F.col("author_id") == author_id))


def q6_pubs_of_author_year(t: Tables, author_id: int = AUTHOR_ID, year: int = YEAR) -> DataFrame:
    return _count(_year_filter(t.publication.filter(F.col("author_id") == author_id), t.timeinfo, year))


def q7_max_cites_of_author(t: Tables, author_id: int = AUTHOR_ID) -> DataFrame:
    return (t.publication.filter(F.col("author_id") == author_id)
            .agg(F.max("citings_dblp").alias("max_citings")))


def q8_sum_cites_of_author(t: Tables, author_id: int = AUTHOR_ID) -> DataFrame:
    return (t.publication.filter(F.col("author_id") == author_id)
            .agg(F.sum("citings_dblp").cast("long").alias("sum_citings")))


def q9_pubs_of_author_name(t: Tables, name: str = AUTHOR_NAME) -> DataFrame:
    return _count(name_filter(t.publication, t.author, name))


def q10_pubs_of_author_name_year(t: Tables, name: str = AUTHOR_NAME, year: int = YEAR) -> DataFrame:
    return _count(_year_filter(name_filter(t.publication, t.author, name), t.timeinfo, year))


QUERIES = {
    "q1_pubs_per_author": q1_pubs_per_author,
    "q2_pubs_per_author_year": q2_pubs_per_author_year,
    "q3_max_cites_per_author": q3_max_cites_per_author,
    "q4_top_cited_authors": q4_top_cited_authors,
    "q5_pubs_of_author": q5_pubs_of_author,
    "q6_pubs_of_author_year": q6_pubs_of_author_year,
    "q7_max_cites_of_author": q7_max_cites_of_author,
    "q8_sum_cites_of_author": q8_sum_cites_of_author,
    "q9_pubs_of_author_name": q9_pubs_of_author_name,
    "q10_pubs_of_author_name_year": q10_pubs_of_author_name_year,
}
