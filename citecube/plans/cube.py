"""Pre-aggregated OLAP cube over the fact table and cuboid-answered queries.

The cube is ``CUBE(author_id, time_id, type_id)`` over fact columns only
(no join before the aggregation), with mergeable measures: row count, sum
and max of the citation count.  The finest cuboid is grouped first; the Expand
to the eight cuboids runs on its rows, not on the fact's, with partial
aggregation right after it.
Persisted as parquet partitioned by ``gid`` (the grouping id), a query reads
only its cuboid's folder.  Decade or name roll-ups join the small dimension
to the cuboid, not to the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .olap import AUTHOR_ID, AUTHOR_NAME, TOP_K, YEAR, name_filter

CUBE_DIMS = ("author_id", "time_id", "type_id")


def build_cube(fact: DataFrame) -> DataFrame:
    """The finest cuboid is grouped first, so a fact row is shuffled once at
    most; the others merge its rows."""
    finest = fact.groupBy(*CUBE_DIMS).agg(F.count("publication_id").alias("n"), F.sum("citings_dblp").alias("s"),
                                          F.max("citings_dblp").alias("m"))
    return (finest.cube(*CUBE_DIMS)
            .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_pubs"),
                 F.sum("s").cast("long").alias("sum_citings"),
                 F.max("m").alias("max_citings"),
                 F.grouping_id().alias("gid")))


def gid_of(dims: tuple[str, ...]) -> int:
    """Grouping id of the cuboid that keeps ``dims`` (first cube dimension is
    the most significant bit; a set bit means rolled up)."""
    g = 0
    for d in CUBE_DIMS:
        g = (g << 1) | (0 if d in dims else 1)
    return g


def cuboid(cube: DataFrame, *dims: str) -> DataFrame:
    return cube.filter(F.col("gid") == gid_of(tuple(dims)))


def write_cube(cube: DataFrame, path: str) -> None:
    """One folder per cuboid, clustered by author inside, so an author filter
    skips files and row groups.  The other dimensions break ties: an author
    with many rows does not become one task."""
    cube = cube.repartitionByRange("gid", "author_id", "time_id", "type_id").sortWithinPartitions(
        "gid", "author_id", "time_id", "type_id")
    cube.write.mode("overwrite").partitionBy("gid").parquet(path)


def _names(per: DataFrame, author: DataFrame) -> DataFrame:
    return per.join(author.select("author_id", F.col("name").alias("author_name")), "author_id")


def _time_ids(timeinfo: DataFrame, year: int) -> DataFrame:
    # years are distinct in the time dimension: at most one row
    return F.broadcast(timeinfo.filter(F.col("year") == year).select("time_id"))


def _total(c: DataFrame) -> DataFrame:
    return c.agg(F.coalesce(F.sum("n_pubs"), F.lit(0)).cast("long").alias("num_pubs"))


def cq1(cube, author, timeinfo):
    return (_names(cuboid(cube, "author_id"), author)
            .select("author_name", F.col("n_pubs").alias("num_pubs"))
            .orderBy(F.desc("num_pubs"), "author_name"))


def cq2(cube, author, timeinfo, year=YEAR):
    c = cuboid(cube, "author_id", "time_id").join(_time_ids(timeinfo, year), "time_id", "left_semi")
    return (_names(c, author).select("author_name", F.col("n_pubs").alias("num_pubs"))
            .orderBy(F.desc("num_pubs"), "author_name"))


def cq3(cube, author, timeinfo):
    return _names(cuboid(cube, "author_id"), author).select("author_name", "max_citings")


def cq4(cube, author, timeinfo, k=TOP_K, year=None):
    per = cuboid(cube, "author_id") if year is None else cuboid(cube, "author_id", "time_id").join(
        _time_ids(timeinfo, year), "time_id", "left_semi")
    # at most k rows
    top = (per.select("author_id", F.col("sum_citings").alias("max_c"))
           .orderBy(F.desc("max_c"), "author_id").limit(k))
    return (_names(F.broadcast(top), author).select("author_name", "max_c")
            .orderBy(F.desc("max_c"), "author_name"))


def cq5(cube, author, timeinfo, author_id=AUTHOR_ID):
    return _total(cuboid(cube, "author_id").filter(F.col("author_id") == author_id))


def cq6(cube, author, timeinfo, author_id=AUTHOR_ID, year=YEAR):
    c = (cuboid(cube, "author_id", "time_id").filter(F.col("author_id") == author_id)
         .join(_time_ids(timeinfo, year), "time_id", "left_semi"))
    return _total(c)


def cq7(cube, author, timeinfo, author_id=AUTHOR_ID):
    return (cuboid(cube, "author_id").filter(F.col("author_id") == author_id)
            .agg(F.max("max_citings").alias("max_citings")))


def cq8(cube, author, timeinfo, author_id=AUTHOR_ID):
    return (cuboid(cube, "author_id").filter(F.col("author_id") == author_id)
            .agg(F.sum("sum_citings").cast("long").alias("sum_citings")))


def cq9(cube, author, timeinfo, name=AUTHOR_NAME):
    return _total(name_filter(cuboid(cube, "author_id"), author, name))


def cq10(cube, author, timeinfo, name=AUTHOR_NAME, year=YEAR):
    c = name_filter(cuboid(cube, "author_id", "time_id"), author, name).join(
        _time_ids(timeinfo, year), "time_id", "left_semi")
    return _total(c)


def decade_rollup(cube: DataFrame, timeinfo: DataFrame) -> DataFrame:
    """Author places (fact rows) and their citations per decade, rolled up from
    the (time_id) cuboid.  A publication counts once per author here; distinct
    publications are in ``lattice``."""
    c = cuboid(cube, "time_id").join(timeinfo.select("time_id", "decade"), "time_id")
    return c.groupBy("decade").agg(F.sum("n_pubs").cast("long").alias("n_links"),
                                   F.sum("sum_citings").cast("long").alias("link_citings"),
                                   F.max("max_citings").alias("max_citings"))


CUBE_QUERIES = {
    "q1_pubs_per_author": cq1, "q2_pubs_per_author_year": cq2, "q3_max_cites_per_author": cq3,
    "q4_top_cited_authors": cq4, "q5_pubs_of_author": cq5, "q6_pubs_of_author_year": cq6,
    "q7_max_cites_of_author": cq7, "q8_sum_cites_of_author": cq8,
    "q9_pubs_of_author_name": cq9, "q10_pubs_of_author_name_year": cq10,
}
