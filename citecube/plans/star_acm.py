"""Star schema from ACM staged records.

Differences to the DBLP branch (kept from the transform job): the citation
count is already a number per record and lands in ``citings_acm``; there is
no document type or venue series dimension (their keys stay -1, the DBLP
citation column stays 0); no key-based citation join, so records sharing a
source id are all kept.  Title lookup is by source id (first title id)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import decade, split_list
from ..operators.keys import dense_ids
from ..operators.lookup import dim_lookup
from ..schemas import FACT_DEFAULTS
from ..session import materialize
from .star import StarSchema


def build_star_acm(acm: DataFrame) -> StarSchema:
    """acm: seq, source_id, title, year, venue, authors, num_citings."""
    acm = materialize(acm, "acm-records")  # parsed once for all tables
    pubs = acm.select("seq", "source_id", "title", "year", "num_citings")
    links_raw = acm.select("seq", F.explode(split_list("authors")).alias("author"))

    def time_dim():
        return dense_ids(pubs.select("year").distinct(), ["year"], "time_id").select(
            "time_id", F.col("year").cast("long").alias("year"), F.lit(1).cast("long").alias("month"),
            F.lit(1).cast("long").alias("day"), decade("year").alias("decade"))

    def title_dim():
        # one title row per record: the record's sequence number is the key
        return pubs.select(F.col("seq").cast("long").alias("title_id"), "title",
                           F.col("source_id").alias("source_key"))

    def author_dim():
        return dense_ids(links_raw.select("author").distinct(), ["author"], "author_id").select(
            "author_id", F.col("author").alias("name"))

    with ThreadPoolExecutor(max_workers=3) as pool:
        timeinfo, title, author = pool.map(lambda f: f(), [time_dim, title_dim, author_dim])

    f = dim_lookup(pubs, "year", timeinfo, "year", "time_id", "time_id", unique=True)
    f = dim_lookup(f, "source_id", title, "source_key", "title_id", "title_id")
    links = dim_lookup(links_raw, "author", author, "name", "author_id", "author_id",
                       unique=True).select("seq", "author_id")
    f = f.join(links, "seq", "inner")
    d = FACT_DEFAULTS
    fact = f.select(
        F.col("seq").cast("long").alias("publication_id"), "title_id",
        F.lit(d["type_id"]).cast("long").alias("type_id"), "time_id",
        F.lit(d["venue_series_id"]).cast("long").alias("venue_series_id"),
        F.lit(d["citings_dblp"]).cast("long").alias("citings_dblp"),
        F.lit(d["ignore1"]).cast("long").alias("ignore1"),
        F.col("num_citings").cast("long").alias("citings_acm"),
        F.lit(d["ignore3"]).cast("long").alias("ignore3"), "author_id",
        F.lit(d["ignore4"]).alias("ignore4"))
    bridge = links.select(F.col("seq").alias("publication_id"), "author_id").distinct()
    empty_type = fact.sparkSession.createDataFrame([], "type_id long, name string, description string")
    empty_venue = fact.sparkSession.createDataFrame([], "venue_series_id long, name string, dblp_key string")
    return StarSchema(timeinfo, empty_venue, title, author, empty_type, fact, bridge)
