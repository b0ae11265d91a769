"""Outputs of the earlier ETL-tool version of the transform (superseded in
the original, still inventoried): authors, titles, types, years,
publication-author map and publication rows, each with a sequence id, for
pipe-delimited files with a header.

Unique-row rules per field: author name and title case-sensitive; document
type, publication key and year case-insensitive (the kept spelling is the
smallest).  Sequences number the unique rows in sort order (``dense_ids``),
so no single-task window is involved."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import unique_rows
from ..operators.keys import dense_ids
from ..operators.lookup import dim_lookup
from ..sources.csv_dialects import read_pipe_header, write_pipe_header


@dataclass
class PdiOutputs:
    authors: DataFrame          # AuthorID, Name
    titles: DataFrame           # TitleID, Title
    types: DataFrame            # TypeID, Type
    years: DataFrame            # YearID, Year
    pub_author_map: DataFrame   # ID, PublicationID, AuthorID
    publication: DataFrame      # Id, PubKey, PublicationID, TitleID, TypeID, YearID, AuthorID

    def files(self) -> dict[str, DataFrame]:
        return {"authors": self.authors, "titles": self.titles, "types": self.types, "years": self.years,
                "pubAuthorMap": self.pub_author_map, "publication": self.publication}

    def write(self, root: str) -> None:
        """All six outputs as pipe-delimited files with a header, in key order."""
        for name, df in self.files().items():
            write_pipe_header(df, f"{root}/{name}.csv", order_by=df.columns[0])

    def read(self, spark: SparkSession, root: str, name: str) -> DataFrame:
        """One written output, with its columns' types."""
        return read_pipe_header(spark, f"{root}/{name}.csv", self.files()[name].schema)


def build_pdi(publications: DataFrame, authors: DataFrame) -> PdiOutputs:
    """publications: id, type, key, title, year; authors: id, author (one row
    per list item - the long form, so no list is collected or split)."""
    rows = publications.select(F.col("id").alias("Id"), F.col("type").alias("Type"),
                               F.col("key").alias("PubKey"), F.col("title").alias("Title"),
                               F.col("year").alias("Year"))
    names = authors.select(F.col("id").alias("Id"), F.col("author").alias("Name"))

    def authors():
        return dense_ids(names.select("Name").distinct(), ["Name"], "AuthorID").select("AuthorID", "Name")

    def titles():
        return dense_ids(rows.select("Title").distinct(), ["Title"], "TitleID").select("TitleID", "Title")

    def types():
        u = unique_rows(rows.select("Type"), ["Type"], ["Type"], case_insensitive=("Type",))
        return dense_ids(u.withColumn("_k", F.lower("Type")), ["_k"], "TypeID").select("TypeID", "Type")

    def years():
        return dense_ids(rows.select("Year").distinct(), ["Year"], "YearID").select("YearID", "Year")

    def pubs():
        u = unique_rows(rows.select("PubKey", "Id"), ["PubKey"], ["Id"], case_insensitive=("PubKey",))
        return dense_ids(u.withColumn("_k", F.lower("PubKey")), ["_k"], "PublicationID").select(
            "_k", "PublicationID")

    with ThreadPoolExecutor(max_workers=5) as pool:
        a, t, ty, y, p = (f.result() for f in [pool.submit(fn) for fn in (authors, titles, types, years, pubs)])

    keyed = rows.withColumn("_k", F.lower("PubKey")).withColumn("_t", F.lower("Type"))
    tyk = ty.select(F.lower("Type").alias("_t"), "TypeID")
    per_pub = dim_lookup(keyed, "_k", p, "_k", "PublicationID", "PublicationID", unique=True)
    per_pub = dim_lookup(per_pub, "Title", t, "Title", "TitleID", "TitleID", unique=True)
    per_pub = dim_lookup(per_pub, "_t", tyk, "_t", "TypeID", "TypeID", unique=True)
    per_pub = dim_lookup(per_pub, "Year", y, "Year", "YearID", "YearID", unique=True)
    per_author = dim_lookup(names, "Name", a, "Name", "AuthorID", "AuthorID", unique=True)
    publication = per_pub.join(per_author.select("Id", "AuthorID"), "Id").select(
        "Id", "PubKey", "PublicationID", "TitleID", "TypeID", "YearID", "AuthorID")
    pairs = publication.select("PublicationID", "AuthorID").distinct()
    pam = dense_ids(pairs, ["PublicationID", "AuthorID"], "ID").select("ID", "PublicationID", "AuthorID")
    return PdiOutputs(a, t, ty, y, pam, publication)

