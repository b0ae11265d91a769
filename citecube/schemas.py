"""Explicit schemas: nothing in the engine infers types from data."""

from pyspark.sql import types as T

L, S, I = T.LongType(), T.StringType(), T.IntegerType()


def struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Staged record files (the import's output, the star job's input).
STAGED_PUBLICATIONS = struct(("id", L), ("type", S), ("key", S), ("title", S),
                             ("year", L), ("venue", S), ("authors", S), ("cites", S))
STAGED_COLLECTIONS = struct(("id", L), ("type", S), ("key", S), ("title", S))
STAGED_ACM_PUBLICATIONS = struct(("id", L), ("source_id", S), ("title", S), ("year", L),
                                 ("venue", S), ("authors", S), ("num_citings", L))

# Long (one row per list item) form of the staged lists.
PUB_AUTHORS = struct(("id", L), ("pos", L), ("author", S))
PUB_CITES = struct(("id", L), ("pos", L), ("cite", S))

# Star schema.
TIMEINFO = struct(("time_id", L), ("year", L), ("month", L), ("day", L), ("decade", L))
VENUE_SERIES = struct(("venue_series_id", L), ("name", S), ("dblp_key", S))
TITLE = struct(("title_id", L), ("title", S), ("source_key", S))
AUTHOR = struct(("author_id", L), ("name", S))
DOCUMENT_TYPE = struct(("type_id", L), ("name", S), ("description", S))
PUBLICATION = struct(("publication_id", L), ("title_id", L), ("type_id", L), ("time_id", L),
                     ("venue_series_id", L), ("citings_dblp", L), ("ignore1", L),
                     ("citings_acm", L), ("ignore3", L), ("author_id", L), ("ignore4", S))
BRIDGE = struct(("publication_id", L), ("author_id", L))
CITING_BRIDGE = struct(("publication_id", L), ("cited_publication_id", L))

# Defaults of a fresh fact row before the dimension keys are
# merged in (missing key = -1, counters = 0, trailing text column = "").
FACT_DEFAULTS = {
    "title_id": -1, "type_id": -1, "time_id": -1, "venue_series_id": -1,
    "citings_dblp": 0, "ignore1": 0, "citings_acm": 0, "ignore3": 0,
    "author_id": -1, "ignore4": "",
}

# Description column of the document type dimension.
TYPE_DESCRIPTION = "-1"

# Record element names kept by the bibliographic XML import.
PUBLICATION_TYPES = ("article", "inproceedings", "incollection")
COLLECTION_TYPES = ("proceedings", "book")
# Every record element of the bibliography DTD.
ALL_RECORD_TYPES = ("article", "inproceedings", "proceedings", "book", "incollection",
                    "phdthesis", "mastersthesis", "www")
# Child fields the DTD allows inside a record.
DTD_FIELDS = ("author", "editor", "title", "booktitle", "pages", "year", "address",
              "journal", "volume", "number", "month", "url", "ee", "cdrom", "cite",
              "publisher", "note", "crossref", "isbn", "series", "school", "chapter")
# Placeholder of an unresolved citation.
CITE_PLACEHOLDER = "..."
