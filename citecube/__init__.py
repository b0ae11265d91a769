"""citecube: bibliographic star-schema analytics on Spark.

Ingest bibliographic records (XML, two CSV dialects), key and conform them
into a star schema (author, title, venue series, document type and time
dimensions, a publication-author bridge and a fact table with citation
counts), and answer OLAP questions from the base tables or from persisted
cuboids.  Everything is expressed with DataFrame / SQL operators so that
Catalyst and AQE plan the work.
"""

__version__ = "0.1.0"
