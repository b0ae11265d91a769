"""The ten analysis queries as SQL text over the star tables registered as
views (the external-table workflow).  ``{p}`` is the view-name prefix.

Same plans as the DataFrame versions after Catalyst: the year filter goes
through the time dimension (dynamic partition pruning on the written fact),
the author filter is a literal on the fact's ``author_id``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .olap import AUTHOR_ID, AUTHOR_NAME, TOP_K, YEAR

_PER_AUTHOR = """
SELECT a.name AS author_name, c.num_pubs
FROM (SELECT author_id, count(publication_id) AS num_pubs FROM {p}publication {where} GROUP BY author_id) c
JOIN {p}author a ON a.author_id = c.author_id
ORDER BY num_pubs DESC, author_name"""
_YEAR = f"time_id IN (SELECT time_id FROM {{p}}timeinfo WHERE year = {YEAR})"
_NAME = f"author_id IN (SELECT author_id FROM {{p}}author WHERE name = '{AUTHOR_NAME}')"

SQL = {
    "q1_pubs_per_author": _PER_AUTHOR.replace("{where}", ""),
    "q2_pubs_per_author_year": _PER_AUTHOR.replace("{where}", "WHERE " + _YEAR),
    "q3_max_cites_per_author": """
SELECT a.name AS author_name, c.max_citings
FROM (SELECT author_id, max(citings_dblp) AS max_citings FROM {p}publication GROUP BY author_id) c
JOIN {p}author a ON a.author_id = c.author_id""",
    "q4_top_cited_authors": f"""
SELECT a.name AS author_name, t.max_c
FROM (SELECT author_id, CAST(sum(citings_dblp) AS BIGINT) AS max_c FROM {{p}}publication
      GROUP BY author_id ORDER BY max_c DESC, author_id LIMIT {TOP_K}) t
JOIN {{p}}author a ON a.author_id = t.author_id
ORDER BY max_c DESC, author_name""",
    "q5_pubs_of_author": f"SELECT count(publication_id) AS num_pubs FROM {{p}}publication WHERE author_id = {AUTHOR_ID}",
    "q6_pubs_of_author_year": f"""
SELECT count(publication_id) AS num_pubs FROM {{p}}publication WHERE author_id = {AUTHOR_ID} AND {_YEAR}""",
    "q7_max_cites_of_author": f"""
SELECT max(citings_dblp) AS max_citings FROM {{p}}publication WHERE author_id = {AUTHOR_ID}""",
    "q8_sum_cites_of_author": f"""
SELECT CAST(sum(citings_dblp) AS BIGINT) AS sum_citings FROM {{p}}publication WHERE author_id = {AUTHOR_ID}""",
    "q9_pubs_of_author_name": f"SELECT count(publication_id) AS num_pubs FROM {{p}}publication WHERE {_NAME}",
    "q10_pubs_of_author_name_year": f"""
SELECT count(publication_id) AS num_pubs FROM {{p}}publication WHERE {_NAME} AND {_YEAR}""",
}


def run(spark: SparkSession, name: str, prefix: str = "") -> DataFrame:
    return spark.sql(SQL[name].replace("{p}", prefix))
