"""Reference SQL (ANSI, runnable by DuckDB on the driver's tables) for each
registered query.  The oracle goes through the record form with
``|``-joined lists and string splitting, i.e. an independent path from the
long form the Spark plans use.  Surrogate ids are
``row_number() OVER (ORDER BY natural key)``; the title dimension (one row
per record) is keyed by the record id."""

from __future__ import annotations

from .plans.olap import AUTHOR_ID, AUTHOR_NAME, TOP_K, YEAR

RECORDS = """
bib_pub_all AS (
  SELECT o_orderkey + 1 AS id, o_orderpriority AS type, 'orders/' || o_orderkey AS key,
         'Order ' || o_orderkey AS title, CAST(year(o_orderdate) AS BIGINT) AS year,
         CASE o_orderstatus WHEN 'P' THEN 'ref:cust/' || o_custkey
              WHEN 'F' THEN o_orderpriority || '#' || month(o_orderdate) || '#' || day(o_orderdate)
              ELSE '' END AS venue
  FROM orders),
bib_authors AS (
  SELECT l_orderkey + 1 AS id, string_agg(replace(s_name, '|', '-'), '|' ORDER BY l_suppkey, s_name) AS authors
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_orderkey),
bib_cites AS (
  SELECT l_orderkey + 1 AS id, string_agg('orders/' || (l_partkey * 9), '|' ORDER BY l_partkey) AS cites
  FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_orderkey),
bib_pub AS (
  SELECT p.id, p.type, p.key, p.title, p.year, p.venue, a.authors, coalesce(c.cites, '') AS cites
  FROM bib_pub_all p JOIN bib_authors a ON a.id = p.id LEFT JOIN bib_cites c ON c.id = p.id
  WHERE p.key IS NOT NULL AND p.title IS NOT NULL AND p.year > 0),
bib_col AS (
  SELECT c_custkey + 1 AS id, c_mktsegment AS type, 'cust/' || c_custkey AS key, c_name AS title
  FROM customer)"""

STAR = RECORDS + """,
split_authors AS (SELECT id, unnest(string_split(authors, '|')) AS author FROM bib_pub),
split_cites AS (SELECT id, unnest(string_split(cites, '|')) AS cite FROM bib_pub),
dim_time AS (
  SELECT row_number() OVER (ORDER BY year) AS time_id, year, CAST(1 AS BIGINT) AS month,
         CAST(1 AS BIGINT) AS day, CAST(((year % 100) // 10) * 10 AS BIGINT) AS decade
  FROM (SELECT DISTINCT year FROM bib_pub)),
dim_type AS (
  SELECT row_number() OVER (ORDER BY name) AS type_id, name, '-1' AS description
  FROM (SELECT type AS name FROM bib_pub UNION SELECT type FROM bib_col)),
dim_venue AS (
  SELECT row_number() OVER (ORDER BY key, title, id) AS venue_series_id, title AS name, key AS dblp_key
  FROM bib_col),
dim_title_src AS (SELECT id AS title_id, title, key AS source_key, id FROM bib_pub),
dim_title AS (SELECT title_id, title, source_key FROM dim_title_src),
dim_author AS (
  SELECT row_number() OVER (ORDER BY author) AS author_id, author AS name
  FROM (SELECT DISTINCT author FROM split_authors)),
cite_counts AS (
  SELECT f.id, coalesce(n.n, 0) AS citings_dblp
  FROM (SELECT key, min(id) AS id FROM bib_pub GROUP BY key) f
  LEFT JOIN (SELECT CASE WHEN cite LIKE '%ref:%' THEN substr(cite, 5) ELSE cite END AS key,
                    count(*) AS n FROM split_cites GROUP BY 1) n ON n.key = f.key),
lookup_venue AS (
  SELECT p.id, coalesce(v.venue_series_id, -1) AS venue_series_id
  FROM bib_pub p LEFT JOIN (SELECT dblp_key, min(venue_series_id) AS venue_series_id
                            FROM dim_venue GROUP BY dblp_key) v
    ON v.dblp_key = CASE WHEN p.venue LIKE '%ref:%' THEN substr(p.venue, 5) ELSE p.venue END),
lookup_time AS (
  SELECT p.id, coalesce(t.time_id, -1) AS time_id FROM bib_pub p LEFT JOIN dim_time t ON t.year = p.year),
lookup_type AS (
  SELECT p.id, coalesce(t.type_id, -1) AS type_id FROM bib_pub p LEFT JOIN dim_type t ON t.name = p.type),
lookup_title AS (
  SELECT p.id, coalesce(t.title_id, -1) AS title_id
  FROM bib_pub p LEFT JOIN (SELECT source_key, min(title_id) AS title_id FROM dim_title GROUP BY 1) t
    ON t.source_key = p.key),
lookup_author AS (
  SELECT s.id, coalesce(a.author_id, -1) AS author_id
  FROM split_authors s LEFT JOIN dim_author a ON a.name = s.author),
fact AS (
  SELECT c.id AS publication_id, ti.title_id, ty.type_id, tm.time_id, v.venue_series_id,
         c.citings_dblp, CAST(0 AS BIGINT) AS ignore1, CAST(0 AS BIGINT) AS citings_acm,
         CAST(0 AS BIGINT) AS ignore3, a.author_id, '' AS ignore4
  FROM cite_counts c
  JOIN lookup_venue v ON v.id = c.id
  JOIN lookup_type ty ON ty.id = c.id
  JOIN lookup_time tm ON tm.id = c.id
  JOIN lookup_title ti ON ti.id = c.id
  JOIN lookup_author a ON a.id = c.id),
bridge AS (SELECT DISTINCT id AS publication_id, author_id FROM lookup_author),
citing_bridge AS (
  SELECT DISTINCT c.id AS publication_id, f.id AS cited_publication_id
  FROM split_cites c JOIN (SELECT key, min(id) AS id FROM bib_pub GROUP BY key) f
    ON f.key = CASE WHEN c.cite LIKE '%ref:%' THEN substr(c.cite, 5) ELSE c.cite END),
cube AS (
  SELECT author_id, time_id, type_id, count(publication_id) AS n_pubs,
         CAST(sum(citings_dblp) AS BIGINT) AS sum_citings, max(citings_dblp) AS max_citings,
         CAST(GROUPING(author_id, time_id, type_id) AS BIGINT) AS gid
  FROM fact GROUP BY CUBE (author_id, time_id, type_id))"""


def with_star(select: str) -> str:
    return "WITH " + STAR.strip() + "\n" + select.strip()


def with_records(select: str) -> str:
    return "WITH " + RECORDS.strip() + "\n" + select.strip()


_per_author = """
SELECT a.name AS author_name, count(f.publication_id) AS num_pubs
FROM fact f JOIN dim_author a ON a.author_id = f.author_id {where}
GROUP BY a.name ORDER BY num_pubs DESC, author_name"""

_year = f"f.time_id IN (SELECT time_id FROM dim_time WHERE year = {YEAR})"

OLAP = {
    "q1_pubs_per_author": _per_author.format(where=""),
    "q2_pubs_per_author_year": _per_author.format(where="WHERE " + _year),
    "q3_max_cites_per_author": """
SELECT a.name AS author_name, max(f.citings_dblp) AS max_citings
FROM fact f JOIN dim_author a ON a.author_id = f.author_id GROUP BY a.name""",
    "q4_top_cited_authors": f"""
SELECT max(num_c) AS max_c, author_name FROM (
  SELECT CAST(sum(f.citings_dblp) AS BIGINT) AS num_c, a.name AS author_name
  FROM fact f JOIN dim_author a ON a.author_id = f.author_id GROUP BY a.name)
GROUP BY author_name ORDER BY max_c DESC, author_name LIMIT {TOP_K}""",
    "q5_pubs_of_author": f"SELECT count(f.publication_id) AS num_pubs FROM fact f WHERE f.author_id = {AUTHOR_ID}",
    "q6_pubs_of_author_year": f"""
SELECT count(f.publication_id) AS num_pubs FROM fact f WHERE f.author_id = {AUTHOR_ID} AND {_year}""",
    "q7_max_cites_of_author": f"SELECT max(f.citings_dblp) AS max_citings FROM fact f WHERE f.author_id = {AUTHOR_ID}",
    "q8_sum_cites_of_author": f"""
SELECT CAST(sum(f.citings_dblp) AS BIGINT) AS sum_citings FROM fact f WHERE f.author_id = {AUTHOR_ID}""",
    "q9_pubs_of_author_name": f"""
SELECT count(f.publication_id) AS num_pubs FROM fact f JOIN dim_author a ON a.author_id = f.author_id
WHERE a.name = '{AUTHOR_NAME}'""",
    "q10_pubs_of_author_name_year": f"""
SELECT count(f.publication_id) AS num_pubs FROM fact f JOIN dim_author a ON a.author_id = f.author_id
WHERE a.name = '{AUTHOR_NAME}' AND {_year}""",
}
