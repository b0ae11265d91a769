"""Further registered queries, by section: CSV dialects, XML import, HTML
markup/entities, record rules, lookups and joins, PDI-style operators,
streaming import, outputs of the earlier ETL-tool transform, external text
tables, and the analysis queries as SQL text.  Each entry is a Spark plan
over the driver's tables plus its DuckDB oracle SQL."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import oracle
from .catalog import memo, register, staged, star
from .functions import text as fx
from .functions.entities import LATIN1_ENTITIES, decode_entities, sql_decode_chain
from .functions.text import split_list
from .operators import dedup, routing
from .operators.lookup import (count_matches, dim_lookup, join_full, join_inner, join_left,
                               join_three_way)
from .plans import hiveql
from .plans.pdi import build_pdi
from .plans.star import build_star, title_ids
from .plans.star_acm import build_star_acm
from .schemas import ALL_RECORD_TYPES, CITE_PLACEHOLDER, DTD_FIELDS, STAGED_COLLECTIONS, STAGED_PUBLICATIONS
from .session import scratch_path
from .sources import adapter
from .sources import csv_dialects as csv
from .sources import csv_scan, dtd
from .sources import tables as tb
from .sources import xml_records as xml
from .sources.tables import author_pub
from .streaming.incremental import run_dblp_import, staged_tables

DOC_COLS = ["doc_id", "lang", "source", "text", "n_chars"]
DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
DOC_SQL = "SELECT doc_id, lang, source, text, n_chars FROM documents"
FIRST_N = 100


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.table(spark, sf_dir, "documents").select(*DOC_COLS)


# --- CSV dialects ---------------------------------------------------------

@register("csv_escaped_roundtrip", DOC_SQL)
def csv_escaped_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "docs-escaped")
    csv.write_escaped(_docs(spark, sf_dir), path, order_by="doc_id")
    return csv.read_escaped(spark, path, DOC_SCHEMA)


@register("csv_quoted_roundtrip", DOC_SQL)
def csv_quoted_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "docs-quoted")
    csv.write_quoted(_docs(spark, sf_dir), path, order_by="doc_id")
    return csv.read_quoted(spark, path, DOC_SCHEMA)


@register("csv_convert_first_n", DOC_SQL + f" ORDER BY doc_id LIMIT {FIRST_N}")
def csv_convert_first_n(spark, sf_dir):
    src, dst = scratch_path(spark, "docs-escaped"), scratch_path(spark, "docs-first-n")
    csv.write_escaped(_docs(spark, sf_dir), src, order_by="doc_id")
    csv.convert(spark, src, dst, DOC_SCHEMA, "escaped-to-quoted", limit=FIRST_N)
    return csv.read_quoted(spark, dst, DOC_SCHEMA)


@register("csv_quoted_to_escaped", """
SELECT doc_id, lang, source, text, CASE WHEN doc_id % 3 > 0 THEN 'extra' END AS first_extra,
       CASE WHEN doc_id % 3 > 1 THEN ', "quoted"' END AS second_extra, 4 + doc_id % 3 AS n_fields FROM documents""")
def csv_quoted_to_escaped(spark, sf_dir):
    """Records of whole texts with none, one or two further fields, converted
    and read back."""
    src, dst = scratch_path(spark, "docs-ragged"), scratch_path(spark, "docs-ragged-escaped")
    fields = F.slice(F.array(F.col("doc_id").cast("string"), "lang", "source", "text", F.lit("extra"), F.lit(', "quoted"')),
                     1, (F.col("doc_id") % 3 + 4).cast("int"))
    lines = _docs(spark, sf_dir).select(F.array_join(F.transform(fields, csv._quote_minimal), ",").alias("value"))
    lines.write.option("lineSep", "\n").text(src)
    csv.convert_records(spark, src, dst, "quoted-to-escaped")
    f = csv.read_escaped_fields(spark, dst)
    get = lambda i: F.get("fields", F.lit(i))
    return f.select(get(0).cast("long").alias("doc_id"), get(1).alias("lang"), get(2).alias("source"), get(3).alias("text"),
                    get(4).alias("first_extra"), get(5).alias("second_extra"), F.size("fields").cast("long").alias("n_fields"))


@register("csv_rejects", """
SELECT CASE page_id % 4 WHEN 1 THEN 'bad_n' WHEN 2 THEN 'text_after_quote' ELSE 'missing_field_2' END AS reason, page_id
FROM pages WHERE page_id % 4 > 0""")
def csv_rejects(spark, sf_dir):
    """Every page as a quoted record; three of four are broken in one way each,
    and all of those come out as rejects, whole."""
    path, kind = scratch_path(spark, "pages-quoted"), F.col("page_id") % 4
    key, html = F.col("page_id").cast("string"), csv._quote_minimal(F.coalesce("html", F.lit("")))
    line = (F.when(kind == 1, F.concat(key, F.lit(",x1,"), html)).when(kind == 2, F.concat(key, F.lit(',1,"a" b,'), html))
            .when(kind == 3, F.concat(key, F.lit(",1"))).otherwise(F.concat(key, F.lit(",1,"), html)))
    adapter.table(spark, sf_dir, "pages").select(line.alias("value")).write.option("lineSep", "\n").text(path)
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("html", T.StringType())])
    rejects = csv_scan.route(csv_scan.scan_quoted(spark, path), schema)[1]
    return rejects.select("reason", F.regexp_extract("raw", "^[0-9]+", 0).cast("long").alias("page_id"))


@register("csv_pipe_header", oracle.with_star(
    'SELECT author_id AS "AuthorID", name AS "Name" FROM dim_author'))
def csv_pipe_header(spark, sf_dir):
    path = scratch_path(spark, "authors-pipe")
    a = star(spark, sf_dir).author.select(F.col("author_id").alias("AuthorID"), F.col("name").alias("Name"))
    csv.write_pipe_header(a, path, order_by="AuthorID")
    schema = T.StructType([T.StructField("AuthorID", T.LongType()), T.StructField("Name", T.StringType())])
    return csv.read_pipe_header(spark, path, schema)


def _write_staged_csv(spark, sf_dir) -> tuple[str, str]:
    return memo("staged-csv", spark, sf_dir, lambda: _write_staged_csv_now(spark, sf_dir))


def _write_staged_csv_now(spark, sf_dir) -> tuple[str, str]:
    """The import's output: staged publication and collection files."""
    root = scratch_path(spark, "staged")
    pubs, cols = os.path.join(root, "dblp-publications.csv"), os.path.join(root, "dblp-collections.csv")
    csv.write_escaped(adapter.publication_records(spark, sf_dir), pubs, order_by="id")
    csv.write_escaped(adapter.collections(spark, sf_dir), cols, order_by="id")
    return pubs, cols


@register("csv_typed_scan", oracle.with_records(
    "SELECT id, key, year FROM bib_pub"))
def csv_typed_scan(spark, sf_dir):
    pubs, _ = _write_staged_csv(spark, sf_dir)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("key", T.StringType()),
                           T.StructField("year", T.LongType())])
    return csv.read_escaped(spark, pubs, schema, indices=[0, 2, 4], strict=True)


@register("star_from_csv_fact", oracle.with_star("SELECT * FROM fact"))
def star_from_csv_fact(spark, sf_dir):
    pubs, cols = _write_staged_csv(spark, sf_dir)
    records = csv.read_escaped(spark, pubs, STAGED_PUBLICATIONS, strict=True)
    collections = csv.read_escaped(spark, cols, STAGED_COLLECTIONS, strict=True)
    return build_star(adapter.staged_from_records(records, collections)).publication


@register("split_authors", oracle.with_records(
    "SELECT id, unnest(string_split(authors, '|')) AS author FROM bib_pub"))
def split_authors(spark, sf_dir):
    r = adapter.publication_records(spark, sf_dir)
    return r.select("id", F.explode(split_list("authors")).alias("author"))


@register("split_cites", oracle.with_records(
    "SELECT id, unnest(string_split(cites, '|')) AS cite FROM bib_pub"))
def split_cites(spark, sf_dir):
    r = adapter.publication_records(spark, sf_dir)
    return r.select("id", F.explode(split_list("cites")).alias("cite"))


@register("join_list", oracle.with_records("SELECT id, authors, cites FROM bib_pub"))
def join_list_q(spark, sf_dir):
    return adapter.publication_records(spark, sf_dir).select("id", "authors", "cites")



# --- XML import -----------------------------------------------------------


XML_HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE dblp SYSTEM "dblp.dtd">\n<dblp>'


def _dblp_dump(spark, sf_dir) -> str:
    return memo("dblp-xml", spark, sf_dir, lambda: _dblp_dump_now(spark, sf_dir))


def _dblp_dump_now(spark, sf_dir) -> str:
    path = scratch_path(spark, "dblp-xml")
    recs = adapter.order_records(spark, sf_dir)
    xml.write_xml([xml.render_dblp_publications(recs),
                   xml.render_dblp_collections(adapter.table(spark, sf_dir, "customer")),
                   xml.render_dblp_homepages(adapter.table(spark, sf_dir, "supplier"))],
                  path, XML_HEAD, "</dblp>")
    return path


_XML_PUBS = """
SELECT row_number() OVER (ORDER BY o.o_orderkey) AS seq,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'article' WHEN '2-HIGH' THEN 'inproceedings'
            ELSE 'incollection' END AS type,
       p.key, 'Order' || chr(160) || o.o_orderkey
              || CASE WHEN o.o_orderkey % 5 = 0 THEN ' with key="v" in its title' ELSE '' END AS title,
       p.year, p.venue, p.authors, p.cites
FROM bib_pub p JOIN orders o ON o.o_orderkey + 1 = p.id
WHERE o.o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"""


@register("xml_dblp_extract", oracle.with_records(_XML_PUBS))
def xml_dblp_extract(spark, sf_dir):
    return xml.dblp_import(spark, _dblp_dump(spark, sf_dir))[0]


@register("xml_dblp_collections", oracle.with_records("""
SELECT row_number() OVER (ORDER BY c_custkey) AS seq, 'proceedings' AS type, 'cust/' || c_custkey AS key,
       c_name AS title FROM customer"""))
def xml_dblp_collections(spark, sf_dir):
    return xml.dblp_import(spark, _dblp_dump(spark, sf_dir))[1]


@register("xml_quality", """
SELECT 'unknown_field' AS rule, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('P', 'F')""")
def xml_quality(spark, sf_dir):
    return xml.quality_report(spark, _dblp_dump(spark, sf_dir))


def _dtd_text() -> str:
    """Declarations for the rendered records: authors and editors first, then one
    title, then any fields (chapters in books only); keys are required; the
    Latin-1 entities."""
    rest = [x for x in DTD_FIELDS if x not in ("author", "editor", "title")]
    lines = [f"<!ELEMENT {r} ((author|editor)*,title,({'|'.join(x for x in rest if x != 'chapter' or r == 'book')})*)>\n"
             f"<!ATTLIST {r} key CDATA #REQUIRED mdate CDATA #IMPLIED>" for r in ALL_RECORD_TYPES]
    inline = "|".join(xml.TITLE_MARKUP)
    lines += [f"<!ELEMENT {f} (#PCDATA{'|' + inline if f == 'title' else ''}){'*' if f == 'title' else ''}>" for f in DTD_FIELDS]
    lines += [f"<!ELEMENT {t} (#PCDATA)>" for t in xml.TITLE_MARKUP]
    lines += [f'<!ENTITY {n} "&#{ord(c)};">' for n, c in LATIN1_ENTITIES.items()]
    return "\n".join(lines)


@register("xml_dtd_violations", """
SELECT CASE o_orderkey % 8 WHEN 0 THEN 'missing_attribute' WHEN 1 THEN 'undeclared_element' WHEN 2 THEN 'misplaced_element'
            WHEN 3 THEN 'content_model' WHEN 4 THEN 'undeclared_entity' ELSE 'unknown_record' END AS rule,
       CASE o_orderkey % 8 WHEN 5 THEN 'person' ELSE 'article' END AS type,
       CASE WHEN o_orderkey % 8 NOT IN (0, 5) THEN 'orders/' || o_orderkey END AS key
FROM orders WHERE o_orderkey % 8 < 6""")
def xml_dtd_violations(spark, sf_dir):
    """One record per order, six of eight broken in one way each, against the
    declarations written beside them."""
    path, where = scratch_path(spark, "dtd-xml"), scratch_path(spark, "dtd")
    spark.createDataFrame([(_dtd_text(),)], "value string").coalesce(1).write.option("lineSep", "\n").text(where)
    key, fault = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 8
    pick = lambda k, broken, whole: F.when(fault == k, broken).otherwise(whole)
    text = F.concat(
        pick(0, F.lit('<article mdate="x">'), F.concat(F.lit('<article mdate="x" key="orders/'), key, F.lit('">'))),
        pick(3, F.lit("<title>T</title><author>A</author>"), F.lit("<author>A</author><title>T <i>x</i> &uuml;</title>")),
        pick(1, F.lit("<extra>e</extra>"), F.lit("")), pick(2, F.lit("<chapter>b</chapter>"), F.lit("")),
        pick(4, F.lit("<note>&unheard;</note>"), F.lit("<year>2001</year>")), F.lit("</article>"),
        pick(5, F.concat(F.lit('<person key="p/'), key, F.lit('"><author>P</author></person>')), F.lit("")))
    xml.write_xml([adapter.table(spark, sf_dir, "orders").select(text.alias("value"), F.col("o_orderkey").cast("long").alias("o"))],
                  path, XML_HEAD, "</dblp>")
    return dtd.violations(spark, path, dtd.read_dtd(spark, where), ALL_RECORD_TYPES, xml.KEY_SEP, xml.parse_dblp_chunks)


@register("xml_rejects", """
SELECT 'missing_author' AS reason,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'article' WHEN '2-HIGH' THEN 'inproceedings' ELSE 'incollection' END AS type,
       'orders/' || o_orderkey AS key
FROM orders o WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def xml_rejects(spark, sf_dir):
    """Records that the import leaves out, with the reason."""
    return xml.dblp_rejects(spark, _dblp_dump(spark, sf_dir)).select("reason", "type", "key")


_ACM_ROWS = """
SELECT row_number() OVER (ORDER BY id) AS seq, * EXCLUDE (id) FROM (
  SELECT p.id, p.key AS source_id, p.title, p.year,
         o.o_orderpriority || ' :1#' || month(o.o_orderdate) || '#' || day(o.o_orderdate) AS venue,
         p.authors, CAST(coalesce(c.n, 0) AS BIGINT) AS num_citings
  FROM bib_pub p JOIN orders o ON o.o_orderkey + 1 = p.id
  LEFT JOIN (SELECT l_orderkey + 1 AS id, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R'
             GROUP BY 1) c ON c.id = p.id)"""


def _acm_rows(spark, sf_dir):
    return memo("acm-rows", spark, sf_dir, lambda: _acm_rows_now(spark, sf_dir))


def _acm_rows_now(spark, sf_dir):
    path = scratch_path(spark, "acm-xml")
    xml.write_xml([xml.render_acm(adapter.order_records(spark, sf_dir))], path,
                  '<?xml version="1.0" encoding="UTF-8"?>\n<PublicationList>', "</PublicationList>")
    return xml.acm_import(spark, path)


@register("xml_acm_extract", oracle.with_records(_ACM_ROWS))
def xml_acm_extract(spark, sf_dir):
    return _acm_rows(spark, sf_dir)


_ACM_STAR = oracle.with_records(f"""
, acm AS ({_ACM_ROWS}),
acm_title AS (SELECT seq AS title_id, title, source_id AS source_key FROM acm),
acm_author AS (SELECT row_number() OVER (ORDER BY author) AS author_id, author AS name
               FROM (SELECT DISTINCT unnest(string_split(authors, '|')) AS author FROM acm)),
acm_time AS (SELECT row_number() OVER (ORDER BY year) AS time_id, year FROM (SELECT DISTINCT year FROM acm)),
acm_links AS (SELECT seq, unnest(string_split(authors, '|')) AS author FROM acm)
SELECT a.seq AS publication_id, t.title_id, CAST(-1 AS BIGINT) AS type_id, tm.time_id,
       CAST(-1 AS BIGINT) AS venue_series_id, CAST(0 AS BIGINT) AS citings_dblp, CAST(0 AS BIGINT) AS ignore1,
       a.num_citings AS citings_acm, CAST(0 AS BIGINT) AS ignore3, au.author_id, '' AS ignore4
FROM acm a
JOIN (SELECT source_key, min(title_id) AS title_id FROM acm_title GROUP BY 1) t ON t.source_key = a.source_id
JOIN acm_time tm ON tm.year = a.year
JOIN acm_links l ON l.seq = a.seq JOIN acm_author au ON au.name = l.author""".replace("\n, acm AS", ", acm AS"))


@register("acm_fact_publication", _ACM_STAR)
def acm_fact_publication(spark, sf_dir):
    return build_star_acm(_acm_rows(spark, sf_dir)).publication


# --- HTML pages: markup flattening and entities ---------------------------



@register("flatten_markup", f"""
SELECT page_id, {sql_decode_chain("regexp_replace(coalesce(html, ''), '<[^>]+>', '', 'g')")}
       AS page_text FROM pages""")
def flatten_markup(spark, sf_dir):
    p = adapter.table(spark, sf_dir, "pages")
    body = F.regexp_replace(F.coalesce("html", F.lit("")), "<[^>]+>", "")
    return p.select("page_id", decode_entities(body, include_predefined=True).alias("page_text"))


@register("entities", f"""
SELECT page_id, {sql_decode_chain("coalesce(html, '')")} AS decoded FROM pages""")
def entities_q(spark, sf_dir):
    p = adapter.table(spark, sf_dir, "pages")
    return p.select("page_id", decode_entities(F.coalesce("html", F.lit("")), True).alias("decoded"))


# --- record rules on the adapter records ----------------------------------


_CLEAN = "CASE WHEN {c} LIKE '%ref:%' THEN substr({c}, 5) ELSE {c} END"


@register("venue_string", oracle.with_records("SELECT id, venue FROM bib_pub_all"))
def venue_string_q(spark, sf_dir):
    return adapter.raw_publications(spark, sf_dir).select("id", "venue")


@register("clean_keys", oracle.with_records(
    f"SELECT id, {_CLEAN.format(c='venue')} AS venue_key FROM bib_pub"))
def clean_keys(spark, sf_dir):
    st = staged(spark, sf_dir)
    return st.publications.select("id", fx.clean_key("venue").alias("venue_key"))


@register("decade", "SELECT o_orderkey, CAST(((year(o_orderdate) % 100) // 10) * 10 AS BIGINT) AS decade "
                    "FROM orders")
def decade_q(spark, sf_dir):
    o = adapter.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", fx.decade(F.year("o_orderdate")).alias("decade"))


@register("complete_records", oracle.with_records("""
SELECT p.id IN (SELECT id FROM bib_pub) AS complete, count(*) AS n FROM bib_pub_all p GROUP BY 1"""))
def complete_records(spark, sf_dir):
    r = adapter.raw_publication_flags(spark, sf_dir)
    ok = (F.col("key").isNotNull() & F.col("title").isNotNull() & (F.col("year") > 0) & F.col("has_authors"))
    return r.groupBy(ok.alias("complete")).agg(F.count(F.lit(1)).alias("n"))


_URL_SPLIT = "[/?#]"


@register("safe_int", f"""
SELECT page_id, tok AS token,
       CASE WHEN regexp_full_match(tok, '[+-]?[0-9]+') THEN TRY_CAST(tok AS INTEGER) END AS value
FROM (SELECT page_id, unnest(string_split_regex(url, '{_URL_SPLIT}')) AS tok FROM pages)""")
def safe_int_q(spark, sf_dir):
    p = adapter.table(spark, sf_dir, "pages")
    t = p.select("page_id", F.explode(F.split("url", _URL_SPLIT)).alias("token"))
    return t.select("page_id", "token", fx.safe_int("token").alias("value"))


@register("drop_placeholder", """
SELECT l_orderkey AS o_orderkey, count(*) AS n_cites, CAST(sum(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END)
       AS BIGINT) AS n_kept FROM lineitem GROUP BY l_orderkey""")
def drop_placeholder_q(spark, sf_dir):
    """Citations per record before and after dropping the placeholder:
    counted with partial aggregation, no list collected."""
    c = adapter.raw_cites(spark, sf_dir)
    kept = (F.col("cite") != F.lit(CITE_PLACEHOLDER)).cast("long")
    return c.groupBy((F.col("id") - 1).alias("o_orderkey")).agg(
        F.count(F.lit(1)).cast("long").alias("n_cites"), F.sum(kept).cast("long").alias("n_kept"))


def _venue_texts(spark, sf_dir):
    o = adapter.table(spark, sf_dir, "orders")
    m, d = F.month("o_orderdate").cast("string"), F.dayofmonth("o_orderdate").cast("string")
    text = (F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Volume "), m, F.lit(" , Issue "), d,
                                                            F.lit(" ("), F.col("o_orderpriority"), F.lit(")")))
            .when(F.col("o_orderstatus") == "P", F.concat(F.lit("volume "), m, F.lit(", issue "), d))
            .otherwise(F.concat(F.lit("VOLUME "), m, F.lit("  ,\tISSUE "), d, F.lit(" "))))
    return o.select("o_orderkey", text.alias("venue_text"))


@register("volume_issue", """
SELECT o_orderkey, venue_text,
       CASE WHEN regexp_full_match(venue_text, '(?i)volume\\s+([0-9]+)\\s+,\\s+issue\\s+([0-9]+)\\s+.*')
            THEN CAST(regexp_extract(venue_text, '(?i)volume\\s+([0-9]+)', 1) AS INTEGER) ELSE 0 END AS volume,
       CASE WHEN regexp_full_match(venue_text, '(?i)volume\\s+([0-9]+)\\s+,\\s+issue\\s+([0-9]+)\\s+.*')
            THEN CAST(regexp_extract(venue_text, '(?i)issue\\s+([0-9]+)', 1) AS INTEGER) ELSE 0 END AS issue
FROM (SELECT o_orderkey,
        CASE o_orderstatus WHEN 'F' THEN 'Volume ' || month(o_orderdate) || ' , Issue ' || day(o_orderdate)
                                         || ' (' || o_orderpriority || ')'
             WHEN 'P' THEN 'volume ' || month(o_orderdate) || ', issue ' || day(o_orderdate)
             ELSE 'VOLUME ' || month(o_orderdate) || '  ,' || chr(9) || 'ISSUE ' || day(o_orderdate) || ' ' END
        AS venue_text FROM orders)""")
def volume_issue_q(spark, sf_dir):
    t = _venue_texts(spark, sf_dir)
    v, i = fx.volume_issue("venue_text")
    return t.select("o_orderkey", "venue_text", v.alias("volume"), i.alias("issue"))


@register("trim_ctl", """
SELECT conv_id, turn, regexp_replace(line, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS line
FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM conversations)""")
def trim_ctl_q(spark, sf_dir):
    c = adapter.table(spark, sf_dir, "conversations")
    lines = c.select("conv_id", "turn", F.explode(F.split("text", "\n")).alias("line"))
    return lines.select("conv_id", "turn", fx.trim_ctl("line").alias("line"))


# --- lookups and joins ----------------------------------------------------

@register("lookup_venue", oracle.with_star("SELECT * FROM lookup_venue"))
def lookup_venue(spark, sf_dir):
    st, s = staged(spark, sf_dir), star(spark, sf_dir)
    p = st.publications.select("id", fx.clean_key("venue").alias("vk"))
    return dim_lookup(p, "vk", s.venue_series, "dblp_key", "venue_series_id", "venue_series_id").drop("vk")


@register("lookup_time", oracle.with_star("SELECT * FROM lookup_time"))
def lookup_time(spark, sf_dir):
    st, s = staged(spark, sf_dir), star(spark, sf_dir)
    return dim_lookup(st.publications.select("id", "year"), "year", s.timeinfo, "year", "time_id",
                      "time_id", unique=True).drop("year")


@register("lookup_author", oracle.with_star("SELECT * FROM lookup_author"))
def lookup_author(spark, sf_dir):
    st, s = staged(spark, sf_dir), star(spark, sf_dir)
    return dim_lookup(st.authors.select("id", "author"), "author", s.author, "name", "author_id",
                      "author_id", unique=True).drop("author")


@register("cite_counts", oracle.with_star("SELECT * FROM cite_counts"))
def cite_counts(spark, sf_dir):
    st = staged(spark, sf_dir)
    return count_matches(st.publications, "key", "id",
                         st.cites.select(fx.clean_key("cite").alias("cite")), "cite", "citings_dblp")


@register("join_left", oracle.with_records(f"""
SELECT p.id, p.key, c.title AS venue_title FROM bib_pub p
LEFT JOIN bib_col c ON c.key = {_CLEAN.format(c='p.venue')}"""))
def join_left_q(spark, sf_dir):
    st = staged(spark, sf_dir)
    p = st.publications.select("id", "key", fx.clean_key("venue").alias("vk"))
    c = st.collections.select(F.col("key").alias("vk"), F.col("title").alias("venue_title"))
    return join_left(p, c, "vk").drop("vk")


@register("join_inner", oracle.with_star("""
SELECT p.id, p.title, c.citings_dblp FROM bib_pub p JOIN cite_counts c ON c.id = p.id"""))
def join_inner_q(spark, sf_dir):
    return join_inner(staged(spark, sf_dir).publications.select("id", "title"),
                      cite_counts(spark, sf_dir), "id")


@register("join_full", oracle.with_records("""
SELECT coalesce(p.id, r.id) AS id, p.title, r.n_refs FROM bib_pub p
FULL JOIN (SELECT l_orderkey + 1 AS id, count(*) AS n_refs FROM lineitem GROUP BY 1) r ON r.id = p.id"""))
def join_full_q(spark, sf_dir):
    p = staged(spark, sf_dir).publications.select("id", "title")
    r = adapter.raw_cites(spark, sf_dir).groupBy("id").agg(F.count(F.lit(1)).alias("n_refs"))
    return join_full(p, r, "id").select("id", "title", "n_refs")


@register("join_right_distinct", oracle.with_star("""
SELECT DISTINCT b.publication_id, a.author_id, a.name FROM dim_author a
RIGHT JOIN bridge b ON a.author_id = b.author_id"""))
def join_right_distinct_q(spark, sf_dir):
    s = star(spark, sf_dir)
    return author_pub(s.author, s.bridge)


@register("join_three_way", oracle.with_star("""
SELECT t.id, t.title_id, tm.time_id, ty.type_id FROM dim_title_src t
JOIN lookup_time tm ON tm.id = t.id JOIN lookup_type ty ON ty.id = t.id"""))
def join_three_way_q(spark, sf_dir):
    st, s = staged(spark, sf_dir), star(spark, sf_dir)
    t = dim_lookup(st.publications.select("id", "type"), "type", s.document_type, "name", "type_id",
                   "type_id", unique=True).drop("type")
    # title ids per publication come from the dimension build itself
    tid = title_ids(st).select("id", "title_id")
    return join_three_way(tid, lookup_time(spark, sf_dir), t, "id").select("id", "title_id", "time_id",
                                                                          "type_id")


# --- PDI-style operators --------------------------------------------------

_WORDS = "[ \\n\\t]+"


@register("unique_ci", f"""
SELECT word, doc_id, pos FROM (
  SELECT word, doc_id, pos, row_number() OVER (PARTITION BY lower(word) ORDER BY doc_id, pos) AS rn FROM (
    SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos
    FROM (SELECT doc_id, string_split_regex(text, '{_WORDS}') AS w FROM documents)))
WHERE rn = 1""")
def unique_ci(spark, sf_dir):
    d = adapter.table(spark, sf_dir, "documents")
    w = d.select("doc_id", F.posexplode(F.split("text", _WORDS)).alias("pos", "word"))
    w = w.select("word", "doc_id", F.col("pos").cast("long").alias("pos"))
    return dedup.unique_rows(w, ["word"], ["doc_id", "pos"], case_insensitive=("word",))


@register("route_nulls", oracle.with_records("""
SELECT p.id, CASE WHEN c.cites IS NULL THEN 'rejected' ELSE 'good' END AS route
FROM bib_pub_all p LEFT JOIN bib_cites c ON c.id = p.id"""))
def route_nulls(spark, sf_dir):
    r = adapter.raw_publication_flags(spark, sf_dir).withColumn(
        "cites_ref", F.when(F.col("has_cites"), F.col("id")))
    good, rejected = routing.route_not_null(r, "cites_ref")
    return (good.select("id", F.lit("good").alias("route"))
            .unionByName(rejected.select("id", F.lit("rejected").alias("route"))))


@register("route_errors", oracle.with_records("""
SELECT p.id, CASE WHEN a.authors IS NULL THEN 'no_author' WHEN p.year <= 0 THEN 'bad_year' ELSE 'ok' END AS route
FROM bib_pub_all p LEFT JOIN bib_authors a ON a.id = p.id"""))
def route_errors(spark, sf_dir):
    r = adapter.raw_publication_flags(spark, sf_dir)
    return routing.route_errors(r, {"no_author": ~F.col("has_authors"),
                                    "bad_year": F.col("year") <= 0}).select("id", "route")


@register("sorted_multi_key", oracle.with_records(
    "SELECT type, year, key FROM bib_pub ORDER BY lower(type), year DESC, key"))
def sorted_multi_key(spark, sf_dir):
    p = staged(spark, sf_dir).publications
    return p.select("type", "year", "key").orderBy(F.lower("type"), F.desc("year"), "key")


@register("pdi_text_scan_limit", oracle.with_records(
    "SELECT id, type, key, title, year, venue, authors, cites FROM bib_pub ORDER BY id LIMIT 1000"))
def pdi_text_scan_limit(spark, sf_dir):
    pubs, _ = _write_staged_csv(spark, sf_dir)
    return csv.read_escaped(spark, pubs, STAGED_PUBLICATIONS, limit=1000, skip_empty=True)


# --- streaming import -----------------------------------------------------

@register("stream_dblp_import", oracle.with_records(_XML_PUBS))
def stream_dblp_import(spark, sf_dir):
    src = _dblp_dump(spark, sf_dir)
    target, ckpt = scratch_path(spark, "stream-staged"), scratch_path(spark, "stream-ckpt")
    run_dblp_import(spark, src, target, ckpt)
    return staged_tables(spark, target)[0].withColumnRenamed("id", "seq")


# --- outputs of the earlier ETL-tool transform ----------------------------


_PDI = oracle.with_records("""
, pa AS (SELECT id, unnest(string_split(authors, '|')) AS name FROM bib_pub),
pdi_authors AS (SELECT row_number() OVER (ORDER BY name) AS "AuthorID", name AS "Name"
                FROM (SELECT DISTINCT name FROM pa)),
pdi_titles AS (SELECT row_number() OVER (ORDER BY title) AS "TitleID", title AS "Title"
               FROM (SELECT DISTINCT title FROM bib_pub)),
pdi_types AS (SELECT row_number() OVER (ORDER BY lt) AS "TypeID", t AS "Type", lt
              FROM (SELECT lower(type) AS lt, min(type) AS t FROM bib_pub GROUP BY 1)),
pdi_years AS (SELECT row_number() OVER (ORDER BY year) AS "YearID", year AS "Year"
              FROM (SELECT DISTINCT year FROM bib_pub)),
pdi_pubs AS (SELECT row_number() OVER (ORDER BY lk) AS "PublicationID", lk
             FROM (SELECT DISTINCT lower(key) AS lk FROM bib_pub)),
pdi_publication AS (
  SELECT p.id AS "Id", p.key AS "PubKey", pp."PublicationID", t."TitleID", ty."TypeID", y."YearID", a."AuthorID"
  FROM bib_pub p JOIN pdi_pubs pp ON pp.lk = lower(p.key) JOIN pdi_titles t ON t."Title" = p.title
  JOIN pdi_types ty ON ty.lt = lower(p.type) JOIN pdi_years y ON y."Year" = p.year
  JOIN pa ON pa.id = p.id JOIN pdi_authors a ON a."Name" = pa.name),
pdi_map AS (SELECT row_number() OVER (ORDER BY "PublicationID", "AuthorID") AS "ID", "PublicationID", "AuthorID"
            FROM (SELECT DISTINCT "PublicationID", "AuthorID" FROM pdi_publication))
""".rstrip() + "\n{select}")


def _pdi(spark, sf_dir):
    st = staged(spark, sf_dir)
    return memo("pdi", spark, sf_dir, lambda: build_pdi(st.publications, st.authors))


def _pdi_files(spark, sf_dir) -> str:
    """The six files, written once per session and table folder."""
    def build():
        root = scratch_path(spark, "pdi")
        _pdi(spark, sf_dir).write(root)
        return root
    return memo("pdi-files", spark, sf_dir, build)


for _name, _file, _sel in [
    ("pdi_authors", "authors", 'SELECT * FROM pdi_authors'),
    ("pdi_titles", "titles", 'SELECT * FROM pdi_titles'),
    ("pdi_types", "types", 'SELECT "TypeID", "Type" FROM pdi_types'),
    ("pdi_years", "years", 'SELECT * FROM pdi_years'),
    ("pdi_publication", "publication", 'SELECT * FROM pdi_publication'),
    ("pdi_pub_author_map_file", "pubAuthorMap", "SELECT * FROM pdi_map"),
]:
    register(_name, _PDI.replace("{select}", _sel))(
        (lambda name: lambda spark, sf_dir: _pdi(spark, sf_dir).read(spark, _pdi_files(spark, sf_dir), name))(_file))


# --- external text tables over the star schema -----------------------------

@register("sql_q1_on_text_tables", oracle.with_star(oracle.OLAP["q1_pubs_per_author"]))
def sql_q1_on_text_tables(spark, sf_dir):
    """Star tables written as escaped CSV, registered as views, Q1 in SQL."""
    root = scratch_path(spark, "star-text")
    tb.save_star_escaped(star(spark, sf_dir).tables(), root)
    tb.register_star(spark, tb.load_star(spark, root, fmt="escaped"), prefix="txt_")
    return spark.sql("""
        SELECT a.name AS author_name, count(f.publication_id) AS num_pubs
        FROM txt_publication f JOIN txt_author a ON a.author_id = f.author_id
        GROUP BY a.name ORDER BY num_pubs DESC, author_name""")


# --- the analysis queries as SQL over registered views ----------------------

def _views(spark, sf_dir) -> str:
    """Register the star tables as temp views once per session and folder;
    returns the view-name prefix."""
    def build():
        prefix = "cc" + hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:8] + "_"
        tb.register_star(spark, star(spark, sf_dir).tables(), prefix=prefix)
        return prefix
    return memo("views", spark, sf_dir, build)


for _name in hiveql.SQL:
    register("sql_" + _name, oracle.with_star(oracle.OLAP[_name]))(
        (lambda n: lambda spark, sf_dir: hiveql.run(spark, n, _views(spark, sf_dir)))(_name))


# --- the same over stored tables, bucketed by author -------------------------

def _stored(spark, sf_dir) -> str:
    def build():
        prefix = "st" + hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:8] + "_"
        tb.store_star(spark, star(spark, sf_dir).tables(), scratch_path(spark, "stored"), prefix, buckets=8)
        return prefix
    return memo("stored", spark, sf_dir, build)


for _name in ("q1_pubs_per_author", "q3_max_cites_per_author", "q4_top_cited_authors"):
    register("stored_" + _name, oracle.with_star(oracle.OLAP[_name]))(
        (lambda n: lambda spark, sf_dir: hiveql.run(spark, n, _stored(spark, sf_dir)))(_name))
