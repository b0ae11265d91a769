"""Bibliographic XML import as a parallel Spark scan.

The dump is one large document with many record elements, which no single
``rowTag`` covers.  Every record element carries a required ``key``
attribute, so the text source splits the files at `` key="`` (a custom line
separator keeps the scan splittable): each chunk holds one record's key,
the rest of its start tag, its body and its first end tag.  Where the separator
stands elsewhere (in a title, CDATA, a comment, another element's tag),
``xml_chunks`` puts the record together again; comments are taken out.  What
follows in the chunk (and all of a file's head) is searched for further whole
records: those whose key is written otherwise (single quotes, a line break
before it) or missing.  Fields are read with one ``from_xml`` parse per record
after markup is flattened and the named entities are decoded.  The dump is read
and parsed once: publications, collections and the records that are not
imported, with the reason, are parts of one written table (``dblp_table``).

Rules kept from the import:
* record types: publications (article, inproceedings, incollection) and
  collections (proceedings, book); everything else is skipped;
* repeated fields (author, cite) become lists, ``...`` cites are dropped;
* scalar fields: the last occurrence wins; year/volume/number keep the last
  value that parses as an integer (0 when none);
* journal and booktitle share one slot: the later one in document order;
* markup inside a title is flattened to its text;
* complete publication = key, title, year > 0 and at least one author;
  complete collection = key and title.
Known difference: a whitelisted element nested inside another one is read
on its own instead of taking over the outer element's text.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.entities import decode_entities, xml_escape
from ..functions.text import (acm_venue_string, drop_placeholder, join_list, last_parseable_int,
                              trim_ctl, venue_string, volume_issue, VOLUME_ISSUE_PATTERN)
from ..session import materialize
from ..schemas import ALL_RECORD_TYPES, COLLECTION_TYPES, DTD_FIELDS, PUBLICATION_TYPES
from .xml_chunks import judge_chunks, number_by_place, read_chunks, whole_records

KEY_SEP = ' key="'
WHERE = ["file", "src", "block", "place"]
_TYPES = "|".join(ALL_RECORD_TYPES)
# Inline elements allowed inside a title by the DTD.
TITLE_MARKUP = ("sub", "sup", "i", "tt", "ref")
_MARKUP_RE = r"</?(?:" + "|".join(TITLE_MARKUP) + r")(?:\s[^>]*)?/?>"

DBLP_FIELDS_SCHEMA = ("author array<string>, title array<string>, year array<string>, "
                      "journal array<string>, booktitle array<string>, volume array<string>, "
                      "number array<string>, crossref array<string>, cite array<string>, _corrupt string")
ACM_FIELDS_SCHEMA = ("Title array<string>, Venue array<struct<_year: string, _VALUE: string>>, "
                     "VenueSeries array<string>, Name array<string>, CitingPub array<string>, _corrupt string")
_XML_OPTS = {"rowTag": "r", "ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE",
             "columnNameOfCorruptRecord": "_corrupt"}


def _last(arr: Column) -> Column:
    return F.try_element_at(arr, F.lit(-1))


def dblp_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks as read, with every record whole in one of them."""
    return whole_records(chunks, judge_chunks(chunks, ALL_RECORD_TYPES), KEY_SEP)


def parse_dblp_chunks(chunks: DataFrame) -> DataFrame:
    """chunk -> (file, src, block, place, sub, type, key, body, raw), one row per
    record; a record without an end tag has an empty type."""
    # a generator, so that what is used many times below is searched for once
    chunks = _once(chunks, [*WHERE, "chunk"], head=F.col("chunk").rlike(r"^\s*<"),
                   first=F.regexp_extract("chunk", r"(?s)^[^\"]*\"[^>]*>.*?</(?:" + _TYPES + ")>", 0))
    head, first = F.col("head"), F.col("first")
    rest = F.when(head, F.col("chunk")).when(first != "", F.substring("chunk", F.length(first) + 1, F.length("chunk"))
                                             ).otherwise(F.lit(""))
    more = F.transform(F.regexp_extract_all(rest, F.lit(r"(?s)<(" + _TYPES + r")(?:\s[^>]*)?>.*?</\1>"), F.lit(0)),
                       lambda m: F.struct(
                           F.regexp_extract(m, r"^<(\w+)", 1).alias("type"),
                           F.regexp_extract(m, r"^<[^>]*?\skey\s*=\s*([\"'])(.*?)\1", 2).alias("key"),
                           F.regexp_extract(m, r"(?s)^<[^>]*>(.*)</\w+>$", 1).alias("body"), m.alias("raw")))
    own = F.array(F.struct(
        F.regexp_extract(F.substring_index(first, "</", -1), r"^(\w+)>$", 1).alias("type"),
        F.regexp_extract("chunk", r"^([^\"]*)\"", 1).alias("key"),
        F.regexp_extract(first, r"(?s)^[^\"]*\"[^>]*>(.*)</\w+>$", 1).alias("body"),
        F.when(first != "", first).otherwise(F.col("chunk")).alias("raw")))
    found = _once(chunks, WHERE, found=F.concat(F.when(head, F.slice(own, 1, 0)).otherwise(own), more))
    return found.select(*WHERE, F.posexplode("found").alias("sub", "r")).select(*WHERE, "sub", "r.*")


def _once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """Columns worked out once a row.  A generator (``inline``) is a projection
    barrier: in a collapsed projection each use would work them out again."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _parse_once(df: DataFrame, keep: list[str], schema: str) -> DataFrame:
    """Parse each record once and expand the fields to columns, past a generator
    again.  Markup is flattened while entities are still encoded: a literal
    ``&lt;i&gt;`` is text and stays."""
    df = _once(df, keep, flat=F.regexp_replace("body", _MARKUP_RE, ""))
    text = F.concat(F.lit("<r>"), decode_entities(F.col("flat")), F.lit("</r>"))
    return df.select(*keep, F.inline(F.array(F.from_xml(text, schema, _XML_OPTS))))


def dblp_fields(records: DataFrame) -> DataFrame:
    """Typed fields of parsed DBLP records (all record types)."""
    # anchored: an unanchored leading ".*" is retried from every position (quadratic)
    later = F.when(F.contains("body", F.lit("<booktitle")), F.regexp_extract(
        "body", r"(?s)^.*<(journal|booktitle)[\s>]", 1)).otherwise("journal").alias("later")
    f = _parse_once(records.select(*WHERE, "sub", "type", "key", "body", "raw", later),
                    [*WHERE, "sub", "type", "key", "raw", "later"], DBLP_FIELDS_SCHEMA)
    journal = F.when(F.col("later") == "booktitle", _last(F.col("booktitle"))).otherwise(_last(F.col("journal")))
    return f.select(
        *WHERE, "sub", "type", "raw", F.col("_corrupt").isNotNull().alias("malformed"), F.when(F.col("key") != "", F.col("key")).alias("key"),
        _last(F.col("title")).alias("title"),
        last_parseable_int(F.coalesce(F.col("year"), F.array())).cast("long").alias("year"),
        journal.alias("journal"),
        _last(F.col("crossref")).alias("crossref"),
        last_parseable_int(F.coalesce(F.col("volume"), F.array())).alias("volume"),
        last_parseable_int(F.coalesce(F.col("number"), F.array())).alias("issue"),
        F.coalesce(F.col("author"), F.array().cast("array<string>")).alias("authors"),
        drop_placeholder(F.coalesce(F.col("cite"), F.array().cast("array<string>"))).alias("cites"))


def dblp_judged(chunks: DataFrame) -> DataFrame:
    """Typed records of the imported kinds, each with the reason why it is not
    imported (null: it is)."""
    parsed = parse_dblp_chunks(chunks)
    f = dblp_fields(parsed.filter(F.col("type").isin(*PUBLICATION_TYPES, *COLLECTION_TYPES, "")))
    is_pub = F.col("type").isin(*PUBLICATION_TYPES)
    reason = (F.when(F.col("type") == "", "unclosed_record").when(F.col("malformed"), "malformed_record")
              .when(F.col("key").isNull(), "missing_key").when(F.col("title").isNull(), "missing_title")
              .when(is_pub & ~F.coalesce(F.col("year") > 0, F.lit(False)), "missing_year")
              .when(is_pub & (F.size("authors") == 0), "missing_author"))
    return f.withColumn("reason", reason).withColumn("is_pub", is_pub)


def dblp_rows(chunks: DataFrame) -> DataFrame:
    """Every record of the imported kinds in one frame: place, ``kind``
    (publication, collection, reject), the staged columns, and for a reject its
    reason and raw text."""
    f, is_pub, good = dblp_judged(chunks), F.col("is_pub"), F.col("reason").isNull()
    kind = F.when(~good, "reject").when(is_pub, "publication").otherwise("collection")
    return f.select(
        *WHERE, "sub", kind.alias("kind"), "type", "key", "title", F.when(is_pub, F.col("year")).alias("year"),
        F.when(is_pub, venue_string("crossref", "journal", "volume", "issue")).alias("venue"),
        F.when(is_pub, join_list("authors")).alias("authors"),
        F.when(is_pub, join_list("cites")).alias("cites"), "reason", F.when(~good, F.col("raw")).alias("raw"))


KINDS = ("publication", "collection", "reject")


def counted_rows(chunks: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """``dblp_rows``, written once, and the number of records of each kind and
    of each reject reason, taken on the way."""
    rows, seen = dblp_rows(dblp_chunks(chunks)), Observation()
    many = [F.count(F.when(F.col("kind") == k, 1)).alias(k) for k in KINDS]
    many += [F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in REASONS]
    rows = materialize(rows.observe(seen, *many), "xml-rows")
    return rows, {k: n for k, n in seen.get.items() if n or k in KINDS}


# The reasons of ``dblp_judged``.
REASONS = ("unclosed_record", "malformed_record", "missing_key", "missing_title", "missing_year", "missing_author")


def dblp_table(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, int]]:
    """All records of the XML files under ``path`` and their counts, in one pass."""
    return counted_rows(read_chunks(spark, path, KEY_SEP))


PUB_COLUMNS = ["type", "key", "title", "year", "venue", "authors", "cites"]
COL_COLUMNS = ["type", "key", "title"]


def dblp_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(reason, type, key, raw) of every record that the import leaves out."""
    return rejects_of(dblp_table(spark, path)[0])


def rejects_of(rows: DataFrame) -> DataFrame:
    return rows.where("kind = 'reject'").select("reason", "type", "key", "raw")


def split_kinds(rows: DataFrame, with_seq: bool = False) -> tuple[DataFrame, DataFrame]:
    """(publications, collections) of ``dblp_rows``, numbered by place if asked."""
    out = []
    for kind, columns in (("publication", PUB_COLUMNS), ("collection", COL_COLUMNS)):
        mine = rows.where(F.col("kind") == kind)
        out.append(number_by_place(mine).select("seq", *columns) if with_seq else mine.select(*columns))
    return out[0], out[1]


def dblp_import(spark: SparkSession, path: str, with_seq: bool = True) -> tuple[DataFrame, DataFrame]:
    """(publications, collections) staged rows from DBLP XML files.

    publications: [seq], type, key, title, year, venue, authors, cites
    collections:  [seq], type, key, title

    ``seq`` counts the records of a kind in the order in which they stand."""
    return split_kinds(dblp_table(spark, path)[0], with_seq)


_QUALITY_SCHEMA = "title array<string>, _corrupt string"
_QUALITY_OPTS = dict(_XML_OPTS, columnNameOfCorruptRecord="_corrupt")


def quality_report(spark: SparkSession, path: str) -> DataFrame:
    """Validation against the DTD content model, as counts per rule:
    unclosed record, missing key, unknown child field, malformed record (not
    well-formed XML; the import drops it as incomplete), and elements that carry
    a key but are no record."""
    chunks = read_chunks(spark, path, KEY_SEP)
    judged = materialize(judge_chunks(chunks, ALL_RECORD_TYPES), "xml-judged")
    p = parse_dblp_chunks(whole_records(chunks, judged, KEY_SEP))
    rec = F.concat(F.lit("<r>"), decode_entities(F.col("body")), F.lit("</r>"))
    p = p.select("type", "key", "body",
                 F.inline(F.array(F.from_xml(rec, _QUALITY_SCHEMA, _QUALITY_OPTS))))
    children = F.regexp_extract_all(F.regexp_replace("body", r"(?s)<!\[CDATA\[.*?\]\]>", ""), F.lit(r"<([A-Za-z][\w.-]*)[\s>/]"), F.lit(1))
    allowed = F.array(*[F.lit(x) for x in DTD_FIELDS + TITLE_MARKUP])
    unknown = F.size(F.array_except(children, allowed)) > 0
    rules = F.array(
        F.when(F.col("type") == "", F.lit("unclosed_record")),
        F.when((F.col("type") != "") & (F.col("key") == ""), F.lit("missing_key")),
        F.when((F.col("type") != "") & unknown, F.lit("unknown_field")),
        F.when((F.col("type") != "") & F.col("_corrupt").isNotNull(), F.lit("malformed_record")))
    flagged = p.select(F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("rule"))
    flagged = flagged.union(judged.where("mode = 0 AND NOT head AND opened != ''").select(F.lit("unknown_element")))
    return flagged.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


# --- ACM -------------------------------------------------------------------

ACM_SEP = "<Publication"
# Elements other than these are taken away around their content, so the
# fields are found at any depth.
_ACM_WRAPPERS = r"</?(?!(?:Title|Venue|VenueSeries|Name|CitingPub)[\s/>])[A-Za-z][\w.-]*(?:\s[^>]*)?/?>"


def acm_import(spark: SparkSession, path: str, with_seq: bool = True) -> DataFrame:
    """ACM staged rows: [seq], source_id, title, year, venue, authors, num_citings."""
    chunks = read_chunks(spark, path, ACM_SEP)
    rec = r"(?s)^[^>]*>(.*)</Publication>"
    where = [*WHERE, F.lit(0).alias("sub")]
    p = chunks.filter(F.col("chunk").rlike(r"^[\s>]")).select(
        *where,
        F.regexp_extract("chunk", r"^[^>]*?\sid\s*=\s*([\"'])(.*?)\1", 2).alias("source_id"),
        F.regexp_replace(F.regexp_extract("chunk", rec, 1), _ACM_WRAPPERS, "").alias("body"),
        F.col("chunk").rlike(r"</Publication>").alias("closed")).filter("closed")
    f = _parse_once(p, [*WHERE, "sub", "source_id"], ACM_FIELDS_SCHEMA)
    venues = F.coalesce(F.col("Venue"), F.array())
    year = last_parseable_int(F.transform(venues, lambda v: v["_year"]))
    matching = F.filter(F.transform(venues, lambda v: v["_VALUE"]), lambda t: t.rlike(VOLUME_ISSUE_PATTERN))
    vol, iss = volume_issue(F.coalesce(_last(matching), F.lit("")))
    series = trim_ctl(_last(F.col("VenueSeries")))
    authors = F.coalesce(F.col("Name"), F.array().cast("array<string>"))
    out = (f.select(*WHERE, "sub", F.when(F.col("source_id") != "", F.col("source_id")).alias("source_id"),
                    _last(F.col("Title")).alias("title"),
                    year.cast("long").alias("year"), acm_venue_string(series, vol, iss).alias("venue"),
                    authors.alias("a"), F.size(F.coalesce(F.col("CitingPub"), F.array())).cast("long")
                    .alias("num_citings"))
           .filter(F.col("source_id").isNotNull() & F.col("title").isNotNull() & (F.col("year") > 0)
                   & (F.size("a") > 0))
           .select(*WHERE, "sub", "source_id", "title", "year", "venue", join_list("a").alias("authors"), "num_citings"))
    columns = ["source_id", "title", "year", "venue", "authors", "num_citings"]
    if with_seq:
        return number_by_place(materialize(out, "acm-rows")).select("seq", *columns)
    return out.select(*columns)


# --- rendering the driver's tables as bibliographic XML --------------------
# The tables carry no XML; these writers produce a dump of the same shape so
# the import runs on data that grows with the tables.  One record element
# per row (the element text is built from that row's own lists).

# Places in the rendered dump: orders by their key, then customers, then suppliers.
COLLECTIONS_FROM, HOMEPAGES_FROM = 2**41, 2**42
RECORDS_PER_FILE = 100_000
FILLED = 0.9    # of a file's records, about, so that few ranges need a second one
# Record element per order priority in the rendered dump.
PRIORITY_TYPES = {"1-URGENT": "article", "2-HIGH": "inproceedings", "3-MEDIUM": "incollection",
                  "4-NOT SPECIFIED": "phdthesis", "5-LOW": "www"}


def _elems(tag: str, arr: Column) -> Column:
    return F.array_join(F.transform(arr, lambda x: F.concat(F.lit(f"<{tag}>"), xml_escape(x), F.lit(f"</{tag}>\n"))), "")


def render_dblp_publications(raw: DataFrame) -> DataFrame:
    """raw: o_orderkey, o_custkey, o_orderstatus, o_orderpriority, year, month, day,
    authors ARRAY, cites ARRAY (placeholders kept)."""
    tmap = F.create_map(*[x for k, v in PRIORITY_TYPES.items() for x in (F.lit(k), F.lit(v))])
    t = F.element_at(tmap, F.col("o_orderpriority"))
    k = F.col("o_orderkey").cast("string")
    status = F.col("o_orderstatus")
    venue = (F.when(status == "P", F.concat(F.lit("<crossref>cust/"), F.col("o_custkey").cast("string"),
                                            F.lit("</crossref>\n")))
             .when(status == "F", F.concat(F.lit("<booktitle>Companion</booktitle>\n<journal>"),
                                           xml_escape(F.col("o_orderpriority")), F.lit("</journal>\n<volume>"),
                                           F.col("month").cast("string"), F.lit("</volume>\n<number>"),
                                           F.col("day").cast("string"), F.lit("</number>\n")))
             .otherwise(F.lit("<ee>https://example.org/</ee>\n<extra>unlisted</extra>\n")))
    bad_year = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("<year>n/a</year>\n")).otherwise(F.lit(""))
    form = F.pmod(F.xxhash64("o_orderkey"), F.lit(7))  # other legal ways to write the key, for some rows
    text = F.concat(
        F.lit("<"), t, F.lit(' mdate="2016-01-01"'),
        F.when(form == 3, F.concat(F.lit(" key='orders/"), k, F.lit("'")))
        .when(form == 5, F.concat(F.lit('\nkey="orders/'), k, F.lit('"')))
        .otherwise(F.concat(F.lit(' key="orders/'), k, F.lit('"'))), F.lit(">\n"),
        _elems("author", F.coalesce(F.col("authors"), F.array().cast("array<string>"))),
        F.lit("<title>Order&nbsp;<i>"), k, F.lit("</i>"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(' with key="v" in its title')).otherwise(F.lit("")), F.lit("</title>\n"),
        F.when(form == 4, F.lit('<note><![CDATA[was <article key="none">]]></note>\n')).otherwise(F.lit("")),
        F.lit("<year>"), F.col("year").cast("string"), F.lit("</year>\n"), bad_year, venue,
        _elems("cite", F.coalesce(F.col("cites"), F.array().cast("array<string>"))),
        F.lit("</"), t, F.lit(">"))
    return raw.select(_hidden(form, k, t, text).alias("value"), F.col("o_orderkey").cast("long").alias("o"))


def _hidden(form: Column, key: Column, kind: Column, text: Column) -> Column:
    """Before some records, comments that hold one or several records."""
    old = F.concat(F.lit("<"), kind, F.lit(' mdate="2015-01-01" key="old/'), key, F.lit('"><title>Old</title></'), kind, F.lit(">\n"))
    return (F.when(form == 1, F.concat(F.lit("<!-- withdrawn "), old, F.lit("-->\n"), text))
            .when(form == 2, F.concat(F.lit("<!--"), old, old, old, F.lit("-->\n"), text)).otherwise(text))


def render_dblp_collections(customers: DataFrame) -> DataFrame:
    return customers.select(F.concat(
        F.lit('<proceedings mdate="2016-01-01" key="cust/'), F.col("c_custkey").cast("string"),
        F.lit('">\n<title>'), xml_escape(F.col("c_name")), F.lit("</title>\n</proceedings>")).alias("value"),
        (F.col("c_custkey") + COLLECTIONS_FROM).cast("long").alias("o"))


def render_dblp_homepages(suppliers: DataFrame) -> DataFrame:
    return suppliers.select(F.concat(
        F.lit('<www mdate="2016-01-01" key="homepages/'), F.col("s_suppkey").cast("string"),
        F.lit('">\n<author>'), xml_escape(F.col("s_name")), F.lit("</author>\n<title>Home Page</title>\n</www>"))
        .alias("value"), (F.col("s_suppkey") + HOMEPAGES_FROM).cast("long").alias("o"))


def render_acm(raw: DataFrame) -> DataFrame:
    k = F.col("o_orderkey").cast("string")
    nested = F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == 0  # some rows nest their lists

    def wrap(tag: str, inner: Column) -> Column:
        return F.when(nested, F.concat(F.lit(f"<{tag}><Group>"), inner, F.lit(f"</Group></{tag}>"))).otherwise(inner)

    cited = F.filter(F.coalesce(F.col("cites"), F.array().cast("array<string>")), lambda c: c != "...")
    text = F.concat(
        F.when(nested, F.concat(F.lit("<Publication\nid='orders/"), k, F.lit("'>\n")))
        .otherwise(F.concat(F.lit('<Publication id="orders/'), k, F.lit('">\n'))), F.lit('<Title>Order <i>'), k, F.lit("</i></Title>\n"),
        F.lit('<Venue year="'), F.col("year").cast("string"), F.lit('">Volume '), F.col("month").cast("string"),
        F.lit(" , Issue "), F.col("day").cast("string"), F.lit(" ("), F.col("o_orderstatus"), F.lit(")</Venue>\n"),
        F.lit("<VenueSeries>\t"), xml_escape(F.col("o_orderpriority")), F.lit(" #1 </VenueSeries>\n"),
        wrap("Authors", _elems("Name", F.coalesce(F.col("authors"), F.array().cast("array<string>")))),
        wrap("Citings", _elems("CitingPub", cited)), F.lit("</Publication>"))
    return raw.select(text.alias("value"), F.col("o_orderkey").cast("long").alias("o"))


def write_xml(parts: list[DataFrame], path: str, head: str, tail: str) -> None:
    """Write record texts (value, o) as XML part files in the order of ``o``;
    the head line opens the first file and the tail line closes the last.  The
    files are compressed and hold RECORDS_PER_FILE records at most: each is one
    split of the import, so a larger dump has more of them.

    The places alone tell where a file ends, so no text is rendered to sample
    them, and a task sorts about one file."""
    spark = parts[0].sparkSession
    body = parts[0]
    for p in parts[1:]:
        body = body.unionByName(p)
    many = body.select("o").agg(F.count(F.lit(1))).first()[0]
    n = max(spark.sparkContext.defaultParallelism, math.ceil(many / (FILLED * RECORDS_PER_FILE)))
    found = body.select("o").agg(F.percentile_approx("o", [i / n for i in range(1, n)], max(10_000, 20 * n))).first()[0] if n > 1 else []
    cuts = sorted({float(x) for x in found or []})
    lo, hi = -(2 ** 63), 2 ** 63 - 1
    framed = (spark.createDataFrame([(head, lo)], "value string, o long")
              .unionByName(body)
              .unionByName(spark.createDataFrame([(tail, hi)], "value string, o long")))
    # a place in no range (null) stands first, as in the order of the places
    framed = framed.withColumn("place", F.coalesce("o", F.lit(lo)).cast("double"))
    framed = Bucketizer(splits=[-math.inf, *(cuts or [0.0]), math.inf], inputCol="place", outputCol="part").transform(framed)
    (framed.select("value", "o", F.col("part").cast("int").alias("part")).repartitionById(max(2, len(cuts) + 1), "part")
     .sortWithinPartitions("o").select("value")
     .write.mode("overwrite").option("lineSep", "\n").option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))
