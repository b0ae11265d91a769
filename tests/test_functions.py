"""Scalar rules: split/join of lists, key cleaning, decade, tolerant ints,
venue strings, trim."""

from pyspark.sql import functions as F

from citecube.functions import text as T


def one(spark, expr, data, schema="s string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("r")).collect()]


def test_split_list_java_semantics(spark):
    rows = [("a|b",), ("",), ("a||b|",), ("|a",), ("|",), ("|||",), ("a",)]
    got = one(spark, T.split_list("s"), rows)
    assert got == [["a", "b"], [""], ["a", "", "b"], ["", "a"], [], [], ["a"]]


def test_join_list_drops_leading_empties_and_escapes_pipes(spark):
    df = spark.createDataFrame([(["", "", "a", "", "b|c"],), (["x"],), ([],)], "a array<string>")
    got = [r[0] for r in df.select(T.join_list("a")).collect()]
    assert got == ["a||b-c", "x", ""]


def test_split_join_roundtrip(spark):
    df = spark.createDataFrame([(["A. B", "C|D", "E"],)], "a array<string>")
    got = df.select(T.split_list(T.join_list("a"))).first()[0]
    assert got == ["A. B", "C-D", "E"]


def test_clean_key_cuts_four_chars_when_ref_anywhere(spark):
    got = one(spark, T.clean_key("s"), [("ref:conf/x",), ("Xref: J#1#2",), ("conf/y",), ("",)])
    assert got == ["conf/x", ": J#1#2", "conf/y", ""]


def test_decade(spark):
    got = one(spark, T.decade("y"), [(1994,), (2005,), (2015,), (1900,), (1999,)], "y long")
    assert got == [90, 0, 10, 0, 90]


def test_safe_int_and_last_parseable(spark):
    got = one(spark, T.safe_int("s"), [("12",), (" 12",), ("+7",), ("-3",), ("19x3",), ("99999999999",)])
    assert got == [12, None, 7, -3, None, None]
    df = spark.createDataFrame([(["1993", "bad"],), (["x"],), (["1990", "1991"],), ([],)], "a array<string>")
    assert [r[0] for r in df.select(T.last_parseable_int("a")).collect()] == [1993, 0, 1991, 0]


def test_drop_placeholder(spark):
    df = spark.createDataFrame([(["a", "...", "b"],)], "a array<string>")
    assert df.select(T.drop_placeholder("a")).first()[0] == ["a", "b"]


def test_venue_string(spark):
    rows = [("conf/x", "J", 5, 5), (None, "IEEE Trans. Knowl. Data Eng.", 5, 5), (None, "J", 0, 3),
            (None, "J", 0, 0), (None, None, 4, 4)]
    df = spark.createDataFrame(rows, "c string, j string, v int, i int")
    got = [r[0] for r in df.select(T.venue_string("c", "j", "v", "i")).collect()]
    assert got == ["ref:conf/x", "IEEE Trans. Knowl. Data Eng.#5#5", "J#0#3", "J", ""]
    got = [r[0] for r in df.select(T.acm_venue_string(F.lit("A#B"), "v", "i")).collect()]
    assert got[:4] == ["A:B#5#5", "A:B#5#5", "A:B#0#3", "A#B"]


def test_volume_issue(spark):
    rows = [("Volume 12 , Issue 3 (May 1999)",), ("volume 12, issue 3 x",), ("VOLUME 1 , ISSUE 2 ",),
            ("nothing",), ("volume 1 , issue 2 x\ny",), ("volume 1 , issue 2 \nmore",)]
    df = spark.createDataFrame(rows, "s string")
    v, i = T.volume_issue("s")
    got = [(r[0], r[1]) for r in df.select(v, i).collect()]
    assert got == [(12, 3), (0, 0), (1, 2), (0, 0), (0, 0), (1, 2)]


def test_trim_ctl(spark):
    got = one(spark, T.trim_ctl("s"), [("\t\n VLDB \r\n",), ("a b",), ("",)])
    assert got == ["VLDB", "a b", ""]


def test_decode_entities(spark):
    from citecube.functions.entities import LATIN1_ENTITIES, decode_entities, sql_decode_chain
    rows = [("J&ouml;rg &amp; M&uuml;ller",), ("&amp;copy; &copy;",), ("&foo; & plain",), ("none",)]
    xml_kept = one(spark, decode_entities(F.col("s")), rows)
    assert xml_kept == ["Jörg &amp; Müller", "&amp;copy; ©", "&foo; & plain", "none"]
    html = one(spark, decode_entities(F.col("s"), include_predefined=True), rows)
    assert html == ["Jörg & Müller", "&copy; ©", "&foo; & plain", "none"]
    # the table is the Latin-1 block, built from a rule
    assert LATIN1_ENTITIES["eacute"] == "é" and LATIN1_ENTITIES["nbsp"] == " " and len(LATIN1_ENTITIES) == 96
    # the SQL chain used by the oracle gives the same text
    import duckdb
    for (src,), want in zip(rows, html):
        lit = src.replace("'", "''")
        assert duckdb.connect().execute(f"SELECT {sql_decode_chain(repr_sql(lit))}").fetchone()[0] == want


def repr_sql(lit):
    return f"'{lit}'"
