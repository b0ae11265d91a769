"""CSV dialects: the escaped round trip, typed
projection, quoted dialect, first-N conversion."""

import csv
import glob
import io
import os
import random

import pytest
from pyspark.sql import types as T

from citecube.session import scratch_path
from citecube.sources import csv_dialects as C
from citecube.sources import csv_scan as S

ROWS = [("north", "gate", 1, "one comma, here", 1001),
        ("south", "gate", 2, "two, commas, here", 1002),
        ("north", "yard", 3, "no comma here", 1003)]
SCHEMA = "name1 string, name2 string, id long, message string, epoch_s long"


def local(path):
    return path.replace("file:", "")


def test_escaped_projection_fixture(spark):
    src = scratch_path(spark, "f1")
    C.write_escaped(spark.createDataFrame(ROWS, SCHEMA), src, order_by="id")
    text = "".join(open(f).read() for f in sorted(glob.glob(local(src) + "/part-*")))
    assert text.splitlines() == [
        "north,gate,1,one comma\\, here,1001",
        "south,gate,2,two\\, commas\\, here,1002",
        "north,yard,3,no comma here,1003"]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name1", T.StringType()),
                           T.StructField("message", T.StringType())])
    proj = C.read_escaped(spark, src, schema, indices=[2, 0, 3], strict=True)
    out = scratch_path(spark, "f1-out")
    C.write_escaped(proj, out, order_by="id")
    text = "".join(open(f).read() for f in sorted(glob.glob(local(out) + "/part-*")))
    assert text.splitlines() == ["1,north,one comma\\, here",
                                 "2,south,two\\, commas\\, here",
                                 "3,north,no comma here"]


def test_typed_projection_f2(spark):
    df = spark.createDataFrame([("gate,22,1001,true,left over",)], "line string")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                           T.StructField("c", T.BooleanType())])
    from pyspark.sql import functions as F
    row = df.select(*C.typed_projection(C.parse_escaped(F.col("line")), [2, 0, 3], schema, strict=True)).first()
    assert tuple(row) == (1001, "gate", True)


def test_escapes_roundtrip_and_nulls(spark):
    rows = [(1, "a\\b", "x\\ny\nz\r,"), (2, None, "\\,"), (3, "", "trailing\\")]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    p = scratch_path(spark, "esc")
    C.write_escaped(df, p, order_by="id")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()),
                           T.StructField("b", T.StringType())])
    got = sorted(tuple(r) for r in C.read_escaped(spark, p, schema).collect())
    # NULL and "" both come back as "" (empty field = NULL, read as "")
    assert got == [(1, "a\\b", "x\\ny\nz\r,"), (2, "", "\\,"), (3, "", "trailing\\")]


def test_quoted_roundtrip_empty_reads_as_null(spark):
    rows = [(1, 'say "hi", ok', "multi\nline"), (2, None, ""), (3, "plain", " padded ")]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    p = scratch_path(spark, "quoted")
    C.write_quoted(df, p, order_by="id")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()),
                           T.StructField("b", T.StringType())])
    # the null string is "", so an empty value reads back as NULL (as in the
    # quoted dialect of the import); surrounding blanks are kept
    want = [(1, 'say "hi", ok', "multi\nline"), (2, None, None), (3, "plain", " padded ")]
    assert sorted(tuple(r) for r in C.read_quoted(spark, p, schema).collect()) == want


def test_convert_first_n_in_file_order(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "id long, v string")
    src, dst = scratch_path(spark, "conv-src"), scratch_path(spark, "conv-dst")
    C.write_escaped(df, src, order_by="id")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    C.convert(spark, src, dst, schema, "escaped-to-quoted", limit=7)
    assert sorted(r.id for r in C.read_quoted(spark, dst, schema).collect()) == list(range(7))
    assert os.path.isdir(local(dst))


def test_strict_projection_fails_on_bad_value(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("x1,2",)], "line string")
    for line in ("2", "2,", ""):      # short records and empty numbers fail as well
        short = spark.createDataFrame([(line,)], "line string")
        two = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
        with pytest.raises(Exception, match="field"):
            short.select(*C.typed_projection(C.parse_escaped(F.col("line")), [0, 1], two, strict=True)).collect()
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    with pytest.raises(Exception, match="cannot convert field 0"):
        df.select(*C.typed_projection(C.parse_escaped(F.col("line")), [0, 1], schema, strict=True)).collect()
    lenient = df.select(*C.typed_projection(C.parse_escaped(F.col("line")), [0, 1], schema)).first()
    assert tuple(lenient) == (None, 2)


def test_null_only_records_survive(spark):
    path = scratch_path(spark, "one-column")
    C.write_escaped(spark.createDataFrame([("a",), (None,), ("b",)], "v string"), path)
    one = T.StructType([T.StructField("v", T.StringType())])
    assert sorted(r.v for r in C.read_escaped(spark, path, one).collect()) == ["", "a", "b"]
    assert C.read_escaped(spark, path, one, skip_empty=True).count() == 2


def test_quoted_to_escaped_keeps_ragged_records(spark):
    src, dst = scratch_path(spark, "ragged"), scratch_path(spark, "ragged-out")
    text = 'a,b\nc,d,e\n"x","y,1",z\nonly\n"two\nlines",2\n"say ""so""",,\n'
    spark.createDataFrame([(text.rstrip("\n"),)], "value string").coalesce(1).write.text(src)
    C.convert_records(spark, src, dst, "quoted-to-escaped")
    got = sorted(tuple(r.fields) for r in C.read_escaped_fields(spark, dst).collect())
    assert got == sorted([("a", "b"), ("c", "d", "e"), ("x", "y,1", "z"), ("only",), ("two\nlines", "2"),
                          ('say "so"', None, None)])


def _text(spark, text, name="raw"):
    path = scratch_path(spark, name)
    os.makedirs(local(path))
    with open(os.path.join(local(path), "part-0.csv"), "w", newline="") as fh:
        fh.write(text)
    return path


def test_no_record_and_no_character_is_lost_between_the_dialects(spark):
    a, b, c = (scratch_path(spark, "loop") for _ in range(3))
    one = T.StructType([T.StructField("v", T.StringType())])
    C.write_escaped(spark.createDataFrame([("a",), (None,), ("b",)], "v string"), a)
    C.convert_records(spark, a, b, "escaped-to-quoted")
    C.convert_records(spark, b, c, "quoted-to-escaped")
    assert sorted(r.v for r in C.read_escaped(spark, c, one).collect()) == ["", "a", "b"]
    C.write_quoted(spark.createDataFrame([("a",), (None,), ('x "y"',)], "v string"), d := scratch_path(spark, "lone"))
    assert sorted((r.v for r in C.read_quoted(spark, d, one).collect()), key=str) == [None, "a", 'x "y"']


def test_rejects_have_reason_and_line(spark):
    text = '1,x,one\n2,"two\nlines",t\n"3" b,c,d\nx,y,z\n5,only\n\n7,"a" ,ok\n8,"never, closed\n9,z,z\n'
    path = _text(spark, text)
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    good, rejects = S.route(S.scan_quoted(spark, path), schema)
    assert sorted(map(tuple, good.collect())) == [(1, "x", "one"), (2, "two\nlines", "t"), (7, "a", "ok")]
    assert sorted((r.line, r.reason, r.raw) for r in rejects.collect()) == [
        (4, "text_after_quote", '"3" b,c,d'), (5, "bad_n", "x,y,z"), (6, "missing_field_2", "5,only"),
        (7, "missing_field_1", ""), (9, "unclosed_quote", '8,"never, closed'), (10, "unclosed_quote", "9,z,z")]
    with pytest.raises(Exception, match="text_after_quote"):
        C.read_quoted_fields(spark, _text(spark, '"a" b,c\n', "late")).collect()
    good, rejects = S.route(S.scan_escaped(spark, _text(spark, "1,a\\,b\r\n2\nz,q\n4,x\\\n", "esc")), T.StructType(schema.fields[:2]))
    assert sorted(map(tuple, good.collect())) == [(1, "a,b")]
    assert sorted((r.line, r.reason) for r in rejects.collect()) == [(2, "missing_field_1"), (3, "bad_n"), (4, "dangling_escape")]


def test_quoted_scan_of_many_splits_against_the_csv_module(spark, split=150):
    rng = random.Random(split)
    texts = ["", "plain", 'say "hi"', "two\nlines", "a,b", '"', '""\n""', "x" * 150, ",\n,", "\n\n\n", 'q"\n"q']
    records = [[str(i), *(rng.choice(texts) for _ in range(rng.randint(0, 4)))] for i in range(60)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(records)
    path = _text(spark, out.getvalue(), "many")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, split)
        rows = S.scan_quoted(spark, path).collect()
        first = C.read_quoted_fields(spark, path, limit=20).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = [[f or None for f in r] for r in records]
    assert len({r.block for r in rows}) > 5
    assert [r.fields for r in sorted(rows, key=lambda r: int(r.fields[0]))] == want and not any(r.reason for r in rows)
    assert [r.line for r in rows if r.fields[0] == "0"] == [1]
    assert sorted((r.fields for r in first), key=lambda f: int(f[0])) == want[:20]


def test_first_lines_leave_later_files_unread(spark):
    path = scratch_path(spark, "first")
    os.makedirs(local(path))
    for i in range(4):
        with open(os.path.join(local(path), f"part-{i}.csv"), "w") as fh:
            fh.write("".join(f"{i},{k}\n" for k in range(5)))
    got = S.first_lines(spark, path, 7)
    assert sorted(r.value for r in got.collect()) == sorted([f"0,{k}" for k in range(5)] + ["1,0", "1,1"])
    assert sorted(os.path.basename(f) for f in got.inputFiles()) == ["part-0.csv", "part-1.csv"]
    assert S.first_lines(spark, path, 100).count() == 20
