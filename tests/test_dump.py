"""The rendered dump: texts are rendered once, line items are moved once."""

import math

from citecube.session import scratch_path
from citecube.sources import adapter, xml_records


def _rows(spark, root, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")


def test_texts_are_rendered_once_in_the_order_of_their_places(spark):
    from pyspark.sql import functions as F

    calls = spark.sparkContext.accumulator(0)

    def render(o):
        calls.add(1)
        return f'<article key="a/{o}"><author>n</author><title>t{o}</title><year>1999</year></article>'

    body = spark.range(200).select(((F.col("id") * 77) % 200).alias("o")).repartition(5)
    body = body.select(F.udf(render, "string")("o").alias("value"), "o")
    path = scratch_path(spark, "t-dump")
    xml_records.write_xml([body], path, "<dblp>", "</dblp>")
    assert calls.value == 200
    got = xml_records.dblp_import(spark, path)[0].select("seq", "key").collect()
    assert sorted(map(tuple, got)) == [(i + 1, f"a/{i}") for i in range(200)]


def test_empty_and_equal_places(spark):
    for rows in ([], [('<article key="k"><author>n</author><title>t</title><year>1999</year></article>', 7)] * 30):
        path = scratch_path(spark, "t-dump")
        xml_records.write_xml([spark.createDataFrame(rows, "value string, o long")], path, "<dblp>", "</dblp>")
        assert xml_records.dblp_import(spark, path)[0].count() == len(rows)


def test_a_task_sorts_about_one_file(spark, monkeypatch):
    monkeypatch.setattr(xml_records, "RECORDS_PER_FILE", 10)
    many = 20 * spark.sparkContext.defaultParallelism
    body = spark.range(many).selectExpr("concat('<a>', id, '</a>') as value", "id as o")
    path = scratch_path(spark, "t-dump")
    xml_records.write_xml([body], path, "<dblp>", "</dblp>")
    parts = {f.rsplit("/", 1)[1].split("-")[1] for f in spark.read.text(path).inputFiles()}
    assert len(parts) == math.ceil(many / 9)


def test_line_items_are_read_once_for_both_lists(spark):
    root = scratch_path(spark, "t-tables")
    _rows(spark, root, "orders", [(1, 5, "P", "1-URGENT"), (2, 5, "O", "5-LOW"), (3, 5, "F", "2-HIGH")],
          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string")
    orders = spark.read.parquet(f"{root}/orders.parquet").selectExpr("*", "date'2001-02-03' as o_orderdate")
    orders.write.parquet(f"{root}/d/orders.parquet")
    _rows(spark, f"{root}/d", "supplier", [(10, "s|a"), (10, "b"), (11, None)], "s_suppkey long, s_name string")
    _rows(spark, f"{root}/d", "lineitem", [(1, 10, 4, "N"), (1, 11, 3, "R"), (1, 10, 4, "N"), (2, 99, 1, "N"), (None, 10, 1, "N")],
          "l_orderkey long, l_suppkey long, l_partkey long, l_returnflag string")
    found = adapter.order_records(spark, f"{root}/d")
    # a repeated supplier repeats the author only; an unknown one is none
    assert {r.o_orderkey: (r.authors, r.cites) for r in found.collect()} == {
        1: (["b", "b", "s-a", "s-a", None], ["...", "orders/36", "orders/36"]), 2: (None, ["orders/9"]), 3: (None, None)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_returnflag") and plan.count("Relation [l_orderkey") == 1
