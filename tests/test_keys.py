"""Surrogate keys equal row_number() by the natural key, across partitions."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from citecube.operators.keys import dense_ids


def test_dense_ids_match_row_number(spark):
    rnd = random.Random(7)
    rows = [(f"name{rnd.randint(0, 10**6):07d}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, i long").repartition(5)
    got = dense_ids(df, ["k", "i"], "id", num_partitions=7).select("k", "i", "id")
    want = df.withColumn("id", F.row_number().over(Window.orderBy("k", "i")).cast("long"))
    assert sorted(got.collect()) == sorted(want.collect())
    ids = [r.id for r in got.collect()]
    assert sorted(ids) == list(range(1, 3001))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=-1000, max_value=1000), min_size=0, max_size=60, unique=True),
       st.integers(min_value=1, max_value=9))
def test_dense_ids_property(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = sorted((r.v, r.id) for r in dense_ids(df, ["v"], "id", num_partitions=parts).collect())
    assert got == [(v, i + 1) for i, v in enumerate(sorted(values))]


def test_dense_ids_default_partitioning(spark):
    rows = [(f"k{(i * 7919) % 5000:05d}", i) for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, i long").repartition(6)
    got = dense_ids(df, ["k", "i"], "id").select("k", "i", "id")
    want = df.withColumn("id", F.row_number().over(Window.orderBy("k", "i")).cast("long"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_result_is_a_plain_scan(spark):
    """Joins with a dimension are planned from its own size: there is no join in it."""
    df = spark.createDataFrame([(i,) for i in range(50)], "v long")
    got = dense_ids(df, ["v"], "id", num_partitions=5, first_id=3)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [(i, i + 3) for i in range(50)]
    assert dense_ids(df.limit(0), ["v"], "id").collect() == []
