"""Join semantics of the transform job: lookup, count, merge."""

from citecube.operators.lookup import count_matches, dim_lookup, merge_column


def test_dim_lookup_first_id_or_minus_one_never_multiplies(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "zz"), (4, "a")], "id long, k string")
    dim = spark.createDataFrame([(10, "a"), (11, "a"), (12, "b")], "did long, name string")
    got = sorted(dim_lookup(left, "k", dim, "name", "did", "out").select("id", "out").collect())
    assert [tuple(r) for r in got] == [(1, 10), (2, 12), (3, -1), (4, 10)]


def test_count_matches_first_id_zero_and_right_only(spark):
    left = spark.createDataFrame([(1, "k1"), (2, "k1"), (3, "k2")], "id long, key string")
    right = spark.createDataFrame([("k1",), ("k1",), ("k9",)], "cite string")
    got = sorted(tuple(r) for r in count_matches(left, "key", "id", right, "cite", "n").collect())
    assert got == [(1, 2), (3, 0)]


def test_merge_is_inner_and_multiplies(spark):
    fact = spark.createDataFrame([(1, -1), (2, -1)], "pid long, author_id long")
    m = spark.createDataFrame([(1, 7), (1, 8)], "pid long, aid long")
    got = sorted(tuple(r) for r in merge_column(fact, "pid", m, "pid", "aid", "author_id").collect())
    assert got == [(1, 7), (1, 8)]
