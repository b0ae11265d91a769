"""Star schema on a hand-written fixture reaching the quirks the adapter
does not: duplicate keys, 'ref:' mid-string, decade 2005 -> 0, a repeated
author, a venue miss."""

from citecube.plans.star import build_star
from citecube.sources.adapter import Staged


def fixture(spark):
    pubs = spark.createDataFrame([
        (1, "article", "journals/a/X1", "T1", 1994, "ref:conf/p1"),
        (2, "article", "journals/a/X2", "T2", 2005, "J#1#2"),
        (3, "inproceedings", "journals/a/X1", "T1 dup", 2005, ""),   # duplicate key of 1
        (4, "article", "journals/a/X4", "T4", 2015, "Xref:conf/p1"),  # 'ref:' mid-string
    ], "id long, type string, key string, title string, year long, venue string")
    authors = spark.createDataFrame([
        (1, 0, "Ann"), (1, 1, "Bob"), (2, 0, "Bob"), (2, 1, "Bob"), (3, 0, "Cid"), (4, 0, "Ann"),
    ], "id long, pos long, author string")
    cites = spark.createDataFrame([
        (2, 0, "journals/a/X1"), (4, 0, "journals/a/X1"), (4, 1, "ref:journals/a/X2"),
        (4, 2, "journals/zz/none"),
    ], "id long, pos long, cite string")
    cols = spark.createDataFrame([(101, "proceedings", "conf/p1", "Proc 1")],
                                 "id long, type string, key string, title string")
    return Staged(pubs, authors, cites, cols)


def test_star_fixture(spark):
    s = build_star(fixture(spark))
    times = {r.year: (r.time_id, r.decade) for r in s.timeinfo.collect()}
    assert times == {1994: (1, 90), 2005: (2, 0), 2015: (3, 10)}
    assert {r.name: r.type_id for r in s.document_type.collect()} == {
        "article": 1, "inproceedings": 2, "proceedings": 3}
    assert {r.name: r.author_id for r in s.author.collect()} == {"Ann": 1, "Bob": 2, "Cid": 3}
    assert [tuple(r) for r in s.venue_series.collect()] == [(1, "Proc 1", "conf/p1")]
    titles = sorted(tuple(r) for r in s.title.collect())
    assert titles == [(1, "T1", "journals/a/X1"), (2, "T2", "journals/a/X2"),
                      (3, "T1 dup", "journals/a/X1"), (4, "T4", "journals/a/X4")]
    fact = sorted((r.publication_id, r.author_id, r.title_id, r.type_id, r.time_id,
                   r.venue_series_id, r.citings_dblp) for r in s.publication.collect())
    # publication 3 shares its key with 1 and disappears; Bob twice on 2 stays twice;
    # 'Xref:conf/p1' -> ':conf/p1' misses the venue.
    assert fact == [
        (1, 1, 1, 1, 1, 1, 2),
        (1, 2, 1, 1, 1, 1, 2),
        (2, 2, 2, 1, 2, -1, 1),
        (2, 2, 2, 1, 2, -1, 1),
        (4, 1, 4, 1, 3, -1, 0),
    ]
    bridge = sorted(tuple(r) for r in s.bridge.collect())
    assert bridge == [(1, 1), (1, 2), (2, 2), (3, 3), (4, 1)]


def test_lists_are_read_from_items_written_once(spark, tmp_path):
    from citecube.sources import adapter

    spark.createDataFrame([(1, 7, "P", "1-URGENT", "1997-02-03"), (2, 7, "F", "2-HIGH", None), (3, 8, "O", "5-LOW", "1998-01-01")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, d string").selectExpr(
        "* except (d)", "cast(d as date) as o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 5, 4, "N"), (1, 5, 3, "R"), (1, 6, 2, "A"), (2, 5, 1, "N"), (3, 9, 1, "N"), (None, 5, 1, "N")],
                          "l_orderkey long, l_suppkey long, l_partkey long, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(5, "a|b"), (6, None)], "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(7, "x", "y")], "c_custkey long, c_mktsegment string, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    st = adapter.staged(spark, str(tmp_path))
    assert [r.id for r in st.publications.collect()] == [2]      # one has no date, one no author
    assert sorted(map(tuple, st.authors.collect()), key=str) == [(2, 5, "a-b"), (2, 5, "a-b"), (2, 6, None)]
    assert sorted(map(tuple, st.cites.collect())) == [(2, 2, "orders/18"), (2, 4, "orders/36")]
    assert set(st.cites.inputFiles()) <= set(st.authors.inputFiles())
