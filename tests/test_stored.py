"""External tables bucketed by author."""

from citecube.plans import hiveql
from citecube.session import scratch_path
from citecube.sources import tables as tb


def test_aggregates_by_author_need_no_exchange(spark):
    fact = spark.range(3000).selectExpr("id AS publication_id", "IF(id % 3 = 0, 7, id % 50) AS author_id", "id % 11 AS citings_dblp")
    author = spark.range(50).selectExpr("id AS author_id", "concat('A', id) AS name")
    tb.store_star(spark, {"publication": fact, "author": author}, scratch_path(spark, "t-stored"), "t_stored_", buckets=4)
    info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED t_stored_publication").collect()}
    assert info["Type"] == "EXTERNAL" and info["Num Buckets"] == "4" and "3000 rows" in info["Statistics"]
    for name in ("q1_pubs_per_author", "q3_max_cites_per_author", "q4_top_cited_authors"):
        df = hiveql.run(spark, name, "t_stored_")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(author_id" not in plan, plan
    got = {r.author_name: r.num_pubs for r in hiveql.run(spark, "q1_pubs_per_author", "t_stored_").collect()}
    assert got["A7"] == 1000 + sum(1 for i in range(3000) if i % 3 and i % 50 == 7) and sum(got.values()) == 3000
