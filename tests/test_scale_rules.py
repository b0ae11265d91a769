"""Rules that keep results whole: no caps, no listing of local folders, a
shared folder off local mode, hot keys split, pruned cuboids."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citecube import session
from citecube.operators.lookup import dim_lookup
from citecube.operators.registry import KeyRegistry
from citecube.plans import cube as cube_plan
from citecube.plans import lattice, olap
from citecube.sources import tables
from citecube.sources import xml_records as xml
from citecube.sources.xml_chunks import join_pieces


def _fact(spark, rows):
    return spark.createDataFrame(rows, "publication_id long, author_id long, time_id long, type_id long, citings_dblp long")


def test_all_ids_of_a_name_count(spark):
    author = spark.createDataFrame([(i, "same" if i < 5 else f"n{i}") for i in range(8)], "author_id long, name string")
    time = spark.createDataFrame([(1, 2000)], "time_id long, year long")
    fact = _fact(spark, [(i, i, 1, 1, i) for i in range(8)])
    t = olap.Tables(fact, author, time)
    assert olap.q9_pubs_of_author_name(t, "same").first().num_pubs == 5
    assert olap.q10_pubs_of_author_name_year(t, "same", 2000).first().num_pubs == 5
    cube = cube_plan.build_cube(fact)
    assert cube_plan.cq9(cube, author, time, "same").first().num_pubs == 5


def test_saved_tables_stand_in_a_manifest(spark, monkeypatch):
    root = session.scratch_path(spark, "manifest")
    author = spark.createDataFrame([(1, "a")], "author_id long, name string")
    tables.save_star({"author": author}, root)
    monkeypatch.setattr(os.path, "isdir", lambda p: False)   # as for a store that is not a local folder
    got = tables.load_star(spark, root)
    assert list(got) == ["author"] and got["author"].collect() == author.collect()


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return self

        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_hot_lookup_key_is_split(spark):
    conf = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 2 == 0, "").otherwise(F.col("id").cast("string")).alias("k"),
                                                   F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        dim = spark.range(0, 60_000, 1, 4).select(F.when(F.col("id") == 0, "").otherwise(F.col("id").cast("string")).alias("key"),
                                                  F.col("id").alias("kid"))
        out = dim_lookup(left, "k", dim, "key", "kid", "found")
        assert out.count() == 60_000
        rows = out.select("found", "pad")
        rows.write.format("noop").mode("overwrite").save()
        plan = rows
        plan.collect()
        assert "skew=true" in plan._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_cuboid_reads_are_pruned(spark):
    path = session.scratch_path(spark, "cube")
    cube_plan.write_cube(cube_plan.build_cube(_fact(spark, [(i, i % 50, i % 3, 1, i) for i in range(500)])), path)
    plan = cube_plan.cq5(spark.read.parquet(path), None, None, 7)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(gid" in plan and "EqualTo(author_id,7)" in plan


def test_the_cube_expands_grouped_rows(spark):
    fact = _fact(spark, [(i, i % 3, None if i % 5 == 0 else 1, i % 2, None if i % 7 == 0 else i) for i in range(40)] + [(None, 1, 1, 1, 9)])
    cube = cube_plan.build_cube(fact)
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan[plan.index("Expand"):]
    want = fact.cube("author_id", "time_id", "type_id").agg(
        F.count("publication_id"), F.sum("citings_dblp").cast("long"), F.max("citings_dblp"), F.grouping_id())
    assert sorted(map(str, map(tuple, cube.collect()))) == sorted(map(str, map(tuple, want.collect())))
    assert cube_plan.build_cube(fact.limit(0)).count() == 0


def test_tables_on_the_way_are_deleted(spark):
    from pathlib import Path

    rows, root = spark.range(20), Path(session.ensure_checkpoint_dir(spark).removeprefix("file:"), "citecube")

    def folders(name):
        return len(list(root.glob(f"{name}-*")))

    outer = session.materialize(rows, "way-before")
    got = session.settle(spark, lambda: session.materialize(outer.where("id > 3"), "way-inner").where("id < 6"), "way-result")
    assert sorted(r.id for r in got.collect()) == [4, 5]
    assert (folders("way-before"), folders("way-inner"), folders("way-result")) == (1, 0, 1)


def _broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_large_written_sides_are_not_broadcast(spark, monkeypatch):
    left = spark.range(2000).withColumn("x", F.col("id") * 2)
    side = session.materialize(spark.range(1000), "side")
    assert _broadcasts(left.join(session.join_side(side), "id")) == 1
    monkeypatch.setattr(session, "BROADCAST_ROWS", 999)          # the table stays small in bytes
    for how, rows in (("inner", 500), ("left", 2000), ("left_anti", 1500)):
        out = left.select("x").join(session.join_side(side.withColumnRenamed("id", "x")), "x", how)
        assert _broadcasts(out) == 0 and out.count() == rows


def test_pieces_of_many_records_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_ROWS", 20)
    # record i (place 2i) is split in two where i is even; every tenth record's second piece is a comment
    chunks = session.materialize(spark.createDataFrame(
        [("f", 1, 0, p, f"c{p}") for p in range(200) if p % 2 == 0 or p % 4 == 1], "file string, src long, block long, place long, chunk string"), "chunks")
    loose = session.materialize(spark.createDataFrame(
        [(1, 0, p, 0, p - 1, p % 20 == 1) for p in range(200) if p % 4 == 1],
        "src long, block long, place long, owner_block long, owner_place long, drop boolean"), "loose")
    out = join_pieces(chunks, loose, "+")
    assert _broadcasts(out) == 0
    want = {p: f"c{p}+c{p + 1}" if p % 4 == 0 and (p + 1) % 20 != 1 else f"c{p}" for p in range(0, 200, 2)}
    assert {r.place: r.chunk for r in out.collect()} == want and out.count() == 100


def test_an_import_with_joins_by_shuffle_is_the_same(spark, monkeypatch):
    path = session.scratch_path(spark, "xml-sides")
    text = "".join(f'<proceedings key="c{i}"><title>T {i}{" key=" + chr(34) if i % 3 == 0 else ""}</title></proceedings>\n'
                   f'<!-- <book key="old{i}"><title>x</title></book> -->\n' for i in range(60))
    spark.createDataFrame([(f"<dblp>{text}</dblp>",)], "value string").coalesce(1).write.text(path)
    want = [(i + 1, "proceedings", f"c{i}", f"T {i}" + (' key="' if i % 3 == 0 else "")) for i in range(60)]
    for most in (500_000, 0):
        monkeypatch.setattr(session, "BROADCAST_ROWS", most)
        assert sorted(map(tuple, xml.dblp_import(spark, path)[1].collect())) == want


def _star_tables(spark):
    written = lambda rows, schema: session.materialize(spark.createDataFrame(rows, schema), "star-table")
    return {"timeinfo": written([(1, 1995, 90), (2, 2001, 0)], "time_id long, year long, decade long"),
            "author": written([(i, f"A{i % 25}") for i in range(30)], "author_id long, name string"),
            "document_type": written([(1, "T")], "type_id long, name string"),
            "venue_series": written([(i, f"V{i}") for i in range(30)], "venue_series_id long, name string"),
            "publication": written([(p, a, 1 + p % 2, 1 if p % 3 else -1, p % 31 - 1, p % 9) for p in range(90) for a in (p % 30, p % 7)],
                                   "publication_id long, author_id long, time_id long, type_id long, venue_series_id long, citings_dblp long")}


def _rows(df):
    return sorted((tuple(r.asDict()[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def test_many_names_of_a_load_are_not_broadcast(spark, monkeypatch):
    tables_, name = _star_tables(spark), lattice.name_of(lattice.FINEST[0])
    want = _rows(lattice.finest(*lattice.star_keys(tables_))[name])
    monkeypatch.setattr(session, "BROADCAST_ROWS", 10)
    got = lattice.finest(*lattice.star_keys(tables_))[name]
    assert _broadcasts(got) == 1          # the type's name
    assert _rows(got) == want and len({r[1] for r in want}) == 25


def test_a_large_lookup_is_not_broadcast(spark, monkeypatch):
    left, dim = spark.range(40).select(F.col("id").alias("k")), session.materialize(spark.range(30).select("id", (F.col("id") + 100).alias("n")), "dim")
    monkeypatch.setattr(session, "BROADCAST_ROWS", 10)
    for unique in (True, False):
        out = dim_lookup(left, "k", dim, "id", "n", "found", unique=unique)
        assert _broadcasts(out) == 0
        assert sorted(r.found for r in out.collect()) == [-1] * 10 + list(range(100, 130))


def test_answers_from_the_fact_join_by_shuffle_too(spark, monkeypatch):
    tables_ = _star_tables(spark)
    ask = lambda: lattice.Lattice(spark, "", fact_rows=lattice.star_rows(tables_))._from_fact(
        ("decade", "venue_name"), tuple(lattice.MEASURES), [F.col("author_name") == "A3"])
    want = _rows(ask())
    hits = [r for r in tables_["publication"].collect() if r.author_id % 25 == 3]
    assert sum(r[4] for r in want) == len({r.publication_id for r in hits}) > 0        # n_pubs
    monkeypatch.setattr(session, "BROADCAST_ROWS", 10)
    got = ask()
    assert _broadcasts(got) == 2          # times and types
    assert _rows(got) == want
    plan = lattice.star_rows(tables_).where("author_name = 'A3'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter, (venue_series_id") < plan.index("Join Inner, (author_id")      # the authors are joined below


def test_known_keys_of_a_large_registry_are_joined_by_shuffle(spark, monkeypatch):
    keys = KeyRegistry(spark, session.scratch_path(spark, "registry"), T.StructType([T.StructField("k", T.StringType())]), "id")
    rows = lambda first, many: spark.range(first, first + many).select(F.format_string("k%03d", "id").alias("k"))
    keys.assign(rows(0, 30), 0)
    sides, real = [], session.join_side
    monkeypatch.setattr(session, "BROADCAST_ROWS", 10)
    monkeypatch.setattr("citecube.operators.registry.join_side", lambda df: sides.append(real(df)) or sides[-1])
    got = {r.k: r.id for r in keys.assign(rows(20, 20), 1).collect()}
    assert got == {f"k{i:03d}": i + 1 for i in range(30, 40)}
    assert _broadcasts(rows(20, 20).join(sides[0], "k", "left_anti")) == 0
