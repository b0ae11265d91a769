"""Cuboid lattice: distinct publications, choice, routing, segments."""

import random

import pytest
from pyspark.sql import functions as F

from citecube.plans import lattice as la
from citecube.session import scratch_path

ROW = ("publication_id long, author_id long, citings_dblp long, year long, decade long, type_id long, type_name string, "
       "venue_series_id long, venue_name string, author_name string")


def rows(spark, pubs):
    """pubs: (publication, citations, year, type, venue, authors)."""
    out = [(p, a, c, y, y % 100 // 10 * 10, t, f"T{t}", v, None if v < 0 else f"V{v}", f"A{a % 7}")
           for p, c, y, t, v, authors in pubs for a in authors]
    return spark.createDataFrame(out, ROW)


def publications(seed, first, many):
    rng = random.Random(seed)
    return [(first + i, rng.randrange(50), 1988 + rng.randrange(20), rng.randrange(4), rng.choice([-1, 1, 2, 3]),
             [rng.randrange(12) for _ in range(rng.randint(1, 5))]) for i in range(many)]


def brute(pubs, by, where=None):
    """By columns -> (author places, publications, citations, citations per place, most)."""
    found = {}
    for p, c, y, t, v, authors in pubs:
        for a in authors:
            row = {"author_id": a, "author_name": f"A{a % 7}", "year": y, "decade": y % 100 // 10 * 10, "type_id": t,
                   "type_name": f"T{t}", "venue_series_id": v, "venue_name": None if v < 0 else f"V{v}"}
            if all(row[k] == x for k, x in (where or {}).items()):
                found.setdefault(tuple(row[k] for k in by), []).append((p, c))
    return sorted(((*k, len(g), len(set(g)), sum(c for _, c in set(g)), sum(c for _, c in g), max(c for _, c in g))
                   for k, g in found.items()), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_two_authors_are_one_publication(spark):
    cube = la.Lattice(spark, scratch_path(spark, "t-lattice"), budget=5.0)
    cube.add_segment(rows(spark, [(1, 5, 1999, 1, 1, [1, 2, 2])]), "a")
    assert got(cube.answer(("year",))) == [(1999, 3, 1, 5, 15, 5)]
    assert got(cube.answer(("author_id",))) == [(1, 1, 1, 5, 5, 5), (2, 2, 1, 5, 10, 5)]
    assert got(cube.distinct_publications("decade")) == [(90, 1)]


def test_segments_merge_replay_and_compact(spark):
    loads = [publications(n, 1 + 70000 * n, 60) for n in range(2)]      # ids over several bitmap buckets
    whole = [p for load in loads for p in load]
    cube = la.Lattice(spark, scratch_path(spark, "t-lattice"), budget=0.1, fact_rows=rows(spark, whole))
    for n, load in enumerate(loads):
        cube.add_segment(rows(spark, load), f"day{n}")
    cube.add_segment(rows(spark, loads[1]), "day1")                      # a load comes once more
    with pytest.raises(ValueError, match="repeats"):
        cube.add_segment(rows(spark, loads[0][:1]), "day9")
    questions = [((), {}), (("year",), {}), (("decade", "type_name"), {}), (("author_id", "year"), {}),
                 (("venue_series_id", "venue_name"), {}), (("type_id",), {"year": whole[0][2]}), (("decade",), {"author_id": 3}),
                 (("decade",), {"author_name": "A1"}), ((), {"author_name": "A1", "type_name": "T2"})]

    def check(questions):
        for by, where in questions:
            assert got(cube.answer(by, **where)) == brute(whole, by, where)
        for by in (("year", "type_name"), ()):
            assert got(cube.distinct_publications(*by)) == [(*r[:len(by)], r[len(by) + 1]) for r in brute(whole, by)]

    assert cube.state[1] == ["day0", "day1"]
    check(questions)
    cube.compact("days")
    assert cube.state[1] == ["days"]
    check(questions[1:4])
    again = la.Lattice(spark, cube.root)                                 # opened anew: the same state from the manifest
    assert again.state == cube.state
    assert got(again.answer(("year",))) == brute(whole, ("year",))
    with pytest.raises(ValueError, match="no fact"):
        again.answer((), author_name="A1")


def test_a_question_reads_one_folder(spark):
    cube = la.Lattice(spark, scratch_path(spark, "t-lattice"), budget=5.0)
    cube.add_segment(rows(spark, publications(1, 1, 80)), "a")
    for by, where, folder in [(("year",), {}, "year"), (("author_name",), {"year": 1990}, "author-year"), ((), {}, "all"),
                              (("decade",), {"type_id": 1}, "decade-type"), (("venue_name",), {}, "venue")]:
        df = cube.answer(by, ("n_links",), **where)
        assert {f.rsplit("/", 3)[-3] for f in df.inputFiles()} == {folder}
        assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_greedy_choice_and_covering():
    sizes = {c: 10 ** len(c) for c in la.cuboids()}
    assert set(la.choose(sizes, 0.0)) == set(la.FINEST)
    some = la.choose(sizes, 0.05)
    assert set(la.FINEST) < set(some) and sum(sizes[c] for c in some[2:]) <= 0.05 * sum(sizes[c] for c in la.FINEST)
    assert set(la.choose(sizes, 100.0)) <= set(la.cuboids()) and () in la.choose(sizes, 100.0)
    assert la.covers(("year", "type"), {"decade"}) and not la.covers(("decade",), {"year"})
    assert not la.covers(("author", "year"), {"year"})                   # publications would count once per author


def test_empty_fact(spark):
    cube = la.Lattice(spark, scratch_path(spark, "t-lattice"))
    cube.add_segment(rows(spark, []), "none")
    assert got(cube.answer(("year",))) == []
    assert got(cube.answer((), ("n_pubs", "n_links"))) == [(0, 0)]
    assert cube.distinct_publications().collect()[0].n_pubs == 0


def test_old_fact_is_not_read_by_a_refresh(spark):
    fact = rows(spark, publications(3, 1, 40))
    cube = la.Lattice(spark, scratch_path(spark, "t-lattice"))
    cube.add_segment(fact.where(F.col("publication_id") <= 20), "a")
    cube.fact_rows = fact.where(F.raise_error(F.lit("the fact was read")).isNull())
    cube.add_segment(fact.where(F.col("publication_id") > 20), "b")
    cube.compact("ab")
    assert cube.answer((), ("n_pubs",)).collect()[0].n_pubs == 40


def test_names_are_joined_after_grouping(spark):
    """Rows without names and the names beside them give the cuboids of the named rows."""
    pubs = publications(5, 1, 50)
    plain, ids = la.Lattice(spark, scratch_path(spark, "t-lattice")), la.Lattice(spark, scratch_path(spark, "t-lattice"))
    whole = rows(spark, pubs)
    names = {c: whole.select(i, c).distinct() for c, i in
             (("author_name", "author_id"), ("type_name", "type_id"), ("venue_name", "venue_series_id"))}
    plain.add_segment(whole, "a")
    ids.add_segment(whole.drop(*names), "a", names)
    assert set(plain.state[2]) == set(ids.state[2])
    for by, where in (((), {}), (("author_id", "author_name"), {}), (("venue_series_id", "venue_name"), {}),
                      (("decade", "type_name"), {}), (("decade",), {"author_id": 3})):
        assert got(ids.answer(by, **where)) == got(plain.answer(by, **where)) == brute(pubs, by, where)
    assert got(ids.distinct_publications("year", "type_name")) == got(plain.distinct_publications("year", "type_name"))


def test_star_keys_are_star_rows_without_names(spark):
    tables = {"publication": spark.createDataFrame([(1, 1, 1, 1, -1, 4), (2, -1, 1, 2, 1, 0)], "publication_id long, author_id long, "
                                                   "time_id long, type_id long, venue_series_id long, citings_dblp long"),
              "timeinfo": spark.createDataFrame([(1, 1997, 90)], "time_id long, year long, decade long"),
              "author": spark.createDataFrame([(1, "a")], "author_id long, name string"),
              "document_type": spark.createDataFrame([(1, "t"), (2, "u")], "type_id long, name string"),
              "venue_series": spark.createDataFrame([(1, "v")], "venue_series_id long, name string")}
    keys, names = la.star_keys(tables)
    joined = keys
    for column, name in names.items():
        joined = joined.join(name, name.columns[0], "left")
    whole = la.star_rows(tables)
    assert got(joined.select(*whole.columns)) == got(whole)
