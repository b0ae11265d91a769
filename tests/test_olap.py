"""Cuboid answers equal base-table answers (the cube-vs-base check), and
the driver entry points run."""

import pytest

import __spark_entry__ as entry_mod
from citecube import catalog
from citecube.plans import cube as cube_plan
from citecube.plans import olap

from .conftest import SF_SMALL


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["author_name", "num_pubs"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_listed():
    qs, sql = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sql) <= set(qs)


@pytest.mark.parametrize("name", list(olap.QUERIES))
def test_cuboid_equals_base(spark, name):
    s = catalog.star(spark, SF_SMALL)
    base = olap.QUERIES[name](olap.Tables(s.publication, s.author, s.timeinfo))
    cube = cube_plan.build_cube(s.publication)
    via_cube = cube_plan.CUBE_QUERIES[name](cube, s.author, s.timeinfo)
    assert base.columns == via_cube.columns
    assert rows(base) == rows(via_cube)


def test_gid_mapping():
    assert cube_plan.gid_of(("author_id", "time_id", "type_id")) == 0
    assert cube_plan.gid_of(("author_id",)) == 3
    assert cube_plan.gid_of(()) == 7
