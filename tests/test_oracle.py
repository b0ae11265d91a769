"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as entry

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join("∅" if r[i] is None else (f"{r[i]:.6g}" if isinstance(r[i], float) else str(r[i]))
                            for i in order) for r in rows)
    return [cols[i] for i in order], len(rows), hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = digest(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    want = digest([d[0] for d in cur.description], cur.fetchall())
    assert got == want
