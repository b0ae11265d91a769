"""End-to-end jobs on the smallest tables: XML dump -> staged escaped CSV ->
star tables -> cube -> queries (cube answers = base answers), plus the
record-exact CSV conversion."""

import glob

import pytest

from citecube import catalog_more, jobs
from citecube.plans import olap
from citecube.session import scratch_path
from citecube.sources import csv_dialects as C

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def pipeline(spark):
    dump = catalog_more._dblp_dump_now(spark, SF_SMALL)
    staged = scratch_path(spark, "job-staged")
    counts = jobs.import_xml(spark, "dblp", dump, staged)
    target = scratch_path(spark, "job-star")
    jobs.star_job(spark, "dblp", staged, target)
    star_dir = target + "/dblp"
    cube_dir = scratch_path(spark, "job-cube")
    jobs.cube_job(spark, star_dir, cube_dir)
    return counts, staged, star_dir, cube_dir


def test_import_counts(pipeline, spark):
    counts, staged, _, _ = pipeline
    pubs, cols = jobs.read_staged(spark, "dblp", staged)
    assert counts["dblp-publications.csv"] == pubs.count() > 0
    assert counts["dblp-collections.csv"] == cols.count() > 0


def test_fact_rows_equal_author_items(pipeline, spark):
    _, staged, star_dir, _ = pipeline
    pubs, _ = jobs.read_staged(spark, "dblp", staged)
    items = sum(len(r.authors.split("|")) for r in pubs.select("authors").collect())
    t = jobs.load_tables(spark, star_dir, register=True)
    assert t["publication"].count() == items          # adapter keys are unique: no publication is merged
    assert spark.sql("SELECT count(*) FROM author_pub").first()[0] == t["publication_author_map"].count()


@pytest.mark.parametrize("name", list(olap.QUERIES))
def test_cube_answers_equal_base(pipeline, spark, name):
    _, _, star_dir, cube_dir = pipeline
    base = sorted(map(tuple, jobs.query(spark, name, star_dir).collect()), key=str)
    cube = sorted(map(tuple, jobs.query(spark, name, star_dir, cube_dir).collect()), key=str)
    assert base == cube


def test_convert_records_roundtrip(spark):
    rows = [(1, "a,b", 'q"x', None), (2, "line\nbreak", " pad", "z")]
    df = spark.createDataFrame(rows, "id long, a string, b string, c string")
    esc, quo, back = (scratch_path(spark, n) for n in ("cr-esc", "cr-quo", "cr-back"))
    C.write_escaped(df, esc, order_by="id")
    C.convert_records(spark, esc, quo, "escaped-to-quoted")
    C.convert_records(spark, quo, back, "quoted-to-escaped")
    a = sorted("".join(open(f).read() for f in glob.glob(esc.replace("file:", "") + "/part-*")).splitlines())
    b = sorted("".join(open(f).read() for f in glob.glob(back.replace("file:", "") + "/part-*")).splitlines())
    assert a == b


def test_cli_csv_conversion(tmp_path):
    """``python -m citecube csv IN OUT --escaped-to-quoted --limit 2`` in its
    own process (its own local session)."""
    import os
    import subprocess
    import sys
    src = tmp_path / "in"
    src.mkdir()
    (src / "part-0.csv").write_text("1,a\\,b,x\n2,c,y\n3,d,z\n", encoding="utf-8")
    dst = tmp_path / "out"
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-m", "citecube", "--master-cores", "2", "csv", str(src), str(dst),
                    "--escaped-to-quoted", "--limit", "2"], cwd=repo, check=True, timeout=600,
                   capture_output=True)
    lines = sorted("".join(p.read_text() for p in dst.glob("part-*")).splitlines())
    assert lines == ['1,"a,b",x', "2,c,y"]


def test_bench_prints_one_json_line():
    """bench.py contract: one JSON line on stdout with metric/value/unit/queries/sf."""
    import json
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_REPEAT="1", BENCH_CPUS="4")
    out = subprocess.run([sys.executable, "bench.py"], cwd=repo, env=env, check=True, timeout=900,
                         capture_output=True, text=True).stdout
    lines = [x for x in out.splitlines() if x.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and d["value"] > 0
    assert {f"q{i}_base" for i in range(1, 11)} <= set(d["queries"])
    assert {f"q{i}_cube" for i in range(1, 11)} <= set(d["queries"])
