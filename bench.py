"""Benchmark: star-schema build, Q1-Q10 on base tables, cube build, Q1-Q10
on cuboids.  Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 5; best run per query is reported).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from citecube.plans import cube as cube_plan  # noqa: E402
from citecube.plans import lattice, olap  # noqa: E402
from citecube.plans.star import build_star  # noqa: E402
from citecube.session import local_session, scratch_path  # noqa: E402
from citecube.sources import adapter, tables  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeat: int) -> float:
    best = float("inf")
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - t0)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = local_session(cpus, shuffle_partitions=max(8, cpus * 2), app="citecube-bench")
    root = scratch_path(spark, "bench-star")
    res: dict[str, float] = {}
    # JVM/JIT warm-up outside the timings (the published numbers exclude start-up too).
    adapter.table(spark, sf_dir, "region").count()

    t0 = time.perf_counter()
    star = build_star(adapter.staged(spark, sf_dir))
    tables.save_star(star.tables(), root)
    res["star_build"] = round(time.perf_counter() - t0, 3)

    t = tables.load_star(spark, root)
    base = olap.Tables(t["publication"], t["author"], t["timeinfo"])
    for name, fn in olap.QUERIES.items():
        run(fn(base))  # warm-up
        res[name.split("_")[0] + "_base"] = timed(lambda: run(fn(base)), repeat)

    cube_root = os.path.join(root, "cube")
    t0 = time.perf_counter()
    cube_plan.write_cube(cube_plan.build_cube(t["publication"]), cube_root)
    res["cube_build"] = round(time.perf_counter() - t0, 3)

    cube = spark.read.parquet(cube_root)
    for name, fn in cube_plan.CUBE_QUERIES.items():
        run(fn(cube, t["author"], t["timeinfo"]))
        res[name.split("_")[0] + "_cube"] = timed(lambda: run(fn(cube, t["author"], t["timeinfo"])), repeat)

    # The lattice: all attributes in its cuboids, so a question reads one folder and joins nothing.
    t0 = time.perf_counter()
    cuboids = lattice.Lattice(spark, os.path.join(root, "lattice"))
    cuboids.add_segment(lattice.star_rows(t), "all-loads")
    res["lattice_build"] = round(time.perf_counter() - t0, 3)
    for name, fn in lattice.QUERIES.items():
        run(fn(cuboids))
        res[name.split("_")[0] + "_routed"] = timed(lambda: run(fn(cuboids)), repeat)

    # XML import: render the tables as a DBLP dump (untimed), then time the
    # parallel import of publications and collections.
    from citecube import catalog_more
    from citecube.sources import xml_records
    dump = catalog_more._dblp_dump_now(spark, sf_dir)
    t0 = time.perf_counter()
    pubs, cols = xml_records.dblp_import(spark, dump)
    run(pubs)
    run(cols)
    res["xml_import"] = round(time.perf_counter() - t0, 3)

    base_times = [v for k, v in res.items() if k.endswith("_base")]
    cube_times = [v for k, v in res.items() if k.endswith("_cube")]
    routed_times = [v for k, v in res.items() if k.endswith("_routed")]
    res["mean_routed"] = round(sum(routed_times) / len(routed_times), 3)
    res["mean_base"] = round(sum(base_times) / len(base_times), 3)
    res["mean_cube"] = round(sum(cube_times) / len(cube_times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "mean_q1_q10_base_sec", "value": res["mean_base"], "unit": "sec",
                      "queries": res, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
