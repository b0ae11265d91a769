"""python -m citecube <command> ...  (see citecube/jobs.py)"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession

from . import jobs
from .plans import olap
from .session import local_session
from .sources import csv_dialects as csv


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="citecube")
    p.add_argument("--master-cores", default="*", help="cores of a local session; a session that "
                   "spark-submit has started is used as it is")
    sub = p.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("import")
    i.add_argument("kind", choices=["dblp", "acm"])
    i.add_argument("xml")
    i.add_argument("out")
    i.add_argument("--format", default="escaped", choices=["escaped", "quoted", "parquet"])
    c = sub.add_parser("csv")
    c.add_argument("src")
    c.add_argument("dst")
    g = c.add_mutually_exclusive_group(required=True)
    g.add_argument("--quoted-to-escaped", action="store_true")
    g.add_argument("--escaped-to-quoted", action="store_true")
    c.add_argument("--limit", type=int, default=0)
    s = sub.add_parser("star")
    s.add_argument("-type", dest="kind", choices=["dblp", "acm"], required=True)
    s.add_argument("-source", required=True)
    s.add_argument("-target", required=True)
    s.add_argument("--in-format", default="escaped", choices=["escaped", "quoted", "parquet"])
    s.add_argument("--out-format", default="parquet", choices=["parquet", "escaped"])
    k = sub.add_parser("cube")
    k.add_argument("star")
    k.add_argument("cube")
    q = sub.add_parser("query")
    q.add_argument("name", choices=list(olap.QUERIES))
    q.add_argument("star")
    q.add_argument("--cube")
    a = p.parse_args(argv)
    spark = SparkSession.getActiveSession() or (
        SparkSession.builder.getOrCreate() if os.environ.get("SPARK_ENV_LOADED") else local_session(a.master_cores))
    if a.cmd == "import":
        print(json.dumps(jobs.import_xml(spark, a.kind, a.xml, a.out, a.format)))
    elif a.cmd == "csv":
        direction = "quoted-to-escaped" if a.quoted_to_escaped else "escaped-to-quoted"
        csv.convert_records(spark, a.src, a.dst, direction, a.limit)
    elif a.cmd == "star":
        jobs.star_job(spark, a.kind, a.source, a.target, a.in_format, a.out_format)
    elif a.cmd == "cube":
        jobs.cube_job(spark, a.star, a.cube)
    elif a.cmd == "query":
        for line in jobs.query(spark, a.name, a.star, a.cube).toJSON().toLocalIterator():
            print(line)
    spark.stop()


if __name__ == "__main__":
    main()
