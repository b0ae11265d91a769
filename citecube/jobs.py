"""End-to-end jobs: the workflows of the original tool chain as Spark jobs.

    import   XML dump -> staged record files (escaped CSV, or parquet)
    csv      dialect conversion of a record file (optionally first N records)
    star     staged record files -> star-schema tables (DBLP or ACM branch)
    cube     fact table -> cuboids partitioned by grouping id
    query    one of the ten analysis queries on the written tables / cube
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas as S
from .plans import cube as cube_plan
from .plans import olap
from .plans.star import build_star
from .plans.star_acm import build_star_acm
from .sources import adapter, tables
from .sources import csv_dialects as csv
from .sources import xml_records as xml

PUB_FILE = "{kind}-publications.csv"
COL_FILE = "{kind}-collections.csv"
REJECTS = "dblp-rejects"


def import_xml(spark: SparkSession, kind: str, xml_path: str, out_dir: str, fmt: str = "escaped",
               strict: bool = False) -> dict:
    """XML dump -> staged files ``<kind>-publications.csv`` (and for DBLP
    ``dblp-collections.csv`` and the quarantined records, ``dblp-rejects``);
    returns the record counts.  ``strict`` fails where a DBLP record is not
    well formed or has no end tag."""
    if kind == "dblp":
        # one scan and one parse: the files are parts of the table written there
        rows, seen = xml.dblp_table(spark, xml_path)
        if strict and (seen.get("malformed_record") or seen.get("unclosed_record")):
            raise ValueError(f"broken records: {seen}")
        xml.rejects_of(rows).write.mode("overwrite").parquet(os.path.join(out_dir, REJECTS))
        pubs, cols = xml.split_kinds(rows, with_seq=True)
        outputs = {PUB_FILE.format(kind=kind): pubs, COL_FILE.format(kind=kind): cols}
        counts = dict(zip([*outputs, REJECTS], map(seen.get, xml.KINDS)))
    elif kind == "acm":
        outputs = {PUB_FILE.format(kind=kind): xml.acm_import(spark, xml_path)}
        counts = {name: df.count() for name, df in outputs.items()}
    else:
        raise ValueError(kind)
    for name, df in outputs.items():
        path = os.path.join(out_dir, name)
        if fmt == "escaped":
            csv.write_escaped(df, path, order_by="seq")
        elif fmt == "quoted":
            csv.write_quoted(df, path, order_by="seq")
        else:
            df.withColumnRenamed("seq", "id").write.mode("overwrite").parquet(path)
    return counts


def read_staged(spark: SparkSession, kind: str, source_dir: str, fmt: str = "escaped"):
    def read(name, schema):
        path = os.path.join(source_dir, name)
        if fmt == "escaped":
            return csv.read_escaped(spark, path, schema, strict=True)
        if fmt == "quoted":
            return csv.read_quoted(spark, path, schema)
        return spark.read.schema(schema).parquet(path)

    def checked(df):
        """Fails the job on a record without an id."""
        return df.withColumn("id", F.coalesce("id", F.raise_error(F.lit("staged record without an id")).cast("long")))
    if kind == "dblp":
        return (checked(read(PUB_FILE.format(kind=kind), S.STAGED_PUBLICATIONS)),
                checked(read(COL_FILE.format(kind=kind), S.STAGED_COLLECTIONS)))
    return checked(read(PUB_FILE.format(kind=kind), S.STAGED_ACM_PUBLICATIONS)), None


def star_job(spark: SparkSession, kind: str, source_dir: str, target_dir: str,
             in_fmt: str = "escaped", out_fmt: str = "parquet") -> dict[str, DataFrame]:
    """Staged record files -> star-schema tables under ``target_dir/<kind>/``."""
    pubs, cols = read_staged(spark, kind, source_dir, in_fmt)
    if kind == "dblp":
        star = build_star(adapter.staged_from_records(pubs, cols))
        out = star.tables()
    else:
        acm = pubs.withColumnRenamed("id", "seq")
        star = build_star_acm(acm)
        out = {k: v for k, v in star.tables().items()
               if k not in ("document_type", "venue_series", "publication_citing_map")}
    root = os.path.join(target_dir, kind)
    if out_fmt == "parquet":
        tables.save_star(out, root)
    else:
        tables.save_star_escaped(out, root)
    return out


def load_tables(spark: SparkSession, star_dir: str, register: bool = True) -> dict[str, DataFrame]:
    t = tables.load_star(spark, star_dir)
    if register:
        tables.register_star(spark, t)
    return t


def cube_job(spark: SparkSession, star_dir: str, cube_dir: str) -> None:
    fact = load_tables(spark, star_dir, register=False)["publication"]
    cube_plan.write_cube(cube_plan.build_cube(fact), cube_dir)


def query(spark: SparkSession, name: str, star_dir: str, cube_dir: str | None = None) -> DataFrame:
    t = load_tables(spark, star_dir, register=False)
    if cube_dir:
        return cube_plan.CUBE_QUERIES[name](spark.read.parquet(cube_dir), t["author"], t["timeinfo"])
    return olap.QUERIES[name](olap.Tables(t["publication"], t["author"], t["timeinfo"]))
