"""Registered questions on the cuboid lattice: three loads, merged answers,
distinct publications, and the ten analysis queries through the router."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import oracle
from .catalog import memo, register, written_star
from .plans import lattice
from .plans.olap import AUTHOR_ID, AUTHOR_NAME, YEAR
from .session import scratch_path

LOADS = 3


def cube(spark: SparkSession, sf_dir: str, compacted: bool = False) -> lattice.Lattice:
    """The lattice after three loads (by ranges of publications), or the same
    merged into one segment; written once per session and table folder."""
    def build():
        rows = lattice.star_rows(written_star(spark, sf_dir))
        out = lattice.Lattice(spark, scratch_path(spark, "lattice"), fact_rows=rows)
        keys, names = lattice.star_keys(written_star(spark, sf_dir))
        last = keys.agg(F.max("publication_id")).first()[0] or 0
        for i in range(LOADS):
            low, high = last * i // LOADS, last * (i + 1) // LOADS
            out.add_segment(keys.where(F.col("publication_id").between(low + (i > 0), high)), f"load{i + 1}", names)
        if compacted:
            out.compact("all-loads")
        return out
    return memo("lattice-compact" if compacted else "lattice", spark, sf_dir, build)


def _sql(by: tuple[str, ...], where: dict) -> str:
    """The question on the fact, publications counted by DISTINCT."""
    condition = " AND ".join(f"{c} = {v!r}" for c, v in where.items()) or "true"
    keys = "".join(f"{c}, " for c in by)
    group = f"GROUP BY {', '.join(by)}" if by else ""
    return oracle.with_star(f"""
, star_rows AS (
  SELECT f.publication_id, f.author_id, a.name AS author_name, t.year, t.decade, f.type_id, y.name AS type_name,
         f.venue_series_id, v.name AS venue_name, f.citings_dblp
  FROM fact f LEFT JOIN dim_author a ON a.author_id = f.author_id LEFT JOIN dim_time t ON t.time_id = f.time_id
  LEFT JOIN dim_type y ON y.type_id = f.type_id LEFT JOIN dim_venue v ON v.venue_series_id = f.venue_series_id),
hit AS (SELECT * FROM star_rows WHERE {condition}),
links AS (SELECT {keys}count(*) AS n_links, count(DISTINCT publication_id) AS n_pubs,
                 CAST(coalesce(sum(citings_dblp), 0) AS BIGINT) AS link_citings, max(citings_dblp) AS max_citings FROM hit {group}),
pubs AS (SELECT {keys}CAST(coalesce(sum(citings_dblp), 0) AS BIGINT) AS sum_citings
         FROM (SELECT DISTINCT {keys}publication_id, citings_dblp FROM hit) {group})
SELECT l.*, p.sum_citings FROM links l JOIN pubs p ON true{"".join(f" AND l.{c} IS NOT DISTINCT FROM p.{c}" for c in by)}""".replace(
        "\n, star_rows", ", star_rows", 1))


QUESTIONS: dict[str, tuple[tuple[str, ...], dict]] = {
    "cube_total": ((), {}),
    "cube_by_year": (("year",), {}),
    "cube_by_decade": (("decade",), {}),
    "cube_by_type": (("type_name",), {}),
    "cube_by_decade_type": (("decade", "type_name"), {}),
    "cube_by_venue": (("venue_series_id", "venue_name"), {}),
    "cube_by_decade_venue": (("decade", "venue_series_id"), {}),
    "cube_by_author": (("author_id", "author_name"), {}),
    "cube_by_author_decade": (("author_id", "decade"), {}),
    "cube_types_of_year": (("type_name",), {"year": YEAR}),
    "cube_years_of_author": (("year",), {"author_id": AUTHOR_ID}),
    "cube_decades_of_name": (("decade",), {"author_name": AUTHOR_NAME}),
}
for _name, (_by, _where) in QUESTIONS.items():
    register(_name, _sql(_by, _where))(
        (lambda by, where: lambda spark, sf_dir: cube(spark, sf_dir).answer(by, **where))(_by, _where))

register("cube_compacted_by_decade_type", _sql(("decade", "type_name"), {}))(
    lambda spark, sf_dir: cube(spark, sf_dir, compacted=True).answer(("decade", "type_name")))
for _name, _by in (("cube_distinct_by_year_type", ("year", "type_name")), ("cube_distinct_by_decade", ("decade",))):
    register(_name, f"SELECT {', '.join(_by)}, n_pubs FROM ({_sql(_by, {})})")(
        (lambda by: lambda spark, sf_dir: cube(spark, sf_dir).distinct_publications(*by))(_by))

for _name, _fn in lattice.QUERIES.items():
    register("routed_" + _name, oracle.with_star(oracle.OLAP[_name]))(
        (lambda fn: lambda spark, sf_dir: fn(cube(spark, sf_dir)))(_fn))
