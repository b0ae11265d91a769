"""Registry of named queries: Spark plan + DuckDB oracle SQL.

Every query reads the driver's tables (or data Spark derives from them).
Star-schema queries share one build per session and table folder: the
dimensions are checkpointed, so later queries reuse them instead of
recomputing the surrogate keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .plans import cube as cube_plan
from .plans import olap
from .plans.star import StarSchema, build_star
from .session import scratch_path
from .sources import adapter
from .sources import tables as star_tables

QueryFn = Callable[[SparkSession, str], DataFrame]

_CACHE: dict[tuple, object] = {}


def memo(kind: str, spark: SparkSession, sf_dir: str, build):
    """Per session and table folder: build once (staged tables, star schema,
    written dumps), reuse for every query of that session."""
    key = (kind, spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CACHE:
        _CACHE[key] = build()
    return _CACHE[key]


def staged(spark: SparkSession, sf_dir: str) -> adapter.Staged:
    return memo("staged", spark, sf_dir, lambda: adapter.staged(spark, sf_dir))


def star(spark: SparkSession, sf_dir: str) -> StarSchema:
    return memo("star", spark, sf_dir, lambda: build_star(staged(spark, sf_dir)))


def written_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star's tables as saved (fact by year, clustered by author) and read back."""
    def build():
        root = scratch_path(spark, "star")
        star_tables.save_star(star(spark, sf_dir).tables(), root)
        return star_tables.load_star(spark, root)
    return memo("written", spark, sf_dir, build)


def _tables(spark: SparkSession, sf_dir: str) -> olap.Tables:
    t = written_star(spark, sf_dir)
    return olap.Tables(t["publication"], t["author"], t["timeinfo"])


_REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        _REGISTRY[name] = (fn, sql)
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load()
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in _REGISTRY.items() if v[1] is not None}


# --- star schema ----------------------------------------------------------

for _name, _attr, _sql in [
    ("dim_time", "timeinfo", "SELECT * FROM dim_time"),
    ("dim_type", "document_type", "SELECT * FROM dim_type"),
    ("dim_venue", "venue_series", "SELECT * FROM dim_venue"),
    ("dim_title", "title", "SELECT * FROM dim_title"),
    ("dim_author", "author", "SELECT * FROM dim_author"),
    ("fact_publication", "publication", "SELECT * FROM fact"),
    ("bridge_pub_author", "bridge", "SELECT * FROM bridge"),
]:
    register(_name, oracle.with_star(_sql))(
        (lambda attr: lambda spark, sf_dir: getattr(star(spark, sf_dir), attr))(_attr))

# --- analysis queries on base tables and on the cube ----------------------

for _name, _fn in olap.QUERIES.items():
    register(_name, oracle.with_star(oracle.OLAP[_name]))(
        (lambda fn: lambda spark, sf_dir: fn(_tables(spark, sf_dir)))(_fn))


def _cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cube as persisted: one folder per cuboid, clustered by author."""
    def build():
        path = scratch_path(spark, "cube")
        cube_plan.write_cube(cube_plan.build_cube(written_star(spark, sf_dir)["publication"]), path)
        return spark.read.parquet(path)
    return memo("cube", spark, sf_dir, build)


register("cube_build", oracle.with_star("SELECT * FROM cube"))(
    lambda spark, sf_dir: cube_plan.build_cube(star(spark, sf_dir).publication))


register("star_parquet_roundtrip", oracle.with_star("""
SELECT 'publication' AS name, count(*) AS n, CAST(sum(author_id) AS BIGINT) AS ids FROM fact
UNION ALL SELECT 'author', count(*), CAST(sum(author_id) AS BIGINT) FROM dim_author
UNION ALL SELECT 'title', count(*), CAST(sum(title_id) AS BIGINT) FROM dim_title
UNION ALL SELECT 'venue_series', count(*), CAST(sum(venue_series_id) AS BIGINT) FROM dim_venue"""))(
    lambda spark, sf_dir: star_roundtrip(written_star(spark, sf_dir)))


def star_roundtrip(t: dict[str, DataFrame]) -> DataFrame:
    """Rows and id sums of the tables read back from the written star."""
    ids = {"publication": "author_id", "author": "author_id", "title": "title_id", "venue_series": "venue_series_id"}
    parts = [t[name].agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.sum(i).cast("long").alias("ids"))
             for name, i in ids.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@register("bridge_pub_citing", oracle.with_star("SELECT * FROM citing_bridge"))
def _citing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .plans.star import citing_bridge
    return citing_bridge(staged(spark, sf_dir))

for _name, _fn in cube_plan.CUBE_QUERIES.items():
    register("cube_" + _name, oracle.with_star(oracle.OLAP[_name]))(
        (lambda fn: lambda spark, sf_dir: fn(_cube(spark, sf_dir), written_star(spark, sf_dir)["author"],
                                             written_star(spark, sf_dir)["timeinfo"]))(_fn))

_Q4_YEAR = oracle.with_star(f"""
SELECT a.name AS author_name, CAST(sum(f.citings_dblp) AS BIGINT) AS max_c
FROM fact f JOIN dim_author a ON a.author_id = f.author_id JOIN dim_time t ON t.time_id = f.time_id
WHERE t.year = {olap.YEAR} GROUP BY a.name, a.author_id ORDER BY max_c DESC, a.author_id LIMIT {olap.TOP_K}""")
register("q4_top_cited_authors_year", _Q4_YEAR)(
    lambda spark, sf_dir: olap.q4_top_cited_authors(_tables(spark, sf_dir), year=olap.YEAR))
register("cube_q4_top_cited_authors_year", _Q4_YEAR)(
    lambda spark, sf_dir: cube_plan.cq4(_cube(spark, sf_dir), written_star(spark, sf_dir)["author"],
                                        written_star(spark, sf_dir)["timeinfo"], year=olap.YEAR))

register("cube_decade_rollup", oracle.with_star("""
SELECT t.decade, CAST(count(f.publication_id) AS BIGINT) AS n_links,
       CAST(sum(f.citings_dblp) AS BIGINT) AS link_citings, max(f.citings_dblp) AS max_citings
FROM fact f JOIN dim_time t ON t.time_id = f.time_id GROUP BY t.decade"""))(
    lambda spark, sf_dir: cube_plan.decade_rollup(_cube(spark, sf_dir), star(spark, sf_dir).timeinfo))


_LOADED = False


def _load() -> None:
    """Import the modules that register further queries."""
    global _LOADED
    if _LOADED:
        return
    _LOADED = True
    from . import catalog_cube, catalog_more  # noqa: F401
