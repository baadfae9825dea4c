"""Landed tables: the fact table and the cubes, written once to the shared folder.

The warehouse is the Spark form of "load once, build cubes, answer views from
cubes".  Each table is written as Parquet under a root inside
``spark.checkpoint.dir`` (the cluster's shared folder) the first time it is
asked for, and read back from there afterwards.  Writing cuts the lineage, so
a lost executor costs a re-read of a landed table, never a re-scan of the fact.

Which table is derived from which (the scan-level cubes read the fact; the
rest are rollups of a landed cube) is recorded in ``BUILDERS``.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loanscope.operators import bitmaps, cubes, lookups, ranking, reports
from loanscope.session import join_path, shared_dir
from loanscope.sources import fixture, reference, sinks


@dataclass
class Sources:
    """Raw inputs: the application rows and the two reference files."""

    fact: Callable[[], DataFrame]
    county: Callable[[], DataFrame]
    filers: Callable[[], DataFrame]
    gathered: bool = False  # the application rows come dealt by year


def fixture_sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(fact=lambda: fixture.lar(spark, sf_dir, by_year=True), gathered=True,
                   county=lambda: fixture.county(spark, sf_dir),
                   filers=lambda: fixture.filers(spark, sf_dir))


BUILDERS: dict[str, Callable[["Warehouse"], DataFrame]] = {
    # reference dimensions
    "county_dim": lambda w: reference.county_dimension(w.sources.county()),
    "lender_names": lambda w: reference.lender_names(w.sources.filers()),
    "county_names": lambda w: lookups.county_names(w.table("county_dim")),
    "state_prefix": lambda w: lookups.state_by_fips_prefix(w.table("county_dim")),
    # scan-level cubes
    "quality": lambda w: cubes.quality_cube(w.fact()),
    "rate_base": lambda w: cubes.rate_base_cube(w.fact()),
    "denials": lambda w: cubes.denial_cube(w.fact()),
    "geo_base": lambda w: cubes.geo_base_cube(w.fact()),
    "lender_base": lambda w: cubes.lender_base_cube(w.fact()),
    "investor_base": lambda w: cubes.investor_base_cube(w.fact()),
    "lender_states": lambda w: ranking.lender_top_states(cubes.lender_state_counts(w.fact())),
    "lender_ordinals": lambda w: bitmaps.lender_ordinals(w.table("lender_base")),
    "lender_bitmaps": lambda w: bitmaps.lender_bitmaps(w.table("lender_base"), w.table("lender_ordinals")),
    "lender_dim": lambda w: lookups.lender_dimension(w.table("lender_names"), w.table("lender_states")),
    # rollups of landed cubes
    "main": lambda w: cubes.main_cube(w.table("quality")),
    "rates": lambda w: cubes.rate_cube_from_base(w.table("rate_base")),
    "rate_distribution": lambda w: reports.rate_distribution_from_base(w.table("rate_base")),
    "state": lambda w: cubes.state_cube(w.table("geo_base")),
    "county": lambda w: cubes.county_cube(w.table("geo_base"), w.table("state_prefix"), w.top_n),
    "lender": lambda w: cubes.lender_cube(w.table("lender_base")),
    "inv_national": lambda w: cubes.investor_national_cube(w.table("investor_base")),
    "inv_state": lambda w: cubes.investor_state_cube(w.table("investor_base")),
    "inv_county": lambda w: cubes.investor_county_cube(w.table("investor_base"), w.table("state_prefix"),
                                                       w.top_n),
}

# The large cubes are landed in order of year, so that row groups hold few years and year filters skip the others.
BY_YEAR = ("quality", "geo_base")

# Landed in buckets of lenders, all in as many: grouping by lender and joining lenders moves no row.
# The column is the order of rows in a bucket; lender_base is in order of year for the same reason as the tables above.
BY_LENDER = {"lender_base": "y", "lender_dim": "lei", "lender_names": "lei", "lender_states": "lei"}
MAX_BUCKETS = 4096

# Rows of the fact table that a task scans, about.  A scan's splits are of bytes, but the cubes' map-side tables grow with rows,
# of which a Parquet split holds ten millions when the codes pack well.
TASK_ROWS = 1 << 20
SPLITS = "spark.sql.files.minPartitionNum"


class Warehouse:
    """Lazily landed tables for one source set under one root folder."""

    def __init__(self, spark: SparkSession, root: str, sources: Sources, top_n: int = 200,
                 max_records_per_file: int = 5_000_000, sf_dir: str | None = None,
                 lender_buckets: int | None = None):
        self.spark = spark
        self.sf_dir = sf_dir  # the driver-table folder behind fixture sources, if any
        self.root = root.rstrip("/")
        self.sources = sources
        self.top_n = top_n
        self.max_records_per_file = max_records_per_file
        self.lender_buckets = lender_buckets  # by default set when the first table is landed in them
        self._landed: set[str] = set()
        self._fact_schema = None
        self._fact_tasks = 0
        self._lock = threading.RLock()          # guards the per-table lock map
        self._table_locks: dict[str, threading.Lock] = {}
        self._remembered: dict = {}

    def path(self, name: str) -> str:
        return join_path(self.root, name)

    def _read(self, name: str) -> DataFrame:
        return self.spark.table(self._catalog_name(name)) if name in BY_LENDER else self.spark.read.parquet(self.path(name))

    def _catalog_name(self, name: str) -> str:
        """Buckets are known to the session's catalog only; the files are under the root like the others."""
        return f"loanscope_{hashlib.sha1(self.root.encode()).hexdigest()[:16]}_{name}"

    def _land(self, name: str, df: DataFrame) -> None:
        if name in BY_LENDER:  # one task, and so one file, for a bucket
            n = self._buckets()
            (df.repartition(n, "lei").write.mode("overwrite").format("parquet").bucketBy(n, "lei").sortBy(BY_LENDER[name])
             .option("path", self.path(name)).saveAsTable(self._catalog_name(name)))
        else:
            df = df.sortWithinPartitions("y") if name in BY_YEAR else df
            df.write.mode("overwrite").parquet(self.path(name))

    def _buckets(self) -> int:
        """A bucket is a task of every lender view and of the write: one for each slot of the cluster, or as many as the
        fact table's scan has tasks, so that none grows with the table."""
        self.fact()
        with self._table_lock("lender buckets"):
            if not self.lender_buckets:
                self.lender_buckets = min(MAX_BUCKETS, max(self.spark.sparkContext.defaultParallelism, self._fact_tasks))
        return self.lender_buckets

    def _scan_in_parts(self, rows: int) -> None:
        """Scans of ``rows`` rows get a task for about ``TASK_ROWS`` of them (a floor on the splits of large files only)."""
        self._fact_tasks = -(-rows // TASK_ROWS)
        least = self.spark.conf.get(SPLITS, None)
        if self._fact_tasks > max(int(least or 0), self.spark.sparkContext.defaultParallelism):
            self.spark.conf.set(SPLITS, str(self._fact_tasks))

    def _table_lock(self, name: str) -> threading.Lock:
        with self._lock:
            return self._table_locks.setdefault(name, threading.Lock())

    def fact(self) -> DataFrame:
        """The application fact table, landed once, partitioned by activity_year (``sinks.write_fact``)."""
        with self._table_lock("fact"):
            if "fact" not in self._landed:
                src = self.sources.fact()
                sinks.write_fact(src, self.path("fact"), self.max_records_per_file, self.sources.gathered)
                self._fact_schema = src.schema
                self._scan_in_parts(sinks.read_fact(self.spark, self.path("fact"), src.schema).count())
                self._landed.add("fact")
        return sinks.read_fact(self.spark, self.path("fact"), self._fact_schema)

    def table(self, name: str) -> DataFrame:
        """A landed cube or dimension, built from ``BUILDERS`` on first use."""
        if name == "fact":
            return self.fact()
        with self._table_lock(name):  # one lock per table: independent tables land concurrently
            if name not in self._landed:
                self._land(name, BUILDERS[name](self))
                self._landed.add(name)
        return self._read(name)

    def derived(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table written once by ``build`` under the warehouse root."""
        return self.spark.read.parquet(self.landed_files(name, lambda p: build().write.mode("overwrite").parquet(p)))

    def remembered(self, key, build: Callable):
        """What ``build`` gave for ``key`` the first time (plans over landed tables, not data)."""
        with self._table_lock(f"remembered {key!r}"):
            if key not in self._remembered:
                self._remembered[key] = build()
            return self._remembered[key]

    def scratch(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written to a folder of its own and read back: fixed values that several views share."""
        path = self.path(f"scratch/{name}-{uuid.uuid4().hex[:12]}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def landed_files(self, name: str, write: Callable[[str], None]) -> str:
        """A folder written once by ``write(path)`` (a sink) under the warehouse root."""
        with self._table_lock(name):
            if name not in self._landed:
                write(self.path(name))
                self._landed.add(name)
        return self.path(name)

    def build_all(self, parallelism: int = 1) -> None:
        """Land every table.  With ``parallelism`` > 1 independent tables are submitted
        as concurrent Spark jobs (the lineage in ``BUILDERS`` is acyclic, so a build
        waiting on a dependency never deadlocks); small rollups then use executor
        slots a large scan leaves idle."""
        self.fact()
        if parallelism <= 1:
            for name in BUILDERS:
                self.table(name)
            return
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            for fut in [pool.submit(self.table, name) for name in BUILDERS]:
                fut.result()


_REGISTRY: dict[tuple[str, int, str], Warehouse] = {}
_REGISTRY_LOCK = threading.Lock()


def _app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", "app")


def fixture_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The session's warehouse over the fixture views of ``sf_dir`` (one per session)."""
    key = (_app_id(spark), id(spark), sf_dir.rstrip("/"))
    with _REGISTRY_LOCK:
        wh = _REGISTRY.get(key)
        if wh is None or wh.spark is not spark:
            tag = hashlib.sha1(key[2].encode()).hexdigest()[:10]
            root = join_path(shared_dir(spark), "loanscope", f"{key[0]}-{tag}-{uuid.uuid4().hex[:8]}")
            wh = Warehouse(spark, root, fixture_sources(spark, sf_dir), sf_dir=sf_dir)
            _REGISTRY[key] = wh
        return wh
