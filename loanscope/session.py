"""Session construction and the shared folder for landed tables."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults that matter at any scale: AQE re-plans joins and coalesces shuffle
# partitions at run time, skew-join splitting is on, partition values stay
# strings (activity_year is text in the register), and no UI server is started.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MB = 1 << 20


def sizing_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * MB,
                shuffle_fraction: float = 0.25, max_partitions: int = 100_000) -> dict[str, str]:
    """Shuffle sizing for a job over ``input_bytes`` of fact data on ``total_cores`` cores.

    The widest shuffle of the cube job is the quality cube, whose cells can approach
    the row count; it carries only its projected columns (about a quarter of the
    85 text columns), hence ``shuffle_fraction``.  The initial partition count
    gives ``target_partition_bytes`` per reducer (at least two waves of the
    cluster, at most ``max_partitions`` so map x reduce shuffle blocks stay
    manageable).  AQE coalesces the many small shuffles (rollups, views) down to
    the advisory size, so starting high costs little and keeps reducers within
    executor memory instead of spilling.
    """
    wanted = -(-int(input_bytes * shuffle_fraction) // target_partition_bytes)
    initial = min(max(2 * total_cores, wanted, 200), max_partitions)
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def get_session(master: str | None = None, app_name: str = "loanscope",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None, input_bytes: int | None = None,
                total_cores: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults applied.

    ``input_bytes`` / ``total_cores`` (the cluster's executor cores) size the
    shuffles with ``sizing_conf``; ``shuffle_partitions`` sets the count directly.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    if input_bytes:
        merged.update(sizing_conf(input_bytes, total_cores or os.cpu_count() or 8))
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for k, v in merged.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    """A runtime setting for what runs inside, then as it was."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def unsorted_writes(spark: SparkSession, folders: int = 16):
    """Partitioned writes inside keep up to ``folders`` files of a task open instead of sorting its rows by folder first;
    a task with more folders sorts from there on."""
    return setting(spark, "spark.sql.maxConcurrentOutputFileWriters", folders)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for landed tables: ``spark.checkpoint.dir``.

    The setting is read from the session.  Only a local-mode session without
    one (tests) gets a fresh folder of its own; a cluster without the setting
    is an error, because a machine-local folder is not visible to executors.
    """
    d = None
    try:
        d = spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect sessions have no SparkContext
        d = None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/NFS) "
                           "before landing tables on a cluster")
    d = tempfile.mkdtemp(prefix="loanscope-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(d)
        return spark.sparkContext.getCheckpointDir() or d
    except Exception:
        return d


def join_path(base: str, *parts: str) -> str:
    base = base.rstrip("/")
    return "/".join([base, *[p.strip("/") for p in parts]])


def local_path(uri: str) -> str | None:
    """Filesystem path for a ``file:`` URI or plain path; None for remote stores."""
    if uri.startswith("file:"):
        return uri[len("file:"):]
    if "://" in uri:
        return None
    return uri if os.path.isabs(uri) else os.path.abspath(uri)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in executor Python workers (once per application).

    Only the zipped-register data source and the file helpers run Python on
    executors.  The package is zipped and handed to ``addPyFile``, which Spark
    distributes to every executor itself.
    """
    import zipfile

    import loanscope
    try:
        key = spark.sparkContext.applicationId
    except Exception:
        key = spark.conf.get("spark.app.id", "app")
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(loanscope.__file__))
    folder = local_path(shared_dir(spark)) or tempfile.mkdtemp(prefix="loanscope-pyfiles-")
    folder = os.path.join(folder, "loanscope-pyfiles")
    os.makedirs(folder, exist_ok=True)
    target = os.path.join(folder, f"loanscope-{key}.zip")
    with zipfile.ZipFile(target + ".part", "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.join("loanscope", os.path.relpath(full, pkg)))
    os.replace(target + ".part", target)
    try:
        spark.sparkContext.addPyFile(target)
    except Exception:  # Spark Connect
        spark.addArtifacts(target, pyfile=True)
    _SHIPPED.add(key)
