"""Access to the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; the scan prunes columns and pushes filters down."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan over at least ``min_partitions`` tasks (default: the cluster's
    parallelism) when its files give fewer splits, e.g. one large single-row-group
    file.  A scan that already has enough splits is returned unchanged, so at scale
    (thousands of files) this adds nothing."""
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # no RDD API (Spark Connect): leave the layout to the planner
        return df
    return df.repartition(want) if have < want else df
