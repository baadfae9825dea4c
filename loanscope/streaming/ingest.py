"""File-stream ingest of register text and additive cube upkeep."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loanscope.operators.cubes import YATP, build_cube, rollup, M4
from loanscope.schema import MLAR_SCHEMA
from loanscope.session import join_path, shared_dir
from loanscope.sources.registers import harmonise


def register_stream(spark: SparkSession, watch_dir: str, layout: str = "mlar",
                    columns: Sequence[str] | None = None, sep: str = "|",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming rows of plain register files dropped into ``watch_dir``.

    ``mlar`` files are read by position; ``lar`` files need their header names
    (``columns``), since a stream cannot infer a schema, and are harmonised.
    """
    if layout == "mlar":
        schema = MLAR_SCHEMA
    elif layout == "lar" and columns:
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    else:
        raise ValueError("layout must be 'mlar', or 'lar' with its column names")
    r = (spark.readStream.schema(schema).option("sep", sep).option("header", True).option("quote", '"')
         .option("escape", '"').option("mode", "FAILFAST"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = r.csv(watch_dir).na.fill("")
    return rows if layout == "mlar" else harmonise(rows)


def _checkpoint(spark: SparkSession, name: str, target: str) -> str:
    return join_path(shared_dir(spark), "loanscope-streams", name, hashlib.sha1(target.encode()).hexdigest()[:12])


def start_fact_stream(spark: SparkSession, watch_dir: str, fact_path: str, layout: str = "mlar",
                      columns: Sequence[str] | None = None, checkpoint: str | None = None,
                      available_now: bool = True) -> StreamingQuery:
    """Append new files' rows to the fact table (Parquet, partitioned by activity_year).

    The file sink with a checkpoint in the shared folder gives exactly-once
    appends across restarts and lost executors.
    """
    rows = register_stream(spark, watch_dir, layout, columns)
    w = (rows.writeStream.format("parquet").option("path", fact_path)
         .option("checkpointLocation", checkpoint or _checkpoint(spark, "fact", fact_path))
         .partitionBy("activity_year").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_cube_upkeep(spark: SparkSession, watch_dir: str, cube_dir: str, layout: str = "mlar",
                      columns: Sequence[str] | None = None, checkpoint: str | None = None,
                      available_now: bool = True) -> StreamingQuery:
    """Keep the main cube (y, a, t, p) current: each micro-batch writes its partial
    cube to ``deltas/epoch=<id>`` (overwritten if the epoch is replayed, so a retry
    never double counts); ``read_cube_deltas`` rolls the deltas up."""
    rows = register_stream(spark, watch_dir, layout, columns)

    def upkeep(batch: DataFrame, epoch_id: int) -> None:
        (build_cube(batch, YATP).write.mode("overwrite")
         .parquet(join_path(cube_dir, "deltas", f"epoch={epoch_id}")))

    w = (rows.writeStream.foreachBatch(upkeep)
         .option("checkpointLocation", checkpoint or _checkpoint(spark, "cube", cube_dir)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_cube_deltas(spark: SparkSession, cube_dir: str, keys: Sequence[str] = ("y", "a", "t", "p")) -> DataFrame:
    """The current cube: the sum of every batch's partial cube (measures are additive)."""
    deltas = spark.read.parquet(join_path(cube_dir, "deltas")).drop("epoch")
    return rollup(deltas, list(keys), None, M4)
