"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.session import join_path, shared_dir

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

# Rows of whole texts handed to Python at a time: bounds a worker's memory when texts are long.
ARROW_ROWS = 256
MATCHES_AT_ONCE = 64


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage (a lost executor costs a re-read), fixes values that later
    steps use more than once, and gives the planner real sizes for its joins.
    """
    spark = df.sparkSession
    path = join_path(shared_dir(spark), "llm", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Lower the rows per Arrow batch (a runtime setting) for operators that pass whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def text_of(df: DataFrame, col: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(df[col], F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(df: DataFrame) -> DataFrame:
    """Each row of ``df`` as one struct column ``row``, so that further columns clash with no name of the input; ``unpacked`` gives it back."""
    return df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once however often ``body`` names it (also inside of lambdas)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def match_spans(text: Column, pattern: str | Column, measure: Callable[[Column], Column] = F.length) -> Column:
    """Array of (s, e, m): every leftmost non-overlapping match with its offsets, end exclusive, in units of ``measure``.

    ``regexp_extract_all`` gives the matches and ``split`` the pieces between them; both walk
    the text with the same matcher, so piece and match lengths add up to the offsets.
    ``pattern`` must not match the empty string.  Offsets are summed in chunks of matches, then over the chunks, as
    appending to one long array would copy it for each match.
    """
    found = F.regexp_extract_all(text, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(0))
    none = F.expr("cast(array() as array<struct<s:int,e:int,m:string>>)")

    def with_offsets(m: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1 if isinstance(pattern, str) else F.lit(-1)), F.lit(1), F.size(m))
        pairs = F.zip_with(gaps, m, lambda g, x: F.struct(measure(g).alias("g"), measure(x).alias("n"), x.alias("m")))
        return let(pairs, lambda p: let(chunked(p), lambda c: F.flatten(F.zip_with(c, chunk_starts(c), shifted))))

    def chunked(p: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), ((F.size(p) - 1) / MATCHES_AT_ONCE).cast("int")),
                           lambda i: F.aggregate(F.slice(p, i * MATCHES_AT_ONCE + 1, MATCHES_AT_ONCE), F.struct(F.lit(0).alias("at"), none.alias("out")), add))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["g"]
        span = F.struct(start.alias("s"), (start + x["n"]).alias("e"), x["m"].alias("m"))
        return F.struct((start + x["n"]).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def chunk_starts(c: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
        return F.aggregate(c, zero, lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
                           lambda acc: acc["out"])

    def shifted(chunk: Column, start: Column) -> Column:
        return F.transform(chunk["out"], lambda x: F.struct((x["s"] + start).alias("s"), (x["e"] + start).alias("e"), x["m"].alias("m")))

    return let(found, lambda m: F.when(F.size(m) == 0, none).otherwise(with_offsets(m)))
