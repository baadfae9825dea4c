"""Sinks: the fact table (S5), payload tables (S12) and CSV exports."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanscope.schema import STATE_NAMES
from loanscope.session import join_path, unsorted_writes
from loanscope.sources.registers import filesystem, path_exists


def write_fact(df: DataFrame, path: str, max_records_per_file: int = 5_000_000, gathered: bool = False) -> None:
    """Full refresh of the fact table, Parquet partitioned by activity_year, as a version of its own.

    The rows go to a new folder below ``path``; when all are written, one row appended to the manifest publishes them.
    Readers follow the manifest, so a refresh that fails or is killed leaves the table as it was, and a reader
    that began before keeps its files.  ``drop_old_versions`` removes what is no longer needed.

    A REBALANCE hint gathers a year's rows in few write tasks, so the write makes few files however the
    input mixes the years; adaptive execution splits a year that is larger than a task should hold.
    ``gathered``: the rows come dealt by year already.  No task sorts its rows, however wide they are.
    """
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    dealt = df if gathered else df.hint("rebalance", F.col("activity_year"))
    with unsorted_writes(spark):
        (dealt.write.option("maxRecordsPerFile", max_records_per_file).partitionBy("activity_year").parquet(join_path(path, version)))
    number = max([n for n, _ in versions(spark, path)], default=0) + 1
    # An append of one file: it is either there as a whole or not at all.
    spark.createDataFrame([(number, version)], MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(join_path(path, MANIFEST))


MANIFEST, MANIFEST_SCHEMA = "manifest", "number long, version string"


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Published versions (number, folder) of a table, oldest first; none if it was never published."""
    manifest = join_path(path, MANIFEST)
    if not path_exists(spark, manifest):
        return []
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(manifest).orderBy("number", "version").collect()
    return [(r["number"], r["version"]) for r in rows]


def read_fact(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The fact table's last published version, with its own column types (the year stays text, whatever partition values look like).

    A partitioned write stores an empty year as the null partition; it is read back as ''.
    """
    published = versions(spark, path)
    if not published:
        raise FileNotFoundError(f"no published version of a table in {path}")
    reader = spark.read.schema(schema) if schema else spark.read
    rows = reader.parquet(join_path(path, published[-1][1]))
    return rows.withColumn("activity_year", F.coalesce(F.col("activity_year").cast("string"), F.lit("")))


def drop_old_versions(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove all but the last ``keep`` published versions and whatever unpublished ones failed refreshes left; returns their folders.

    To be run when no refresh is under way and no reader is on an older version."""
    from pyarrow import fs
    published = [v for _, v in versions(spark, path)]
    where, name = filesystem(path)
    found = [f.base_name for f in where.get_file_info(fs.FileSelector(name)) if f.type == fs.FileType.Directory and f.base_name.startswith("v-")]
    gone = sorted(v for v in found if v not in published[-max(1, keep):])
    for v in gone:
        where.delete_dir(f"{name.rstrip('/')}/{v}")
    return gone


def write_payload(tables: Mapping[str, DataFrame], out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """One table per payload member (``parquet`` by default, or JSON lines)."""
    written = {}
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        w = df.write.mode("overwrite")
        (w.json(path) if fmt == "json" else w.parquet(path))
        written[name] = path
    return written


def plain_number(x: Column) -> Column:
    """A number as JavaScript prints it: no exponent, no fraction if whole; NULL is ''."""
    text = F.regexp_replace(x.cast("string").cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    return F.coalesce(F.when(x == 0, "0").otherwise(text), F.lit(""))


def csv_field(df: DataFrame, name: str) -> Column:
    """A column as CSV text: plain numbers, NULL empty, quoted if it holds a quote, comma or newline."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return plain_number(F.col(f"`{name}`"))
    text = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
    return F.when(text.rlike('[",\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def csv_lines(df: DataFrame, order: Sequence[str], headers: Mapping[str, str] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """(value): the header line and a line per row by ``order``; for bounded tables (views, charts)."""
    names = [c for c in df.columns if c not in drop]
    head = ",".join('"' + h.replace('"', '""') + '"' if any(x in h for x in '",\n') else h for h in
                    ((headers or {}).get(c, c) for c in names))
    body = df.select(F.lit(1).alias("_part"), *[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)],
                     F.concat_ws(",", *[csv_field(df, c) for c in names]).alias("value"))
    first = df.sparkSession.range(1).select(F.lit(0).alias("_part"), *[F.lit(None).cast(df.schema[c].dataType).alias(f"_o{i}")
                                                                      for i, c in enumerate(order)], F.lit(head).alias("value"))
    keys = ["_part", *[f"_o{i}" for i in range(len(order))]]
    return first.unionByName(body).coalesce(1).sortWithinPartitions(*keys).select("value")


def write_csv_lines(lines: DataFrame, path: str) -> None:
    """One CSV file."""
    lines.coalesce(1).write.mode("overwrite").text(path)


def compare_csv_lines(table: DataFrame, states: Sequence[str]) -> DataFrame:
    """``Year`` and one ``XX - Name`` column per state of the comparison table, in selection order."""
    shown = [s for s in dict.fromkeys(states) if s in table.columns]
    headers = {"y": "Year"} | {s: f"{s} - {STATE_NAMES.get(s, s)}" for s in shown}
    return csv_lines(table.select("y", *shown), ["y"], headers)


def write_compare_csv(table: DataFrame, states: Sequence[str], path: str) -> None:
    """The comparison table as one CSV file (bounded: years x selected states)."""
    write_csv_lines(compare_csv_lines(table, states), path)


def chart_csv_lines(long: DataFrame) -> DataFrame:
    """S16 for a chart with several series (R4's long form: code, label, y, c, pos): ``Category``, then one column per
    series in order; one row per year."""
    # The series of a chart: as many as its codes.
    series = [(r["label"], r["pos"]) for r in long.select("label", "pos").distinct().orderBy("pos").collect()]
    wide = long.groupBy("y").agg(*[F.max(F.when(F.col("pos") == p, F.col("c"))).alias(f"s{p}") for _, p in series])
    return csv_lines(wide, ["y"], {"y": "Category"} | {f"s{p}": label for label, p in series})


def single_chart_csv_lines(df: DataFrame, label: str, value: str, title: str, order: Sequence[str]) -> DataFrame:
    """S16 for a chart with one unlabelled series: ``Category`` and the title's column."""
    keep = df.select(label, value, *[c for c in order if c not in (label, value)])
    return csv_lines(keep, order, {label: "Category", value: title}, [c for c in order if c not in (label, value)])


def write_series_csv(df: DataFrame, path: str, order: Sequence[str] = (), category: str = "Category") -> None:
    """Any bounded view as one CSV file, its first column named ``category``."""
    write_csv_lines(csv_lines(df, list(order), {df.columns[0]: category}), path)


def static_member(spark: SparkSession, groups: Mapping[str, Sequence | Mapping[str, str]]) -> DataFrame:
    """A payload's labels or orders as rows (dim, pos, code, label); in an order the label is the code."""
    rows = [(dim, i, code, label) for dim, values in groups.items()
            for i, (code, label) in enumerate(values.items() if isinstance(values, Mapping) else ((v, v) for v in values))]
    return spark.createDataFrame(rows, "dim string, pos int, code string, label string")


def document_lines(members: Mapping[str, tuple[DataFrame | Mapping, Sequence[str]]], indent: bool = False,
                   bounded: bool = False) -> DataFrame:
    """The lines (part, seq, value) of one JSON document, an object with a field for each member.

    A member is (table, key columns) - an array of its rows by key, one row to a line -, (one-row table, ()) - an
    object -, or (constant, ()) - plain JSON.  Lines are in order of partitions: rows are range-sorted by key and nothing
    is gathered; the row that needs no comma before it is the one with the smallest key.  ``bounded`` tables (reports,
    views) are numbered instead (``seq``), so that the lines can be sorted into one file.
    """
    spark = next(t.sparkSession for t, _ in members.values() if isinstance(t, DataFrame))
    json_options = {"pretty": str(indent).lower(), "ignoreNullFields": "false"}

    def line(part: int, text: str) -> DataFrame:
        return spark.range(1).select(F.lit(part).alias("part"), F.lit(0).alias("seq"), F.lit(text).alias("value"))

    out, part = [], 0
    for i, (name, (table, keys)) in enumerate(members.items()):
        opening = ("{" if i == 0 else ",") + json.dumps(name) + ":"
        if not isinstance(table, DataFrame):
            out.append(line(part, opening + json.dumps(table, indent=2 if indent else None)))
            part += 1
            continue
        row = F.to_json(F.struct(*table.columns), json_options)
        if not keys:
            out.append(table.select(F.lit(part).alias("part"), F.lit(0).alias("seq"), F.concat(F.lit(opening), row).alias("value")))
            part += 1
            continue
        if bounded:
            seq = F.row_number().over(Window.orderBy(*keys))
            lead = F.when(seq == 1, "").otherwise(",")
            rows = table.select(F.lit(part + 1).alias("part"), seq.alias("seq"), F.concat(lead, row).alias("value"))
        else:
            first = table.select(*keys).orderBy(*keys).first()
            is_first = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(first[k])) for k in keys]) if first else F.lit(True)
            rows = table.orderBy(*keys).select(F.lit(part + 1).alias("part"), F.lit(0).alias("seq"),
                                               F.concat(F.when(is_first, "").otherwise(","), row).alias("value"))
        out += [line(part, opening + "["), rows, line(part + 2, "]")]
        part += 3
    out.append(line(part, "}"))
    return reduce(DataFrame.unionByName, out)


def write_document(members: Mapping[str, tuple[DataFrame | Mapping, Sequence[str]]], path: str, indent: bool = False,
                   bounded: bool = False) -> None:
    """One JSON document: the part files of ``path`` one after the other, in the order of their names;
    ``bounded`` members make one file."""
    lines = document_lines(members, indent, bounded)
    if bounded:
        lines = lines.coalesce(1).sortWithinPartitions("part", "seq")
    lines.select("value").write.mode("overwrite").text(path)
