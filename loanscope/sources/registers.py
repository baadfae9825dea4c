"""Yearly register files: scan (S1, S2), harmonise (S3), multi-file load (S4), audit.

Two layouts exist: the modified register (85 columns, read by position) and the
public register (99 named columns, three of them under older names).  Both end
as the 85-column all-text fact schema, with '' for anything absent.

* Plain (unzipped) text goes through ``spark.read.csv``: splittable, so a large
  file is read by many tasks.  This is the path for data at scale.
* Zipped text goes through the ``zipped_delimited`` Python data source: one
  input partition per zip member (deflate streams cannot be split), parsed by
  Arrow's streaming CSV reader and shipped to the JVM as record batches.  Land it once as Parquet
  (``sinks.write_fact``) and work from there.
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
import os
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from loanscope.schema import LAR_TO_MLAR_RENAMES, MLAR_COLUMNS, MLAR_SCHEMA
from loanscope.session import ship_package

ARROW_BLOCK_BYTES = 8 << 20


# ---------------------------------------------------------------------------
# Zipped, delimited text as a Python data source
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class ZipMember(InputPartition):
    path: str
    member: str


def filesystem(path: str):
    """(pyarrow filesystem, path in it): mounted paths and ``file:`` URIs, or the store that a URI names.

    A scheme that pyarrow has no filesystem for is an error, never a local folder of that name.
    """
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), os.path.abspath(path)
    return fs.FileSystem.from_uri("s3" + path[3:] if path.startswith("s3a:") else path)


def _zip(path: str) -> zipfile.ZipFile:
    where, name = filesystem(path)
    return zipfile.ZipFile(where.open_input_file(name))


def _zip_paths(path: str) -> list[str]:
    """The zip files of ``path``: itself, or every zip below it if it is a folder."""
    from pyarrow import fs
    where, name = filesystem(path)
    if where.get_file_info(name).type != fs.FileType.Directory:
        return [path]
    found = where.get_file_info(fs.FileSelector(name, recursive=True))
    # Below the given path, so that a URI keeps its scheme and authority.
    base, inner = path.rstrip("/"), len(name.rstrip("/"))
    return sorted(f"{base}/{f.path[inner:].lstrip('/')}" for f in found if f.type == fs.FileType.File and f.path.lower().endswith(".zip"))


def _members(path: str, member: str | None) -> list[str]:
    if member:
        return [member]
    with _zip(path) as zf:
        return [n for n in zf.namelist() if not n.endswith("/")]


def _header(path: str, member: str, sep: str) -> list[str]:
    """The member's own column names, de-duplicated; an empty member has none."""
    with _zip(path) as zf, io.TextIOWrapper(zf.open(member), encoding="utf-8", newline="") as text:
        return dedupe_header(next(csv.reader(text, delimiter=sep), []))


def dedupe_header(names: Sequence[str]) -> list[str]:
    """Unique column names; on a repeated name the *last* column keeps it."""
    out, seen = [], set()
    for i in range(len(names) - 1, -1, -1):
        n = names[i]
        out.append(n if n not in seen else f"{n}__dup{i}")
        seen.add(n)
    return out[::-1]


@dataclass(frozen=True)
class ZipEntry:
    """A member of a zip: its header's names and its size unpacked."""
    path: str
    member: str
    header: tuple[str, ...]
    size: int


def manifest(spark: SparkSession, zips: Sequence[tuple[str, str | None]], sep: str = "|") -> dict[tuple[str, str | None], list[ZipEntry]]:
    """What is in the zips, each (a zip or a folder of zips, member or None for every member): folders are listed here, central
    directories and header lines are read by one job, a task per zip."""
    import pyarrow as pa
    listed = [(i, z, m) for i, (p, m) in enumerate(zips) for z in _zip_paths(p)]
    found: dict[tuple[str, str | None], list[ZipEntry]] = {(p, m): [] for p, m in zips}
    if not listed:
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                with _zip(r["path"]) as zf:
                    for n, info in enumerate([zf.getinfo(r["member"])] if r["member"] else [x for x in zf.infolist() if not x.is_dir()]):
                        with io.TextIOWrapper(zf.open(info), encoding="utf-8", newline="") as text:
                            header = dedupe_header(next(csv.reader(text, delimiter=sep), []))
                        out.append({"i": r["i"], "path": r["path"], "n": n, "member": info.filename, "header": header, "size": info.file_size})
            kinds = [("i", pa.int64()), ("path", pa.string()), ("n", pa.int64()), ("member", pa.string()), ("header", pa.list_(pa.string())), ("size", pa.int64())]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(kinds))

    ship_package(spark)
    rows = spark.createDataFrame(listed, "i long, path string, member string").repartition(len(listed), "i", "path")
    told = rows.mapInArrow(run, "i long, path string, n long, member string, header array<string>, size long").collect()  # a line per member
    for r in sorted(told, key=lambda r: (r["i"], r["path"], r["n"])):
        found[zips[r["i"]]].append(ZipEntry(r["path"], r["member"], tuple(r["header"]), r["size"]))
    return found


class ZipDelimitedReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema = schema
        self.members = members_option(options)
        self.sep = options.get("sep", "|")
        self.by_name = options.get("layout", "position") == "name"
        self.required = json.loads(options["required"]) if options.get("required") else [f.name for f in schema.fields]

    def partitions(self) -> list[InputPartition]:
        return [ZipMember(p, m) for p, m, _ in self.members]

    def read(self, partition: ZipMember) -> Iterator:
        """Arrow's streaming CSV reader over the decompressed member.

        By position every row must have the schema's width.  By name the member's own header places the
        columns (absent ones are null); fields beyond the header are ignored, and a row that ends
        before the last column that is required is an error.
        """
        import pyarrow as pa
        from pyarrow import csv as pacsv

        wanted = [f.name for f in self.schema.fields]
        names = _header(partition.path, partition.member, self.sep) if self.by_name else wanted
        if not names:
            return
        need = max((names.index(n) for n in self.required if n in names), default=-1) + 1 if self.by_name else len(names)
        odd: list[str] = []
        wrong: list[str] = []

        def uneven(row) -> str:
            if not self.by_name or row.actual_columns < need:
                wrong.append(f"{partition.path}:{partition.member} line {row.number}: {row.actual_columns} fields, expected {need}")
                return "error"
            odd.append(row.text)
            return "skip"

        def batch(columns: dict, rows: int):
            return pa.RecordBatch.from_arrays([columns.get(n, pa.nulls(rows, pa.string())) for n in wanted], names=wanted)

        def given_back():
            parsed = [(r + [""] * len(names))[:len(names)] for r in csv.reader(odd, delimiter=self.sep)]
            odd.clear()
            return batch({n: pa.array([r[i] for r in parsed], pa.string()) for i, n in enumerate(names)}, len(parsed))

        with _zip(partition.path) as zf, zf.open(partition.member) as stream:
            try:
                reader = pacsv.open_csv(
                    stream, pacsv.ReadOptions(block_size=ARROW_BLOCK_BYTES, skip_rows=1, column_names=names, use_threads=False),
                    pacsv.ParseOptions(delimiter=self.sep, quote_char='"', double_quote=True, newlines_in_values=True,
                                       ignore_empty_lines=False, invalid_row_handler=uneven),
                    pacsv.ConvertOptions(column_types={n: pa.string() for n in names}, strings_can_be_null=False))
                for part in reader:
                    if part.num_rows:
                        yield batch(dict(zip(names, part.columns)), part.num_rows)
                    if odd:
                        yield given_back()
            except pa.ArrowInvalid as e:
                raise ValueError(wrong[0] if wrong else f"{partition.path}:{partition.member}: {e}") from e
            if odd:
                yield given_back()


def members_option(options: dict) -> list[tuple[str, str, list[str] | None]]:
    """(zip, member, header) of option ``members`` (a manifest as JSON, its headers told once each), else of ``paths`` (a JSON list) or
    ``path`` (one file or a folder), folders listed and zips opened one by one, headers not read."""
    if options.get("members"):
        told = json.loads(options["members"])
        return [(p, m, told["headers"][h]) for p, m, h in told["members"]]
    given = json.loads(options["paths"]) if options.get("paths") else [options["path"]]
    return [(z, m, None) for p in given for z in _zip_paths(p) for m in _members(z, options.get("member") or None)]


def as_option(entries: Sequence[ZipEntry]) -> str:
    headers = list(dict.fromkeys(e.header for e in entries))
    place = {h: i for i, h in enumerate(headers)}
    return json.dumps({"headers": headers, "members": [(e.path, e.member, place[e.header]) for e in entries]})


class ZipDelimitedSource(DataSource):
    """``spark.read.format("zipped_delimited")``: options ``path`` (a zip or a folder of zips) or ``paths`` (a JSON
    list of them), ``member`` (default: every member), ``sep`` ('|'), ``layout`` ('position': the given schema's
    columns in order; 'name': by each member's header).  Without a schema the columns are all members' header names."""

    @classmethod
    def name(cls) -> str:
        return "zipped_delimited"

    def schema(self):
        sep = self.options.get("sep", "|")
        names = dict.fromkeys(n for p, m, header in members_option(self.options) for n in (_header(p, m, sep) if header is None else header))
        return T.StructType([T.StructField(n, T.StringType(), True) for n in names])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ZipDelimitedReader(schema, self.options)


def register_sources(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(ZipDelimitedSource)


def read_zip(spark: SparkSession, path: str | Sequence[str], member: str | None = None,
             schema: T.StructType | None = None, sep: str = "|", required: Sequence[str] | None = None,
             entries: Sequence[ZipEntry] | None = None) -> DataFrame:
    """Rows of zipped delimited text, all columns text: by position with a schema, else by each
    member's own header; then ``required`` names the columns that no row may end before (default: all).
    ``entries``: the zips' manifest, if it was made before."""
    register_sources(spark)
    if entries is None:
        paths = [path] if isinstance(path, str) else list(path)
        entries = [e for of in manifest(spark, [(p, member) for p in paths], sep).values() for e in of]
    r = (spark.read.format("zipped_delimited").option("members", as_option(entries)).option("sep", sep)
         .option("layout", "name" if schema is None else "position"))
    if required is not None:
        r = r.option("required", json.dumps(list(required)))
    if schema is not None:
        r = r.schema(schema)
    return r.load()


def extracted_name(path: str, member: str) -> str:
    """File name of an extracted member: its own name after a digest of the zip's whole path and the member's."""
    digest = hashlib.sha256(f"{path}\0{member}".encode()).hexdigest()[:20]
    return f"{digest}-{os.path.basename(member)}"


def extract_members(spark: SparkSession, zips: Sequence[tuple[str, str | None]], out_dir: str) -> dict[tuple[str, str], str]:
    """S1 for large members: one task per zip member, all zips in one job, streams its decompressed
    bytes (zlib, no parsing) to ``out_dir``; the text is then read by the splittable CSV
    reader, so parsing is spread over the cluster however large one member is.

    ``zips`` is (zip path, member or None for every member).  Each file is written under a temporary
    name and renamed, so a retried task leaves one whole copy.  Returns the text path of each
    (zip path, member).
    """
    pairs = list(dict.fromkeys((e.path, e.member) for of in manifest(spark, zips).values() for e in of))
    if not pairs:
        return {}
    base = out_dir.rstrip("/")
    targets = {(p, m): f"{base}/{extracted_name(p, m)}" for p, m in pairs}

    def extract(batches):
        import shutil
        import uuid

        import pandas as pd
        for pdf in batches:
            for path, member, target in zip(pdf["path"], pdf["member"], pdf["target"]):
                where, name = filesystem(target)
                where.create_dir(os.path.dirname(name), recursive=True)
                part = f"{name}.{uuid.uuid4().hex[:8]}.part"  # of this attempt alone
                with _zip(path) as zf, zf.open(member) as src, where.open_output_stream(part) as dst:
                    shutil.copyfileobj(src, dst, 16 << 20)
                where.move(part, name)
            yield pd.DataFrame({"done": [len(pdf)]})

    ship_package(spark)
    rows = spark.createDataFrame([(p, m, t) for (p, m), t in targets.items()], "path string, member string, target string")
    done = rows.repartition(len(pairs), "target").mapInPandas(extract, "done long").agg(F.sum("done")).first()[0]
    if done != len(pairs):
        raise RuntimeError(f"{done} of {len(pairs)} members extracted")
    return targets


# ---------------------------------------------------------------------------
# Plain text, both layouts
# ---------------------------------------------------------------------------
def _csv(spark: SparkSession, sep: str):
    # Without pruning every row's width is checked, whatever columns a query asks for.
    return (spark.read.option("sep", sep).option("header", True).option("quote", '"').option("escape", '"')
            .option("enforceSchema", True).option("columnPruning", False))


def read_mlar_text(spark: SparkSession, path: str | Sequence[str], sep: str = "|") -> DataFrame:
    """Modified-register text, 85 columns by position (the header is not compared); a row of another
    width is an error."""
    return _csv(spark, sep).option("mode", "FAILFAST").schema(MLAR_SCHEMA).csv(path).na.fill("")


def lar_header(spark: SparkSession, path: str, sep: str = "|") -> list[str]:
    """A public-register text's column names (one line to the driver); of equal names the last column keeps it.  An empty text has none."""
    first = spark.read.text(path).first()
    return dedupe_header(next(csv.reader([first[0]], delimiter=sep, quotechar='"'), [])) if first else []


def read_lar_text(spark: SparkSession, path: str | Sequence[str], sep: str = "|", names: Sequence[str] | None = None) -> DataFrame:
    """Public-register text with its own header names, all text, read by position with that schema.

    Fields beyond the header are ignored; a row that ends before the last column of the 85 is an error.
    Several texts are read as one if they share the header ``names``.
    """
    names = lar_header(spark, path, sep) if names is None else list(names)
    if not names:  # an empty text has no rows, as an empty zip member
        return spark.createDataFrame([], MLAR_SCHEMA)
    wanted = renamed_columns(names)
    need = max((names.index(wanted[c]) for c in MLAR_COLUMNS if c in wanted), default=-1) + 1
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in [*names, "_uneven"]])
    df = (_csv(spark, sep).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_uneven").schema(schema).csv(path))
    unquoted = F.regexp_replace("_uneven", r'"(?:[^"]|"")*"', "")
    fields = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(sep))) + 1
    short = F.when(F.col("_uneven").isNotNull() & (fields < need), F.raise_error(
        F.concat(F.lit(path) if isinstance(path, str) else F.input_file_name(), F.lit(": "), fields.cast("string"), F.lit(f" fields, expected {need}: "), F.col("_uneven"))))
    return df.na.fill("", subset=names).filter(F.coalesce(short.cast("boolean"), F.lit(True))).drop("_uneven")


# ---------------------------------------------------------------------------
# S3: harmonise a public-register frame onto the 85-column schema
# ---------------------------------------------------------------------------
def renamed_columns(columns: Sequence[str]) -> dict[str, str]:
    """Target name -> source column after the renames (last duplicate wins)."""
    out: dict[str, str] = {}
    for c in columns:
        base = c.split("__dup")[0] if "__dup" in c else c
        if "__dup" in c:
            continue
        out[LAR_TO_MLAR_RENAMES.get(base, base)] = c
    return out


def harmonise(df: DataFrame) -> DataFrame:
    """S3: rename, reorder by name, drop extras, fill absent columns with ''."""
    src = renamed_columns(df.columns)
    return df.select(*[(F.coalesce(F.col(f"`{src[c]}`"), F.lit("")) if c in src else F.lit("")).alias(c)
                       for c in MLAR_COLUMNS])


def missing_columns(columns: Sequence[str]) -> list[str]:
    """The 85-column names a public-register header does not provide."""
    src = renamed_columns(columns)
    return [c for c in MLAR_COLUMNS if c not in src]


# ---------------------------------------------------------------------------
# A list of yearly files, oldest first, absent files skipped
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class RegisterFile:
    path: str
    layout: str                  # 'lar' or 'mlar'
    member: str | None = None    # zip member; None for plain text or every member


def _texts(spark: SparkSession, f: RegisterFile, paths: Sequence[str], headers: Sequence[tuple[str, ...]] | None = None) -> DataFrame:
    if f.layout == "mlar":
        return read_mlar_text(spark, list(paths))
    # Each text has its own header; those of one header are one reader.
    alike: dict[tuple[str, ...], list[str]] = {}
    for path, names in zip(paths, headers or [tuple(lar_header(spark, p)) for p in paths]):
        alike.setdefault(names, []).append(path)
    return reduce(DataFrame.unionByName, [harmonise(read_lar_text(spark, ps if len(ps) > 1 else ps[0], names=h)) for h, ps in alike.items()])


def read_register(spark: SparkSession, f: RegisterFile, extracted: Sequence[str] | None = None,
                  entries: Sequence[ZipEntry] | None = None) -> DataFrame:
    """One file in its layout, harmonised to the 85 columns, tagged with ``source_file`` (its path).

    ``extracted``: the texts of a zip's members (``extract_members``), read as splittable text;
    without them the zip data source parses the zip directly (``entries``: its manifest).
    """
    if f.layout not in ("lar", "mlar"):
        raise ValueError(f"layout must be 'lar' or 'mlar', not {f.layout!r}")
    if not is_zip(f):
        df = _texts(spark, f, [f.path])
    elif extracted:
        df = _texts(spark, f, extracted, [e.header for e in entries] if entries else None)
    elif f.layout == "mlar":
        df = read_zip(spark, f.path, f.member, MLAR_SCHEMA, entries=entries)
    else:
        df = harmonise(read_zip(spark, f.path, f.member, required=[*MLAR_COLUMNS, *LAR_TO_MLAR_RENAMES], entries=entries))
    return df.withColumn("source_file", F.lit(f.path))


def is_zip(f: RegisterFile) -> bool:
    """Whether a register is a zip or a folder that holds zips (else text, as one file or a folder of part files)."""
    if f.path.lower().endswith(".zip"):
        return True
    try:
        return _zip_paths(f.path) not in ([], [f.path])
    except (OSError, ValueError):  # a store that only Spark reads: text
        return False


def absent_columns(spark: SparkSession, files: Sequence[RegisterFile]) -> dict[str, list[str]]:
    """For each public-register file the names of the 85 columns that its header (any member's) lacks; zips by one job."""
    public = [f for f in files if f.layout == "lar"]
    zipped = manifest(spark, [(f.path, f.member) for f in public if is_zip(f)])
    out = {}
    for f in public:
        names = [n for e in zipped[f.path, f.member] for n in e.header] if is_zip(f) else lar_header(spark, f.path)
        out[f.path] = missing_columns(names)
    return out


def absent_column_table(spark: SparkSession, files: Sequence[RegisterFile]) -> DataFrame:
    """S6 as rows: (source_file, column) of the columns that public-register files lack."""
    rows = [(path, c) for path, names in absent_columns(spark, files).items() for c in names]
    return spark.createDataFrame(rows, "source_file string, column string")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file exists: local paths directly, other stores through Spark's own file listing
    (a lazy ``binaryFile`` read fails on a missing path, reads no bytes).  Only "not found" is
    absence: a store that cannot be reached or read is an error."""
    if "://" not in path or path.startswith("file:"):
        return os.path.exists(filesystem(path)[1])
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def present_files(spark: SparkSession, files: Sequence[RegisterFile], exists=None) -> tuple[list[RegisterFile], list[str]]:
    """(files that exist, paths of those that do not); ``exists`` checks a path (default: ``path_exists``)."""
    flags = [(exists or (lambda p: path_exists(spark, p)))(f.path) for f in files]
    return [f for f, ok in zip(files, flags) if ok], [f.path for f, ok in zip(files, flags) if not ok]


def load_registers(spark: SparkSession, files: Sequence[RegisterFile],
                   exists=None, extract_dir: str | None = None) -> tuple[DataFrame | None, list[str]]:
    """S4 + U1: union of every present file (one reader per file and layout); returns (rows, missing paths).

    A path may be a folder of zips.  With ``extract_dir`` all members of all zips are first extracted there, in one job.
    """
    present, missing = present_files(spark, files, exists)
    if not present:
        return None, missing
    zips = [(f.path, f.member) for f in present if is_zip(f)]
    listed = manifest(spark, zips)  # one job for all files
    texts = extract_members(spark, zips, extract_dir) if extract_dir else {}
    own = lambda f: [texts[e.path, e.member] for e in listed.get((f.path, f.member), []) if texts]
    return reduce(DataFrame.unionByName, [read_register(spark, f, own(f), listed.get((f.path, f.member))) for f in present]), missing


def ingest_audit(rows: DataFrame) -> DataFrame:
    """Rows per source file."""
    return rows.groupBy("source_file").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


def year_summary(fact: DataFrame) -> DataFrame:
    """Per year, applications and originations, by year."""
    return (fact.groupBy(F.col("activity_year")).agg(
        F.count(F.lit(1)).cast("bigint").alias("apps"),
        F.sum(F.when(F.col("action_taken") == "1", 1).otherwise(0)).cast("bigint").alias("originated"))
        .coalesce(1).sortWithinPartitions("activity_year"))  # one row per year


def total_rows(fact: DataFrame) -> DataFrame:
    """S8."""
    return fact.agg(F.count(F.lit(1)).cast("bigint").alias("total"))
