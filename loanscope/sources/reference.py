"""Reference files: the county list (S9) and the filer lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.sources.documents import read_documents
from loanscope.sources.registers import path_exists

COUNTY_COLUMNS = ("STATEFP", "STATE", "COUNTYFP", "COUNTYNAME")

def county_dimension(raw: DataFrame) -> DataFrame:
    """(STATEFP, STATE, COUNTYFP, COUNTYNAME, pos); ``pos`` keeps file order for last-row-wins."""
    if "pos" not in raw.columns:
        raw = raw.withColumn("pos", F.monotonically_increasing_id())
    return raw.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in COUNTY_COLUMNS], "pos")


def read_county_file(spark: SparkSession, path: str) -> DataFrame:
    """The pipe-delimited county reference file, all text, empty fields as ''."""
    raw = (spark.read.option("sep", "|").option("header", True).option("quote", '"')
           .option("escape", '"').option("inferSchema", False).csv(path))
    return county_dimension(raw.withColumn("pos", F.monotonically_increasing_id()))


def present_years(spark: SparkSession, paths_by_year: dict[int, str]) -> dict[int, str]:
    return {year: path for year, path in sorted(paths_by_year.items()) if path_exists(spark, path)}


def _institutions(spark: SparkSession, paths_by_year: dict[int, str]) -> tuple[DataFrame, list[int]]:
    """(year, pos, inst) of the present documents, and the years that are none or have no list; ``inst.broken`` is the text of an entry that does not parse."""
    rows, broken = read_documents(spark, {str(year): path for year, path in present_years(spark, paths_by_year).items()})
    own = rows.filter(F.col("member") == "institutions")
    listed = {r[0] for r in own.filter("value is null").select("document").distinct().collect()}  # at most one per path
    options = {"columnNameOfCorruptRecord": "broken"}
    parsed = own.filter("value is not null").select(
        F.col("document").cast("int").alias("year"), "pos", F.from_json("value", "lei string, name string, broken string", options).alias("inst"))
    return parsed, sorted({int(d) for d in broken} | {y for y in present_years(spark, paths_by_year) if str(y) not in listed | {*broken}})


def read_filer_files(spark: SparkSession, paths_by_year: dict[int, str]) -> DataFrame:
    """JSON documents per year (a file or a folder of them), ``{"institutions": [{"lei", "name"}]}`` ->
    (year, lei, name, pos).

    A year whose file is missing or does not parse is skipped (``skipped_years`` tells which); ``pos`` grows along
    the document's list.  The lists are read in chunks (``documents``), an institution to a row, however long a list is.
    """
    rows, _ = _institutions(spark, paths_by_year)
    broken = rows.filter("inst.broken is not null").select("year").distinct()
    return rows.join(broken, "year", "left_anti").select("year", F.col("inst.lei").alias("lei"), F.col("inst.name").alias("name"), "pos")


def skipped_years(spark: SparkSession, paths_by_year: dict[int, str]) -> list[int]:
    """The years whose filer list is missing or holds a document that does not parse (at most one per path)."""
    rows, none = _institutions(spark, paths_by_year)
    broken = [r[0] for r in rows.filter("inst.broken is not null").select("year").distinct().collect()]
    return sorted({*paths_by_year} - {*present_years(spark, paths_by_year)} | {*none} | {*broken})


def lender_names(filers: DataFrame) -> DataFrame:
    """(lei, name): the later year wins; inside a year the later entry wins."""
    src = filers if "pos" in filers.columns else filers.withColumn("pos", F.monotonically_increasing_id())
    return src.groupBy("lei").agg(F.max_by("name", F.struct("year", "pos")).alias("name"))
