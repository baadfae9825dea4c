"""Stand-in registers derived from the driver's TPC-H-like tables.

The test tables hold no mortgage data, so three views are derived from them:
``lar`` (one application per line item, 21 queried columns), ``filers``
(year, lei, name) and ``county`` (the county reference file).  The SQL texts
are the fixture specification; the same ``LAR_SQL`` text runs in Spark and in
the DuckDB oracle.  In Spark, ``filers`` and ``county`` enumerate their small
code sets (years: at most 8 values, county numbers: at most 29 values) with an
uncorrelated scalar subquery and ``explode`` instead of a cartesian product.
"""

from __future__ import annotations

import os
import zipfile
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.session import ship_package, unsorted_writes
from loanscope.sources.tables import ensure_parallelism, read_table

# FIXED VALUES: fixture definitions (test-data specification).
LAR_SQL = """SELECT
 cast(2018 + (l_orderkey % 8) as string) AS activity_year,
 concat('LEI', lpad(cast(l_suppkey as string), 17, '0')) AS lei,
 CASE WHEN k = 19 THEN '-1' ELSE cast(1 + (l_linenumber % 4) as string) END AS loan_type,
 CASE WHEN k = 19 THEN '-1' ELSE (CASE l_partkey % 6 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '31' WHEN 3 THEN '32' WHEN 4 THEN '4' ELSE '5' END) END AS loan_purpose,
 CASE WHEN k < 9 THEN '1' WHEN k < 12 THEN '3' WHEN k = 12 THEN '2' WHEN k < 15 THEN '4' WHEN k < 19 THEN cast(k - 10 as string) ELSE '-1' END AS action_taken,
 CASE WHEN k = 19 THEN '5000' ELSE concat(cast(1 + (l_partkey * 7 + l_orderkey) % 90 as string), '5000') END AS loan_amount,
 CASE (l_orderkey + l_partkey) % 13 WHEN 0 THEN 'NA' WHEN 1 THEN 'Exempt' WHEN 2 THEN '' ELSE concat(cast(2 + (l_partkey + l_suppkey) % 9 as string), '.', lpad(cast((l_orderkey * 125) % 1000 as string), 3, '0')) END AS interest_rate,
 CASE c_nationkey % 14 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' WHEN 2 THEN 'FL' WHEN 3 THEN 'NY' WHEN 4 THEN 'IL' WHEN 5 THEN 'HI' WHEN 6 THEN 'WA' WHEN 7 THEN 'MA' WHEN 8 THEN 'MS' WHEN 9 THEN 'WV' WHEN 10 THEN 'AZ' WHEN 11 THEN 'PR' WHEN 12 THEN 'NA' ELSE '' END AS state_code,
 CASE WHEN c_custkey % 41 = 0 THEN 'NA' WHEN c_custkey % 43 = 0 THEN '' ELSE concat(lpad(cast(1 + c_nationkey % 14 as string), 2, '0'), lpad(cast(1 + 2 * (c_custkey % 29) as string), 3, '0')) END AS county_code,
 CASE l_partkey % 12 WHEN 10 THEN '1111' WHEN 11 THEN '' ELSE cast(1 + l_partkey % 12 as string) END AS denial_reason_1,
 CASE l_partkey % 10 WHEN 0 THEN 'NA' WHEN 1 THEN 'Exempt' WHEN 2 THEN '' WHEN 3 THEN '<20%' WHEN 4 THEN '20%-<30%' WHEN 5 THEN '30%-<36%' WHEN 6 THEN '50%-60%' WHEN 7 THEN '>60%' ELSE cast(36 + l_orderkey % 14 as string) END AS debt_to_income_ratio,
 CASE l_orderkey % 12 WHEN 0 THEN 'NA' WHEN 1 THEN 'Exempt' WHEN 2 THEN '' ELSE concat(cast(50 + l_partkey % 56 as string), '.', cast(l_linenumber % 2 * 5 as string)) END AS combined_loan_to_value_ratio,
 CASE l_suppkey % 11 WHEN 7 THEN '71' WHEN 10 THEN '72' ELSE cast(l_suppkey % 11 as string) END AS purchaser_type,
 CASE l_orderkey % 9 WHEN 0 THEN 'NA' WHEN 1 THEN 'Exempt' WHEN 2 THEN '' WHEN 3 THEN '-0.250' ELSE concat(cast(l_partkey % 6 as string), '.5') END AS rate_spread,
 CASE l_partkey % 7 WHEN 6 THEN '1111' ELSE cast(1 + l_partkey % 2 as string) END AS lien_status,
 CASE l_partkey % 8 WHEN 0 THEN '1' WHEN 1 THEN '1111' WHEN 2 THEN 'Exempt' ELSE '2' END AS balloon_payment,
 CASE WHEN l_partkey % 9 = 0 THEN '1' ELSE '2' END AS interest_only_payment,
 CASE WHEN l_partkey % 50 = 0 THEN '1' ELSE '2' END AS negative_amortization,
 CASE WHEN l_partkey % 25 = 3 THEN '1' ELSE '2' END AS other_non_amortizing_features,
 cast(1 + l_orderkey % 3 as string) AS occupancy_type,
 CASE l_partkey % 5 WHEN 0 THEN '1111' WHEN 1 THEN '1' ELSE '2' END AS business_or_commercial_purpose
FROM (SELECT *, (l_orderkey + 3 * l_linenumber + l_partkey) % 20 AS k FROM {lineitem}) li
JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey"""

# Spark form: the same select list over rows that are joined already (``lar_rows``).
LAR_SQL_SPARK = LAR_SQL[:LAR_SQL.rindex("\nJOIN {orders}")]

_STATE_CASE = ("CASE {n} % 14 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' WHEN 2 THEN 'FL' WHEN 3 THEN 'NY' "
               "WHEN 4 THEN 'IL' WHEN 5 THEN 'HI' WHEN 6 THEN 'WA' WHEN 7 THEN 'MA' WHEN 8 THEN 'MS' "
               "WHEN 9 THEN 'WV' WHEN 10 THEN 'AZ' WHEN 11 THEN 'PR' WHEN 12 THEN 'GU' ELSE '' END")
# Some names are empty, so that lookups fall back ('', 'Unknown', the LEI); no row is left out.
_NAME_CASE = ("CASE WHEN s_suppkey % 17 = 0 OR (s_suppkey + {yr}) % 5 = 0 THEN '' "
              "WHEN {yr} >= 2022 THEN concat(s_name, ' Bank') ELSE s_name END")
_COUNTY_CASE = ("CASE WHEN {c} = 7 THEN '' ELSE concat('County ', cast(1 + {n} % 14 as string), '-', "
                "cast({c} as string)) END")

# Oracle (DuckDB) forms: the specification text.
FILERS_SQL_ORACLE = ("SELECT y.yr AS year, concat('LEI', lpad(cast(s_suppkey as string), 17, '0')) AS lei,\n "
                     + _NAME_CASE.format(yr="y.yr") + " AS name\n"
                     "FROM supplier CROSS JOIN (SELECT DISTINCT 2018 + (n_nationkey % 8) AS yr FROM nation) y")

COUNTY_SQL_ORACLE = ("SELECT DISTINCT lpad(cast(1 + n.n_nationkey % 14 as string), 2, '0') AS STATEFP,\n "
                     + _STATE_CASE.format(n="n.n_nationkey") + " AS STATE,\n"
                     " lpad(cast(1 + 2 * (c.c_custkey % 29) as string), 3, '0') AS COUNTYFP,\n"
                     " " + _COUNTY_CASE.format(c="(c.c_custkey % 29)", n="n.n_nationkey") + " AS COUNTYNAME\n"
                     "FROM nation n CROSS JOIN customer c")

# Spark forms: each supplier row fans out to at most 8 filing years, each nation
# row to at most 29 county numbers.
FILERS_SQL_SPARK = ("SELECT yr AS year, concat('LEI', lpad(cast(s_suppkey as string), 17, '0')) AS lei,\n "
                    + _NAME_CASE.format(yr="yr") + " AS name\n"
                    "FROM {supplier} LATERAL VIEW explode((SELECT collect_set(2018 + (n_nationkey % 8)) FROM {nation})) y AS yr")

COUNTY_SQL_SPARK = ("SELECT DISTINCT lpad(cast(1 + n_nationkey % 14 as string), 2, '0') AS STATEFP,\n "
                    + _STATE_CASE.format(n="n_nationkey") + " AS STATE,\n"
                    " lpad(cast(1 + 2 * ck as string), 3, '0') AS COUNTYFP,\n"
                    " " + _COUNTY_CASE.format(c="ck", n="n_nationkey") + " AS COUNTYNAME\n"
                    "FROM {nation} LATERAL VIEW explode((SELECT collect_set(c_custkey % 29) FROM {customer})) c AS ck")


def lar_oracle_sql() -> str:
    return LAR_SQL.format(lineitem="lineitem", orders="orders", customer="customer")


def with_oracle_views(select_sql: str, *views: str) -> str:
    """Prefix an oracle SELECT with the fixture views it reads (``lar``, ``filers``, ``county``)."""
    defs = {"lar": lar_oracle_sql(), "filers": FILERS_SQL_ORACLE, "county": COUNTY_SQL_ORACLE}
    names = views or ("lar",)
    return "WITH " + ",\n".join(f"{v} AS (\n{defs[v]}\n)" for v in names) + "\n" + select_sql


def lar_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The few numbers behind each application.  Orders meet their customers first, so the line items are shuffled once."""
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_custkey", "c_nationkey")
    lineitem = ensure_parallelism(read_table(spark, sf_dir, "lineitem")
                                  .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    return lineitem.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


def lar(spark: SparkSession, sf_dir: str, by_year: bool = False) -> DataFrame:
    """The 21-column application fixture (one row per line item).

    ``by_year`` gathers the rows of a year in few partitions (as ``sinks.write_fact`` would) while they are
    still a few numbers: a quarter of the bytes of their text columns.
    """
    rows = lar_rows(spark, sf_dir)
    if by_year:
        rows = rows.withColumn("y", F.col("l_orderkey") % 8).hint("rebalance", F.col("y"))
    return spark.sql(LAR_SQL_SPARK, lineitem=rows)


def filers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filer names per year (year int, lei, name)."""
    return spark.sql(FILERS_SQL_SPARK, supplier=read_table(spark, sf_dir, "supplier"),
                     nation=read_table(spark, sf_dir, "nation"))


def county(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County reference rows (STATEFP, STATE, COUNTYFP, COUNTYNAME)."""
    return spark.sql(COUNTY_SQL_SPARK, nation=read_table(spark, sf_dir, "nation"),
                     customer=read_table(spark, sf_dir, "customer"))


TEXT_ROWS = 1 << 20  # of a text file at most: a gzipped file is read by one task


def write_text(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Fixture helper: the rows as gzipped pipe text with a header, empty values bare as in the registers, by folders of ``partition``."""
    w = (df.write.mode("overwrite").option("sep", "|").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "")
         .option("compression", "gzip").option("maxRecordsPerFile", TEXT_ROWS))
    with unsorted_writes(df.sparkSession):
        (w.partitionBy(partition) if partition else w).csv(path)


def add_gzipped(zf: zipfile.ZipFile, name: str, raw: BinaryIO, size: int) -> None:
    """A gzip file of one member and ``size`` bytes (``raw`` can seek) as member ``name`` of a zip, without packing it again: both formats
    hold the same deflate stream, checksum and length."""
    head = raw.read(10)
    if head[:3] != b"\x1f\x8b\x08":
        raise ValueError(f"{name}: no gzip file")
    flags = head[3]
    if flags & 4:
        raw.seek(int.from_bytes(raw.read(2), "little"), os.SEEK_CUR)
    for flag in (8, 16):  # file name and comment, ended by a zero
        while flags & flag and raw.read(1) not in (b"\0", b""):
            pass
    if flags & 2:
        raw.seek(2, os.SEEK_CUR)
    begin = raw.tell()
    raw.seek(size - 8)
    tail = raw.read(8)
    info = zipfile.ZipInfo(name)
    info.compress_type = zipfile.ZIP_DEFLATED
    info.CRC, info.file_size, info.compress_size = int.from_bytes(tail[:4], "little"), int.from_bytes(tail[4:], "little"), size - 8 - begin
    info.header_offset = zf.fp.tell()
    zf.fp.write(info.FileHeader())
    raw.seek(begin)
    left = info.compress_size
    while left:
        block = raw.read(min(left, 4 << 20))
        if not block:
            raise ValueError(f"{name}: cut short")
        zf.fp.write(block)
        left -= len(block)
    zf.filelist.append(info)
    zf.NameToInfo[name] = info
    zf.start_dir = zf.fp.tell()


def zip_folder(spark: SparkSession, text_dir: str, out_dir: str, zip_name: str = "{stem}.zip") -> str:
    """Fixture helper: zip the gzipped texts (``write_text``) below ``text_dir`` as the yearly registers are published.

    Each folder of text files becomes one zip in the folder of the same name below ``out_dir``, its files the
    members; one task per folder, which only copies what the tasks that wrote the texts have packed.  Returns
    ``out_dir``; no list of files passes through the driver.
    """
    def pack(key, pdf):
        import pandas as pd

        from loanscope.sources.registers import filesystem
        where, base = filesystem(out_dir)
        folder = os.path.join(base, os.path.relpath(key[0], filesystem(text_dir)[1]))
        where.create_dir(folder, recursive=True)
        target = os.path.join(folder, zip_name.format(stem=os.path.basename(key[0])))
        with where.open_output_stream(target) as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as zf:
            for path in sorted(pdf["path"]):
                source, name = filesystem(path)
                with source.open_input_file(name) as src:
                    add_gzipped(zf, os.path.basename(name).removesuffix(".gz"), src, src.size())
        return pd.DataFrame({"files": [len(pdf)]})

    ship_package(spark)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(text_dir)
             .select(F.regexp_replace("path", "^file:/*", "/").alias("path")))
    folders = files.withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    folders.groupBy("folder").applyInPandas(pack, "files long").agg(F.sum("files")).collect()
    return out_dir
