"""Batch jobs: ingest (S4-S7), payload build (S13) and payload load."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loanscope.operators import cubes, ranking, reports
from loanscope.plans.views import lender_profile_cube
from loanscope.plans.warehouse import Warehouse
from loanscope.schema import (BIZ_PURPOSE_LABELS, DTI_ORDER, LIEN_LABELS, LOAN_PURPOSE_LABELS, LTV_ORDER, NON_AM_LABELS,
                              NON_AM_ORDER, OCCUPANCY_LABELS, PURCHASER_LABELS, SPREAD_ORDER)
from loanscope.session import join_path, shared_dir
from loanscope.sources import documents as docs
from loanscope.sources import registers, sinks

QUALITY_ORDERS = {"dti": DTI_ORDER, "ltv": LTV_ORDER, "spread": SPREAD_ORDER, "non_am": NON_AM_ORDER}
QUALITY_LABELS = {"purchaser": PURCHASER_LABELS, "lien": LIEN_LABELS, "non_am": NON_AM_LABELS}
INVESTOR_LABELS = {"occupancy": OCCUPANCY_LABELS, "biz_purpose": BIZ_PURPOSE_LABELS, "loan_purpose": LOAN_PURPOSE_LABELS}


def ingest(spark: SparkSession, files: Sequence[registers.RegisterFile], out_path: str,
           exists=None, extract_dir: str | None = None) -> dict:
    """Load the yearly files, publish the fact table's new version (``sinks.write_fact``), and return the audit tables.

    ``extract_dir`` (a shared folder) switches zips to extract-then-parse: one task
    per member streams bytes, the CSV reader parses the text in parallel.  A path without a scheme
    is taken as a folder that is mounted on every executor."""
    present, missing = registers.present_files(spark, files, exists)
    if not present:
        raise FileNotFoundError(f"no register file found; missing: {missing}")
    rows, _ = registers.load_registers(spark, present, exists=lambda _: True, extract_dir=extract_dir)
    # Rows per file are counted while the fact is written: the raw files are parsed once.
    counted = Observation("rows per file")
    seen = rows.observe(counted, *[F.count(F.when(F.col("source_file") == f.path, 1)).alias(f"f{i}") for i, f in enumerate(present)])
    fact_rows = seen.drop("source_file")
    sinks.write_fact(fact_rows, out_path)
    per_file = [(f.path, counted.get[f"f{i}"]) for i, f in enumerate(present)]
    fact = sinks.read_fact(spark, out_path, fact_rows.schema)
    return {"missing_files": missing,
            "missing_columns": registers.absent_columns(spark, present),  # names by file
            "rows_per_file": spark.createDataFrame(per_file, "source_file string, rows bigint"),
            "year_summary": registers.year_summary(fact),
            "total": registers.total_rows(fact)}


def payloads(wh: Warehouse) -> dict[str, dict[str, DataFrame]]:
    """The six payloads in their fixed order, each a set of named tables."""
    return {
        "national": {
            "summary": reports.summary(wh.table("lender_base")),
            "by_action": reports.by_action(wh.table("main")),
            "by_loan_type": reports.by_loan_type(wh.table("main")),
            "by_loan_purpose": reports.by_loan_purpose(wh.table("main")),
            "rate_distribution": wh.table("rate_distribution"),
            "denial_reasons": reports.denial_reasons(wh.table("denials")),
        },
        "geographic": {
            "county_names": wh.table("county_names"),
            "state_cube": cubes.round_cells(wh.table("state")),
            "county_cube": cubes.round_cells(wh.table("county")),
        },
        "cube": {"main": wh.table("main"), "rates": wh.table("rates"), "denials": wh.table("denials")},
        "lenders": {
            "names": wh.table("lender_names"),
            "cube": cubes.round_cells(wh.table("lender")),
            "states": ranking.nest_top_states(wh.table("lender_states")),
        },
        "quality": {
            "cube": cubes.round_cells(wh.table("quality")),
            "orders": sinks.static_member(wh.spark, QUALITY_ORDERS),
            "labels": sinks.static_member(wh.spark, QUALITY_LABELS),
        },
        "investor": {
            "national_cube": cubes.round_cells(wh.table("inv_national")),
            "state_cube": cubes.round_cells(wh.table("inv_state")),
            "county_cube": cubes.round_cells(wh.table("inv_county")),
            "labels": sinks.static_member(wh.spark, INVESTOR_LABELS),
        },
    }


def run_all(wh: Warehouse, out_dir: str, fmt: str = "parquet") -> dict[str, dict[str, str]]:
    """Write every payload table; one write action per table."""
    out = {}
    for payload, tables in payloads(wh).items():
        out[payload] = sinks.write_payload(tables, f"{out_dir.rstrip('/')}/{payload}", fmt)
    return out


def load_payload(spark: SparkSession, written: dict[str, dict[str, str]], fmt: str = "parquet"
                 ) -> dict[str, dict[str, DataFrame]]:
    """Read payload tables back."""
    rd = spark.read.json if fmt == "json" else spark.read.parquet
    return {p: {n: rd(path) for n, path in tables.items()} for p, tables in written.items()}


def documents(wh: Warehouse) -> dict[str, dict[str, tuple]]:
    """The members of each payload's JSON document, with their row order."""
    p = payloads(wh)
    by_count = lambda name: (p["national"][name], [F.desc("count"), F.asc("code")])
    keyed = lambda payload, name, *keys: (p[payload][name], list(keys))
    national = {"summary": (p["national"]["summary"], [])}
    for name in ("by_action", "by_loan_type", "by_loan_purpose"):
        national[name] = by_count(name)
    national["rate_distribution"] = keyed("national", "rate_distribution", "bucket")
    national["denial_reasons"] = by_count("denial_reasons")
    return {
        "national": national,
        "geographic": {"county_names": keyed("geographic", "county_names", "fips"),
                       "state_cube": keyed("geographic", "state_cube", "y", "state", "a", "t", "p"),
                       "county_cube": keyed("geographic", "county_cube", "y", "fips", "a", "t", "p")},
        "cube": {"main": keyed("cube", "main", "y", "a", "t", "p"), "rates": keyed("cube", "rates", "y", "t", "p", "bucket"),
                 "denials": keyed("cube", "denials", "y", "t", "p", "reason")},
        "lenders": {"names": keyed("lenders", "names", "lei"), "cube": (lender_profile_cube(wh.table("lender")), ["l", "a", "t", "p"]),
                    "states": keyed("lenders", "states", "lei")},
        "quality": {"cube": keyed("quality", "cube", "y", "a", "t", "p", "d", "l", "pu", "rs", "li", "nm"),
                    "orders": (QUALITY_ORDERS, ()), "labels": (QUALITY_LABELS, ())},
        "investor": {"national_cube": keyed("investor", "national_cube", "y", "occ", "bp", "p"),
                     "state_cube": keyed("investor", "state_cube", "y", "state", "occ", "bp", "p"),
                     "county_cube": keyed("investor", "county_cube", "y", "fips", "occ", "bp", "p"),
                     "labels": (INVESTOR_LABELS, ())},
    }


def write_documents(wh: Warehouse, out_dir: str) -> dict[str, str]:
    """The six payloads in their fixed order, one JSON document each; the national report and the main cubes
    indented, the report in one file, the others compact."""
    out = {}
    for name, members in documents(wh).items():
        out[name] = f"{out_dir.rstrip('/')}/{name}"
        sinks.write_document(members, out[name], indent=name in ("national", "cube"), bounded=name == "national")
    return out


_CELL = "c bigint, s bigint, r double, rc bigint"
_REPORT = "code string, count bigint, pct double, avg_loan double, label string"
# The members of each payload's document and their columns; members without columns are lists or dictionaries.
DOCUMENT_MEMBERS: dict[str, dict[str, str | None]] = {
    "national": {"summary": "total_apps bigint, originated bigint, denied bigint, lender_count bigint, avg_loan double, total_volume_b double, avg_rate double",
                 "by_action": _REPORT, "by_loan_type": _REPORT, "by_loan_purpose": _REPORT, "rate_distribution": "bucket string, count bigint",
                 "denial_reasons": "code string, count bigint, label string"},
    "geographic": {"county_names": "fips string, county_name string", "state_cube": f"y string, state string, a string, t string, p string, {_CELL}",
                   "county_cube": f"y string, fips string, a string, t string, p string, {_CELL}, state string"},
    "cube": {"main": "y string, a string, t string, p string, c bigint, s double, r double, rc bigint",
             "rates": "y string, t string, p string, bucket string, c bigint", "denials": "y string, t string, p string, reason string, c bigint"},
    "lenders": {"names": "lei string, name string", "cube": f"l string, a string, t string, p string, {_CELL}",
                "states": "lei string, states array<struct<state:string,count:bigint>>"},
    "quality": {"cube": f"y string, a string, t string, p string, d string, l string, pu string, rs string, li string, nm string, {_CELL}",
                "orders": None, "labels": None},
    "investor": {"national_cube": f"y string, occ string, bp string, p string, {_CELL}",
                 "state_cube": "y string, state string, occ string, bp string, p string, c bigint, s bigint",
                 "county_cube": "y string, fips string, occ string, bp string, p string, c bigint, s bigint, state string", "labels": None},
}


def load_documents(spark: SparkSession, paths: Mapping[str, str], chunk_bytes: int = docs.CHUNK_BYTES) -> dict[str, dict[str, DataFrame]]:
    """The tables of written payload documents by payload (a file or a folder of part files each), every member of ``DOCUMENT_MEMBERS``;
    orders and labels as (dim, pos, code, label).  A document that is none is an error.  ``chunk_bytes`` is the least that a task
    reads; it reads more of large documents (``documents.chunk_size``).

    The documents are taken apart once, into Parquet by payload and member in the shared folder."""
    rows, broken = docs.read_documents(spark, paths, docs.chunk_size(spark, paths, chunk_bytes))
    if broken:
        raise docs.BrokenDocument("; ".join(broken.values()))
    landed = join_path(shared_dir(spark), "documents", uuid.uuid4().hex)
    rows.withColumn("of", F.concat_ws("-", "document", "member")).write.partitionBy("of").parquet(landed)
    parsed = spark.read.schema(f"{docs.ROW_SCHEMA}, of string").parquet(landed)
    out: dict[str, dict[str, DataFrame]] = {}
    for payload in paths:
        own = {m: parsed.filter(F.col("of") == f"{payload}-{m}") for m in DOCUMENT_MEMBERS[payload]}
        out[payload] = {m: docs.member_table(own[m], m, ddl) if ddl else docs.entries_table(own[m], m) for m, ddl in DOCUMENT_MEMBERS[payload].items()}
    return out
