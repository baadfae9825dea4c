"""What grows with the fact table: rows dealt while narrow, bounded tasks, register texts packed once (F1-F12 of round 3)."""

import glob
import gzip
import io
import os
import zipfile

from conftest import SF_SMALL
from loanscope.plans import catalog, warehouse
from loanscope.plans.warehouse import Warehouse, fixture_sources
from loanscope.schema import QUERIED_COLUMNS
from loanscope.sources import fixture, registers, sinks


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_fact_rows_are_dealt_by_year_while_they_are_numbers(spark):
    dealt = fixture.lar(spark, SF_SMALL, by_year=True)
    plan = _plan(dealt)
    assert plan.count("RebalancePartitions") == 1
    assert plan.index("AS activity_year") < plan.index("RebalancePartitions")  # the text columns are made above it
    assert fixture_sources(spark, SF_SMALL).gathered
    rows = lambda df: sorted(map(tuple, df.select(*QUERIED_COLUMNS).collect()), key=str)
    assert rows(dealt) == rows(fixture.lar(spark, SF_SMALL))


def test_line_items_are_joined_once(spark):
    joins = [x for x in _plan(fixture.lar(spark, SF_SMALL)).splitlines() if "Join Inner" in x]
    assert [("l_orderkey" in x, "o_custkey" in x) for x in joins] == [(True, False), (False, True)]


def test_fact_write_keeps_every_row_and_restores_the_setting(spark, scratch):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    rows = fixture.lar(spark, SF_SMALL)
    with sinks.unsorted_writes(spark):
        assert int(spark.conf.get(key)) >= 8  # the register's years
    sinks.write_fact(rows, f"{scratch}/fact")
    assert spark.conf.get(key) == before
    back = sinks.read_fact(spark, f"{scratch}/fact", rows.schema)
    assert back.select(*QUERIED_COLUMNS).exceptAll(rows).isEmpty() and back.count() == rows.count()


def test_scans_and_buckets_follow_the_rows_of_the_fact_table(spark, scratch, monkeypatch):
    monkeypatch.setattr(warehouse, "TASK_ROWS", 100)
    before = spark.conf.get(warehouse.SPLITS, None)
    try:
        wh = Warehouse(spark, f"{scratch}/wh", fixture_sources(spark, SF_SMALL))
        tasks = -(-wh.fact().count() // 100)
        assert tasks > spark.sparkContext.defaultParallelism
        assert int(spark.conf.get(warehouse.SPLITS)) == tasks and wh._buckets() == tasks
    finally:
        spark.conf.unset(warehouse.SPLITS) if before is None else spark.conf.set(warehouse.SPLITS, before)


def test_zips_hold_the_packed_texts_as_they_are(spark, scratch):
    rows = spark.createDataFrame([(str(i), 'a|"b"' if i % 3 else "", None) for i in range(5000)], "x string, y string, z string").repartition(3)
    fixture.write_text(rows, f"{scratch}/text/one")
    fixture.zip_folder(spark, f"{scratch}/text", f"{scratch}/zip")
    (zipped,) = glob.glob(f"{scratch}/zip/**/*.zip", recursive=True)
    texts = {os.path.basename(p)[:-3]: gzip.open(p).read() for p in glob.glob(f"{scratch}/text/one/part-*.gz")}
    with zipfile.ZipFile(zipped) as zf:
        assert zf.testzip() is None and len(texts) == 3
        assert {n: zf.read(n) for n in zf.namelist()} == texts
    back = registers.read_zip(spark, zipped, required=["x"])
    assert sorted((r.x, r.y, r.z) for r in back.collect()) == sorted((r.x, r.y, r.z or "") for r in rows.collect())


def test_gzip_headers_with_names_and_extras(tmp_path):
    packed = gzip.compress(b"a|b\n1|2\n")
    for flags, extra in ((4 | 8 | 16 | 2, b"\x03\0xyz" + b"name\0" + b"said\0" + b"\0\0"), (0, b"")):
        raw = packed[:3] + bytes([flags]) + packed[4:10] + extra + packed[10:]
        with zipfile.ZipFile(tmp_path / "z.zip", "w", zipfile.ZIP_DEFLATED) as zf:
            fixture.add_gzipped(zf, "t", io.BytesIO(raw), len(raw))
        with zipfile.ZipFile(tmp_path / "z.zip") as zf:
            assert zf.read("t") == b"a|b\n1|2\n"


def test_extracted_texts_of_one_header_are_one_reader(spark, scratch):
    rows = catalog.as_lar_layout(fixture.lar(spark, SF_SMALL).limit(300)).repartition(4)
    fixture.write_text(rows, f"{scratch}/text/one")
    fixture.zip_folder(spark, f"{scratch}/text", f"{scratch}/zip", "r.zip")
    f = registers.RegisterFile(f"{scratch}/zip/one/r.zip", "lar")
    got, missing = registers.load_registers(spark, [f], extract_dir=f"{scratch}/out")
    assert not missing and len(os.listdir(f"{scratch}/out")) == 4
    assert _plan(got).count("Relation [") == 1 and len(got.collect()) == 300
    plain, _ = registers.load_registers(spark, [f])
    assert sorted(got.collect(), key=str) == sorted(plain.collect(), key=str)
