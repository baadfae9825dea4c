"""Ingest round trip: the fixture rows written as zipped and plain register files
in both layouts, read back through S1-S4, compared with the rows."""

import csv
import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from loanscope.plans import jobs
from loanscope.schema import LAR_TO_MLAR_RENAMES, MLAR_COLUMNS, QUERIED_COLUMNS
from loanscope.sources import fixture, registers, sinks
from tests.conftest import SF_SMALL

MLAR_TO_LAR = {v: k for k, v in LAR_TO_MLAR_RENAMES.items()}


def _write_zip(path, member, header, rows):
    buf = io.StringIO()
    w = csv.writer(buf, delimiter="|", lineterminator="\n")
    w.writerow(header)
    w.writerows(rows)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr(member, buf.getvalue())


@pytest.fixture(scope="module")
def rows(spark):
    pdf = fixture.lar(spark, SF_SMALL).toPandas()
    pdf.loc[pdf.index[0], "denial_reason_1"] = 'a|"b"'   # quoted field holding the delimiter and quotes
    return pdf


def _lar_layout(pdf):
    cols = list(reversed(pdf.columns))
    header = ["lei"] + [MLAR_TO_LAR.get(c, c) for c in cols] + ["derived_msa_md"]   # leading duplicate 'lei'
    data = [["junk"] + [r[c] for c in cols] + ["99999"] for r in pdf.to_dict("records")]
    return header, data


def _mlar_layout(pdf):
    header = [f"col{i}" for i in range(len(MLAR_COLUMNS))]   # header text is not compared
    data = [[r.get(c, "") for c in MLAR_COLUMNS] for r in pdf.to_dict("records")]
    return header, data


@pytest.mark.parametrize("extract", [False, True])
def test_round_trip_both_layouts(spark, rows, scratch, extract):
    files = []
    for year in sorted(rows["activity_year"].unique()):
        part = rows[rows["activity_year"] == year]
        if year < "2022":
            path = os.path.join(scratch, f"{year}_lar.zip")
            _write_zip(path, f"{year}_lar.txt", *_lar_layout(part))
            files.append(registers.RegisterFile(path, "lar", f"{year}_lar.txt"))
        else:
            path = os.path.join(scratch, f"{year}_combined_mlar_header.zip")
            _write_zip(path, f"{year}_combined_mlar_header.txt", *_mlar_layout(part))
            files.append(registers.RegisterFile(path, "mlar"))
    files.append(registers.RegisterFile(os.path.join(scratch, "2026_absent.zip"), "mlar"))
    out = jobs.ingest(spark, files, os.path.join(scratch, "fact"),
                      extract_dir=os.path.join(scratch, "text") if extract else None)
    assert out["missing_files"] == [os.path.join(scratch, "2026_absent.zip")]
    fact = sinks.read_fact(spark, os.path.join(scratch, "fact"))
    assert set(fact.columns) == set(MLAR_COLUMNS)
    got = sorted(tuple(r) for r in fact.select(*QUERIED_COLUMNS).collect())
    want = sorted(tuple(r[c] for c in QUERIED_COLUMNS) for r in rows.to_dict("records"))
    assert got == want
    absent = [c for c in MLAR_COLUMNS if c not in QUERIED_COLUMNS]
    assert fact.where(F.concat(*absent) != "").count() == 0
    per_file = {r["source_file"]: r["rows"] for r in out["rows_per_file"].collect()}
    assert sum(per_file.values()) == len(rows)
    assert out["total"].first()[0] == len(rows)


def test_missing_columns_report():
    header = ["activity_year", "lei", "other_nonamortizing_features", "extra"]
    missing = registers.missing_columns(header)
    assert "other_non_amortizing_features" not in missing and "lei" not in missing
    assert len(missing) == 85 - 3


def test_short_row_fails_fast(spark, scratch):
    path = os.path.join(scratch, "bad.zip")
    _write_zip(path, "bad.txt", [f"c{i}" for i in range(85)], [["x"] * 85, ["x"] * 10])
    with pytest.raises(Exception, match="10 fields, expected 85"):
        registers.read_zip(spark, path, schema=registers.MLAR_SCHEMA).collect()


def test_plain_text_mlar_is_positional(spark, rows, scratch):
    path = os.path.join(scratch, "2023.txt")
    header, data = _mlar_layout(rows.head(50))
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh, delimiter="|", lineterminator="\n")
        w.writerow(header)
        w.writerows(data)
    df = registers.read_mlar_text(spark, path)
    assert df.columns == MLAR_COLUMNS
    got = sorted(tuple(r) for r in df.select(*QUERIED_COLUMNS).collect())
    want = sorted(tuple(r[c] for c in QUERIED_COLUMNS) for r in rows.head(50).to_dict("records"))
    assert got == want


def test_reference_files(spark, scratch):
    from loanscope.sources import reference
    cpath = os.path.join(scratch, "county_fips.txt")
    with open(cpath, "w") as fh:
        fh.write("STATE|STATEFP|COUNTYFP|COUNTYNAME\nCA|06|075|San Francisco\nCA|06|001|Alameda\n"
                 "XX|06|001|Alameda Again\n")
    dim = reference.read_county_file(spark, cpath)
    from loanscope.operators.lookups import county_names, state_by_fips_prefix
    assert {r["prefix"]: r["state"] for r in state_by_fips_prefix(dim).collect()} == {"06": "XX"}
    assert {r["fips"]: r["county_name"] for r in county_names(dim).collect()}["06001"] == "Alameda Again"
    paths = {}
    for year, insts in [(2020, [("L1", "Old"), ("L2", "Two")]), (2022, [("L1", "New"), ("L1", "Newer")])]:
        p = os.path.join(scratch, f"filers_{year}.json")
        with open(p, "w") as fh:
            import json
            json.dump({"institutions": [{"lei": a, "name": b} for a, b in insts]}, fh)
        paths[year] = p
    names = reference.lender_names(reference.read_filer_files(spark, paths))
    assert {r["lei"]: r["name"] for r in names.collect()} == {"L1": "Newer", "L2": "Two"}


def test_path_exists(spark, scratch):
    p = os.path.join(scratch, "x.txt")
    open(p, "w").write("a")
    assert registers.path_exists(spark, p) and registers.path_exists(spark, "file:" + p)
    assert not registers.path_exists(spark, os.path.join(scratch, "nope.txt"))
    assert not registers.path_exists(spark, "file:" + os.path.join(scratch, "nope.txt"))


def _text(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh, delimiter="|", lineterminator="\n")
        w.writerow(header)
        w.writerows(rows)


@pytest.mark.parametrize("extract", [False, True])
def test_equal_names_in_different_folders(spark, scratch, extract):
    """Two zips of one name, and members that differ by a slash alone, stay apart."""
    for folder, year in (("a", "2018"), ("b", "2019")):
        os.makedirs(os.path.join(scratch, folder))
        with zipfile.ZipFile(os.path.join(scratch, folder, "lar.zip"), "w") as zf:
            zf.writestr("x/y.txt", f"activity_year|lei\n{year}|L1\n{year}|L2\n")
            zf.writestr("x_y.txt", f"activity_year|lei\n{year}|L3\n")
    files = [registers.RegisterFile(os.path.join(scratch, f, "lar.zip"), "lar") for f in "ab"]
    rows, missing = registers.load_registers(spark, files, extract_dir=os.path.join(scratch, "texts") if extract else None)
    got = sorted((r["activity_year"], r["lei"], r["source_file"]) for r in rows.collect())
    assert got == [(y, lei, f.path) for f, y in zip(files, ("2018", "2019")) for lei in ("L1", "L2", "L3")] and not missing


@pytest.mark.parametrize("extract", [False, True])
def test_every_member_has_its_own_header(spark, scratch, extract):
    path = os.path.join(scratch, "lar.zip")
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("1.txt", "activity_year|lei\n2019|L1\n")
        zf.writestr("2.txt", "lei|state_code|activity_year\nL2|CA|2020\n")
    rows, _ = registers.load_registers(spark, [registers.RegisterFile(path, "lar")], extract_dir=os.path.join(scratch, "t") if extract else None)
    assert sorted((r["activity_year"], r["lei"], r["state_code"]) for r in rows.collect()) == [("2019", "L1", ""), ("2020", "L2", "CA")]


@pytest.mark.parametrize("kind", ["zip", "extracted", "text"])
def test_public_rows_of_uneven_width(spark, scratch, kind):
    """Fields beyond the header are ignored; a row without a wanted column is an error."""
    def load(body, name):
        text = "junk|activity_year|lei|extra\n" + body
        path = os.path.join(scratch, name + (".txt" if kind == "text" else ".zip"))
        if kind == "text":
            open(path, "w").write(text)
        else:
            with zipfile.ZipFile(path, "w") as zf:
                zf.writestr("m.txt", text)
        rows, _ = registers.load_registers(spark, [registers.RegisterFile(path, "lar")],
                                           extract_dir=os.path.join(scratch, "t" + name) if kind == "extracted" else None)
        return sorted((r["activity_year"], r["lei"]) for r in rows.collect())

    assert load('j|2018|L1|x\nj|2018|"L|2"|x|y|"z|z"\nj|2018|L3\n', "long") == [("2018", "L1"), ("2018", "L3"), ("2018", "L|2")]
    with pytest.raises(Exception, match="2 fields, expected 3"):
        load("j|2018|L1|x\nj|2018\n", "short")


@pytest.mark.parametrize("width", [84, 86])
def test_modified_rows_must_have_85_fields(spark, scratch, width):
    rows = [["x"] * 85, ["x"] * width]
    path = os.path.join(scratch, "m.zip")
    _write_zip(path, "m.txt", MLAR_COLUMNS, rows)
    text = os.path.join(scratch, "m.txt")
    _text(text, MLAR_COLUMNS, rows)
    for f, to in ((path, None), (path, os.path.join(scratch, "t")), (text, None)):
        with pytest.raises(Exception):
            registers.load_registers(spark, [registers.RegisterFile(f, "mlar")], extract_dir=to)[0].collect()


def test_quoting_and_paths_with_commas(spark, scratch):
    path = os.path.join(scratch, "a,b", "2019,x.zip")
    os.makedirs(os.path.dirname(path))
    values = ["", "a|b", 'say "hi"', "two\nlines", " padded ", "é"]
    _write_zip(path, "m.txt", ["activity_year", "lei"], [["2019", v] for v in values])
    rows = registers.read_zip(spark, path)
    assert sorted(r["lei"] for r in rows.collect()) == sorted(values)
    folder = registers.read_zip(spark, os.path.dirname(path))
    assert folder.count() == len(values)


def test_unreachable_store_is_not_absence(spark):
    with pytest.raises(Exception):
        registers.path_exists(spark, "nostore://host/x.zip")
    with pytest.raises(Exception):
        registers.read_zip(spark, "nostore://host/x.zip").count()


def test_ingest_reports_absent_columns_and_keeps_the_year_text(spark, scratch):
    path = os.path.join(scratch, "2018.txt")
    _text(path, ["activity_year", "lei", "action_taken"], [["2018", "L1", "1"], ["", "L2", "3"]])
    out = jobs.ingest(spark, [registers.RegisterFile(path, "lar")], os.path.join(scratch, "fact"))
    assert set(out["missing_columns"]) == {path} and len(out["missing_columns"][path]) == 82
    assert "state_code" in out["missing_columns"][path] and "lei" not in out["missing_columns"][path]
    assert [tuple(r) for r in out["year_summary"].collect()] == [("", 1, 0), ("2018", 1, 1)]
    assert out["year_summary"].schema["activity_year"].dataType.simpleString() == "string"
    assert [tuple(r) for r in out["rows_per_file"].collect()] == [(path, 2)]


def test_missing_and_broken_filer_lists_are_skipped_and_told(spark, scratch):
    from loanscope.sources import reference
    paths = {y: os.path.join(scratch, f"{y}.json") for y in (2020, 2021, 2022)}
    open(paths[2020], "w").write('{"institutions": [{"lei": "L1", "name": "One"}]}')
    open(paths[2022], "w").write('{"institutions": [{"lei": ')
    assert [tuple(r)[:3] for r in reference.read_filer_files(spark, paths).collect()] == [(2020, "L1", "One")]
    assert reference.skipped_years(spark, paths) == [2021, 2022]
    assert reference.read_filer_files(spark, {2021: paths[2021]}).count() == 0


def small(path, member, *rows, header=("lei", "activity_year", "action_taken")):
    _write_zip(path, member, header, rows)


@pytest.mark.parametrize("extract", [False, True])
def test_a_folder_of_zips_by_uri(spark, scratch, extract, monkeypatch):
    os.makedirs(os.path.join(scratch, "zips", "more"))
    columns = (*[c for c in MLAR_COLUMNS if c != "state_code"],)
    for name, lei in [("a.zip", "L1"), ("more/b.zip", "L2")]:
        small(os.path.join(scratch, "zips", name), "x.txt", [lei if c == "lei" else "2021" if c == "activity_year" else "1" for c in columns], header=columns)
    with zipfile.ZipFile(os.path.join(scratch, "zips", "empty.zip"), "w") as zf:
        zf.writestr("nothing.txt", "")
    uri = "file://" + os.path.join(scratch, "zips")
    f = registers.RegisterFile(uri, "lar")
    listed = registers.manifest(spark, [(uri, None)])[uri, None]
    assert [(e.path, e.member, len(e.header)) for e in listed] == [
        (f"{uri}/a.zip", "x.txt", 84), (f"{uri}/empty.zip", "nothing.txt", 0), (f"{uri}/more/b.zip", "x.txt", 84)]

    driver, really = os.getpid(), registers._zip

    def opened(path):
        assert os.getpid() != driver, "a zip was opened on the driver"
        return really(path)

    monkeypatch.setattr(registers, "_zip", opened)
    rows, missing = registers.load_registers(spark, [f], extract_dir=os.path.join(scratch, "texts") if extract else None)
    assert sorted((r["lei"], r["state_code"], r["source_file"]) for r in rows.collect()) == [("L1", "", uri), ("L2", "", uri)] and missing == []
    assert sorted(map(tuple, registers.absent_column_table(spark, [f]).collect())) == [(uri, "state_code")]


def test_zips_of_a_store_keep_their_uri(scratch, monkeypatch):
    from pyarrow import fs
    os.makedirs(os.path.join(scratch, "bucket", "year"))
    for name in ("b.zip", "year/a.ZIP", "c.txt"):
        open(os.path.join(scratch, "bucket", name), "w").close()
    store = fs.SubTreeFileSystem(scratch, fs.LocalFileSystem())
    monkeypatch.setattr(registers, "filesystem", lambda path: (store, path.split("://", 1)[1].rstrip("/")))
    assert registers._zip_paths("stub://bucket") == ["stub://bucket/b.zip", "stub://bucket/year/a.ZIP"]
    assert registers._zip_paths("stub://bucket/") == ["stub://bucket/b.zip", "stub://bucket/year/a.ZIP"]
    assert registers._zip_paths("stub://bucket/b.zip") == ["stub://bucket/b.zip"]


def test_an_empty_public_text_has_no_rows(spark, scratch):
    path = os.path.join(scratch, "2019_lar.txt")
    open(path, "w").close()
    f = registers.RegisterFile(path, "lar")
    rows, _ = registers.load_registers(spark, [f])
    assert rows.count() == 0 and rows.columns == [*MLAR_COLUMNS, "source_file"]
    assert registers.absent_columns(spark, [f]) == {path: list(MLAR_COLUMNS)}


def test_a_refresh_that_fails_leaves_the_table(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "table")
    rows = lambda n: spark.range(n).selectExpr("cast(2018 + id % 3 as string) as activity_year", "cast(id as string) as lei").repartition(4)
    with pytest.raises(FileNotFoundError):
        sinks.read_fact(spark, path)
    sinks.write_fact(rows(30), path)
    before = sinks.read_fact(spark, path)
    bad = rows(60).withColumn("lei", F.when(F.col("lei") == "59", F.raise_error(F.lit("lost"))).otherwise(F.col("lei")))
    with pytest.raises(Exception, match="lost"):
        sinks.write_fact(bad, path)
    assert before.count() == 30 == sinks.read_fact(spark, path).count()

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):  # all rows written, not yet published
        m.setattr(sinks, "versions", killed)
        sinks.write_fact(rows(90), path)
    assert sinks.read_fact(spark, path).count() == 30
    sinks.write_fact(rows(12), path)
    assert sinks.read_fact(spark, path).count() == 12 and before.count() == 30
    assert [n for n, _ in sinks.versions(spark, path)] == [1, 2]
    assert len(sinks.drop_old_versions(spark, path)) == 2  # the first and the unpublished one; Spark took back the failed one
    assert sinks.read_fact(spark, path).count() == 12
