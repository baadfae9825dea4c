"""The production path: register files + reference files -> warehouse -> cubes and views,
equal to the same pipeline over the in-memory fixture."""

import csv
import io
import json
import os
import zipfile

from loanscope.operators.filters import Filters
from loanscope.plans import views as V
from loanscope.plans.warehouse import Sources, Warehouse, fixture_warehouse
from loanscope.schema import LAR_TO_MLAR_RENAMES, MLAR_COLUMNS
from loanscope.sources import fixture, reference, registers
from tests.conftest import SF_SMALL

MLAR_TO_LAR = {v: k for k, v in LAR_TO_MLAR_RENAMES.items()}


def _rows(df, order=None):
    cols = order or sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))


def test_files_to_views(spark, scratch):
    lar = fixture.lar(spark, SF_SMALL).toPandas()
    files = []
    for year in sorted(lar.activity_year.unique()):
        part = lar[lar.activity_year == year]
        buf = io.StringIO()
        w = csv.writer(buf, delimiter="|", lineterminator="\n")
        if year < "2022":
            cols = list(part.columns)
            w.writerow([MLAR_TO_LAR.get(c, c) for c in cols])
            w.writerows(part[cols].values.tolist())
            path = os.path.join(scratch, f"{year}_lar.zip")
            with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
                zf.writestr(f"{year}_lar.txt", buf.getvalue())
            files.append(registers.RegisterFile(path, "lar", f"{year}_lar.txt"))
        else:
            w.writerow(MLAR_COLUMNS)
            w.writerows([[r.get(c, "") for c in MLAR_COLUMNS] for r in part.to_dict("records")])
            path = os.path.join(scratch, f"{year}_combined_mlar_header.txt")
            open(path, "w").write(buf.getvalue())
            files.append(registers.RegisterFile(path, "mlar"))

    county = fixture.county(spark, SF_SMALL).toPandas()
    cpath = os.path.join(scratch, "county_fips.txt")
    county[["STATE", "STATEFP", "COUNTYFP", "COUNTYNAME"]].to_csv(cpath, sep="|", index=False)
    filers = fixture.filers(spark, SF_SMALL).toPandas()
    fpaths = {}
    for year, g in filers.groupby("year"):
        fpaths[int(year)] = os.path.join(scratch, f"filers_{year}.json")
        json.dump({"institutions": g[["lei", "name"]].to_dict("records")}, open(fpaths[int(year)], "w"))

    wh = Warehouse(spark, os.path.join(scratch, "wh"), Sources(
        fact=lambda: registers.load_registers(spark, files)[0].drop("source_file"),
        county=lambda: reference.read_county_file(spark, cpath),
        filers=lambda: reference.read_filer_files(spark, fpaths)))
    ref = fixture_warehouse(spark, SF_SMALL)
    for name in ("main", "quality", "state", "county", "lender_states", "inv_county"):
        assert _rows(wh.table(name)) == _rows(ref.table(name)), name
    f = Filters(year="2020")
    assert (_rows(V.lender_table(wh.table("lender_base"), wh.table("lender_dim"), f))
            == _rows(V.lender_table(ref.table("lender_base"), ref.table("lender_dim"), f)))
    assert (_rows(V.county_table(wh.table("county"), wh.table("county_names"), f))
            == _rows(V.county_table(ref.table("county"), ref.table("county_names"), f)))
