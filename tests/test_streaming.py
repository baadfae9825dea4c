"""Streaming ingest: files landing over time reach the fact table and the cube exactly once."""

import csv
import os

from pyspark.sql import functions as F

from loanscope.operators.cubes import main_cube_direct
from loanscope.schema import MLAR_COLUMNS
from loanscope.sources import fixture
from loanscope.streaming import read_cube_deltas, start_cube_upkeep, start_fact_stream
from tests.conftest import SF_SMALL


def _drop(path, pdf):
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh, delimiter="|", lineterminator="\n")
        w.writerow(MLAR_COLUMNS)
        for r in pdf.to_dict("records"):
            w.writerow([r.get(c, "") for c in MLAR_COLUMNS])


def test_stream_appends_new_files(spark, scratch):
    rows = fixture.lar(spark, SF_SMALL).toPandas()
    watch, fact, cube = (os.path.join(scratch, d) for d in ("in", "fact", "cube"))
    os.makedirs(watch)
    ckpt = os.path.join(scratch, "ckpt")
    _drop(os.path.join(watch, "2022.txt"), rows[rows.activity_year == "2022"])
    _drop(os.path.join(watch, "2023.txt"), rows[rows.activity_year == "2023"])
    for start in (lambda: start_fact_stream(spark, watch, fact, checkpoint=ckpt + "/f"),
                  lambda: start_cube_upkeep(spark, watch, cube, checkpoint=ckpt + "/c")):
        start().awaitTermination(120)
    n1 = int(((rows.activity_year == "2022") | (rows.activity_year == "2023")).sum())
    assert spark.read.parquet(fact).count() == n1
    _drop(os.path.join(watch, "2024.txt"), rows[rows.activity_year == "2024"])
    for start in (lambda: start_fact_stream(spark, watch, fact, checkpoint=ckpt + "/f"),
                  lambda: start_cube_upkeep(spark, watch, cube, checkpoint=ckpt + "/c")):
        start().awaitTermination(120)
    years = {"2022", "2023", "2024"}
    assert spark.read.parquet(fact).count() == int(rows.activity_year.isin(years).sum())
    want = main_cube_direct(fixture.lar(spark, SF_SMALL).where(F.col("activity_year").isin(*years)))
    cols = ["y", "a", "t", "p", "c", "s", "r", "rc"]
    got = sorted(tuple(r) for r in read_cube_deltas(spark, cube).select(*cols).collect())
    assert got == sorted(tuple(r) for r in want.select(*cols).collect())
