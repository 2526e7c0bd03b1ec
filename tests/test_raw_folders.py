"""The raw table as folders: a few small files first, in checklist order, the rest in files of any size."""

import datetime
import glob
import os
import random

import pyarrow.parquet as pq

from flyway.plans import q_sources
from flyway.schema import RAW_COLUMNS, RAW_SCHEMA
from flyway.sources import scan as SC


def raw_rows(per_year):
    r, out = random.Random(6), []
    for year, n in per_year.items():
        for i in range(n):
            row = dict.fromkeys(RAW_COLUMNS)
            row |= {"observer_id": i % 7, "scientific_name": f"s{i % 11}", "year": year, "species_observed": i % 3 > 0,
                    "checklist_id": i, "observation_date": datetime.date(year, 1, 1), "hours_of_day": 1.0}
            out.append(tuple(row[f.name] for f in RAW_SCHEMA))
    r.shuffle(out)
    return out


def test_first_files_are_small_and_all_rows_are_filed(spark, monkeypatch):
    rows = raw_rows({2001: 450, 2002: 130})
    df = spark.createDataFrame(rows, RAW_SCHEMA).repartition(5)
    monkeypatch.setattr(q_sources.FX, "raw_observations", lambda *_: df)
    path = q_sources._raw_folders(spark, "", "few", 200, first=(2, 100))
    for year, sizes in ((2001, [100, 100, 200, 50]), (2002, [100, 30])):
        files = sorted(glob.glob(os.path.join(path, f"year={year}", "*.parquet")))
        ids = [pq.ParquetFile(f).read(["checklist_id"]).column(0).to_pylist() for f in files]
        assert [len(x) for x in ids] == sizes
        assert [i for x in ids for i in x] == list(range(sum(sizes)))
    sample = SC.scan_sample(spark, path, 2)
    got = {(r.year, r.checklist_id) for r in sample.select("year", "checklist_id").collect()}
    assert got == {(y, i) for y, n in ((2001, 200), (2002, 130)) for i in range(n) if i % 3 > 0}
