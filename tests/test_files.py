"""Damaged, old and foreign files are each reported; loads read the folders of their years only."""

import datetime
import glob
import logging
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from flyway.models.lsh import lsh_neighbors, recall
from flyway.models.neighbors import neighbor_search
from flyway.schema import RAW_COLUMNS, RAW_SCHEMA
from flyway.sources import scan as SC
from flyway.sources.validate import file_report

NEEDED = [c for c in RAW_COLUMNS if c != "year"]


def rows(spark, years, n=4000):
    made = spark.range(n).crossJoin(spark.createDataFrame([(y,) for y in years], "year int"))
    value = {"observer_id": F.col("id") % 50, "scientific_name": F.concat(F.lit("s"), F.xxhash64("id")),
             "species_observed": F.lit(True), "checklist_id": F.col("id"), "observation_date": F.lit(datetime.date(2000, 1, 2)),
             "state": F.lit("A"), "county": F.lit("c"), "year": F.col("year")}
    return made.select(*[value.get(f.name, F.rand(1) * 50).cast(f.dataType).alias(f.name) for f in RAW_SCHEMA])


def only_file(folder):
    return glob.glob(os.path.join(folder, "*.parquet"))[0]


@pytest.fixture()
def table(spark, tmp_path):
    base = str(tmp_path / "raw")
    rows(spark, [2000, 2001, 2002, 2003]).coalesce(1).write.partitionBy("year").parquet(base)
    return base


def damage(table):
    """One file cut short, one with broken pages, one without a column, one that is text; folders 2000 to 2003."""
    bad = {}
    cut = only_file(f"{table}/year=2000")
    data = open(cut, "rb").read()
    bad["cut"] = f"{table}/year=2000/cut.parquet"
    open(bad["cut"], "wb").write(data[:len(data) // 2])
    bad["pages"] = f"{table}/year=2001/pages.parquet"
    t = pq.read_table(only_file(f"{table}/year=2001"), partitioning=None)
    pq.write_table(t, bad["pages"], row_group_size=1000)
    meta = pq.read_metadata(bad["pages"])
    at = meta.row_group(2).column(1).data_page_offset
    with open(bad["pages"], "r+b") as f:
        f.seek(at)
        f.write(b"\xff" * 400)
    bad["old"] = f"{table}/year=2002/old.parquet"
    pq.write_table(pq.read_table(only_file(f"{table}/year=2002"), partitioning=None).drop(["species_observed"]), bad["old"])
    bad["text"] = f"{table}/year=2003/notes.parquet"
    open(bad["text"], "w").write("not a table")
    return bad


def test_report_names_every_kind(spark, table):
    bad = damage(table)
    report = file_report(spark, table, SC.list_files(spark, table), RAW_SCHEMA, NEEDED)
    got = {os.path.basename(r.path): r for r in report.collect() if r.status != "ok"}
    assert {k: r.status for k, r in got.items()} == {"cut.parquet": "unreadable", "pages.parquet": "short", "old.parquet": "columns",
                                                     "notes.parquet": "unreadable"}
    assert got["old.parquet"].missing == ["species_observed"]
    assert 0 <= got["pages.parquet"].n_read < got["pages.parquet"].n_rows == 4000
    assert report.where("status = 'ok' and n_read = n_rows").count() == 4 and len(bad) == 4


def test_tolerant_read_warns_of_each(spark, table, caplog):
    bad = damage(table)
    with caplog.at_level(logging.WARNING):
        raw = SC.read_raw(spark, table, tolerant=True)
        n = {r.year: r["count"] for r in raw.groupBy("year").count().collect()}
    for path in bad.values():
        assert any(os.path.basename(path) in m for m in caplog.messages), path
    assert n[2000] == n[2002] == n[2003] == 4000 and n[2001] >= 4000           # no row of the old file
    assert raw.where("species_observed is null").count() == 0 and sorted(raw.columns) == sorted(RAW_COLUMNS)


def test_strict_read_asks_every_file(spark, table):
    assert SC.read_raw(spark, table).count() == 16000
    old = f"{table}/year=2002/zz-old.parquet"                                   # not the first file of its folder
    pq.write_table(pq.read_table(only_file(f"{table}/year=2002"), partitioning=None).drop(["county"]), old)
    with pytest.raises(ValueError, match="zz-old.*county"):
        SC.read_raw(spark, table)


def metric(df, name):
    df.collect()
    todo, found = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        p = todo.pop()
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(p.plan())
        elif kind == "FileSourceScanExec" and p.metrics().contains(name):
            found.append(p.metrics().apply(name).value())
        for i in range(p.children().size()):
            todo.append(p.children().apply(i))
    return found


def test_fold_reads_its_years_only(spark, table):
    folds = spark.createDataFrame([(1, "train", 2000, 2001), (1, "test", 2001, 2002), (2, "test", 2002, 2003)],
                                  "fold int, role string, year_from int, year_to int")
    raw = SC.read_raw(spark, table)
    loaded = SC.fold_years(raw, folds, 2)
    assert sorted(r.year for r in loaded.select("year").distinct().collect()) == [2002, 2003]
    counted = loaded.groupBy("year").agg(F.count("county"))
    assert metric(counted, "numPartitions") == [2]
    assert "dynamicpruning" in counted._jdf.queryExecution().executedPlan().toString().lower()


def test_sample_paths(spark, table):
    for y in (2000, 2001):
        pq.write_table(pq.read_table(only_file(f"{table}/year={y}"), partitioning=None), f"{table}/year={y}/aa.parquet")
    got = SC.sample_paths(spark, table, 1)
    assert [os.path.basename(p) == "aa.parquet" for p in got] == [True, True, False, False]


def test_lsh_recall(spark):
    import random
    r = random.Random(7)
    base = [{f"s{r.randrange(300)}" for _ in range(r.randint(5, 40))} for _ in range(40)]
    near = lambda s: sorted({x for x in s if r.random() < 0.85} | {f"s{r.randrange(300)}" for _ in range(3)})
    test = spark.createDataFrame([(1 + i % 2, i, near(s)) for i, s in enumerate(base)] + [(1, 99, [])],
                                 "fold int, observer_id long, species_from array<string>")
    train = spark.createDataFrame([(1 + i % 2, 1000 + 10 * i + k, 2000, near(s)) for i, s in enumerate(base) for k in range(6)],
                                  "fold int, observer_id long, year_from int, species array<string>")
    exact = neighbor_search(test, train, "jaccard", 5)
    found = lsh_neighbors(test, train, 5, bands=32)
    got = recall(found, exact).collect()
    assert {x.fold for x in got} == {1, 2} and all(x.recall >= 0.9 for x in got)
    sims = {(x.observer_id, x.nb_observer_id): x.sim for x in exact.collect()}
    both = [(x.sim, sims[x.observer_id, x.nb_observer_id]) for x in found.collect() if (x.observer_id, x.nb_observer_id) in sims]
    assert both and all(a == pytest.approx(b) for a, b in both)
