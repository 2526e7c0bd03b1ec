"""A catalogue of one block is ranked where it is scored; fits read the folds they learn from."""

import pytest
from pyspark.sql import functions as F

from flyway.models import cooccurrence as C
from flyway.plans.pipeline import folded
from flyway.session import cut_lineage

SF = "/root/testdata/sf0.001"


def top(d):
    return C.cooccurrence_topk(d.fold_trans, d.transitions, d.folds, d.catalogue, d.n_species, k=7)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_block_needs_no_window(spark, monkeypatch):
    d = folded(spark, SF)
    one = top(d)
    assert "Window" not in plan(one)
    size = d.catalogue.count()
    monkeypatch.setattr(C, "_MODEL_CELLS", size * -(-size // 3))
    several = top(d)
    assert "Window" in plan(several)

    def rows(df):
        return {(r.fold, r.observer_id, r.rank): (r.species, pytest.approx(r.score, rel=1e-9)) for r in df.collect()}
    got = rows(one)
    assert got and got == rows(several) and len(got) == one.count()


def test_written_by_a_column(spark):
    df = spark.range(9).select((F.col("id") % 3).cast("int").alias("fold"), F.col("id").cast("double").alias("x"))
    back = cut_lineage(df, "by", by="fold")
    assert back.dtypes == df.dtypes and sorted(back.collect()) == sorted(df.collect())
    assert "PartitionFilters: []" in plan(back) and "PartitionFilters: []" not in plan(back.where("fold = 1"))
    assert cut_lineage(df.where("x < 0"), "by", by="fold").collect() == []
