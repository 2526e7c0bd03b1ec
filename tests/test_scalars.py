"""Scalar checks of FIXTURES §3.2."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flyway.functions import activity_band, predicted_k
from flyway.operators.features import geo_features, geo_from_summary, robust_scale, temporal_features
from flyway.operators.metrics import count_metrics
from flyway.operators.region import in_region


def _raw(spark, rows):
    schema = T.StructType([T.StructField("observer_id", T.LongType()), T.StructField("year", T.IntegerType()),
                           T.StructField("state", T.StringType()), T.StructField("county", T.StringType()),
                           T.StructField("locality_id", T.LongType()), T.StructField("latitude", T.DoubleType()),
                           T.StructField("longitude", T.DoubleType()), T.StructField("effort_hours", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def test_state_diversity(spark):
    df = _raw(spark, [(1, 2020, s, "c", 1, 0.0, 0.0, 1.0) for s in "XXY"])
    r = geo_features(df).first()
    assert r.state_diversity == pytest.approx(0.636514, abs=1e-6)
    assert r.top_state == "X" and r.num_states == 2


def test_summary_diversity(spark):
    df = spark.createDataFrame([(1, 2020, ["P", "Q"], ["c"], [1])],
                               "observer_id long, year int, state array<string>, county array<string>, "
                               "locality_id array<long>")
    r = geo_from_summary(df).first()
    assert r.state_diversity == pytest.approx(0.693147, abs=1e-6)
    assert r.state_diversity_literal == pytest.approx(0.346574, abs=1e-6)


def test_std_variants(spark):
    from flyway.functions import set_std_pop
    df = spark.createDataFrame([([1.0, 2.0, 4.0],), ([7.0],)], "v array<double>")
    got = [round(r[0], 6) for r in df.select(set_std_pop(F.col("v"))).collect()]
    assert got == [1.247219, 0.0]
    raw = _raw(spark, [(1, 2020, "X", "c", 1, 0.0, 0.0, e) for e in (1.0, 2.0, 4.0)] +
               [(2, 2020, "X", "c", 1, 0.0, 0.0, 7.0)])
    raw = (raw.withColumn("scientific_name", F.lit("s")).withColumn("observation_count", F.lit(None).cast("double"))
              .withColumn("day_of_year", F.lit(1)).withColumn("hours_of_day", F.lit(1.0))
              .withColumn("duration_minutes", F.lit(1.0)).withColumn("observation_date", F.lit(None).cast("date")))
    tf = {r.observer_id: r for r in temporal_features(raw).collect()}
    assert tf[1].effort_std == pytest.approx(1.527525, abs=1e-6)
    assert tf[2].effort_std == 0.0
    assert tf[1].total_observations == 0.0        # all-null counts sum to 0
    assert tf[1].month_1_freq == 0.0              # no parseable date


def test_robust_scale(spark):
    rows = [(1, "train", "f", float(v)) for v in (1, 2, 3, 4, 100)] + \
           [(1, "train", "g", float(v)) for v in (5, 5, 9, 5, 5)]
    df = spark.createDataFrame(rows, "fold int, role string, feature string, value double")
    got = {}
    for r in robust_scale(df, ["fold"]).collect():
        got.setdefault(r.feature, []).append(r.scaled)
    assert sorted(got["f"]) == [-1.0, -0.5, 0.0, 0.5, 48.5]
    assert sorted(got["g"]) == [0.0, 0.0, 0.0, 0.0, 4.0]


@pytest.mark.parametrize("pred,expect", [
    ((3, 3, 3), (1.666667, 1.914854, 0.0, 41.666667)),
    ((1, 4, 8), (1.0, 1.290994, 0.996616, 27.777778)),
])
def test_count_metrics(spark, pred, expect):
    rows = [(1, float(a), float(p)) for a, p in zip((2, 4, 6), pred)]
    df = spark.createDataFrame(rows, "fold int, actual double, predicted double")
    m = {r.metric: r.value for r in count_metrics(df).collect()}
    got = (m["count_mae"], m["count_rmse"], m["count_correlation"], m["count_mape"])
    assert [round(x, 6) for x in got] == list(expect)


def test_activity_band(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 5, 6, 10, 20, 50, 51)], "n int")
    got = [r[0] for r in df.select(activity_band(F.col("n"))).collect()]
    assert got == [None, "1-5", "1-5", "6-10", "6-10", "11-20", "21-50", "50+"]


def test_region_filter(spark):
    df = spark.createDataFrame([([" Maine "],), (["Ohio"],), ([],), (None,), ([None, "Vermont"],)],
                               "state array<string>")
    assert [r[0] for r in df.select(in_region(F.col("state"))).collect()] == [True, False, False, False, True]


def test_predicted_k(spark):
    df = spark.createDataFrame([(x,) for x in (-3.0, 0.4, 2.5, 3.5, 99.0)], "c double")
    assert [r[0] for r in df.select(predicted_k(F.col("c"), 6)).collect()] == [1, 1, 2, 4, 6]


def test_entropy_bound(spark):
    df = _raw(spark, [(1, 2020, s, "c", 1, 0.0, 0.0, 1.0) for s in "XYZZW"])
    r = geo_features(df).first()
    assert r.state_diversity <= math.log(r.num_states) + 1e-9
