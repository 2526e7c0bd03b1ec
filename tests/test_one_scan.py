"""Feature plans read the raw table once; quantiles are exact wherever their ranks lie."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flyway.operators import features as FE
from flyway.operators.quantiles import exact_quantiles
from flyway.plans import q_features as Q
from flyway.plans.pipeline import observed

SF = "/root/testdata/sf0.001"


def raw_scans(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return sum("FileScan parquet" in line and "l_suppkey" in line for line in final.splitlines())


@pytest.mark.parametrize("build", [FE.temporal_features, FE.geo_features, FE.observer_year_features])
def test_one_raw_scan(spark, build):
    assert raw_scans(build(observed(spark, SF))) == 1


def test_assembly_scans_once(spark):
    assert raw_scans(Q._assembly(spark, SF)[1]) == 1


def test_scaling_reads_the_assembly_back(spark):
    assert raw_scans(Q.q_robust_scale(spark, SF)) == 0


def test_moments_are_merged(spark):
    r = random.Random(4)
    rows = [(o, 2020, r.choice(["A", "B", None]), r.choice(["x", "y"]), r.randrange(6), r.uniform(40, 41), r.choice([None, -70.5]))
            for o in (1, 2) for _ in range(400)] + [(3, 2020, None, None, None, None, None), (None, 2020, "A", "x", 1, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "observer_id long, year int, state string, county string, locality_id long, "
                                     "latitude double, longitude double")
    got = {g.observer_id: g for g in FE.geo_features(df).collect()}
    assert set(got) == {1, 2, 3}
    for o in (1, 2):
        own = [x for x in rows if x[0] == o]
        lat = np.std([x[5] for x in own], ddof=1)
        states = [x[2] for x in own if x[2]]
        p = np.array([states.count(s) / len(states) for s in "AB"])
        assert got[o].geographic_spread == pytest.approx(lat, rel=1e-12)
        assert got[o].state_diversity == pytest.approx(-(p * np.log(p + 1e-10)).sum(), rel=1e-12)
        assert (got[o].num_states, got[o].num_counties, got[o].num_localities) == (2, 2, 6)
        assert got[o].top_state == max("AB", key=lambda s: (states.count(s), s == "A"))
    assert (got[3].num_states, got[3].num_localities, got[3].top_state, got[3].geographic_spread) == (0, 0, None, 0.0)


def test_exact_quantiles(spark):
    r = random.Random(9)
    groups = {("a", 1): [r.choice([0.0, 1.0, 2.5]) for _ in range(3000)], ("a", 2): [r.gauss(0, 1) for _ in range(999)],
              ("b", 1): [7.0], ("b", 2): [3.0, 1.0], ("c", 1): [-0.0, 0.0, 5.0]}
    rows = [(g, f, v) for (g, f), vs in groups.items() for v in vs + [None]] + [("d", 1, None)]
    df = spark.createDataFrame(rows, "g string, f int, value double").repartition(7)
    q = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(x.g, x.f): x.quantiles for x in exact_quantiles(df, ["g", "f"], "value", q).collect()}
    assert set(got) == set(groups)
    for k, v in groups.items():
        assert got[k] == pytest.approx(np.quantile(v, q), rel=1e-12, abs=1e-12)
    spread = exact_quantiles(df.withColumn("f", F.lit(1)), ["f"], "value", [0.5]).first()
    assert spread.quantiles[0] == pytest.approx(np.median([v for vs in groups.values() for v in vs]))
