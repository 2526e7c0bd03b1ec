"""One-hot places per fold, and several K from one prediction table."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flyway.models.popularity import popularity_topk
from flyway.operators import onehot as OH
from flyway.operators.metrics import ranking_metrics, ranking_metrics_at

from micro import data


@pytest.fixture()
def tables(spark):
    folds = spark.createDataFrame([(1, "train", 2000, 2001), (1, "test", 2001, 2002), (2, "train", 2000, 2001),
                                   (2, "train", 2001, 2002), (2, "test", 2002, 2003)],
                                  "fold int, role string, year_from int, year_to int")
    obs = spark.createDataFrame([(2000, "Maine", "York"), (2001, "Ohio", "Adams"), (2002, "Texas", None), (2003, None, "Zapata"),
                                 (2000, "Maine", "York"), (1999, "Utah", "Juab")], "year int, state string, county string")
    rows = spark.createDataFrame([(1, 10, "Ohio", "York"), (1, 11, "Texas", "Zapata"), (1, 12, None, "nowhere"),
                                  (2, 10, "Maine", "Zapata"), (2, 13, "Utah", None)],
                                 "fold int, observer_id long, top_state string, top_county string")
    return folds, obs, rows


def test_hot_places_by_fold(spark, tables):
    folds, obs, rows = tables
    d = OH.fold_dictionaries(obs, folds)
    labels = {(r.fold, r["column"]): r.labels for r in d.collect()}
    assert labels == {(1, "state"): ["Maine", "Ohio", "Texas"], (1, "county"): ["Adams", "York"],
                      (2, "state"): ["Maine", "Ohio", "Texas"], (2, "county"): ["Adams", "York", "Zapata"]}
    v = OH.onehot_vectors(rows, d)
    got = {(r.fold, r.observer_id): (r.s, r.c) for r in v.select(
        "fold", "observer_id", vector_to_array("state_onehot").alias("s"), vector_to_array("county_onehot").alias("c")).collect()}
    assert got == {(1, 10): ([0, 1, 0], [0, 1]), (1, 11): ([0, 0, 1], [0, 0]), (1, 12): ([0, 0, 0], [0, 0]),
                   (2, 10): ([1, 0, 0], [0, 0, 1]), (2, 13): ([0, 0, 0], [0, 0, 0])}
    assert all(r.state_onehot.indices.size <= 1 for r in v.collect())                 # sparse
    hot = {(r.fold, r.observer_id, r.feature) for r in OH.hot_features(v, d, ["fold", "observer_id"]).collect()}
    assert hot == {(1, 10, "state_Ohio"), (1, 10, "county_York"), (1, 11, "state_Texas"), (2, 10, "state_Maine"),
                   (2, 10, "county_Zapata")}


def test_training_dictionary_leaves_unseen_cold(spark, tables):
    folds, obs, rows = tables
    d = OH.fold_dictionaries(obs, folds, roles=("train",))
    hot = {(r.fold, r.observer_id, r.feature) for r in OH.hot_features(
        OH.onehot_vectors(rows, d), d, ["fold", "observer_id"], ("state",)).collect()}
    assert hot == {(1, 10, "state_Ohio"), (2, 10, "state_Maine")}                     # Texas is seen in the test year only


@pytest.mark.parametrize("include_zero", [False, True])
def test_many_k_equal_one_by_one(spark, include_zero):
    d = data(spark)
    truth = d.fold_trans.where(F.col("role") == "test")
    preds = popularity_topk(d.fold_trans, d.catalogue, k=5)
    ks = [1, 2, 3, 5]
    got = {(r.fold, r.k, r.metric): r.value for r in ranking_metrics_at(preds, truth, ks, d.n_species, include_zero).collect()}
    want = {(r.fold, r.k, r.metric): r.value for k in ks for r in ranking_metrics(
        preds.where(F.col("rank") <= k), truth, k, d.n_species, include_zero).collect()}
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x]) for x in want)
