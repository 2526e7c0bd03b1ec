"""Transitions, folds, species tables, models and metrics on the micro table."""

import pytest
from pyspark.sql import functions as F

from flyway.models.cooccurrence import cooccurrence_topk, fit_counts
from flyway.models.neighbors import neighbor_search, neighbor_topk
from flyway.models.popularity import frozen_popularity, popularity_topk
from flyway.operators.metrics import ranking_metrics
from flyway.operators.species import species_features
from flyway.operators.transitions import transitions

from micro import data, species_sets


def test_transitions_adjacent_and_consecutive(spark):
    s = species_sets(spark)
    assert transitions(s).count() == 7
    cons = transitions(s, consecutive=True)
    assert cons.count() == 6
    assert cons.where("observer_id = 5").count() == 0
    gap = transitions(s).where("observer_id = 2 AND year_from = 2019").first()
    assert gap.year_to == 2021


def test_folds_consecutive(spark):
    f = {(r.fold, r.role, r.year_from, r.year_to) for r in data(spark).folds.collect()}
    assert f == {(1, "train", 2018, 2019), (1, "test", 2019, 2020),
                 (2, "train", 2018, 2019), (2, "train", 2019, 2020), (2, "test", 2020, 2021)}


def test_folds_train_before_test(spark):
    for mode in ("consecutive", "lexicographic", "ending_before"):
        f = data(spark, mode=mode).folds
        te = f.where("role = 'test'").select("fold", F.col("year_from").alias("tf"),
                                            F.col("year_to").alias("tt"))
        tr = f.where("role = 'train'").join(te, "fold")
        assert tr.where("year_to > tt").count() == 0, mode


def test_species_features_consecutive(spark):
    t = transitions(species_sets(spark), consecutive=True)
    got = {r.species: (r.total_viewers, r.popularity, round(r.popularity_score, 6))
           for r in species_features(t).collect()}
    assert got == {"A": (9, "common", 1.8), "B": (7, "common", 1.4), "C": (7, "common", 1.4),
                   "D": (4, "rare", 0.8), "E": (2, "rare", 0.4), "F": (1, "rare", 0.2)}


def test_species_features_adjacent(spark):
    t = transitions(species_sets(spark))
    got = {r.species: (r.total_viewers, round(r.popularity_score, 6)) for r in species_features(t).collect()}
    assert got["A"] == (11, 1.941176) and got["D"][0] == 5


def test_popularity_baseline_fold1(spark):
    d = data(spark)
    pop = {r.species: r.n_viewers for r in frozen_popularity(d.fold_trans, d.catalogue).collect()}
    assert pop == {"A": 2, "B": 1, "C": 1, "D": 1, "E": 0, "F": 0}
    p = popularity_topk(d.fold_trans, d.catalogue, k=2).where("fold = 1")
    got = {(r.observer_id, r.species) for r in p.collect()}
    assert got == {(1, "D"), (1, "E"), (3, "A"), (3, "C")}
    m = {r.metric: r.value for r in ranking_metrics(p, d.fold_trans.where("role = 'test'"), 2,
                                                  d.n_species).where("fold = 1").collect()}
    assert m["precision@k"] == pytest.approx(0.25)
    assert m["recall@k"] == pytest.approx(1 / 6)
    assert m["map@k"] == pytest.approx(0.5)
    assert m["coverage"] == pytest.approx(4 / 6)
    m0 = {r.metric: r.value for r in ranking_metrics(p, d.fold_trans.where("role = 'test'"), 2,
                                                   d.n_species, include_zero=True)
          .where("fold = 1").collect()}
    assert m0["map@k"] == pytest.approx(0.25)


def test_metric_bounds(spark):
    d = data(spark)
    p = popularity_topk(d.fold_trans, d.catalogue, k=3)
    for r in ranking_metrics(p, d.fold_trans.where("role = 'test'"), 3, d.n_species).collect():
        assert 0.0 <= r.value <= 1.0


def test_cooccurrence_counts_symmetric(spark):
    d = data(spark)
    _, n_ij = fit_counts(d.transitions, d.folds)
    got = {(r.species_i, r.species_j): r.n_ij for r in n_ij.where("fold = 1").collect()}
    assert got[("A", "B")] == 1 and got[("A", "C")] == 2 and got[("A", "D")] == 1
    assert got[("B", "C")] == 1 and got[("C", "D")] == 1 and ("B", "D") not in got
    assert all(got[(j, i)] == n for (i, j), n in got.items())


def test_cooccurrence_scores(spark):
    d = data(spark)
    p = cooccurrence_topk(d.fold_trans, d.transitions, d.folds, d.catalogue, d.n_species, k=6,
                          alpha=0.1, n_folds=4).where("fold = 1")
    o1 = {r.species: round(r.score, 6) for r in p.where("observer_id = 1").collect()}
    assert o1 == {"D": 0.261439, "E": 0.049237, "F": 0.049237}
    o3 = {r.species: round(r.score, 6) for r in p.where("observer_id = 3").collect()}
    assert o3 == {"A": 0.6875, "C": 0.6875, "D": 0.0625, "E": 0.0625, "F": 0.0625}
    # no recommended species was already viewed
    ft = d.fold_trans.where("role = 'test'")
    bad = p.join(ft, ["fold", "observer_id"]).where(F.array_contains("species_from", F.col("species")))
    assert bad.count() == 0


def test_neighbor_similarities(spark):
    d = data(spark)
    test = d.fold_trans.where("role = 'test'").select("fold", "observer_id", "species_from")
    train = d.fold_trans.where("role = 'train'").select(
        "fold", "observer_id", "year_from", F.array_union("species_from", "species_to").alias("species"))
    cos = neighbor_search(test, train, "cosine").where("fold = 1 AND observer_id = 3").collect()
    assert [(r.nb_observer_id, round(r.sim, 6)) for r in cos] == [(1, 0.57735)]
    jac = neighbor_search(test, train, "jaccard").where("fold = 1 AND observer_id = 3").collect()
    assert [(r.nb_observer_id, round(r.sim, 6)) for r in jac] == [(1, 0.333333)]
    # small blocks give the same exact answer
    small = neighbor_search(test, train, "cosine", test_block_rows=1, train_block_rows=1)
    assert small.count() == neighbor_search(test, train, "cosine").count()


def test_cosine_at_least_jaccard(spark):
    d = data(spark)
    test = d.fold_trans.where("role = 'test'").select("fold", "observer_id", "species_from")
    train = d.fold_trans.where("role = 'train'").select(
        "fold", "observer_id", "year_from", F.array_union("species_from", "species_to").alias("species"))
    c = neighbor_search(test, train, "cosine").select("fold", "observer_id", "nb_observer_id",
                                                          "nb_year_from", F.col("sim").alias("c"))
    j = neighbor_search(test, train, "jaccard").select("fold", "observer_id", "nb_observer_id",
                                                           "nb_year_from", F.col("sim").alias("j"))
    assert c.join(j, ["fold", "observer_id", "nb_observer_id", "nb_year_from"]).where("c < j - 1e-12").count() == 0


def test_neighbor_topk_excludes_viewed(spark):
    d = data(spark)
    p = neighbor_topk(d.fold_trans, k=3)
    ft = d.fold_trans.where("role = 'test'")
    assert p.join(ft, ["fold", "observer_id"]).where(F.array_contains("species_from", F.col("species"))).count() == 0
    assert p.where("score <= 0").count() == 0


def test_gram_flush_gives_same_counts(spark):
    d = data(spark)
    _, full = fit_counts(d.transitions, d.folds)
    want = {(r.fold, r.species_i, r.species_j, r.n_ij) for r in full.collect()}
    _, small = fit_counts(d.transitions, d.folds, max_vocab=2, rows_per_chunk=1)
    assert {(r.fold, r.species_i, r.species_j, r.n_ij) for r in small.collect()} == want


def test_neighbor_paths_agree(spark):
    d = data(spark)
    one = {(r.fold, r.observer_id, r.species, round(r.score, 9), r.rank)
           for r in neighbor_topk(d.fold_trans, k=4).collect()}          # single block: votes in kernel
    many = {(r.fold, r.observer_id, r.species, round(r.score, 9), r.rank)
            for r in neighbor_topk(d.fold_trans, k=4, test_block_rows=1, train_block_rows=1).collect()}
    assert one == many and len(one) > 0
