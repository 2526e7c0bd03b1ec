"""The scenario grid gives what separate runs give, for every region, with and without features."""

import pytest
from pyspark.sql import functions as F

from flyway.models.cooccurrence import cooccurrence_topk
from flyway.models.learned import learned_topk
from flyway.models.neighbors import neighbor_topk
from flyway.operators.folds import FOLDS_APART, cv_folds
from flyway.operators.region import region_transitions
from flyway.operators.species import fold_species_features
from flyway.operators.transitions import transitions
from flyway.plans.pipeline import folded
from flyway.plans.scenarios import scenario_data, scenario_lift, scenario_metrics, scenario_predictions

STATES = {"everywhere": None, "coast": ["Maine", "Vermont"], "inland": ["Ohio"], "nowhere": ["Utah"]}


@pytest.fixture(scope="module")
def summary(spark):
    """48 observers, 5 years, in one or two states each; a state set that is empty, one that is null."""
    rows = []
    for o in range(48):
        for y in range(2000, 2005):
            if (o + y) % 11 == 0:
                continue
            states = [["Maine"], ["Ohio"], [" Vermont", "Ohio"], ["Iowa"]][(o + y // 2) % 4]
            states = [] if o == 5 else None if o == 6 else states
            species = sorted({f"s{(o + y) % 7}", f"s{(o * 3) % 5}", f"c{y % 2}", f"t{o % 4}"})
            n = float(o % 9 + 1)
            rows.append((o, y, species, states, [o % 3 + 1], [n], [n], [n], [1], n * 10))
    return spark.createDataFrame(rows, """observer_id bigint, year int, scientific_name array<string>, state array<string>,
        locality_id array<bigint>, effort_hours array<double>, effort_distance_km array<double>,
        duration_minutes array<double>, number_observers array<int>, total_observations double""").withColumn(
        "county", F.col("state")).cache()


@pytest.fixture(scope="module")
def grid(summary):
    return scenario_data(summary, STATES)


def apart(spark, summary, name):
    t = transitions(summary) if STATES[name] is None else region_transitions(summary, STATES[name])
    return folded(spark, "", trans=t)


def rows(preds):
    return sorted((r.fold, r.observer_id, r.rank, r.species, round(r.score, 9)) for r in preds.collect())


def scenario(preds, number):
    f = F.col("fold")
    return preds.where(F.floor(f / FOLDS_APART) == number).withColumn("fold", f % FOLDS_APART)


@pytest.mark.parametrize("model", ["collaborative", "user_collaborative", "neural"])
def test_grid_equals_separate_runs(spark, summary, grid, model):
    both = scenario_predictions(grid, model, 3, summary).cache()
    for place, name in enumerate(["everywhere", "coast", "inland"]):
        d = apart(spark, summary, name)
        for flag in (0, 1):
            species = fold_species_features(d.fold_trans) if flag else None
            if model == "collaborative":
                want = cooccurrence_topk(d.fold_trans, d.transitions, d.folds, d.catalogue, d.n_species, k=3,
                                         features=species)
            elif model == "user_collaborative":
                want = neighbor_topk(d.fold_trans, k=3, features=species)
            elif name == "everywhere":          # fits of every fold: one region suffices
                want = learned_topk(d, k=3, summary=summary if flag else None)
            else:
                continue
            got, want = rows(scenario(both, 2 * place + flag)), rows(want)
            assert want
            if model == "neural":               # iterative fits agree to their tolerance
                assert [r[:3] for r in got] == [r[:3] for r in want]
                assert sum(a[3] == b[3] for a, b in zip(got, want)) >= 0.98 * len(want)
            else:
                assert got == want


def test_folds_and_catalogues_are_of_the_region(spark, summary, grid):
    numbers = {r[0] // FOLDS_APART for r in grid.folds.select("fold").distinct().collect()}
    assert numbers == {0, 1, 2, 3, 4, 5}                        # nowhere: no folds, no rows
    d = apart(spark, summary, "coast")
    mine = grid.catalogue.where("fold = 201").select("species").collect()
    assert sorted(mine) == sorted(d.catalogue.collect())
    sizes = {r.fold: r.n_species for r in grid.n_species.collect()}
    assert sizes[201] == sizes[301] == d.n_species.first()[0]


def test_folds_per_region_in_every_mode(spark, summary):
    whole = transitions(summary).withColumn("region", F.lit(0))
    both = whole.unionByName(region_transitions(summary, STATES["coast"]).withColumn("region", F.lit(1)))
    for mode in ("consecutive", "lexicographic", "ending_before"):
        got = cv_folds(both, mode=mode, by=("region",))
        for region in (0, 1):
            want = cv_folds(both.where(F.col("region") == region), mode=mode)
            assert sorted(got.where(F.col("region") == region).drop("region").collect()) == sorted(want.collect())


def test_lift(spark, grid, summary):
    m = scenario_metrics(grid, scenario_predictions(grid, "collaborative", 3), "collaborative", 3).cache()
    assert {(r.region, r.features) for r in m.select("region", "features").distinct().collect()} == {
        (n, f) for n in ("everywhere", "coast", "inland") for f in (True, False)}
    for r in scenario_lift(m).collect():
        mean = {f: m.where((F.col("region") == r.region) & (F.col("metric") == r.metric) & (F.col("features") == f))
                .agg(F.avg("value")).first()[0] for f in (True, False)}
        assert r["with"] == pytest.approx(mean[True]) and r["without"] == pytest.approx(mean[False])
        assert r.lift_pct == pytest.approx((mean[True] - mean[False]) / mean[False] * 100)


def test_a_model_without_features_is_refused(grid):
    with pytest.raises(ValueError):
        scenario_predictions(grid, "baseline", 3)


def test_dictionary_of_some_years(spark):
    """Values of other years get no place; places are in value order."""
    from flyway.operators.features import geo_dictionary
    obs = spark.createDataFrame([(2000, "b"), (2000, "d"), (2001, "a"), (2001, "d"), (2002, "c"), (2001, None)],
                                "year int, state string")
    got = geo_dictionary(obs, "state", years=spark.createDataFrame([(2001,), (2002,)], "year int")).collect()
    assert sorted((r.state_idx, r.state) for r in got) == [(0, "a"), (1, "c"), (2, "d")]
