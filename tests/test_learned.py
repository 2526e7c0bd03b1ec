"""Planted signals: the fitted models must find what popularity and the mean cannot."""

import pytest
from pyspark.sql import functions as F

from flyway.models.latent import dense_users, latent_topk
from flyway.models.learned import clip_count, count_regression, learned_at_counts, learned_topk
from flyway.models.popularity import mean_count_predict, popularity_topk
from flyway.operators.metrics import ranking_metrics
from flyway.plans.crossval import count_errors, model_summary, normalized_errors
from flyway.plans.pipeline import folded


def data_of(spark, noise):
    """60 observers, 5 years: group a goes from a0 to a1, the smaller group b from b0 to b1."""
    rows = []
    for o in range(60):
        g = "a" if o % 5 < 3 else "b"
        for y in range(2000, 2004):
            extra = [f"x{(o * 7 + y) % 6}"] if noise else []
            rows.append((-(1 << 40) + o, y, y + 1, sorted([g + "0", "c", *extra]), [g + "1"]))
    trans = spark.createDataFrame(rows, "observer_id bigint, year_from int, year_to int, "
                                        "species_from array<string>, species_to array<string>")
    return folded(spark, "", trans=trans, n_folds=3)


@pytest.fixture(scope="module")
def planted(spark):
    return data_of(spark, True)


def precision(data, preds):
    truth = data.fold_trans.where("role = 'test'")
    m = ranking_metrics(preds, truth, 1, data.n_species).where("metric = 'precision@k'")
    return {r.fold: r.value for r in m.collect()}


def test_learned_ranker_beats_popularity(planted):
    base = precision(planted, popularity_topk(planted.fold_trans, planted.catalogue, k=1))
    mine = precision(planted, learned_topk(planted, k=1))
    assert all(mine[f] > base[f] for f in base) and mine[3] == 1.0


def test_latent_factors_beat_popularity(spark):
    data = data_of(spark, False)            # its ratings are sets: species seen once count like any
    base = precision(data, popularity_topk(data.fold_trans, data.catalogue, k=1))
    mine = precision(data, latent_topk(data.fold_trans, k=1, rank=4))
    assert mine[3] > base[3]


def test_users_are_numbered_densely(planted):
    got = dense_users(planted.fold_trans, parts=7).collect()
    assert sorted(r.user for r in got) == list(range(60)) and len({r.observer_id for r in got}) == 60


def test_count_regression_beats_the_mean(spark, planted):
    # Next year's birds grow with this year's: learnable from the observer's own total.
    obs = planted.fold_trans.select("observer_id").distinct()
    n = (F.pmod("observer_id", F.lit(20)) + 1).cast("double")
    summary = (obs.select("observer_id", F.explode(F.sequence(F.lit(2000), F.lit(2004))).alias("year"))
               .select("observer_id", "year", *[F.array(F.lit("s")).alias(c) for c in
                                                ("scientific_name", "state", "county")],
                       F.array(F.lit(1).cast("bigint")).alias("locality_id"),
                       *[F.array(n).alias(c) for c in ("effort_hours", "effort_distance_km", "duration_minutes")],
                       F.array(F.lit(1)).alias("number_observers"), (n * 10).alias("total_observations")))
    pred, actual = count_regression(planted, summary)
    mean = mean_count_predict(planted.fold_trans, summary.select("observer_id", "year", "total_observations"))

    def error(p):
        return p.join(actual, ["fold", "observer_id"]).agg(F.avg(F.abs(F.col("predicted") - F.col("actual")))).first()[0]
    assert error(pred) < 0.5 * error(mean)


def test_clip(spark):
    df = spark.createDataFrame([(-5.0,), (3.5,), (1e9,)], "p double")
    assert [r[0] for r in df.select(clip_count(F.col("p"))).collect()] == [0.0, 3.5, 10000.0]


def test_holdout_chooses_the_regularisation(planted):
    losses = {}
    mine = precision(planted, learned_topk(planted, k=1, reg_param=(0.001, 5.0), chosen=losses))
    assert set(losses) == {2, 3} and all(set(x) == {0.001, 5.0} for x in losses.values())
    assert all(x[0.001] < x[5.0] for x in losses.values())            # a planted signal: shrinking it away costs
    assert mine[3] == 1.0


def counted_summary(planted):
    """Every observer's yearly total is 1 to 4 birds."""
    obs = planted.fold_trans.select("observer_id").distinct()
    n = (F.pmod("observer_id", F.lit(4)) + 1).cast("double")
    return (obs.select("observer_id", F.explode(F.sequence(F.lit(2000), F.lit(2004))).alias("year"))
            .select("observer_id", "year", *[F.array(F.lit("s")).alias(c) for c in ("scientific_name", "state", "county")],
                    F.array(F.lit(1).cast("bigint")).alias("locality_id"),
                    *[F.array(n).alias(c) for c in ("effort_hours", "effort_distance_km", "duration_minutes")],
                    F.array(F.lit(1)).alias("number_observers"), n.alias("total_observations")))


def test_every_observer_gets_as_many_species_as_predicted(planted):
    summary = counted_summary(planted)
    counts, _ = count_regression(planted, summary)
    size = planted.n_species.first()[0]
    want = {(r.fold, r.observer_id): min(max(round(r.predicted), 1), size) for r in counts.collect()}
    got, full = (learned_at_counts(planted, summary).collect(), learned_topk(planted, k=size, summary=summary).collect())
    seen = {(r.fold, r.observer_id): len(r.species_from)
            for r in planted.fold_trans.where("role = 'test'").collect()}
    lengths = {}
    for r in got:
        lengths[r.fold, r.observer_id] = max(lengths.get((r.fold, r.observer_id), 0), r["rank"])
    assert len(set(want.values())) > 1
    assert lengths == {key: min(k, size - seen[key]) for key, k in want.items()}
    whole = {(r.fold, r.observer_id, r["rank"]): r.species for r in full}
    assert all(whole[r.fold, r.observer_id, r["rank"]] == r.species for r in got)


def test_errors_of_two_count_models_are_divided_by_the_larger(planted):
    errors = count_errors(planted, counted_summary(planted)).cache()
    mean = {(r.model, r.metric): r.mean_value for r in model_summary(errors).collect()}
    for r in normalized_errors(errors).collect():
        if r.metric == "count_correlation":
            assert r.normalized == mean[r.model, r.metric]
        else:
            assert r.normalized == pytest.approx(
                mean[r.model, r.metric] / max(mean["baseline", r.metric], mean["neural", r.metric]))
    assert mean["neural", "count_mae"] < mean["baseline", "count_mae"]
