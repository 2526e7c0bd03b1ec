"""Registered model queries: co-occurrence, neighbours, learned models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import oracle as O
from .pipeline import folded
from .registry import cmp_ready, register, metric_keys
from ..models.cooccurrence import (boost_factor, cooccurrence_table, cooccurrence_topk,
                                   fit_counts, history_share)
from ..operators.species import fold_species_features


def _cooc(spark, sf, k=O.K):
    d = folded(spark, sf)
    feats = fold_species_features(d.fold_trans, scope="train")
    return d, cooccurrence_topk(d.fold_trans, d.transitions, d.folds, d.catalogue, d.n_species,
                                k=k, features=feats, n_folds=d.n_folds)


@register("history_popularity", O.with_(["hist_share"], """
SELECT fold, species, CAST(n_i AS BIGINT) AS n_rows, round(share, 6) AS share FROM hist_share
"""))
def q_history_popularity(spark, sf):
    d = folded(spark, sf)
    n_i, _ = fit_counts(d.transitions, d.folds)
    return cmp_ready(history_share(n_i).select("fold", "species", F.col("n_i").alias("n_rows"), "share"))


@register("cooc_pairs", O.with_(["cooc"], """
SELECT fold, species_i, species_j, CAST(n_ij AS BIGINT) AS n_ij FROM cooc
"""))
def q_cooc_pairs(spark, sf):
    d = folded(spark, sf)
    _, n_ij = fit_counts(d.transitions, d.folds)
    return n_ij


@register("cooccurrence", O.with_(["cooc", "hist_n", "n_species"], """
SELECT c.fold, c.species_i, c.species_j, CAST(c.n_ij AS BIGINT) AS n_ij,
       round((c.n_ij + 0.1) / (h.n_i + 0.1 * (SELECT s FROM n_species)), 6) AS p_j_given_i
FROM cooc c JOIN hist_n h ON h.fold = c.fold AND h.species = c.species_i
"""))
def q_cooccurrence(spark, sf):
    d = folded(spark, sf)
    n_i, n_ij = fit_counts(d.transitions, d.folds)
    S = d.n_species.select(F.col("n_species").cast("double")).scalar()
    return cmp_ready(cooccurrence_table(n_i, n_ij, S, 0.1))


@register("popularity_boost", O.with_(["boost"], """
SELECT fold, species, round(boost, 6) AS boost FROM boost
"""))
def q_popularity_boost(spark, sf):
    d = folded(spark, sf)
    return cmp_ready(boost_factor(fold_species_features(d.fold_trans, scope="train")))


@register("cooccurrence_topk", O.with_(["pred_cooc"], """
SELECT fold, observer_id, species, round(score, 6) AS score, rank FROM pred_cooc
"""))
def q_cooccurrence_topk(spark, sf):
    return cmp_ready(_cooc(spark, sf)[1])


metric_keys("cooc", "pred_cooc", lambda spark, sf: _cooc(spark, sf))


# ---------------------------------------------------------------- neighbours
from ..session import cut_lineage  # noqa: E402
from ..models.lsh import lsh_neighbors, recall  # noqa: E402
from ..models.neighbors import neighbor_search, neighbor_topk  # noqa: E402


def _nb(metric):
    def build(spark, sf):
        d = folded(spark, sf)
        return d, neighbor_topk(d.fold_trans, k=O.K, metric=metric)
    return build


def _nb_frames(spark, sf):
    d = folded(spark, sf)
    test = (d.fold_trans.where(F.col("role") == "test")
                        .select("fold", "observer_id", "species_from"))
    train = (d.fold_trans.where(F.col("role") == "train")
                         .select("fold", "observer_id", "year_from",
                                 F.array_union("species_from", "species_to").alias("species")))
    return test, train


@register("neighbor_topk_cosine", O.with_(["pred_nb_cosine"], """
SELECT fold, observer_id, species, round(score, 6) AS score, rank FROM pred_nb_cosine
"""))
def q_neighbor_topk_cosine(spark, sf):
    return cmp_ready(_nb("cosine")(spark, sf)[1])


@register("neighbor_topk_jaccard", O.with_(["pred_nb_jaccard"], """
SELECT fold, observer_id, species, round(score, 6) AS score, rank FROM pred_nb_jaccard
"""))
def q_neighbor_topk_jaccard(spark, sf):
    return cmp_ready(_nb("jaccard")(spark, sf)[1])


@register("topn_neighbors", O.with_(["nb_top_cosine"], """
SELECT fold, observer_id, nb_observer_id, nb_year_from, CAST(common AS BIGINT) AS common,
       round(sim, 6) AS sim, CAST(nb_rank AS INTEGER) AS nb_rank FROM nb_top_cosine
"""))
def q_topn_neighbors(spark, sf):
    return cmp_ready(neighbor_search(*_nb_frames(spark, sf)))


@register("neighbor_votes", O.with_(["nb_votes_cosine"], """
SELECT fold, observer_id, species, round(score, 6) AS score FROM nb_votes_cosine
"""))
def q_neighbor_votes(spark, sf):
    return cmp_ready(neighbor_search(*_nb_frames(spark, sf), output="votes"))


metric_keys("neighbor_cosine", "pred_nb_cosine", _nb("cosine"))
metric_keys("neighbor_jaccard", "pred_nb_jaccard", _nb("jaccard"))


@register("neighbor_lsh")
def q_neighbor_lsh(spark, sf):
    """M4 by MinHash candidates, ranked by exact similarity (hash candidates have no SQL form)."""
    return cmp_ready(lsh_neighbors(*_nb_frames(spark, sf)))


@register("lsh_recall")
def q_lsh_recall(spark, sf):
    """Share of the exact Jaccard neighbours that the MinHash candidates hold, per fold."""
    test, train = _nb_frames(spark, sf)
    exact = cut_lineage(neighbor_search(test, train, "jaccard"), "nb-exact")
    return cmp_ready(recall(cut_lineage(lsh_neighbors(test, train), "nb-lsh"), exact))


# ---------------------------------------------------------------- MLlib models (rows-only)
from .pipeline import summary  # noqa: E402
from ..models.latent import latent_topk  # noqa: E402
from ..models.learned import count_regression, learned_at_counts, learned_topk  # noqa: E402
from ..operators.metrics import count_metrics  # noqa: E402
from ..operators.transitions import transitions  # noqa: E402
from .crossval import (DEFAULT_MODELS, count_errors, cross_validate, evaluate_fold, feature_lift,  # noqa: E402
                       normalized_errors)  # noqa: E402


@register("latent_topk")
def q_latent_topk(spark, sf):
    d = folded(spark, sf)
    return latent_topk(d.fold_trans, k=O.K)


@register("learned_topk")
def q_learned_topk(spark, sf):
    d = folded(spark, sf)
    return learned_topk(d, k=O.K, summary=summary(spark, sf))


@register("learned_holdout_choice")
def q_learned_holdout_choice(spark, sf):
    """M0d: per fold, the holdout log loss of every regularisation tried, and which one the fit took."""
    d, losses = folded(spark, sf), {}
    learned_topk(d, k=O.K, summary=summary(spark, sf), reg_param=(0.001, 0.01, 0.1), chosen=losses)
    rows = [(f, r, v, r == min(by, key=lambda x: (by[x], -x))) for f, by in losses.items() for r, v in by.items()]
    return spark.createDataFrame(rows, "fold int, reg_param double, log_loss double, chosen boolean")


@register("count_regression")
def q_count_regression(spark, sf):
    d = folded(spark, sf)
    p, a = count_regression(d, summary(spark, sf))
    return count_metrics(p.join(a, ["fold", "observer_id"]), ["fold"])


@register("learned_predicted_k")
def q_learned_predicted_k(spark, sf):
    """W7 by the learned model: every observer's ranking is as long as the count predicted for them."""
    return learned_at_counts(folded(spark, sf), summary(spark, sf))


@register("normalized_errors_models")
def q_normalized_errors_models(spark, sf):
    """A29 over the models that predict counts: the frozen mean and the regression."""
    s = cut_lineage(summary(spark, sf), "summary")       # its species sets are those that transitions are made of
    d = folded(spark, sf, trans=transitions(s))
    return cmp_ready(normalized_errors(count_errors(d, s)))


@register("with_vs_without_features")
def q_with_vs_without_features(spark, sf):
    d = folded(spark, sf)
    w = evaluate_fold(d, "neural", learned_topk(d, k=O.K, summary=summary(spark, sf)), O.K)
    wo = evaluate_fold(d, "neural", learned_topk(d, k=O.K), O.K)
    return feature_lift(w, wo)


@register("cross_validate_all")
def q_cross_validate_all(spark, sf):
    """The default run: all four models, the learned one with its predicted counts."""
    return cross_validate(folded(spark, sf), {**DEFAULT_MODELS, "neural": {}}, O.K, summary(spark, sf))


from ..models.cooccurrence import cooc_raw_scores  # noqa: E402


@register("cooc_score", O.with_(["cooc_dense"], """
SELECT fold, observer_id, species, round(raw_score, 6) AS score FROM cooc_dense WHERE n_pairs > 0
"""))
def q_cooc_score(spark, sf):
    d = folded(spark, sf)
    return cmp_ready(cooc_raw_scores(d.fold_trans, d.transitions, d.folds, d.catalogue, d.n_species))


@register("neighbor_pairs", O.with_(["nb_pairs_cosine"], """
SELECT fold, observer_id, CAST(count(*) AS BIGINT) AS n_candidates FROM nb_pairs_cosine GROUP BY fold, observer_id
"""))
def q_neighbor_pairs(spark, sf):
    return neighbor_search(*_nb_frames(spark, sf), output="counts")


# ---------------------------------------------------------------- scenario grid
from ..sources.fixture import region_states  # noqa: E402
from .scenarios import scenario_data, scenario_lift, scenario_metrics, scenario_predictions  # noqa: E402

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
O.metric_ctes("pred_cooc_noboost")


def _scenario_sql(body: str) -> str:
    """``body`` over the metrics of every scenario: one regional run of the SQL models after the other."""
    runs = []
    for name in [None, *REGIONS]:
        select = "\nUNION ALL\n".join(
            f"SELECT '{name or 'everywhere'}' AS region, {flag} AS features, 'collaborative' AS model, fold, k, metric, "
            f"value FROM {cte} WHERE metric IN ('precision@k', 'recall@k', 'map@k')"
            for flag, cte in (("false", "pred_cooc_noboost_long"), ("true", "pred_cooc_long")))
        names, instead = ["pred_cooc_long", "pred_cooc_noboost_long"], {}
        if name:
            short = name.lower().replace(" ", "_")
            O.region_ctes(name, f"states_{short}", f"summ_{short}", f"trans_{short}")
            instead = {"trans": f"trans_{short}"}
        runs.append(f"SELECT * FROM ({O.with_in(names, select, **instead)})")
    return f"WITH grid AS ({chr(10)}{(chr(10) + 'UNION ALL' + chr(10)).join(runs)})\n{body.strip()}"


def _scenarios(spark, sf, regions):
    allowed = {"everywhere": None, **{r: region_states(spark, sf, r) for r in regions}}
    full = cut_lineage(summary(spark, sf), "summary")
    return full, scenario_data(full, allowed)


def _collaborative_grid(spark, sf):
    d = _scenarios(spark, sf, REGIONS)[1]
    return scenario_metrics(d, scenario_predictions(d, "collaborative", O.K), "collaborative", O.K)


@register("scenario_metrics", _scenario_sql("""
SELECT region, features, model, fold, k, metric, round(value, 6) AS value FROM grid
"""))
def q_scenario_metrics(spark, sf):
    """Every region with and without species features, one fit and one scoring for all of them."""
    return cmp_ready(_collaborative_grid(spark, sf))


@register("scenario_lift", _scenario_sql("""
SELECT region, model, metric, round(a, 6) AS without, round(b, 6) AS with,
       round(CASE WHEN a <> 0 THEN (b - a) / a * 100.0 END, 6) AS lift_pct
FROM (SELECT region, model, metric, avg(value) FILTER (WHERE NOT features) AS a,
             avg(value) FILTER (WHERE features) AS b
      FROM grid GROUP BY region, model, metric)
"""))
def q_scenario_lift(spark, sf):
    return cmp_ready(scenario_lift(_collaborative_grid(spark, sf)))


@register("scenario_lift_models")
def q_scenario_lift_models(spark, sf):
    """Lift of the three models that take features, nationally and in one region (the learned one has no SQL form)."""
    full, d = _scenarios(spark, sf, ["EUROPE"])
    parts = [scenario_metrics(d, scenario_predictions(d, m, O.K, full), m, O.K)
             for m in ("collaborative", "user_collaborative", "neural")]
    return scenario_lift(reduce(DataFrame.unionByName, parts))
