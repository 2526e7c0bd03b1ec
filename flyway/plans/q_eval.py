"""Registered evaluation / report queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import oracle as O
from .crossval import (DEFAULT_K, baseline_counts, best_model, cross_validate, evaluate_fold, feature_lift,
                       metric_quartiles, model_summary, normalized_errors, report_lines)
from .pipeline import folded, summary
from .registry import cmp_ready, register
from ..functions import predicted_k
from ..models import create_model
from ..models.common import KEY, ranked_fillers, test_rows, top_k
from ..models.learned import clip_count
from ..models.popularity import (frozen_popularity, mean_count, mean_count_predict,
                                 popularity_topk)
from ..operators.metrics import activity_bands, count_metrics, hits
from ..operators.region import region_transitions
from ..session import cut_lineage
from ..sources import fixture as FX
from ..sources import sinks as SK

_CV_OUT = "SELECT model, fold, k, metric, round(value, 6) AS value FROM cv"
O.metric_ctes("pred_cooc_noboost")


def _cv(spark, sf):
    # The metric table is tiny and feeds several aggregates: checkpoint it once
    # (reliable checkpoint in the shared folder) instead of re-deriving it.
    d = folded(spark, sf)
    return d, cut_lineage(cross_validate(d, k=O.K, summary=summary(spark, sf)))


@register("cross_validate", O.with_(["cv"], _CV_OUT))
def q_cross_validate(spark, sf):
    return cmp_ready(_cv(spark, sf)[1])


MANY_K = [5, 20, 70]
O.cte("pred_pop_70", """
SELECT fold, observer_id, species, score, CAST(rk AS INTEGER) AS rank FROM (
  SELECT t.fold, t.observer_id, p.species, CAST(p.n_viewers AS DOUBLE) AS score,
         row_number() OVER (PARTITION BY t.fold, t.observer_id ORDER BY p.pop_rank) AS rk
  FROM test t JOIN pop p ON NOT list_contains(t.species_from, p.species))
WHERE rk <= 70
""", ["test", "pop"])
for _k in MANY_K[:-1]:
    O.cte(f"pred_pop_{_k}", f"SELECT * FROM pred_pop_70 WHERE rank <= {_k}", ["pred_pop_70"])
_MANY = [O.metric_ctes(f"pred_pop_{_k}", _k) for _k in MANY_K]


@register("metrics_many_k", O.with_(_MANY, "\nUNION ALL\n".join(
    f"SELECT fold, k, metric, round(value, 6) AS value FROM {m}" for m in _MANY)))
def q_metrics_many_k(spark, sf):
    """Every K from one prediction table."""
    d = folded(spark, sf)
    preds = popularity_topk(d.fold_trans, d.catalogue, k=max(MANY_K))
    return cmp_ready(evaluate_fold(d, "baseline", preds, MANY_K).drop("model"))


@register("cross_validate_default", O.with_(["pred_pop_70_long", "pred_cooc_long", "pred_nb_cosine_long", "cnt_long"], f"""
SELECT 'baseline' AS model, fold, k, metric, round(value, 6) AS value FROM pred_pop_70_long
UNION ALL SELECT 'collaborative', fold, k, metric, round(value, 6) FROM pred_cooc_long
UNION ALL SELECT 'user_collaborative', fold, k, metric, round(value, 6) FROM pred_nb_cosine_long
UNION ALL SELECT 'baseline', fold, CAST({DEFAULT_K["baseline"]} AS INTEGER), metric, round(value, 6) FROM cnt_long
"""))
def q_cross_validate_default(spark, sf):
    """The default comparison run: the baseline at 70, the others at 10."""
    return cmp_ready(cross_validate(folded(spark, sf), k=O.K, summary=summary(spark, sf), k_of=DEFAULT_K))


@register("evaluate_fold", O.with_(["pred_pop_long", "cnt_long"], f"""
SELECT 'baseline' AS model, fold, k, metric, round(value, 6) AS value FROM pred_pop_long
UNION ALL
SELECT 'baseline' AS model, fold, CAST({O.K} AS INTEGER) AS k, metric, round(value, 6) AS value FROM cnt_long
"""))
def q_evaluate_fold(spark, sf):
    d = folded(spark, sf)
    preds = popularity_topk(d.fold_trans, d.catalogue, k=O.K)
    counts, actual = baseline_counts(d, summary(spark, sf))
    return cmp_ready(evaluate_fold(d, "baseline", preds, O.K, counts, actual))


@register("count_metrics", O.with_(["cnt_long"], "SELECT fold, metric, round(value, 6) AS value FROM cnt_long"))
def q_count_metrics(spark, sf):
    d = folded(spark, sf)
    counts, actual = baseline_counts(d, summary(spark, sf))
    return cmp_ready(count_metrics(counts.join(actual, KEY), ["fold"]))


@register("mean_count", O.with_(["mean_cnt"], "SELECT round(m, 6) AS mean_count FROM mean_cnt"))
def q_mean_count(spark, sf):
    d = folded(spark, sf)
    return cmp_ready(mean_count(d.fold_trans, summary(spark, sf)))


@register("mean_count_predict", O.with_(["cnt_rows"], """
SELECT fold, observer_id, round(p, 6) AS predicted FROM cnt_rows
"""))
def q_mean_count_predict(spark, sf):
    d = folded(spark, sf)
    return cmp_ready(baseline_counts(d, summary(spark, sf))[0])


@register("model_summary", O.with_(["cv_summary"], """
SELECT model, k, metric, round(mean_value, 6) AS mean_value, n_folds FROM cv_summary
"""))
def q_model_summary(spark, sf):
    return cmp_ready(model_summary(_cv(spark, sf)[1]))


@register("best_model", O.with_(["cv_summary"], """
SELECT arg_max(model, mean_value) AS best_model, round(max(mean_value), 6) AS best_value
FROM cv_summary WHERE metric = 'map@k'
"""))
def q_best_model(spark, sf):
    return cmp_ready(best_model(_cv(spark, sf)[1]))


@register("metric_quartiles", O.with_(["cv"], """
SELECT model, metric, round(q[1], 6) AS q0, round(q[2], 6) AS q1, round(q[3], 6) AS q2,
       round(q[4], 6) AS q3, round(q[5], 6) AS q4
FROM (SELECT model, metric, quantile_cont(value, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q
      FROM cv GROUP BY model, metric)
"""))
def q_metric_quartiles(spark, sf):
    return cmp_ready(metric_quartiles(_cv(spark, sf)[1]))


@register("normalized_errors", O.with_(["cv_summary"], """
SELECT model, metric,
       round(CASE WHEN metric = 'count_correlation' THEN mean_value
                  ELSE mean_value / CASE WHEN max(mean_value) OVER (PARTITION BY metric) > 0
                                         THEN max(mean_value) OVER (PARTITION BY metric) ELSE 1.0 END
             END, 6) AS normalized
FROM cv_summary WHERE metric IN ('count_mae', 'count_rmse', 'count_correlation')
"""))
def q_normalized_errors(spark, sf):
    return cmp_ready(normalized_errors(_cv(spark, sf)[1]))


@register("feature_lift", O.with_(["pred_cooc_long", "pred_cooc_noboost_long"], """
SELECT 'collaborative' AS model, round(a.v, 6) AS without, round(b.v, 6) AS with,
       round(CASE WHEN a.v <> 0 THEN (b.v - a.v) / a.v * 100.0 END, 6) AS lift_pct
FROM (SELECT avg(value) AS v FROM pred_cooc_noboost_long WHERE metric = 'precision@k') a,
     (SELECT avg(value) AS v FROM pred_cooc_long WHERE metric = 'precision@k') b
"""))
def q_feature_lift(spark, sf):
    d = folded(spark, sf)
    w = evaluate_fold(d, "collaborative", create_model("collaborative", boost=True).recommend(d, O.K), O.K)
    wo = evaluate_fold(d, "collaborative", create_model("collaborative", boost=False).recommend(d, O.K), O.K)
    return cmp_ready(feature_lift(w, wo))


RANKED = ["precision@k", "recall@k", "map@k"]


@register("region_feature_lift", O.with_in(["pred_cooc_long", "pred_cooc_noboost_long"], """
SELECT 'EUROPE' AS region, 'collaborative' AS model, metric, round(a, 6) AS without, round(b, 6) AS with,
       round(CASE WHEN a <> 0 THEN (b - a) / a * 100.0 END, 6) AS lift_pct
FROM (SELECT metric, avg(value) AS a FROM pred_cooc_noboost_long GROUP BY metric)
JOIN (SELECT metric, avg(value) AS b FROM pred_cooc_long GROUP BY metric) USING (metric)
WHERE metric IN ('precision@k', 'recall@k', 'map@k')
""", trans="trans_region"))
def q_region_feature_lift(spark, sf):
    """One region's run, with and without species features, per metric."""
    states = FX.region_states(spark, sf, "EUROPE")
    d = folded(spark, sf, trans=region_transitions(summary(spark, sf), states))
    w, wo = (cut_lineage(evaluate_fold(d, "collaborative", create_model("collaborative", boost=b).recommend(d, O.K), O.K),
                         "region-metrics") for b in (True, False))
    lifts = [feature_lift(w, wo, m).withColumn("metric", F.lit(m)) for m in RANKED]
    return cmp_ready(reduce(DataFrame.unionByName, lifts).select(
        F.lit("EUROPE").alias("region"), "model", "metric", "without", "with", "lift_pct"))


def _report_sql() -> str:
    def line(label: str, src: str) -> str:
        def r4(c: str) -> str:
            return (f"(floor((floor(({c}) * 1000000000 + 0.5) / 1000000000) * 10000 + 0.5) / 10000)")
        return (f"printf('%s: P@%d=%.4f R@%d=%.4f MAP@%d=%.4f coverage=%.4f', {label}, k, "
                f"{r4('p')}, k, {r4('r')}, k, {r4('m')}, {r4('c')})")
    piv = """SELECT {keys}, k,
      max(CASE WHEN metric = 'precision@k' THEN {v} END) AS p,
      max(CASE WHEN metric = 'recall@k' THEN {v} END) AS r,
      max(CASE WHEN metric = 'map@k' THEN {v} END) AS m,
      max(CASE WHEN metric = 'coverage' THEN {v} END) AS c
    FROM {src} GROUP BY {keys}, k"""
    means = piv.format(keys="model", v="mean_value", src="cv_summary")
    folds = piv.format(keys="model, fold", v="value", src="cv")
    best = "(floor((floor((max(mean_value)) * 1000000000 + 0.5) / 1000000000) * 10000 + 0.5) / 10000)"
    return O.with_(["cv", "cv_summary"], f"""
SELECT 'mean' AS section, model, CAST(NULL AS INTEGER) AS fold, {line('model', '')} AS line FROM ({means})
UNION ALL
SELECT 'fold' AS section, model, CAST(fold AS INTEGER) AS fold,
       {line("model || ' fold ' || CAST(fold AS VARCHAR)", '')} AS line FROM ({folds})
UNION ALL
SELECT 'best' AS section, arg_max(model, mean_value) AS model, CAST(NULL AS INTEGER) AS fold,
       printf('best model by MAP: %s (%.4f)', arg_max(model, mean_value), {best}) AS line
FROM cv_summary WHERE metric = 'map@k'
""")


@register("report_table", _report_sql())
def q_report_table(spark, sf):
    lines = report_lines(_cv(spark, sf)[1])
    path = SK.write_report_text(lines, SK.new_output_dir(spark, "report"))
    assert spark.read.text(path).count() >= 1
    return lines


@register("metrics_json", O.with_(["cv"], _CV_OUT))
def q_metrics_json(spark, sf):
    path = SK.write_metrics_json(_cv(spark, sf)[1], SK.new_output_dir(spark, "metrics_json"))
    back = spark.read.schema("model STRING, fold INT, k INT, metric STRING, value DOUBLE").json(path)
    return cmp_ready(back)


@register("hits", O.with_(["pred_pop_h"], """
SELECT fold, observer_id, species, rank, hit FROM pred_pop_h
"""))
def q_hits(spark, sf):
    d = folded(spark, sf)
    h = hits(popularity_topk(d.fold_trans, d.catalogue, k=O.K), d.fold_trans.where(F.col("role") == "test"))
    return h.select("fold", "observer_id", "species", "rank", "hit")


@register("running_hits", O.with_(["pred_pop_h"], """
SELECT fold, observer_id, rank, CAST(cum_hits AS BIGINT) AS cum_hits,
       round(cum_hits / rank, 6) AS precision_at_rank FROM pred_pop_h
"""))
def q_running_hits(spark, sf):
    d = folded(spark, sf)
    h = hits(popularity_topk(d.fold_trans, d.catalogue, k=O.K), d.fold_trans.where(F.col("role") == "test"))
    return cmp_ready(h.select("fold", "observer_id", "rank", F.col("cum_hits").cast("bigint"),
                              (F.col("cum_hits") / F.col("rank")).alias("precision_at_rank")))


@register("activity_bands", O.with_(["pred_pop_po"], f"""
SELECT fold, activity_level, count(*) AS n_birders, round(avg(hits_k / {float(O.K)}), 6) AS precision_at_k,
       round(avg(hits_k / n_truth), 6) AS recall_at_k,
       round(coalesce(avg(CASE WHEN hits_k > 0 THEN ap_k_num / least(n_truth, {O.K}) END), 0.0), 6)
         AS map_at_k
FROM (SELECT *, CASE WHEN n_truth <= 0 THEN NULL WHEN n_truth <= 5 THEN '1-5'
                     WHEN n_truth <= 10 THEN '6-10' WHEN n_truth <= 20 THEN '11-20'
                     WHEN n_truth <= 50 THEN '21-50' ELSE '50+' END AS activity_level
      FROM pred_pop_po)
WHERE activity_level IS NOT NULL GROUP BY fold, activity_level
"""))
def q_activity_bands(spark, sf):
    d = folded(spark, sf)
    p = popularity_topk(d.fold_trans, d.catalogue, k=O.K)
    return cmp_ready(activity_bands(p, d.fold_trans.where(F.col("role") == "test"), O.K))


@register("exclude_viewed", O.with_(["test"], """
SELECT fold, observer_id, species FROM (
  SELECT fold, observer_id, unnest(species_to) AS species FROM test) n
WHERE NOT EXISTS (SELECT 1 FROM (SELECT fold, observer_id, unnest(species_from) AS species FROM test) v
                  WHERE v.fold = n.fold AND v.observer_id = n.observer_id AND v.species = n.species)
"""))
def q_exclude_viewed(spark, sf):
    t = folded(spark, sf).fold_trans.where(F.col("role") == "test")
    new = t.select(*KEY, F.explode("species_to").alias("species"))
    seen = t.select(*KEY, F.explode("species_from").alias("species"))
    return new.join(seen, [*KEY, "species"], "left_anti")


@register("popular_candidates", O.with_(["test", "pop"], f"""
SELECT t.fold, t.observer_id, p.species, CAST(p.pop_rank AS INTEGER) AS pos
FROM test t JOIN pop p ON p.pop_rank <= {O.K} + len(t.species_from)
WHERE NOT list_contains(t.species_from, p.species)
"""))
def q_popular_candidates(spark, sf):
    d = folded(spark, sf)
    pop = frozen_popularity(d.fold_trans, d.catalogue).select("species", F.col("pop_rank").alias("pos"))
    c = ranked_fillers(test_rows(d.fold_trans), pop, O.K)
    return c.select(*KEY, "species", F.col("pos").cast("int"))


@register("nonempty_truth", O.with_(["test"], """
SELECT fold, count(*) AS n_rows, count(*) FILTER (WHERE len(species_to) > 0) AS n_nonempty FROM test GROUP BY fold
"""))
def q_nonempty_truth(spark, sf):
    t = folded(spark, sf).fold_trans.where(F.col("role") == "test")
    return t.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.count_if(F.size("species_to") > 0).alias("n_nonempty"))


@register("min_common", O.with_(["pred_nb_cosine_mc2"], """
SELECT fold, observer_id, species, round(score, 6) AS score, rank FROM pred_nb_cosine_mc2
"""))
def q_min_common(spark, sf):
    d = folded(spark, sf)
    return cmp_ready(create_model("user_collaborative", min_common_species=2).recommend(d, O.K))


@register("positive_similarity", O.with_(["nb_top_cosine"], """
SELECT fold, count(*) AS n_neighbors, count(*) FILTER (WHERE sim > 0) AS n_positive,
       round(min(sim), 6) AS min_sim FROM nb_top_cosine GROUP BY fold
"""))
def q_positive_similarity(spark, sf):
    from ..models.neighbors import neighbor_search
    from .q_models import _nb_frames
    nb = neighbor_search(*_nb_frames(spark, sf))
    return cmp_ready(nb.groupBy("fold").agg(F.count(F.lit(1)).alias("n_neighbors"),
                                            F.count_if(F.col("sim") > 0).alias("n_positive"),
                                            F.min("sim").alias("min_sim")))


@register("clip_counts", O.with_(["cnt_rows"], """
SELECT fold, observer_id, round(least(greatest(p, 0.0), 10000.0), 6) AS clipped FROM cnt_rows
"""))
def q_clip_counts(spark, sf):
    predicted = baseline_counts(folded(spark, sf), summary(spark, sf))[0]
    return cmp_ready(predicted.select(*KEY, clip_count(F.col("predicted")).alias("clipped")))


@register("predicted_k", O.with_(["test", "train", "pop", "catalogue"], """
SELECT fold, observer_id, species, CAST(rk AS INTEGER) AS rank, kk FROM (
  SELECT t.fold, t.observer_id, p.species, t.kk,
         row_number() OVER (PARTITION BY t.fold, t.observer_id ORDER BY p.pop_rank) AS rk
  FROM (SELECT *, CAST(least(greatest(round_even((SELECT avg(len(species_to)) FROM train WHERE fold = 1), 0), 1.0),
                             (SELECT count(*) FROM catalogue)) AS INTEGER) AS kk FROM test) t
  JOIN pop p ON NOT list_contains(t.species_from, p.species))
WHERE rk <= kk
"""))
def q_predicted_k(spark, sf):
    # Per-row K from the predicted next-year species count (the frozen mean), then the
    # popularity ranking cut at that K.
    d = folded(spark, sf)
    S = d.n_species.select("n_species").scalar()
    t = (test_rows(d.fold_trans).join(mean_count_predict(d.fold_trans), KEY)
         .withColumn("kk", predicted_k(F.col("predicted"), S)).drop("predicted"))
    pop = frozen_popularity(d.fold_trans, d.catalogue).select("species", F.col("pop_rank").alias("pos"))
    c = ranked_fillers(t, pop, "kk")
    w = Window.partitionBy(*KEY).orderBy("pos")
    return (c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= F.col("kk"))
             .select(*KEY, "species", F.col("rank").cast("int"), "kk"))
