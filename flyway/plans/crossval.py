"""Cross-validation, evaluation and reports.

Folds are a column: each model produces the predictions of every fold in one
plan, the metrics are one aggregation by (model, fold), and only the small
metric table ever reaches the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..models import create_model
from ..models.learned import count_regression, learned_topk
from ..models.popularity import mean_count_predict
from ..operators.features import bird_counts
from ..operators.metrics import count_metrics, ranking_metrics, ranking_metrics_at
from ..session import cut_lineage

# Shipped defaults of the comparison runs.
DEFAULT_MODELS = {
    "baseline": {},
    "collaborative": {"alpha": 0.1},
    "user_collaborative": {"similarity_metric": "cosine", "n_similar_users": 50,
                           "min_common_species": 1},
}

# How many species each of them recommends there; 70 is about what an observer sees in a year.
DEFAULT_K = {"baseline": 70}


def truth(data) -> DataFrame:
    return data.fold_trans.where(F.col("role") == "test")


def evaluate_fold(data, model_name: str, preds: DataFrame, k: int | list[int] = 10,
                  counts: DataFrame | None = None, actual: DataFrame | None = None) -> DataFrame:
    """All ranking metrics (+ count metrics when the model predicts counts) -- M8.

    ``counts``: (fold, observer_id, predicted); ``actual``: (fold, observer_id, actual).  With a list
    of K, all are taken from the one prediction table; count metrics stand beside the largest.
    """
    if isinstance(k, list):
        m, k = ranking_metrics_at(preds, truth(data), k, data.n_species), max(k)
    else:
        m = ranking_metrics(preds, truth(data), k, data.n_species)
    if counts is not None and actual is not None:
        c = count_metrics(counts.join(actual, ["fold", "observer_id"]), ["fold"])
        m = m.unionByName(c.select("fold", F.lit(k).alias("k"), "metric", "value"))
    return m.select(F.lit(model_name).alias("model"), "fold", "k", "metric", "value")


def baseline_counts(data, summary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Frozen mean next-year bird count vs the actual count."""
    pred = mean_count_predict(data.fold_trans, summary.select("observer_id", "year", "total_observations"))
    t = truth(data).select("fold", "observer_id", "year_to")
    actual = bird_counts(t, summary).select("fold", "observer_id", F.col("bird_count").alias("actual"))
    return pred, actual


def count_errors(data, summary: DataFrame) -> DataFrame:
    """(model, fold, k, metric, value): count metrics of every model that predicts counts, without rankings."""
    runs = {"baseline": baseline_counts(data, summary.select("observer_id", "year", "total_observations")),
            "neural": count_regression(data, summary)}
    return reduce(DataFrame.unionByName, [
        count_metrics(p.join(a, ["fold", "observer_id"]), ["fold"])
        .select(F.lit(name).alias("model"), "fold", F.lit(0).alias("k"), "metric", "value")
        for name, (p, a) in runs.items()])


def cross_validate(data, models: dict[str, dict] | None = None, k: int | list[int] = 10,
                   summary: DataFrame | None = None, k_of: dict[str, int | list[int]] | None = None) -> DataFrame:
    """(model, fold, k, metric, value) for every model and fold -- M9.

    ``k``: K of every model that ``k_of`` (``DEFAULT_K`` in the default run) gives none of its own.  A
    list of K costs one set of predictions, at the largest.
    """
    models = models or DEFAULT_MODELS
    if summary is not None:             # read for the mean and for the actual counts
        full = cut_lineage(summary, "summary") if "neural" in models else summary
        summary = cut_lineage(full.select("observer_id", "year", "total_observations"), "counts")
    parts, every = [], k
    for name, params in models.items():
        model = create_model(name, **params)
        k = (k_of or {}).get(name, every)
        most = max(k) if isinstance(k, list) else k
        if name == "neural" and summary is not None:
            preds = learned_topk(data, k=most, summary=full, **params)
            counts, actual = count_regression(data, full)
            parts.append(evaluate_fold(data, name, preds, k, counts, actual))
            continue
        preds = model.recommend(data, most)
        counts = actual = None
        if name == "baseline" and summary is not None:
            counts, actual = baseline_counts(data, summary)
        parts.append(evaluate_fold(data, name, preds, k, counts, actual))
    return reduce(DataFrame.unionByName, parts)


def model_summary(metrics: DataFrame) -> DataFrame:
    """Mean over folds per (model, k, metric) -- A25."""
    return (metrics.groupBy("model", "k", "metric")
                   .agg(F.avg("value").alias("mean_value"), F.count(F.lit(1)).alias("n_folds")))


def best_model(metrics: DataFrame, metric: str = "map@k") -> DataFrame:
    """Model with the highest mean ``metric`` (ties: name) -- A27."""
    s = model_summary(metrics).where(F.col("metric") == metric)
    return s.agg(F.max_by("model", F.struct(F.round("mean_value", 12), F.col("model"))).alias("best_model"),
                 F.max("mean_value").alias("best_value"))


def metric_quartiles(metrics: DataFrame) -> DataFrame:
    """Min, quartiles, max over folds per (model, metric) -- A28 (numbers behind box plots)."""
    q = F.percentile("value", [0.0, 0.25, 0.5, 0.75, 1.0])
    return (metrics.groupBy("model", "metric").agg(q.alias("_q"))
                   .select("model", "metric", *[F.col("_q")[i].alias(n) for i, n in
                                                enumerate(["q0", "q1", "q2", "q3", "q4"])]))


def normalized_errors(metrics: DataFrame) -> DataFrame:
    """count MAE / RMSE divided by their max across models; correlation as is -- A29."""
    c = metrics.where(F.col("metric").isin("count_mae", "count_rmse", "count_correlation"))
    s = model_summary(c)
    mx = F.max("mean_value").over(Window.partitionBy("metric"))
    return s.select("model", "metric",
                    F.when(F.col("metric") == "count_correlation", F.col("mean_value"))
                     .otherwise(F.col("mean_value")
                                / F.when(mx > 0, mx).otherwise(F.lit(1.0))).alias("normalized"))


def feature_lift(with_f: DataFrame, without_f: DataFrame, metric: str = "precision@k") -> DataFrame:
    """% change of a mean metric with vs without features, per model -- A26."""
    a = model_summary(without_f).where(F.col("metric") == metric).select("model", F.col("mean_value").alias("without"))
    b = model_summary(with_f).where(F.col("metric") == metric).select("model", F.col("mean_value").alias("with"))
    return (a.join(b, "model")
             .withColumn("lift_pct", F.when(F.col("without") != 0,
                                            (F.col("with") - F.col("without")) / F.col("without") * 100.0)))


def _r4(c):
    c9 = F.floor(c * F.lit(1e9) + F.lit(0.5)) / F.lit(1e9)
    return F.floor(c9 * F.lit(1e4) + F.lit(0.5)) / F.lit(1e4)


def report_lines(metrics: DataFrame, metric_order=("precision@k", "recall@k", "map@k", "coverage")) -> DataFrame:
    """Text report as rows (section, model, fold, line) -- S11.

    Per model: one line of means; per (model, fold): one line; then the best
    model by mean MAP.  Numbers are rounded to 4 places before formatting.
    """
    keep = metrics.where(F.col("metric").isin(*metric_order))
    fmt = "%s: P@%d=%.4f R@%d=%.4f MAP@%d=%.4f coverage=%.4f"

    def wide(df, keys, val):
        return df.groupBy(*keys, "k").pivot("metric", list(metric_order)).agg(F.first(val))

    means = wide(model_summary(keep).withColumnRenamed("mean_value", "v"), ["model"], "v")
    per_fold = wide(keep.withColumnRenamed("value", "v"), ["model", "fold"], "v")

    def line(df, label):
        return F.format_string(fmt, label, F.col("k"), _r4(F.col("`precision@k`")), F.col("k"),
                               _r4(F.col("`recall@k`")), F.col("k"), _r4(F.col("`map@k`")),
                               _r4(F.col("coverage")))
    m = means.select(F.lit("mean").alias("section"), "model", F.lit(None).cast("int").alias("fold"),
                     line(means, F.col("model")).alias("line"))
    f = per_fold.select(F.lit("fold").alias("section"), "model", F.col("fold").cast("int"),
                        line(per_fold, F.concat(F.col("model"), F.lit(" fold "),
                                                F.col("fold").cast("string"))).alias("line"))
    b = best_model(metrics).select(F.lit("best").alias("section"), F.col("best_model").alias("model"),
                                   F.lit(None).cast("int").alias("fold"),
                                   F.format_string("best model by MAP: %s (%.4f)", F.col("best_model"),
                                                   _r4(F.col("best_value"))).alias("line"))
    return m.unionByName(f).unionByName(b)
