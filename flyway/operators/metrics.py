"""Ranking and regression metrics over long prediction tables.

Predictions: (fold, observer_id, species, score, rank) with rank 1..K.
Truth: (fold, observer_id, species_to) -- one test row per key.
Every metric is a (fold, metric, value) row; nothing leaves the executors except
the final per-fold numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import activity_band
from ..session import cut_lineage

KEY = ["fold", "observer_id"]
RANKING_METRICS = ["precision@k", "recall@k", "map@k", "coverage",
                   "precision_full", "recall_full", "map_full"]


def hits(preds: DataFrame, truth: DataFrame) -> DataFrame:
    """Each prediction flagged hit/miss, with the running hit count by rank -- J16 + W3.

    Inner join on the test key; the join partitions by (fold, observer_id), which
    the window reuses (no second shuffle).
    """
    t = truth.select(*KEY, "species_to")
    j = preds.join(t, KEY)
    w = Window.partitionBy(*KEY).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return (j.withColumn("hit", F.array_contains("species_to", F.col("species")).cast("int"))
             .withColumn("cum_hits", F.sum("hit").over(w))
             .drop("species_to"))


def per_observer(preds: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """One row per test key with a non-empty truth set (P8) and its hit statistics."""
    h = hits(preds, truth)
    in_k = F.col("rank") <= k
    in_t = F.col("rank") <= F.col("n_truth")
    prec = F.col("cum_hits") / F.col("rank")
    t = (truth.where(F.size("species_to") > 0)
              .select(*KEY, F.size("species_to").alias("n_truth")))
    stats = (h.join(t, KEY)
              .groupBy(*KEY, "n_truth")
              .agg(F.sum(F.when(in_k, F.col("hit")).otherwise(0)).alias("hits_k"),
                   F.sum(F.when(in_k & (F.col("hit") == 1), prec).otherwise(0.0)).alias("ap_k_num"),
                   F.count(F.lit(1)).alias("n_pred"),
                   F.sum("hit").alias("hits_all"),
                   F.sum(F.when(in_t, F.col("hit")).otherwise(0)).alias("hits_full"),
                   F.sum(F.when(in_t & (F.col("hit") == 1), prec).otherwise(0.0)).alias("ap_full_num")))
    # Observers without any prediction still count (zero hits).
    return (t.join(stats.drop("n_truth"), KEY, "left")
             .na.fill(0, ["hits_k", "n_pred", "hits_all", "hits_full"])
             .na.fill(0.0, ["ap_k_num", "ap_full_num"]))


def ranking_metrics(preds: DataFrame, truth: DataFrame, k: int, n_species: DataFrame,
                    include_zero: bool = False) -> DataFrame:
    """precision@k, recall@k, map@k, coverage, precision_full, recall_full, map_full -- A18-A22.

    * MAP leaves out keys without a hit unless ``include_zero`` (reference default: out).
    * precision_full skips keys without predictions.
    * ``n_species`` is a one-row frame with column ``n_species`` (catalogue size);
      it enters as a scalar subquery, not a join.
    """
    preds = cut_lineage(preds, "predictions")      # read twice: hits and coverage
    po = per_observer(preds, truth, k)
    map_k = F.col("ap_k_num") / F.least(F.col("n_truth"), F.lit(k))
    map_f = F.col("ap_full_num") / F.col("n_truth")
    zero_k = F.lit(True) if include_zero else (F.col("hits_k") > 0)
    zero_f = F.lit(True) if include_zero else (F.col("hits_full") > 0)
    wide = po.groupBy("fold").agg(
        F.avg(F.col("hits_k") / F.lit(float(k))).alias("precision@k"),
        F.avg(F.col("hits_k") / F.col("n_truth")).alias("recall@k"),
        F.coalesce(F.avg(F.when(zero_k, map_k)), F.lit(0.0)).alias("map@k"),
        F.coalesce(F.avg(F.when(F.col("n_pred") > 0, F.col("hits_all") / F.col("n_pred"))),
                   F.lit(0.0)).alias("precision_full"),
        F.avg(F.col("hits_full") / F.col("n_truth")).alias("recall_full"),
        F.coalesce(F.avg(F.when(zero_f, map_f)), F.lit(0.0)).alias("map_full"))
    cov = (preds.groupBy("fold").agg(F.count_distinct("species").alias("_n_pred_species"))
                .select("fold", (F.col("_n_pred_species")
                                 / n_species.select("n_species").scalar()).alias("coverage")))
    wide = wide.join(cov, "fold", "left").na.fill(0.0, ["coverage"])
    long = wide.unpivot("fold", RANKING_METRICS, "metric", "value")
    return long.select("fold", F.lit(k).alias("k"), "metric", F.col("value").cast("double"))


def ranking_metrics_at(preds: DataFrame, truth: DataFrame, ks: list[int], n_species: DataFrame,
                       include_zero: bool = False) -> DataFrame:
    """``ranking_metrics`` of the first K predictions for every K of ``ks``, from one prediction table (M9).

    An observer's hit prefixes at all K come from one pass over the running hits; a species' best rank in
    a fold tells from which K on it is covered.
    """
    preds = cut_lineage(preds, "predictions")      # read twice: hits and coverage
    prec = F.col("cum_hits") / F.col("rank")
    hit = F.col("hit") == 1

    def at(k):
        first = F.col("rank") <= k
        full = first & (F.col("rank") <= F.col("n_truth"))
        return F.struct(F.lit(k).alias("k"), F.count(F.when(first & hit, 1)).alias("hits"),
                        F.sum(F.when(first & hit, prec).otherwise(0.0)).alias("ap"), F.count(F.when(first, 1)).alias("n_pred"),
                        F.count(F.when(full & hit, 1)).alias("hits_full"),
                        F.sum(F.when(full & hit, prec).otherwise(0.0)).alias("ap_full"))

    t = truth.where(F.size("species_to") > 0).select(*KEY, F.size("species_to").alias("n_truth"))
    stats = hits(preds, truth).join(t, KEY).groupBy(*KEY, "n_truth").agg(F.array(*map(at, ks)).alias("at")).drop("n_truth")
    nothing = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(0).cast("long").alias("hits"), F.lit(0.0).alias("ap"),
                                 F.lit(0).cast("long").alias("n_pred"), F.lit(0).cast("long").alias("hits_full"),
                                 F.lit(0.0).alias("ap_full")) for k in ks])
    po = t.join(stats, KEY, "left").select("fold", "n_truth", F.explode(F.coalesce("at", nothing)).alias("a")) \
        .select("fold", "n_truth", "a.*")
    met = F.lit(True) if include_zero else (F.col("hits") > 0)
    met_full = F.lit(True) if include_zero else (F.col("hits_full") > 0)
    wide = po.groupBy("fold", "k").agg(
        F.avg(F.col("hits") / F.col("k").cast("double")).alias("precision@k"),
        F.avg(F.col("hits") / F.col("n_truth")).alias("recall@k"),
        F.coalesce(F.avg(F.when(met, F.col("ap") / F.least("n_truth", "k"))), F.lit(0.0)).alias("map@k"),
        F.coalesce(F.avg(F.when(F.col("n_pred") > 0, F.col("hits") / F.col("n_pred"))), F.lit(0.0)).alias("precision_full"),
        F.avg(F.col("hits_full") / F.col("n_truth")).alias("recall_full"),
        F.coalesce(F.avg(F.when(met_full, F.col("ap_full") / F.col("n_truth"))), F.lit(0.0)).alias("map_full"))
    best = preds.groupBy("fold", "species").agg(F.min("rank").alias("rank"))
    total = n_species.select("n_species").scalar()
    cov = best.groupBy("fold").agg(F.array(*[F.struct(
        F.lit(k).alias("k"), (F.count(F.when(F.col("rank") <= k, 1)) / F.max(total)).alias("coverage")) for k in ks]).alias("c")) \
        .select("fold", F.inline("c"))
    wide = wide.join(cov, ["fold", "k"], "left").na.fill(0.0, ["coverage"])
    return (wide.unpivot(["fold", "k"], RANKING_METRICS, "metric", "value")
            .select("fold", "k", "metric", F.col("value").cast("double")))


def count_metrics(rows: DataFrame, group: list[str] | None = None) -> DataFrame:
    """MAE, RMSE, correlation, MAPE (also over non-zero actuals only), mean actual / predicted -- A23.

    ``rows`` has (*group, actual, predicted).  Predictions are floored at 0;
    correlation is 0 unless both population std devs are positive; MAPE divides
    by (actual + 1e-8) and is in percent.
    """
    g = list(group or ["fold"])
    a = F.col("actual").cast("double")
    p = F.greatest(F.col("predicted").cast("double"), F.lit(0.0))
    r = rows.select(*g, a.alias("a"), p.alias("p"))
    corr_ok = (F.stddev_pop("a") > 0) & (F.stddev_pop("p") > 0)
    # corr() itself divides by zero (an error under ANSI) when a side is constant.
    corr = F.try_divide(F.covar_pop("a", "p"), F.stddev_pop("a") * F.stddev_pop("p"))
    wide = r.groupBy(*g).agg(
        F.avg(F.abs(F.col("a") - F.col("p"))).alias("count_mae"),
        F.sqrt(F.avg(F.pow(F.col("a") - F.col("p"), 2))).alias("count_rmse"),
        F.when(corr_ok, F.coalesce(F.nanvl(corr, F.lit(0.0)), F.lit(0.0)))
         .otherwise(F.lit(0.0)).alias("count_correlation"),
        (F.avg(F.abs((F.col("a") - F.col("p")) / (F.col("a") + F.lit(1e-8)))) * 100).alias("count_mape"),
        F.coalesce(F.avg(F.when(F.col("a") != 0, F.abs((F.col("a") - F.col("p")) / F.col("a")))) * 100,
                   F.lit(0.0)).alias("mape_nonzero"),
        F.avg("a").alias("mean_actual_count"),
        F.avg("p").alias("mean_predicted_count"))
    names = ["count_mae", "count_rmse", "count_correlation", "count_mape", "mape_nonzero",
             "mean_actual_count", "mean_predicted_count"]
    return wide.unpivot(g, names, "metric", "value")


def activity_bands(preds: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """P@k, R@k, MAP@k per activity band (next-year species count) -- A24."""
    po = per_observer(preds, truth, k).withColumn("activity_level", activity_band(F.col("n_truth")))
    map_k = F.col("ap_k_num") / F.least(F.col("n_truth"), F.lit(k))
    return (po.where(F.col("activity_level").isNotNull())
              .groupBy("fold", "activity_level")
              .agg(F.count(F.lit(1)).alias("n_birders"),
                   F.avg(F.col("hits_k") / F.lit(float(k))).alias("precision_at_k"),
                   F.avg(F.col("hits_k") / F.col("n_truth")).alias("recall_at_k"),
                   F.coalesce(F.avg(F.when(F.col("hits_k") > 0, map_k)), F.lit(0.0)).alias("map_at_k")))
