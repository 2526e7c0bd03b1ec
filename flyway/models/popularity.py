"""Popularity baseline.

Popularity is learned once, from the *first* fold's training targets, and frozen
for every later fold (the reference's naive baseline).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.species import target_popularity
from .common import KEY, ranked_fillers, test_rows, top_k


def frozen_popularity(fold_trans: DataFrame, catalogue: DataFrame, frozen_fold: int = 1) -> DataFrame:
    """(species, n_viewers, pop_rank) from the targets of fold ``frozen_fold``'s train rows."""
    targets = fold_trans.where((F.col("fold") == frozen_fold) & (F.col("role") == "train"))
    return target_popularity(targets.select("species_to"), catalogue)


def popularity_topk(fold_trans: DataFrame, catalogue: DataFrame, k: int = 10,
                    frozen_fold: int = 1, query_rows: DataFrame | None = None) -> DataFrame:
    """Top-K most popular species the observer has not seen in the source year -- M1."""
    pop = (frozen_popularity(fold_trans, catalogue, frozen_fold)
           .select("species", F.col("pop_rank").alias("pos"),
                   F.col("n_viewers").cast("double").alias("pop_score")))
    q = test_rows(fold_trans) if query_rows is None else query_rows
    cands = ranked_fillers(q, pop, k)
    # Rank among the unseen candidates = order of the global popularity rank.
    return top_k(cands, k, score="pop_score", order=[F.col("pos")])


def mean_count(fold_trans: DataFrame, totals: DataFrame | None = None, frozen_fold: int = 1) -> DataFrame:
    """Constant next-year count learned from fold ``frozen_fold`` -- A7.

    With ``totals`` (observer_id, year, total_observations) it is the mean total bird
    count of the training targets (0 for observers without a total); otherwise the
    mean size of the target species sets.
    """
    tr = fold_trans.where((F.col("fold") == frozen_fold) & (F.col("role") == "train"))
    if totals is None:
        return tr.agg(F.avg(F.size("species_to").cast("double")).alias("mean_count"))
    t = totals.select("observer_id", F.col("year").alias("year_to"), "total_observations")
    return (tr.join(t, ["observer_id", "year_to"], "left")
              .agg(F.avg(F.coalesce("total_observations", F.lit(0.0))).alias("mean_count")))


def mean_count_predict(fold_trans: DataFrame, totals: DataFrame | None = None,
                       frozen_fold: int = 1) -> DataFrame:
    """Every test row predicted the frozen mean -- M1b.  (fold, observer_id, predicted)."""
    m = mean_count(fold_trans, totals, frozen_fold)
    return (fold_trans.where(F.col("role") == "test").select(*KEY)
                      .withColumn("predicted", m.select("mean_count").scalar()))
