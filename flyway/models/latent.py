"""Latent-factor recommender (M5): implicit-feedback ALS from MLlib.

The documented matrix-factorisation model, re-expressed as
``ALS(implicitPrefs=True)`` (``nonnegative`` tends to one popularity-like factor).  Per fold (a bounded loop over
<= n_folds fits -- MLlib fits one model per call), observers are users and
species items; interactions are the fold's training sets (from U to) plus the
test rows' *source* sets, which are known at prediction time.  Recommendations
come from ``recommendForUserSubset`` (blocked top-k inside MLlib), then the
already-seen species are removed and the top K kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, cut_lineage
from .common import KEY, top_k

def dense_users(fold_trans: DataFrame, parts: int = 1024) -> DataFrame:
    """(observer_id, user): observers numbered from 0, as ALS needs ints whatever the ids.

    Numbered within hash parts and shifted by the sizes of the parts before, so no
    task holds all observers; ``parts`` rows are counted in one.
    """
    ids = cut_lineage(fold_trans.select("observer_id").distinct()
                      .withColumn("part", F.pmod(F.xxhash64("observer_id"), F.lit(parts))), "als-observers")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = ids.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("observer_id")) - 1
    return ids.join(shift, "part").select("observer_id", (F.col("shift") + place).cast("int").alias("user"))


def latent_topk(fold_trans: DataFrame, k: int = 10, rank: int = 16, max_iter: int = 10,
                reg_param: float = 0.01, alpha: float = 1.0, seed: int = 42,
                nonnegative: bool = False) -> DataFrame:
    spark = fold_trans.sparkSession
    checkpoint_dir(spark)   # ALS checkpoints its factor lineage every few iterations
    cat = (fold_trans.select(F.explode(F.array_union("species_from", "species_to")).alias("species"))
                     .distinct())
    items = cat.select("species", (F.row_number().over(Window.orderBy("species")) - 1)
                       .cast("int").alias("item"))          # S rows
    users = cut_lineage(dense_users(fold_trans), "als-users")
    folds = [r[0] for r in fold_trans.select("fold").distinct().orderBy("fold").collect()]
    out = []
    for f in folds:
        ft = fold_trans.where(F.col("fold") == f)
        train = ft.where(F.col("role") == "train").select(
            "observer_id", F.explode(F.array_union("species_from", "species_to")).alias("species"))
        test = ft.where(F.col("role") == "test")
        hist = test.select("observer_id", F.explode("species_from").alias("species"))
        inter = (train.unionByName(hist).distinct()
                      .join(items, "species").join(users, "observer_id")
                      .select("user", "item", F.lit(1.0).alias("rating")))
        als = ALS(rank=rank, maxIter=max_iter, regParam=reg_param, alpha=alpha, implicitPrefs=True,
                  nonnegative=nonnegative, seed=seed, userCol="user", itemCol="item", ratingCol="rating",
                  coldStartStrategy="drop", checkpointInterval=5)
        model = als.fit(cut_lineage(inter))
        # Observers in classes of doubling set size: a heavy one does not lengthen all lists.
        asked = test.join(users, "observer_id").select(
            "user", F.ceil(F.log2(F.size("species_from") + 1.0)).cast("int").alias("c"))
        classes = sorted(r["c"] for r in asked.select("c").distinct().collect())
        recs = reduce(DataFrame.unionByName, [
            model.recommendForUserSubset(asked.where(F.col("c") == c).select("user"), k + 2 ** c)
            for c in classes])
        recs = (recs.select("user", F.explode("recommendations").alias("r"))
                .select("user", F.col("r.item").alias("item"), F.col("r.rating").alias("score"))
                .join(users, "user"))
        cands = (recs.join(items, "item")
                     .join(test.select("observer_id", "species_from"), "observer_id")
                     .where(~F.array_contains("species_from", F.col("species")))
                     .select(F.lit(f).cast("int").alias("fold"), "observer_id", "species", "score"))
        out.append(cands)
    return top_k(reduce(DataFrame.unionByName, out), k)
