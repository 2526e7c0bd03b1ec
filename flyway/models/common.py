"""Shared pieces of the recommenders: test rows, ranking, filler candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["fold", "observer_id"]
PRED_COLUMNS = ["fold", "observer_id", "species", "score", "rank"]


def test_rows(fold_trans: DataFrame) -> DataFrame:
    """Compact test rows, hash-partitioned by the ranking key *before* any explode.

    Later windows on (fold, observer_id) then reuse this partitioning: the one
    shuffle moves a row per observer, not its exploded candidates.
    """
    return (fold_trans.where(F.col("role") == "test")
                      .select(*KEY, "species_from", "species_to")
                      .repartition(*KEY))


def train_rows(fold_trans: DataFrame) -> DataFrame:
    return (fold_trans.where(F.col("role") == "train")
                      .select("fold", "observer_id", "year_from", "year_to",
                              "species_from", "species_to"))


def top_k(cands: DataFrame, k: int | str, score: str = "score", order=None) -> DataFrame:
    """Keep the K best candidates per test key: score desc (rounded to 9 places so
    float summation order cannot flip ties), species asc -- W2 / O4.

    ``k`` is an int or the name of a per-row K column (W7); ``order`` overrides
    the ordering expressions.
    """
    order = order or [F.desc(F.round(score, 9)), F.col("species")]
    w = Window.partitionBy(*KEY).orderBy(*order)
    kk = F.lit(k) if isinstance(k, int) else F.col(k)
    return (cands.withColumn("rank", F.row_number().over(w))
                 .where(F.col("rank") <= kk)
                 .select(*KEY, "species", F.col(score).cast("double").alias("score"),
                         F.col("rank").cast("int").alias("rank")))


def ranked_fillers(test: DataFrame, ranking: DataFrame, extra: int | str) -> DataFrame:
    """Per test row, the first ``extra + size(species_from)`` species of a global ranking.

    ``ranking`` has (species, pos, ...) with pos = 1..S (catalogue-bounded).  The
    expansion is an *equi*-join on the position: each row explodes the positions it
    may need, and at most size(species_from) of them are already seen, so the first
    ``extra`` unseen species of the ranking are always among them.  No nested loop.
    """
    ex = F.lit(extra) if isinstance(extra, int) else F.col(extra)
    pos = test.select(*test.columns,
                      F.explode(F.sequence(F.lit(1), ex + F.size("species_from"))).alias("pos"))
    return (pos.join(F.broadcast(ranking), "pos")
               .where(~F.array_contains("species_from", F.col("species"))))
