"""Time-ordered cross-validation folds (M0, S9, P6, M0d).

A fold table is ``(fold, role, year_from, year_to)`` with role 'train' / 'test'.
Its size is bounded by (number of years)^2 x folds, so it is always safe to
broadcast; every fold is evaluated in the same job, as a column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Folds of one scenario (region, features) are numbered from a multiple of this: scenario * 100 + fold.
FOLDS_APART = 100

MODES = ("consecutive", "lexicographic", "ending_before")


def cv_folds(trans: DataFrame, n_folds: int = 4, mode: str = "consecutive", by: tuple[str, ...] = ()) -> DataFrame:
    """Fold f tests the (f+1)-th year pair and trains on the pairs before it.

    * ``consecutive`` (default): only calendar-adjacent pairs (the documented design).
    * ``lexicographic``: all adjacent-present pairs sorted as tuples, gaps included
      (what the original code does).
    * ``ending_before``: tests as ``consecutive``; trains on every pair, gaps
      included, whose target year is before the test's target year.
    Emits min(n_folds, #pairs - 1) folds, for each value of the columns ``by`` (regions).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    pairs_all = trans.select(*by, "year_from", "year_to").distinct()
    cons = pairs_all.where(F.col("year_to") == F.col("year_from") + 1)
    ranked_src = pairs_all if mode == "lexicographic" else cons
    # A tiny table (distinct year pairs): a global window is one small task.
    w = Window.partitionBy(*by).orderBy("year_from", "year_to")
    ranked = (ranked_src.withColumn("rn", F.row_number().over(w))
                        .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*by))))
    nf = F.least(F.lit(n_folds), F.col("n") - 1)
    test = (ranked.where((F.col("rn") >= 2) & (F.col("rn") - 1 <= nf))
                  .select(*by, (F.col("rn") - 1).cast("int").alias("fold"),
                          F.lit("test").alias("role"), "year_from", "year_to"))
    if mode == "ending_before":
        t = test.select(*[F.col(c).alias(f"_{c}") for c in by], "fold", F.col("year_to").alias("_test_to"))
        before = F.col("year_to") < F.col("_test_to")
        for c in by:
            before &= F.col(c) == F.col(f"_{c}")
        train = (pairs_all.join(F.broadcast(t), before)
                          .select(*by, "fold", F.lit("train").alias("role"), "year_from", "year_to"))
    else:
        train = (ranked.where(F.col("rn") <= nf)
                       .select(*by, F.explode(F.sequence(F.col("rn").cast("int"), nf.cast("int")))
                                .alias("fold"),
                               F.lit("train").alias("role"), "year_from", "year_to"))
    return train.unionByName(test)


def assign_folds(trans: DataFrame, folds: DataFrame) -> DataFrame:
    """Transitions with their (fold, role) -- the row predicate of P6 as a join.

    A transition may be in several folds (train of later folds), so this is a bag
    expansion by at most #folds.  ``folds`` is bounded by years^2 x folds: broadcast.
    """
    return trans.join(F.broadcast(folds), ["year_from", "year_to"])


def years_for_fold(folds: DataFrame) -> DataFrame:
    """Distinct years each fold touches (S9) -- drives partition pruning of raw loads."""
    return (folds.select("fold", F.explode(F.array("year_from", "year_to")).alias("year"))
                 .groupBy("fold").agg(F.array_sort(F.collect_set("year")).alias("years")))


def holdout_split(train_rows: DataFrame, seed: int = 42, max_rows: int = 1000,
                  fraction: float = 0.1, salt_buckets: int = 64) -> DataFrame:
    """Validation flag for min(max_rows, floor(n * fraction)) rows per fold (M0d).

    Deterministic and distributed: the rows with the smallest seeded hash of their
    key are validation.  The per-fold top-m is exact but split in two levels, so no
    task ever sorts a whole fold: first the top-m inside ``salt_buckets`` hash
    buckets of the fold, then the top-m of those (<= buckets x m rows).
    """
    key_hash = F.md5(F.concat_ws(":", F.lit(seed), "observer_id", "year_from", "year_to").cast("binary"))
    rows = train_rows.withColumn("_h", key_hash)          # the same hash in any engine
    sizes = (rows.groupBy("fold").agg(F.count(F.lit(1)).alias("_n"))
                 .select("fold", F.least(F.lit(max_rows),
                                         F.floor(F.col("_n") * fraction)).alias("_m")))
    keys = rows.select("fold", "_h", "observer_id", "year_from", "year_to")
    order = ["_h", "observer_id", "year_from", "year_to"]
    w1 = Window.partitionBy("fold", F.pmod(F.crc32("_h"), F.lit(salt_buckets))).orderBy(*order)
    stage1 = (keys.withColumn("_r1", F.row_number().over(w1))
                  .where(F.col("_r1") <= max_rows).drop("_r1"))
    w2 = Window.partitionBy("fold").orderBy(*order)
    chosen = (stage1.withColumn("_r2", F.row_number().over(w2))
                    .join(F.broadcast(sizes), "fold")
                    .where(F.col("_r2") <= F.col("_m"))
                    .select("fold", "observer_id", "year_from", "year_to",
                            F.lit(True).alias("is_validation")))
    return (rows.drop("_h")
                .join(chosen, ["fold", "observer_id", "year_from", "year_to"], "left")
                .withColumn("is_validation", F.coalesce("is_validation", F.lit(False))))
