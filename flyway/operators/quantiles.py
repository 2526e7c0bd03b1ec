"""Exact quantiles per group as distributed order statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def exact_quantiles(df: DataFrame, group: list[str], value: str, probabilities: list[float]) -> DataFrame:
    """(*group, quantiles ARRAY): linear interpolation between the two nearest ranks, nulls skipped.

    Equal values are counted first; the counts are range-sorted by (*group, value), so a group is
    spread over as many tasks as its size asks for.  A value's ranks follow from the counts before it in
    its range and those of the ranges before, carried in; only the values that hold a
    wanted rank go on.  No task and no buffer holds a whole group.  ``group`` columns are not null.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).cast("double").alias("v")) \
        .agg(F.count(F.lit(1)).alias("n"))
    ranged = cut_lineage(counts.repartitionByRange(*group, "v").withColumn("range", F.spark_partition_id()),
                         "quantile-counts")
    parts = ranged.groupBy(*group, "range").agg(F.sum("n").alias("held"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*group, "range", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("carried"),
                         F.sum("held").over(whole).alias("total"))
    upto = F.sum("n").over(Window.partitionBy(*group, "range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    run = ranged.withColumn("upto", upto).join(parts, [*group, "range"]).withColumn("end", F.col("upto") + F.col("carried"))

    def holds(rank):
        return (rank < F.col("end")) & (rank >= F.col("end") - F.col("n"))

    at = [(F.col("total") - 1) * F.lit(float(p)) for p in probabilities]
    wanted = [(holds(F.floor(x)), holds(F.ceil(x))) for x in at]
    some = F.lit(False)
    for low, high in wanted:
        some = some | low | high
    # 1 row holds several ranks where a value is frequent: at most 2 rows per probability are left.
    picked = run.where(some).groupBy(*group).agg(
        *[F.max(F.when(c, F.col("v"))).alias(f"{side}{i}") for i, pair in enumerate(wanted)
          for side, c in zip(("low", "high"), pair)],
        *[F.first(x - F.floor(x)).alias(f"part{i}") for i, x in enumerate(at)])
    return picked.select(*group, F.array(*[
        F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * F.col(f"part{i}")
        for i in range(len(probabilities))]).alias("quantiles"))
