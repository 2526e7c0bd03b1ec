"""Year-over-year transition pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def transitions(summary: DataFrame, consecutive: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Pair each observer-year with the same observer's next *present* year.

    ``summary`` has one row per (observer_id, year) and a ``scientific_name`` set.
    One shuffle on ``observer_id``; after aggregation an observer holds at most one
    row per year, so even the most active observer is a handful of rows.
    ``consecutive=True`` keeps calendar-adjacent pairs only (J2).  ``by``: columns that keep several
    tables apart (regions), paired in the same shuffle.
    """
    w = Window.partitionBy("observer_id", *by).orderBy("year")
    t = (summary.select(*by, "observer_id", "year", "scientific_name")
         .withColumn("year_to", F.lead("year").over(w))
         .withColumn("species_to", F.lead("scientific_name").over(w))
         .where(F.col("year_to").isNotNull())
         .select(*by, "observer_id",
                 F.col("year").alias("year_from"),
                 F.col("year_to").cast("int").alias("year_to"),
                 F.col("scientific_name").alias("species_from"),
                 "species_to"))
    if consecutive:
        t = t.where(F.col("year_to") == F.col("year_from") + 1)
    return t


def transition_counts(trans: DataFrame) -> DataFrame:
    """Rows per distinct (year_from, year_to) -- A30 / O5."""
    return (trans.groupBy("year_from", "year_to")
                 .agg(F.count(F.lit(1)).alias("n_transitions")))
