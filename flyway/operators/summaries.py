"""Observer-year aggregates of the raw observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["observer_id", "year"]

# Set-valued columns of the rich summary, in output order.
SET_COLUMNS = ["scientific_name", "state", "county", "locality_id", "effort_hours",
               "effort_distance_km", "duration_minutes", "number_observers"]


def _keyed(obs: DataFrame) -> DataFrame:
    # pandas groupby drops rows whose key is null; so do we.
    return obs.where(F.col("observer_id").isNotNull() & F.col("year").isNotNull())


def observer_year_species(obs: DataFrame) -> DataFrame:
    """(observer_id, year, scientific_name: sorted distinct species) -- A1.

    ``collect_set`` aggregates partially on the map side, so a very active
    observer ships at most one set per map task (bounded by the species count).
    """
    return (_keyed(obs).groupBy(*KEY)
            .agg(F.array_sort(F.collect_set("scientific_name")).alias("scientific_name")))


def observer_year_summary(obs: DataFrame) -> DataFrame:
    """A1 plus the distinct sets of the context columns and the total count -- A2."""
    aggs = [F.array_sort(F.collect_set(c)).alias(c) for c in SET_COLUMNS]
    aggs.append(F.coalesce(F.sum("observation_count"), F.lit(0.0)).alias("total_observations"))
    return _keyed(obs).groupBy(*KEY).agg(*aggs)


def year_profile(obs: DataFrame) -> DataFrame:
    """Rows and distinct observers per year -- A31."""
    return obs.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("observer_id").alias("n_observers"))


def rename_summary(species_by_year: DataFrame, year: int | None = None) -> DataFrame:
    """Give a per-year species frame its output column names; add a literal year -- P3."""
    df = species_by_year
    if year is not None:
        df = df.withColumn("year", F.lit(int(year)).cast("int"))
    return df.withColumnRenamed("scientific_name", "species").select("observer_id", "year", "species")
