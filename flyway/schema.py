"""Explicit schemas of the three persistent tables and the required-column check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed column list of the raw observation table (18 columns).
RAW_COLUMNS = [
    "observer_id", "scientific_name", "year", "species_observed", "checklist_id",
    "observation_date", "observation_count", "state", "day_of_year", "hours_of_day",
    "effort_hours", "effort_distance_km", "duration_minutes", "number_observers",
    "locality_id", "county", "latitude", "longitude",
]

RAW_SCHEMA = T.StructType([
    T.StructField("observer_id", T.LongType()),
    T.StructField("scientific_name", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("species_observed", T.BooleanType()),
    T.StructField("checklist_id", T.LongType()),
    T.StructField("observation_date", T.DateType()),
    T.StructField("observation_count", T.DoubleType()),
    T.StructField("state", T.StringType()),
    T.StructField("day_of_year", T.IntegerType()),
    T.StructField("hours_of_day", T.DoubleType()),
    T.StructField("effort_hours", T.DoubleType()),
    T.StructField("effort_distance_km", T.DoubleType()),
    T.StructField("duration_minutes", T.DoubleType()),
    T.StructField("number_observers", T.IntegerType()),
    T.StructField("locality_id", T.LongType()),
    T.StructField("county", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

OBSERVED_COLUMNS = [c for c in RAW_COLUMNS if c != "species_observed"]

SUMMARY_SCHEMA = T.StructType([
    T.StructField("observer_id", T.LongType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("scientific_name", T.ArrayType(T.StringType())),
    T.StructField("state", T.ArrayType(T.StringType())),
    T.StructField("county", T.ArrayType(T.StringType())),
    T.StructField("locality_id", T.ArrayType(T.LongType())),
    T.StructField("effort_hours", T.ArrayType(T.DoubleType())),
    T.StructField("effort_distance_km", T.ArrayType(T.DoubleType())),
    T.StructField("duration_minutes", T.ArrayType(T.DoubleType())),
    T.StructField("number_observers", T.ArrayType(T.IntegerType())),
    T.StructField("total_observations", T.DoubleType()),
])

TRANSITION_SCHEMA = T.StructType([
    T.StructField("observer_id", T.LongType()),
    T.StructField("year_from", T.IntegerType()),
    T.StructField("year_to", T.IntegerType()),
    T.StructField("species_from", T.ArrayType(T.StringType())),
    T.StructField("species_to", T.ArrayType(T.StringType())),
])


def require_columns(df: DataFrame, required: list[str], what: str = "input") -> DataFrame:
    """Fail loudly when a required column is missing (schema only, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(
            f"{what}: missing required columns {missing}; available: {sorted(df.columns)}")
    return df
