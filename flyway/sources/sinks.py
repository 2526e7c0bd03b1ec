"""Sinks and the persisted ETL jobs.

Every intermediate that later jobs reuse is *written* (parquet, partitioned by
year) rather than cached: a written table survives executor loss and cuts the
lineage for the downstream jobs.
"""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.summaries import observer_year_species, observer_year_summary
from ..operators.transitions import transitions
from ..schema import TRANSITION_SCHEMA
from ..session import scratch_path


def new_output_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never reused)."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def write_year_partitions(df: DataFrame, path: str) -> str:
    """Snappy parquet partitioned by year; re-running a year replaces only that year."""
    (df.write.mode("overwrite")
       .option("compression", "snappy")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy("year").parquet(path))
    return path


def year_etl(obs: DataFrame, path: str, years: list[int] | None = None) -> str:
    """Per-year job: observed rows -> observer-year species sets -> year partitions."""
    src = obs if years is None else obs.where(F.col("year").isin(list(years)))
    return write_year_partitions(observer_year_species(src), path)


def summary_etl(obs: DataFrame, out_dir: str) -> dict[str, str]:
    """Whole extraction: rich summary and transitions, each persisted.

    The transitions are computed from the *written* summary, so the second sink
    does not recompute the raw scan.
    """
    spark = obs.sparkSession
    s_path = os.path.join(out_dir, "observer_year_summary")
    t_path = os.path.join(out_dir, "transitions")
    write_year_partitions(observer_year_summary(obs), s_path)
    summ = spark.read.parquet(s_path)
    (transitions(summ).write.mode("overwrite").option("compression", "snappy").parquet(t_path))
    return {"summary": s_path, "transitions": t_path}


def union_year_tables(spark: SparkSession, path: str) -> DataFrame:
    """The ``year=`` folders under ``path`` as one table, a pruned read of each year there is."""
    whole = spark.read.parquet(path)
    years = sorted(r["year"] for r in whole.select("year").distinct().collect())   # partition values
    if not years:
        return whole
    return reduce(DataFrame.unionByName, [whole.where(F.col("year") == y) for y in years])


def read_transitions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRANSITION_SCHEMA).parquet(path)


def write_report_text(lines: DataFrame, path: str) -> str:
    """One text line per row (column ``line``)."""
    lines.select("line").coalesce(1).write.mode("overwrite").text(path)
    return path


def write_metrics_json(metrics: DataFrame, path: str) -> str:
    """The long metric table as JSON lines."""
    metrics.write.mode("overwrite").json(path)
    return path
