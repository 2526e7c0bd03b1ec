"""Observation view over the TPC-H-like test tables.

The raw observation table of a real deployment is parquet partitioned by ``year``
(see ``flyway.sources.scan.read_raw``).  The test data is a star schema instead, so this
adapter derives the same 18 columns with one declarative join; Catalyst prunes the
columns of every input and pushes the ``species_observed`` predicate into the
``lineitem`` scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RAW_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 18 raw columns (``species_observed`` included), one row per line item."""
    li = table(spark, sf_dir, "lineitem")
    li = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_discount", "l_returnflag")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    s = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_nationkey", "s_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(p, li.l_partkey == p.p_partkey)
           .join(s, li.l_suppkey == s.s_suppkey)
           .join(n, s.s_nationkey == n.n_nationkey))
    return j.select(
        F.col("o_custkey").cast("bigint").alias("observer_id"),
        F.concat(F.col("p_brand"), F.lit("/"), F.col("p_type")).alias("scientific_name"),
        F.year("o_orderdate").cast("int").alias("year"),
        (F.col("l_returnflag") != F.lit("R")).alias("species_observed"),
        F.col("o_orderkey").cast("bigint").alias("checklist_id"),
        F.to_date("o_orderdate").alias("observation_date"),
        F.expr("nullif(l_quantity, CAST(1.0 AS DOUBLE))").alias("observation_count"),
        F.col("n_name").alias("state"),
        F.concat(F.col("n_name"), F.lit("-"),
                 (F.col("s_suppkey") % 4).cast("string")).alias("county"),
        F.col("s_suppkey").cast("bigint").alias("locality_id"),
        F.dayofyear("o_orderdate").cast("int").alias("day_of_year"),
        (F.col("l_linenumber") * F.lit(2.5).cast("double")).alias("hours_of_day"),
        (F.col("o_totalprice") / F.lit(100000.0).cast("double")).alias("effort_hours"),
        (F.expr("nullif(l_discount, CAST(0.0 AS DOUBLE))")
         * F.lit(100.0).cast("double")).alias("effort_distance_km"),
        (F.col("l_linenumber") * F.lit(15.0).cast("double")).alias("duration_minutes"),
        (F.col("p_size") % 5 + 1).cast("int").alias("number_observers"),
        (F.col("s_nationkey") * F.lit(2.0).cast("double")).alias("latitude"),
        (F.col("s_acctbal") / F.lit(100.0).cast("double")).alias("longitude"),
    ).select(*RAW_COLUMNS)


def region_states(spark: SparkSession, sf_dir: str, region: str = "EUROPE") -> DataFrame:
    """Nation names of one region -- the fixture's state allow-list, as a tiny table."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .where(F.col("r_name") == region)
             .select(F.col("n_name").alias("state")))
