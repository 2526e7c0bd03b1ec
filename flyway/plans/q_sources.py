"""Registered source / sink / region queries."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import oracle as O
from .pipeline import all_transitions, folded, observed, species_sets, summary
from .registry import cmp_ready, register
from ..operators.folds import years_for_fold
from ..operators.region import region_filter, region_share, region_transitions
from ..operators.summaries import observer_year_species, rename_summary, year_profile
from ..operators.transitions import transition_counts
from ..session import cut_lineage
from ..schema import OBSERVED_COLUMNS, RAW_COLUMNS, RAW_SCHEMA, require_columns
from ..sources import fixture as FX
from ..sources import scan as SC
from ..sources import sinks as SK

_TRANS_OUT = """observer_id, year_from, year_to, array_to_string(species_from, ',') AS species_from,
       array_to_string(species_to, ',') AS species_to"""
_YEAR_COUNTS = """
SELECT year, count(*) AS n_rows, count(DISTINCT observer_id) AS n_observers,
       count(DISTINCT scientific_name) AS n_species
FROM {src} GROUP BY year
"""


def _year_counts(df):
    return df.groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"),
                                  F.count_distinct("observer_id").alias("n_observers"),
                                  F.count_distinct("scientific_name").alias("n_species"))


@register("project_essential", O.with_(["obs_raw"], """
SELECT year, count(*) AS n_rows, count(DISTINCT checklist_id) AS n_checklists,
       count(DISTINCT county) AS n_counties, round(sum(latitude), 6) AS sum_latitude
FROM obs_raw GROUP BY year
"""))
def q_project_essential(spark, sf):
    raw = SC.project_essential(FX.raw_observations(spark, sf))
    return cmp_ready(raw.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("checklist_id").alias("n_checklists"),
        F.count_distinct("county").alias("n_counties"), F.sum("latitude").alias("sum_latitude")))


@register("filter_observed", O.with_(["obs_raw"], _YEAR_COUNTS.format(src="obs_raw WHERE species_observed")))
def q_filter_observed(spark, sf):
    return _year_counts(SC.filter_observed(FX.raw_observations(spark, sf)))


@register("scan_years", O.with_(["obs"], _YEAR_COUNTS.format(src="obs WHERE year IN (1996, 1997, 1998)")))
def q_scan_years(spark, sf):
    return _year_counts(SC.scan_years(FX.raw_observations(spark, sf), [1996, 1997, 1998]))


def _raw_folders(spark, sf, name, rows_per_file=100_000, where=None, first=(0, 100)):
    """The raw table as ``year=`` folders of several files each, in checklist order by file name.

    ``first``: the number and the rows of a year's first files, all others hold ``rows_per_file``.
    """
    path = SK.new_output_dir(spark, name)
    raw = FX.raw_observations(spark, sf)
    raw = raw if where is None else raw.where(where)
    order = ["checklist_id", "hours_of_day", "scientific_name", "species_observed"]
    # A row's place in its year: within its range partition, which is sorted before it is written, and the rows of
    # the ranges before.  Only one row per year and range is joined to find it.
    ranged = cut_lineage(raw.repartitionByRange("year", *order).sortWithinPartitions("year", *order).withColumns(
        {"range": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "raw-order")
    held = ranged.groupBy("year", "range").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("begin"))
    before = F.sum("n").over(Window.partitionBy("year").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    ahead = held.select("year", "range", (F.col("begin") - F.coalesce(before, F.lit(0))).alias("begin"))
    n, size = first
    filed = (ranged.join(F.broadcast(ahead), ["year", "range"]).withColumn("place", F.col("at") - F.col("begin"))
             .withColumn("file", F.when(F.col("place") < n * size, F.floor(F.col("place") / size))
                         .otherwise(n + F.floor((F.col("place") - n * size) / rows_per_file)))
             .drop("at", "begin", "range", "place"))
    # A union keeps its parts' order, so a year's first files come first by name, from a partition each.
    parts = [filed.where(F.col("file") == i).repartition(1).sortWithinPartitions("year", *order) for i in range(n)]
    parts.append(filed.where(F.col("file") >= n).repartitionByRange("year", "file").sortWithinPartitions("year", "file", *order))
    (reduce(DataFrame.unionByName, parts).drop("file")
        .write.option("maxRecordsPerFile", rows_per_file).partitionBy("year").parquet(path))
    return path


@register("scan_sample", O.with_(["obs_raw"], _YEAR_COUNTS.format(src="""(
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY checklist_id, hours_of_day,
                                       scientific_name, species_observed) AS rn
                 FROM obs_raw) WHERE rn <= 200 AND species_observed)""")))
def q_scan_sample(spark, sf):
    # The first two files of a year hold its first 200 rows.
    return _year_counts(SC.scan_sample(spark, _raw_folders(spark, sf, "sample", first=(2, 100)), 2))


@register("read_raw", O.with_(["obs"], _YEAR_COUNTS.format(src="obs WHERE year IN (1996, 1997)")))
def q_read_raw(spark, sf):
    raw = SC.read_raw(spark, _raw_folders(spark, sf, "raw"))
    return _year_counts(SC.scan_years(raw, [1996, 1997]))


@register("tolerant_scan", O.with_(["obs"], _YEAR_COUNTS.format(
    src="obs WHERE NOT (year = 1997 AND checklist_id % 3 = 0)")))
def q_tolerant_scan(spark, sf):
    # A third of 1997 lies in files that are no Parquet.
    lost = (F.col("year") == 1997) & (F.col("checklist_id") % 3 == 0)
    path = _raw_folders(spark, sf, "tolerant", where=~lost)
    (FX.raw_observations(spark, sf).where(lost).select(F.to_json(F.struct("*")).alias("value"))
        .write.mode("append").text(os.path.join(path, "year=1997")))
    return _year_counts(SC.scan_observed(SC.read_raw(spark, path, tolerant=True)))


@register("fold_load", O.with_(["folds", "obs"], """
SELECT f.fold, o.year, count(*) AS n_rows, count(DISTINCT o.observer_id) AS n_observers
FROM (SELECT DISTINCT fold, y FROM (SELECT fold, year_from AS y FROM folds UNION ALL SELECT fold, year_to FROM folds)) f
JOIN obs o ON o.year = f.y GROUP BY f.fold, o.year
"""))
def q_fold_load(spark, sf):
    """Each fold's raw rows, read from the folders of its years only."""
    d = folded(spark, sf)
    raw = SC.read_raw(spark, _raw_folders(spark, sf, "folds"))
    parts = [SC.scan_observed(SC.fold_years(raw, d.folds, f)).groupBy("year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("observer_id").alias("n_observers"))
        .select(F.lit(f).alias("fold"), "year", "n_rows", "n_observers") for f in range(1, d.n_folds + 1)]
    return reduce(DataFrame.unionByName, parts)


@register("require_columns", O.with_(["obs"], _YEAR_COUNTS.format(src="obs")))
def q_require_columns(spark, sf):
    raw = FX.raw_observations(spark, sf)
    require_columns(raw, RAW_COLUMNS, "raw observations")
    try:
        require_columns(raw.drop("state"), RAW_COLUMNS, "raw observations")
    except ValueError:
        return _year_counts(SC.scan_observed(raw))
    raise AssertionError("missing column not detected")


_INVENTORY = ", ".join(f"('{f.name}', '{f.dataType.simpleString()}')" for f in RAW_SCHEMA
                       if f.name in OBSERVED_COLUMNS)


@register("column_inventory", O.with_(["obs"], f"""
SELECT year, column_name, data_type,
       regexp_matches(column_name, 'state|county|lat|lon|location|region|country|locality') AS is_geographic,
       regexp_matches(column_name, 'date|time|day|hour|month|year') AS is_temporal,
       regexp_matches(column_name, 'effort|duration|distance|protocol') AS is_effort
FROM (SELECT DISTINCT year FROM obs), (VALUES {_INVENTORY}) v(column_name, data_type)
"""))
def q_column_inventory(spark, sf):
    return SC.column_inventory_df(observed(spark, sf))


@register("rename_summary", O.with_(["oys"], """
SELECT observer_id, year, array_to_string(species, ',') AS species FROM oys
"""))
def q_rename_summary(spark, sf):
    return cmp_ready(rename_summary(observer_year_species(observed(spark, sf))))


@register("year_profile", O.with_(["obs"], """
SELECT year, count(*) AS n_rows, count(DISTINCT observer_id) AS n_observers FROM obs GROUP BY year
"""))
def q_year_profile(spark, sf):
    return year_profile(observed(spark, sf))


@register("transition_counts", O.with_(["trans"], """
SELECT year_from, year_to, count(*) AS n_transitions FROM trans GROUP BY year_from, year_to
"""))
def q_transition_counts(spark, sf):
    return transition_counts(all_transitions(spark, sf))


@register("year_etl", O.with_(["oys"], """
SELECT observer_id, year, array_to_string(species, ',') AS scientific_name FROM oys
"""))
def q_year_etl(spark, sf):
    path = SK.new_output_dir(spark, "year_etl")
    o = observed(spark, sf)
    years = sorted(r["year"] for r in o.select("year").distinct().collect())
    SK.year_etl(o, path, years=years[:3])
    SK.year_etl(o, path, years=years[3:])                  # dynamic overwrite adds years
    SK.year_etl(o, path, years=years[2:3])                 # re-running one year replaces it
    back = spark.read.parquet(path)
    return cmp_ready(back.select("observer_id", F.col("year").cast("int"), "scientific_name"))


@register("summaries_union", O.with_(["summ"], """
SELECT year, count(*) AS n_observer_years, round(sum(total_observations), 6) AS total_observations,
       sum(len(scientific_name)) AS n_species_entries
FROM summ GROUP BY year
"""))
def q_summaries_union(spark, sf):
    base = SK.new_output_dir(spark, "summaries")
    # One write for all years, one folder each; the year column is kept inside the files.
    summary(spark, sf).withColumn("file_year", F.col("year")).write.partitionBy("file_year").parquet(base)
    years = [r["year"] for r in spark.read.parquet(base).select("year").distinct().collect()]
    paths = {y: os.path.join(base, f"file_year={y}") for y in [*years, max(years) + 1]}
    u = SC.read_summaries(spark, paths)                        # the last year is missing: warned, skipped
    return cmp_ready(u.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_observer_years"),
        F.sum("total_observations").alias("total_observations"),
        F.sum(F.size("scientific_name")).alias("n_species_entries")))


@register("summary_etl", O.with_(["trans"], f"SELECT {_TRANS_OUT} FROM trans"))
def q_summary_etl(spark, sf):
    out = SK.summary_etl(observed(spark, sf), SK.new_output_dir(spark, "summary_etl"))
    t = SK.read_transitions(spark, out["transitions"])
    return cmp_ready(t)


@register("years_for_fold", O.with_(["folds"], """
SELECT fold, array_to_string(list_sort(list_distinct(list(y))), ',') AS years FROM (
  SELECT fold, year_from AS y FROM folds UNION ALL SELECT fold, year_to AS y FROM folds)
GROUP BY fold
"""))
def q_years_for_fold(spark, sf):
    return cmp_ready(years_for_fold(folded(spark, sf).folds))


@register("region_filter", O.with_(["summ_region"], """
SELECT observer_id, year, array_to_string(state, ',') AS state,
       array_to_string(scientific_name, ',') AS scientific_name FROM summ_region
"""))
def q_region_filter(spark, sf):
    r = region_filter(summary(spark, sf), FX.region_states(spark, sf, "EUROPE"))
    return cmp_ready(r.select("observer_id", "year", "state", "scientific_name"))


@register("region_share", O.with_(["summ", "europe"], """
SELECT c.year, c.n_observers, c.n_kept, round(c.n_kept * 100.0 / c.n_observers, 6) AS pct_kept,
       coalesce(m.matched_states, '') AS matched_states
FROM (SELECT year, count(*) AS n_observers,
             count(*) FILTER (WHERE coalesce(len(list_intersect(list_transform(state, lambda x: trim(x)),
                              (SELECT list(state) FROM europe))) > 0, false)) AS n_kept
      FROM summ GROUP BY year) c
LEFT JOIN (SELECT year, array_to_string(list_sort(list_distinct(list(st))), ',') AS matched_states
           FROM (SELECT year, unnest(state) AS st FROM summ)
           WHERE trim(st) IN (SELECT state FROM europe) GROUP BY year) m USING (year)
"""))
def q_region_share(spark, sf):
    return cmp_ready(region_share(summary(spark, sf), FX.region_states(spark, sf, "EUROPE")))


@register("region_etl", O.with_(["trans_region"], f"SELECT {_TRANS_OUT} FROM trans_region"))
def q_region_etl(spark, sf):
    states = FX.region_states(spark, sf, "EUROPE")
    out = SK.new_output_dir(spark, "region_etl")
    s_path, t_path = os.path.join(out, "summary"), os.path.join(out, "transitions")
    SK.write_year_partitions(region_filter(summary(spark, sf), states), s_path)
    from ..operators.transitions import transitions
    transitions(spark.read.parquet(s_path)).write.mode("overwrite").parquet(t_path)
    return cmp_ready(SK.read_transitions(spark, t_path))


@register("region_transitions", O.with_(["trans_region"], f"SELECT {_TRANS_OUT} FROM trans_region"))
def q_region_transitions(spark, sf):
    s = summary(spark, sf)
    return cmp_ready(region_transitions(s, FX.region_states(spark, sf, "EUROPE")))
