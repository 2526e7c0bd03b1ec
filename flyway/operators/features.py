"""Observer-year features.

All features are computed once per (observer_id, year) -- never per transition -- and attached
to transitions by key joins.  The raw rows are shuffled once, by (observer, year) and with the needed
columns only, and every feature, temporal or geographic, is aggregated in the same tasks.
Statistics follow the reference's conventions:
nulls are skipped, sample std dev is 0 for <= 1 value, effort and duration are per observation
row (a checklist with 30 species counts 30 times).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import exact_quantiles
from ..functions import month_of, set_mean, set_std_pop, set_sum

KEY = ["observer_id", "year"]
TKEY = ["observer_id", "year_from", "year_to"]

TEMPORAL_COLUMNS = (
    ["num_checklists", "num_species", "total_observations", "avg_observations_per_checklist",
     "max_observations_per_checklist", "doy_mean", "doy_std", "doy_min", "doy_max", "doy_range",
     "hod_mean", "hod_std", "hod_min", "hod_max"]
    + [f"month_{m}_freq" for m in range(1, 13)]
    + ["effort_mean", "effort_total", "effort_max", "effort_std",
       "duration_mean", "duration_total", "duration_max", "duration_std",
       "checklists_per_month", "num_locations", "num_states",
       "avg_day_of_year", "avg_hours_of_day", "avg_effort_hours", "avg_duration"])

GEO_METRICS = ["state_diversity", "num_states", "num_counties", "num_localities", "geographic_spread"]

# Model feature subsets (P9); num_species is left out on purpose.
RAW_MODEL_FEATURES = [
    "num_checklists", "total_observations", "avg_observations_per_checklist",
    "avg_day_of_year", "doy_std", "doy_range",
    "avg_hours_of_day", "hod_std",
    "avg_effort_hours", "effort_total", "effort_max", "effort_std",
    "avg_duration", "duration_total", "duration_max", "duration_std",
    "checklists_per_month", "num_locations", "num_states",
] + [f"month_{m}_freq" for m in range(1, 13)]
SUMMARY_MODEL_FEATURES = [
    "num_checklists", "total_observations", "avg_observations_per_checklist",
    "avg_effort_hours", "effort_total", "effort_max", "effort_std",
    "avg_duration", "duration_total", "duration_max", "duration_std",
    "checklists_per_month", "num_locations", "num_states",
]


PLACE = ["locality_id", "state", "county"]
TEMPORAL_VALUES = ["day_of_year", "hours_of_day", "effort_hours", "duration_minutes"]
GEO_VALUES = ["latitude", "longitude"]
SPREAD = 4                 # parts of the raw rows for each shuffle partition of the session


def observer_rows(obs: DataFrame, temporal: bool = True, geo: bool = True) -> DataFrame:
    """The columns that features need, all rows of an observer-year in one task.

    The one shuffle of the raw rows: they travel narrow, before any moment is made of them.  ``SPREAD`` parts
    for each one that the session asks for keep a task small; AQE merges no parts whose number is given.
    """
    parts = SPREAD * int(obs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = ["scientific_name", "observation_count", *TEMPORAL_VALUES] * temporal + GEO_VALUES * geo
    month = [month_of("observation_date").cast("tinyint").alias("_month")] * temporal
    return (obs.where(F.col("observer_id").isNotNull() & F.col("year").isNotNull())
            .select(*KEY, *[c for c in PLACE if geo or c != "county"], *own, *month).repartition(parts, *KEY))


def observer_year_features(obs: DataFrame, temporal: bool = True, geo: bool = True) -> DataFrame:
    """One row per (observer_id, year): A10 with A11 (temporal), A12 (geo), from one pass over its rows.

    Rows are shuffled once (``observer_rows``) and aggregated where they lie.  The buffer of an
    observer-year holds its distinct places and species, as the summary's does, and no rows: these are sorted
    and spill.  The state entropy alone needs the rows of a state side by side, a window in the same task.
    """
    rows = observer_rows(obs, temporal, geo)

    def distinct(c):
        return F.size(F.collect_set(c)).cast("bigint")

    def deviation(v):
        return F.when(F.count(v) > 1, F.stddev_samp(v)).otherwise(F.lit(0.0))

    def total(v):
        return F.coalesce(F.sum(v), F.lit(0.0))

    def most(v):
        return F.coalesce(F.max(v), F.lit(0.0))

    if geo:
        peers = Window.partitionBy(*KEY).orderBy("state")
        rows = rows.withColumns({
            "n_in_state": F.count("state").over(peers.rangeBetween(Window.currentRow, Window.currentRow)),
            "n_states": F.count("state").over(peers.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    n_loc = distinct("locality_id")
    out = {"num_states": distinct("state")}
    if temporal:
        months = F.nullif(F.count("_month"), F.lit(0))
        out |= {"num_checklists": n_loc, "num_locations": n_loc, "num_species": distinct("scientific_name"),
                "total_observations": total("observation_count"),
                "avg_observations_per_checklist": F.when(
                    n_loc > 0, total("observation_count") / F.nullif(n_loc, F.lit(0))).otherwise(F.lit(0.0)),
                "max_observations_per_checklist": most("observation_count"),
                "checklists_per_month": n_loc / F.lit(12.0)}
        for short, v in (("doy", "day_of_year"), ("hod", "hours_of_day")):
            out |= {f"{short}_mean": F.avg(v), f"{short}_std": deviation(v), f"{short}_min": F.min(v).cast("double"),
                    f"{short}_max": F.max(v).cast("double")}
        out["doy_range"] = F.coalesce(F.max("day_of_year") - F.min("day_of_year"), F.lit(0)).cast("double")
        out |= {f"month_{m}_freq": F.coalesce(F.count(F.when(F.col("_month") == m, 1)) / months, F.lit(0.0))
                for m in range(1, 13)}
        for short, v in (("effort", "effort_hours"), ("duration", "duration_minutes")):
            out |= {f"{short}_mean": F.avg(v), f"{short}_total": total(v), f"{short}_max": most(v), f"{short}_std": deviation(v)}
        for c, v in (("avg_day_of_year", "day_of_year"), ("avg_hours_of_day", "hours_of_day"),
                     ("avg_effort_hours", "effort_hours"), ("avg_duration", "duration_minutes")):
            out[c] = F.avg(v)
    if geo:
        # -sum p log p over the states, dealt out over their rows: each has 1/n of it
        entropy = F.sum(F.when(F.col("state").isNotNull(),
                               -F.log(F.col("n_in_state") / F.col("n_states") + F.lit(1e-10)) / F.col("n_states")))
        out |= {"top_state": F.mode("state", True), "top_county": F.mode("county", True),     # ties: the smallest
                "state_diversity": F.coalesce(entropy, F.lit(0.0)),
                "num_counties": distinct("county"), "num_localities": n_loc,
                "geographic_spread": F.when((F.count("latitude") > 0) & (F.count("longitude") > 0),
                                            deviation("latitude") + deviation("longitude")).otherwise(F.lit(0.0))}
    return rows.groupBy(*KEY).agg(*[c.alias(k) for k, c in out.items()])


def temporal_features(obs: DataFrame) -> DataFrame:
    """One row per (observer_id, year) -- A10 (+ A11 month shares)."""
    return observer_year_features(obs, geo=False).select(*KEY, *TEMPORAL_COLUMNS)


def geo_features(obs: DataFrame) -> DataFrame:
    """One row per (observer_id, year) -- A12: top state/county, entropy, counts, spread."""
    return observer_year_features(obs, temporal=False).select(*KEY, "top_state", "top_county", *GEO_METRICS)


def geo_dictionary(obs: DataFrame, col: str = "state", years: DataFrame | None = None) -> DataFrame:
    """Sorted distinct values of ``col`` (over some years) with their index -- A14."""
    src = obs if years is None else obs.join(F.broadcast(years), "year", "left_semi")
    vals = src.where(F.col(col).isNotNull()).select(col).distinct()
    return vals.select(col, (F.row_number().over(Window.orderBy(col)) - 1).cast("int").alias(f"{col}_idx"))


def state_onehot(geo: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Index of the most common state in the sorted dictionary (the hot position) -- A13.

    The one-hot vector itself is ``OneHotEncoder(dropLast=False)`` on this index at
    the ML boundary; a dictionary miss gives no hot position (NULL).
    """
    d = dictionary.withColumnRenamed("state", "top_state")
    return geo.select(*KEY, "top_state").join(F.broadcast(d), "top_state", "left")


def temporal_from_summary(summary: DataFrame) -> DataFrame:
    """Temporal features from the set-valued summary -- A15 (always computed)."""
    n_loc = F.size("locality_id")
    total = F.coalesce(F.col("total_observations"), F.lit(0.0))
    eff, dur = F.col("effort_hours"), F.col("duration_minutes")
    cols = [
        F.size("scientific_name").cast("bigint").alias("num_species"),
        n_loc.cast("bigint").alias("num_checklists"),
        total.alias("total_observations"),
        F.when(n_loc > 0, total / n_loc).otherwise(F.lit(0.0)).alias("avg_observations_per_checklist"),
        set_mean(eff).alias("effort_mean"), set_sum(eff).alias("effort_total"),
        F.coalesce(F.array_max(eff), F.lit(0.0)).alias("effort_max"),
        set_std_pop(eff).alias("effort_std"),
        set_mean(dur).alias("duration_mean"), set_sum(dur).alias("duration_total"),
        F.coalesce(F.array_max(dur), F.lit(0.0)).alias("duration_max"),
        set_std_pop(dur).alias("duration_std"),
        (n_loc / F.lit(12.0)).alias("checklists_per_month"),
        n_loc.cast("bigint").alias("num_locations"),
        F.size("state").cast("bigint").alias("num_states"),
    ]
    out = summary.select(*KEY, *cols)
    out = out.withColumn("avg_effort_hours", F.col("effort_mean")).withColumn("avg_duration", F.col("duration_mean"))
    for c in ["avg_day_of_year", "doy_std", "doy_range", "avg_hours_of_day", "hod_std"] + \
             [f"month_{m}_freq" for m in range(1, 13)]:
        out = out.withColumn(c, F.lit(0.0))
    return out


def geo_from_summary(summary: DataFrame) -> DataFrame:
    """Geographic features from the set-valued summary -- A16.

    ``state_diversity`` = entropy of a uniform choice over the state set, -ln(1/n + 1e-10);
    ``state_diversity_literal`` keeps the original's scalar slip, -(1/n) ln(1/n + 1e-10).
    The 'most common' state of a set is its smallest element (deterministic).
    """
    n = F.size("state").cast("double")
    p = F.lit(1.0) / n
    return summary.select(
        *KEY,
        F.array_min("state").alias("top_state"),
        F.array_min("county").alias("top_county"),
        F.when(n > 0, -F.log(p + F.lit(1e-10))).otherwise(F.lit(0.0)).alias("state_diversity"),
        F.when(n > 0, -p * F.log(p + F.lit(1e-10))).otherwise(F.lit(0.0)).alias("state_diversity_literal"),
        F.size("state").cast("bigint").alias("num_states"),
        F.size("county").cast("bigint").alias("num_counties"),
        F.size("locality_id").cast("bigint").alias("num_localities"),
        F.size("locality_id").cast("double").alias("geographic_spread"))


def lookup(trans: DataFrame, per_year: DataFrame, how: str = "inner", year_col: str = "year_from",
           fill_zero: bool = False) -> DataFrame:
    """Attach observer-year rows to transitions by key -- J3 (inner), J4/J6 (left, 0-fill), J5."""
    f = per_year.withColumnRenamed("year", year_col)
    out = trans.join(f, ["observer_id", year_col], how)
    if fill_zero:
        num = [c for c, t in f.dtypes if c not in ("observer_id", year_col)
               and t in ("double", "bigint", "int", "float")]
        out = out.na.fill(0, [c for c in num if dict(f.dtypes)[c] != "double"]) \
                 .na.fill(0.0, [c for c in num if dict(f.dtypes)[c] == "double"])
    return out


def bird_counts(trans: DataFrame, summary: DataFrame) -> DataFrame:
    """Next-year total bird count per transition, 0 when the observer has none -- J7."""
    s = summary.select("observer_id", F.col("year").alias("year_to"), "total_observations")
    return (trans.join(s, ["observer_id", "year_to"], "left")
                 .withColumn("bird_count", F.coalesce("total_observations", F.lit(0.0)))
                 .drop("total_observations"))


def simple_features(trans: DataFrame) -> DataFrame:
    """Fallback features: source-set size and year_from / 2023 -- F10."""
    return trans.select(*[c for c in trans.columns if c in ("fold", "role")], *TKEY,
                        F.size("species_from").cast("double").alias("num_species"),
                        (F.col("year_from") / F.lit(2023.0)).alias("year"))


def impute_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    """NaN / NULL feature -> 0.0 -- P13."""
    return df.select(*[F.coalesce(F.nanvl(F.col(c), F.lit(0.0)), F.lit(0.0)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def feature_subset(df: DataFrame, wanted: list[str]) -> list[str]:
    """The wanted feature columns that exist, in order -- P9."""
    return [c for c in wanted if c in df.columns]


def to_long(df: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """Wide features -> (keys..., feature, value DOUBLE)."""
    casted = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in features])
    return casted.unpivot(keys, features, "feature", "value")


def robust_scale(long: DataFrame, group: list[str] | None = None) -> DataFrame:
    """(x - median) / IQR fitted on the training rows, applied to all -- A17.

    ``long`` has (*group, role, ..., feature, value).  Exact quantiles (linear interpolation) per
    (*group, feature) over the train rows; scale 1 when the IQR is 0.  The fitted table
    (groups x features rows) is joined back by key.
    """
    g = [*(group or []), "feature"]
    q = exact_quantiles(long.where(F.col("role") == "train"), g, "value", [0.25, 0.5, 0.75])
    iqr = F.col("quantiles")[2] - F.col("quantiles")[0]
    fit = q.select(*g, F.col("quantiles")[1].alias("center"), F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias("scale"))
    return (long.join(fit, g, "left")
                .withColumn("scaled", (F.col("value") - F.col("center")) / F.col("scale")))
