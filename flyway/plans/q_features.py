"""Registered feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import oracle as O
from .pipeline import folded, observed, summary
from .registry import cmp_ready, register
from ..operators import features as FE
from ..operators import onehot as OH
from ..operators.species import fold_species_features
from ..session import cut_lineage

_NUM_SETS = ["effort_hours", "effort_distance_km", "duration_minutes"]


def _summary_cmp(df):
    """Numeric (double) sets as size + rounded sum; string / integer sets joined."""
    cols = ["observer_id", "year"]
    out = []
    for c in df.columns:
        if c in _NUM_SETS:
            out += [F.size(c).alias(f"{c}_n"),
                    F.aggregate(c, F.lit(0.0), lambda a, x: a + x).alias(f"{c}_sum")]
        elif c not in cols:
            out.append(F.col(c))
    return cmp_ready(df.select(*cols, *out))


def _summary_sql_cols() -> str:
    parts = ["observer_id", "year",
             "array_to_string(scientific_name, ',') AS scientific_name",
             "array_to_string(state, ',') AS state", "array_to_string(county, ',') AS county",
             "array_to_string(locality_id, ',') AS locality_id",
             "array_to_string(number_observers, ',') AS number_observers",
             "round(total_observations, 6) AS total_observations"]
    for c in _NUM_SETS:
        parts += [f"CAST(len({c}) AS INTEGER) AS {c}_n",
                  f"round(coalesce(list_sum({c}), 0.0), 6) AS {c}_sum"]
    return ", ".join(parts)


@register("observer_year_summary", O.with_(["summ"], f"SELECT {_summary_sql_cols()} FROM summ"))
def q_observer_year_summary(spark, sf):
    return _summary_cmp(summary(spark, sf))


def _round_all(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


_TF_DOUBLE = [c for c in FE.TEMPORAL_COLUMNS
              if c not in ("num_checklists", "num_species", "num_locations", "num_states")]
_TF_INT = ["num_checklists", "num_species", "num_locations", "num_states"]


@register("temporal_features", O.with_(["tf"], f"""
SELECT observer_id, year, {", ".join(_TF_INT)}, {_round_all(_TF_DOUBLE)} FROM tf
"""))
def q_temporal_features(spark, sf):
    return cmp_ready(FE.temporal_features(observed(spark, sf)))


@register("month_freq", O.with_(["tf"], f"""
SELECT observer_id, year, {_round_all([f"month_{m}_freq" for m in range(1, 13)])} FROM tf
"""))
def q_month_freq(spark, sf):
    tf = FE.temporal_features(observed(spark, sf))
    return cmp_ready(tf.select("observer_id", "year", *[f"month_{m}_freq" for m in range(1, 13)]))


_GF_COLS = "observer_id, year, top_state, top_county, round(state_diversity, 6) AS state_diversity, " \
           "num_states, num_counties, num_localities, round(geographic_spread, 6) AS geographic_spread"


@register("geo_features", O.with_(["gf"], f"SELECT {_GF_COLS} FROM gf"))
def q_geo_features(spark, sf):
    return cmp_ready(FE.geo_features(observed(spark, sf)))


@register("geo_dictionaries", O.with_(["obs"], """
SELECT 'state' AS kind, state AS value, CAST(row_number() OVER (ORDER BY state) - 1 AS INTEGER) AS idx
FROM (SELECT DISTINCT state FROM obs WHERE state IS NOT NULL)
UNION ALL
SELECT 'county' AS kind, county AS value,
       CAST(row_number() OVER (ORDER BY county) - 1 AS INTEGER) AS idx
FROM (SELECT DISTINCT county FROM obs WHERE county IS NOT NULL)
"""))
def q_geo_dictionaries(spark, sf):
    o = observed(spark, sf)
    s = FE.geo_dictionary(o, "state").select(F.lit("state").alias("kind"), F.col("state").alias("value"),
                                              F.col("state_idx").alias("idx"))
    c = FE.geo_dictionary(o, "county").select(F.lit("county").alias("kind"), F.col("county").alias("value"),
                                               F.col("county_idx").alias("idx"))
    return s.unionByName(c)


@register("geo_dictionaries_fold", O.with_(["obs", "folds"], """
SELECT fold, county AS value, CAST(row_number() OVER (PARTITION BY fold ORDER BY county) - 1 AS INTEGER) AS idx
FROM (SELECT DISTINCT f.fold, o.county
      FROM obs o JOIN (SELECT fold, unnest([year_from, year_to]) AS year FROM folds WHERE role = 'train' AND fold = 1) f
        ON f.year = o.year
      WHERE o.county IS NOT NULL)
"""))
def q_geo_dictionaries_fold(spark, sf):
    """A14 from one fold's years alone: the counties of the first fold's training years."""
    train = folded(spark, sf).folds.where("role = 'train' and fold = 1")
    years = train.select(F.explode(F.array("year_from", "year_to")).alias("year")).distinct()
    d = FE.geo_dictionary(observed(spark, sf), "county", years=years)
    return d.select(F.lit(1).alias("fold"), F.col("county").alias("value"), F.col("county_idx").cast("int").alias("idx"))


@register("state_onehot", O.with_(["gf", "obs"], """
SELECT g.observer_id, g.year, g.top_state, d.state_idx
FROM gf g LEFT JOIN (
  SELECT state, CAST(row_number() OVER (ORDER BY state) - 1 AS INTEGER) AS state_idx
  FROM (SELECT DISTINCT state FROM obs WHERE state IS NOT NULL)) d ON d.state = g.top_state
"""))
def q_state_onehot(spark, sf):
    o = observed(spark, sf)
    return FE.state_onehot(FE.geo_features(o), FE.geo_dictionary(o, "state"))


_KEYS = ["fold", "role", "observer_id", "year_from"]

for _c in ("state", "county"):
    O.cte(f"hot_{_c}", f"""
SELECT f.fold, f.role, f.observer_id, f.year_from, '{_c}_' || g.top_{_c} AS feature, CAST(1 AS DOUBLE) AS value
FROM fold_trans f JOIN gf g ON g.observer_id = f.observer_id AND g.year = f.year_from
JOIN (SELECT DISTINCT y.fold, o.{_c} FROM (
        SELECT fold, year_from AS y FROM folds UNION SELECT fold, year_to FROM folds) y
      JOIN obs o ON o.year = y.y WHERE o.{_c} IS NOT NULL) d ON d.fold = f.fold AND d.{_c} = g.top_{_c}
""", ["fold_trans", "gf", "folds", "obs"])


def _hot(spark, sf, columns=("state", "county")):
    """Fold rows with the hot places of their source year's most common state and county."""
    d = folded(spark, sf)
    dictionaries = cut_lineage(OH.fold_dictionaries(observed(spark, sf), d.folds), "dictionaries")
    tops = FE.geo_features(observed(spark, sf)).select("observer_id", "year", "top_state", "top_county")
    rows = cut_lineage(FE.lookup(d.fold_trans.select(*_KEYS), tops, "left"), "tops")     # read by every fold
    return OH.hot_features(OH.onehot_vectors(rows, dictionaries), dictionaries, _KEYS, columns)


def _hot_query(column):
    @register(f"{column}_hot_places", O.with_([f"hot_{column}"], f"""
SELECT fold, role, observer_id, year_from, feature, round(value, 6) AS value FROM hot_{column}
"""))
    def q(spark, sf):
        return cmp_ready(_hot(spark, sf, (column,)))


for _c in ("state", "county"):
    _hot_query(_c)


_TFS_INT = ["num_species", "num_checklists", "num_locations", "num_states"]
_TFS_DBL = ["total_observations", "avg_observations_per_checklist", "effort_mean", "effort_total",
            "effort_max", "effort_std", "duration_mean", "duration_total", "duration_max",
            "duration_std", "checklists_per_month"]


@register("temporal_from_summary", O.with_(["tf_summ"], f"""
SELECT observer_id, year, {", ".join(_TFS_INT)}, {_round_all(_TFS_DBL)} FROM tf_summ
"""))
def q_temporal_from_summary(spark, sf):
    t = FE.temporal_from_summary(summary(spark, sf))
    return cmp_ready(t.select("observer_id", "year", *_TFS_INT, *_TFS_DBL))


@register("geo_from_summary", O.with_(["gf_summ"], """
SELECT observer_id, year, top_state, top_county, round(state_diversity, 6) AS state_diversity,
       round(state_diversity_literal, 6) AS state_diversity_literal, num_states, num_counties,
       num_localities, round(geographic_spread, 6) AS geographic_spread FROM gf_summ
"""))
def q_geo_from_summary(spark, sf):
    return cmp_ready(FE.geo_from_summary(summary(spark, sf)))


@register("temporal_lookup", O.with_(["trans", "tf"], """
SELECT t.observer_id, t.year_from, t.year_to, f.num_checklists, f.num_species,
       round(f.total_observations, 6) AS total_observations, round(f.doy_mean, 6) AS doy_mean
FROM trans t JOIN tf f ON f.observer_id = t.observer_id AND f.year = t.year_from
"""))
def q_temporal_lookup(spark, sf):
    d = folded(spark, sf)
    tf = FE.temporal_features(observed(spark, sf))
    j = FE.lookup(d.transitions.select("observer_id", "year_from", "year_to"), tf, "inner")
    return cmp_ready(j.select("observer_id", "year_from", "year_to", "num_checklists", "num_species",
                              "total_observations", "doy_mean"))


@register("geo_lookup", O.with_(["trans", "gf"], """
SELECT t.observer_id, t.year_from, t.year_to, coalesce(g.num_states, 0) AS num_states,
       round(coalesce(g.state_diversity, 0.0), 6) AS state_diversity,
       round(coalesce(g.geographic_spread, 0.0), 6) AS geographic_spread
FROM trans t LEFT JOIN gf g ON g.observer_id = t.observer_id AND g.year = t.year_from
"""))
def q_geo_lookup(spark, sf):
    d = folded(spark, sf)
    gf = FE.geo_features(observed(spark, sf)).select(
        "observer_id", "year", "num_states", "state_diversity", "geographic_spread")
    j = FE.lookup(d.transitions.select("observer_id", "year_from", "year_to"), gf, "left", fill_zero=True)
    return cmp_ready(j)


@register("summary_lookup", O.with_(["trans", "summ"], """
SELECT t.observer_id, t.year_from, t.year_to, CAST(len(s.locality_id) AS INTEGER) AS n_localities,
       round(s.total_observations, 6) AS total_observations
FROM trans t JOIN summ s ON s.observer_id = t.observer_id AND s.year = t.year_from
"""))
def q_summary_lookup(spark, sf):
    d = folded(spark, sf)
    s = summary(spark, sf).select("observer_id", "year", F.size("locality_id").alias("n_localities"),
                                  "total_observations")
    return cmp_ready(FE.lookup(d.transitions.select("observer_id", "year_from", "year_to"), s, "inner"))


@register("bird_counts", O.with_(["test", "summ"], """
SELECT t.fold, t.observer_id, round(coalesce(s.total_observations, 0.0), 6) AS bird_count
FROM (SELECT f.fold, f.observer_id, f.year_to FROM fold_trans f WHERE role = 'test') t
LEFT JOIN summ s ON s.observer_id = t.observer_id AND s.year = t.year_to
"""))
def q_bird_counts(spark, sf):
    d = folded(spark, sf)
    t = d.fold_trans.where(F.col("role") == "test").select("fold", "observer_id", "year_to")
    return cmp_ready(FE.bird_counts(t, summary(spark, sf)).select("fold", "observer_id", "bird_count"))


def _assembly(spark, sf):
    """Fold rows with the raw temporal and geographic features of their source year (J6), one raw scan."""
    d = folded(spark, sf)
    own = FE.observer_year_features(observed(spark, sf)).select(
        "observer_id", "year", *FE.RAW_MODEL_FEATURES, *[F.col(c).alias(f"geo_{c}") for c in FE.GEO_METRICS])
    base = d.fold_trans.select("fold", "role", "observer_id", "year_from", "year_to")
    return d, FE.impute_zero(FE.lookup(base, own, "left"), _ASM_COLS)


_GEO_ASM = [f"geo_{c}" for c in FE.GEO_METRICS]
_ASM_COLS = FE.RAW_MODEL_FEATURES + _GEO_ASM

O.cte("assembly", f"""
SELECT f.fold, f.role, f.observer_id, f.year_from, f.year_to,
       {", ".join(f"CAST(coalesce(t.{c}, 0) AS DOUBLE) AS {c}" for c in FE.RAW_MODEL_FEATURES)},
       {", ".join(f"CAST(coalesce(g.{c}, 0) AS DOUBLE) AS geo_{c}" for c in FE.GEO_METRICS)}
FROM fold_trans f
LEFT JOIN tf t ON t.observer_id = f.observer_id AND t.year = f.year_from
LEFT JOIN gf g ON g.observer_id = f.observer_id AND g.year = f.year_from
""", ["fold_trans", "tf", "gf"])


@register("feature_assembly", O.with_(["assembly"], f"""
SELECT fold, role, observer_id, year_from, year_to, {_round_all(_ASM_COLS)} FROM assembly
"""))
def q_feature_assembly(spark, sf):
    _, w = _assembly(spark, sf)
    return cmp_ready(w.select("fold", "role", "observer_id", "year_from", "year_to",
                              *[F.col(c).cast("double").alias(c) for c in _ASM_COLS]))


O.cte("scaled", f"""
SELECT l.fold, l.role, l.observer_id, l.year_from, l.feature, l.value,
       (l.value - q.q[2]) / CASE WHEN q.q[3] - q.q[1] = 0 THEN 1.0 ELSE q.q[3] - q.q[1] END AS scaled
FROM (UNPIVOT assembly ON {", ".join(_ASM_COLS)} INTO NAME feature VALUE value) l
JOIN (SELECT fold, feature, quantile_cont(value, [0.25, 0.5, 0.75]) AS q
      FROM (UNPIVOT assembly ON {", ".join(_ASM_COLS)} INTO NAME feature VALUE value)
      WHERE role = 'train' GROUP BY fold, feature) q USING (fold, feature)
""", ["assembly"])


@register("robust_scale", O.with_(["scaled"], """
SELECT fold, role, observer_id, year_from, feature, round(scaled, 6) AS scaled FROM scaled
"""))
def q_robust_scale(spark, sf):
    _, w = _assembly(spark, sf)
    w = cut_lineage(w, "assembly")                       # read by the fit and by the scaling
    long = FE.to_long(w, ["fold", "role", "observer_id", "year_from"], _ASM_COLS)
    s = FE.robust_scale(long, ["fold"])
    return cmp_ready(s.select("fold", "role", "observer_id", "year_from", "feature", "scaled"))


@register("simple_features", O.with_(["fold_trans"], """
SELECT fold, role, observer_id, year_from, year_to, CAST(len(species_from) AS DOUBLE) AS num_species,
       round(year_from / 2023.0, 6) AS year
FROM fold_trans
"""))
def q_simple_features(spark, sf):
    return cmp_ready(FE.simple_features(folded(spark, sf).fold_trans))


@register("impute_zero", O.with_(["trans", "tf"], """
SELECT t.observer_id, t.year_from, round(coalesce(f.doy_mean, 0.0), 6) AS doy_mean,
       round(coalesce(f.effort_mean, 0.0), 6) AS effort_mean
FROM trans t LEFT JOIN tf f ON f.observer_id = t.observer_id AND f.year = t.year_to
"""))
def q_impute_zero(spark, sf):
    # year_to lookups miss for the last year of every observer: NULL -> 0.0
    d = folded(spark, sf)
    tf = FE.temporal_features(observed(spark, sf)).select("observer_id", "year", "doy_mean", "effort_mean")
    j = FE.lookup(d.transitions.select("observer_id", "year_from", "year_to"), tf, "left", year_col="year_to")
    return cmp_ready(FE.impute_zero(j, ["doy_mean", "effort_mean"]).drop("year_to"))


@register("feature_subset", O.with_(["tf"], f"""
SELECT observer_id, year, {", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in FE.RAW_MODEL_FEATURES)}
FROM tf
"""))
def q_feature_subset(spark, sf):
    tf = FE.temporal_features(observed(spark, sf))
    cols = FE.feature_subset(tf, FE.RAW_MODEL_FEATURES)
    return cmp_ready(tf.select("observer_id", "year", *[F.col(c).cast("double").alias(c) for c in cols]))


@register("drop_null_stats", O.with_(["obs"], """
SELECT year, count(observation_count) AS n_counts, round(avg(observation_count), 6) AS mean_count,
       count(effort_distance_km) AS n_distances, round(max(effort_distance_km), 6) AS max_distance
FROM obs GROUP BY year
"""))
def q_drop_null_stats(spark, sf):
    o = observed(spark, sf)
    return cmp_ready(o.groupBy("year").agg(
        F.count("observation_count").alias("n_counts"), F.avg("observation_count").alias("mean_count"),
        F.count("effort_distance_km").alias("n_distances"),
        F.max("effort_distance_km").alias("max_distance")))


_PF = FE.SUMMARY_MODEL_FEATURES

O.cte("pf_wide", f"""
SELECT f.fold, f.role, f.observer_id, f.year_from,
       {", ".join(f"CAST(coalesce(t.{c if c not in ('avg_effort_hours', 'avg_duration') else {'avg_effort_hours': 'effort_mean', 'avg_duration': 'duration_mean'}[c]}, 0) AS DOUBLE) AS {c}" for c in _PF)}
FROM fold_trans f LEFT JOIN tf_summ t ON t.observer_id = f.observer_id AND t.year = f.year_from
""", ["fold_trans", "tf_summ"])

O.cte("pf_scaled", f"""
SELECT l.fold, l.role, l.observer_id, l.year_from, l.feature,
       (l.value - q.q[2]) / CASE WHEN q.q[3] - q.q[1] = 0 THEN 1.0 ELSE q.q[3] - q.q[1] END AS scaled
FROM (UNPIVOT pf_wide ON {", ".join(_PF)} INTO NAME feature VALUE value) l
JOIN (SELECT fold, feature, quantile_cont(value, [0.25, 0.5, 0.75]) AS q
      FROM (UNPIVOT pf_wide ON {", ".join(_PF)} INTO NAME feature VALUE value)
      WHERE role = 'train' GROUP BY fold, feature) q USING (fold, feature)
""", ["pf_wide"])


@register("prepared_fold", O.with_(["pf_scaled"], """
SELECT fold, role, observer_id, year_from, feature, round(scaled, 6) AS scaled FROM pf_scaled
"""))
def q_prepared_fold(spark, sf):
    """Fold rows + summary-based features (J6, 0-filled) robust-scaled on train."""
    d = folded(spark, sf)
    tf = FE.temporal_from_summary(summary(spark, sf)).select("observer_id", "year", *_PF)
    base = d.fold_trans.select("fold", "role", "observer_id", "year_from", "year_to")
    wide = cut_lineage(FE.impute_zero(FE.lookup(base, tf, "left"), _PF), "prepared")
    long = FE.to_long(wide, ["fold", "role", "observer_id", "year_from"], _PF)
    return cmp_ready(FE.robust_scale(long, ["fold"]).select(
        "fold", "role", "observer_id", "year_from", "feature", "scaled"))


@register("prepared_fold_species", O.with_(["sfeat"], """
SELECT fold, species, total_viewers, popularity, round(popularity_score, 6) AS popularity_score FROM sfeat
"""))
def q_prepared_fold_species(spark, sf):
    """The species features that a fold's models are given, from the fold's training rows alone."""
    return cmp_ready(fold_species_features(folded(spark, sf).fold_trans).drop("viewers_by_year"))


@register("prepared_fold_full", O.with_(["scaled", "hot_state", "hot_county"], """
SELECT fold, role, observer_id, year_from, feature, round(scaled, 6) AS value FROM scaled
UNION ALL SELECT fold, role, observer_id, year_from, feature, round(value, 6) FROM hot_state
UNION ALL SELECT fold, role, observer_id, year_from, feature, round(value, 6) FROM hot_county
"""))
def q_prepared_fold_full(spark, sf):
    """M0c from the raw rows: temporal features and geographic metrics scaled on train, one-hots as they are."""
    w = cut_lineage(_assembly(spark, sf)[1], "assembly")
    scaled = FE.robust_scale(FE.to_long(w, _KEYS, _ASM_COLS), ["fold"])
    return cmp_ready(scaled.select(*_KEYS, "feature", F.col("scaled").alias("value")).unionByName(_hot(spark, sf)))
