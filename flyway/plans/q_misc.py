"""Registered small operators: species tables, fold variants, sets, windows, sorts, scalars."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from . import oracle as O
from .pipeline import all_transitions, folded, observed, species_sets, summary
from .registry import cmp_ready, register
from ..functions import clean_state, cosine, jaccard, month_of, set_mean, set_std_pop, set_sum
from ..operators.folds import cv_folds, holdout_split
from ..operators.species import (all_species, interaction_long, species_features, species_index,
                                 species_viewers)
from ..sources.sinks import new_output_dir, union_year_tables, year_etl

_T = "observer_id, year_from, year_to"


@register("all_species", O.with_(["catalogue"], "SELECT species FROM catalogue"))
def q_all_species(spark, sf):
    return all_species(all_transitions(spark, sf))


def _viewers_str(c):
    return F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(
        e["key"].cast("string"), F.lit(":"), e["value"].cast("string"))), ",")


@register("species_viewers", O.with_(["sfeat_all"], "SELECT species, viewers_by_year, total_viewers FROM sfeat_all"))
def q_species_viewers(spark, sf):
    v = species_viewers(all_transitions(spark, sf))
    return v.select("species", _viewers_str(F.col("viewers_by_year")).alias("viewers_by_year"), "total_viewers")


@register("species_popularity_label", O.with_(["sfeat_all"], """
SELECT species, total_viewers, popularity, round(popularity_score, 6) AS popularity_score FROM sfeat_all
"""))
def q_species_popularity_label(spark, sf):
    f = species_features(all_transitions(spark, sf))
    return cmp_ready(f.select("species", "total_viewers", "popularity", "popularity_score"))


_IDX_SQL = O.with_(["catalogue"], """
SELECT species, CAST(row_number() OVER (ORDER BY species) - 1 AS INTEGER) AS species_idx FROM catalogue
""")


@register("species_index", _IDX_SQL)
def q_species_index(spark, sf):
    return species_index(all_species(all_transitions(spark, sf)))


@register("sorted_species", _IDX_SQL)
def q_sorted_species(spark, sf):
    return species_index(all_species(all_transitions(spark, sf))).orderBy("species_idx")


@register("interaction_matrix", O.with_(["trans"], f"""
SELECT {_T}, 'X' AS side, unnest(species_from) AS species FROM trans
UNION ALL
SELECT {_T}, 'y' AS side, unnest(species_to) AS species FROM trans
"""))
def q_interaction_matrix(spark, sf):
    return interaction_long(all_transitions(spark, sf), ["observer_id", "year_from", "year_to"])


@register("popularity_rank", O.with_(["sfeat_all"], """
SELECT species, total_viewers,
       CAST(row_number() OVER (ORDER BY total_viewers DESC, species) AS INTEGER) AS pop_rank FROM sfeat_all
"""))
def q_popularity_rank(spark, sf):
    f = species_viewers(all_transitions(spark, sf)).select("species", "total_viewers")
    w = Window.orderBy(F.desc("total_viewers"), "species")   # S rows
    return f.withColumn("pop_rank", F.row_number().over(w).cast("int"))


@register("argsort_desc", O.with_(["sfeat_all"], """
SELECT species, CAST(row_number() OVER (ORDER BY popularity_score DESC, species) AS INTEGER) AS position
FROM sfeat_all
"""))
def q_argsort_desc(spark, sf):
    f = species_features(all_transitions(spark, sf))
    return f.select("species", F.row_number().over(
        Window.orderBy(F.desc("popularity_score"), "species")).cast("int").alias("position"))


@register("share_of_total", O.with_(["sv_all"], """
SELECT year, species, round(n / sum(n) OVER (PARTITION BY year), 6) AS share FROM sv_all
"""))
def q_share_of_total(spark, sf):
    t = all_transitions(spark, sf)
    side = (t.select(F.col("year_from").alias("year"), F.explode("species_from").alias("species"))
             .unionByName(t.select(F.col("year_to").alias("year"), F.explode("species_to").alias("species"))))
    c = side.groupBy("year", "species").agg(F.count(F.lit(1)).alias("n"))
    return cmp_ready(c.select("year", "species",
                              (F.col("n") / F.sum("n").over(Window.partitionBy("year"))).alias("share")))


@register("cv_folds_lexicographic", O.with_(["folds_lexicographic"],
                                            "SELECT fold, role, year_from, year_to FROM folds_lexicographic"))
def q_cv_folds_lexicographic(spark, sf):
    return cv_folds(all_transitions(spark, sf), mode="lexicographic")


@register("cv_folds_ending_before", O.with_(["folds_ending_before"],
                                            "SELECT fold, role, year_from, year_to FROM folds_ending_before"))
def q_cv_folds_ending_before(spark, sf):
    return cv_folds(all_transitions(spark, sf), mode="ending_before")


@register("fold_membership", O.with_(["fold_trans"], f"SELECT fold, role, {_T} FROM fold_trans"))
def q_fold_membership(spark, sf):
    return folded(spark, sf).fold_trans.select("fold", "role", "observer_id", "year_from", "year_to")


@register("holdout_split", O.with_(["train"], """
SELECT fold, observer_id, year_from, year_to, rn <= m AS is_validation
FROM (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY
                md5(concat_ws(':', 42, observer_id, year_from, year_to)), observer_id, year_from, year_to) AS rn,
             least(1000, floor(count(*) OVER (PARTITION BY fold) * 0.1)) AS m FROM train)
"""))
def q_holdout_split(spark, sf):
    ft = folded(spark, sf).fold_trans.where(F.col("role") == "train")
    return holdout_split(ft).select("fold", "observer_id", "year_from", "year_to", "is_validation")


@register("distinct_transitions", O.with_(["trans"], "SELECT DISTINCT year_from, year_to FROM trans"))
def q_distinct_transitions(spark, sf):
    return all_transitions(spark, sf).select("year_from", "year_to").distinct()


@register("sort_transitions", O.with_(["trans"], """
SELECT year_from, year_to, CAST(row_number() OVER (ORDER BY year_from, year_to) AS INTEGER) AS position
FROM (SELECT DISTINCT year_from, year_to FROM trans)
"""))
def q_sort_transitions(spark, sf):
    p = all_transitions(spark, sf).select("year_from", "year_to").distinct()
    return p.withColumn("position", F.row_number().over(Window.orderBy("year_from", "year_to")).cast("int"))


@register("next_year", O.with_(["oys"], """
SELECT observer_id, year, lead(year) OVER (PARTITION BY observer_id ORDER BY year) AS next_year FROM oys
"""))
def q_next_year(spark, sf):
    s = species_sets(spark, sf)
    return s.select("observer_id", "year",
                    F.lead("year").over(Window.partitionBy("observer_id").orderBy("year")).alias("next_year"))


@register("topk_per_observer", O.with_(["obs"], """
SELECT observer_id, year, species, n_rows, CAST(rk AS INTEGER) AS rank FROM (
  SELECT observer_id, year, scientific_name AS species, count(*) AS n_rows,
         row_number() OVER (PARTITION BY observer_id, year ORDER BY count(*) DESC, scientific_name) AS rk
  FROM obs GROUP BY observer_id, year, scientific_name)
WHERE rk <= 3
"""))
def q_topk_per_observer(spark, sf):
    c = observed(spark, sf).groupBy("observer_id", "year", F.col("scientific_name").alias("species")) \
        .agg(F.count(F.lit(1)).alias("n_rows"))
    w = Window.partitionBy("observer_id", "year").orderBy(F.desc("n_rows"), "species")
    return c.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= 3)


@register("sort_summary", O.with_(["oys"], """
SELECT observer_id, year, len(species) AS n_species FROM oys
"""))
def q_sort_summary(spark, sf):
    s = species_sets(spark, sf)
    return s.select("observer_id", "year", F.size("scientific_name").alias("n_species")) \
            .orderBy("observer_id", "year")


@register("head_n", O.with_(["oys"], """
SELECT observer_id, year, array_to_string(species, ',') AS scientific_name FROM oys
ORDER BY observer_id, year LIMIT 100
"""))
def q_head_n(spark, sf):
    return cmp_ready(species_sets(spark, sf).orderBy("observer_id", "year").limit(100))


@register("union_years", O.with_(["oys"], """
SELECT year, count(*) AS n_observer_years FROM oys GROUP BY year
"""))
def q_union_years(spark, sf):
    """The per-year tables, one frame for each ``year=`` folder that the year job wrote."""
    path = new_output_dir(spark, "union_years")
    year_etl(observed(spark, sf), path)
    u = union_year_tables(spark, path)
    return u.groupBy("year").agg(F.count(F.lit(1)).alias("n_observer_years"))


def _sets(spark, sf, **columns):
    return all_transitions(spark, sf).select("observer_id", "year_from", "year_to",
                                             *[c.alias(n) for n, c in columns.items()])


def _joined(c):
    return F.array_join(F.array_sort(c), ",")


@register("set_intersect", O.with_(["trans"], f"""
SELECT {_T}, CAST(len(list_intersect(species_from, species_to)) AS INTEGER) AS n_common,
       array_to_string(list_sort(list_intersect(species_from, species_to)), ',') AS common_species FROM trans
"""))
def q_set_intersect(spark, sf):
    """Species seen in both years."""
    both = F.array_intersect("species_from", "species_to")
    return _sets(spark, sf, n_common=F.size(both), common_species=_joined(both))


@register("set_union", O.with_(["trans"], f"""
SELECT {_T}, CAST(len(list_distinct(list_concat(species_from, species_to))) AS INTEGER) AS n_union,
       array_to_string(list_sort(list_distinct(list_concat(species_from, species_to))), ',') AS all_species FROM trans
"""))
def q_set_union(spark, sf):
    """Species seen in either year (the training set of a transition)."""
    either = F.array_union("species_from", "species_to")
    return _sets(spark, sf, n_union=F.size(either), all_species=_joined(either))


@register("set_difference", O.with_(["trans"], f"""
SELECT {_T},
       array_to_string(list_sort(list_filter(species_to, lambda x: NOT list_contains(species_from, x))), ',')
         AS new_species,
       array_to_string(list_sort(list_filter(species_from, lambda x: NOT list_contains(species_to, x))), ',')
         AS lost_species FROM trans
"""))
def q_set_difference(spark, sf):
    """U4: species new in the later year, and those seen in the earlier one only."""
    return _sets(spark, sf, new_species=_joined(F.array_except("species_to", "species_from")),
                 lost_species=_joined(F.array_except("species_from", "species_to")))


@register("similarity", O.with_(["trans"], f"""
SELECT {_T}, round(c / sqrt(CAST(a AS DOUBLE) * b), 6) AS cosine, round(c / CAST(a + b - c AS DOUBLE), 6) AS jaccard
FROM (SELECT *, len(list_intersect(species_from, species_to)) AS c, len(species_from) AS a,
             len(species_to) AS b FROM trans)
"""))
def q_similarity(spark, sf):
    t = all_transitions(spark, sf)
    c = F.size(F.array_intersect("species_from", "species_to"))
    a, b = F.size("species_from"), F.size("species_to")
    return cmp_ready(t.select("observer_id", "year_from", "year_to",
                              cosine(c, a, b).alias("cosine"), jaccard(c, a, b).alias("jaccard")))


@register("clean_state", O.with_(["obs"], """
SELECT trim(state) AS state, count(*) AS n_rows FROM obs GROUP BY trim(state)
"""))
def q_clean_state(spark, sf):
    o = observed(spark, sf)
    return o.groupBy(clean_state("state").alias("state")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("month_of", O.with_(["obs"], """
SELECT month(observation_date) AS month, count(*) AS n_rows FROM obs GROUP BY month(observation_date)
"""))
def q_month_of(spark, sf):
    o = observed(spark, sf)
    return o.groupBy(month_of("observation_date").alias("month")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("set_features", O.with_(["summ"], """
SELECT observer_id, year, CAST(len(effort_hours) AS INTEGER) AS n_values,
       round(coalesce(list_sum(effort_hours), 0.0), 6) AS total,
       round(coalesce(list_avg(effort_hours), 0.0), 6) AS mean,
       round(coalesce(list_max(effort_hours), 0.0), 6) AS max,
       round(CASE WHEN len(effort_hours) > 1 THEN list_stddev_pop(effort_hours) ELSE 0.0 END, 6) AS std_pop,
       list_contains(number_observers, 3) AS has_three_observers
FROM summ
"""))
def q_set_features(spark, sf):
    s = summary(spark, sf)
    e = F.col("effort_hours")
    return cmp_ready(s.select("observer_id", "year", F.size(e).alias("n_values"),
                              set_sum(e).alias("total"), set_mean(e).alias("mean"),
                              F.coalesce(F.array_max(e), F.lit(0.0)).alias("max"),
                              set_std_pop(e).alias("std_pop"),
                              F.array_contains("number_observers", 3).alias("has_three_observers")))
