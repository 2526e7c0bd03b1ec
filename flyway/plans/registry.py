"""Registered queries: one Spark plan and (where SQL can express it) one DuckDB oracle per key.

Comparison-ready outputs: sets as comma-joined sorted strings, doubles rounded to ten
significant digits, every computed column aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import oracle as O
from .pipeline import all_transitions, folded, observed, species_sets
from ..models.popularity import popularity_topk
from ..operators.metrics import ranking_metrics
from ..operators.species import target_popularity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = half_up_sql(sql)
        return fn
    return deco


def half_up_sql(sql: str) -> str:
    """Rewrite every ``round(x, 6)`` into rounding to significant digits (see ``r6``).

    Both engines then round with the same IEEE arithmetic.
    """
    out, i, pat = [], 0, "round("
    while True:
        j = sql.find(pat, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(pat)])
            i = j + len(pat)
            continue
        depth, m = 0, j + len(pat) - 1
        while True:
            ch = sql[m]
            depth += ch == "("
            depth -= ch == ")"
            if depth == 0:
                break
            m += 1
        inner = sql[j + len(pat):m]
        head, _, tail = inner.rpartition(",")
        if tail.strip() == "6":
            out.append(sql[i:j])
            out.append(_significant_sql(half_up_sql(head)))
        else:
            out.append(sql[i:j + len(pat)] + half_up_sql(inner) + ")")
        i = m + 1


DIGITS = 10
# What is left of a difference of nearly equal values (a deviation, a scaled value): below it both sides
# are 0.  The smallest share of 13.6 billion rows, 7e-11, lies above it.
NOISE = 1e-12


def _significant_sql(x: str) -> str:
    f = f"power(CAST(10 AS DOUBLE), {DIGITS - 1} - floor(log10(abs({x}))))"
    return f"(CASE WHEN abs({x}) < {NOISE} THEN CAST(0 AS DOUBLE) ELSE floor(({x}) * {f} + 0.5) / {f} END)"


def r6(c):
    """Spark side of the comparison rounding: ten significant digits, whatever the magnitude.

    That erases the last-ulp noise of different summation orders; values below ``NOISE`` count as 0.
    Only the registered queries round, for the comparison; the operators never do.
    """
    f = F.pow(F.lit(10.0), F.lit(DIGITS - 1.0) - F.floor(F.log10(F.abs(c))))
    return F.when(F.abs(c) < NOISE, F.lit(0.0)).otherwise(F.floor(c * f + F.lit(0.5)) / f)


def cmp_ready(df: DataFrame) -> DataFrame:
    """Arrays -> comma-joined strings, doubles -> ten significant digits."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = r6(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ------------------------------------------------------------------ slice 0
@register("scan_observed", O.with_(["obs"], """
SELECT year, count(*) AS n_rows, count(DISTINCT observer_id) AS n_observers,
       count(DISTINCT scientific_name) AS n_species, count(observation_count) AS n_counts,
       round(sum(observation_count), 6) AS sum_counts,
       count(effort_distance_km) AS n_distances
FROM obs GROUP BY year
"""))
def q_scan_observed(spark, sf):
    o = observed(spark, sf)
    return cmp_ready(o.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("observer_id").alias("n_observers"),
        F.count_distinct("scientific_name").alias("n_species"),
        F.count("observation_count").alias("n_counts"),
        F.sum("observation_count").alias("sum_counts"),
        F.count("effort_distance_km").alias("n_distances")))


@register("observer_year_species", O.with_(["oys"], """
SELECT observer_id, year, array_to_string(species, ',') AS scientific_name FROM oys
"""))
def q_observer_year_species(spark, sf):
    return cmp_ready(species_sets(spark, sf))


@register("transitions", O.with_(["trans"], """
SELECT observer_id, year_from, year_to, array_to_string(species_from, ',') AS species_from,
       array_to_string(species_to, ',') AS species_to FROM trans
"""))
def q_transitions(spark, sf):
    return cmp_ready(all_transitions(spark, sf))


@register("transitions_consecutive", O.with_(["trans_cons"], """
SELECT observer_id, year_from, year_to, array_to_string(species_from, ',') AS species_from,
       array_to_string(species_to, ',') AS species_to FROM trans_cons
"""))
def q_transitions_consecutive(spark, sf):
    return cmp_ready(all_transitions(spark, sf, consecutive=True))


@register("cv_folds", O.with_(["folds"], "SELECT fold, role, year_from, year_to FROM folds"))
def q_cv_folds(spark, sf):
    return folded(spark, sf).folds


@register("target_popularity", O.with_(["pop"], """
SELECT species, n_viewers, CAST(pop_rank AS INTEGER) AS pop_rank FROM pop
"""))
def q_target_popularity(spark, sf):
    d = folded(spark, sf)
    tr = d.fold_trans.where((F.col("fold") == 1) & (F.col("role") == "train"))
    return target_popularity(tr.select("species_to"), d.catalogue) \
        .withColumn("pop_rank", F.col("pop_rank").cast("int"))


@register("popularity_topk", O.with_(["pred_pop"], """
SELECT fold, observer_id, species, round(score, 6) AS score, rank FROM pred_pop
"""))
def q_popularity_topk(spark, sf):
    d = folded(spark, sf)
    return cmp_ready(popularity_topk(d.fold_trans, d.catalogue, k=O.K))


def _pop(spark, sf):
    d = folded(spark, sf)
    return d, popularity_topk(d.fold_trans, d.catalogue, k=O.K)


def metric_keys(prefix: str, pred_cte: str, build, k: int = O.K):
    """Register ``{prefix}_metrics`` = the long metric table of one model's predictions.

    ``build(spark, sf)`` returns (FoldedData, predictions).
    """
    long_cte = O.metric_ctes(pred_cte, k)
    sql = O.with_([long_cte], f"""
SELECT fold, k, metric, round(value, 6) AS value FROM {long_cte}
""")

    def fn(spark, sf):
        d, preds = build(spark, sf)
        truth = d.fold_trans.where(F.col("role") == "test")
        return cmp_ready(ranking_metrics(preds, truth, k, d.n_species))
    register(f"{prefix}_metrics", sql)(fn)
    return long_cte


_POP_LONG = metric_keys("popularity", "pred_pop", _pop)


def _metric_query(metric: str, alias: str):
    sql = O.with_([_POP_LONG], f"""
SELECT fold, round(value, 6) AS {alias} FROM {_POP_LONG} WHERE metric = '{metric}'
""")

    def fn(spark, sf):
        d, preds = _pop(spark, sf)
        truth = d.fold_trans.where(F.col("role") == "test")
        m = ranking_metrics(preds, truth, O.K, d.n_species).where(F.col("metric") == metric)
        return cmp_ready(m.select("fold", F.col("value").alias(alias)))
    return fn, sql


for _metric, _key in [("precision@k", "precision_at_k"), ("recall@k", "recall_at_k"),
                      ("map@k", "map_at_k"), ("precision_full", "precision_full"),
                      ("recall_full", "recall_full"), ("map_full", "map_full"),
                      ("coverage", "coverage")]:
    _fn, _sql = _metric_query(_metric, _key)
    register(_key, _sql)(_fn)


from . import q_models, q_features, q_sources, q_eval, q_misc  # noqa: E402,F401  (register on import)
