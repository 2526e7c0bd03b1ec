"""Learned ranker and count regression (M6, M7): re-aims of the neural model.

M6 -- a pointwise classifier over (row, species) pairs of the whole catalogue.
Features of a pair: the co-occurrence score, the species' popularity share and its
log, the source-set size, and (optionally) the observer's activity; row features
also come multiplied with the co-occurrence score, as a row's own features cannot
change the order of its species.  A logistic regression (sigmoid + cross-entropy, the
NN's output layer; see ``logistic``) is fitted per fold.

No target leaks into a feature: the rows that fold f learns from are the *test* rows of
the folds before it, scored by those folds' own models, that is by counts of strictly
earlier year pairs.  The first fold has no scored pair before it and ranks by the
co-occurrence score.  Every row of those folds, with its whole unseen catalogue, is learned
from, in passes of the co-occurrence kernel that never write a pair; every test row is scored against
the whole catalogue inside that kernel, which leaves K species per row.

M7 -- next-year bird count (falls back to the species count) with a Poisson
``GeneralizedLinearRegression`` (log link, non-negative), clipped to [0, 10000].
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicted_k
from ..operators.features import SUMMARY_MODEL_FEATURES, temporal_from_summary
from ..operators.folds import FOLDS_APART, holdout_split
from ..session import cut_lineage
from .common import KEY
from .cooccurrence import fitted_model, packed_tests, ranked_scores
from .logistic import ALL, REST, log_losses, logistic_fits, pair_logits


def _observer_features(summary: DataFrame | None) -> tuple[DataFrame | None, list[str]]:
    if summary is None:
        return None, []
    tf = temporal_from_summary(summary).select(
        "observer_id", F.col("year").alias("year_from"),
        *[F.log1p(F.col(c).cast("double")).alias(c) for c in SUMMARY_MODEL_FEATURES])
    return tf, list(SUMMARY_MODEL_FEATURES)


def _rows(data, summary: DataFrame | None, featured=None) -> DataFrame:
    """Test rows of every fold with their row features as the array ``extra``."""
    rows = data.fold_trans.where(F.col("role") == "test").select(
        "fold", "observer_id", "year_from", "year_to", "species_from", "species_to")
    obs_f, cols = _observer_features(summary)
    if obs_f is not None:
        rows = rows.join(obs_f, ["observer_id", "year_from"], "left").na.fill(0.0, cols)
    values = [F.col(c) if featured is None else F.when(featured, F.col(c)).otherwise(0.0) for c in cols]
    return cut_lineage(rows.withColumn("extra", F.array(
        F.log1p(F.size("species_from").cast("double")), *values)), "learned-rows")


def _reranker(weights: dict[int, np.ndarray]):
    """Probability of every species of a block from a fold's weights; scores stay without any."""
    def rerank(fold, score, share, extras):
        if fold not in weights:
            return score
        return 1.0 / (1.0 + np.exp(-pair_logits(weights[fold], score, share, np.array(extras, dtype=float))))
    return rerank


def holdout_losses(blocks: DataFrame, before: dict[int, list[int]], reg_params: tuple[float, ...], n_features: int,
                   alpha: float, max_iter: int = 50) -> dict[int, dict[float, float]]:
    """Per fold and regularisation the log loss on the held-out rows (M0d) of a classifier fitted on the others.

    ``before``: fold -> folds it learns from.  A fold whose other rows know one label only, or that holds out none, has no losses.
    """
    fits = {(f, r): (folds, REST, r) for f, folds in before.items() for r in reg_params}
    weights = logistic_fits(blocks, fits, n_features, alpha, max_iter)
    losses = log_losses(blocks, weights, {key: before[key[0]] for key in weights}, alpha)
    return {f: {r: losses[f, r] for r in reg_params if (f, r) in losses} for f in before}


def learned_topk(data, k: int = 10, summary: DataFrame | None = None, use_features: bool = True,
                 alpha: float = 0.1, reg_param: float | tuple[float, ...] = 0.001,
                 max_iter: int = 50, seed: int = 42, chosen: dict | None = None,
                 featured=None, own_k: DataFrame | None = None) -> DataFrame:
    """M6: every unseen species of the catalogue, ranked by a per-fold logistic regression.

    Every row of the earlier folds, with every unseen species, is fitted on.  Of several ``reg_param`` each
    fold takes the one with the least log loss on its holdout rows (M0d; ties: the
    largest), then fits on all its rows; ``chosen`` is filled with fold -> {reg_param: loss}.
    ``featured``: a predicate on ``fold``; where it does not hold the observer features are 0 and get no weight.
    ``own_k`` (fold, observer_id, kk) gives every observer a K of its own instead of ``k``.
    Folds learn from earlier folds of their own scenario only (``FOLDS_APART``).
    """
    reg_params = reg_param if isinstance(reg_param, tuple) else (reg_param,)
    model, n_blocks = fitted_model(data, alpha)
    rows = _rows(data, summary if use_features else None, featured)
    folds = sorted(r["fold"] for r in rows.select("fold").distinct().collect())
    before = {f: [g for g in folds if f - f % FOLDS_APART <= g < f] for f in folds}
    before = {f: earlier for f, earlier in before.items() if earlier}
    learned = sorted(set().union(*before.values()))
    weights = {}
    if learned:
        held = holdout_split(rows.where(F.col("fold").isin(learned)), seed)
        blocks = cut_lineage(packed_tests(held.select(*KEY, "species_from", "species_to", "extra", "is_validation"),
                                          labelled=True), "learned-blocks")
        blocks = (blocks.withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
                  .join(model, ["fold", "cb"]))
        width = len(SUMMARY_MODEL_FEATURES) + 1 if use_features and summary is not None else 1
        best = dict.fromkeys(before, max(reg_params))
        if len(reg_params) > 1:
            for f, losses in holdout_losses(blocks, before, reg_params, width, alpha, max_iter).items():
                best[f] = min(losses, key=lambda r: (losses[r], -r), default=best[f])
                if chosen is not None:
                    chosen[f] = losses
        weights = logistic_fits(blocks, {f: (earlier, ALL, best[f]) for f, earlier in before.items()}, width, alpha, max_iter)
    rerank = _reranker(weights)
    if own_k is None:
        return ranked_scores(rows, model, n_blocks, k, alpha, rerank=rerank)
    own_k = own_k.select(*KEY, "kk")                # K travels behind the row features into the kernel
    rows = rows.join(own_k, KEY).withColumn("extra", F.array_append("extra", F.col("kk").cast("double"))).drop("kk")
    return ranked_scores(rows, model, n_blocks, lambda extras: [int(x[-1]) for x in extras], alpha, own_k,
                         rerank=lambda fold, score, share, extras: rerank(fold, score, share, [x[:-1] for x in extras]))


def learned_at_counts(data, summary: DataFrame, **params) -> DataFrame:
    """The learned ranking cut at each observer's own learned next-year count -- W7.

    K = the count, rounded half to even, at least 1 and at most the catalogue.
    """
    counts, _ = count_regression(data, summary)
    size = data.n_species.select("n_species").scalar()
    own_k = cut_lineage(counts.select(*KEY, predicted_k(F.col("predicted"), size).alias("kk")), "learned-k")
    return learned_topk(data, summary=summary, own_k=own_k, **params)


def count_regression(data, summary: DataFrame, use_features: bool = True,
                     reg_param: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """Per fold Poisson GLM of next-year bird count -- M7.

    Returns (predictions (fold, observer_id, predicted), actual (fold, observer_id, actual)).
    """
    from ..operators.features import bird_counts
    obs_f, obs_cols = _observer_features(summary) if use_features else (None, [])
    rows = (bird_counts(data.fold_trans.select("fold", "role", "observer_id", "year_from", "year_to",
                                               "species_from"), summary)
            .withColumn("n_from", F.log1p(F.size("species_from").cast("double"))))
    if obs_f is not None:
        rows = rows.join(obs_f, ["observer_id", "year_from"], "left").na.fill(0.0, obs_cols)
    # A fit passes over its rows some 25 times: narrow, and every fold in a folder of its own.
    rows = cut_lineage(rows.select("fold", "role", "observer_id", "bird_count", "n_from", *obs_cols), "count-rows", by="fold")
    va = VectorAssembler(inputCols=["n_from"] + obs_cols, outputCol="features", handleInvalid="keep")
    preds = []
    for f in [r[0] for r in data.fold_trans.select("fold").distinct().orderBy("fold").collect()]:
        glr = GeneralizedLinearRegression(family="poisson", link="log", regParam=reg_param,
                                          labelCol="bird_count", featuresCol="features", maxIter=25)
        model = glr.fit(va.transform(rows.where((F.col("fold") == f) & (F.col("role") == "train"))))
        p = model.transform(va.transform(rows.where((F.col("fold") == f) & (F.col("role") == "test"))))
        preds.append(p.select("fold", "observer_id", clip_count(F.col("prediction")).alias("predicted"),
                              F.col("bird_count").alias("actual")))
    allp = reduce(DataFrame.unionByName, preds)
    return allp.select("fold", "observer_id", "predicted"), allp.select("fold", "observer_id", "actual")


def clip_count(c):
    """Predicted counts stay within [0, 10000] -- P12."""
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(10000.0))
