"""The learned ranker is fitted on every row of the folds before, with the optimum that MLlib finds on the written pairs."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from flyway.models import logistic as L
from flyway.models.cooccurrence import _by_model, _scored_rows, fitted_model, packed_tests
from flyway.models.learned import _rows, learned_topk
from flyway.operators.folds import holdout_split
from flyway.plans.pipeline import folded


def data_of(spark, observers, species=9):
    """``observers`` with four years each; what they see next follows what they saw, more or less."""
    o, y = F.col("o"), F.col("y")
    rows = (spark.range(observers).withColumnRenamed("id", "o")
            .withColumn("y", F.explode(F.array(*map(F.lit, range(2000, 2004)))))
            .withColumn("a", F.pmod(F.hash("o", "y"), F.lit(species)))
            .withColumn("b", F.pmod(F.hash("y", "o"), F.lit(species))))
    t = rows.select(o.alias("observer_id"), y.cast("int").alias("year_from"), (y + 1).cast("int").alias("year_to"),
                    F.array_sort(F.array_distinct(F.array(F.concat(F.lit("s"), "a"), F.concat(F.lit("s"), "b")))).alias("species_from"),
                    F.when(F.pmod(F.hash("b", "o"), F.lit(3)) > 0, F.array(F.concat(F.lit("s"), ((F.col("a") + 1) % species))))
                     .otherwise(F.array(F.concat(F.lit("s"), ((F.col("b") + 3) % species)))).alias("species_to"))
    return folded(spark, "", trans=t, n_folds=3)


def pair_rows(alpha):
    """mapInPandas-like reading of the pairs a pass meets: features and label, one row a pair."""
    import pyarrow as pa
    schema = pa.schema([("fold", pa.int32()), ("label", pa.float64()), ("x", pa.list_(pa.float64()))])

    def run(batches):
        for b, i, model in _by_model(batches, alpha):
            names, share = model[0].to_pylist(), model[7]
            known = b.column("known")[i].as_py()
            x = b.column("extras")[i].as_py()
            sizes = np.frombuffer(b.column("to_sizes")[i].as_buffer(), np.int64)
            codes = np.frombuffer(b.column("to_codes")[i].as_buffer(), np.int32)
            ends = np.append(0, np.cumsum(sizes))
            for first, n, score, seen, _ in _scored_rows(b, i, model):
                rows = []
                for r in range(n):
                    to = {known[c] for c in codes[ends[first + r]:ends[first + r + 1]]}
                    e = x[first + r]
                    rows += [(float(names[j] in to), [score[r, j], share[j], float(np.log(share[j] + 1e-6)), *e,
                                                      *(score[r, j] * v for v in e)]) for j in np.flatnonzero(~seen[r])]
                yield pa.RecordBatch.from_arrays([pa.array([b.column("fold")[i].as_py()] * len(rows), pa.int32()),
                                                  pa.array([q[0] for q in rows]), pa.array([q[1] for q in rows])], schema=schema)
    return run


def labelled(data):
    model, n_blocks = fitted_model(data, 0.1)
    assert n_blocks == 1
    rows = holdout_split(_rows(data, None))
    return packed_tests(rows, labelled=True).withColumn("cb", F.lit(0)).join(model, ["fold", "cb"])


def test_weights_are_those_of_mllib(spark):
    from pyspark.ml.functions import array_to_vector
    blocks = labelled(data_of(spark, 150)).cache()
    pairs = blocks.mapInArrow(pair_rows(0.1), "fold int, label double, x array<double>").cache()
    for reg in (0.001, 0.1):
        fits = L.logistic_fits(blocks, {f: (list(range(1, f)), L.ALL, reg) for f in (2, 3)}, 1, 0.1)
        for f in (2, 3):
            want = LogisticRegression(featuresCol="v", regParam=reg, maxIter=500, tol=1e-12).fit(
                pairs.where(F.col("fold") < f).select("label", array_to_vector("x").alias("v")))
            assert fits[f][0] == pytest.approx(want.intercept, abs=1e-4)
            assert fits[f][1:] == pytest.approx(want.coefficients.toArray(), rel=1e-3, abs=1e-4)


def test_every_row_of_the_folds_before_is_learned_from(spark, monkeypatch):
    data, passes, real = data_of(spark, 11_000), [], L._one_pass
    monkeypatch.setattr(L, "_one_pass", lambda blocks, asked, alpha: passes.append(real(blocks, asked, alpha)) or passes[-1])
    top = learned_topk(data, k=1)
    size = data.n_species.first()[0]
    tests = {r.fold: (r.n, r.pairs) for r in data.fold_trans.where("role = 'test'").groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum(size - F.size("species_from")).alias("pairs")).collect()}
    assert tests[1][0] + tests[2][0] > 20_000
    assert [passes[0][i][0] for i in (0, 1)] == [tests[1][1], tests[1][1] + tests[2][1]]
    assert top.count() == sum(n for n, _ in tests.values())


def test_held_out_rows_are_told_apart(spark):
    blocks = labelled(data_of(spark, 60)).cache()
    w = np.zeros(6)
    n = {which: L._one_pass(blocks, [(0, frozenset([1, 2]), which, w)], 0.1)[0][0] for which in (L.ALL, L.REST, L.HELD)}
    assert n[L.HELD] > 0 and n[L.REST] > n[L.HELD] and n[L.ALL] == n[L.REST] + n[L.HELD]


def test_one_label_gives_no_weights(spark):
    data = data_of(spark, 30)
    data.fold_trans = data.fold_trans.withColumn("species_to", F.array().cast("array<string>"))
    assert L.logistic_fits(labelled(data), {2: ([1], L.ALL, 0.1)}, 1, 0.1) == {}
    assert learned_topk(data, k=1).where("score is null").count() == 0
