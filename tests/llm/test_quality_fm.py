"""The factorisation machine: its identity, its gradient and its held-out accuracy."""

import zlib
from itertools import combinations

import numpy as np

from flyway.llm import quality_fm as M
from flyway.llm.common import table

from . import fixtures as X


def test_interactions_equal_all_pairs():
    rng = np.random.default_rng(0)
    m = M.FactorisationMachine(30, 4, 1)
    m.w, m.bias = rng.normal(size=len(m.w)), 0.3
    at = rng.choice(40, 12, replace=False)
    x = rng.normal(size=12)
    plain = m.bias + m.w[at] @ x + sum(m.v[at[i]] @ m.v[at[j]] * x[i] * x[j]
                                       for i, j in combinations(range(12), 2))
    assert abs(plain - m.margin(at, x)) < 1e-9


def test_learns_an_interaction():
    rng = np.random.default_rng(2)
    rows, y = [], []
    for _ in range(600):                                # label: exactly one of places 0 and 1
        a, b = rng.integers(0, 2, 2)
        at = np.array([p for p, on in ((0, a), (1, b)) if on] + [2], np.int64)
        rows.append((at, np.ones(len(at)), rng.normal(size=M.DENSE)))
        y.append(float(a != b))
    m = M.FactorisationMachine(4, 6, 3)
    m.fit(rows, np.array(y), 40, 64, 0.05, 0.0, 1)
    right = [(m.margin(*m.row(*r)) > 0) == (t == 1) for r, t in zip(rows, y)]
    assert np.mean(right) > 0.95


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    scored = M.quality_scores(table(spark, sf, "documents"), labels)
    got = scored.collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(r.predicted == int(r.score >= 0.7) for r in got)
    unseen = scored.where("held_out").join(labels, "doc_id").collect()
    right = [r.predicted == r.quality for r in unseen]
    assert len(unseen) > 50 and np.mean(right) > 0.9


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, _ = X.documents(spark)
    rows = [(i, i % 2) for i in range(60)]
    flip = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in rows]
    one, two = (sorted((str(r.doc_id), r.score) for r in M.quality_scores(
        docs, spark.createDataFrame(x, "doc_id bigint, quality int"), epochs=1).collect())
        for x in (rows, flip))
    assert one == two


def test_awkward_tables(spark):
    docs, rows = X.documents(spark)
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id bigint, quality int")
    got = M.quality_scores(docs, none).collect()
    assert len(got) == len(rows) and {r.score for r in got} == {0.5}
    assert M.quality_scores(X.empty(spark), none).count() == 0
