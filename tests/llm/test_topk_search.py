"""Exact top-k inner products against all pairs."""

import math

import numpy as np
import pytest

from flyway.llm import topk_search as T

SCHEMA = "vec_id bigint, embedding array<float>, label int, length double, rank string, block string"


def rows_of(kind, n=700, d=12):
    r = np.random.default_rng(7)
    x = r.normal(0, 1, (n, d)) * ([1.0] * 3 + [0.1] * (d - 3))
    if kind == "unit":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "skewed":
        x *= r.pareto(1.0, (n, 1))
    if kind == "copies":
        x[n // 3:2 * n // 3] = x[0]                       # one vector holds a third of the rows
    rows = [(i, [float(v) for v in x[i]], 0, 1.0, "r", "b") for i in range(n)]
    nan, inf = float("nan"), float("inf")
    rows += [(1000, None, 0, 1.0, "r", "b"), (1020, [1.0, None], 0, 1.0, "r", "b"), (1040, [nan] * d, 0, 1.0, "r", "b"),
             (1060, [inf] * d, 0, 1.0, "r", "b"), (1080, [], 0, 1.0, "r", "b"), (1100, [0.5, -0.5], 0, 1.0, "r", "b"),
             (None, [9.0] * d, 0, 1.0, "r", "b"), (1120, [0.0] * d, 0, 1.0, "r", "b"), (1121, rows[5][1], 0, 1.0, "r", "b"),
             (1121, rows[5][1], 0, 1.0, "r", "b")]
    return rows


def expected(rows, k, d=12):
    use = []
    for i, e, *_ in rows:
        if i is not None and e is not None and all(v is not None and math.isfinite(v) for v in e):
            v = [math.floor(64 * float(np.float32(x))) for x in e]
            use.append((i, v + [0] * (d - len(v))))
    ids = np.array([i for i, _ in use])
    m = np.array([v for _, v in use])
    out = []
    for i, v in use:
        if i % 20 == 0:
            s = m @ np.array(v)
            best = sorted((-int(s[j]), int(ids[j])) for j in range(len(ids)) if ids[j] != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["unit", "skewed", "copies"])
def test_equals_all_pairs(spark, kind):
    rows = rows_of(kind)
    df = spark.createDataFrame(rows, SCHEMA)
    got = T.top_inner_products(df, k=5, query_rows=10, stripe_blocks=2, least_rows=50, most_rows=50, sample_rows=100)
    assert sorted(map(tuple, got.collect())) == expected(rows, 5)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0], 0, 1.0, "r", "b"), (1, [3.0, 1.0], 0, 1.0, "r", "b"), (20, [-1.0, 0.0], 0, 1.0, "r", "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, T.top_inner_products(df).collect())) == expected(rows, 20, 2)
    assert T.top_inner_products(df.where("vec_id = 1")).count() == 0
    assert T.top_inner_products(df.limit(0)).count() == 0


def test_large_components_stay_exact(spark):
    r = np.random.default_rng(3)
    rows = [(i, [float(np.float32(v)) for v in r.normal(0, 1e6, 3)], 0, 1.0, "r", "b") for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, T.top_inner_products(df).collect())) == expected(rows, 20, 3)


@pytest.mark.parametrize("part_blocks,least_tasks", [(1, 1), (3, 1), (64, 5)])
def test_parts_and_stripes(spark, part_blocks, least_tasks):
    rows = rows_of("skewed", n=900)
    df = spark.createDataFrame(rows, SCHEMA)
    got = T.top_inner_products(df, k=7, query_rows=4, stripe_blocks=3, least_rows=40, most_rows=40, part_blocks=part_blocks,
                               least_tasks=least_tasks, sample_rows=60)
    assert sorted(map(tuple, got.collect())) == expected(rows, 7)


def test_components_beyond_64_bits(spark):
    """floor(64 * x) is no 64-bit integer: the vector takes no part; below that it does, exactly."""
    rows = [(0, [1e300, 1.0], 0), (20, [2.0 ** 57, 0.0], 0), (40, [-(2.0 ** 57), 1.0], 0), (60, [2.0 ** 40, 1.0], 0),
            (1, [1.0, 1.0], 0), (2, [0.0, 3.0], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = sorted((r.query_id, r.vec_id, r.score) for r in T.top_inner_products(df).collect())
    big = 64 * 2 ** 40
    assert got == [(60, 1, big * 64 + 64 * 64), (60, 2, 64 * 192)]
