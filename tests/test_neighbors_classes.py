"""Nearest observers where many rows hold equal sets, and the training blocks that a task is sent."""

import random

import pytest

from flyway.models.lsh import bands_of, lsh_neighbors
from flyway.models.neighbors import neighbor_search, neighbor_topk
from tests.test_neighbors_search import TEST, TRAIN, plain, similarity


def repeated(seed, n, kinds, fold=1):
    r = random.Random(seed)
    sets = [sorted({f"s{r.randrange(30)}" for _ in range(r.randrange(1, 7))}) for _ in range(kinds)]
    return [(fold, i, r.choice(sets)) for i in range(n)]


@pytest.mark.parametrize("metric", ["cosine", "jaccard"])
def test_equal_sets_are_searched_once(spark, metric):
    """Members of a class tie, by observer and year across classes; the search sees classes only."""
    test = repeated(1, 120, 9) + [(1, 500, [])]
    train = [(f, i % 200, 2000 + i // 200, s) for f, i, s in repeated(1, 400, 9) + repeated(2, 100, 40)]
    frames = spark.createDataFrame(test, TEST), spark.createDataFrame(train, TRAIN)
    got = {}
    for r in neighbor_search(*frames, metric, 70, test_block_rows=4, train_block_rows=5).collect():
        got.setdefault((r.fold, r.observer_id), []).append((r.nb_rank, -round(r.sim, 9), r.nb_observer_id, r.nb_year_from, r.common))
    want = plain(test, train, metric, 70, 1)
    assert {k: [x[1:] for x in sorted(v)] for k, v in got.items()} == want
    effort = neighbor_search(*frames, metric, 70, output="effort").collect()
    classes = len({tuple(s) for *_, s in test}) * len({tuple(s) for *_, s in train})
    assert sum(e.candidates for e in effort) <= classes < len(test) * len(train) / 50
    counts = {r.observer_id: r.n_candidates for r in neighbor_search(*frames, metric, output="counts", min_common=2).collect()}
    assert counts == {i: n for _, i, s in test if (n := sum(len(set(s) & set(t)) >= 2 for *_, t in train))}


def test_min_hash_candidates_of_equal_sets(spark):
    """The same neighbours as all pairs that agree in a band, ranked; before, every such pair of rows was joined."""
    from pyspark.sql import functions as F
    test = repeated(3, 80, 12) + [(1, 500, [])]
    train = [(f, i, 2000, s) for f, i, s in repeated(4, 300, 25)]
    hashes = {tuple(r.species): r.h for r in spark.createDataFrame([(s,) for *_, s in test + train if s], "species array<string>")
              .distinct().select("species", bands_of(6, 1, 42).alias("h")).collect()}
    want = {}
    for _, i, s in test:
        near = [(-round(similarity("jaccard", set(s), set(t))[0], 9), j, y) for _, j, y, t in train
                if s and any(a == b for a, b in zip(hashes[tuple(s)], hashes[tuple(t)]))]
        if near:
            want[i] = sorted(near)[:20]
    found = lsh_neighbors(spark.createDataFrame(test, TEST), spark.createDataFrame(train, TRAIN), 20, bands=6)
    got = {}
    for r in found.orderBy("observer_id", F.col("nb_rank")).collect():
        got.setdefault(r.observer_id, []).append((-round(r.sim, 9), r.nb_observer_id, r.nb_year_from))
    assert got == want
    assert all(len(v) == 20 for v in got.values())


def test_ranking_of_equal_rows(spark):
    """Rows of equal sets get one ranking, rows without a species or a neighbour the most frequent species."""
    rows = [(1, "train", i, 2000, s, s + ["z"]) for _, i, s in repeated(5, 60, 5)]
    rows += [(1, "test", 100 + i, 2001, s, []) for _, i, s in repeated(5, 40, 5)] + [(1, "test", 200, 2001, [], []), (1, "test", 201, 2001, ["q"], [])]
    df = spark.createDataFrame(rows, "fold int, role string, observer_id long, year_from int, species_from array<string>, species_to array<string>")
    got, by_set = {}, {}
    for r in neighbor_topk(df, 3).collect():
        got.setdefault(r.observer_id, []).append((r.rank, r.species, round(r.score, 9)))
    for _, role, i, _, s, _ in rows:
        if role == "test":
            by_set.setdefault(tuple(s), set()).add(tuple(sorted(got[i])))
    assert len(got) == 42 and all(len(v) == 1 for v in by_set.values())
    assert by_set[("q",)] == by_set[()] and next(iter(by_set[()]))[0][1] == "z"
