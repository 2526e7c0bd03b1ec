"""The co-occurrence kernel on blocks: sparse rows of codes, several column blocks, a dense full catalogue."""

import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flyway.models import cooccurrence as C
from micro import data as folded_micro


def _dense_pair(n_species: int, n_rows: int):
    """One model block with every cell set and one test block of ``n_rows`` rows, as the kernels get them."""
    rng = np.random.default_rng(7)
    names = [f"species {i:05d}" for i in range(n_species)]
    i, j = (x.ravel().astype(np.int32) for x in np.indices((n_species, n_species)))
    cells = pa.table({"i": i, "j": j, "n_ij": rng.integers(1, 500, i.size)})
    packed = C._pack_cells(n_species)((pa.scalar(1, pa.int32()), pa.scalar(0, pa.int32())), cells)
    sets = [[names[x] for x in rng.choice(n_species, 100, replace=False)] for _ in range(n_rows)]
    tests = pa.RecordBatch.from_arrays(
        [pa.array([1] * n_rows, pa.int32()), pa.array(range(n_rows), pa.int64()), pa.array(sets),
         pa.array([None] * n_rows, pa.list_(pa.float64()))],
        names=["fold", "observer_id", "species_from", "extra"])
    (block,) = C._pack_tests(n_rows, 1 << 22)([tests])
    share = rng.random(n_species) / n_species
    model = {"names": [names], "shares": [share], "d": [rng.integers(1, 900, n_species) + 109.5],
             "boosts": [np.ones(n_species)], "cb": [0], "columns": [n_species]}
    columns = {**{c: block.column(c) for c in block.schema.names},
               **{c: pa.array(v) for c, v in model.items()},
               **{c: packed.column(c).combine_chunks() for c in ("ends", "at", "n")}}
    return pa.RecordBatch.from_pydict(columns), cells, sets, names


def test_dense_catalogue_is_scored_in_bounded_time_and_memory():
    """The whole catalogue of 1,095 species, every pair seen: under a second and 200 MB a pair of blocks."""
    pair, _, _, _ = _dense_pair(1095, 2048)
    list(C._score_kernel(10, 0.1)([pair]))                    # libraries loaded
    seconds = []
    for _ in range(3):
        t = time.perf_counter()
        rows = sum(b.num_rows for b in C._score_kernel(10, 0.1)([pair]))
        seconds.append(time.perf_counter() - t)
    tracemalloc.start()
    list(C._score_kernel(10, 0.1)([pair]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 20480
    assert min(seconds) < 1.0, seconds
    assert peak < 200e6, peak


def test_kernel_gives_the_formula():
    pair, cells, sets, names = _dense_pair(130, 5)
    d, share = (np.array(pair.column(c)[0].as_py()) for c in ("d", "shares"))
    count = np.zeros((130, 130))
    count[cells["i"], cells["j"]] = cells["n_ij"]
    place = {s: x for x, s in enumerate(names)}
    got = {(r["observer_id"], r["species"]): r["score"]
           for b in C._score_kernel(130, 0.1)([pair]) for r in b.to_pylist()}
    assert len(got) == 5 * 30
    for (o, s), score in got.items():
        viewed = [place[x] for x in sets[o]]
        w = [1 / (1 + 10 * share[i]) for i in viewed]
        want = sum(x * (count[i, place[s]] + 0.1) / d[i] for x, i in zip(w, viewed)) / sum(w)
        assert place[s] not in viewed and score == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("cells", [1, 7, 12])
def test_column_blocks_do_not_change_the_ranking(spark, monkeypatch, cells):
    d = folded_micro(spark)

    def run():
        p = C.cooccurrence_topk(d.fold_trans, d.transitions, d.folds, d.catalogue, d.n_species, k=4)
        return sorted((r.fold, r.observer_id, r.rank, r.species, round(r.score, 12)) for r in p.collect())

    whole = run()
    monkeypatch.setattr(C, "_MODEL_CELLS", cells)
    assert run() == whole and whole


def test_unknown_species_empty_and_null_sets(spark):
    """Species outside the catalogue weigh 1 and pull evenly; empty and null sets rank by share."""
    d = folded_micro(spark)
    rows = spark.createDataFrame([(1, 70, []), (1, 71, None), (1, 72, ["unheard of"]), (1, 73, ["A", "unheard of"])],
                                 "fold int, observer_id bigint, species_from array<string>")
    p = C.cooccurrence_topk(d.fold_trans, d.transitions, d.folds, d.catalogue, d.n_species, k=3, query_rows=rows)
    by = {}
    for r in p.orderBy("observer_id", "rank").collect():
        by.setdefault(r.observer_id, []).append((r.species, r.score))
    n_i, _ = C.fit_counts(d.transitions, d.folds)
    share = sorted(((-r.share, r.species) for r in C.history_share(n_i).where(F.col("fold") == 1).collect()))
    assert by[70] == by[71]
    assert [s for s, _ in by[70]] == [s for _, s in share[:3]]
    size = d.n_species.first()["n_species"]
    assert [x for _, x in by[72]] == pytest.approx([1 / size] * 3)
    assert "A" not in [s for s, _ in by[73]]
