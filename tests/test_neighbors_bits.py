"""Bits that are added up in words give the common species of all pairs, their counts and their first bounds."""

import random
import zlib

import numpy as np
import pytest

from flyway.models import neighbors as nb

N, V = 5, 70


def block(prefix, sets, names, held=None):
    place = {x: i for i, x in enumerate(names)}
    held = held or [1] * len(sets)
    out = {"names": names, "sizes": np.array([len(s) for s in sets], np.int32).tobytes(),
           "codes": np.array([place[x] for s in sets for x in s], np.int32).tobytes(),
           "ids": np.arange(sum(held)).tobytes(), "years": np.zeros(sum(held), np.int32).tobytes(),
           "held": np.array(held, np.int32).tobytes(), "weights": np.array([3 * h + 1 for h in held], np.int64).tobytes(),
           "bands": np.array([[min(zlib.crc32(f"{k}{x}".encode()) % 97 for x in s) for k in range(4)] for s in sets], np.int64).tobytes()}
    return {f"{prefix}{c}": v for c, v in out.items()}


def sets_of(seed, n, first=0):
    r = random.Random(seed)
    return sorted(({f"s{first + int(V * r.random() ** 1.5)}" for _ in range(r.randrange(1, 12))} for _ in range(n)), key=len)


def search(tests, output, metric="cosine", min_common=1, bands=False, least=None):
    names = sorted({x for s in tests for x in s})
    own = {c: v for c, v in block("", tests, names).items() if c in ("names", "sizes", "codes", "ids") or bands and c == "bands"}
    return nb._Search({"fold": 1, "block": 1, "least": least, **own}, metric, N, min_common, output)


def met(s, train, held=None):
    s.meet(block("t_", train, sorted({x for t in train for x in t}), held))
    return s.result()


@pytest.mark.parametrize("bit", [0.0, 1e9])
@pytest.mark.parametrize("min_common", [1, 3])
def test_tallies(monkeypatch, bit, min_common):
    monkeypatch.setattr(nb, "BIT", bit)                      # bits always, lists always
    tests, train = sets_of(1, 90), sets_of(2, 200, first=5)   # the vocabularies differ; 200 is no multiple of 64
    held = [1 + i % 3 for i in range(len(train))]
    got = met(search(tests, "counts", min_common=min_common), train, held).to_pydict()
    want = [sum(3 * h + 1 for t, h in zip(train, held) if len(s & t) >= min_common) for s in tests]
    assert dict(zip(got["observer_id"], got["n_candidates"])) == {i: w for i, w in enumerate(want) if w}


@pytest.mark.parametrize("bands", [False, True])
@pytest.mark.parametrize("metric", ["cosine", "jaccard"])
def test_bits_and_lists_find_the_same(monkeypatch, metric, bands):
    tests, train = sets_of(3, 120), sets_of(4, 300, first=3)
    held = [1 + i % 4 for i in range(len(train))]
    found = {}
    for bit in (0.0, 1e9):
        monkeypatch.setattr(nb, "BIT", bit)
        for least in (None, np.full(len(tests), 0.3).tobytes()):
            s = search(tests, "neighbors", metric, 1, bands, least)
            found[bit, least is None] = met(s, train, held).to_pylist()
            if bit == 0.0 and least is None and not bands:
                assert s.candidates < 0.75 * sum(bool(a & b) for a in tests for b in train)    # a row's first bound comes before its pairs
    assert found[0.0, True] == found[1e9, True] and found[0.0, False] == found[1e9, False]
    assert len(found[0.0, True]) > len(tests)


def test_wide_sets_are_read_in_parts(monkeypatch):
    """More species than a word, and sets with one species more than a power of two."""
    monkeypatch.setattr(nb, "BIT", 0.0)
    r = random.Random(9)
    train = sorted((set(r.sample([f"s{i}" for i in range(300)], r.choice([8, 9, 17, 33, 64]))) for _ in range(130)), key=len)
    got = {}
    for x in met(search(train, "neighbors"), train).to_pylist():
        got.setdefault(x["observer_id"], []).append((x["nb_observer_id"], x["common"]))
    for i, s in enumerate(train):
        near = sorted((-round(len(s & t) / (len(s) * len(t)) ** 0.5, 9), j, len(s & t)) for j, t in enumerate(train) if s & t)
        assert got[i] == [(j, c) for _, j, c in near[:N]]
