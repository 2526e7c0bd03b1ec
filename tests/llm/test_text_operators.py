"""Token counts, SimHash and quality rules against plain per-document code."""

import re
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash

from flyway.llm import quality_rules as Q
from flyway.llm import simhash as S
from flyway.llm.common import fresh_path, table
from flyway.llm.token_counts import token_counts

from . import fixtures as X

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def test_token_counts(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs, rows = X.documents(spark)
    cache = fresh_path(spark, "cache")
    expect = sorted((-1 if r[0] is None else r[0], len((r[1] or "").encode()),
                     len(t.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    for _ in range(2):                               # the second call finds every digest stored
        got = token_counts(docs, cache, limit=100).collect()
        assert sorted((-1 if g.doc_id is None else g.doc_id, g.n_bytes, g.n_tokens) for g in got) == expect
        assert all(g.over_limit == (g.n_tokens > 100) for g in got)
        assert spark.read.parquet(cache).count() == len({r[1] or "" for r in rows})
    assert token_counts(X.empty(spark), fresh_path(spark, "cache")).count() == 0


def test_token_cache_is_read_and_told_apart(spark):
    docs = spark.createDataFrame([(1, "one two three")], "doc_id bigint, text string")
    cache = fresh_path(spark, "cache")
    first = token_counts(docs, cache).first().n_tokens
    other = token_counts(docs, cache, tokenizer=public_tokenizers.path("piece_bpe_32k.model")).first()
    import sentencepiece
    p = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert other.n_tokens == len(p.encode("one two three")) and first == 3
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2


def plain_fingerprint(text, shingle=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    sh = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, radius):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= radius:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {f: find(f) for f in parent}


def check_simhash(got, rows):
    fps = {(r[0], r[1]): plain_fingerprint(r[1]) for r in rows}
    root = plain_components(set(fps.values()), 2)
    least = {}
    for (d, _), f in fps.items():
        if d is not None:
            least[root[f]] = min(least.get(root[f], d), d)
    expect = sorted((str(r[0]), f"{fps[r[0], r[1]]:016x}", str(least.get(root[fps[r[0], r[1]]]))) for r in rows)
    assert sorted((str(g.doc_id), g.fingerprint, str(g.component_id)) for g in got) == expect


def test_simhash_fixture(spark):
    docs, rows = X.documents(spark)
    check_simhash(S.simhash_near_dedup(docs).collect(), rows)
    assert S.simhash_near_dedup(X.empty(spark)).count() == 0


def test_simhash_table(spark):
    docs = table(spark, SF, "documents")
    check_simhash(S.simhash_near_dedup(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_routed_bk_trees_find_every_link(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base:                                   # chains and clouds of close fingerprints
        f = int(b)
        for _ in range(30):
            for bit in rng.integers(0, 64, rng.integers(1, 4)):
                f ^= 1 << int(bit)
            fps.add(f)
    fps = np.array(sorted(fps), np.uint64)
    expect = plain_components([int(f) for f in fps], radius)
    parent = np.arange(len(fps))
    for m in S.block_masks(radius):
        tree = fps & np.uint64(m % (1 << 64))
        roots, codes, children = S.bk_trees(fps, tree)
        root = roots[np.unique(tree, return_inverse=True)[1]]
        rows = np.arange(len(fps))
        parent = S.contract(parent, *S.probe(fps, rows, root, codes, children, radius))
    assert {int(f): int(fps[p]) for f, p in zip(fps, parent)} == expect


def plain_statistics(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    rep = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)} \
        if len(w) < 500 else (set(range(len(w))) if len(set(windows)) < 3 else set())
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(rep))


def test_rule_statistics(spark):
    docs, rows = X.documents(spark)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 9) for i in range(40)] + [(None, 1, 1), (3, None, 1)],
                                   "doc_id bigint, quality int, text int")
    got = Q.quality_rules(docs, labels).collect()
    names = Q.STATS[:5]
    def key(d, s): return (-1 if d is None else d, *s)
    plain = sorted(key(r[0], plain_statistics(r[1])) for r in rows if "tail" not in (r[1] or ""))
    mine = sorted(key(g.doc_id, [g[c] for c in names]) for g in got if g.n_words != 5001)
    assert mine == plain
    long = next(g for g in got if g.n_words == 5001)
    assert long.n_repeat_words == 5000
    for g in got:
        assert g.base_failed == (g.n_words < 50 or 100 * g.n_repeat_words > 50 * g.n_words)
        assert g.kept == (not g.base_failed and g.anomaly < g.threshold)
    nothing = Q.quality_rules(docs, labels.limit(0)).collect()
    assert all(g.kept == (not g.base_failed) for g in nothing) and len(nothing) == len(rows)
    assert Q.quality_rules(X.empty(spark), labels).count() == 0


def test_verdict_separates_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    got = Q.quality_rules(table(spark, sf, "documents"), labels).join(labels, "doc_id").collect()
    passed = [g for g in got if not g.base_failed]
    good, bad = [g for g in passed if g.quality == 1], [g for g in passed if g.quality == 0]
    assert sum(g.kept for g in good) >= 0.99 * len(good)
    assert sum(not g.kept for g in bad) >= 0.8 * len(bad)


def test_forest_isolates_an_outlier():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (500, 3)), [[9.0, 9.0, 9.0]]])
    s = Q.forest_scores(Q.grow_forest(x, 100, 256, 7), x)
    assert s[-1] == s.max() and s[-1] > 0.7 and np.median(s) < 0.55
