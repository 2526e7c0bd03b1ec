"""Spelling variants against every pair of words, and the index against plain search."""

import random
import re
import zlib
from collections import Counter

import pytest

from flyway.llm.spelling import FMIndex, near_words, one_error_search, roots, spelling_variants, vocabulary

from . import fixtures

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    """One code point inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
    return (a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:] if len(a) < len(b) else a[i + 1:] == b[i:])


def plain_words(docs, modulus=199):
    n = Counter()
    for doc_id, text, *_ in docs:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % modulus == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def plain(words):
    forms, out = {}, []
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        forms[w] = (best if best and words[best] >= 5 * n else None, len(others))
    for w, n in words.items():
        end = w
        while forms[end][0]:
            end = forms[end][0]
        out.append((w, n, forms[w][1], forms[w][0], words.get(forms[w][0]), end))
    return sorted(out, key=str)


def vocabulary_of(seed, n=300):
    r = random.Random(seed)
    words = {"".join(r.choice("abcé") for _ in range(r.randint(6, 11))): r.choice([5, 6, 30, 200, 4000]) for _ in range(n)}
    for w in list(words)[::2]:
        at, c = r.randrange(len(w)), r.choice("abcÿ×")
        for x in (w[:at] + c + w[at:], w[:at] + c + w[at + 1:], w[:at] + w[at + 1:]):
            if len(x) >= 6:
                words.setdefault(x, r.choice([5, 7, 150]))
    words |= {"a" * k: 5 + k for k in range(6, 30)}
    return words


@pytest.mark.parametrize("seed,shard_words", [(1, 1 << 14), (2, 40), (3, 7)])
def test_near_words_equal_all_pairs(spark, seed, shard_words):
    words = vocabulary_of(seed)
    got = near_words(spark.createDataFrame(list(words.items()), "word string, n bigint"), shard_words, block=50)
    want = {}
    for w in words:
        others = [x for x in words if near(w, x)]
        if others:
            best = min(others, key=lambda x: (-words[x], x))
            want[w] = (len(others), words[best], best)
    assert {r["word"]: (r["n_near"], r["form_n"], r["form"]) for r in got.collect()} == want


def test_index():
    words = [w.encode("latin-1") for w in sorted(vocabulary_of(4))]
    random.Random(1).shuffle(words)
    index = FMIndex(words)
    rows = index.rows
    assert all(index.text[a:].tobytes() < index.text[b:].tobytes() for a, b in zip(rows, rows[1:]))
    found = one_error_search(index, words, [len(w) - len(w) // 2 for w in words]).T.tolist()
    want = [[i, j] for i, a in enumerate(words) for j, b in enumerate(words)
            if near(a, b) and a[len(a) // 2:] == b[len(b) - len(a) + len(a) // 2:]]
    assert sorted(found) == want


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("x", "w3"), ("y", "z")]
    got = dict(map(tuple, roots(spark.createDataFrame(chain, "word string, form string")).collect()))
    assert got == {f"w{i}": "w37" for i in range(37)} | {"x": "w37", "y": "z"}


def corpus():
    r = random.Random(8)
    words = list(vocabulary_of(5, 60)) + ["Kürzlich", "kürzlich", "KÜRZLICH", "naïveté", "tiny"]
    docs = [(i, " ".join(r.choice(words[:r.choice([10, 90, len(words)])]).title() if i % 3 else r.choice(words) + "łx1"
                         for _ in range(r.choice([0, 5, 200]))), "en", "s", 1, 2, "d", "n", 3) for i in range(90)]
    docs += [docs[3], docs[3], (None, docs[5][1], None, None, None, None, None, None, None), (None,) * 9,
             (91, "long" * 3000 + " " + ("x" * 400 + " ") * 6 + ("x" * 401 + "-") * 40, "", "", 1, 1, "", "", 1)]
    return docs


def test_equals_brute_force(spark):
    docs = corpus()
    d = spark.createDataFrame(docs, fixtures.DOC_SCHEMA)
    words = plain_words(docs)
    assert dict(map(tuple, vocabulary(d, held_words=20).collect())) == words
    want = plain(words)
    got = spelling_variants(d, shard_words=50)
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert any(x[3] for x in want) and any(x[5] not in (x[0], x[3]) for x in plain(vocabulary_of(1)))


def test_damaged_runs(spark):
    docs = corpus()
    d = spark.createDataFrame(docs, fixtures.DOC_SCHEMA)
    assert dict(map(tuple, vocabulary(d, modulus=3).collect())) == plain_words(docs, 3)


def test_empty(spark):
    assert spelling_variants(fixtures.empty(spark)).count() == 0
    one = spark.createDataFrame([(1, "single " * 5)], "doc_id bigint, text string")
    assert [tuple(r) for r in spelling_variants(one).collect()] in ([("single", 5, 0, None, None, "single")], [])
