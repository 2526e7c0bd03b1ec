"""The conversation trie against a plain trie, and tree contraction against recursion."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from flyway.llm.prefix_trie import prefix_trie, rebuild, subtree_sums

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, id string, a bigint, words bigint, parent int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rows(seed=2, n=130):
    r, out = random.Random(seed), []
    for c in range(n):
        if c % 11 == 3:
            continue
        for t in range(r.choice([1, 1, 2, 3, 4, 6])):
            out.append((c, t, r.choice(["user", "tool"]), r.choice(["a", "a b", "c\x0bd e", ""]), 7, "x", 1, 2, 3))
    out += [(500, None, None, None, 1, "x", 1, 1, 1), (500, 3, "user", None, 1, "x", 1, 1, 1), (501, 1, "", "", 1, "x", 1, 1, 1),
            (None, 1, "user", "lost", 1, "x", 1, 1, 1), (-7, 2, "user", "minus", 1, "x", 1, 1, 1)]
    out += [(520, 5, "user", "same", 1, "x", 1, 1, 1)] * 3                  # repeated rows
    out += [(600, t, "user", f"long {t}", 1, "x", 1, 1, 1) for t in range(90)]
    out += [(600 + 20 * k, t, "user", f"long {t}", 1, "x", 1, 1, 1) for k in (1, 2) for t in range(70)]
    return out


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def plain(data):
    convs = {}
    for c, turn, role, text, *_ in data:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append(((turn is not None, turn or 0, digest(role, text)), role, text))
    for c in convs:
        convs[c] = [x[1:] for x in sorted(convs[c], key=lambda x: x[0])]
    made = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        made[c] = convs.get(base, [])[:h] + own[h:]
    trie = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            trie.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for p in trie:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out = []

    def total(p):
        words = len([w for w in "".join(" " if ch in "\t\n\x0b\x0c\r " else ch for ch in p[-1][1]).split(" ") if w]) if p else 0
        leaves, saved = int(p not in kids), (len(trie[p]) - 1) * words
        for k in kids.get(p, []):
            a, b = total(k)
            leaves, saved = leaves + a, saved + b
        ends = ",".join(map(str, sorted(c for c in trie[p] if len(made[c]) == len(p))))
        out.append((min(trie[p]), len(p), min(trie[p[:-1]]) if p else None, len(trie[p]), len(kids.get(p, [])),
                    leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    if made:
        total(())
    return sorted(out, key=str)


@pytest.mark.parametrize("part", [1024, 4])
def test_equals_plain_trie(spark, part):
    data = rows()
    got = prefix_trie(*rebuild(spark.createDataFrame(data, SCHEMA)), part=part)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == plain(data)


def test_empty_and_turnless(spark):
    assert prefix_trie(*rebuild(spark.createDataFrame([], SCHEMA))).count() == 0
    c = next(i for i in range(1000, 2000) if i % 20 and zlib.crc32(str(i).encode()) % 4)   # its only turn is dropped
    data = [(c, 1, "user", "gone", 1, "x", 1, 1, 1)]
    got = prefix_trie(*rebuild(spark.createDataFrame(data, SCHEMA))).collect()
    assert [tuple(r) for r in got] == plain(data) and len(got) == 1


def test_subtree_sums_of_a_forest(spark):
    r = random.Random(1)
    parent = {0: None, 1: None}
    for i in range(2, 300):
        parent[i] = i - 1 if i < 60 else r.randrange(i) if i % 3 else i - 1
    value = {i: r.randrange(100) for i in parent}
    want = dict(value)
    for i in sorted(parent, reverse=True):
        if parent[i] is not None:
            want[parent[i]] += want[i]
    nodes = spark.createDataFrame([(i, p, value[i]) for i, p in parent.items()], "id bigint, parent bigint, v bigint")
    assert dict(map(tuple, subtree_sums(nodes, "v").collect())) == want
    assert subtree_sums(nodes.where(F.lit(False)), "v").count() == 0
