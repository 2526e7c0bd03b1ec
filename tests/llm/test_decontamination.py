"""Benchmark decontamination against a plain search for every window in every text."""

import hashlib
import random
import re

from flyway.llm.decontamination import decontaminate

from . import fixtures

ITEMS = "item_id bigint, text string, doc_id bigint, words string, size int, n bigint"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def plain(docs, items, window):
    out = []
    for doc_id, text, *_ in docs:
        words, hit, found = words_of(text), set(), set()
        for item, body, *_ in items:
            own = words_of(body)
            n = min(window, len(own))
            for i in range(len(own) - n + 1 if n else 0):
                for at in range(len(words) - n + 1):
                    if words[at:at + n] == own[i:i + n]:
                        hit |= set(range(at, at + n))
                        found |= {item} - {None}
        ids = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, **how):
    got = decontaminate(docs, items, **how)
    return sorted(map(tuple, got.drop("items").collect()), key=str)


def cases(seed=5):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(12)] + ["É", "ß1", "x"]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, say(r.choice([12, 15, 30])), i, "w", 1, 2) for i in range(10)]
    items += [(20, "One", 1, "w", 1, 1), (21, "w1 x W2", 1, "w", 1, 1), (22, say(5), 1, "w", 1, 1), (23, say(9), 1, "w", 1, 1),
              (24, None, 1, "w", 1, 1), (25, " \n--", 1, "w", 1, 1), (26, items[0][1], 1, "w", 1, 1),
              (26, items[3][1], 1, "w", 1, 1), (None, say(10), 1, "w", 1, 1), (27, "w3 " * 40, 1, "w", 1, 1)]
    docs = []
    for i in range(40):
        text = say(r.choice([0, 3, 9, 40]))
        for _ in range(r.choice([0, 1, 2])):
            own = items[r.randrange(len(items))][1] or ""
            cut = own.split()
            low = r.randrange(len(cut) + 1)
            text += r.choice([" ", "\n", "-,"]) + r.choice([own, own.upper(), " ".join(cut[low:])]) + " " + say(r.choice([0, 7]))
        docs.append((i, text, "en", "s", 1, 2, "d", "n", 3))
    docs += [docs[4], docs[4], (None, docs[5][1], None, None, None, None, None, None, None),
             (None,) * 9, (90, "w3 " * 3000, "", "", 1, 1, "", "", 1), (91, "", "", "", 1, 1, "", "", 1)]
    return docs, items


def test_equals_plain_search(spark):
    docs, items = cases()
    d, b = spark.createDataFrame(docs, fixtures.DOC_SCHEMA), spark.createDataFrame(items, ITEMS)
    want = plain(docs, items, 10)
    assert run(spark, d, b) == want
    assert any(x[-1] for x in want) and not all(x[-1] for x in want)
    assert run(spark, d, b, batch_words=50, bitmap_bits=6) == want          # a full bitmap only costs time
    assert run(spark, d, b, window=4, shingle=2) == plain(docs, items, 4)


def test_empty_tables(spark):
    docs, items = cases()
    d, b = spark.createDataFrame(docs, fixtures.DOC_SCHEMA), spark.createDataFrame(items, ITEMS)
    assert run(spark, fixtures.empty(spark), b) == []
    none = run(spark, d, spark.createDataFrame([], ITEMS))
    assert len(none) == len(docs) and not any(x[-1] for x in none)
    assert {x[4] for x in none} == {hashlib.sha256(b"").hexdigest()}


def test_item_ids(spark):
    docs, items = cases()
    d, b = spark.createDataFrame(docs, fixtures.DOC_SCHEMA), spark.createDataFrame(items, ITEMS)
    for r in decontaminate(d, b).collect():
        assert r["items"] == sorted(r["items"]) and len(r["items"]) == r["n_items"]
