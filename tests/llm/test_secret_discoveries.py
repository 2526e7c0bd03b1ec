"""Random keys planted among identifiers, UUIDs, paths and dates: recall and false reports."""

import random
import re
import string
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from flyway.llm import secret_scan as S
from flyway.llm.common import bounded_sample, table

SF = "/root/testdata/sf0.01"
CODE = ("get set user account order total value index cache buffer reader writer handler service manager request response "
        "item list map from with for by name count update delete create session token format parse config path").split()


def structured_strings(r, words, n):
    """Identifiers and the like, 20 characters or more, letters and digits mixed."""
    out = []
    while len(out) < n:
        pick = [r.choice(words) for _ in range(r.randint(2, 6))]
        out.append(r.choice([
            pick[0] + "".join(w.title() for w in pick[1:]) + str(r.randrange(100)),
            "_".join(pick) + f"_{r.randrange(1000)}", "-".join(pick) + f"-v{r.randrange(9)}", "_".join(pick).upper() + "_2",
            "/".join(pick) + f"/{r.randint(1990, 2026)}", str(uuid.UUID(int=r.getrandbits(128))),
            f"{r.randint(1990, 2026)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}T{r.randrange(24):02}-{r.randrange(60):02}-10Z",
            "usr/lib/python3/" + "/".join(pick)]))
        if len(out[-1]) < 20 or not re.search("[0-9]", out[-1]):
            out.pop()
    return out


def keys(r, n):
    """Random strings of 20 to 64 characters over the encodings, none of which the base patterns take."""
    out = []
    while len(out) < n:
        alphabet = r.choice([S.UPPER + S.LOWER + S.DIGITS, S.UPPER + S.LOWER + S.DIGITS + "+/", S.UPPER + "234567",
                             S.DIGITS + S.LOWER, S.UPPER + S.LOWER + S.DIGITS + "-_"])
        k = "".join(r.choice(alphabet) for _ in range(r.choice([20, 24, 32, 40, 64])))
        if re.search("[0-9]", k) and k[0].isalnum() and k[-1].isalnum() and not S.base_spans(k):
            out.append(k)
    return out


@pytest.mark.parametrize("n_keys", [300, 12, 0])
def test_planted_keys_and_false_reports(spark, n_keys):
    r = random.Random(n_keys)
    docs = table(spark, SF, "documents").select("doc_id", "text")
    own = [w for t in docs.limit(60).collect() for w in re.findall("[a-z]{3,9}", t.text)]
    plain = structured_strings(r, own[:4000], 1500) + structured_strings(r, CODE, 1500)
    secret = keys(r, n_keys)
    rows = [(10 ** 6 + i, f"see {w} there") for i, w in enumerate(plain)] + [(2 * 10 ** 6 + i, f"é {w} x") for i, w in enumerate(secret)]
    got = {x.doc_id: x.spans for x in S.secret_spans(docs.unionAll(spark.createDataFrame(rows, docs.schema)))
           .where("doc_id >= 1000000").collect()}
    base = {i: S.base_spans(t) for i, t in rows}
    false = [t for i, t in rows if i < 2 * 10 ** 6 and "random:" in got[i]]
    true = [i for i, t in rows if i >= 2 * 10 ** 6 and f"random:2:{2 + len(t) - 4}" in got[i]]
    assert not any(base[i] for i, _ in rows if i >= 2 * 10 ** 6)
    if n_keys:
        assert len(true) >= 0.9 * n_keys, (len(true), n_keys)
    assert len(false) <= max(3, 0.02 * len(true)), false[:20]


def plain_level(ps, lengths, alpha):
    """Benjamini-Hochberg by the book, p-values weighed by length, to the histogram's hundredth of a decade."""
    mean = np.mean(lengths)
    w = np.sort(10 ** -(np.floor(-np.log10(np.clip(np.array(ps) * mean / np.array(lengths), 1e-300, 1)) * 100) / 100))
    good = np.flatnonzero(w <= alpha * (np.searchsorted(w, w, side="right")) / len(w))
    return mean, w[good[-1]] if len(good) else 0.0


def test_level_equals_plain_procedure(spark):
    r = random.Random(2)
    ps = [10 ** -r.uniform(0, 30) if r.random() < 0.2 else r.random() for _ in range(800)]
    lengths = [r.randint(20, 90) for _ in ps]
    rows = [(i, [(0, 3, n, p), (0, 1, 5, None)]) for i, (p, n) in enumerate(zip(ps, lengths))]
    found = spark.createDataFrame(rows, "doc_id long, spans array<struct<start int, kind int, end int, p double>>")
    for alpha in (0.001, 0.01, 0.2):
        assert S.discovery_level(found, alpha) == pytest.approx(plain_level(ps, lengths, alpha), rel=1e-9)
    assert S.discovery_level(found.where(F.lit(False)), 0.01) == (1.0, 0.0)


def test_structured_is_a_p_value(spark):
    """Strings drawn from the model itself have p-values below x no more often than x."""
    letters = S.letter_model(table(spark, SF, "documents"))
    p = 2.0 ** letters[:, 1:]
    assert np.allclose(p.sum(axis=1), 1)
    r = np.random.default_rng(5)
    drawn = []
    for _ in range(4000):
        kind, before, word = None, 0, ""
        for _ in range(24):
            now = r.choice(4, p=S.FIRST if kind is None else S.SWITCH[kind])
            if now < 2:
                at = 1 + r.choice(26, p=p[0 if now == 1 and kind == 0 else before])
                word += (string.ascii_lowercase if now == 0 else string.ascii_uppercase)[at - 1]
            else:
                at = 0
                word += r.choice(list(S.CLASSES[now]))
            kind, before = now, at
        drawn.append(S.structured(word, letters))
    for x in (0.1, 0.01, 0.001):
        assert np.mean(np.array(drawn) <= x) <= 1.5 * x + 0.001


def test_bounded_sample_of_equal_rows(spark):
    df = spark.range(5000).select(F.lit(7).alias("v"), F.xxhash64(F.lit(7)).alias("salt"))
    assert bounded_sample(df, "salt", 1000).count() == 1000
    mixed = df.unionAll(spark.range(300).select("id", F.xxhash64("id")))
    a, b = (sorted(map(tuple, bounded_sample(x, "salt", 1000).collect())) for x in (mixed, mixed.repartition(9)))
    assert a == b and len(a) == 1000
    assert bounded_sample(df.limit(10), "salt", 1000).count() == 10
