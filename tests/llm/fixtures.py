"""Small documents with the awkward cases: nulls, empty and long texts, ties, repeats, clashing names."""

import random

DOC_SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
              "fp bigint, digest string, n_tokens string, value int")


def texts(seed=3, n=60):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefgé ") for _ in range(r.randint(1, 7))).replace(" ", "")
             or "x" for _ in range(200)]
    out = []
    for _ in range(n):
        words = [r.choice(vocab) for _ in range(r.choice([1, 2, 3, 5, 40, 80, 200]))]
        out.append(" ".join(words))
    for i in range(0, n, 3):                       # near copies: one word changed
        w = out[i].split()
        w[r.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    out += out[:5]                                 # exact copies
    out += ["", None, " \n\t ", "One", "A b", "É é \x1c x\x0by", "tabs\tand\nlines\n\nlines\nlines",
            "long " * 5000 + "tail", "x" * 20000, "<|endoftext|> a<|endoftext|>b", "  spaces   　 end  "]
    return out


def documents(spark, seed=3):
    rows = [(i, t, "en", f"s{i % 4}" if i % 7 else None, len(t or ""), i, "d", "n", 1)
            for i, t in enumerate(texts(seed))]
    rows += [rows[2], rows[2], (None, rows[4][1], None, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOC_SCHEMA), rows


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
