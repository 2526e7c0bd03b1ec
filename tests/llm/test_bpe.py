"""Byte-level BPE against the library on whole texts, and an exact round trip."""

import hashlib

import public_tokenizers as P
import tiktoken

from flyway.llm import bpe as B
from flyway.llm.common import table

from . import fixtures as X


def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.read_ranks(P.path(B.VOCABULARY)),
                             special_tokens={})


def expected(rows):
    enc, out = library(), []
    for d, t in rows:
        ids = enc.encode_ordinary(t or "")
        out.append((str(d), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect())


def test_awkward_texts(spark):
    docs, rows = X.documents(spark)
    assert got(B.bpe_round_trip(docs)) == expected([r[:2] for r in rows])
    assert B.bpe_round_trip(X.empty(spark)).count() == 0
    small = B.bpe_round_trip(docs, block_chars=300, block_words=20, outputs=True)   # many blocks
    assert got(small) == expected([r[:2] for r in rows])
    for r in small.where("doc_id = 4").collect():
        assert library().decode_bytes(r.ids) == bytes(r.decoded)


def test_white_space_and_marks(spark):
    import random
    r = random.Random(5)
    alphabet = "ab'sté1٣ \n\t\r\x0b\x0c\x1c\x1f\x85\xa0   　᠎​!.👍́中ſ"
    rows = [(i, "".join(r.choice(alphabet) for _ in range(r.randint(0, 60)))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(B.bpe_round_trip(docs, block_words=500)) == expected(rows)


def test_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert got(B.bpe_round_trip(docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_packing():
    import numpy as np
    for n in (0, 1, 1000):
        v = np.random.default_rng(n).integers(0, 1 << 30, n).astype(np.int32)
        assert (B.unpack(B.pack(v)) == v).all()
        w = [bytes(x) for x in np.random.default_rng(n).integers(0, 256, (n, 5), dtype=np.uint8)]
        assert B.unpack_words(B.pack_words(w)) == w
