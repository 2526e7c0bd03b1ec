"""Token counts through a digest cache.

A text's normalised content (null becomes the empty text; nothing else may be
folded, as any change of a character can change its tokens) is named by its
SHA-256, a tokenizer by the SHA-256 of its vocabulary file and library version.
The cache is a Parquet table ``(digest, n_tokens)`` partitioned by tokenizer
digest.  One call

1. keeps one text per digest (partial ``first`` before the shuffle, so a group of
   copies sends one text per task),
2. joins the digests to the stored counts (left anti, on the partitioning of step 1)
   and encodes the misses with the library,
3. appends the new counts to the cache, and
4. joins the counts back to the narrow ``(doc_id, n_bytes, digest)`` rows.

Texts move only in step 1 and only once; the joins move digests.  A digest that
holds a third of all rows meets a unique cache row, and AQE splits its partition.

Defined results: a null text counts as the empty text (0 bytes, 0 tokens); a null
doc_id or repeated rows give one row each; an empty table gives no rows; extra
columns are ignored.  Appends are not transactional across writers: let one job at
a time write a cache folder.
"""

from __future__ import annotations

import hashlib
import os

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_or_empty, record_batch, text_chunks

CACHE_SCHEMA = "digest binary, n_tokens bigint, tokenizer string"
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_digest(path: str) -> str:
    """Names file content, library and library version: another tokenizer never reuses a count."""
    import importlib.metadata
    library = "tokenizers" if path.endswith(".json") else "sentencepiece"
    h = hashlib.sha256(f"{library} {importlib.metadata.version(library)}\n".encode())
    with open(path, "rb") as f:
        h.update(f.read())
    return h.hexdigest()


def count_kernel(path: str, batch_bytes: int):
    """mapInArrow function (digest, text) -> (digest, n_tokens) by the tokenizer's own library."""
    schema = pa.schema([("digest", pa.binary()), ("n_tokens", pa.int64())])

    def load():
        if path.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            return lambda texts: [len(e) for e in
                                  t.encode_batch_fast(texts, add_special_tokens=False)]
        import sentencepiece
        p = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in p.encode(texts, num_threads=1)]

    def run(batches):
        count = None
        for b in batches:
            count = count or load()
            n = []
            for texts in text_chunks(b.column("text"), batch_bytes):
                n += count(texts)
            yield record_batch(schema, digest=b.column("digest"), n_tokens=n)

    return run


def token_counts(docs: DataFrame, cache: str, tokenizer: str | None = None,
                 limit: int = 1024, batch_bytes: int = 1 << 18) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document, by way of the cache folder.

    ``tokenizer``: path of a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file that
    every executor can open; ``batch_bytes`` bounds what one library call holds.
    """
    spark = docs.sparkSession
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    name = tokenizer_digest(path)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"),
                        F.unhex(F.sha2(text, 256)).alias("digest"))

    def stored() -> DataFrame:
        return (read_or_empty(spark, cache, CACHE_SCHEMA)
                .where(F.col("tokenizer") == name).select("digest", "n_tokens"))

    misses = (keyed.groupBy("digest").agg(F.first("text").alias("text"))
              .join(stored(), "digest", "left_anti"))
    new = misses.mapInArrow(count_kernel(path, batch_bytes), "digest binary, n_tokens bigint")
    (new.withColumn("tokenizer", F.lit(name))
        .write.mode("append").partitionBy("tokenizer").parquet(cache))
    return (keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
            .join(stored(), "digest", "left")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
