"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

1. Documents are cut into pre-tokens.  A task gathers about ``block_chars`` of text into a
   block and numbers the block's distinct pre-tokens, the most frequent first.  The block
   leaves the task as one row with every document's pre-tokens in position order (packed
   numbers) and, per word shard, one row with its distinct words of that shard.  However
   often a pre-token occurs in a block, it is shuffled once: occurrences are pre-aggregated.
2. The word rows are shuffled by shard (a hash of the word), so equal words of all blocks
   meet in one task, which encodes each distinct word once and joins its ids to every block
   that asked.  A word occurs at most once per block and shard, so no word makes a task hot.
3. Ids go back to their block (the sequences lie in buckets of the block, so they are not
   shuffled again), are set in place of the numbers in position order, and
   decoded by looking each id up in the token-byte table (one entry per vocabulary token).

Memory is bounded by a block (or one document when that is larger) in steps 1 and 3 and by
the distinct words of one shard in step 2; ``words_per_shard`` sets the shard count from
the corpus size.  Everything shuffled is packed: about 1.5 bytes per pre-token.

Defined results: a null text encodes as empty (0 tokens, the digests of nothing); null
doc_ids and repeated rows each give a row; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_bucketed, record_batch, text_chunks

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# Fixed value: the white space of the split pattern's \s.
SPACE = "\t-\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# White space with the text up to the next white space: no pre-token crosses such a piece.
PIECE = f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+"
BLOCK_SCHEMA = ("block bigint, shard int, n bigint, doc_ids array<bigint>, n_words array<bigint>, "
                "packed binary, shards binary")


def pack(values: np.ndarray) -> bytes:
    """32-bit integers as compressed byte planes."""
    v = np.ascontiguousarray(values, np.int32)
    return zstandard.compress(v.view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view(np.int32).ravel()


def pack_words(words: list[bytes]) -> bytes:
    """A list of byte strings: count, packed lengths and joined bytes, compressed."""
    lengths = np.array([len(w) for w in words], np.int32).tobytes()
    return zstandard.compress(len(words).to_bytes(4, "little") + lengths + b"".join(words), 3)


def unpack_words(data: bytes) -> list[bytes]:
    raw = zstandard.decompress(data)
    n = int.from_bytes(raw[:4], "little")
    ends = np.cumsum(np.frombuffer(raw, np.int32, n, 4).astype(np.int64)) + 4 + 4 * n
    out, at = [], 4 + 4 * n
    for end in ends.tolist():
        out.append(raw[at:end])
        at = end
    return out


def block_kernel(pattern: str, shards: int, block_chars: int, block_words: int):
    """mapInArrow: (doc_id, text) -> one sequence row per block and one word row per block and shard."""
    schema = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("n", pa.int64()),
                        ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())),
                        ("packed", pa.binary()), ("shards", pa.binary())])
    find = regex.compile(pattern).findall
    cut = re.compile(PIECE).finditer

    def block_rows(name, doc_ids, sequences, numbers):
        sizes = [len(s) for s in sequences]
        sequence = np.concatenate(sequences) if sizes else np.empty(0, np.int32)
        words = [w.encode() for w in numbers]
        by_use = np.argsort(-np.bincount(sequence, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.int32)
        rank[by_use] = np.arange(len(words))
        shard = np.fromiter((zlib.crc32(words[i]) % shards for i in by_use), np.int32, len(words))
        rows = [(name, -1, len(words), doc_ids, sizes, pack(rank[sequence]), pack(shard))]
        order = np.argsort(shard, kind="stable")
        starts = np.flatnonzero(np.diff(shard[order], prepend=-1))
        for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(order)]):
            rows.append((name, int(shard[order[i]]), j - i, None, None,
                         pack_words([words[by_use[k]] for k in order[i:j]]), None))
        yield record_batch(schema, **dict(zip(schema.names, zip(*rows))))

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        doc_ids, sequences, numbers, memo, held = [], [], {}, {}, 0
        for b in batches:
            ids, at = b.column("doc_id").to_pylist(), 0
            for texts in text_chunks(b.column("text"), 1 << 20):
                for text in texts:
                    out: list[int] = []
                    for m in cut(text):
                        piece = m.group()
                        got = memo.get(piece)
                        if got is None:
                            got = memo[piece] = [numbers.setdefault(w, len(numbers)) for w in find(piece)]
                        out += got
                    doc_ids.append(ids[at])
                    sequences.append(np.array(out, np.int32))
                    at += 1
                    held += len(text) + 64
                    if held >= block_chars or len(numbers) >= block_words:
                        yield from block_rows(block, doc_ids, sequences, numbers)
                        block += 1
                        doc_ids, sequences, numbers, memo, held = [], [], {}, {}, 0
        if doc_ids:
            yield from block_rows(block, doc_ids, sequences, numbers)

    return run


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def encode_kernel(path: str, pattern: str):
    """mapInArrow over word rows sorted by shard: the ids of every block's words, each word encoded once."""
    schema = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("n", pa.int64()),
                        ("sizes", pa.binary()), ("ids", pa.binary())])

    def run(batches):
        encode, now, known = None, None, {}
        for b in batches:
            if encode is None:
                import tiktoken
                encode = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=read_ranks(path),
                                           special_tokens={}).encode_ordinary
            for block, shard, n, packed in zip(*(b.column(c) for c in ("block", "shard", "n", "packed"))):
                if shard.as_py() != now:
                    now, known = shard.as_py(), {}
                found = []
                for w in unpack_words(packed.as_py()):
                    ids = known.get(w)
                    if ids is None:
                        ids = known[w] = np.array(encode(w.decode()), np.int32)
                    found.append(ids)
                yield record_batch(schema, block=[block.as_py()], shard=[now], n=[n.as_py()],
                                   sizes=[pack(np.array([len(x) for x in found]))],
                                   ids=[pack(np.concatenate(found))])

    return run


def gather(start: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Positions start[k] .. start[k] + size[k] - 1 of every k in ``at``, one after the other."""
    n = size[at]
    ends = np.cumsum(n)
    return np.repeat(start[at] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)


def reassemble_kernel(path: str, outputs: bool):
    """cogroup function of one block: sequences and word ids -> documents encoded and decoded."""
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
              ("decoded_sha256", pa.string())]
    if outputs:
        fields += [("ids", pa.list_(pa.int32())), ("decoded", pa.binary())]
    schema = pa.schema(fields)

    def run(block: pa.Table, words: pa.Table) -> pa.Table:
        parts = sorted(zip(words.column("shard").to_pylist(), words.column("sizes").to_pylist(),
                           words.column("ids").to_pylist()))
        table: list[bytes] = []
        if parts:
            table = sorted(ranks := read_ranks(path), key=ranks.get)
        empty = np.empty(0, np.int32)
        sizes = np.concatenate([empty, *(unpack(s) for _, s, _ in parts)]).astype(np.int64)
        ids = np.concatenate([empty, *(unpack(i) for _, _, i in parts)])
        text = [str(i) for i in range(len(table))]
        out = []
        for row in block.to_pylist():
            order = np.argsort(unpack(row["shards"]), kind="stable")
            size, start = np.empty_like(sizes), np.empty_like(sizes)
            size[order], start[order] = sizes, np.cumsum(sizes) - sizes
            sequence, at = unpack(row["packed"]), 0
            for doc_id, n in zip(row["doc_ids"], row["n_words"]):
                mine = ids[gather(start, size, sequence[at:at + n])]
                at += n
                listed = mine.tolist()
                decoded = b"".join([table[i] for i in listed])
                line = ",".join([text[i] for i in listed])
                got = [doc_id, len(listed), hashlib.sha256(line.encode()).hexdigest(),
                       hashlib.sha256(decoded).hexdigest()]
                out.append([*got, listed, decoded] if outputs else got)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)],
                                    schema=schema)

    return run


def bpe_round_trip(docs: DataFrame, vocabulary: str | None = None,
                   pattern: str = public_tokenizers.PATTERN, block_chars: int = 1 << 24,
                   block_words: int = 1 << 18, words_per_shard: int = 1 << 16,
                   outputs: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) of every document.

    ``vocabulary``: a rank file that every executor can open.  ``block_chars`` and
    ``block_words`` bound a block; a block of text has about one distinct word per 64
    characters, from which ``words_per_shard`` sets the number of shards (16 to 16384).
    ``outputs`` adds the ids and the decoded bytes themselves.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    chars = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = int(min(max(chars // (64 * words_per_shard), 16), 1 << 14))
    rows = cut_bucketed(texts.mapInArrow(block_kernel(pattern, shards, block_chars, block_words), BLOCK_SCHEMA)
                        .withColumn("kind", F.when(F.col("shard") < 0, "sequence").otherwise("word")),
                        "bpe_blocks", "block", "kind")
    words = (rows.where("kind = 'word'").select("block", "shard", "n", "packed")
             .repartition("shard").sortWithinPartitions("shard")
             .mapInArrow(encode_kernel(path, pattern),
                         "block bigint, shard int, n bigint, sizes binary, ids binary"))
    blocks = rows.where("kind = 'sequence'").select("block", "doc_ids", "n_words", "packed", "shards")
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return (blocks.groupBy("block").cogroup(words.groupBy("block"))
            .applyInArrow(reassemble_kernel(path, outputs),
                          schema + (", ids array<int>, decoded binary" if outputs else "")))
