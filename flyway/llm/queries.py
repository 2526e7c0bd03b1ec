"""Registered queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import bpe_round_trip
from .common import fresh_path, table
from . import chat_tools, decontamination, mixing, prefix_trie, spelling, topk_search
from .quality_fm import quality_scores
from .quality_rules import quality_rules
from .secret_scan import secret_spans
from .simhash import simhash_near_dedup
from .token_counts import token_counts
from .warc import read_warc, write_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_token_counts")
def op1(spark, sf):
    return token_counts(table(spark, sf, "documents"), cache=fresh_path(spark, "token-cache"))


@register("op4_quality_rules")
def op4(spark, sf):
    return (quality_rules(table(spark, sf, "documents"), table(spark, sf, "labels"))
            .drop("threshold"))


@register("op2_simhash_near_dedup")
def op2(spark, sf):
    return (simhash_near_dedup(table(spark, sf, "documents"), shingle=3, max_bits=2)
            .drop("component_key"))


@register("op6_source_mixing", mixing.ORACLE)
def op6(spark, sf):
    return mixing.mix_sources(table(spark, sf, "documents")).drop("source", "passes")


@register("op5_byte_bpe")
def op5(spark, sf):
    return bpe_round_trip(table(spark, sf, "documents"))


@register("op3_quality_fm")
def op3(spark, sf):
    return quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register("op8_secret_scan")
def op8(spark, sf):
    return secret_spans(table(spark, sf, "documents"))


@register("op7_warc", r"""
SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN last END AS refers_to
FROM (SELECT *, strlen(coalesce(html, '')) >= 1000 AND last IS NOT NULL
               AND (page_id IS NULL OR page_id < last) AS revisit
      FROM (SELECT *, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages))
""")
def op7(spark, sf):
    path = fresh_path(spark, "warc")
    write_warc(table(spark, sf, "pages"), path)
    return read_warc(spark, path)


@register("op9_topk_inner_products", topk_search.ORACLE)
def op9(spark, sf):
    return topk_search.top_inner_products(table(spark, sf, "embeddings"))


@register("op10_chat_tools", chat_tools.ORACLE)
def op10(spark, sf):
    return chat_tools.format_chat(chat_tools.transcripts(table(spark, sf, "conversations")),
                                  chat_tools.transcript_schemas(spark))


@register("op11_prefix_trie", prefix_trie.ORACLE)
def op11(spark, sf):
    return prefix_trie.prefix_trie(*prefix_trie.rebuild(table(spark, sf, "conversations")))


@register("op12_spelling_variants", spelling.ORACLE)
def op12(spark, sf):
    return spelling.spelling_variants(table(spark, sf, "documents"))


@register("op13_decontamination", decontamination.ORACLE)
def op13(spark, sf):
    return decontamination.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("items")
