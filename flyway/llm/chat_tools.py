"""Chat formatting: tool calls linked to results, ordered, validated and written as canonical JSON.

Messages are (conv_id, turn, role, content, tool_calls, tool_call_id): ``tool_calls`` is an
array of (id, name, arguments, after), ``arguments`` a JSON text and ``after`` the id of a
call that has to come first; ``tool_call_id`` marks the result of a call.

* Linking: calls and results are reduced to one row per (conversation, id) -- partial
  aggregates, so neither a hot id nor a hot conversation gathers in a task -- and
  hash-joined on that key.
* Order: a call's level is the length of its chain of ``after`` calls, found by pointer
  doubling: each round joins every call to the call its pointer names and doubles the
  pointer's reach, so a chain of n calls takes log2(n) rounds.  Rows are returned sorted by
  (conv_id, level, turn, id), a global range sort.  Calls on or behind a cycle have no level.
* Validation: the arguments must be a JSON object and fit the tool's parameters
  (type, required, least and most length); unknown tools and parameters are errors.
* Canonical JSON: variants hold object keys sorted and no white space, at every depth;
  null fields are left out.
* Texts: every message that is not a result and has content, calls beside it or not, gives a
  ``message`` row of its own (content and role); one without content only if it has no calls.

Everything is built-in DataFrame functions.

Status: ``linked``, ``unanswered`` (call without result), ``orphan`` (result without call),
``cyclic``, ``repeated`` (a call or result whose id another holds, with other content),
``message`` (a text that is not a result, or a call without an id: its JSON has after, arguments,
name and role, and it is validated like any call).

Defined results: of several calls with one id the first by (turn, place, name, arguments)
counts, of several results the first by (turn, content); ``copies`` says how many calls and
results there were.  Those that differ from the first, calls by (name, arguments, after) and
results by content, give one ``repeated`` row per difference, with its first turn and its own ``copies``, at
the first's level and directly before it, so that whoever keeps the last row of an id keeps the
first call.  A null conv_id is a conversation of its own; an ``after`` that names
no call is reported as the error ``after:missing`` and does not move the level; null content
is left out of the JSON; repeated plain messages each give a row; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage

CALLS = "array<struct<id:string,name:string,arguments:string,after:string>>"
SCHEMA = "name string, param string, type string, required boolean, least int, most int"
OUTPUT = ["conv_id", "call_id", "status", "level", "call_turn", "result_turn", "name", "valid",
          "errors", "copies", "json"]
MAY_LACK = {"call_id": "string", "level": "bigint", "call_turn": "bigint", "result_turn": "bigint", "name": "string",
            "valid": "boolean", "errors": "string"}


def link_key(conv_id, call_id) -> Column:
    """One text per (conversation, call id); null without an id."""
    return F.when(call_id.isNotNull(), F.to_json(F.array(
        F.coalesce(conv_id.cast("string"), F.lit("")), conv_id.isNull().cast("string"), call_id)))


def call_levels(calls: DataFrame) -> DataFrame:
    """(key, level) from (key, up): the number of calls before each in its chain; null on cycles."""
    now = cut_lineage(calls.select("key", "up", F.when(F.col("up").isNull(), 0).otherwise(1)
                                   .cast("bigint").alias("level")), "chat-levels")
    n = now.where("up is not null").count()
    for _ in range(math.ceil(math.log2(n + 1)) + 1 if n else 0):
        far = now.select(F.col("key").alias("up"), F.col("up").alias("up2"), F.col("level").alias("more"))
        now = cut_lineage(now.join(far, "up", "left").select(
            "key", F.col("up2").alias("up"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")),
            "chat-levels")
        if not now.where("up is not null").limit(1).count():
            break
    return now.select("key", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def argument_errors(args: Column, params: Column, known: Column) -> Column:
    """Sorted errors of a variant against the tool's parameters."""
    fields = args.cast("map<string,variant>")

    def kind(v: Column) -> Column:
        s = F.schema_of_variant(v)
        return (F.when(s == "STRING", "string").when(s == "BIGINT", "integer")
                .when(s.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "number").when(s == "BOOLEAN", "boolean")
                .when(s.startswith("ARRAY"), "array").when(s.startswith("OBJECT"), "object").otherwise("null"))

    def check(p: Column) -> Column:
        v = F.element_at(fields, p.param)
        k, size = kind(v), F.length(v.cast("string"))
        return (F.when(~F.map_contains_key(fields, p.param),
                       F.when(p.required, F.concat(p.param, F.lit(":missing"))))
                .when((k != p.type) & ~((k == "integer") & (p.type == "number")),
                      F.concat(p.param, F.lit(":type")))
                .when((p.type == "string") & (size < p.least), F.concat(p.param, F.lit(":short")))
                .when((p.type == "string") & (size > p.most), F.concat(p.param, F.lit(":long"))))

    unknown = F.transform(F.array_except(F.map_keys(fields), F.transform(params, lambda p: p.param)),
                          lambda n: F.concat(n, F.lit(":unknown")))
    found = F.concat(F.filter(F.transform(params, check), lambda e: e.isNotNull()), unknown)
    return (F.when(~known, F.array(F.lit("tool:unknown")))
            .when(args.isNull(), F.array(F.lit("arguments:not_json")))
            .when(~F.schema_of_variant(args).startswith("OBJECT"), F.array(F.lit("arguments:not_object")))
            .otherwise(F.array_sort(found)))


def digest(*columns: str) -> Column:
    """SHA-256 of the columns, nulls told from texts."""
    return F.unhex(F.sha2(F.to_json(F.struct(*columns)), 256))


def judged(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """Calls with the variant of their arguments, ``args``, and their errors, ``errs``."""
    return (calls.join(tools, "name", "left").withColumn("args", F.try_parse_json("arguments"))
            .withColumn("errs", F.concat(
                argument_errors(F.col("args"), F.col("params"), F.col("params").isNotNull()),
                F.when(F.col("after").isNotNull() & F.col("there").isNull(),
                       F.array(F.lit("after:missing"))).otherwise(F.array().cast("array<string>")))))


def output_rows(df: DataFrame, **columns) -> DataFrame:
    """The output columns, null where neither given nor there, and those that only sort."""
    empty = {k: F.lit(None).cast(t) for k, t in MAY_LACK.items() if k not in df.columns}
    df = df.withColumns(empty | columns)
    at = {"at_call": F.col("call_turn"), "at_result": F.col("result_turn"), "first": F.lit(True)}
    return df.withColumns({k: v for k, v in at.items() if k not in df.columns}).select(*OUTPUT, *at)


def format_chat(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call, orphan result, differing repeat and message text, in topological order."""
    m = messages.select("conv_id", "turn", "role", "content", "tool_calls", "tool_call_id")
    calls = (m.select("conv_id", "turn", "role", F.posexplode("tool_calls").alias("place", "c"))
             .select("conv_id", "turn", "role", "place", "c.*"))
    named = calls.where("id is not null").withColumn("key", link_key(F.col("conv_id"), F.col("id")))
    said = digest("name", "arguments", "after")
    first = F.min(F.struct(F.coalesce("turn", F.lit((1 << 63) - 1)).alias("t"), "place", "name", "arguments",
                           "after", "turn"))
    one = (named.groupBy("key").agg(F.first("conv_id").alias("conv_id"), F.first("id").alias("call_id"),
                                    first.alias("c"), F.count(F.lit(1)).alias("copies"),
                                    (F.min(said) != F.max(said)).alias("varied"))
           .select("key", "conv_id", "call_id", "copies", "varied", F.col("c.turn").alias("call_turn"), "c.name",
                   "c.arguments", "c.after", link_key(F.col("conv_id"), F.col("c.after")).alias("up")))
    one = cut_lineage(one, "chat-calls")
    there = one.select(F.col("key").alias("up"), F.lit(True).alias("there"))
    one = one.join(there, "up", "left")
    levels = call_levels(one.select("key", F.when(F.col("there"), F.col("up")).alias("up")))

    answered = m.where("tool_call_id is not null").select(
        link_key(F.col("conv_id"), F.col("tool_call_id")).alias("key"), "conv_id", "tool_call_id", "turn", "content")
    told = digest("content")
    results = (answered.groupBy("key").agg(
        F.first("conv_id").alias("r_conv"), F.first("tool_call_id").alias("r_id"),
        F.min(F.struct(F.coalesce("turn", F.lit((1 << 63) - 1)).alias("t"), "content", "turn")).alias("r"),
        F.count(F.lit(1)).alias("r_copies"), (F.min(told) != F.max(told)).alias("r_varied"))
        .select("key", "r_conv", "r_id", "r_copies", "r_varied", F.col("r.turn").alias("result_turn"),
                F.col("r.content").alias("result")))

    tools = schemas.groupBy("name").agg(F.collect_list(F.struct(
        "param", "type", "required", "least", "most")).alias("params"))
    joined = one.join(levels, "key").join(results, "key", "full_outer")
    is_call = F.col("call_id").isNotNull()
    status = (F.when(~is_call, "orphan").when(F.col("level").isNull(), "cyclic")
              .when(F.col("r_copies").isNull(), "unanswered").otherwise("linked"))
    raw = F.when(F.col("args").isNull(), F.col("arguments")).alias("raw_arguments")
    verdict = {"valid": F.size("errs") == 0, "errors": F.array_join("errs", ",")}
    exchanges = output_rows(
        judged(joined, tools).withColumn("errs", F.when(is_call, F.col("errs"))).withColumn("status", status)
        .withColumn("call_id", F.coalesce("call_id", "r_id")),
        conv_id=F.coalesce("conv_id", "r_conv"), **verdict,
        copies=F.coalesce("copies", F.lit(0)) + F.coalesce("r_copies", F.lit(0)),
        json=F.to_json(F.struct(F.col("args").alias("arguments"), F.col("call_id").alias("id"), "name", raw,
                                "result", "status")))

    heads = cut_lineage(joined.where("varied or r_varied").select(
        "key", "level", F.col("call_turn").alias("at_call"), F.col("result_turn").alias("at_result"),
        "varied", "r_varied", F.struct("name", "arguments", "after").alias("head_call"), "result"), "chat-heads")
    held = [F.first(c).alias(c) for c in ("conv_id", "call_id", "level", "at_call", "at_result")]
    repeat = {"status": F.lit("repeated"), "first": F.lit(False)}
    again = (named.withColumnRenamed("id", "call_id").join(heads.where("varied"), "key")
             .where(~F.struct("name", "arguments", "after").eqNullSafe(F.col("head_call")))
             .groupBy("key", "name", "arguments", "after")
             .agg(*held, F.min("turn").alias("call_turn"), F.count(F.lit(1)).alias("copies"))
             .withColumn("up", link_key(F.col("conv_id"), F.col("after"))).join(there, "up", "left"))
    again = output_rows(
        judged(again.withColumns(repeat), tools), **verdict,
        json=F.to_json(F.struct("after", F.col("args").alias("arguments"), F.col("call_id").alias("id"), "name",
                                raw, "status")))
    retold = (answered.withColumnRenamed("tool_call_id", "call_id").join(heads.where("r_varied"), "key")
              .where(~F.col("content").eqNullSafe(F.col("result")))
              .groupBy("key", "content")
              .agg(*held, F.min("turn").alias("result_turn"), F.count(F.lit(1)).alias("copies")))
    retold = output_rows(retold.withColumns(repeat), json=F.to_json(F.struct(
        F.col("call_id").alias("id"), F.col("content").alias("result"), "status")))

    unnamed = (calls.where("id is null").withColumn("up", link_key(F.col("conv_id"), F.col("after")))
               .join(there, "up", "left").withColumn("call_turn", F.col("turn")))
    unnamed = output_rows(
        judged(unnamed, tools), **verdict, status=F.lit("message"), copies=F.lit(1).cast("bigint"),
        json=F.to_json(F.struct("after", F.col("args").alias("arguments"), "name", raw, "role")))
    plain = output_rows(
        m.where("tool_call_id is null and (content is not null or size(coalesce(tool_calls, array())) = 0)"),
        call_turn=F.col("turn"), status=F.lit("message"), copies=F.lit(1).cast("bigint"),
        json=F.to_json(F.struct("content", "role")))
    return (exchanges.unionByName(again).unionByName(retold).unionByName(unnamed).unionByName(plain)
            .orderBy("conv_id", F.col("level").asc_nulls_last(), "at_call", "at_result", "call_id", "first",
                     "call_turn", "result_turn")
            .select(*OUTPUT))


def transcripts(conversations: DataFrame) -> DataFrame:
    """Tool transcripts that a conversation table spells out.

    An assistant turn is a call ``answer`` with its text and turn as arguments, after the call two
    turns earlier; a system turn is a call ``setup``; a user turn is the result of the call
    one turn earlier.  Other roles stay plain messages.  A call's text stands in its arguments
    only, so such a message has no content.
    """
    call = F.struct(
        F.concat(F.lit("c"), F.col("turn")).alias("id"),
        F.when(F.col("role") == "system", "setup").otherwise("answer").alias("name"),
        F.to_json(F.struct("turn", "text")).alias("arguments"),
        F.when((F.col("role") == "assistant") & (F.col("turn") >= 2),
               F.concat(F.lit("c"), F.col("turn") - 2)).alias("after"))
    return conversations.select(
        "conv_id", "turn", "role",
        F.when(F.col("role").isin("assistant", "system"), None).otherwise(F.col("text")).alias("content"),
        F.when(F.col("role").isin("assistant", "system"), F.array(call)).cast(CALLS).alias("tool_calls"),
        F.when(F.col("role") == "user", F.concat(F.lit("c"), F.col("turn") - 1)).alias("tool_call_id"))


def transcript_schemas(spark: SparkSession) -> DataFrame:
    """Parameters of the tools that ``transcripts`` calls."""
    return spark.createDataFrame([
        ("answer", "text", "string", True, 1, 1500), ("answer", "turn", "integer", True, None, None),
        ("setup", "text", "string", True, 40, None), ("setup", "turn", "integer", False, None, None)], SCHEMA)


ORACLE = """
WITH RECURSIVE calls AS (
  SELECT conv_id, turn, 'c' || turn AS call_id, text, CASE role WHEN 'system' THEN 'setup' ELSE 'answer' END AS name,
         CASE WHEN role = 'assistant' AND turn >= 2 THEN turn - 2 END AS after
  FROM conversations WHERE role IN ('assistant', 'system')),
linked AS (SELECT c.*, p.turn AS up FROM calls c LEFT JOIN calls p ON p.conv_id = c.conv_id AND p.turn = c.after),
levels AS (
  SELECT conv_id, turn, 0 AS level FROM linked WHERE up IS NULL
  UNION ALL
  SELECT l.conv_id, l.turn, v.level + 1 FROM linked l JOIN levels v ON v.conv_id = l.conv_id AND v.turn = l.up),
results AS (SELECT conv_id, turn, 'c' || (turn - 1) AS call_id, text FROM conversations WHERE role = 'user'),
joined AS (
  SELECT l.*, v.level, r.turn AS result_turn, r.text AS result,
    concat_ws(',', CASE WHEN l.text IS NULL THEN 'text:missing' WHEN name = 'answer' AND length(l.text) < 1 THEN 'text:short'
                        WHEN name = 'answer' AND length(l.text) > 1500 THEN 'text:long'
                        WHEN name = 'setup' AND length(l.text) < 40 THEN 'text:short' END,
              CASE WHEN l.after IS NOT NULL AND l.up IS NULL THEN 'after:missing' END) AS errors,
    CASE WHEN r.turn IS NULL THEN 'unanswered' ELSE 'linked' END AS status
  FROM linked l JOIN levels v USING (conv_id, turn) LEFT JOIN results r ON r.conv_id = l.conv_id AND r.call_id = l.call_id)
SELECT conv_id, call_id, status, CAST(level AS BIGINT) AS level, turn AS call_turn, result_turn, name,
       errors = '' AS valid, errors, CAST(1 + (result_turn IS NOT NULL)::INT AS BIGINT) AS copies,
       '{"arguments":{' || CASE WHEN text IS NULL THEN '' ELSE '"text":' || to_json(text) || ',' END || '"turn":' || turn
       || '},"id":"' || call_id || '","name":"' || name || '"'
       || CASE WHEN result IS NULL THEN '' ELSE ',"result":' || to_json(result) END || ',"status":"' || status || '"}' AS json
FROM joined
UNION ALL
SELECT r.conv_id, r.call_id, 'orphan', NULL, NULL, r.turn, NULL, NULL, NULL, 1,
       '{"id":"' || r.call_id || '"' || CASE WHEN r.text IS NULL THEN '' ELSE ',"result":' || to_json(r.text) END
       || ',"status":"orphan"}'
FROM results r LEFT JOIN calls c ON c.conv_id = r.conv_id AND c.call_id = r.call_id WHERE c.call_id IS NULL
UNION ALL
SELECT conv_id, NULL, 'message', NULL, turn, NULL, NULL, NULL, NULL, 1,
       '{' || concat_ws(',', '"content":' || to_json(text), '"role":' || to_json(role)) || '}'
FROM conversations WHERE role IS NULL OR role NOT IN ('assistant', 'system', 'user')
"""
