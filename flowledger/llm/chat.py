"""Chat formatting: tool calls linked to results, ordered, validated and written as canonical JSON.

Results meet calls in a hash join on their identifier, each side reduced to one row per identifier first,
so repeated calls and results of one identifier never multiply; what is built in memory there are identifiers
without texts, one per call, and texts follow in joins that can spill. A call may name the call it follows; its depth
(the number of calls before it) comes from pointer doubling, so a chain of n calls takes log2(n) joins. Sorted
by (depth, turn, call_id), every call stands after the one it follows. Arguments are checked against the
fields of the tool's schema and written as JSON with sorted keys and no white space.

Only DataFrame operations run. Tables joined repeatedly are stored, with one row per identifier on the right, so
Spark can split an identifier that many calls follow; nothing is gathered per conversation.

A row per call, and one per identifier that has results but no call:
- several calls with one identifier: the first by (turn, tool, arguments, after) counts, error "repeated call";
- several results: the first by content counts, n_results tells how many;
- no identifier: the call keeps a row of its own, error "no identifier", linked with nothing; results without
  one are dropped from linking and counted under a null identifier per conversation;
- unknown predecessor: depth 0, error "unknown predecessor"; in or behind a cycle: depth null, error "cycle";
- arguments that are null or no JSON object: error "no object"; unknown tool: error "unknown tool";
- results without a call: tool null, error "no call".
Empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, stage

ID = ["conv_id", "call_id"]


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth, reached) of calls with unique identifiers and `after`, by pointer doubling.

    reached is false in and behind cycles. after must be null or name a call of the conversation.
    """
    n = calls.count()
    jumps = stage(calls.select(*ID, F.col("after").alias("to"), F.when(F.col("after").isNull(), 0).otherwise(1).cast("bigint").alias("depth")))
    reach = 1
    while reach < 2 * n and not jumps.where("to IS NOT NULL").isEmpty():
        there = jumps.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("depth").alias("more"))
        moved = stage(
            jumps.join(there, ["conv_id", "to"], "left").select(
                *ID, F.col("next").alias("to"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
            )
        )
        release(jumps)
        jumps, reach = moved, reach * 2
    return jumps.select(*ID, F.col("depth"), F.col("to").isNull().alias("reached"))


def _field_error(arguments: Column, field: Column) -> Column:
    """What is wrong with one field of the arguments, null if nothing."""
    path = F.concat(F.lit("$."), field["field"])
    typed = lambda kind: F.call_function("try_variant_get", arguments, path, F.lit(kind))
    kind = F.schema_of_variant(typed("variant"))
    number = typed("double")
    integer = kind == "BIGINT"
    fits = (
        F.when(field["type"] == "string", kind == "STRING")
        .when(field["type"] == "integer", integer)
        .when(field["type"] == "number", integer | kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"))
        .when(field["type"] == "boolean", kind == "BOOLEAN")
        .when(field["type"] == "array", kind.startswith("ARRAY"))
        .when(field["type"] == "object", kind.startswith("OBJECT"))
        .otherwise(F.lit(False))
    )
    missing = kind.isNull() | (kind == "VOID")
    said = lambda what: F.concat(field["field"], F.lit(": " + what))
    return (
        F.when(missing, F.when(F.coalesce(field["required"], F.lit(False)), said("missing")))
        .when(~fits, said("wrong type"))
        .when(number < field["minimum"], said("too small"))
        .when(number > field["maximum"], said("too large"))
    )


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv_id, call_id, turn, tool, depth, n_results, errors (sorted), message (canonical JSON).

    calls: conv_id, call_id, turn, tool, arguments (JSON text), after; results: conv_id, call_id, content;
    schemas: tool, field, type, required, minimum, maximum.
    """
    text = lambda c: F.col(c).cast("string").alias(c)
    calls = calls.select(F.col("conv_id").cast("bigint").alias("conv_id"), text("call_id"), F.col("turn").cast("bigint").alias("turn"),
                         text("tool"), text("arguments"), text("after"))
    results = results.select(F.col("conv_id").cast("bigint").alias("conv_id"), text("call_id"), text("content"))
    named = calls.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
    details = F.struct("turn", "tool", "arguments", "after")
    unique = stage(named.groupBy(*ID).agg(F.min(details).alias("c"), F.count(F.lit(1)).alias("n_calls")).select(*ID, "c.*", "n_calls"))
    known = unique.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("known"))
    checked = stage(unique.join(known, ["conv_id", "after"], "left").select(
        *ID, "turn", "tool", "arguments", "n_calls", F.when(F.col("known"), F.col("after")).alias("after"),
        (F.col("after").isNotNull() & F.col("known").isNull()).alias("lost")
    ))
    levels = depths(checked.select(*ID, "after"))
    nameless = calls.where("conv_id IS NULL OR call_id IS NULL").select(
        *ID, "turn", "tool", "arguments", F.lit(1).cast("bigint").alias("n_calls"), "after", F.lit(False).alias("lost"),
        F.lit(None).cast("bigint").alias("depth"), F.lit(None).cast("boolean").alias("reached"),
    )
    ordered = checked.join(levels, ID).select(*nameless.columns).unionByName(nameless)
    answers = results.groupBy(*ID).agg(F.count(F.lit(1)).alias("n_results"), F.min("content").alias("content"))
    fields = F.struct("field", "type", "required", "minimum", "maximum")
    tools = schemas.groupBy("tool").agg(F.array_sort(F.collect_list(fields)).alias("fields"))  # as long as a schema

    called = unique.select(*ID, F.lit(True).alias("is_call"))
    tagged = stage(answers.join(called.hint("shuffle_hash"), ID, "left"))
    linked = ordered.join(tagged.where("is_call").drop("is_call"), ID, "left").withColumn("is_call", F.lit(True))
    alone = tagged.where("is_call IS NULL")
    joined = linked.unionByName(alone, allowMissingColumns=True).join(tools, "tool", "left")
    parsed = F.try_parse_json("arguments")
    joined = joined.withColumn("parsed", F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed))
    is_call = F.coalesce("is_call", F.lit(False))
    flag = lambda condition, what: F.when(F.coalesce(condition, F.lit(False)), F.lit(what))
    general = F.array(
        flag(~is_call, "no call"),
        flag(is_call & (F.col("conv_id").isNull() | F.col("call_id").isNull()), "no identifier"),
        flag(F.col("n_calls") > 1, "repeated call"), flag(F.col("lost"), "unknown predecessor"), flag(~F.col("reached"), "cycle"),
        flag(is_call & F.col("fields").isNull(), "unknown tool"), flag(is_call & F.col("parsed").isNull(), "no object"),
    )
    specific = F.when(F.col("parsed").isNotNull(), F.transform("fields", lambda f: _field_error(F.col("parsed"), f)))
    errors = F.array_sort(F.filter(F.concat(general, F.coalesce(specific, F.array().cast("array<string>"))), lambda e: e.isNotNull()))
    # Fields in the order of their names; absent where null.
    message = F.to_json(F.struct(
        F.col("after"), F.col("parsed").alias("arguments"), F.col("call_id"), F.col("conv_id"), F.col("content").alias("result"), F.col("tool"),
    ))
    return joined.select(
        *ID, "turn", "tool", F.when(F.col("reached"), F.col("depth")).alias("depth"), F.coalesce("n_results", F.lit(0)).cast("bigint").alias("n_results"),
        errors.alias("errors"), message.alias("message"),
    )


# The tools that turns of a conversation stand for, and their schemas.
SHORT_WORDS = 60
SCHEMAS = [
    ("answer", "lines", "integer", True, 1.0, 12.0),
    ("answer", "text", "string", True, None, None),
    ("answer", "words", "integer", True, 61.0, 250.0),
    ("reply", "lines", "integer", True, 1.0, 2.0),
    ("reply", "text", "string", True, None, None),
    ("reply", "words", "integer", True, 5.0, 60.0),
]


def _calls_and_results(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Assistant turns as calls, later user turns as results, and the turns that are neither."""
    turns = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    name = lambda back: F.concat_ws(":", "conv_id", (F.col("turn") - back).cast("string"))
    words = F.size(F.filter(F.split("text", " "), lambda w: w != ""))
    calls = turns.where("role = 'assistant'").select(
        "conv_id", name(0).alias("call_id"), "turn", F.when(words <= SHORT_WORDS, "reply").otherwise("answer").alias("tool"),
        F.to_json(F.struct(words.alias("words"), F.col("text"), F.size(F.split("text", "\n")).alias("lines"))).alias("arguments"),
        F.when(F.col("turn") >= 2, name(2)).alias("after"),
    )
    results = turns.where("role = 'user' AND turn > 0").select("conv_id", name(1).alias("call_id"), F.col("text").alias("content"))
    others = turns.where("NOT coalesce(role = 'assistant' OR role = 'user' AND turn > 0, false)")
    return calls, results, others


def _linked_turns(conversations: DataFrame) -> DataFrame:
    """Assistant turns as calls (their text, words and lines as arguments, each after the assistant turn two
    turns back) and user turns as results of the turn before."""
    spark = conversations.sparkSession
    calls, results, _ = _calls_and_results(conversations)
    names = ("tool", "field", "type", "required", "minimum", "maximum")
    kinds = ("string", "string", "string", "boolean", "double", "double")
    rows = [F.struct(*(F.lit(v).cast(k).alias(n) for v, k, n in zip(r, kinds, names))) for r in SCHEMAS]
    schemas = spark.range(1).select(F.inline(F.array(*rows)))
    linked = link_calls(calls, results, schemas)
    return linked.select("conv_id", "call_id", "turn", "tool", "depth", "n_results", F.array_join("errors", "; ").alias("errors"), "message")


def _unlinked(rows: DataFrame, details: list[str], kept: str = "true") -> DataFrame:
    """One row for each of rows that is not the first by details of its identifier; rows outside kept are dropped."""
    same = stage(rows.where(kept).groupBy(*ID, *details).agg(F.count(F.lit(1)).alias("n")))
    first = same.groupBy(*ID).agg(F.min(F.struct(*details)).alias("first")).select(*(F.col(c).alias(f"_{c}") for c in ID), "first")
    both = same.join(first, [same[c].eqNullSafe(F.col(f"_{c}")) for c in ID])
    more = (F.col("n") - F.struct(*details).eqNullSafe(F.col("first")).cast("bigint")).cast("int")
    return both.withColumn("more", more).where("more > 0").select(*ID, *details, F.explode(F.sequence(F.lit(1), "more")).alias("nth")).drop("nth")


def op3_query(conversations: DataFrame) -> DataFrame:
    """Every turn of every conversation: n_rows of all rows together is the number of input rows.

    kind: "call" (with its first result, if any), "result" (without a call, or not the first of its call) or
    "message" (system turns, user turns at or before turn 0 or without turn, and any other role). Messages stand
    at depth 0 before the calls of their turn; a role other than system, user and assistant is an error.
    """
    calls, results, others = _calls_and_results(conversations)
    linked = _linked_turns(conversations).withColumn("kind", F.when(F.col("tool").isNotNull(), "call").otherwise("result"))
    linked = linked.withColumn("role", F.when(F.col("kind") == "call", "assistant").otherwise("user")).withColumn(
        "n_rows", F.lit(1).cast("bigint") + ((F.col("kind") == "call") & (F.col("n_results") > 0)).cast("bigint"))

    def rows(df: DataFrame, kind: str, error: Column, message: Column) -> DataFrame:
        have = {c: F.lit(None).cast(t).alias(c) for c, t in linked.dtypes if c not in df.columns}
        have |= {"kind": F.lit(kind).alias("kind"), "n_rows": F.lit(1).cast("bigint").alias("n_rows"), "message": F.to_json(message).alias("message"),
                 "errors": F.coalesce(error, F.lit("")).alias("errors"), "n_results": F.lit(0).cast("bigint").alias("n_results")}
        return df.select(*(have.get(c, F.col(c)) for c in linked.columns))

    parsed = F.try_parse_json("arguments").alias("arguments")
    # Every call without conversation has a row of its own already.
    again = _unlinked(calls, ["turn", "tool", "arguments", "after"], "conv_id IS NOT NULL").withColumn("role", F.lit("assistant"))
    again = rows(again, "call", F.lit("repeated call"), F.struct("after", parsed, "call_id", "conv_id", "tool"))
    more = _unlinked(results, ["content"]).withColumn("role", F.lit("user"))
    more = rows(more, "result", F.lit("repeated result"), F.struct("call_id", "conv_id", F.col("content").alias("result")))
    known = F.coalesce(F.col("role").isin("system", "user"), F.lit(False))
    others = others.withColumn("depth", F.lit(0).cast("bigint"))
    others = rows(others, "message", F.when(~known, "unknown role"), F.struct(F.col("text").alias("content"), "conv_id", "role", "turn"))
    return linked.unionByName(again).unionByName(more).unionByName(others)


ORACLE = f"""
WITH turns AS (SELECT conv_id, turn, role, coalesce(text, '') AS text,
    CAST(len(list_filter(string_split(coalesce(text, ''), ' '), lambda x: x <> '')) AS BIGINT) AS words,
    CAST(len(string_split(coalesce(text, ''), chr(10))) AS BIGINT) AS lines FROM conversations),
raw AS (SELECT conv_id, concat_ws(':', conv_id, turn) AS call_id, turn, CASE WHEN words <= {SHORT_WORDS} THEN 'reply' ELSE 'answer' END AS tool,
    words, lines, text, CASE WHEN turn >= 2 THEN concat_ws(':', conv_id, turn - 2) END AS after FROM turns WHERE role = 'assistant'),
numbered AS (SELECT *, count(*) OVER (PARTITION BY conv_id, call_id) AS n_calls,
    row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn, tool, '{{"words":' || words || ',"text":' || to_json(text)) AS nth FROM raw),
calls AS (SELECT c.*, p.call_id IS NULL AND c.after IS NOT NULL AS lost, p.call_id AS parent
    FROM numbered c LEFT JOIN (SELECT DISTINCT conv_id, call_id FROM raw) p ON p.conv_id = c.conv_id AND p.call_id = c.after WHERE nth = 1),
starts AS (SELECT *, sum(CASE WHEN parent IS NULL THEN 1 ELSE 0 END)
    OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS chain FROM calls),
levels AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, chain ORDER BY turn) - 1 AS depth FROM starts),
replies AS (SELECT conv_id, concat_ws(':', conv_id, turn - 1) AS call_id, text,
    row_number() OVER (PARTITION BY conv_id, turn ORDER BY text) AS nth FROM turns WHERE role = 'user' AND turn > 0),
answers AS (SELECT conv_id, call_id, count(*) AS n_results, min(text) AS content FROM replies GROUP BY ALL),
both_sides AS (SELECT coalesce(l.conv_id, a.conv_id) AS conv_id, coalesce(l.call_id, a.call_id) AS call_id, l.turn, l.tool, l.depth,
    l.words, l.lines, l.text, l.parent, l.lost, l.n_calls, l.call_id IS NOT NULL AS is_call, coalesce(a.n_results, 0) AS n_results, a.content
    FROM levels l FULL JOIN answers a ON l.conv_id = a.conv_id AND l.call_id = a.call_id)
SELECT conv_id, call_id, turn, tool, depth, n_results, CASE WHEN is_call THEN 'call' ELSE 'result' END AS kind,
    CASE WHEN is_call THEN 'assistant' ELSE 'user' END AS role, CAST(CASE WHEN is_call AND n_results > 0 THEN 2 ELSE 1 END AS BIGINT) AS n_rows,
    array_to_string(list_filter([
        CASE WHEN lines > CASE tool WHEN 'answer' THEN 12 ELSE 2 END THEN 'lines: too large' END,
        CASE WHEN NOT is_call THEN 'no call' END,
        CASE WHEN n_calls > 1 THEN 'repeated call' END,
        CASE WHEN lost THEN 'unknown predecessor' END,
        CASE WHEN words > CASE tool WHEN 'answer' THEN 250 ELSE 60 END THEN 'words: too large' END,
        CASE WHEN words < CASE tool WHEN 'answer' THEN 61 ELSE 5 END THEN 'words: too small' END], lambda x: x IS NOT NULL), '; ') AS errors,
    '{{' || array_to_string(list_filter([
        '"after":' || to_json(parent),
        CASE WHEN is_call THEN '"arguments":{{"lines":' || lines || ',"text":' || to_json(text) || ',"words":' || words || '}}' END,
        '"call_id":' || to_json(call_id), '"conv_id":' || conv_id, '"result":' || to_json(content),
        '"tool":' || to_json(tool)], lambda x: x IS NOT NULL), ',') || '}}' AS message
FROM both_sides
UNION ALL
SELECT conv_id, call_id, turn, tool, NULL, 0, 'call', 'assistant', 1, 'repeated call',
    '{{' || array_to_string(list_filter([
        '"after":' || to_json(after), '"arguments":{{"lines":' || lines || ',"text":' || to_json(text) || ',"words":' || words || '}}',
        '"call_id":' || to_json(call_id), '"conv_id":' || conv_id, '"tool":' || to_json(tool)], lambda x: x IS NOT NULL), ',') || '}}'
FROM numbered WHERE nth > 1
UNION ALL
SELECT conv_id, call_id, NULL, NULL, NULL, 0, 'result', 'user', 1, 'repeated result',
    '{{"call_id":' || to_json(call_id) || ',"conv_id":' || conv_id || ',"result":' || to_json(text) || '}}'
FROM replies WHERE nth > 1
UNION ALL
SELECT conv_id, NULL, turn, NULL, 0, 0, 'message', role, 1, CASE WHEN coalesce(role IN ('system', 'user'), false) THEN '' ELSE 'unknown role' END,
    '{{' || array_to_string(list_filter(['"content":' || to_json(text), '"conv_id":' || conv_id, '"role":' || to_json(role), '"turn":' || turn],
        lambda x: x IS NOT NULL), ',') || '}}'
FROM turns WHERE NOT coalesce(role = 'assistant' OR role = 'user' AND turn > 0, false)
"""
