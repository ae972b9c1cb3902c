"""Chat formatting: tool calls linked to their results, ordered, validated and written as canonical JSON.

Messages have conv_id, turn, kind ('call' or 'result'), call_id, name, arguments (JSON text), needs (ids of calls whose
results a call uses) and content. Calls and results meet in a hash join on (conv_id, call_id). A call comes after all
calls it needs: turns already say so in a conversation where every call needs only earlier ones; in all
others a call's level is the longest way down its needs. Levels are found by rounds of joins: a call that needs one
other is replaced by what that one needs, so that chains shorten by half in every round; only calls with several open needs
wait for a round each. Calls of a cycle, and those that need one, get no level and stand last. Arguments are parsed as VARIANT, checked against
the tool's schema, and written with sorted keys and without spaces.

Rows: a null conv_id links with nothing and has no positions; a null call_id links with nothing; a call without a turn has no position;
missing or broken arguments are an error of that
call; a call without a result is 'unanswered', a result without a call 'orphan'; repeated calls stay rows of their
own, and of several results the first by turn, then by content, is linked; calls of one turn are numbered by one task; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import kept, table

#: tool -> argument -> (kind by schema_of_variant, required)
SCHEMAS = {"reply": {"text": ("STRING", True), "words": ("BIGINT", True), "after": ("STRING", False)}, "setup": {"text": ("STRING", True)}}
#: Turns, or levels, that one task numbers at most.
STRIDE = 1024
_NEVER = 1 << 62


def from_conversations(df: DataFrame) -> DataFrame:
    """Messages of plain conversations: a system turn is a call of the tool setup, a user turn one of reply, the turn after it the result.

    What a user turn says decides on its call, so that all that can go wrong does: by its number of words it needs the
    user turn two turns on (a multiple of 3) or else the one two turns back, unless that needs it; words are given as text (a multiple of 5), or
    not at all (of 7), the arguments break off (of 11), or the tool is unknown (of 13).
    """
    words = F.size(F.expr(r"filter(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), x -> x <> '')"))
    rows = df.where("role IN ('user', 'assistant', 'system')").withColumn("words", words).withColumn("later", (F.col("role") == "user") & (F.col("words") % 3 == 0))
    user, result, system = F.col("role") == "user", F.col("role") == "assistant", F.col("role") == "system"
    before = rows.where("role = 'user'").groupBy("conv_id", (F.col("turn") + 2).alias("turn")).agg(F.max("later").alias("needed"))
    rows = rows.join(before, ["conv_id", "turn"], "left")
    id_ = lambda turn: F.concat(F.lit("c"), turn)
    need = F.when(user & F.col("later"), id_(F.col("turn") + 2)).when(user & (F.col("turn") >= 2) & ~F.coalesce("needed", F.lit(False)), id_(F.col("turn") - 2))
    count = F.when(F.col("words") % 7 == 0, None).when(F.col("words") % 5 == 0, F.concat(F.lit('"'), "words", F.lit('"'))).otherwise(F.col("words").cast("string"))
    text, after = F.to_json(F.struct("text")), F.to_json(F.struct(need.alias("after")))
    # Members joined as text, in an order that is not the canonical one.
    inner = lambda json: F.when(F.length(json) > 2, F.substr(json, F.lit(2), F.length(json) - 2))
    arguments = F.concat(F.lit("{ "), F.concat_ws(", ", F.concat(F.lit('"words": '), count), inner(text), inner(after)), F.when(F.col("words") % 11 == 0, "").otherwise("}"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(result, "result").otherwise("call").alias("kind"),
        F.when(system, F.concat(F.lit("s"), "turn")).when(user, id_(F.col("turn"))).otherwise(id_(F.col("turn") - 1)).alias("call_id"),
        F.when(system, "setup").when(user & (F.col("words") % 13 == 0), "respond").when(user, "reply").alias("name"),
        F.when(system, text).when(user, arguments).alias("arguments"),
        F.when(need.isNotNull(), F.array(need)).otherwise(F.array().cast("array<string>")).alias("needs"),
        F.when(result, F.col("text")).alias("content"),
    )


def schema_errors(name: Column, parsed: Column, schemas: dict = SCHEMAS) -> Column:
    """The arguments that are missing or of another kind, as an array of text."""
    found = F.when(parsed.isNull(), F.array(F.lit("arguments: not JSON")))
    for tool, arguments in schemas.items():
        each = []
        for key, (kind, required) in sorted(arguments.items()):
            is_ = F.schema_of_variant(F.try_variant_get(parsed, f"$.{key}", "variant"))
            missing = F.lit(f"{key}: missing") if required else F.lit(None)
            each.append(F.when(is_.isNull() | (is_ == "VOID"), missing).when(is_ != kind, F.lit(f"{key}: not {kind}")))
        found = found.when(name == tool, F.array_compact(F.array(*each)))
    return found.otherwise(F.array(F.lit("name: no such tool")))


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of calls in conversations where some call needs one that isn't earlier."""
    nodes = calls.where("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(F.min("turn").alias("turn"), F.flatten(F.collect_set("needs")).alias("needs"))
    edges = nodes.select("conv_id", "call_id", "turn", F.explode(F.array_distinct("needs")).alias("need"))
    known = nodes.select("conv_id", F.col("call_id").alias("need"), F.col("turn").alias("need_turn"))
    edges = edges.join(known, ["conv_id", "need"])
    late = kept(edges.where("need_turn >= turn").select("conv_id").distinct())
    edges = kept(edges.join(late, "conv_id", "left_semi").select("conv_id", "call_id", "need"))
    state = kept(nodes.join(late, "conv_id", "left_semi").select("conv_id", "call_id", F.lit(0).cast("long").alias("level")))
    sizes = kept(state.groupBy("conv_id").agg(F.count("*").alias("size")))
    edges, seen = kept(edges.withColumn("far", F.lit(1).cast("long"))), None
    while True:
        signature = tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(conv_id, call_id, need, far))")).first())
        if not signature[0] or signature == seen:  # none are open, or all that are wait for a cycle
            break
        seen = signature
        open_ = edges.groupBy("conv_id", "call_id").agg(F.count("*").alias("open"), F.min("need").alias("next"), F.min("far").alias("step"))
        needed = state.join(open_, ["conv_id", "call_id"], "left").select("conv_id", F.col("call_id").alias("need"), "level", F.coalesce("open", F.lit(0)).alias("open"), "next", "step")
        met = edges.join(needed, ["conv_id", "need"]).join(sizes, "conv_id")
        # A way down that is longer than the conversation goes round a cycle.
        moved = kept(
            met.select(
                "conv_id", "call_id",
                F.expr(f"CASE WHEN far > size THEN {_NEVER} WHEN open < 2 THEN least({_NEVER}, level + far) ELSE 0 END").alias("gain"),
                F.expr("CASE WHEN far > size OR open = 0 THEN NULL WHEN open = 1 THEN next ELSE need END").alias("need"),
                F.expr("CASE WHEN open = 1 THEN far + step ELSE far END").alias("far"),
            )
        )
        gains = moved.groupBy("conv_id", "call_id").agg(F.max("gain").alias("gain"))
        state = kept(state.join(gains, ["conv_id", "call_id"], "left").select("conv_id", "call_id", F.greatest("level", F.coalesce("gain", F.lit(0))).alias("level")))
        edges = kept(moved.where("need IS NOT NULL").groupBy("conv_id", "call_id", "need").agg(F.max("far").alias("far")))
    waiting = edges.select("conv_id", "call_id", F.lit(_NEVER).cast("long").alias("never")).distinct()
    return state.join(waiting, ["conv_id", "call_id"], "left").select("conv_id", "call_id", F.coalesce("never", "level").alias("level"))


def linked(messages: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """(conv_id, turn, call_id, position, status, errors, message): a row for every call and every orphan result.

    `position` counts a conversation's calls in order, from 0; orphans have none.
    """
    messages = messages.select("conv_id", "turn", "kind", "call_id", "name", "arguments", "needs", "content")
    calls, results = messages.where("kind = 'call'"), messages.where("kind = 'result'")
    first = results.where("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "content")).alias("result"))
    rows = calls.join(levels(calls), ["conv_id", "call_id"], "left").withColumn("level", F.coalesce("level", F.lit(0)))
    rows = rows.join(first, ["conv_id", "call_id"], "left")
    # Positions in steps, so that no task numbers a whole conversation: by strides of levels, in those by level and stride of turns.
    rows = rows.withColumn("storey", F.floor(F.col("level") / STRIDE)).withColumn("stride", F.floor(F.coalesce("turn", F.lit(0)) / STRIDE))
    keys = ["conv_id", "storey", "level", "stride"]
    counts = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy(*keys).agg(F.count("*").alias("n"))
    storeys = counts.groupBy("conv_id", "storey").agg(F.sum("n").alias("all")).select("conv_id", "storey", F.expr("sum(all) OVER (PARTITION BY conv_id ORDER BY storey) - all").alias("below"))
    within = counts.select(*keys, F.expr("sum(n) OVER (PARTITION BY conv_id, storey ORDER BY level, stride) - n").alias("before"))
    rows = rows.join(within.join(storeys, ["conv_id", "storey"]), keys, "left")
    place = F.expr("row_number() OVER (PARTITION BY conv_id, storey, level, stride, turn IS NULL ORDER BY turn, call_id, arguments)")
    position = F.when(F.col("turn").isNotNull(), F.col("below") + F.col("before") + place - 1)
    parsed = F.try_parse_json(F.col("arguments"))
    errors = schema_errors(F.col("name"), parsed, schemas)
    message = F.to_json(F.struct(parsed.alias("arguments"), F.col("call_id").alias("id"), F.col("name"), F.col("result.content").alias("result")))
    called = rows.select(
        "conv_id", "turn", "call_id", position.alias("position"),
        F.when(F.col("result").isNull(), "unanswered").otherwise("linked").alias("status"), errors.alias("errors"), message.alias("message"),
    )
    ids = calls.select("conv_id", "call_id").distinct()
    orphans = results.join(ids, ["conv_id", "call_id"], "left_anti").select(
        "conv_id", "turn", "call_id", F.lit(None).cast("long").alias("position"), F.lit("orphan").alias("status"),
        F.array().cast("array<string>").alias("errors"), F.to_json(F.struct(F.col("call_id").alias("id"), F.col("content").alias("result"))).alias("message"),
    )
    return called.union(orphans)


def op8_tool_calls(spark, sf_dir):
    found = linked(from_conversations(table(spark, sf_dir, "conversations")))
    return found.withColumn("errors", F.concat_ws("; ", "errors"))


OP8_SQL = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, text, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words,
    CASE role WHEN 'system' THEN 's' || turn WHEN 'user' THEN 'c' || turn ELSE 'c' || (turn - 1) END AS call_id
  FROM conversations WHERE role IN ('user', 'assistant', 'system')
), calls AS (
  SELECT m.*, CASE WHEN m.role <> 'user' THEN NULL WHEN m.words % 3 = 0 THEN 'c' || (m.turn + 2)
      WHEN m.turn >= 2 AND NOT coalesce(p.words % 3 = 0, false) THEN 'c' || (m.turn - 2) END AS need
  FROM m LEFT JOIN (SELECT conv_id, turn, min(words % 3) AS words FROM m WHERE role = 'user' GROUP BY ALL) p ON p.conv_id = m.conv_id AND p.turn = m.turn - 2
  WHERE m.role <> 'assistant'
), results AS (
  SELECT conv_id, call_id, arg_min(text, turn) AS content FROM m WHERE role = 'assistant' GROUP BY ALL
), edges AS (
  SELECT c.conv_id, c.call_id, c.need, n.turn >= c.turn AS late FROM calls c JOIN calls n ON n.conv_id = c.conv_id AND n.call_id = c.need
), ways AS (
  SELECT conv_id, call_id, 0 AS steps FROM calls c WHERE conv_id IN (SELECT conv_id FROM edges WHERE late)
    AND NOT EXISTS (SELECT 1 FROM edges e WHERE e.conv_id = c.conv_id AND e.call_id = c.call_id)
  UNION
  SELECT e.conv_id, e.call_id, w.steps + 1 FROM ways w JOIN edges e ON e.conv_id = w.conv_id AND e.need = w.call_id
), levels AS (
  SELECT conv_id, call_id, max(steps) AS level FROM ways GROUP BY ALL
), told AS (
  SELECT c.*, coalesce(level, 0) AS level,
    CASE WHEN role = 'user' AND words % 11 = 0 THEN NULL ELSE '{' || concat_ws(',', '"after":"' || need || '"', '"text":' || CAST(to_json(text) AS VARCHAR),
      CASE WHEN role = 'system' OR words % 7 = 0 THEN NULL WHEN words % 5 = 0 THEN '"words":"' || words || '"' ELSE '"words":' || words END) || '}' END AS arguments,
    CASE WHEN role = 'system' THEN 'setup' WHEN words % 13 = 0 THEN 'respond' ELSE 'reply' END AS name,
    CASE WHEN role = 'system' THEN CASE WHEN text IS NULL THEN 'text: missing' ELSE '' END
      WHEN words % 11 = 0 THEN 'arguments: not JSON' WHEN words % 13 = 0 THEN 'name: no such tool'
      ELSE concat_ws('; ', CASE WHEN text IS NULL THEN 'text: missing' END, CASE WHEN words % 7 = 0 THEN 'words: missing' WHEN words % 5 = 0 THEN 'words: not BIGINT' END) END AS errors
  FROM calls c LEFT JOIN levels USING (conv_id, call_id)
)
SELECT c.conv_id, c.turn, c.call_id,
  CAST(row_number() OVER (PARTITION BY c.conv_id ORDER BY c.level, c.turn, c.call_id) - 1 AS BIGINT) AS position,
  CASE WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status, c.errors,
  '{' || concat_ws(',', '"arguments":' || c.arguments, '"id":"' || c.call_id || '"', '"name":"' || c.name || '"', '"result":' || CAST(to_json(r.content) AS VARCHAR)) || '}' AS message
FROM told c LEFT JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
UNION ALL
SELECT conv_id, turn, call_id, NULL, 'orphan', '', '{"id":"' || call_id || '","result":' || CAST(to_json(text) AS VARCHAR) || '}'
FROM m WHERE role = 'assistant' AND NOT EXISTS (SELECT 1 FROM calls c WHERE c.conv_id = m.conv_id AND c.call_id = m.call_id)
"""
