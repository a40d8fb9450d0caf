"""Tool calls of conversations: linking, topological order, validation and canonical JSON, all in DataFrame operations.

1. Calls and results are hash-joined by conversation and call identifier.
2. A call names the calls that it follows. Its depth is the longest chain of calls before it: the most of d + depth(p) over the
   calls p that it still waits for, and of what is known. In each round a call that waits for one other takes over what
   that one waits for, distances added; calls waited for at one distance or another fall together; and known depths are put in.
   So a chain of n calls takes log2(n) joins, however many branches meet again on it, and other graphs a join per
   level of calls where unlike branches meet. Positions are ranks by depth, then turn, within a conversation; a range sort
   numbers them, so one long conversation is spread over tasks.
3. Arguments are parsed as variants and checked field by field against the tool's schema: types, nested objects, items of arrays and
   enumerations. Fields are looked up by name, never by path, so names may hold dots, quotes and brackets.
4. Each call is serialised with its arguments and result as JSON with sorted keys and no white space.

Edge cases: calls of one identifier in a conversation count as one (the least by turn, then arguments), with
their number in n_calls; of several results the first by turn, then content, is linked, with
their number in n_results; a call without a result has a null one; a result without a call gives no
row; calls that aren't known are not waited for, and a call that is named twice counts once; calls on a cycle, and those that follow them, have no depth and come
last; null conversations are one conversation; calls with a null identifier are kept, each by itself,
without link, depth or position; null or malformed arguments are invalid and serialised as null; an empty
table gives no row; other columns are ignored.
"""

from __future__ import annotations

import json as plain_json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicework.llm.common import materialize, table



class Field(NamedTuple):
    """What a value has to be: its JSON type, whether it has to be there, and of objects their fields, of arrays what each item is, of others a list of values."""

    kind: str
    needed: bool = True
    fields: dict[str, Field] | None = None
    items: Field | None = None
    values: tuple | None = None


#: A tool's fields; other fields are errors. A plain pair is a type, and whether the field has to be there.
Schema = dict[str, Field | tuple[str, bool]]
_KINDS = {"string": r"^STRING", "integer": r"^BIGINT", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)", "boolean": r"^BOOLEAN", "array": r"^ARRAY", "object": r"^OBJECT"}
_COLUMNS = ("conv_id", "turn", "call_id", "name", "arguments", "follows")


def _with_arrays(calls: DataFrame) -> DataFrame:
    """With ``follows`` as an array, if it is one identifier."""
    if calls.schema["follows"].dataType.typeName() == "array":
        return calls
    return calls.withColumn("follows", F.array_compact(F.array("follows")))


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """calls (conv_id, turn, call_id, name, arguments, follows) with result, n_calls and n_results; follows is an array, or one identifier."""
    calls = _with_arrays(calls)
    named = calls.where("call_id is not null")
    one = named.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "name", "arguments", "follows")).alias("c"), F.count("*").alias("n_calls"))
    answer = results.where("call_id is not null").groupBy(F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_call")).agg(F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results"))
    linked = one.join(answer, F.col("conv_id").eqNullSafe(F.col("r_conv")) & (F.col("call_id") == F.col("r_call")), "left")
    return linked.select("conv_id", F.col("c.turn").alias("turn"), "call_id", F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"), F.col("c.follows").alias("follows"), F.col("r.content").alias("result"), "n_calls", F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"))


def depths(linked: DataFrame) -> DataFrame:
    """conv_id, call_id, depth: the longest chain of calls before each; null on a cycle and after one."""
    ids = linked.select("conv_id", "call_id", F.explode_outer(F.array_distinct("follows")).alias("before"))
    known = linked.select(F.col("conv_id").alias("k_conv"), F.col("call_id").alias("k_call"))
    start = ids.join(known, F.col("conv_id").eqNullSafe(F.col("k_conv")) & (F.col("before") == F.col("k_call")), "left")
    waits = F.collect_set(F.when(F.col("k_call").isNotNull(), F.struct(F.col("k_call").alias("to"), F.lit(1).cast("long").alias("d"))))
    state = start.groupBy("conv_id", "call_id").agg(waits.alias("waits")).withColumns({"least": F.lit(0).cast("long"), "bad": F.lit(False)})
    state, before, round_ = materialize(state, "depth-0"), None, 0
    n = state.count()
    while True:
        sums = F.sum(F.aggregate("waits", F.lit(0).cast("long"), lambda x, e: x + e["d"]))
        now = state.agg(F.count_if(F.size("waits") > 0), F.sum(F.size("waits")), sums).first()
        if not now[0] or now == before:
            return state.select("conv_id", "call_id", F.when((F.size("waits") == 0) & ~F.col("bad"), F.col("least")).alias("depth"))
        before, round_ = now, round_ + 1
        there = state.select(F.col("conv_id").alias("k_conv"), F.col("call_id").alias("k_call"), F.col("waits").alias("k_waits"), F.col("least").alias("k_least"), F.col("bad").alias("k_bad"))
        each = state.where(F.size("waits") > 0).select("conv_id", "call_id", "least", F.explode("waits").alias("w"))
        each = each.join(there, F.col("conv_id").eqNullSafe(F.col("k_conv")) & (F.col("w.to") == F.col("k_call")))
        next_ = F.get("k_waits", F.lit(0))
        one, many = F.size("k_waits") == 1, F.size("k_waits") > 1
        far = F.col("w.d") + F.when(one, next_["d"]).otherwise(0)
        each = each.select("conv_id", "call_id", F.when(one, next_["to"]).when(many, F.col("w.to")).alias("to"), far.alias("d"), F.greatest("least", F.when(~many, F.col("w.d") + F.col("k_least"))).alias("least"), (F.col("k_bad") | (far > n)).alias("bad"))
        each = each.groupBy("conv_id", "call_id", "to").agg(F.max("d").alias("d"), F.max("least").alias("least"), F.bool_or("bad").alias("bad"))
        again = each.groupBy("conv_id", "call_id").agg(F.collect_list(F.when(F.col("to").isNotNull(), F.struct("to", "d"))).alias("waits"), F.max("least").alias("least"), F.bool_or("bad").alias("bad"))
        again = again.withColumn("waits", F.when(F.col("bad"), F.filter("waits", lambda _: F.lit(False))).otherwise(F.col("waits")))
        state = materialize(state.where(F.size("waits") == 0).unionByName(again), f"depth-{round_}")


def positions(rows: DataFrame) -> DataFrame:
    """``rows`` with position: the rank by depth, turn and identifier in the conversation, from 0.

    Rows are sorted by ranges and numbered within each range; what a conversation has in earlier
    ranges is added, from a row per conversation and range.
    """
    order = [F.col("conv_id").asc_nulls_first(), F.col("depth").asc_nulls_last(), F.col("turn").asc_nulls_last(), F.col("call_id").asc()]
    rows = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("number", F.monotonically_increasing_id()), "ordered")
    rows = rows.withColumn("range", F.shiftright("number", 33))
    per = rows.groupBy("conv_id", "range").agg(F.min("number").alias("low"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("conv_id").alias("p_conv"), F.col("range").alias("p_range"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("shift"))
    joined = rows.join(per, F.col("conv_id").eqNullSafe(F.col("p_conv")) & (F.col("range") == F.col("p_range")))
    return joined.withColumn("position", F.col("number") + F.col("shift")).drop("number", "range", "p_conv", "p_range", "shift")


_MAP = "map<string,variant>"


def _field_errors(fields: Column, schema: Schema, path: str = "") -> Column:
    """An array of what is wrong with the fields of an object, a map from names to variants."""
    none = F.array().cast("array<string>")
    checks = [none]
    for name, given in schema.items():
        field, value = Field(*given), F.try_element_at(fields, F.lit(name))
        missing = F.array(F.lit(f"missing {path}{name}")) if field.needed else none
        checks.append(F.when(value.isNull(), missing).otherwise(_value_errors(value, field, path + name)))
    known = F.array(*map(F.lit, schema)) if schema else none
    extra = F.transform(F.array_sort(F.array_except(F.map_keys(fields), known)), lambda k: F.concat(F.lit(f"unknown {path}"), k))
    return F.concat(*checks, extra)


def _value_errors(value: Column, field: Field, path: str) -> Column:
    """An array of what is wrong with a value, a variant that is there."""
    inner = F.array().cast("array<string>")
    if field.values is not None:
        allowed = [plain_json.dumps(v, ensure_ascii=False) for v in field.values]
        inner = F.when(F.to_json(value).isin(allowed), inner).otherwise(F.array(F.lit(f"{path} is none of its values")))
    elif field.fields is not None:
        inner = _field_errors(F.try_variant_get(value, "$", _MAP), field.fields, f"{path}.")
    elif field.items is not None:
        items = F.try_variant_get(value, "$", "array<variant>")
        inner = F.array_distinct(F.flatten(F.transform(items, lambda x: _value_errors(x, field.items, f"{path}[]"))))
    return F.when(F.schema_of_variant(value).rlike(_KINDS[field.kind]), inner).otherwise(F.array(F.lit(f"{path} is no {field.kind}")))


def argument_errors(parsed: str, fields: str, name: str, schemas: dict[str, Schema]) -> Column:
    """An array of what is wrong with the arguments of a call, as a variant and as a map of its fields; empty if they are valid.

    Errors come by the schema's fields, then unknown ones by name; equal errors of an array's items count once.
    """
    found = F.when(F.col(name).isNull(), F.array(F.lit("no tool")))
    for tool, schema in schemas.items():
        found = found.when(F.col(name) == tool, F.when(F.col(parsed).isNull(), F.array(F.lit("no JSON"))).when(F.col(fields).isNull(), F.array(F.lit("no object"))).otherwise(_field_errors(F.col(fields), schema)))
    return found.otherwise(F.array(F.lit("unknown tool")))


def format_tools(calls: DataFrame, results: DataFrame, schemas: dict[str, Schema]) -> DataFrame:
    """A row per call: conv_id, call_id, turn, depth, position, n_calls, n_results, valid, errors, json."""
    calls = _with_arrays(calls.select(*_COLUMNS))
    linked = materialize(link(calls, results), "linked")
    deep = depths(linked).select(F.col("conv_id").alias("d_conv"), F.col("call_id").alias("d_call"), "depth")
    placed = positions(linked.join(deep, F.col("conv_id").eqNullSafe(F.col("d_conv")) & (F.col("call_id") == F.col("d_call"))).drop("d_conv", "d_call"))
    nameless = calls.where("call_id is null").withColumns({"result": F.lit(None).cast("string"), "n_calls": F.lit(1).cast("long"), "n_results": F.lit(0).cast("long"), "depth": F.lit(None).cast("long"), "position": F.lit(None).cast("long")})
    rows = placed.unionByName(nameless.select(placed.columns))
    rows = rows.withColumn("parsed", F.try_parse_json("arguments"))
    rows = rows.withColumn("fields", F.when(F.schema_of_variant("parsed").startswith("OBJECT"), F.try_variant_get("parsed", "$", _MAP)))
    errors = argument_errors("parsed", "fields", "name", schemas)
    json = F.to_json(F.struct(F.col("parsed").alias("arguments"), "call_id", "name", "result"), {"ignoreNullFields": "false"})
    return rows.select("conv_id", "call_id", "turn", "depth", "position", "n_calls", "n_results", (F.size(errors) == 0).alias("valid"), errors.alias("errors"), json.alias("json"))


#: The tool that a conversation's user turns call.
REPLY: Schema = {"text": ("string", True), "turn": ("integer", True)}


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations.

    A user turn is a call of ``reply`` that follows the call two turns above, and on each fourth such turn the one six turns
    above, too; an assistant turn is the result of the call one turn above. As callers err, by conversation and turn
    some arguments lack the turn, have it as a string, have a field that the tool doesn't know, or are cut off.
    """
    name = lambda turn: F.concat_ws(":", F.lit("call"), F.col("conv_id").cast("string"), turn.cast("string"))
    turn, text = F.col("turn"), F.col("text")
    slip = F.pmod(F.col("conv_id") + F.floor(turn / 2), F.lit(8))
    whole = F.to_json(F.struct("turn", "text"))
    arguments = F.when(slip == 1, F.to_json(F.struct("text"))).when(slip == 2, F.to_json(F.struct(turn.cast("string").alias("turn"), "text"))).when(slip == 3, F.to_json(F.struct("turn", "text", F.lit("en").alias("lang"))))
    arguments = arguments.when(slip == 4, F.left(whole, F.length(whole) - 1)).otherwise(whole)
    follows = F.when(turn.isNull(), F.array().cast("array<string>")).when(turn % 8 == 6, F.array(name(turn - 2), name(turn - 6))).otherwise(F.array(name(turn - 2)))
    calls = turns.where("role = 'user'").select("conv_id", "turn", F.when(turn.isNotNull(), name(turn)).alias("call_id"), F.lit("reply").alias("name"), arguments.alias("arguments"), follows.alias("follows"))
    results = turns.where("role = 'assistant'").select("conv_id", "turn", F.when(turn.isNotNull(), name(turn - 1)).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def op4_tool_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations: conv_id, call_id, turn, depth, position, n_calls, n_results, valid, errors, json."""
    calls, results = conversation_calls(table(spark, sf_dir, "conversations"))
    rows = format_tools(calls, results, {"reply": REPLY})
    return rows.select("conv_id", "call_id", "turn", "depth", "position", "n_calls", "n_results", "valid", F.array_join("errors", "; ").alias("errors"), "json")


OP4_SQL = """
WITH RECURSIVE calls AS (SELECT conv_id, turn, min(to_json(text)::VARCHAR) AS text, count(*) AS n_calls, (conv_id + turn // 2) % 8 AS slip FROM conversations WHERE role = 'user' GROUP BY conv_id, turn),
answers AS (SELECT conv_id, turn - 1 AS turn, min(text) AS result, count(*) AS n_results FROM conversations WHERE role = 'assistant' GROUP BY ALL),
edges AS (SELECT c.conv_id, c.turn, p.turn AS before FROM calls c JOIN calls p ON p.conv_id = c.conv_id AND (p.turn = c.turn - 2 OR c.turn % 8 = 6 AND p.turn = c.turn - 6)),
deep(conv_id, turn, depth) AS (SELECT conv_id, turn, 0::BIGINT FROM calls ANTI JOIN edges USING (conv_id, turn) UNION SELECT e.conv_id, e.turn, depth + 1 FROM deep d JOIN edges e ON e.conv_id = d.conv_id AND e.before = d.turn),
placed AS (SELECT *, 'call:' || conv_id || ':' || turn AS call_id FROM calls JOIN (SELECT conv_id, turn, max(depth) AS depth FROM deep GROUP BY ALL) USING (conv_id, turn)),
told AS (SELECT *,
  CASE WHEN slip = 4 THEN 'no JSON' ELSE concat_ws('; ', CASE WHEN text IS NULL THEN 'missing text' END, CASE slip WHEN 1 THEN 'missing turn' WHEN 2 THEN 'turn is no integer' WHEN 3 THEN 'unknown lang' END) END AS errors,
  CASE WHEN slip = 4 THEN 'null' ELSE '{' || concat_ws(',', CASE slip WHEN 3 THEN '"lang":"en"' END, '"text":' || text, CASE slip WHEN 1 THEN NULL WHEN 2 THEN '"turn":"' || turn || '"' ELSE '"turn":' || turn END) || '}' END AS arguments FROM placed)
SELECT conv_id, call_id, turn, depth, row_number() OVER (PARTITION BY conv_id ORDER BY depth, turn, call_id) - 1 AS position,
  n_calls, coalesce(n_results, 0) AS n_results, errors = '' AS valid, errors,
  '{"arguments":' || arguments || ',"call_id":"' || call_id || '","name":"reply","result":' || coalesce(to_json(result)::VARCHAR, 'null') || '}' AS json
FROM told LEFT JOIN answers USING (conv_id, turn)
"""
