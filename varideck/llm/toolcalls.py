"""Tool-call linking, in DataFrame functions alone: calls and results meet by identifier, calls are put in topological order of what
they depend on, arguments are checked against schemas, and each linked call becomes one line of canonical JSON.

Canonical JSON: keys in ascending order at every level, no white space, null fields left out, and one form for each number: whole ones
without a fraction, others in plain decimals without trailing zeros, those from 1e38 or below 1e-21 with an exponent.

Tables: calls(conv_id, turn, call_id, name, arguments, depends_on array<string>), results(conv_id, call_id, turn, content),
tools(name, field, type, required) with a row for each field; types are string, integer, number, boolean, object, array.

Defined cases: a call without a result is 'missing_result', with several 'ambiguous' and takes the result of the earliest turn;
arguments that are null or no JSON object are 'invalid' with the error 'not an object', an object that names a key twice (at any
level) with 'duplicate keys'; where arguments don't parse or name a key twice, their text stands in the JSON as a string; 1.0 and 1e2
are integers, as JSON Schema has it; a null or unknown tool is 'unknown tool';
a dependency that no call of the conversation has is left out and named in the errors; calls that wait for each other are a 'cycle'
and have no level; repeated calls of one identifier count as the earliest; results without a call are left out; rows with a null
conversation or call id take no part; empty tables give empty ones; other columns are dropped, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored

KEYS = ["conv_id", "call_id"]


def linked(calls: DataFrame, results: DataFrame) -> DataFrame:
    """One row a call: conv_id, call_id, turn, name, arguments, depends_on, content (null: none) and n_results, by a hash join."""
    known = calls.filter(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull())
    one = known.groupBy(*KEYS).agg(F.min(F.struct("turn", "name", "arguments", "depends_on")).alias("c")).select(*KEYS, "c.*")
    got = results.filter(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull())
    first = got.groupBy(*KEYS).agg(F.min(F.struct("turn", "content")).alias("r"), F.count(F.lit(1)).alias("n_results")).select(*KEYS, F.col("r.content").alias("content"), "n_results")
    return one.join(first.hint("shuffle_hash"), KEYS, "left").withColumn("n_results", F.coalesce("n_results", F.lit(0)))


#: Conversations of at most so many calls are ordered in one row each, larger ones by rounds over all executors.
MOST = 256


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level: the longest chain of calls that a call waits for; null in or behind a cycle."""
    large = stored(calls.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > MOST).select("conv_id"), "large-conversations")
    if large.isEmpty():
        return levels_in_rows(calls)
    return levels_in_rows(calls.join(large, "conv_id", "left_anti")).unionByName(levels_by_rounds(calls.join(large, "conv_id", "left_semi")))


def levels_in_rows(calls: DataFrame) -> DataFrame:
    """levels of conversations of at most MOST calls: each round gives a level to the calls whose needs all have one."""
    packed = calls.groupBy("conv_id").agg(F.collect_list(F.struct("call_id", "depends_on")).alias("c")).withColumn("ids", F.transform("c", lambda x: x.call_id))
    places = lambda x: F.filter(F.transform(F.array_distinct(F.coalesce(x.depends_on, F.array().cast("array<string>"))), lambda d: F.array_position("ids", d)), lambda p: p > 0)
    packed = packed.withColumn("needs", F.transform("c", places))
    at = lambda found, p: F.get(found, (p - 1).cast("int"))
    level = lambda found, needs: F.when(~F.exists(needs, lambda p: at(found, p).isNull()), F.coalesce(F.array_max(F.transform(needs, lambda p: at(found, p))) + 1, F.lit(0)))
    found = F.aggregate(F.sequence(F.lit(1), F.size("ids")), F.transform("ids", lambda i: F.lit(None).cast("int")), lambda found, _: F.transform("needs", lambda needs: level(found, needs)))
    return packed.select("conv_id", F.explode(F.arrays_zip("ids", found.alias("found"))).alias("x")).select("conv_id", F.col("x.ids").alias("call_id"), F.col("x.found").alias("level"))


def levels_by_rounds(calls: DataFrame) -> DataFrame:
    """levels of conversations of any size. Each round takes out the calls that wait for none of the rest, so there are as many rounds
    as levels."""
    nodes = stored(calls.select(*KEYS), "calls")
    edges = calls.select(*KEYS, F.explode(F.array_distinct("depends_on")).alias("needs"))
    there = nodes.select("conv_id", F.col("call_id").alias("needs"))
    edges = stored(edges.join(there, ["conv_id", "needs"], "left_semi"), "call-edges")
    done, level = None, 0
    while True:
        ready = stored(nodes.join(edges.select(*KEYS).distinct(), KEYS, "left_anti"), "ready-calls")
        if ready.isEmpty():
            break
        part = ready.withColumn("level", F.lit(level))
        done = part if done is None else done.unionByName(part)
        old = [edges, nodes]
        edges = stored(edges.join(ready.select("conv_id", F.col("call_id").alias("needs")), ["conv_id", "needs"], "left_anti"), "call-edges")
        nodes = stored(nodes.join(ready, KEYS, "left_anti"), "calls")
        discard(*old)
        level += 1
    rest = nodes.withColumn("level", F.lit(None).cast("int"))
    return rest if done is None else done.unionByName(rest)


def canonical_number(t: Column) -> Column:
    """The one form of a number's JSON text."""
    d = t.try_cast("double")
    exponent = F.replace(F.replace(d.cast("string"), F.lit(".0E"), F.lit("E")), F.lit("E"), F.lit("e"))
    plain = F.when(~F.contains(t, F.lit("E")), t).when(d == F.rint(d), d.try_cast("decimal(38,0)").cast("string"))
    plain = plain.when(F.abs(d) < 1, d.try_cast("decimal(38,38)").cast("string")).otherwise(d.try_cast("decimal(38,18)").cast("string"))
    plain = F.when(F.contains(plain, F.lit(".")), F.regexp_replace(plain, r"\.?0+$", "")).otherwise(plain)
    return F.when((F.abs(d) >= 1e38) | ((d != 0) & (F.abs(d) < 1e-21)), exponent).when(d == 0, F.lit("0")).otherwise(plain)


def canonical_json(json: Column) -> Column:
    """The JSON text of a variant with every number in its one form. What stands between quotes isn't touched: escaped backslashes and
    quotes stand aside as control characters, which JSON text can't hold, while the text is split at its quotes."""
    aside = F.replace(F.replace(json, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    numbers = lambda x: F.array_join(F.transform(F.regexp_extract_all(x, F.lit("(-?[0-9][-+.0-9eE]*|[^-0-9]+)"), F.lit(1)), lambda t: F.when(t.rlike("^-?[0-9]"), canonical_number(t)).otherwise(t)), "")
    joined = F.array_join(F.transform(F.split(aside, '"', -1), lambda x, i: F.when(i % 2 == 0, numbers(x)).otherwise(x)), '"')
    back = F.replace(F.replace(joined, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))
    return F.when(json.rlike("[0-9][.E]|-0"), back).otherwise(json)


def type_fits(value: Column, wanted: Column) -> Column:
    """Whether a variant is of a schema's type; unknown types fit."""
    kind, text = F.schema_of_variant(value), F.to_json(value)
    number = kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    whole = F.when(F.contains(text, F.lit("E")), text.try_cast("double") == F.rint(text.try_cast("double"))).otherwise(text.rlike(r"^-?[0-9]+(\.0*)?$"))
    return (
        F.when(wanted == "string", kind == "STRING")
        .when(wanted == "integer", number & whole)
        .when(wanted == "number", number)
        .when(wanted == "boolean", kind == "BOOLEAN")
        .when(wanted == "object", kind.startswith("OBJECT"))
        .when(wanted == "array", kind.startswith("ARRAY"))
        .otherwise(F.lit(True))
    )


def validated(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """calls with parsed (variant of the arguments) and errors (array<string>, sorted)."""
    schema = tools.filter(F.col("name").isNotNull()).groupBy("name").agg(F.array_sort(F.collect_set(F.struct("field", "type", "required"))).alias("fields"))
    joined = calls.join(schema, "name", "left").withColumn("parsed", F.try_parse_json("arguments"))
    joined = joined.withColumn("args", F.when(F.schema_of_variant("parsed").startswith("OBJECT"), F.col("parsed").cast("map<string,variant>")))

    def wrong(f: Column) -> Column:
        value = F.try_element_at("args", f.field)
        return F.when(~F.map_contains_key("args", f.field), F.when(f.required, F.concat(F.lit("missing "), f.field))).when(
            ~type_fits(value, f.type), F.concat(F.lit("wrong type "), f.field)
        )

    extra = F.transform(F.array_except(F.map_keys("args"), F.transform("fields", lambda f: f.field)), lambda x: F.concat(F.lit("unexpected "), x))
    # A variant can't hold a key twice; where the text is JSON all the same, that is what's wrong.
    twice = F.col("parsed").isNull() & F.startswith(F.ltrim("arguments"), F.lit("{")) & F.get_json_object("arguments", "$").isNotNull()
    errors = F.when(F.col("fields").isNull(), F.array(F.lit("unknown tool"))).when(twice, F.array(F.lit("duplicate keys"))).when(F.col("args").isNull(), F.array(F.lit("not an object")))
    errors = errors.otherwise(F.array_sort(F.concat(F.array_compact(F.transform("fields", wrong)), extra)))
    return joined.withColumn("errors", errors).drop("fields", "args")


def link_tool_calls(calls: DataFrame, results: DataFrame, tools: DataFrame) -> DataFrame:
    """conv_id, call_id, position long (place in the conversation's topological order, from 0), level int, status string (ok, invalid,
    missing_result, ambiguous or cycle; the last of these that holds), errors string (joined by '; '), json string."""
    one = stored(linked(calls, results), "linked-calls")
    placed = validated(one, tools).join(levels(one), KEYS)
    there = one.select("conv_id", F.col("call_id").alias("needs"))
    gone = one.select(*KEYS, F.explode(F.array_distinct("depends_on")).alias("needs")).filter("needs is not null").join(there, ["conv_id", "needs"], "left_anti")
    gone = gone.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.concat(F.lit("no call "), F.col("needs")))).alias("gone"))
    placed = placed.join(gone, KEYS, "left")
    errors = F.concat("errors", F.coalesce("gone", F.array().cast("array<string>")))
    status = (
        F.when(F.col("level").isNull(), "cycle")
        .when(F.col("n_results") > 1, "ambiguous")
        .when(F.col("n_results") == 0, "missing_result")
        .when(F.size(errors) > 0, "invalid")
        .otherwise("ok")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("level").asc_nulls_last(), "turn", "call_id")
    text = lambda c: F.substring(F.to_json(F.array(c)), F.lit(2), F.length(F.to_json(F.array(c))) - 2)  # a JSON string of a text
    shown = F.when(F.col("parsed").isNotNull(), canonical_json(F.to_json("parsed"))).when(F.col("arguments").isNotNull(), text(F.col("arguments")))
    parts = [  # names in ascending order; what is null drops out
        F.concat(F.lit('"arguments":'), shown),
        F.concat(F.lit('"call_id":'), text(F.col("call_id"))),
        F.when(F.col("name").isNotNull(), F.concat(F.lit('"name":'), text(F.col("name")))),
        F.when(F.col("content").isNotNull(), F.concat(F.lit('"result":'), text(F.col("content")))),
    ]
    json = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return placed.select(*KEYS, (F.row_number().over(order) - 1).cast("bigint").alias("position"), "level", status.alias("status"), F.concat_ws("; ", errors).alias("errors"), json.alias("json"))


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of a table (conv_id, turn, role, text): a user's turn calls a tool, the next turn of the assistant is its
    result, and a call waits for an earlier one of its conversation. Some calls are made wrong, by their ids, for the checks."""
    conv, turn = F.col("conv_id"), F.col("turn")
    name = lambda c, t: F.concat(c, F.lit("-"), t)
    limit = F.when(conv % 11 == 0, F.concat(F.lit('"'), turn, F.lit('"'))).otherwise(turn.cast("string"))
    body = F.to_json(F.array(F.coalesce("text", F.lit(""))))
    query = F.substring(body, F.lit(2), F.length(body) - 2)
    fields = [
        F.concat(F.lit('"limit": '), limit),
        F.when(conv % 13 != 0, F.concat(F.lit('"query": '), query)),
        F.when(conv % 17 == 0, F.lit('"debug": true')),
    ]
    arguments = F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))
    before = F.floor((turn - 2) / 4) * 2 + turn % 2
    needs = F.when(turn >= 2, F.array(name(conv, before))).otherwise(F.array().cast("array<string>"))
    tool = F.element_at(F.array(*map(F.lit, ("search", "lookup", "report"))), (turn % 3 + 1).cast("int"))
    calls = turns.filter("role = 'user'").select(conv, turn, name(conv, turn).alias("call_id"), tool.alias("name"), arguments.alias("arguments"), needs.alias("depends_on"))
    results = turns.filter("role = 'assistant'").select(conv, name(conv, turn - 1).alias("call_id"), turn, F.col("text").alias("content"))
    return calls, results


def own_tools(spark) -> DataFrame:
    """The schemas of the tools that from_conversations calls."""
    rows = [("search", "query", "string", True), ("search", "limit", "integer", False), ("lookup", "query", "string", True), ("lookup", "limit", "integer", True), ("report", "query", "string", False), ("report", "limit", "number", False), ("report", "debug", "boolean", False)]
    # Literals in one expression, as a local table would start Python for its rows.
    made = F.array(*(F.struct(F.lit(a).alias("name"), F.lit(b).alias("field"), F.lit(c).alias("type"), F.lit(d).alias("required")) for a, b, c, d in rows))
    return spark.range(1).select(F.explode(made).alias("t")).select("t.*")
