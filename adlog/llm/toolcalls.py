"""Tool-call linking: calls and results of conversations by identifier, in topological order, validated, as canonical JSON.

Everything is DataFrame operations. A call may name one call whose result it needs (``after``). Calls keep the order of their
positions, but none comes before what it needs: a call counts as placed where the last of its predecessors is placed, and
among calls of one place those with fewer predecessors come first. Results follow their call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlog.llm.common import stage

#: Type of a JSON value by the first word of its variant type. Whole numbers are numbers too.
_TYPES = {
    "string": ("STRING",),
    "integer": ("BIGINT",),
    "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"),
    "boolean": ("BOOLEAN",),
    "object": ("OBJECT",),
    "array": ("ARRAY",),
    "null": ("VOID",),
}


def validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """Calls with ``parsed`` (their arguments as a variant, NULL if they are no JSON) and ``errors``, sorted.

    ``schemas`` has a row for each field of each tool: name, field, type (of the JSON kinds), required; a tool without fields
    has one with a NULL field. Errors: not_json, not_object, unknown_tool, missing:<field>, type:<field>, unknown:<field>.
    Repeated keys are no JSON. NULL arguments are those of an empty object.
    """
    field = F.struct("field", "type", "required")
    tools = schemas.groupBy("name").agg(F.collect_set(F.when(F.col("field").isNotNull(), field)).alias("fields"))
    tools = tools.select(F.col("name").alias("tool"), "fields")
    rows = calls.withColumn("parsed", F.expr("try_parse_json(coalesce(arguments, '{}'))"))
    rows = rows.withColumn("given", F.expr("try_variant_get(parsed, '$', 'map<string, variant>')"))
    kinds = F.transform(F.map_entries("given"), lambda e: F.struct(e.key.alias("field"), F.regexp_extract(F.schema_of_variant(e.value), "^[A-Z]+", 0).alias("kind")))
    rows = rows.withColumn("kinds", kinds).join(F.broadcast(tools) if _few(tools) else tools, F.col("name") == F.col("tool"), "left")
    has = lambda f: F.exists("kinds", lambda k: k.field == f.field)
    fits = lambda f, k: F.coalesce(F.array_contains(F.element_at(_type_map(), f.type), k.kind), F.lit(False))
    missing = F.transform(F.filter("fields", lambda f: f.required & ~has(f)), lambda f: F.concat(F.lit("missing:"), f.field))
    wrong = F.filter("kinds", lambda k: F.exists("fields", lambda f: (f.field == k.field) & ~fits(f, k)))
    unknown = F.filter("kinds", lambda k: ~F.exists("fields", lambda f: f.field == k.field))
    errors = (
        F.when(F.col("parsed").isNull(), F.array(F.lit("not_json")))
        .when(F.col("given").isNull(), F.array(F.lit("not_object")))
        .when(F.col("tool").isNull(), F.array(F.lit("unknown_tool")))
        .otherwise(
            F.concat(missing, F.transform(wrong, lambda k: F.concat(F.lit("type:"), k.field)), F.transform(unknown, lambda k: F.concat(F.lit("unknown:"), k.field)))
        )
    )
    return rows.withColumn("errors", F.sort_array(errors)).drop("given", "kinds", "tool", "fields")


def _few(tools: DataFrame) -> bool:
    return tools.limit(10_001).count() <= 10_000


def _type_map() -> Column:
    return F.create_map(*[x for name, kinds in _TYPES.items() for x in (F.lit(name), F.array(*[F.lit(k) for k in kinds]))])


def ordered(calls: DataFrame) -> DataFrame:
    """Calls ``conv_id, call_id, position, after`` (identifiers once in a conversation) with ``at``, ``step`` and ``cyclic``.

    at: the largest position among a call and all its predecessors; step: their number. Pointers are doubled: each round, a
    call takes over the pointer of the call it points to, so a chain of n calls takes log2(n) rounds and no conversation is ever
    gathered in one place. What still points somewhere after that is on a cycle or behind one, and keeps its own position. A
    predecessor that is no call of the conversation is none.
    """
    ids = calls.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"))
    on = (F.col("conv_id") == F.col("c")) & (F.col("after") == F.col("i"))
    now = calls.select("conv_id", "call_id", "position", "after").join(ids, on, "left")
    now = now.select("conv_id", "call_id", F.col("i").alias("to"), F.col("i").isNotNull().cast("long").alias("step"), F.col("position").alias("at"))
    now = stage(now, "pointers")
    most = calls.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    for _ in range(most.bit_length() + 1):
        if now.where("to is not null").isEmpty():
            break
        other = now.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("to").alias("to2"), F.col("step").alias("step2"), F.col("at").alias("at2"))
        moved = now.where("to is not null").join(other, (F.col("conv_id") == F.col("c")) & (F.col("to") == F.col("i")))
        moved = moved.select("conv_id", "call_id", F.col("to2").alias("to"), (F.col("step") + F.col("step2")).alias("step"), F.greatest("at", "at2").alias("at"))
        now = stage(now.where("to is null").unionByName(moved), "pointers")
    found = now.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), "step", "at", F.col("to").isNotNull().alias("cyclic"))
    rows = calls.join(found, (F.col("conv_id") == F.col("c")) & (F.col("call_id") == F.col("i")), "left").drop("c", "i")
    cyclic = F.coalesce("cyclic", F.lit(False))
    return rows.select(
        *calls.columns,
        F.when(cyclic | F.col("at").isNull(), F.col("position")).otherwise(F.col("at")).alias("at"),
        F.when(cyclic | F.col("step").isNull(), F.lit(0)).otherwise(F.col("step")).cast("long").alias("step"),
        cyclic.alias("cyclic"),
    )


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row for each call and each result: conv_id, at, step, place, kind, call_id, name, errors, json.

    ``conv_id, at, step, call_id, kind, place`` is the order of a conversation. calls: conv_id, position (long), call_id, name,
    arguments (JSON text), after; results: conv_id, position, call_id, content. More columns are ignored.

    NULL identifiers and conversations link nothing: such calls stand at their own position, such results are orphans (error
    unknown_call). Calls equal in all columns are one. Of different calls with one identifier the smallest by position, name and
    arguments is linked, the others have the error repeated_id and stand at their own position. A call without a result has
    none. Several results of a call follow it in order. Empty tables give no rows.
    """
    calls = calls.select("conv_id", F.col("position").cast("long").alias("position"), "call_id", "name", "arguments", "after").distinct()
    calls = stage(validated(calls, schemas).select("*"), "calls")
    sort = F.struct("position", "name", "arguments", "after")
    first = calls.groupBy("conv_id", "call_id").agg(F.min(sort).alias("first"))
    known = first.where("conv_id is not null and call_id is not null")
    known = known.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), "first")
    rows = calls.join(known, (F.col("conv_id") == F.col("c")) & (F.col("call_id") == F.col("i")), "left").withColumn("one", F.coalesce(F.col("first") == sort, F.lit(False)))
    rows = stage(rows.drop("c", "i", "first"), "linkable")
    good = ordered(rows.where("one").drop("one"))
    alone = rows.where("not one").drop("one").withColumns({"at": F.col("position"), "step": F.lit(0).cast("long"), "cyclic": F.lit(False)})
    alone = alone.withColumn("errors", F.when(F.col("call_id").isNotNull() & F.col("conv_id").isNotNull(), F.array_append("errors", "repeated_id")).otherwise(F.col("errors")))
    good = good.withColumn("errors", F.when(F.col("cyclic"), F.array_append("errors", "cycle")).otherwise(F.col("errors")))
    good = stage(good.drop("cyclic"), "ordered")

    value = F.struct(F.col("parsed").alias("arguments"), F.col("call_id").alias("id"), F.col("name"), F.lit("call").alias("type"))
    raw = F.struct(F.col("arguments"), F.col("call_id").alias("id"), F.col("name"), F.lit("call").alias("type"))
    text = F.when(F.col("parsed").isNotNull(), F.to_json(value)).otherwise(F.to_json(raw))
    said = good.unionByName(alone.drop("cyclic")).select(
        "conv_id", "at", "step", F.col("position").alias("place"), F.lit("call").alias("kind"), "call_id", "name", F.sort_array("errors").alias("errors"), text.alias("json")
    )
    target = good.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), "at", "step", "name").hint("shuffle_hash")
    answers = results.select("conv_id", F.col("position").cast("long").alias("position"), "call_id", "content")
    answers = answers.join(target, (F.col("conv_id") == F.col("c")) & (F.col("call_id") == F.col("i")), "left")
    orphan = F.col("i").isNull()
    answers = answers.select(
        "conv_id",
        F.when(orphan, F.col("position")).otherwise(F.col("at")).alias("at"),
        F.when(orphan, F.lit(0)).otherwise(F.col("step")).cast("long").alias("step"),
        F.col("position").alias("place"),
        F.lit("result").alias("kind"),
        "call_id",
        "name",
        F.when(orphan, F.array(F.lit("unknown_call"))).otherwise(F.array().cast("array<string>")).alias("errors"),
        F.to_json(F.struct("content", F.col("call_id").alias("id"), F.lit("result").alias("type"))).alias("json"),
    )
    return said.unionByName(answers)


#: The tools of the query.
TOOLS = [
    ("lookup", "query", "string", True),
    ("lookup", "limit", "integer", False),
    ("translate", "text", "string", True),
    ("translate", "to", "string", True),
    ("note", "body", "string", True),
    ("note", "pinned", "boolean", False),
]


def tools(spark: SparkSession) -> DataFrame:
    """:data:`TOOLS` as a table of schemas."""
    values = ", ".join(f"('{n}', '{f}', '{t}', {str(r).lower()})" for n, f, t, r in TOOLS)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(name, field, type, required)")


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results made of plain conversations: each turn of the assistant becomes a call whose tool and arguments
    follow from its text, each other turn the result of the turn before.

    By the length of the text, some arguments lack a field, have a wrong type or end in a wrong bracket; all hold the whole text. In every fifth conversation a
    call needs the one after it, in the others the one before.
    """
    said = conversations.withColumn("n", F.length("text"))
    name = F.element_at(F.array(F.lit("lookup"), F.lit("translate"), F.lit("note")), F.pmod(F.coalesce("n", F.lit(0)), F.lit(3)) + 1)
    lookup = F.to_json(F.struct(F.col("text").alias("query"), F.when(F.col("n") % 7 == 0, F.lit("5")).alias("limit")))
    lookup_good = F.to_json(F.struct(F.col("text").alias("query"), (F.col("n") % 20).alias("limit")))
    translate = F.to_json(F.struct(F.when(F.col("n") % 11 != 0, F.lit("en")).alias("to"), F.col("text")))
    note = F.to_json(F.struct((F.col("n") % 2 == 0).alias("pinned"), F.col("text").alias("body")))
    made = F.when(name == "lookup", F.when(F.col("n") % 7 == 0, lookup).otherwise(lookup_good)).when(name == "translate", translate).otherwise(note)
    made = F.when(F.col("n") % 13 == 0, F.regexp_replace(made, r"\}\z", "]")).otherwise(made)
    ident = lambda turn: F.concat_ws("_", F.lit("call"), turn.cast("string"))
    after = F.when(F.col("conv_id") % 5 == 0, F.col("turn") + 2).otherwise(F.col("turn") - 2)
    calls = said.where("role = 'assistant'").select(
        "conv_id", F.col("turn").alias("position"), ident(F.col("turn")).alias("call_id"), name.alias("name"), made.alias("arguments"), ident(after).alias("after")
    )
    results = said.where("role is null or role <> 'assistant'").select(
        "conv_id", F.col("turn").alias("position"), ident(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content")
    )
    return calls, results
