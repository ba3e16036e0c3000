"""Chat formatting with tool calls, in DataFrame operations only.

Messages of a conversation are texts, calls (an identifier, a tool, JSON arguments, and
the identifiers whose results it needs) and results (an identifier and a content). Calls
and results are joined by conversation and identifier. Calls are put after what they
need, level by level, in rounds that touch only calls still waiting; a message keeps its
place otherwise: it is ordered by the latest position among itself and all it needs,
then by depth. Arguments are checked against the tool's schema. Each message becomes
one line of canonical JSON: keys sorted at every level, no blanks, numbers in one form.

No conversation is gathered in one task: the order is a pair of columns
(``order_at``, ``depth``), and rows are range-sorted.

Defined results: ``problems`` lists, sorted, what is wrong with a message: for calls
``no_result``, ``duplicate_id``, ``unknown_tool``, ``bad_json`` (not JSON, or a key
twice), ``not_object``, ``missing:<p>``, ``unknown:<p>``, ``type:<p>``, ``value:<p>``,
``missing_dependency``, ``cycle``; for results ``no_call`` and ``duplicate_result``. The
first of several calls with an identifier (by position, then arguments) is the call, the
others are ``duplicate_id`` and link with nothing; every result of a call links.
Arguments that are not JSON stay a string in the line. A call in a cycle, or behind one,
keeps its position with depth 0. NULL conversations are one conversation; a NULL
identifier links with nothing; equal rows stay rows; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import Stash

MESSAGE = (
    "conv_id long, position long, kind string, role string, call_id string, tool string, arguments string,"
    " needs array<string>, content string"
)
SCHEMA = "tool string, parameter string, kind string, required boolean, least double, most double, allowed array<string>"

# Parameters of the tools that the bound query uses.
TOOLS = [
    ("search", "limit", "integer", True, 1.0, 60.0, None),
    ("search", "query", "string", True, None, None, None),
    ("search", "scope", "string", False, None, None, ["all", "recent"]),
    ("summarise", "text", "string", True, None, None, None),
    ("summarise", "words", "integer", False, 10.0, 200.0, None),
    ("translate", "exact", "boolean", False, None, None, None),
    ("translate", "target", "string", True, None, None, ["de", "en", "fr"]),
    ("translate", "text", "string", True, None, None, None),
]


def tool_schemas(spark: SparkSession, tools: list[tuple] = TOOLS) -> DataFrame:
    """One row per tool and parameter."""
    fields = [f.split() for f in SCHEMA.split(", ")]
    rows = [
        F.struct(
            *[
                (F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value)).cast(kind).alias(name)
                for value, (name, kind) in zip(tool, fields, strict=True)
            ]
        )
        for tool in tools
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _by_tool(schemas: DataFrame) -> DataFrame:
    fields = F.struct("parameter", "kind", "required", "least", "most", "allowed")
    return schemas.groupBy(F.col("tool").alias("s_tool")).agg(F.sort_array(F.collect_list(fields)).alias("params"))


def _kind_of(value: Column) -> Column:
    """JSON type of a variant."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind == "BIGINT", "integer")
        .when(kind.startswith("DECIMAL") & kind.endswith(",0)"), "integer")
        .when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), "number")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("OBJECT"), "object")
        .otherwise("null")
    )


def _path(name: Column) -> Column:
    return F.concat(F.lit("$['"), name, F.lit("']"))


def argument_problems(arguments: Column, parsed: Column, params: Column) -> Column:
    """What is wrong with a call's arguments under its tool's parameters."""
    keys = F.json_object_keys(arguments)

    def of(p: Column) -> Column:
        value = F.variant_get(parsed, _path(p["parameter"]), "variant")
        number = F.try_variant_get(parsed, _path(p["parameter"]), "double")
        text = F.try_variant_get(parsed, _path(p["parameter"]), "string")
        kind = _kind_of(value)
        fits = (kind == p["kind"]) | ((p["kind"] == "number") & (kind == "integer"))
        outside = F.coalesce(number < p["least"], F.lit(False)) | F.coalesce(number > p["most"], F.lit(False))
        other = p["allowed"].isNotNull() & ~F.coalesce(F.array_contains(p["allowed"], text), F.lit(False))
        return (
            F.when(~F.array_contains(keys, p["parameter"]), F.when(p["required"], F.concat(F.lit("missing:"), p["parameter"])))
            .when(~fits, F.concat(F.lit("type:"), p["parameter"]))
            .when(outside | other, F.concat(F.lit("value:"), p["parameter"]))
        )

    names = F.transform(params, lambda p: p["parameter"])
    unknown = F.transform(F.array_except(keys, names), lambda k: F.concat(F.lit("unknown:"), k))
    found = F.filter(F.concat(F.transform(params, of), unknown), lambda x: x.isNotNull())
    return (
        F.when(params.isNull(), F.array(F.lit("unknown_tool")))
        .when(parsed.isNull(), F.array(F.lit("bad_json")))
        .when(~F.schema_of_variant(parsed).startswith("OBJECT"), F.array(F.lit("not_object")))
        .otherwise(found)
    )


def order_calls(calls: DataFrame, stash: Stash) -> DataFrame:
    """Stored ``(c, call_id, order_at, depth, ready_at, trouble)`` of each call.

    ``calls`` has ``c, call_id, position, answered`` (latest position of its results) and
    ``needs``. A call is ordered once all it needs are; there are as many rounds as the
    longest chain has calls.
    """
    calls = stash.put(calls, "calls")
    wanted = calls.select("c", F.col("call_id").alias("by"), F.explode(F.array_distinct("needs")).alias("on"))
    wanted = wanted.where(F.col("on").isNotNull())
    known = calls.select("c", F.col("call_id").alias("on"), F.lit(True).alias("there"))
    links = stash.put(wanted.join(known, ["c", "on"], "left"), "needs")
    open_links = links.where("there").select("c", "by", "on")
    tally = links.groupBy("c", "by").agg(
        F.count("there").alias("waits"), F.max(F.col("there").isNull()).alias("lacks")
    )
    state = calls.join(tally.withColumnRenamed("by", "call_id"), ["c", "call_id"], "left").select(
        "c",
        "call_id",
        "position",
        "answered",
        F.coalesce("waits", F.lit(0)).cast("long").alias("waits"),
        F.coalesce("lacks", F.lit(False)).alias("lacks"),
        F.col("position").alias("order_at"),
        F.lit(0).cast("long").alias("depth"),
    )
    state = stash.put(state, "state")
    done: list[DataFrame] = []
    while True:
        free = state.where("waits = 0").withColumn("ready_at", F.greatest("order_at", F.coalesce("answered", "order_at")))
        free = stash.put(free, "free")
        done.append(free)
        waiting = state.where("waits > 0")
        if free.isEmpty() or waiting.isEmpty():
            break
        given = (
            open_links.join(free.select("c", F.col("call_id").alias("on"), "ready_at", "depth"), ["c", "on"])
            .groupBy("c", "by")
            .agg(F.count("*").alias("got"), F.max("ready_at").alias("after"), F.max("depth").alias("deep"))
        )
        later = waiting.join(given.withColumnRenamed("by", "call_id"), ["c", "call_id"], "left").select(
            "c",
            "call_id",
            "position",
            "answered",
            (F.col("waits") - F.coalesce("got", F.lit(0))).alias("waits"),
            "lacks",
            F.greatest("order_at", F.coalesce("after", "order_at")).alias("order_at"),
            # A call stands two below the call it needs: the result lies between.
            F.greatest("depth", F.coalesce(F.col("deep") + 2, F.lit(0))).alias("depth"),
        )
        state = stash.put(later, "state")
    shown = ["c", "call_id", "order_at", "depth", "ready_at", "trouble"]
    lacking = F.when(F.col("lacks"), F.array(F.lit("missing_dependency"))).otherwise(F.array().cast("array<string>"))
    ordered = done[0]
    for part in done[1:]:
        ordered = ordered.unionByName(part)
    ordered = ordered.withColumn("trouble", lacking).select(shown)
    stuck = state.where("waits > 0").select(
        "c",
        "call_id",
        F.col("position").alias("order_at"),
        F.lit(0).cast("long").alias("depth"),
        F.greatest("position", F.coalesce("answered", "position")).alias("ready_at"),
        F.concat(lacking, F.array(F.lit("cycle"))).alias("trouble"),
    )
    return stash.put(ordered.unionByName(stuck), "ordered")


def format_chat(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """Linked, ordered and checked messages with a line of canonical JSON each.

    ``messages`` has the columns of :data:`MESSAGE`, ``schemas`` those of :data:`SCHEMA`.
    """
    stash = Stash(messages.sparkSession)
    names = [c.split()[0] for c in MESSAGE.split(", ")]
    rows = stash.put(
        messages.select(*names).withColumns(
            {
                # One key that is never NULL, so that NULL conversations join too.
                "c": F.coalesce(F.col("conv_id").cast("string"), F.lit("")),
                "row": F.monotonically_increasing_id(),
            }
        ),
        "messages",
    )
    asking = rows.where("kind = 'call' AND call_id IS NOT NULL")
    # An aggregate, not a window: an identifier that very many calls share is one row per task.
    best = asking.groupBy("c", "call_id").agg(F.min(F.struct("position", "arguments", "row")).alias("b"))
    best = stash.put(best.select("c", "call_id", F.col("b.row").alias("lead")), "leads")
    calls = stash.put(asking.join(best, ["c", "call_id"]).withColumn("leads", F.col("row") == F.col("lead")), "calls")
    leads = calls.where("leads").select("c", "call_id", "position", "needs")
    answers = rows.where("kind = 'result' AND call_id IS NOT NULL")
    answered = answers.groupBy("c", "call_id").agg(
        F.max("position").alias("answered"), F.min(F.struct("position", "row")).alias("f")
    )
    answered = stash.put(answered.select("c", "call_id", "answered", F.col("f.row").alias("first_row")), "answered")
    ordered = order_calls(leads.join(answered.drop("first_row"), ["c", "call_id"], "left"), stash)

    no_text = F.array().cast("array<string>")
    plain = rows.where("kind NOT IN ('call', 'result') OR call_id IS NULL OR kind IS NULL")
    unlinked = (
        F.when(F.col("kind") == "call", F.array(F.lit("no_result")))
        .when(F.col("kind") == "result", F.array(F.lit("no_call")))
        .otherwise(no_text)
    )
    plain = plain.select("*", F.col("position").alias("order_at"), F.lit(0).cast("long").alias("depth"), F.lit(False).alias("linked"), unlinked.alias("found"))

    facts = ordered.join(answered.select("c", "call_id", F.lit(True).alias("has")), ["c", "call_id"], "left")
    asked = calls.join(facts, ["c", "call_id"])
    wrong = F.when(
        F.col("leads"),
        F.concat("trouble", F.when(F.col("has"), no_text).otherwise(F.array(F.lit("no_result")))),
    ).otherwise(F.array(F.lit("duplicate_id")))
    asked = asked.select(
        *[F.col(n) for n in names],
        "c",
        "row",
        F.when(F.col("leads"), F.col("order_at")).otherwise(F.col("position")).alias("order_at"),
        F.when(F.col("leads"), F.col("depth")).otherwise(F.lit(0)).cast("long").alias("depth"),
        (F.col("leads") & F.coalesce("has", F.lit(False))).alias("linked"),
        wrong.alias("found"),
    )
    told = answers.join(ordered.select("c", "call_id", F.col("order_at").alias("call_at"), F.col("depth").alias("call_depth")), ["c", "call_id"], "left")
    told = told.join(answered.select("c", "call_id", "first_row"), ["c", "call_id"])
    wrong = F.when(F.col("call_at").isNull(), F.array(F.lit("no_call"))).otherwise(
        F.when(F.col("row") == F.col("first_row"), no_text).otherwise(F.array(F.lit("duplicate_result")))
    )
    told = told.select(
        *[F.col(n) for n in names],
        "c",
        "row",
        F.greatest("position", F.coalesce("call_at", "position")).alias("order_at"),
        F.coalesce(F.col("call_depth") + 1, F.lit(0)).cast("long").alias("depth"),
        F.col("call_at").isNotNull().alias("linked"),
        wrong.alias("found"),
    )
    every = plain.select(asked.columns).unionByName(asked).unionByName(told)

    checked = every.join(_by_tool(schemas), (F.col("kind") == "call") & (F.col("tool") == F.col("s_tool")), "left")
    checked = checked.withColumn("parsed", F.try_parse_json("arguments"))
    is_call = F.col("kind") == "call"
    bad = F.when(is_call, argument_problems(F.col("arguments"), F.col("parsed"), F.col("params"))).otherwise(no_text)
    checked = checked.withColumn("args_wrong", F.coalesce(bad, no_text))
    problems = F.array_sort(F.array_distinct(F.concat("found", "args_wrong")))
    given = F.coalesce(F.col("parsed"), F.col("arguments").cast("variant"))
    line = F.to_json(
        F.struct(
            F.when(is_call, given).alias("arguments"),
            "call_id",
            "content",
            "kind",
            F.when(is_call, F.col("needs")).alias("needs"),
            "role",
            "tool",
        )
    )
    return checked.select(
        "conv_id",
        "position",
        "kind",
        "call_id",
        "order_at",
        "depth",
        "linked",
        F.when(is_call, F.size("args_wrong") == 0).alias("arguments_valid"),
        problems.alias("problems"),
        line.alias("json"),
    ).orderBy("conv_id", "order_at", "depth", "position", "json")


def from_turns(turns: DataFrame) -> DataFrame:
    """Messages of plain conversations: user turns ask a tool, assistant turns answer the turn before.

    The tool goes by the turn; its arguments are made from the text. Within each six
    turns a call needs the result of the call before it.
    """
    turn, text = F.col("turn").cast("long"), F.coalesce("text", F.lit(""))
    user, reply = F.col("role") == "user", F.col("role") == "assistant"
    n_words = F.regexp_count(text, F.lit(r"\S+"))
    number = F.pmod(turn.bitwiseAND(F.lit(2**40 - 1)) / 2, F.lit(3)).cast("int")
    search = F.to_json(F.struct(text.alias("query"), n_words.alias("limit"), F.lit("all").alias("scope")))
    summarise = F.to_json(F.struct(n_words.alias("words"), text.alias("text")))
    translate = F.to_json(
        F.struct(text.alias("text"), F.element_at(F.array(F.lit("en"), F.lit("es"), F.lit("fr")), F.pmod(n_words, F.lit(3)) + 1).alias("target"))
    )
    asks = F.concat(F.lit("call-"), turn.cast("string"))
    before = F.concat(F.lit("call-"), (turn - 2).cast("string"))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        turn.alias("position"),
        F.when(user, "call").when(reply, "result").otherwise("text").alias("kind"),
        "role",
        F.when(user, asks).when(reply, F.concat(F.lit("call-"), (turn - 1).cast("string"))).alias("call_id"),
        F.when(user, F.element_at(F.array(F.lit("search"), F.lit("summarise"), F.lit("translate")), number + 1)).alias("tool"),
        F.when(user, F.when(number == 0, search).when(number == 1, summarise).otherwise(translate)).alias("arguments"),
        F.when(user & (number > 0), F.array(before)).alias("needs"),
        F.when(~user | user.isNull(), F.col("text")).alias("content"),
    )
