import json
import random
import re

from pyspark.sql import functions as F

from tallyline.llm import toolcalls

NAMES = [c.split()[0] for c in toolcalls.MESSAGE.split(", ")]


def plain_problems(arguments, tool):
    params = {p: rest for t, p, *rest in toolcalls.TOOLS if t == tool}
    if not params:
        return ["unknown_tool"]

    def once(pairs):
        if len({k for k, _ in pairs}) < len(pairs):
            raise ValueError
        return dict(pairs)

    try:
        given = json.loads(arguments, object_pairs_hook=once)
    except (ValueError, TypeError):
        return ["bad_json"]
    if not isinstance(given, dict):
        return ["not_object"]
    found = [f"unknown:{k}" for k in given if k not in params]
    for name, (kind, required, least, most, allowed) in params.items():
        if name not in given:
            found += [f"missing:{name}"] if required else []
            continue
        value = given[name]
        is_kind = {"string": isinstance(value, str), "boolean": isinstance(value, bool), "integer": isinstance(value, int) and not isinstance(value, bool)}[kind]
        if not is_kind:
            found.append(f"type:{name}")
        elif (least is not None and value < least) or (most is not None and value > most) or (allowed is not None and value not in allowed):
            found.append(f"value:{name}")
    return found


def plain_chat(rows):
    """Conversation by conversation, with dictionaries and recursion."""
    made = []
    by_chat = {}
    for number, row in enumerate(rows):
        by_chat.setdefault(row["conv_id"], []).append((number, row))
    for chat in by_chat.values():
        calls, answers = {}, {}
        for number, r in sorted(chat, key=lambda x: (x[1]["position"], x[1]["arguments"] or "", x[0])):
            if r["kind"] == "call" and r["call_id"] is not None:
                calls.setdefault(r["call_id"], (number, r))
            if r["kind"] == "result" and r["call_id"] is not None:
                answers.setdefault(r["call_id"], []).append((r["position"], number))
        needs = {c: {n for n in (r["needs"] or []) if n is not None} for c, (_, r) in calls.items()}
        place = {}
        while True:
            ready = [c for c in calls if c not in place and all(n in place or n not in calls for n in needs[c])]
            if not ready:
                break
            for c in ready:
                own = calls[c][1]["position"]
                before = [place[n] for n in needs[c] if n in calls]
                at = max([own, *(b[2] for b in before)])
                place[c] = (at, max([0, *(b[1] + 2 for b in before)]), max([at, *(a[0] for a in answers.get(c, []))]))
        for number, r in chat:
            at, depth, linked, wrong = r["position"], 0, False, []
            c = r["call_id"]
            if r["kind"] == "call":
                if c is None:
                    wrong = ["no_result"]
                elif calls[c][0] != number:
                    wrong = ["duplicate_id"]
                else:
                    if c in place:
                        at, depth = place[c][:2]
                    else:
                        wrong.append("cycle")
                    wrong += ["missing_dependency"] if any(n not in calls for n in needs[c]) else []
                    linked = c in answers
                    wrong += [] if linked else ["no_result"]
                wrong = wrong + plain_problems(r["arguments"], r["tool"])
            elif r["kind"] == "result":
                if c is None or c not in calls:
                    wrong = ["no_call"]
                else:
                    linked = True
                    base = place.get(c, (calls[c][1]["position"], 0))
                    at, depth = max(r["position"], base[0]), base[1] + 1
                    wrong = [] if (r["position"], number) == min(answers[c]) else ["duplicate_result"]
            made.append((r["conv_id"], r["position"], r["kind"], c, at, depth, linked, sorted(set(wrong))))
    return made


def message(conv, position, kind, call_id=None, tool=None, arguments=None, needs=None, content=None):
    return dict(zip(NAMES, (conv, position, kind, "assistant", call_id, tool, arguments, needs, content), strict=True))


def run(spark, rows):
    frame = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], toolcalls.MESSAGE)
    return toolcalls.format_chat(frame.coalesce(1), toolcalls.tool_schemas(spark))


def key(row):
    return str(row)


def test_random_chats_equal_brute_force(spark):
    draw = random.Random(1)
    arguments = [
        '{"query":"x","limit":5}', '{"limit":99,"query":"x"}', '{"query":1,"limit":2}', '{"query":"x","limit":2,"scope":"some"}', '{"query":"x","limit":2,"more":[1]}',
        '{"a":1,"a":2}', "nope", None, "[1]", '{"text":"t","target":"en","exact":true}', '{"text":"t","target":"xx"}', '{"text":"t","words":10.5}', '{"text":null}', '{"query":"x","limit":7}',
    ]
    rows = []
    for conv in range(25):
        ids = [f"i{k}" for k in range(draw.randint(1, 7))]
        for position in range(draw.randint(1, 18)):
            kind = draw.choice(["call", "call", "result", "text"])
            if kind == "call":
                needs = draw.choice([None, [], [draw.choice(ids)], draw.choices([*ids, "gone"], k=2)])
                rows.append(message(conv, position, kind, draw.choice([*ids, *ids, None]), draw.choice(["search", "summarise", "translate", "fly", None]), draw.choice(arguments), needs))
            elif kind == "result":
                rows.append(message(conv, position, kind, draw.choice([*ids, "lost", None]), content="r"))
            else:
                rows.append(message(conv, position, kind, content="hello"))
    got = [(r["conv_id"], r["position"], r["kind"], r["call_id"], r["order_at"], r["depth"], r["linked"], list(r["problems"])) for r in run(spark, rows).collect()]
    assert sorted(got, key=key) == sorted(plain_chat(rows), key=key)


def test_long_chain_is_ordered(spark):
    n = 9
    rows = [message(1, n - k, "call", f"c{k}", "search", '{"query":"q","limit":1}', [f"c{k - 1}"] if k else []) for k in range(n)]
    rows += [message(1, 100 - k, "result", f"c{k}", content="x") for k in range(n)]
    made = run(spark, rows).collect()
    place = {(r["kind"], r["call_id"]): k for k, r in enumerate(made)}
    for k in range(n):
        assert place["call", f"c{k}"] < place["result", f"c{k}"]
        assert not k or place["result", f"c{k - 1}"] < place["call", f"c{k}"]
    assert all(not r["problems"] for r in made)


def test_json_is_canonical(spark):
    one = '{"b": {"z": [1, 2.50, {"y": null, "x": true}], "a": "é\\n\\"/"}, "limit": 1.0, "query": "q"}'
    two = '{"query":"q","limit":1,"b":{"a":"\\u00e9\\n\\"/","z":[1,2.5,{"x":true,"y":null}]}}'
    rows = [message(1, 0, "call", "a", "search", one), message(2, 0, "call", "a", "search", two), message(3, 0, "call", "a", "search", "no json")]
    lines = {r["conv_id"]: r["json"] for r in run(spark, rows).collect()}
    assert lines[1] == lines[2]
    assert lines[1] == json.dumps(json.loads(lines[1]), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert json.loads(lines[3])["arguments"] == "no json"


def test_turns(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "what is it"), (1, 2, "assistant", "a thing"), (1, 3, "user", "and that"), (2, 0, "assistant", "hello"), (2, 1, None, None), (None, 0, "user", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("kind", F.lit("clash"))
    made = toolcalls.format_chat(toolcalls.from_turns(turns), toolcalls.tool_schemas(spark))
    got = {(r["conv_id"], r["position"]): r for r in made.collect()}
    assert len(got) == 7 and got[1, 1]["linked"] and got[1, 2]["linked"] and got[1, 3]["problems"] == ["no_result", "value:words"]
    assert got[2, 0]["problems"] == ["no_call"] and got[None, 0]["problems"] == ["no_result", "value:limit"]
    assert json.loads(got[1, 1]["json"])["arguments"] == {"limit": 3, "query": "what is it", "scope": "all"}
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty(spark):
    assert toolcalls.format_chat(spark.createDataFrame([], toolcalls.MESSAGE), toolcalls.tool_schemas(spark)).count() == 0
