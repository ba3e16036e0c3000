import random

import numpy as np
from pyspark.sql import functions as F

from tallyline.llm import chunks

DOCS = "doc_id long, text string, source string, n_chars long"


def words(draw, count):
    return " ".join("".join(draw.choice("abcdefghijkl") for _ in range(draw.randint(2, 8))) for _ in range(count))


def test_gear_hash_is_the_rolling_sum():
    data = np.frombuffer(random.Random(1).randbytes(300), np.uint8)
    rolled, h = [], 0
    for byte in data:
        h = ((h << 1) + int(chunks.GEAR[byte])) & 0xFFFF
        rolled.append(h)
    assert chunks.gear_hashes(data).tolist()[15:] == [
        sum(int(chunks.GEAR[data[i - k]]) << k for k in range(16)) & 0xFFFF for i in range(15, 300)
    ]
    assert chunks.gear_hashes(data).tolist() == rolled


def test_cuts_cover_and_resist_shifts():
    draw = random.Random(2)
    text = words(draw, 400).encode()
    ends = chunks.cuts(text)
    assert ends[-1] == len(text) and ends == sorted(set(ends))
    pieces = {text[a:b] for a, b in zip([0, *ends], ends, strict=False)}
    moved = b"quite new " + text[:900] + b"inserted words " + text[900:]
    ends = chunks.cuts(moved)
    again = [moved[a:b] for a, b in zip([0, *ends], ends, strict=False)]
    assert sum(len(p) for p in again if p in pieces) > 0.9 * len(text)
    for odd in ("", "é" * 3000, "日本" * 2000, " " * 500, "a" * 5000):
        ends = chunks.cuts(odd.encode())
        parts = [odd.encode()[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        assert "".join(p.decode() for p in parts) == odd


def plain_cut(docs, least):
    """Documents one by one, against all earlier ones' chunks."""
    seen, left = {}, {}
    for i, text in sorted((i, t) for i, t in docs if t is not None):
        data, last, made = text.encode(), 0, []
        for end in chunks.cuts(data):
            made.append(data[last:end])
            last = end
        repeated = [any(j < i for j in seen.get(p, ())) for p in made]
        out, k = [], 0
        while k < len(made):
            run = k
            while run < len(made) and repeated[run]:
                run += 1
            block = b"".join(made[k:run])
            if run > k:
                if len(block.split()) < least:
                    out.append(block)
                k = run
            else:
                out.append(made[k])
                k += 1
        left[i] = b"".join(out).decode()
        for p in made:
            seen.setdefault(p, set()).add(i)
    return left


def test_equals_brute_force_and_catches_passages(spark):
    draw = random.Random(3)
    passages = [words(draw, 60) for _ in range(6)]
    texts = []
    for i in range(80):
        text = words(draw, draw.randint(5, 150))
        if i % 3 == 0:
            text = text + " " + draw.choice(passages) + " " + words(draw, 20)
        texts.append((i, text))
    texts += [(100, texts[4][1]), (101, texts[4][1])]
    docs = spark.createDataFrame([(i, t, "s", 0) for i, t in texts], DOCS)
    found = {r["doc_id"]: r for r in chunks.cut_repeats(docs, detail=True).collect()}
    wanted = plain_cut(texts, chunks.MIN_WORDS)
    assert {i: r["text"] for i, r in found.items()} == wanted
    whole = dict(texts)
    for i, row in found.items():
        spans = sorted((s["start"], s["end"]) for s in row["removed_spans"])
        cut = "".join(whole[i][a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), None], strict=True))
        assert cut == row["text"] and row["removed_words"] == sum(len(whole[i][s:e].split()) for s, e in spans)
    assert found[100]["text"] == "" and found[101]["text"] == ""
    first = set()
    for i, text in texts[:80]:
        for p in passages:
            if p in text and i % 3 == 0:
                inside = " ".join(p.split()[20:40])
                assert (inside in found[i]["text"]) == (p not in first)
                first.add(p)
    assert all(found[i]["removed_words"] == 0 for i in range(80) if i % 3)


def test_edges(spark):
    draw = random.Random(4)
    copy = words(draw, 80)
    rows = [(1, copy, "a", 1), (1, copy, "a", 1), (None, copy, None, None), (3, None, "b", 2), (4, "", "b", 2), (5, " \n", "c", 3), (6, copy * 150, "c", 3)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("numbers", F.lit(1)).withColumn("id", F.lit("x"))
    made = chunks.cut_repeats(docs)
    assert made.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"]) for r in made.collect()), key=str)
    assert found.count((1, copy)) == 2 and (None, "") in found and (3, None) in found and (4, "") in found and (5, " \n") in found
    six = next(t for i, t in found if i == 6)
    assert len(six) < 0.2 * len(copy * 150)
    empty = chunks.cut_repeats(spark.createDataFrame([], DOCS))
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "source", "n_chars"]


def test_text_without_white_space(spark):
    draw = random.Random(6)
    unspaced = lambda count: "".join(chr(draw.randint(0x4E00, 0x9FA5)) for _ in range(count))
    passage, code = unspaced(1000), "".join(draw.choice("abcdefghij0123456789+/") for _ in range(1500))
    short = "Thank you."
    rows = [(1, passage), (2, unspaced(60) + passage + unspaced(60)), (3, passage), (4, code), (5, code), (6, unspaced(300)), (7, short), (8, short), (9, short + " " + words(draw, 12))]
    docs = spark.createDataFrame([(i, t, "s", 0) for i, t in rows], DOCS)
    found = {r["doc_id"]: r for r in chunks.cut_repeats(docs, detail=True).collect()}
    whole = dict(rows)
    assert all(found[i]["text"] == whole[i] for i in (1, 4, 6, 7, 9))
    assert [found[i]["text"] for i in (3, 5, 8)] == ["", "", ""]
    left = found[2]["text"]
    assert left.startswith(whole[2][:60]) and left.endswith(whole[2][-60:]) and len(left) < 120 + 500
    assert found[8]["removed_words"] == 2


def test_short_words_count_one_each():
    assert chunks.amount(b" ".join([b"w" * 30] * 24)) == 24 and chunks.amount(b"x" * 150) == 25 and chunks.amount(b" \n") == 0
