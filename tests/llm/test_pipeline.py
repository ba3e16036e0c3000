"""The pipeline's rows against the stages done by hand, row by row."""

import hashlib
import math
import random
import re

import pytest
import sentencepiece

import corpus_pipeline
from tallyline.llm import pieces, toxicity
from tests.llm.test_chunks import plain_cut
from tests.llm.test_mixing import plain_targets
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_toxicity import texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(draw):
    made = [t.decode() for t, _ in texts(draw, 220)]
    marks = [int(i % 3 == 0) for i in range(220)]
    passage = " ".join("".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(70))
    rows = []
    for i, text in enumerate(made):
        if i % 10 == 1:
            text = text + " " + passage
        rows.append((i, text, draw.choice(["en", None]), draw.choice(["a", "a", "a", "b", "c", None]), len(text)))
    rows += [(300 + i, made[1 + 3 * i].upper(), "en", "b", 5) for i in range(8)]
    rows += [(400, None, None, "b", None), (401, "", "en", "b", 0), (402, " \n", "en", "c", 2)]
    return rows, marks


def by_hand(rows, net):
    rows = [r for r, s in zip(rows, toxicity.scores(net, [r[1].encode() if r[1] is not None else None for r in rows]), strict=True) if s < toxicity.THRESHOLD]
    comps = plain_components([plain_fingerprint(r[1]) for r in rows], [r[0] for r in rows])
    rows = [r for r, c in zip(rows, comps, strict=True) if r[0] == c]
    left = plain_cut([(r[0], r[1]) for r in rows], 25)
    rows = [(r[0], left.get(r[0]), *r[2:]) for r in rows]
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    totals = {}
    for r in rows:
        totals[r[3]] = totals.get(r[3], 0) + size[r[0]]
    goal = plain_targets(totals)
    made = []
    for source in totals:
        left = math.floor(goal[source] + 0.5)  # half up, as the operator and its SQL round; round() would go to even
        own = sorted((r for r in rows if r[3] == source), key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest())
        for _ in range(2):
            for r in own:
                taken = min(left, size[r[0]])
                left -= taken
                if taken:
                    text = r[1] if taken == size[r[0]] else " ".join(WORD.findall(r[1])[:taken])
                    made.append((r[0], text, r[2], source))
    return made


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, marks = corpus(random.Random(8))
    path = str(tmp_path_factory.mktemp("corpus"))
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kind).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, m) for i, m in enumerate(marks)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_run_equals_stages_by_hand(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    net = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = [tuple(r) for r in docs.collect()]
    wanted = by_hand(sorted(rows), net)
    got = corpus_pipeline.run(spark, folder).collect()
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    assert 0 < len(wanted) and len({w[0] for w in wanted}) < len(rows)
    order = lambda row: (row[0], row[1], str(row[2:]))
    assert sorted(((r["doc_id"], list(r["ids"]), r["lang"], r["source"]) for r in got), key=order) == sorted(
        ((i, model.encode(t), lang, source) for i, t, lang, source in wanted), key=order
    )
    assert len(got) == len(wanted) and all(r["parity"] and r["round_trip"] for r in got)


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, folder)
        assert made.dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), folder).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder).count() == 0
