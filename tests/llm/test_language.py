import random

import numpy as np
from pyspark.sql import functions as F

from tallyline.llm import language

PARTS = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "er", "ö"], "cc": ["ción", "ez", "ar", "ll"]}


def text(draw, lang, count):
    return " ".join("".join(draw.choice(PARTS[lang]) for _ in range(draw.randint(1, 4))) for _ in range(count))


def rows(draw, count):
    made = []
    for i in range(count):
        lang = draw.choice(list(PARTS))
        made.append((i, text(draw, lang, draw.choice([2, 20, 150])), lang))
    return made


def test_learns_and_rejects():
    draw = random.Random(1)
    some = rows(draw, 400)
    model = language.train([t for _, t, _ in some[:300]], [y for *_, y in some[:300]])
    langs, scores, accepted = language.predict(model, [t for _, t, _ in some[300:]])
    right = np.array([a == y for a, (*_, y) in zip(langs, some[300:], strict=True)])
    assert right.mean() > 0.97 and right[accepted].mean() >= right.mean() and ((0 <= scores) & (scores <= 1)).all()
    odd = [None, "", " \n", "123 !? ½ ²", "_-", "x" * 200_000, text(draw, "bb", 60_000)]
    langs, scores, accepted = language.predict(model, odd)
    assert langs[:5] == ["und"] * 5 and scores[:5].tolist() == [0] * 5 and not accepted[:5].any()
    assert langs[5] in PARTS and langs[6] == "bb"


def test_shares_are_the_mean_of_embeddings():
    draw = random.Random(2)
    some = rows(draw, 60)
    model = language.train([t for _, t, _ in some], [y for *_, y in some])
    words = language.words_of(some[5][1])
    ids, starts = language.bags(words, language.ORDERS, language.BUCKETS)
    wanted = model.embedding.astype(float)[ids].mean(axis=0) @ model.layer + model.bias
    assert np.allclose(language.raw_logits(model, [words, [], words])[2], wanted)


def test_column(spark):
    draw = random.Random(3)
    some = rows(draw, 240)
    given = some + [(900, None, "aa"), (901, "", None), (None, some[0][1], None), (None, some[0][1], None)]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("clash"))
    model = language.fit(docs)
    got = docs.select("doc_id", "text", "lang", language.predicted(model).alias("p")).select("doc_id", "text", "lang", "p.lang_pred", "p.score").collect()
    assert len(got) == len(given)
    known = [r for r in got if r["text"] and r["lang"]]
    assert sum(r["lang"] == r["lang_pred"] for r in known) >= 0.97 * len(known)
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in got if not r["text"])
    again = language.fit(docs)
    assert np.array_equal(again.embedding, model.embedding)
    assert language.fit(docs.limit(0)) is None
    assert docs.select(language.predicted(None)["lang_pred"]).distinct().collect()[0][0] == "und"


def test_words_are_drawn_over_the_whole_text(spark):
    """What stands behind the first characters of long texts is learned from."""
    draw = random.Random(4)
    given = []
    for i, lang in enumerate(["aa", "bb", "cc"] * 60):
        given.append((i, "zzz " * 3000 + text(draw, lang, 400), lang))
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string")
    model = language.fit(docs)
    fresh = [(text(draw, lang, 60), lang) for lang in ["aa", "bb", "cc"] * 20]
    langs, *_ = language.predict(model, [t for t, _ in fresh])
    assert sum(a == y for a, (_, y) in zip(langs, fresh, strict=True)) >= 57
    made = language.drawn_words(given[0][1])
    assert len(made.split()) == language.SAMPLE_WORDS and made == language.drawn_words(given[0][1])
    assert len(language.drawn_words("字" * 10**6)) == language.WORD_CHARS and language.drawn_words(None) is None


def test_no_language_is_left_out(spark):
    given = [(i, f"w{i % 1100} x{i % 1100} y{i % 1100}", f"l{i % 1100:04d}") for i in range(6600)]
    given += [(10_000 + i, "common words here", "l0000") for i in range(3000)]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string")
    model = language.fit(docs)
    kept = docs.where(language.learnable("doc_id", 4, 2)).select("lang").distinct().count()
    assert len(model.languages) == kept > 1000
