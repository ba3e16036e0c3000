import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tallyline.llm import outliers

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = r"[^\x20\x09-\x0D]+"


def plain(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    hit = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(hit),
        len(lines),
    )


def texts(draw, count):
    vocabulary = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(2, 6))) for _ in range(60)]
    made = []
    for i in range(count):
        lines = [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 14))) for _ in range(draw.randint(1, 22))]
        if i % 7 == 0:
            lines += lines[: draw.randint(0, 4)]
        text = draw.choice(["\n", "\n\n", " \n\t"]).join(lines)
        if i % 9 == 0:
            text = "".join(c + "#" if draw.random() < 0.2 else c for c in text)
        made.append(text)
    return made


def test_counts_equal_brute_force(spark):
    draw = random.Random(1)
    some = texts(draw, 120) + ["", " \n ", None, "a", "a b", "a b c a b c", "a a a a a", "x\n x\nx\n\n", "\x0b\x0ca\rb", "é日本 " * 400, "w x " * 5000]
    docs = spark.createDataFrame([(i, t, "l", "s", 0) for i, t in enumerate(some)], DOCS)
    got = {r["doc_id"]: r for r in outliers.judge(docs).collect()}
    assert len(got) == len(some)
    for i, text in enumerate(some):
        n_words, chars, symbols, dup, repeat, _ = plain(text)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n_words, chars, symbols, dup, repeat), text
        assert r["base_failed"] == (n_words < 50 or 100 * repeat > 50 * n_words)
        assert not (r["base_failed"] and r["kept"])


def fit(x):
    """The same estimate, in numpy with all rows at hand."""
    floors = np.array(outliers.FLOORS)

    def regular(mean, cov, scale):
        return mean, cov * scale + np.diag(floors**2)

    def distance(mean, cov):
        z = np.linalg.solve(np.linalg.cholesky(cov), (x - mean).T)
        return (z**2).sum(axis=0)

    def moments(rows, scale):
        mean = rows.mean(axis=0)
        return regular(mean, rows.T @ rows / len(rows) - np.outer(mean, mean), scale)

    def quantile(column, q):
        bins = np.sort(np.floor(column / 0.002))
        return (bins[math.ceil(q * len(bins)) - 1] + 0.5) * 0.002

    mid = np.array([quantile(c, 0.5) for c in x.T])
    sd = np.array([(quantile(c, 0.75) - quantile(c, 0.25)) / 1.349 for c in x.T])
    best = None
    for state in (regular(mid, np.diag(sd**2), 1.0), moments(x, 1.0)):
        for _ in range(outliers.STEPS):
            bins = np.floor(np.log(distance(*state) + 1e-9) * outliers.BINS)
            edge = np.sort(bins)[math.ceil(len(x) * outliers.SHARE) - 1]
            state = moments(x[bins <= edge], outliers.consistency(outliers.SHARE))
        det = np.linalg.slogdet(state[1])[1]
        if best is None or det < best[0] - 1e-9:
            best = (det, state)
    inside = distance(*best[1]) <= outliers.chi2_quantile(outliers.REWEIGHT, 2)
    return distance(*moments(x[inside], outliers.consistency(outliers.REWEIGHT)))


def test_estimate_equals_brute_force_per_group(spark):
    draw = random.Random(2)
    rows = [(i, t, draw.choice(["en", "en", "fr", None]), draw.choice(["a", "a", "b", "rare"])) for i, t in enumerate(texts(draw, 500))]
    docs = spark.createDataFrame([(*r, 0) for r in rows], DOCS)
    got = {r["doc_id"]: r for r in outliers.judge(docs, least_rows=30).collect()}
    groups, vector = {}, {}
    for i, text, lang, source in rows:
        if not got[i]["base_failed"]:
            n, chars, symbols, dup, repeat, lines = plain(text)
            vector[i] = [math.log(chars / n), math.sqrt(symbols / chars), math.sqrt(dup / lines), math.sqrt(repeat / n)]
            groups.setdefault((lang, source), []).append(i)
    pools, rest = [], {}
    for (lang, _), ids in groups.items():
        if len(ids) >= 30:
            pools.append(ids)
        else:
            rest.setdefault(lang, []).extend(ids)
    last = []
    for ids in rest.values():
        if len(ids) >= 30:
            pools.append(ids)
        else:
            last += ids
    if last:
        pools.append(last)
    cut = outliers.chi2_quantile(outliers.CUTOFF, 2)
    assert len(pools) > 3
    for ids in pools:
        wanted = fit(np.array([vector[i] for i in ids]))
        for i, d in zip(ids, wanted, strict=True):
            assert abs(got[i]["distance2"] - d) < 1e-6 * max(1, d)
            assert got[i]["kept"] == (d <= cut or len(ids) < 30)


def test_rejects_junk_and_keeps_the_rest(spark):
    draw = random.Random(3)
    clean = [" ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(draw.randint(60, 300))) for _ in range(300)]
    junk = [" ".join(w + "###" for w in t.split()) for t in clean[:20]]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(clean + junk)], DOCS)
    got = {r["doc_id"]: r["kept"] for r in outliers.judge(docs).collect()}
    assert all(got[i] for i in range(300)) and not any(got[i] for i in range(300, 320))


def test_chi_squared():
    assert abs(outliers.chi2_quantile(0.975, 2) - 11.143287) < 1e-5
    assert 1 < outliers.consistency(0.5) < 3 and outliers.consistency(1 - 1e-12) < 1.001


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b", "l", "s", 0)], DOCS)
    plan = outliers.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_edges(spark):
    rows = [(None, "a " * 60, None, None, None), (1, "a b " * 60, None, "s", 1), (1, "a b " * 60, None, "s", 1), (2, None, "en", None, 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("gid", F.lit(1)).withColumn("x0", F.lit(2.0)).withColumn("llm_words", F.lit("clash"))
    got = outliers.judge(docs).collect()
    assert len(got) == 4 and sum(r["doc_id"] is None for r in got) == 1
    assert outliers.judge(spark.createDataFrame([], DOCS)).count() == 0


def spaced(draw, count, letters="abcdefgh"):
    return [" ".join("".join(draw.choice(letters) for _ in range(draw.randint(2, 7))) for _ in range(draw.randint(60, 300))) for _ in range(count)]


def junk_of(texts):
    return [" ".join(w + "###" for w in t.split()) for t in texts]


def test_rare_groups_are_judged_by_the_rest(spark):
    draw = random.Random(4)
    rows = [(t, "en", "s") for t in spaced(draw, 200)] + [(t, "fr", "s") for t in spaced(draw, 200)]
    fine = [(t, lang, source) for lang, source in (("en", "rare"), ("xx", "s"), (None, "s")) for t in spaced(draw, 10)]
    bad = [(t, lang, source) for lang, source in (("en", "rare"), ("xx", "s"), (None, None)) for t in junk_of(spaced(draw, 10))]
    docs = spark.createDataFrame([(i, *r, 0) for i, r in enumerate(rows + fine + bad)], DOCS)
    got = {r["doc_id"]: r["kept"] for r in outliers.judge(docs).collect()}
    edge = len(rows + fine)
    assert len(got) == edge + len(bad)
    assert all(got[i] for i in range(edge)) and not any(got[i] for i in range(edge, len(got)))


def test_small_tables_are_judged(spark):
    draw = random.Random(5)
    clean = spaced(draw, 40)
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", 0) for i, t in enumerate(clean + junk_of(clean[:5]))], DOCS)
    got = {r["doc_id"]: r["kept"] for r in outliers.judge(docs).collect()}
    assert [i for i in range(45) if not got[i]] == list(range(40, 45))
