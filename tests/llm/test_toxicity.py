import random

import numpy as np

from tallyline.llm import toxicity as tox
from tallyline.llm.subwords import bags

BAD = ["grumbo", "zarnik", "plofter"]


def texts(draw, count):
    vocabulary = ["".join(draw.choice("abcdeimnorst") for _ in range(draw.randint(2, 7))) for _ in range(300)]
    made = []
    for i in range(count):
        words = [draw.choice(vocabulary) for _ in range(draw.randint(5, 120))]
        bad = i % 3 == 0
        if bad:
            for _ in range(1 + len(words) // 25):
                words.insert(draw.randint(0, len(words)), draw.choice(BAD) + draw.choice(["", ",", "s"]))
        made.append((" ".join(words).encode(), int(bad)))
    return made


def test_windows_cover_and_overlap():
    for n in [0, 1, 31, 32, 33, 60, 61, 500]:
        starts = tox.windows_of(n)
        covered = {k for s in starts for k in range(s, min(s + tox.WINDOW, n))}
        assert covered == set(range(n))
        assert all(b - a == tox.STRIDE < tox.WINDOW for a, b in zip(starts, starts[1:], strict=False))
        assert not starts or starts[-1] < n


def test_gradients():
    net = tox.Network.fresh(3, np.float64, embed=3, hidden=4, buckets=64)
    words = [b"a", b"bc", b"def", b"ghij"]
    bag = bags(words, tox.ORDERS, 64)
    tokens = np.array([[0, 1], [2, 3], [3, 3], [1, 0]])
    real = np.array([[True, True], [True, True], [True, False], [True, False]])
    slope = np.array([0.7, -1.3])
    net.forward(net.inputs(bag), tokens, real, train=True)
    grads = net.backward(net.inputs(bag), bag, tokens, real, slope)
    draw = np.random.default_rng(0)
    for name, grad in grads.items():
        flat, by = net.weights[name].reshape(-1), grad.reshape(-1)
        for k in draw.choice(len(flat), min(12, len(flat)), replace=False):
            kept, ends = flat[k], []
            for step in (1e-5, -1e-5):
                flat[k] = kept + step
                ends.append(net.forward(net.inputs(bag), tokens, real) @ slope)
            flat[k] = kept
            assert abs((ends[0] - ends[1]) / 2e-5 - by[k]) < 1e-6, name


def test_learns_and_scores_every_window():
    draw = random.Random(5)
    rows = texts(draw, 500)
    net = tox.train([t for t, _ in rows[:400]], [y for _, y in rows[:400]])
    scores = tox.scores(net, [t for t, _ in rows[400:]])
    wrong = sum((s >= tox.THRESHOLD) != y for s, (_, y) in zip(scores, rows[400:], strict=True))
    assert wrong <= 8 and (0 <= scores).all() and (scores <= 1).all()
    clean = next(t for t, y in rows if not y and len(t.split()) > 60)
    late = clean + b" " + b" ".join([b"grumbo zarnik plofter"] * 4)
    assert tox.scores(net, [clean * 3])[0] < 0.5 < tox.scores(net, [clean * 3 + late])[0]
    odd = [None, b"", b" \n", b"x" * 100_000, b"a b " * 30_000, clean, clean]
    made = tox.scores(net, odd)
    assert made[:3].tolist() == [0, 0, 0] and made[5] == made[6]
    alone = [tox.scores(net, [t])[0] for t in odd]
    assert np.allclose(made, alone, atol=1e-4)


def test_column_and_filter(spark):
    draw = random.Random(6)
    rows = [(i, t.decode(), y) for i, (t, y) in enumerate(texts(draw, 300))]
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in rows] + [(None, None, 1), (None, "", 2), (7, rows[7][1], 1)], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(10**6, 1, 1), (None, 0, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    net = tox.fit(docs.drop("toxic"), labels)
    scored = {r["doc_id"]: r["s"] for r in docs.select("doc_id", tox.scored(net).alias("s")).collect()}
    right = sum((scored[i] >= tox.THRESHOLD) == y for i, _, y in rows)
    assert right >= 0.9 * len(rows) and scored[None] == 0
    kept = tox.keep_clean(docs, net)
    assert kept.columns == docs.columns
    assert kept.where("doc_id IS NULL").count() == 2
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in scored.items() if s < tox.THRESHOLD}
    nothing = tox.fit(docs.limit(0), labels)
    assert not nothing.usable and docs.select(tox.scored(nothing)).distinct().count() == 1
    assert tox.keep_clean(docs.limit(0), net).count() == 0


def test_held_out_rows_are_not_learned_from(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60)], "doc_id long, text string")
    import zlib

    asked = [r["doc_id"] for r in docs.where(tox.learnable("doc_id", 3, 1)).collect()]
    assert asked == [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]


def test_a_span_at_any_offset_lies_whole_in_a_window():
    for span in (5, 12, 16, 17):
        for at in range(200):
            starts = tox.windows_of(200 + span)
            assert any(s <= at and at + span <= s + tox.WINDOW for s in starts), (span, at)


def test_planted_span_scores_near_its_best_window():
    draw = random.Random(8)
    rows = texts(draw, 500)
    net = tox.train([t for t, _ in rows], [y for _, y in rows])
    clean = next(t for t, y in rows if not y and len(t.split()) > 100).split()[:100]
    span = [w.encode() for w in BAD * 6][:16]
    for at in range(len(clean) - len(span)):
        words = clean[:at] + span + clean[at:]
        (found,) = tox.window_logits(net, [words])
        every = [words[s : s + tox.WINDOW] for s in range(len(words) - tox.WINDOW + 1)]
        best = max(x.max() for x in tox.window_logits(net, every))
        plain = tox.window_logits(net, [clean])[0].max()
        assert found.max() - plain >= 0.7 * (best - plain), at


def test_passages_behind_long_clean_text_are_learned(spark):
    """Toxic passages that begin behind 20,000 characters, a few windows of hundreds."""
    draw = random.Random(12)
    rows = texts(draw, 240)
    clean = [t.decode() for t, y in rows if not y]
    given = []
    for i in range(150):
        long = " ".join(draw.choice(clean) for _ in range(90))
        bad = i % 2
        given.append((i, long + (" " + " ".join(draw.choice(BAD) for _ in range(24)) if bad else "") + " " + draw.choice(clean), bad))
    assert min(len(t) for _, t, _ in given) > 20_000
    docs = spark.createDataFrame([(i, t) for i, t, _ in given], "doc_id long, text string")
    net = tox.fit(docs, spark.createDataFrame([(i, y) for i, _, y in given], "doc_id long, toxic int"))
    scored = {r["doc_id"]: r["s"] for r in docs.select("doc_id", tox.scored(net).alias("s")).collect()}
    right = sum((scored[i] >= tox.THRESHOLD) == y for i, _, y in given)
    assert right >= 0.85 * len(given)


def plain_logit(net, words):
    """The network word by word, in plain loops."""
    import math

    w = {k: v.astype(float) for k, v in net.weights.items()}
    inputs = []
    for word in words:
        ids, _ = bags([word], tox.ORDERS, tox.BUCKETS)
        inputs.append(list(w["words"][ids[0]]) + [sum(w["grams"][i][c] for i in ids) / len(ids) for c in range(w["grams"].shape[1])])
    sig = lambda x: 1 / (1 + math.exp(-x))
    size = w["state_f"].shape[0]
    states = {}
    for way, order in (("f", range(len(words))), ("b", range(len(words) - 1, -1, -1))):
        h = [0.0] * size
        for t in order:
            g = [sum(x * w[f"in_{way}"][i][c] for i, x in enumerate(inputs[t])) + w[f"bias_{way}"][c] for c in range(3 * size)]
            u = [sum(h[i] * w[f"state_{way}"][i][c] for i in range(size)) for c in range(3 * size)]
            z = [sig(g[c] + u[c]) for c in range(size)]
            r = [sig(g[size + c] + u[size + c]) for c in range(size)]
            n = [math.tanh(g[2 * size + c] + r[c] * u[2 * size + c]) for c in range(size)]
            h = [(1 - z[c]) * n[c] + z[c] * h[c] for c in range(size)]
            states[way, t] = h
    both = [states["f", t] + states["b", t] for t in range(len(words))]
    raw = [sum(math.tanh(sum(s[i] * w["attend"][i][a] for i in range(2 * size))) * w["query"][a] for a in range(len(w["query"]))) for s in both]
    share = [math.exp(x - max(raw)) for x in raw]
    pooled = [sum(p * s[i] for p, s in zip(share, both, strict=True)) / sum(share) for i in range(2 * size)]
    return sum(p * o for p, o in zip(pooled, w["out"], strict=True)) + w["bias"][0]


def test_forward_against_plain_loops():
    draw = random.Random(13)
    rows = texts(draw, 90)
    net = tox.train([t for t, _ in rows], [y for _, y in rows])
    for text, _ in rows[:6]:
        words = tox.words_of(text)
        (found,) = tox.window_logits(net, [words])
        wanted = [plain_logit(net, words[s : s + tox.WINDOW]) for s in tox.windows_of(len(words))]
        assert np.allclose(found, wanted, atol=2e-3)
