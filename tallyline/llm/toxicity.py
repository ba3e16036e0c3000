"""Toxicity by a bidirectional gated recurrent network, trained and run in numpy.

A text is cut into windows of 32 words that overlap by half, to its end, so a span of up
to 17 words lies whole in one of them wherever it starts. A word comes in as a word (a hashed embedding) and as characters (the mean of hashed character
n-gram embeddings). A gated recurrent unit reads the window each way, attention pools
its states, and a linear layer gives the window's logit. Three figures of a text's
windows (the highest logit, the mean and the sum of their probabilities) go into a
logistic curve, fitted on rows kept out of training, which makes the score.

Labels are per text, windows are not labelled: all windows of a clean text are
negatives; of a toxic text those count as positive that the network of the round
before finds positive, its best window always.

Training takes a bounded sample of labelled rows (``SAMPLE_ROWS``, about half of them
toxic where there are enough, by hash) and, on the driver, a bounded number of windows of
each: some drawn at random over the whole text, and of toxic texts, after two rounds,
those that the network finds most toxic wherever they lie. The curve is fitted on figures
of whole texts. Scoring covers every window of every text, in tasks, without a shuffle.

Defined results: NULL, empty or blank text has no window and scores as the bias of the
empty text, which is 0; labels whose text is missing are left out; without both kinds of
labels every text scores 0; rows without an id are not held out; repeated rows score alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import Stash, learnable
from tallyline.llm.rawtext import tidied
from tallyline.llm.subwords import bags

WINDOW = 32
STRIDE = WINDOW // 2
BUCKETS = 1 << 14
ORDERS = (3, 5)
EMBED = 8
HIDDEN = 8
ATTEND = 8
SAMPLE_ROWS = 3000
WINDOWS_PER_ROW = 8
TOXIC_WINDOWS_PER_ROW = 8
MINED_PER_ROW = 4
MINE_BEFORE = 2
WINDOW_BYTES = 8192
ROUNDS = 5
BATCH = 256
LEAST_STEPS = 60
THRESHOLD = 0.7
SLICE_WORDS = 100_000
CACHE_WORDS = 250_000
CACHE_BYTES = 8 << 20


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights, by name."""

    weights: dict[str, np.ndarray]
    curve: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0, 0.0, 0.0]))
    usable: bool = True
    memory: dict = field(default_factory=dict, repr=False)

    @classmethod
    def fresh(cls, seed: int = 11, kind: type = np.float32, embed: int = EMBED, hidden: int = HIDDEN, buckets: int = BUCKETS) -> Network:
        draw = np.random.default_rng(seed)

        def matrix(*shape: int, by: float) -> np.ndarray:
            return (draw.standard_normal(shape) * by).astype(kind)

        made = {"words": matrix(buckets, embed, by=0.3), "grams": matrix(buckets, embed, by=0.3)}
        for way in ("f", "b"):
            made |= {
                f"in_{way}": matrix(2 * embed, 3 * hidden, by=(2 * embed) ** -0.5),
                f"bias_{way}": np.zeros(3 * hidden, kind),
                f"state_{way}": matrix(hidden, 3 * hidden, by=hidden**-0.5),
            }
        made |= {
            "attend": matrix(2 * hidden, ATTEND, by=(2 * hidden) ** -0.5),
            "query": matrix(ATTEND, by=ATTEND**-0.5),
            "out": matrix(2 * hidden, by=(2 * hidden) ** -0.5),
            "bias": np.zeros(1, kind),
        }
        return cls(made)

    def inputs(self, bag: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Word and character vector of each distinct word, side by side."""
        ids, starts = bag
        sizes = np.diff(np.r_[starts, len(ids)])
        means = np.add.reduceat(self.weights["grams"][ids], starts, axis=0) / sizes[:, None].astype(self.weights["grams"].dtype)
        return np.concatenate([self.weights["words"][ids[starts]], means], axis=1)

    def _read(self, way: str, gates: np.ndarray, tokens: np.ndarray, real: np.ndarray, keep: list | None) -> np.ndarray:
        """States at each step, (steps, windows, hidden); padding leaves the state as it is."""
        state_w = self.weights[f"state_{way}"]
        hidden = state_w.shape[0]
        steps, count = tokens.shape
        states = np.zeros((steps, count, hidden), gates.dtype)
        h = np.zeros((count, hidden), gates.dtype)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            g, s = gates[tokens[t]], h @ state_w
            zr = sigmoid(g[:, : 2 * hidden] + s[:, : 2 * hidden])
            z, r = zr[:, :hidden], zr[:, hidden:]
            n = np.tanh(g[:, 2 * hidden :] + r * s[:, 2 * hidden :])
            new = n + z * (h - n)
            if not real[t].all():
                new = np.where(real[t][:, None], new, h)
            if keep is not None:
                keep.append((t, h, z, r, n, s[:, 2 * hidden :]))
            h = states[t] = new
        return states

    def forward(self, vectors: np.ndarray, tokens: np.ndarray, real: np.ndarray, train: bool = False) -> np.ndarray:
        """Logit of each window; ``tokens`` and ``real`` are (steps, windows)."""
        w = self.weights
        both, kept = [], {}
        for way in ("f", "b"):
            keep = [] if train else None
            gates = vectors @ w[f"in_{way}"] + w[f"bias_{way}"]
            both.append(self._read(way, gates, tokens, real, keep))
            kept[way] = keep
        states = np.concatenate(both, axis=2)
        hot = np.tanh(states @ w["attend"])
        raw = np.where(real, hot @ w["query"], np.asarray(-1e9, states.dtype))
        share = np.exp(raw - raw.max(axis=0))
        share /= share.sum(axis=0)
        context = np.einsum("tn,tnh->nh", share, states)
        if train:
            self.memory = {"kept": kept, "states": states, "hot": hot, "share": share, "context": context}
        return context @ w["out"] + w["bias"][0]

    def backward(self, vectors: np.ndarray, bag: tuple, tokens: np.ndarray, real: np.ndarray, slope: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the sum of ``slope * logit``."""
        w, m = self.weights, self.memory
        hidden = w["state_f"].shape[0]
        grads = {"out": m["context"].T @ slope, "bias": np.array([slope.sum()], slope.dtype)}
        d_context = slope[:, None] * w["out"]
        d_states = m["share"][:, :, None] * d_context
        d_share = np.einsum("nh,tnh->tn", d_context, m["states"])
        d_raw = m["share"] * (d_share - (m["share"] * d_share).sum(axis=0))
        d_raw = np.where(real, d_raw, 0).astype(slope.dtype)
        grads["query"] = np.einsum("tn,tna->a", d_raw, m["hot"])
        d_hot = d_raw[:, :, None] * w["query"] * (1 - m["hot"] ** 2)
        grads["attend"] = np.einsum("tnh,tna->ha", m["states"], d_hot)
        d_states = d_states + d_hot @ w["attend"].T
        d_vectors = np.zeros_like(vectors)
        for number, way in enumerate(("f", "b")):
            u = w[f"state_{way}"]
            numbers, parts = [], []
            grads[f"state_{way}"] = np.zeros_like(u)
            carry = np.zeros((tokens.shape[1], hidden), vectors.dtype)
            for t, h, z, r, n, s_n in reversed(m["kept"][way]):
                d = carry + d_states[t][:, number * hidden : (number + 1) * hidden]
                live = np.where(real[t][:, None], d, 0)
                d_n = live * (1 - z) * (1 - n**2)
                d_z = live * (h - n) * z * (1 - z)
                d_r = d_n * s_n * r * (1 - r)
                side = np.concatenate([d_z, d_r, d_n * r], axis=1)
                grads[f"state_{way}"] += h.T @ side
                numbers.append(tokens[t])
                parts.append(np.concatenate([d_z, d_r, d_n], axis=1))
                carry = (d - live) + live * z + side @ u.T
            d_gates = scatter(np.concatenate(numbers), np.concatenate(parts), len(vectors))
            grads[f"in_{way}"] = vectors.T @ d_gates
            grads[f"bias_{way}"] = d_gates.sum(axis=0)
            d_vectors += d_gates @ w[f"in_{way}"].T
        ids, starts = bag
        sizes = np.diff(np.r_[starts, len(ids)])
        embed = w["words"].shape[1]
        buckets = len(w["words"])
        each = (d_vectors[:, embed:] / sizes[:, None]).astype(d_vectors.dtype)
        grads["words"] = scatter(ids[starts], d_vectors[:, :embed], buckets)
        grads["grams"] = scatter(ids, np.repeat(each, sizes, axis=0), buckets)
        return grads

    def slim(self) -> Network:
        """A copy without the memory of training, to be sent to tasks."""
        return Network(self.weights, self.curve, self.usable)


def scatter(ids: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sum of the rows under each number."""
    return np.stack([np.bincount(ids, column, size) for column in rows.T], axis=1).astype(rows.dtype)


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def windows_of(count: int) -> list[int]:
    """Starts of the windows over a text of so many words; together they cover it."""
    if count <= WINDOW:
        return [0] if count else []
    return list(range(0, count - WINDOW + STRIDE, STRIDE))


def _laid_out(tokens: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(steps, windows) word numbers and which of them are real."""
    at = starts[None, :] + np.arange(WINDOW)[:, None]
    real = at < ends[None, :]
    return tokens[np.where(real, at, starts[None, :])], real


def _numbered(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    number: dict[bytes, int] = {}
    tokens = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    return list(number), tokens


class Vocabulary:
    """Vectors of the distinct words met so far, up to a number of words."""

    def __init__(self, net: Network):
        self.net = net
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.held = 0
        self.vectors = self.net.inputs(bags([b""], ORDERS, BUCKETS))[:0]

    def tokens(self, words: list[bytes]) -> np.ndarray:
        if len(self.number) > CACHE_WORDS or self.held > CACHE_BYTES:
            self.forget()
        known = len(self.number)
        found, number = self.number.setdefault, self.number
        tokens = np.array([found(w, len(number)) for w in words], np.int64)
        if len(number) > known:
            fresh = list(islice(number, known, None))
            self.held += sum(map(len, fresh))
            self.vectors = np.concatenate([self.vectors, self.net.inputs(bags(fresh, ORDERS, BUCKETS))])
        return tokens


def window_logits(net: Network, texts: list[list[bytes]], vocabulary: Vocabulary | None = None) -> list[np.ndarray]:
    """Logits of all windows of each text."""
    vocabulary = vocabulary or Vocabulary(net)
    tokens = vocabulary.tokens([w for words in texts for w in words])
    starts, ends, counts, base = [], [], [], 0
    for words in texts:
        own = windows_of(len(words))
        starts += [base + s for s in own]
        ends += [min(base + s + WINDOW, base + len(words)) for s in own]
        counts.append(len(own))
        base += len(words)
    if not starts:
        return [np.zeros(0, np.float32) for _ in texts]
    distinct, tokens = np.unique(tokens, return_inverse=True)
    vectors = vocabulary.vectors[distinct]
    starts, ends = np.array(starts), np.array(ends)
    logits = np.empty(len(starts), np.float32)
    for at in range(0, len(starts), 2048):
        part, real = _laid_out(tokens, starts[at : at + 2048], ends[at : at + 2048])
        logits[at : at + 2048] = net.forward(vectors, part, real)
    return np.split(logits, np.cumsum(counts)[:-1])


class Adam:
    """Stochastic gradient steps with running moments."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float = 0.01):
        self.weights, self.rate, self.step = weights, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def apply(self, grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        fix = (1 - 0.999**self.step) ** 0.5 / (1 - 0.9**self.step)
        for name, g in grads.items():
            self.mean[name] += 0.1 * (g - self.mean[name])
            self.square[name] += 0.001 * (g * g - self.square[name])
            self.weights[name] -= self.rate * fix * self.mean[name] / (np.sqrt(self.square[name]) + 1e-6)


def _round(net: Network, adam: Adam, windows: list[list[bytes]], marks: np.ndarray, draw: np.random.Generator) -> None:
    """One pass over the windows, or as many as make ``LEAST_STEPS`` steps."""
    batch = int(np.clip(len(windows) // LEAST_STEPS, 32, BATCH))
    passes = max(1, -(-LEAST_STEPS * batch // len(windows)))
    order = np.concatenate([draw.permutation(len(windows)) for _ in range(passes)])
    for at in range(0, len(order), batch):
        some = order[at : at + batch]
        distinct, tokens = _numbered([w for k in some for w in windows[k]])
        sizes = np.array([len(windows[k]) for k in some])
        ends = np.cumsum(sizes)
        bag = bags(distinct, ORDERS, BUCKETS)
        vectors = net.inputs(bag)
        part, real = _laid_out(tokens, ends - sizes, ends)
        logits = net.forward(vectors, part, real, train=True)
        slope = ((sigmoid(logits) - marks[some]) / len(some)).astype(np.float32)
        adam.apply(net.backward(vectors, bag, part, real, slope))


def drawn_windows(text: bytes | None, toxic: bool) -> list[list[bytes]]:
    """Windows drawn at random over the whole text, the same ones in every run. Windows of very long words are left to scoring."""
    words = words_of(text)
    starts, most = windows_of(len(words)), TOXIC_WINDOWS_PER_ROW if toxic else WINDOWS_PER_ROW
    if len(starts) > most:
        draw = np.random.default_rng(zlib.crc32(text))
        starts = sorted(starts[k] for k in draw.choice(len(starts), most, replace=False))
    made = [words[s : s + WINDOW] for s in starts]
    return [w for w in made if sum(map(len, w)) <= WINDOW_BYTES]


def best_windows(net: Network, texts: list[bytes | None], most: int = MINED_PER_ROW) -> list[list[list[bytes]]]:
    """The windows of each text, of all it has, that the network finds most toxic."""
    made: list[list[list[bytes]]] = []
    vocabulary = Vocabulary(net)
    for text in texts:
        words = words_of(text)
        starts = windows_of(len(words))
        order = np.argsort(-window_logits(net, [words], vocabulary)[0], kind="stable")[:most].tolist() if starts else []
        windows = [words[starts[k] : starts[k] + WINDOW] for k in order]
        made.append([w for w in windows if sum(map(len, w)) <= WINDOW_BYTES])
    return made


def text_figures(net: Network, texts: list[bytes | None]) -> list[tuple[float, float, float] | None]:
    """:func:`figures` of whole texts; None for a text without a window."""
    vocabulary = Vocabulary(net)
    logits = (window_logits(net, [words_of(text)], vocabulary)[0] for text in texts)
    return [figures(x) if len(x) else None for x in logits]


def train(texts: list[bytes | None], labels: list[int], seed: int = 11, clean_weight: float = 1.0) -> Network:
    """Fit the network and its calibration to labelled texts that are at hand."""
    rows = [(t, int(y)) for t, y in zip(texts, labels, strict=True)]
    toxic = [k for k, (_, y) in enumerate(rows) if y]

    def mine(net: Network) -> dict[int, list[list[bytes]]]:
        return dict(zip(toxic, best_windows(net, [rows[k][0] for k in toxic]), strict=True))

    def figure(net: Network) -> dict[int, tuple | None]:
        return dict(enumerate(text_figures(net, [t for t, _ in rows])))

    return fitted([(y, drawn_windows(t, bool(y))) for t, y in rows], mine, figure, seed, clean_weight)


def fitted(
    drawn: list[tuple[int, list[list[bytes]]]],
    mine: Callable[[Network], dict[int, list[list[bytes]]]],
    figure: Callable[[Network], dict[int, tuple | None]],
    seed: int = 11,
    clean_weight: float = 1.0,
) -> Network:
    """Fit the network to rows of (label, windows), and its calibration to figures of whole texts.

    ``mine`` gives, by row, windows that the network so far finds most toxic, wherever they
    lie in the text; ``figure`` gives, by row, the figures of the whole text.
    ``clean_weight`` is how many clean rows each sampled one stands for, against toxic ones.
    """
    net = Network.fresh(seed)
    rows = [k for k, (_, windows) in enumerate(drawn) if windows]
    label = np.array([y for y, _ in drawn], np.int64)
    if len(set(label[rows].tolist())) < 2:
        net.usable = False
        return net
    draw = np.random.default_rng(seed)
    rows = [rows[k] for k in draw.permutation(len(rows))]
    aside, learn = rows[::5], [k for n, k in enumerate(rows) if n % 5]
    if len(set(label[learn].tolist())) < 2 or len(set(label[aside].tolist())) < 2:
        learn = aside = rows
    adam = Adam(net.weights)
    windows = [w for k in learn for w in drawn[k][1]]
    owner = np.array([k for k in learn for _ in drawn[k][1]])
    use = np.ones(len(windows), bool)
    for number in range(ROUNDS):
        if number == MINE_BEFORE:
            found = mine(net)
            held = {(k, b" ".join(w)) for k, w in zip(owner.tolist(), windows, strict=True)}
            more = [(k, w) for k in learn if label[k] for w in found.get(k, []) if (k, b" ".join(w)) not in held]
            windows += [w for _, w in more]
            owner = np.r_[owner, np.array([k for k, _ in more], np.int64)]
            use = np.ones(len(windows), bool)
            use[label[owner] > 0] = _positive(net, windows, owner, label, 0.0)[label[owner] > 0]
        chosen = np.flatnonzero(use)
        _round(net, adam, [windows[k] for k in chosen], label[owner[chosen]].astype(np.float32), draw)
        if number < ROUNDS - 1:
            use = _positive(net, windows, owner, label, None if number == 0 else 0.0)
        adam.rate *= 0.8
    whole = figure(net)
    aside = [k for k in aside if whole.get(k) is not None]
    net.curve = _calibrated(np.array([whole[k] for k in aside]), label[aside].astype(np.float64), clean_weight)
    return net.slim()


def _positive(net: Network, windows: list[list[bytes]], owner: np.ndarray, label: np.ndarray, line: float | None) -> np.ndarray:
    """Windows to learn from: all of clean texts; of toxic ones those above the line, the best always.

    Without a line it is the middle of the clean windows, or 0 where that is higher."""
    logits = np.concatenate(window_logits(net, windows))
    toxic = label[owner] > 0
    best = np.full(len(label), -np.inf)
    np.maximum.at(best, owner, logits)
    line = max(np.median(logits[~toxic]), 0.0) if line is None else line
    return ~toxic | (logits >= best[owner]) | (logits > line)


def figures(logits: np.ndarray) -> tuple[float, float, float]:
    """What the curve sees of a text's windows."""
    chances = sigmoid(logits.astype(np.float64))
    return float(logits.max()), float(chances.mean()), float(np.log1p(chances.sum()))


def _calibrated(x: np.ndarray, labels: np.ndarray, clean_weight: float) -> np.ndarray:
    """Weights and offset of a logistic curve, by Newton steps with a small penalty."""
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = np.concatenate([(x - centre) / spread, np.ones((len(x), 1))], axis=1)
    beta, stands = np.zeros(x.shape[1]), np.where(labels > 0, 1.0, clean_weight)
    for _ in range(50):
        p = sigmoid(x @ beta)
        grad = x.T @ (stands * (p - labels)) + 0.1 * beta
        bend = (x * (stands * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(beta))
        step = np.clip(np.linalg.solve(bend, grad), -2, 2)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    weights = beta[:-1] / spread
    return np.r_[weights, beta[-1] - weights @ centre]


def scores(net: Network, texts: list[bytes | None], vocabulary: Vocabulary | None = None) -> np.ndarray:
    """Score of each text, slice by slice of bounded size."""
    made = np.zeros(len(texts))
    if not net.usable:
        return made
    vocabulary = vocabulary or Vocabulary(net)
    held: list[list[bytes]] = []
    at = size = 0

    def settle() -> None:
        for k, logits in enumerate(window_logits(net, held, vocabulary), at):
            if len(logits):
                made[k] = sigmoid(net.curve[:3] @ figures(logits) + net.curve[3])

    for number, text in enumerate(texts):
        words = words_of(text)
        if held and size + len(words) > SLICE_WORDS:
            settle()
            held, at, size = [], number, 0
        held.append(words)
        size += len(words)
    if held:
        settle()
    return made


def scorer(net: Network):
    """Arrow UDF: text to score."""

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = Vocabulary(net)
        yield from tidied(pa.array(scores(net, texts.cast(pa.binary()).to_pylist(), vocabulary)) for texts in batches)

    return score


@F.arrow_udf(T.ArrayType(T.BinaryType()))
def _drawn(texts: pa.Array, toxic: pa.Array) -> pa.Array:
    pairs = zip(texts.cast(pa.binary()).to_pylist(), toxic.to_pylist(), strict=True)
    return pa.array([[b" ".join(w) for w in drawn_windows(t, bool(y))] for t, y in pairs], pa.list_(pa.binary()))


def _mined(net: Network):
    @F.arrow_udf(T.ArrayType(T.BinaryType()))
    def run(texts: pa.Array) -> pa.Array:
        found = best_windows(net, texts.cast(pa.binary()).to_pylist())
        return pa.array([[b" ".join(w) for w in windows] for windows in found], pa.list_(pa.binary()))

    return run


def _figured(net: Network):
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(text_figures(net, texts.cast(pa.binary()).to_pylist()), pa.list_(pa.float64()))

    return run


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Network:
    """Train on a bounded sample of the labelled rows that may be learned from.

    The whole texts of the sample stay with the tasks, which draw windows from them,
    find the most toxic ones, and work out the figures to calibrate on. What reaches
    the driver is bounded in rows, windows of a row and bytes of a window.
    """
    known = labels.where(learnable("doc_id", 3, 1) & F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    kinds = []
    for kind in (0, 1):
        share = min(1.0, 1.2 * (rows // 2) / max(sizes.get(kind, 0), 1))
        lucky = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
        kinds.append((F.col("toxic") == kind) & lucky)
    sample = known.where(kinds[0] | kinds[1]).orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(2 * rows)
    # The sample has 2 * rows rows of two numbers at most, so it is broadcast and no text is shuffled.
    joined = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(sample), "doc_id")
    stash = Stash(docs.sparkSession)
    texts = stash.put(joined.select("doc_id", F.xxhash64("text").alias("th"), "toxic", "text"), "toxicity-sample")

    def taken(column: Column, kind: Column | None = None) -> list:
        """A figure of the sampled rows, in an order that does not change."""
        some = texts if kind is None else texts.where(kind)
        found = some.select("doc_id", "th", "toxic", column.alias("made")).orderBy(F.xxhash64("doc_id"), "doc_id", "th", "toxic")
        return found.limit(rows).collect()

    def windows(made: list[bytes] | None) -> list[list[bytes]]:
        return [bytes(w).split() for w in made or []]

    drawn = taken(_drawn("text", "toxic"))
    marks = [r["toxic"] for r in drawn]
    place = {(r["doc_id"], r["th"], r["toxic"]): k for k, r in enumerate(drawn)}
    at = lambda r: place.get((r["doc_id"], r["th"], r["toxic"]))
    toxic, clean = max(sum(marks), 1), max(len(marks) - sum(marks), 1)
    net = fitted(
        [(r["toxic"], windows(r["made"])) for r in drawn],
        lambda net: {at(r): windows(r["made"]) for r in taken(_mined(net.slim())("text"), F.col("toxic") == 1)},
        lambda net: {at(r): r["made"] for r in taken(_figured(net.slim())("text"))},
        clean_weight=(sizes.get(0, 0) / clean) / max(sizes.get(1, 0) / toxic, 1e-9),
    )
    stash.drop(texts)
    return net


def scored(net: Network, text: Column | str = "text") -> Column:
    """Score column for a text column."""
    return scorer(net)(text)


def keep_clean(docs: DataFrame, net: Network, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the network does not reject."""
    return docs.where(scored(net, F.col(text)) < threshold)
