"""Language ID by averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of all its words' subwords (hashed byte n-grams of
the lower-cased, end-marked word, and the word as one). A linear layer and softmax give
the languages' chances. Both are trained in numpy by stochastic gradient descent, on
the driver, on a bounded sample: ``SAMPLE_ROWS`` rows dealt out evenly over languages
(one of each at least), ``SAMPLE_WORDS`` words drawn over the whole of each text, and a short
piece of each so that short texts are met.

As the mean and the layer are linear, a word's share in the logits is worked out once
per task and word; a text is then a sum over its words, the whole of it.

Calibration: on a fifth of the sample kept out of training, a temperature is chosen by
likelihood, and the least chance at which accepted predictions reach ``PRECISION`` is
the line of rejection; ``accepted`` tells which predictions pass it.

Defined results: NULL text and text without a letter are ``und`` with score 0, not
accepted; where nothing can be learned every text is ``und``; rows without an id are
not held out; a tie goes to the first language by code point; repeats score alike.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import learnable
from tallyline.llm.subwords import bags
from tallyline.llm.toxicity import scatter

ORDERS = (2, 3, 4)
BUCKETS = 1 << 16
WIDTH = 16
SAMPLE_ROWS = 3000
SAMPLE_WORDS = 120
WORD_CHARS = 400
BROADCAST_LANGUAGES = 100_000
EPOCHS = 3
BATCH = 32
RATE = 0.1
PRECISION = 0.995
CACHE_WORDS = 250_000
SLICE_WORDS = 200_000
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Model:
    languages: list[str]
    embedding: np.ndarray
    layer: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0

    def slim(self) -> Model:
        return Model(
            self.languages,
            self.embedding.astype(np.float32),
            self.layer.astype(np.float32),
            self.bias,
            self.temperature,
            self.least,
        )


def softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return shifted / shifted.sum(axis=-1, keepdims=True)


def has_letter(text: str) -> bool:
    """Is there a letter? The pattern also finds numerals such as ½, which are none."""
    return any(found.group().isalpha() for found in _LETTER.finditer(text))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().split()


def _step(model: Model, past: dict, texts: list[list[bytes]], wanted: np.ndarray, rate: float) -> None:
    """One gradient step on a batch."""
    ids, starts = bags([w for words in texts for w in words], ORDERS, BUCKETS)
    firsts = np.cumsum([0, *map(len, texts)])[:-1]
    bounds = np.r_[starts[firsts], len(ids)]
    sizes = np.diff(bounds)
    means = np.add.reduceat(model.embedding[ids], bounds[:-1], axis=0) / sizes[:, None]
    slope = softmax(means @ model.layer + model.bias)
    slope[np.arange(len(texts)), wanted] -= 1
    slope /= len(texts)
    back = (slope @ model.layer.T) / sizes[:, None]
    touched, place = np.unique(ids, return_inverse=True)
    rows = scatter(place, np.repeat(back, sizes, axis=0), len(touched))
    # Steps shrink with the squared gradients so far (per entry, or per embedding row).
    for name, values, gradient in (("layer", model.layer, means.T @ slope), ("bias", model.bias, slope.sum(axis=0))):
        past[name] += gradient**2
        values -= rate * gradient / np.sqrt(past[name] + 1e-10)
    past["rows"][touched] += (rows**2).mean(axis=1)
    model.embedding[touched] -= rate * rows / np.sqrt(past["rows"][touched] + 1e-12)[:, None]


def train(texts: list[str], langs: list[str], seed: int = 5) -> Model | None:
    """Fit the model and its calibration."""
    rows = [(words_of(t)[:SAMPLE_WORDS], y) for t, y in zip(texts, langs, strict=True)]
    rows = [r for r in rows if r[0]]
    languages = sorted({y for _, y in rows}, key=lambda y: y.encode())
    if not languages:
        return None
    draw = np.random.default_rng(seed)
    rows = [rows[k] for k in draw.permutation(len(rows))]
    aside, learn = rows[::5], [r for k, r in enumerate(rows) if k % 5] or rows
    model = Model(
        languages,
        draw.uniform(-1.0, 1.0, (BUCKETS, WIDTH)) / WIDTH,
        np.zeros((WIDTH, len(languages))),
        np.zeros(len(languages)),
    )
    number = {y: k for k, y in enumerate(languages)}
    past = {"layer": np.zeros_like(model.layer), "bias": np.zeros_like(model.bias), "rows": np.zeros(BUCKETS)}
    total = EPOCHS * (-(-2 * len(learn) // BATCH))
    done = 0
    for _ in range(EPOCHS):
        pieces = []
        for words, lang in learn:
            size = int(draw.integers(1, 9))
            at = int(draw.integers(0, max(1, len(words) - size + 1)))
            pieces += [(words, lang), (words[at : at + size], lang)]
        order = draw.permutation(len(pieces))
        for at in range(0, len(order), BATCH):
            some = [pieces[k] for k in order[at : at + BATCH]]
            _step(model, past, [w for w, _ in some], np.array([number[y] for _, y in some]), RATE * (1 - done / total))
            done += 1
    # Whole texts are rarely wrong, so short pieces of them are what shows how far chances can be trusted.
    cut = [int(draw.integers(0, len(w))) for w, _ in aside]
    _calibrate(model, aside + [(w[c : c + 1 + k % 3], y) for k, (c, (w, y)) in enumerate(zip(cut, aside, strict=True))], number)
    return model.slim()


def _calibrate(model: Model, rows: list, number: dict[str, int]) -> None:
    raw = raw_logits(model, [w for w, _ in rows])
    wanted = np.array([number[y] for _, y in rows])
    best, at = np.inf, np.arange(len(rows))
    for temperature in np.geomspace(0.02, 8.0, 80):
        loss = -np.log(softmax(raw / temperature)[at, wanted] + 1e-12).mean()
        if loss < best:
            best, model.temperature = loss, float(temperature)
    chances = softmax(raw / model.temperature)
    sure = chances.max(axis=1)
    order = np.argsort(-sure, kind="stable")
    right = np.cumsum(chances.argmax(axis=1)[order] == wanted[order]) / np.arange(1, len(rows) + 1)
    good = np.flatnonzero(right >= PRECISION)
    model.least = float(sure[order][good[-1]]) if len(good) else 1.0


class Shares:
    """Logit shares of the distinct words met so far."""

    def __init__(self, model: Model):
        self.model = model
        self.table = model.embedding.astype(np.float64) @ model.layer
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.shares = np.zeros((0, len(self.model.languages)))
        self.counts = np.zeros(0)

    def tokens(self, words: list[bytes]) -> np.ndarray:
        if len(self.number) > CACHE_WORDS:
            self.forget()
        known = len(self.number)
        found, number = self.number.setdefault, self.number
        tokens = np.array([found(w, len(number)) for w in words], np.int64)
        if len(number) > known:
            ids, starts = bags(list(islice(number, known, None)), ORDERS, BUCKETS)
            self.shares = np.concatenate([self.shares, np.add.reduceat(self.table[ids], starts, axis=0)])
            self.counts = np.r_[self.counts, np.diff(np.r_[starts, len(ids)])]
        return tokens


def raw_logits(model: Model, texts: list[list[bytes]], shares: Shares | None = None) -> np.ndarray:
    """Logits before the temperature; a text without words has the bias."""
    shares = shares or Shares(model)
    tokens = shares.tokens([w for words in texts for w in words])
    made = np.tile(model.bias, (len(texts), 1)).astype(np.float64)
    sizes = np.array([len(words) for words in texts])
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        made[full] += np.add.reduceat(shares.shares[tokens], starts, axis=0) / np.add.reduceat(shares.counts[tokens], starts)[:, None]
    return made


def predict(model: Model | None, texts: list[str | None], shares: Shares | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and acceptance of each text."""
    langs, scores, accepted = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
    if model is None:
        return langs, scores, accepted
    shares = shares or Shares(model)
    held: list[tuple[int, list[bytes]]] = []
    size = 0

    def settle() -> None:
        chances = softmax(raw_logits(model, [w for _, w in held], shares) / model.temperature)
        for (k, _), row in zip(held, chances, strict=True):
            best = int(row.argmax())
            langs[k], scores[k] = model.languages[best], float(row[best])
            accepted[k] = row[best] >= model.least

    for k, text in enumerate(texts):
        if text and has_letter(text):
            held.append((k, words_of(text)))
            size += len(held[-1][1])
            if size > SLICE_WORDS:
                settle()
                held, size = [], 0
    if held:
        settle()
    return langs, scores, accepted


_PREDICTED = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("accepted", T.BooleanType()),
    ]
)


def predictor(model: Model | None):
    """Arrow UDF: text to ``(lang_pred, score, accepted)``."""

    @F.arrow_udf(_PREDICTED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        shares = Shares(model) if model else None
        for texts in batches:
            langs, scores, accepted = predict(model, texts.to_pylist(), shares)
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores), pa.array(accepted)], names=_PREDICTED.names
            )

    return run


def drawn_words(text: str | None, most: int = SAMPLE_WORDS) -> str | None:
    """Some words of a text, drawn at random over the whole of it, in their order; the same ones in every run.

    Of a very long stretch without white space a piece from a random place stands for the word.
    """
    if text is None:
        return None
    words = text.split()
    draw = np.random.default_rng(zlib.crc32(text.encode()))
    if len(words) > most:
        words = [words[k] for k in np.sort(draw.choice(len(words), most, replace=False)).tolist()]
    for k, word in enumerate(words):
        if len(word) > WORD_CHARS:
            at = int(draw.integers(0, len(word) - WORD_CHARS + 1))
            words[k] = word[at : at + WORD_CHARS]
    return " ".join(words)


@F.arrow_udf(T.StringType())
def _drawn(texts: pa.Array) -> pa.Array:
    return pa.array([drawn_words(t) for t in texts.to_pylist()], pa.string())


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """Train on a bounded sample of the rows that may be learned from, even over languages.

    Every language has its share of the ``rows``, one row at least. Words are drawn from
    whole texts inside the tasks.
    """
    known = docs.where(learnable("doc_id", 4, 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("n"))
    languages = sizes.count()
    if not languages:
        return None
    each = max(1, rows // languages)
    # Many more than needed pass the draw by hash, so that no language is left out by chance.
    share = F.least(F.lit(1.0), (each + 4 * each**0.5 + 32) / F.col("n"))
    lucky = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 40)) < share * F.lit(float(1 << 40))
    small = F.broadcast(sizes) if languages <= BROADCAST_LANGUAGES else sizes
    drawn = known.select("doc_id", "text", "lang").join(small, F.col("lang") == F.col("of")).where(lucky)
    words = drawn.select("doc_id", "lang", _drawn("text").alias("text"))
    order = [F.xxhash64("doc_id", "lang"), F.col("doc_id"), F.col("text")]
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).alias("place")
    found = words.select("lang", "text", *(c.alias(f"o{k}") for k, c in enumerate(order)), place).where(F.col("place") <= each)
    chosen = found.orderBy("o0", "o1", "o2", "lang").collect()
    return train([r["text"] for r in chosen], [r["lang"] for r in chosen])


def predicted(model: Model | None, text: Column | str = "text") -> Column:
    """Struct of language, score and acceptance for a text column."""
    return predictor(model)(text)
