import json
import random
from hashlib import sha256

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyline.llm import fragments

ALPHABET = [
    "a", "Z", "é", "é", "́", " ", "  ", "\n", "\t", "\x1c", "\x85", "᠎", "　", "'", "'s", "'LL", "<|endoftext|>",
    "<|startoftext|>", "<|end", "中文", "１", "²", "9", "--", "…", "İ", "Σ", "ς", "ß", "😀", "​", "\x00", "</w>", "ﬁ", "가", "가",
    "=", "̸", "_", "don't", "the", "substring",
]
LONG = ["a" * 5000, "中" * 3000, "-=" * 3000, "word " * 4000, "x1" * 2000 + " " + "́" * 50]


@pytest.fixture(scope="module", params=["word_bpe_49k.json", "byte_bpe_50k.json"])
def model(request):
    return fragments.read_model(public_tokenizers.path(request.param))


def odd_texts(n):
    draw = random.Random(7)
    return ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 25))) for _ in range(n)] + LONG


def test_equals_library(model):
    encoder, library, texts = fragments.ForcedBoundaryEncoder(model), Tokenizer.from_str(model), odd_texts(4000)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_no_token_spans_a_cut(model):
    """Every cut is one that no token of the vocabulary has inside, and every such place is cut."""
    encoder = fragments.ForcedBoundaryEncoder(model)
    vocabulary = json.loads(model)["model"]["vocab"]
    words = ["zqxjkvw", "ab!ĠĊ", "Ġthe", "x" * 40, "q", "Ã©Ċ0", "é"]
    cuts = encoder.cuts(words)
    held = {token[k : k + 2] for token in vocabulary for k in range(len(token) - 1)}
    wanted = {n: [k for k in range(1, len(w)) if w[k - 1 : k + 1] not in held] for n, w in enumerate(words)}
    assert cuts == {n: at for n, at in wanted.items() if at} and cuts
    assert encoder.cuts(["the"]) == {}


def test_full_memo_starts_anew(model, monkeypatch):
    monkeypatch.setattr(fragments, "MEMO_BYTES", 1)
    encoder, library = fragments.ForcedBoundaryEncoder(model), Tokenizer.from_str(model)
    for _ in range(3):
        texts = ["one two three", "two", ""]
        assert encoder.encode(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_runs_are_used_where_steps_are_local():
    local = {n: fragments.ForcedBoundaryEncoder(fragments.read_model(public_tokenizers.path(n))).local for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}
    assert local == {"word_bpe_49k.json": True, "byte_bpe_50k.json": False}


def test_other_models_are_refused(model):
    spec = json.loads(model)
    for change in ({"dropout": 0.1}, {"unk_token": "<unk>"}, {"continuing_subword_prefix": "##"}):
        with pytest.raises(ValueError):
            fragments.ForcedBoundaryEncoder(json.dumps(spec | {"model": spec["model"] | change}))
    with pytest.raises(ValueError, match="byte alphabet"):
        fragments.ForcedBoundaryEncoder(json.dumps(spec | {"pre_tokenizer": None}))


def digest(text):
    return sha256(text.encode()).hexdigest()


def test_column(spark, model):
    texts = [*odd_texts(50), "", None, "same", "same"]
    rows = [(None if k == 3 else k % 60, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash")).withColumn("llm_text", F.lit(1))
    with pytest.raises(ValueError, match="n_tokens"):
        fragments.encoded(docs, model, ["doc_id", "n_tokens"])
    library = Tokenizer.from_str(model)
    wanted = []
    for ident, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        wanted.append((ident, len(ids), digest(" ".join(map(str, ids))), digest(decoded)))
    order = lambda row: str(row)
    assert sorted(map(tuple, fragments.encoded(docs, model, ["doc_id"]).collect()), key=order) == sorted(wanted, key=order)
    whole = fragments.encoded(docs, model, ["text"], ("ids", "decoded")).collect()
    for row in whole:
        assert row["ids"] == library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["decoded"] == library.decode(row["ids"], skip_special_tokens=False)
    assert fragments.encoded(docs.limit(0), model, ["doc_id"]).count() == 0
