import os

import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from tallyline.llm import pieces

ODD = [
    "", " ", "  ", "   a", "a     b", "a           b  ", "x▁y", "▁", "<s> a </s>", "<0x41>", "日本 語\n\n\tz",
    "🎉🎉 ok", "\x00\x01é", "don't stop", "Élan ß ﬁ", "word " * 3000, "a" * 3000,
]


def unigram_model(dummy=True, squeeze=False):
    """A small model written by hand, not trained."""
    proto = sentencepiece_model_pb2.ModelProto()
    proto.trainer_spec.model_type = 1
    proto.trainer_spec.byte_fallback = True
    proto.normalizer_spec.name = "identity"
    proto.normalizer_spec.add_dummy_prefix = dummy
    proto.normalizer_spec.remove_extra_whitespaces = squeeze
    proto.normalizer_spec.escape_whitespaces = True
    parts = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    parts += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    words = ["▁", "a", "b", "c", "▁a", "ab", "▁ab", "abc", "bc", "▁ca", "b▁c", "cab", "▁b"]
    parts += [(w, -1.0 - 0.37 * k - 0.0131 * k * k, 1) for k, w in enumerate(words)]
    for piece, score, kind in parts:
        proto.pieces.add(piece=piece, score=score, type=kind)
    return proto.SerializeToString()


@pytest.fixture(scope="module")
def model():
    if not os.path.exists(pieces.MODEL_PATH):
        pytest.skip("no model file")
    return pieces.read_model(None)


def check(codec, texts):
    ids, counts, same, back = codec.encode(texts)
    wanted = [codec.reference.encode(t) for t in texts]
    at = 0
    for text, n, yours in zip(texts, counts, wanted, strict=True):
        assert ids[at : at + n].tolist() == yours, text
        at += n
    assert at == len(ids) and same.all()
    assert codec.backend(texts) == wanted
    return back


def test_words_equal_whole_texts(model):
    codec = pieces.Codec(model)
    assert codec.by_word
    assert check(codec, ODD).all()
    for text in ODD:
        ids = codec.reference.encode(text)
        assert codec.decode(ids) == codec.normalised(text) == codec.tokenizer.decode(ids, skip_special_tokens=False)


def test_full_cache_starts_anew(model, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 3)
    codec = pieces.Codec(model)
    for _ in range(3):
        assert check(codec, ["one two three four five", "six seven"]).all()


@pytest.mark.parametrize("dummy", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
def test_unigram_model(dummy, squeeze):
    codec = pieces.Codec(unigram_model(dummy, squeeze))
    assert not codec.by_word
    texts = ["abc cab", "ab ca bc", "b c", "abcabcabc", "x", "é ab", "cab abc b ca", "a"]
    check(codec, texts)


def test_unlike_words_are_told(model):
    """Where the backend's ids differ, the ids are sentencepiece's and the text is marked."""
    codec = pieces.Codec(model)
    real = codec.backend

    def wrong(texts):
        made = real(texts)
        return [[ids[0], ids[2], *ids[2:]] if "grotesquely" in text else ids for text, ids in zip(texts, made, strict=True)]

    codec.backend = wrong
    texts = ["grotesquely", "plain words"]
    ids, counts, same, _ = codec.encode(texts)
    assert same.tolist() == [False, True]
    assert ids.tolist() == [i for t in texts for i in codec.reference.encode(t)] and counts.sum() == len(ids)


def test_column(spark, model):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(98, None), (None, "same"), (None, "same")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("llm_text", F.lit(1))
    made = pieces.encoded(docs, model, ["doc_id", "text"])
    with pytest.raises(ValueError, match="ids"):
        pieces.encoded(docs, model, ["doc_id", "ids"])
    made = made.withColumn("decoded", pieces.decoder(model)("ids"))
    reference = sentencepiece.SentencePieceProcessor(model_proto=model)
    got = made.collect()
    assert len(got) == len(rows)
    for r in got:
        if r["text"] is None:
            assert r["ids"] is None and r["parity"] is None and r["decoded"] is None
        else:
            assert r["ids"] == reference.encode(r["text"]) and r["parity"] and r["round_trip"]
            assert r["decoded"] == r["text"].replace("▁", " ")
    assert pieces.encoded(docs.limit(0), model, ["doc_id"]).count() == 0
