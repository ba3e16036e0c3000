"""SentencePiece encoding and decoding on the tokenizers library.

The model protobuf is parsed and rebuilt as a tokenizers pipeline: its normaliser
(precompiled character map, white-space clean-up, dummy prefix), the metaspace marker,
its pieces with their scores (unigram), or the merges that the scores of a BPE model
imply, and byte fallback. Batches are encoded with the library's threads.

Where the vocabulary has no piece that goes on over the start of a word, a text's
encoding is the encodings of its words put together. Then each distinct word of a task
is encoded once (a bounded cache), by the backend and by the sentencepiece library, and
both must agree for ``parity``; other models encode and compare whole texts. Where they
differ, the ids are sentencepiece's, whose definition the model follows, and ``parity``
is false for the text.

Defined results: NULL text has NULL ids; empty text has no ids and decodes to itself;
the ids of any text decode to its normalised form (``round_trip``). One row per row,
no shuffle; other columns, ids and repeats do not matter.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

from tallyline.llm.rawtext import tidied

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
THREADS = 2
CACHE_WORDS = 250_000
CACHE_CHARS = 8 << 20
LINE_WORDS = 40

# Piece types and model types of the protobuf.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2


def parse(model: bytes):
    """The model protobuf."""
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    return proto


def _merges(scores: dict[str, float], order: dict[str, int]) -> list[tuple[str, str]]:
    """Pairs whose union is a piece, best piece first."""
    found = []
    for piece, score in scores.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in scores and right in scores:
                found.append((-score, order[piece], order[left], left, right))
    found.sort()
    return [(left, right) for *_, left, right in found]


def build(model: bytes) -> Tokenizer:
    """The tokenizers pipeline of a SentencePiece model."""
    proto = parse(model)
    if any(p.type == USER_DEFINED for p in proto.pieces):
        raise ValueError("models with user-defined pieces are not supported")
    spec, byte_fallback = proto.normalizer_spec, proto.trainer_spec.byte_fallback
    unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
    if proto.trainer_spec.model_type == UNIGRAM:
        # Pieces that text never matches get a score that no path takes.
        floor = min((p.score for p in proto.pieces), default=0.0) - 1e4
        vocab = [(p.piece, p.score if p.type in (NORMAL, UNKNOWN) else floor) for p in proto.pieces]
        core = models.Unigram(vocab, unk_id=unknown, byte_fallback=byte_fallback)
    elif proto.trainer_spec.model_type == BPE:
        order = {p.piece: i for i, p in enumerate(proto.pieces)}
        scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        core = models.BPE(
            order,
            _merges(scores, order),
            unk_token=proto.pieces[unknown].piece,
            fuse_unk=True,
            byte_fallback=byte_fallback,
            cache_capacity=0,  # lines of distinct words never come again
        )
    else:
        raise ValueError("only unigram and BPE models are supported")
    tokenizer = Tokenizer(core)
    steps = []
    if spec.precompiled_charsmap:
        steps.append(normalizers.Precompiled(spec.precompiled_charsmap))
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if spec.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    after = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if spec.add_dummy_prefix:
        after.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(after)
    return tokenizer


class Codec:
    """Encoder and decoder of one model, with the sentencepiece library beside it."""

    def __init__(self, model: bytes, threads: int = THREADS):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        self.threads = threads
        self.proto = parse(model)
        self.tokenizer = build(model)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=model)
        spec = self.proto.normalizer_spec
        self.dummy = spec.add_dummy_prefix
        texts = [p.piece for p in self.proto.pieces if p.type == NORMAL]
        self.by_word = (
            self.dummy
            and spec.escape_whitespaces
            and not spec.precompiled_charsmap
            and not spec.remove_extra_whitespaces
            and not any(re.search(f"[^{MARK}]{MARK}", t) for t in texts)
        )
        self.bytes_of = [
            bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else b"" if p.type == CONTROL else p.piece.replace(MARK, " ").encode()
            for p in self.proto.pieces
        ]
        self.begins = np.array([p.piece.startswith(MARK) for p in self.proto.pieces])
        self._forget()

    def backend(self, texts: list[str]) -> list[list[int]]:
        """Ids by the tokenizers library, with its threads."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word_ids(self, encode, plain: list[str], odd: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has.

        Plain words go in lines, as a call per word costs more than its work; in a line
        only the first piece of a word begins with the marker.
        """
        lines = [" ".join(plain[at : at + LINE_WORDS]) for at in range(0, len(plain), LINE_WORDS)]
        ids = np.fromiter(chain.from_iterable(encode(lines)), np.int32)
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) != len(plain) or (len(starts) and starts[0]):
            raise ValueError("a word of a line has no piece of its own")
        # A marker alone ends a text; by itself the empty word has no piece, so it is taken from behind another.
        others = [ids if w else encode(["a "])[0][len(encode(["a"])[0]) :] for w, ids in zip(odd, encode(odd), strict=True)]
        lengths = np.r_[np.diff(np.r_[starts, len(ids)]), [len(o) for o in others]].astype(np.int64)
        return np.r_[ids, np.fromiter(chain.from_iterable(others), np.int32)], lengths

    def _learn(self, missing: list[str]) -> None:
        """Give each missing word its place in the pool."""
        plain = [w for w in missing if w and " " not in w]
        odd = [w for w in missing if not w or " " in w]
        mine, my_lengths = self._word_ids(self.backend, plain, odd)
        ids, lengths = self._word_ids(lambda t: self.reference.encode(t, num_threads=self.threads), plain, odd)
        base, words = len(self.lengths), plain + odd
        self.held += sum(map(len, words))
        self.index.update(zip(words, range(base, base + len(words)), strict=True))
        begins = np.cumsum(lengths) - lengths
        text = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        same = np.array_equal(mine, ids) and np.array_equal(my_lengths, lengths)
        if not same:
            at = np.cumsum(my_lengths) - my_lengths
            for word, i, n, j, k in zip(words, at, my_lengths, begins, lengths, strict=True):
                if n != k or not np.array_equal(mine[i : i + n], ids[j : j + k]):
                    self.unlike.add(word)
        if text != "".join(" " + w for w in words).encode():
            for word, j, k in zip(words, begins, lengths, strict=True):
                if self.decode(ids[j : j + k].tolist()) != word:
                    self.lossy.add(word)
        self.begin = np.r_[self.begin, begins + len(self.pool)]
        self.lengths = np.r_[self.lengths, lengths]
        self.pool = np.r_[self.pool, ids]

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.held = 0
        self.unlike: set[str] = set()
        self.lossy: set[str] = set()
        self.pool = np.zeros(0, np.int32)
        self.begin, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _split(self, text: str) -> list[str]:
        """Words of a text with all but one of the spaces before each."""
        if "  " not in text and MARK not in text and text[:1] != " " and text[-1:] != " ":
            return text.split(" ")
        return [w[1:] for w in re.findall(" +[^ ]*", " " + text.replace(MARK, " "))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts one after the other; per text how many, whether both
        libraries agree on it, and whether its ids decode to its normalised form."""
        if not self.by_word:
            ours, theirs = self.backend(texts), self.reference.encode(texts, num_threads=self.threads)
            ids = np.fromiter(chain.from_iterable(theirs), np.int32)
            same = np.array([m == y for m, y in zip(ours, theirs, strict=True)], bool)
            back = np.array([self.decode(y) == self.normalised(t) for y, t in zip(theirs, texts, strict=True)], bool)
            return ids, np.array([len(y) for y in theirs], np.int64), same, back
        split = [self._split(t) if t else [] for t in texts]
        counts = np.array([len(w) for w in split], np.int64)
        words = list(chain.from_iterable(split))
        if len(self.index) > CACHE_WORDS or self.held > CACHE_CHARS:
            self._forget()
        found = self.index.get
        places = np.array([found(w, -1) for w in words], np.int64)
        gaps = np.flatnonzero(places < 0).tolist()
        if gaps:
            self._learn(list(dict.fromkeys(words[g] for g in gaps)))
            places[gaps] = [found(words[g]) for g in gaps]
        lengths = self.lengths[places]
        ends = np.cumsum(lengths)
        shift = np.repeat((self.begin[places] - (ends - lengths)).astype(np.int32), lengths)
        ids = self.pool[shift + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
        reach = np.r_[0, ends][np.cumsum(counts)] if len(counts) else np.zeros(0, np.int64)
        bad = [[not words_bad.isdisjoint(w) for w in split] if words_bad else [False] * len(split) for words_bad in (self.unlike, self.lossy)]
        return ids, np.diff(np.r_[0, reach]), ~np.array(bad[0], bool), ~np.array(bad[1], bool)

    def decode(self, ids: list[int]) -> str:
        """The normalised text of some ids."""
        data = b"".join(map(self.bytes_of.__getitem__, ids))
        if self.dummy and data[:1] == b" ":
            data = data[1:]
        return data.decode(errors="replace")

    def normalised(self, text: str) -> str:
        """What the ids of a text decode to."""
        if self.by_word:
            return text.replace(MARK, " ")
        made = self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
        made = made.replace(MARK, " ")
        return made[1:] if self.dummy and made[:1] == " " else made


SLICE_BYTES = 1 << 20


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and length of stretches of texts of a bounded size (or of one text)."""
    sizes = np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at, size = 0, 0
    for k, more in enumerate(sizes.tolist()):
        if k > at and size + more > SLICE_BYTES:
            yield at, k - at
            at, size = k, 0
        size += more
    if at < len(texts):
        yield at, len(texts) - at


_MADE = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("parity", T.BooleanType()),
        T.StructField("round_trip", T.BooleanType()),
    ]
)


def _encoder(model: bytes, text: str, keep: list[str]):
    def made(codec: Codec, texts: pa.Array) -> list[pa.Array]:
        given = texts.to_pylist()
        none = np.array([t is None for t in given], bool)
        ids, counts, same, back = codec.encode([t for t in given if t is not None])
        lengths = np.zeros(len(given), np.int64)
        lengths[~none] = counts
        offsets = pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32))
        flags = [np.zeros(len(given), bool) for _ in range(2)]
        for flag, values in zip(flags, (same, back), strict=True):
            flag[~none] = values
        lists = pa.ListArray.from_arrays(offsets, pa.array(ids), mask=pa.array(none))
        return [lists, *(pa.array(flag, mask=none) for flag in flags)]

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The codec and its words live as long as the task; what comes out is as small as a slice.
        codec = Codec(model)
        for batch in batches:
            texts = batch.column(text)
            for at, size in _slices(texts):
                kept = [batch.column(c).slice(at, size) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, *made(codec, texts.slice(at, size))], names=[*keep, *_MADE.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from tidied(slices(batches))

    return run


def decoder(model: bytes):
    """Arrow UDF: ids to text, by the tokenizers library's decoder."""

    @F.arrow_udf(T.StringType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = build(model)
        for ids in batches:
            given = ids.to_pylist()
            texts = tokenizer.decode_batch([i or [] for i in given], skip_special_tokens=False)
            yield pa.array([None if i is None else t for i, t in zip(given, texts, strict=True)], pa.string())

    return decode


def read_model(spark: SparkSession, path: str = MODEL_PATH) -> bytes:
    """The model file; vocabulary files are small and travel with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def encoded(docs: DataFrame, model: bytes, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns, then ``ids``, ``parity`` and ``round_trip`` of the text; a row per row."""
    taken = set(keep) & set(_MADE.names)
    if taken:
        raise ValueError(f"column names kept for the result: {sorted(taken)}")
    given = docs.select(*keep, F.col(text).alias("llm_text"))
    shape = T.StructType([*docs.select(*keep).schema.fields, *_MADE.fields])
    return given.mapInArrow(_encoder(model, "llm_text", keep), shape)
