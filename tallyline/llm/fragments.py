"""BPE encoding and decoding by forced boundaries.

A merge makes a token of the vocabulary, so two neighbouring bytes that no token holds
side by side are never merged over: the place between them is a certain cut. Texts
are normalised and split into words as the tokenizer file says, each word is cut at
all certain cuts, each distinct fragment is encoded by itself, and the ids are put
together again. The end of a word counts as a byte of its own where the model marks
it, so only a word's last fragment is encoded with the mark.

Where the file's steps treat each run between white space alone (NFC, white-space
clean-up and lower case, then a split that drops white space), runs are looked up in a
memo of bounded bytes; with any other steps whole texts are normalised and split. Texts
are worked on in slices of about 1 MB, whole texts always. Special tokens of the file
found in a text are tokens, as in the library.

Defined results: NULL text is taken as empty; a text without tokens has no ids and
decodes to the empty text. One row per row, no shuffle; ids of rows and repeats do
not matter. Decoding is the library's: with a decoder in the file its decoder, else the
tokens joined by blanks.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tallyline.llm.rawtext import slices, sums, tidied

MODEL_NAME = "word_bpe_49k.json"
MEMO_BYTES = 96 << 20
ENTRY_BYTES = 200  # what a memo entry takes besides its characters, about
BREAK = "\n"  # no character of the byte alphabet
LINE_FRAGMENTS = 256
# White space by which Python splits a text and the tokenizers library does not.
ODD_SPACES = re.compile("[\x1c-\x1f]")
LOCAL_STEPS = ("NFC", "Lowercase", "Replace")


def read_model(path: str | None = None) -> str:
    """The tokenizer file; vocabulary files are small and travel with the tasks."""
    with open(path or public_tokenizers.path(MODEL_NAME), encoding="utf-8") as file:
        return file.read()


def neighbours(tokens: list[str], suffix: str | None) -> np.ndarray:
    """Which characters (of the byte alphabet) stand side by side in some token.

    A token that ends in the end-of-word mark counts with it and as plain characters.
    """
    texts = list(tokens) + [t[: -len(suffix)] for t in tokens if suffix and t.endswith(suffix)]
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
    table = np.zeros((int(codes.max(initial=0)) + 2,) * 2, bool)
    table[codes[:-1], codes[1:]] = True
    table[ord("\n")], table[:, ord("\n")] = False, False
    return table


def gathered(pool: np.ndarray, lengths: np.ndarray, order: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of a pool in the given order, and how much each owner of ``counts`` of them has."""
    part = lengths[order]
    ends = np.cumsum(part)
    begins = np.cumsum(lengths) - lengths
    return pool[np.repeat(begins[order] - (ends - part), part) + np.arange(int(part.sum()))], sums(part, counts)


class ForcedBoundaryEncoder:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("only plain BPE models are supported")
        if model.get("unk_token") or model.get("byte_fallback"):
            raise ValueError("only BPE without an unknown token is supported")
        splitter = spec.get("pre_tokenizer") or {}
        if not any(s.get("type") == "ByteLevel" for s in splitter.get("pretokenizers", [splitter])):
            raise ValueError("only BPE over a byte alphabet is supported")
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in spec["added_tokens"]):
            raise ValueError("only plain special tokens are supported")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        bare = spec | {"truncation": None, "padding": None}
        self.library = Tokenizer.from_str(json.dumps(bare))
        # Fragments stand in lines, a break after each, as a call per fragment costs more than its work.
        lines = {"type": "Split", "pattern": {"String": BREAK}, "behavior": "Removed", "invert": False}
        core = bare | {"normalizer": None, "pre_tokenizer": lines, "post_processor": None, "added_tokens": []}
        self.last = Tokenizer.from_str(json.dumps(core))
        self.inner = Tokenizer.from_str(json.dumps(core | {"model": model | {"end_of_word_suffix": None}}))
        self.joined = neighbours(list(model["vocab"]), model.get("end_of_word_suffix"))
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        found = "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.special_at = re.compile(f"({found})") if found else None
        self.local = _is_local(spec)
        self.plain_words = _plain_words(spec) if self.local else None
        known = model["vocab"] | self.special
        self.id_text = list(map(str, range(max(known.values(), default=0) + 1)))
        self.token_text = list(map(self.library.id_to_token, range(len(self.id_text))))
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.pool, self.begin, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.used = 0

    def cuts(self, words: list[str]) -> dict[int, list[int]]:
        """The certain cuts inside words: of each word that has any, by its place."""
        text = BREAK.join(words)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        known = np.minimum(codes, len(self.joined) - 1)
        breaks = codes == ord(BREAK)
        places = np.flatnonzero(~self.joined[known[:-1], known[1:]] & ~breaks[:-1] & ~breaks[1:]) + 1
        begins = np.r_[0, np.flatnonzero(breaks) + 1]
        owners = np.searchsorted(begins, places, side="right") - 1
        found, firsts = np.unique(owners, return_index=True)
        parts = np.split(places - begins[owners], firsts[1:])
        return {word: at.tolist() for word, at in zip(found.tolist(), parts, strict=False)}

    def _encode(self, fragments: list[str], last: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all fragments, each encoded by itself, one after the other; and how many each has."""
        lines = [fragments[at : at + LINE_FRAGMENTS] for at in range(0, len(fragments), LINE_FRAGMENTS)]
        tokenizer = self.last if last else self.inner
        codes = tokenizer.encode_batch([BREAK.join(line) for line in lines], add_special_tokens=False)
        ids = [np.array(code.ids, np.int32) for code in codes]
        lengths = [np.bincount(np.array(code.word_ids, np.int64), minlength=len(line)) for line, code in zip(lines, codes, strict=True)]
        return np.concatenate([np.zeros(0, np.int32), *ids]), np.concatenate([np.zeros(0, np.int64), *lengths])

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, those of their fragments put together; and how many each has."""
        cuts = self.cuts(words)
        if not cuts:
            return self._encode(words, last=True)
        inner: dict[str, int] = {}
        final = dict.fromkeys(w for k, w in enumerate(words) if k not in cuts)
        pieces = {k: [words[k][x:y] for x, y in zip([0, *at], [*at, None], strict=True)] for k, at in cuts.items()}
        final |= dict.fromkeys(some[-1] for some in pieces.values())
        final = {p: k for k, p in enumerate(final)}
        for some in pieces.values():
            for p in some[:-1]:
                inner.setdefault(p, len(final) + len(inner))
        order: list[int] = []
        counts = np.ones(len(words), np.int64)
        for k, word in enumerate(words):
            some = pieces.get(k)
            if some:
                order += [inner[p] for p in some[:-1]]
                counts[k] = len(some)
            order.append(final[some[-1] if some else word])
        parts = [self._encode(list(final), last=True), self._encode(list(inner), last=False)]
        pool, lengths = (np.concatenate(arrays) for arrays in zip(*parts, strict=True))
        return gathered(pool, lengths, np.array(order, np.int64), counts)

    def _words(self, run: str) -> list[str | int]:
        """Words of a run in the byte alphabet; special tokens as their ids."""
        normaliser, splitter = self.library.normalizer, self.library.pre_tokenizer
        made: list[str | int] = []
        for part in self.special_at.split(run) if self.special_at else [run]:
            if part in self.special:
                made.append(self.special[part])
            elif part:
                made += [w for w, _ in splitter.pre_tokenize_str(normaliser.normalize_str(part) if normaliser else part)]
        return made

    def _words_of_runs(self, runs: list[str]) -> list[list[str | int]]:
        """Words of each run. Runs of printable ASCII take a short way; the others go to the library in lines."""
        if not self.local:
            return [self._words(run) for run in runs]
        made: list[list[str | int]] = [[]] * len(runs)
        others: list[int] = []
        for k, run in enumerate(runs):
            if self.special_at and "<" in run and self.special_at.search(run):
                made[k] = self._words(run)
            elif self.plain_words and run.isascii() and run.isprintable():
                made[k] = self.plain_words(run.lower())
            else:
                others.append(k)
        splitter, normaliser = self.library.pre_tokenizer, self.library.normalizer
        for at in range(0, len(others), LINE_FRAGMENTS):
            some = others[at : at + LINE_FRAGMENTS]
            line = " ".join(runs[k] for k in some)
            line = normaliser.normalize_str(line) if normaliser else line
            ends = np.cumsum([len(part) + 1 for part in line.split(" ")])
            found = splitter.pre_tokenize_str(line)
            if len(ends) != len(some):  # a run with white space of another kind
                for k in some:
                    made[k] = self._words(runs[k])
                continue
            owners = np.searchsorted(ends, [place[0] for _, place in found], side="right").tolist()
            for k in some:
                made[k] = []
            for owner, (word, _) in zip(owners, found, strict=True):
                made[some[owner]].append(word)
        return made

    def _learn(self, runs: list[str]) -> None:
        """Put the ids of runs that the memo lacks into the pool."""
        words = self._words_of_runs(runs)
        flat = list(chain.from_iterable(words))
        number = {w: k for k, w in enumerate(dict.fromkeys(w for w in flat if w.__class__ is str))}
        pool, lengths = self.encode_words(list(number))
        special = {i: len(number) + k for k, i in enumerate(self.special.values())}
        pool = np.r_[pool, np.array(list(special), np.int32)]
        lengths = np.r_[lengths, np.ones(len(special), np.int64)]
        order = np.fromiter(map((number | special).__getitem__, flat), np.int64, len(flat))
        ids, sizes = gathered(pool, lengths, order, np.fromiter(map(len, words), np.int64, len(words)))
        self.index.update(zip(runs, range(len(self.lengths), len(self.lengths) + len(runs)), strict=True))
        self.begin = np.r_[self.begin, len(self.pool) + np.cumsum(sizes) - sizes]
        self.lengths = np.r_[self.lengths, sizes]
        self.pool = np.r_[self.pool, ids]
        self.used += ENTRY_BYTES * len(runs) + 4 * len(ids) + sum(map(len, runs))

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        if self.used > MEMO_BYTES:
            self.forget()
        split = [self._runs(t) for t in texts]
        missing = set().union(*split).difference(self.index)
        if missing:
            self._learn(list(missing))
        runs = np.fromiter(map(self.index.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        part = self.lengths[runs]
        ends = np.cumsum(part)
        ids = self.pool[np.repeat(self.begin[runs] - (ends - part), part) + np.arange(int(part.sum()))]
        reach = np.r_[0, np.cumsum(sums(part, counts))].tolist()
        return [ids[x:y].tolist() for x, y in zip(reach, reach[1:], strict=False)]

    def ids_text(self, ids: list[int]) -> str:
        """Decimal ids, joined by blanks."""
        return " ".join(map(self.id_text.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """The text of some ids, as the library's ``decode(ids, skip_special_tokens=False)``."""
        if self.library.decoder is None:  # the library then joins the tokens by blanks
            return " ".join(map(self.token_text.__getitem__, ids))
        return self.library.decode(ids, skip_special_tokens=False)

    def _runs(self, text: str) -> list[str]:
        if not self.local:
            return [text] if text else []
        # Only these four need a split of another kind.
        return re.findall("(?:[^\\s]|[\x1c-\x1f])+", text) if ODD_SPACES.search(text) else text.split()


def _is_local(spec: dict) -> bool:
    """Do the steps treat each run between white space by itself?"""
    normaliser, splitter = spec.get("normalizer"), spec.get("pre_tokenizer")
    steps = normaliser.get("normalizers", [normaliser]) if normaliser else []
    splits = splitter.get("pretokenizers", [splitter]) if splitter else []
    if any(s["type"] not in LOCAL_STEPS for s in steps) or any(s["type"] not in ("Split", "ByteLevel") for s in splits):
        return False
    if any(s["type"] == "Replace" and (s["pattern"], s["content"]) != ({"Regex": r"\s+"}, " ") for s in steps):
        return False
    first = splits[0] if splits else {}
    drops = first.get("type") == "Split" and first["behavior"] == "Removed" and first["invert"]
    # Every alternative of the split must leave white space out and look at nothing around it.
    pattern = first.get("pattern", {}).get("Regex", " ") if drops else " "
    plain = not re.search(r"[ .^$]|\(\?|\\[sWDb]", pattern.replace(r"[^\s\p{L}\p{N}]", "").replace("[^", "["))
    return drops and plain and all(not s.get("add_prefix_space") and not s.get("use_regex", True) for s in splits[1:] if s["type"] == "ByteLevel")


def _plain_words(spec: dict):
    """The split of the file's pattern for lower-case printable ASCII, where letters and digits are a-z and 0-9."""
    first = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])[0]
    pattern = first["pattern"]["Regex"].replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9")
    lowers = any(s["type"] == "Lowercase" for s in (spec.get("normalizer") or {}).get("normalizers", []))
    return re.compile(pattern, re.ASCII).findall if lowers and "\\p" not in pattern and "(" not in pattern else None


_MADE = {
    "n_tokens": T.LongType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
    "ids": T.ArrayType(T.IntegerType()),
    "decoded": T.StringType(),
}
DIGESTS = ("n_tokens", "ids_sha256", "decoded_sha256")


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _columns(encoder: ForcedBoundaryEncoder, texts: pa.Array, names: tuple[str, ...]) -> list[pa.Array]:
    made: dict[str, list] = {name: [] for name in names}
    for ids in encoder.encode([t or "" for t in texts.to_pylist()]):
        for name, values in made.items():
            if name == "n_tokens":
                values.append(len(ids))
            elif name == "ids":
                values.append(ids)
            elif name == "ids_sha256":
                values.append(_digest(encoder.ids_text(ids)))
            else:
                text = encoder.decode(ids)
                values.append(text if name == "decoded" else _digest(text))
    kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
    return [pa.array(values, kinds.get(name, pa.string())) for name, values in made.items()]


def encoded(docs: DataFrame, model: str, keep: list[str], outputs: tuple[str, ...] = DIGESTS, text: str = "text") -> DataFrame:
    """The ``keep`` columns and the asked-for results of each text, a row per row.

    ``outputs`` are of ``n_tokens``, ``ids``, ``decoded`` and the digests of both.
    """
    taken = {k.lower() for k in keep} & set(outputs)
    if taken:
        raise ValueError(f"column names kept for the result: {sorted(taken)}")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ForcedBoundaryEncoder(model)
        for batch in batches:
            texts = batch.column("llm_text")
            for at, size in slices(texts):
                kept = [batch.column(k).slice(at, size) for k in range(len(keep))]
                made = _columns(encoder, texts.slice(at, size), outputs)
                yield pa.RecordBatch.from_arrays([*kept, *made], names=[*keep, *outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from tidied(encode(batches))

    given = docs.select(*keep, F.col(text).alias("llm_text"))
    shape = T.StructType([*docs.select(*keep).schema.fields, *(T.StructField(n, _MADE[n]) for n in outputs)])
    return given.mapInArrow(run, shape)
