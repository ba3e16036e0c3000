"""Helpers on the UTF-8 bytes of whole texts inside a task."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SLICE_BYTES = 1 << 20


def _folding() -> bytes:
    """A-Z to a-z; every other ASCII character that is no letter or digit to a blank."""
    return bytes(ord(chr(b).lower()) if b > 127 or chr(b).isalnum() else 0x20 for b in range(128)) + bytes(range(128, 256))


FOLDED = _folding()


def folded_words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and whatever is not ASCII; only A-Z is lower-cased."""
    return text.translate(FOLDED).split()


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Start and length of stretches of texts of a bounded size (or of one text)."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at, size = 0, 0
    for k, more in enumerate(sizes.tolist()):
        if k > at and size + more > most:
            yield at, k - at
            at, size = k, 0
        size += more
    if at < len(texts):
        yield at, len(texts) - at


def tidied(made: Iterator) -> Iterator:
    """What a task makes; at its end what its worker does not need any more goes back to the system.

    Workers are kept for later tasks and stages, and so would be the memory that the C
    heap and Arrow hold in reserve.
    """
    try:
        yield from made
    finally:
        del made
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each stretch of the values; the stretches lie one after the other."""
    running = np.r_[0, np.cumsum(values)]
    ends = np.cumsum(lengths)
    return running[ends] - running[ends - lengths]


def need_integer(frame: DataFrame, column: str) -> None:
    """Ids are integers; other types are refused before any job runs."""
    kind = frame.select(column).schema[0].dataType
    if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"{column} must be an integer column, it is {kind.simpleString()}")
