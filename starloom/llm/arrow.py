"""What the operators share inside tasks: text buffers as arrays, words and their hashes.

Text reaches a task as Arrow batches.  A batch is cut into slices of a few
megabytes, so the arrays made for it stay small however long its texts are;
only a single text longer than a slice makes a slice of its own.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of text that are turned into arrays at once.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = 0xD6E8FEB86659FD93


_sent: set[str] = set()


def send_code(spark: SparkSession) -> None:
    """Give executors this package's source, once a session: it need not be installed there."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="starloom-code-")) / "starloom-code.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    _sent.add(context.applicationId)


def strings(column) -> pa.Array:
    """A text column with 64-bit offsets; null stands for the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, where each begins); ``texts`` as ``strings`` gives them."""
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = texts.buffers()
    at = np.frombuffer(where, np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    _, at = buffers(texts)
    n, begin = len(texts), 0
    while begin < n:
        end = int(np.searchsorted(at, at[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), n)
        yield begin, end
        begin = end


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes lie in one of the ranges, both ends included."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Digits, small letters and every byte of a character beyond ASCII.
WORD_BYTES = byte_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def words(data: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, first): where the words lie, and each text's first word (one entry more than texts)."""
    inside = table[data]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(inside):
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cuts = at[1:-1]
        before[cuts[cuts < len(inside)]] = False
        after[cuts[cuts > 0] - 1] = False
    begin = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return begin, end, np.searchsorted(begin, at)


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    out = []
    for base in (_BASE, _INVERSE):
        powers = np.full(n, base, np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Hashes:
    """64-bit hashes of any ranges of a buffer, equal for equal bytes wherever they lie."""

    def __init__(self, data: np.ndarray):
        powers, self._inverse = _powers(max(20, int(len(data)).bit_length()))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=self._sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self._sums[end] - self._sums[begin]) * self._inverse[begin]
        return mix(value ^ (end - begin).astype(np.uint64))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k words in a row: entry i covers words i to i + k - 1."""
    n = max(len(hashes) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(_STEP) + hashes[j : j + n]
    return mix(out)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values occur in ``known``, which is sorted."""
    if not len(known) or not len(values):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values
