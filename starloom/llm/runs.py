"""Periodic runs of words, found by seeds that are extended along diagonals.

Words are runs of ``[^\\x20\\x09-\\x0D]+``, numbered from 0 in their text.  A run is a
stretch with smallest period q (words q apart are equal) and a length of at
least ``max(LEAST, 3 * q)`` that no neighbouring word extends.

*Guaranteed overlap.*  On the diagonal of lag q, where word i meets word i + q, a run
of length n makes a stretch of n - q equal pairs: at least ``max(LEAST - q, 2 * q)``, 16
at the least.  So a text in which no 16 words in a row occur twice has no run,
and one sort of the hashes of all 16-grams sets aside nearly all texts.

*Seeds.*  Lags are taken in classes [low, high) of a ratio of three to two, and a
class has k-grams of the overlap that its lags guarantee, k = max(LEAST - high + 1, 2 * low)
words.  Their names are exact: a k-gram is named by the names of two of half its
length.  A k-gram that occurs again within k / 4 words has a period of at most k / 4;
with a lag q below 3 / 4 k that makes a full block of q words periodic (Fine and
Wilf), so q is not the smallest period and the seed is left out.  The others occur
at most three more times within reach of the class's lags, so the occurrence pairs
enumerated are no more than three for each word and class, whatever the text
repeats.

*Extension.*  Pairs are taken by lag and place.  A table says how far each lag is
covered; a pair behind that point lies in a stretch that is known and is
skipped.  Others are extended to both sides along their diagonal.  A stretch whose
smallest period is a proper divisor of its lag is none of its own.

A null or empty text has no words and no runs.  Texts are taken whole, one at a time,
so a task's memory follows its longest text.  Repeated rows give a row each; an
empty table gives none; further columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.arrow import Hashes, buffers, byte_table, grams, send_code, slices, strings, words

#: Words of the shortest run.
LEAST = 24

#: A run holds its period this many times at least.
TIMES = 3

_INSIDE = ~byte_table((0x20, 0x20), (0x09, 0x0D))


def least_overlap(low: int, high: int) -> int:
    """Equal pairs that a run with a period in [low, high) has on its diagonal, at least."""
    return max(LEAST - high + 1, (TIMES - 1) * low)


#: The least overlap of any period; it is that of a third of the shortest run.
SEED = min(max(LEAST - q, (TIMES - 1) * q) for q in range(1, LEAST))


def lag_classes(longest: int) -> list[tuple[int, int]]:
    """[low, high) of lags up to ``longest``: single ones first, then by a ratio of three to two."""
    out, low = [], 1
    while low <= longest:
        high = max(low + 1, min(-(-3 * low // 2), longest + 1))
        out.append((low, high))
        low = high
    return out


class _Names:
    """Numbers of the k-grams of one text, equal for equal k-grams and for no others."""

    def __init__(self, word_ids: np.ndarray):
        self._doubled = [word_ids.astype(np.int64)]

    def of(self, k: int) -> np.ndarray:
        level = k.bit_length() - 1
        while len(self._doubled) <= level:
            last, step = self._doubled[-1], 1 << (len(self._doubled) - 1)
            self._doubled.append(self._pair(last[:-step], last[step:]))
        half = self._doubled[level]
        rest = k - (1 << level)
        return half if not rest else self._pair(half[:-rest], half[rest:])

    @staticmethod
    def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(left):
            return np.zeros(0, np.int64)
        both = left * (int(right.max()) + 1) + right
        return np.unique(both, return_inverse=True)[1].astype(np.int64)


def _occurrence_pairs(names: np.ndarray, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """(places, lags, whether any k-gram repeats) of equal k-grams with a lag in [low, high), by lag and place."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    if not same.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), False
    gap = order[1:] - order[:-1]
    # a gap of at most k / 4 gives the k-gram a period that no lag of the class can be the least multiple of
    # (that belongs to the k-gram, so it holds at all its places)
    periodic = np.zeros(int(names.max()) + 1, bool)
    periodic[names[order[:-1][same & (4 * gap <= k) & (gap < low)]]] = True
    places, lags = [], []
    reach = 1
    open_ = np.flatnonzero(same & ~periodic[names[order[:-1]]])
    while len(open_):
        far = open_ + reach
        inside = far < len(order)
        open_, far = open_[inside], far[inside]
        near = names[order[far]] == names[order[open_]]
        open_, far = open_[near], far[near]
        lag = order[far] - order[open_]
        hit = (lag >= low) & (lag < high)
        places.append(order[open_[hit]])
        lags.append(lag[hit])
        open_ = open_[lag < high - 1]
        reach += 1
    place = np.concatenate(places) if places else np.zeros(0, np.int64)
    lag = np.concatenate(lags) if lags else np.zeros(0, np.int64)
    by = np.lexsort((place, lag))
    return place[by], lag[by], True


def _equal_ahead(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading entries are equal; reads no more than twice as many."""
    step, done = 64, 0
    n = min(len(a), len(b))
    while done < n:
        differ = np.flatnonzero(a[done : min(done + step, n)] != b[done : min(done + step, n)])
        if len(differ):
            return done + int(differ[0])
        done += step
        step *= 2
    return n


def find_runs(word_ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and then period."""
    n = len(word_ids)
    out: list[tuple[int, int, int]] = []
    if n < LEAST:
        return out
    names, covered = _Names(word_ids), {}
    for low, high in lag_classes(n // TIMES):
        k = least_overlap(low, high)
        named = names.of(k)
        places, lags, repeated = _occurrence_pairs(named, k, low, high)
        if not repeated and k == (TIMES - 1) * low:
            break  # longer grams do not repeat either, and later classes have longer ones
        for place, lag in zip(places.tolist(), lags.tolist()):
            if place < covered.get(lag, 0):
                continue
            end = place + _equal_ahead(word_ids[place:], word_ids[place + lag :])
            start = place - _equal_ahead(word_ids[:place][::-1], word_ids[: place + lag][::-1])
            covered[lag] = end
            length = end + lag - start
            if length < max(LEAST, TIMES * lag):
                continue
            # a smaller period of the stretch would divide the lag, and have a run of its own
            if not any(_has_period(word_ids[start : start + length], d) for d in _proper_divisors(lag)):
                out.append((start, length, lag))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _has_period(part: np.ndarray, q: int) -> bool:
    return bool((part[q:] == part[:-q]).all())


def _proper_divisors(q: int) -> list[int]:
    """The divisors q / p for each prime p; any smaller period divides one of them."""
    out, rest, p = [], q, 2
    while p * p <= rest:
        if rest % p == 0:
            out.append(q // p)
            while rest % p == 0:
                rest //= p
        p += 1
    if rest > 1:
        out.append(q // rest)
    return out


def collapsed(runs: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Which of n words stay: those in no run, or only among the first period of their runs."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest exact length / period; ties by start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


_FIELDS = ("n_words long, n_runs long, start long, length long, period long, "
           "runs array<struct<start:long,length:long,period:long>>, collapsed string")
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _may_repeat(hashes: np.ndarray) -> bool:
    """Whether some ``SEED`` words in a row can occur twice; never wrong in saying no."""
    if len(hashes) < LEAST:
        return False
    seeds = np.sort(grams(hashes, SEED))
    return bool((seeds[1:] == seeds[:-1]).any())


def _searched(texts: pa.Array):
    """(words, runs) of each text."""
    data, at = buffers(texts)
    begin, end, first = words(data, at, _INSIDE)
    hashes, raw = Hashes(data).of(begin, end), data.tobytes()
    for row in range(len(texts)):
        parts = raw[at[row] : at[row + 1]].split()
        runs = []
        if _may_repeat(hashes[first[row] : first[row + 1]]):
            runs = find_runs(pa.array(parts, pa.binary()).dictionary_encode().indices.to_numpy())
        yield parts, runs


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_runs, start, length and period of the strongest run, runs (all), collapsed.

    ``collapsed`` is the text without repeats: of each run the first period stays,
    words are joined by one space.
    """
    send_code(docs.sparkSession)

    def task(batches):
        for batch in batches:
            texts, ids = strings(batch.column(1)), batch.column(0)
            for a, b in slices(texts):
                out = []
                for parts, runs in _searched(texts[a:b]):
                    n = len(parts)
                    if runs:
                        parts = [parts[i] for i in np.flatnonzero(collapsed(runs, n)).tolist()]
                    best = strongest(runs) or (None, None, None)
                    listed = [{"start": s, "length": m, "period": q} for s, m, q in runs]
                    out.append((n, len(runs), *best, listed, b" ".join(parts)))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), *(pa.array(c, pa.int64()) for c in columns[:5]),
                     pa.array(columns[5], _RUN), pa.array(columns[6], pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "n_runs", "start", "length", "period", "runs", "collapsed"],
                )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(task, f"doc_id long, {_FIELDS}")
