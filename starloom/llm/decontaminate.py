"""Benchmark decontamination by winnowing.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became a-z.  A
window is ten consecutive words of a benchmark item; an item of fewer words,
but not none, is one window.  A document word inside any occurrence of a window
is hit.

Of every six consecutive 5-word hashes, documents and items keep the smallest
(the last one of equals).  Ten shared words contain six such hashes on both
sides, so at least one kept hash is shared: no window is missed.  A shared hash
is extended to the windows around it, which are compared word by word.  Windows
of short items are looked up by the hash of all their words.

The benchmark's kept hashes and windows are broadcast if its texts are smaller
than ``index_bytes``.  Beyond that, kept hashes are joined by shuffle, and the
windows around the shared ones are joined by their text.

Null texts, empty texts and texts without words have no words and no hits.
Repeated documents give a row each.  Repeated items count once; an item without
an id marks words, but is no item to list.  An empty benchmark hits nothing.
Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.arrow import LOWER, WORD_BYTES, among, buffers, grams, Hashes, send_code, slices, strings, words
from starloom.session import stage_table

WINDOW = 10
GRAM = 5
KEPT_OF = WINDOW - GRAM + 1

#: Bytes of benchmark texts up to which the index is broadcast; it takes about 75 bytes for each of them.
INDEX_BYTES = 5 << 20

RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


class _Words:
    """The words of some texts, with a hash each."""

    def __init__(self, texts: pa.Array):
        data, at = buffers(texts)
        self.lower = LOWER[data]
        self.begin, self.end, self.first = words(self.lower, at, WORD_BYTES)
        self.hashes = Hashes(self.lower).of(self.begin, self.end)
        self.bytes = self.lower.tobytes()

    def last(self) -> np.ndarray:
        """For each word, the end of its text's words."""
        return np.repeat(self.first[1:], np.diff(self.first))

    def kept(self) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) that winnowing keeps."""
        hashes = grams(self.hashes, GRAM)
        n = len(self.hashes) - WINDOW + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        begin = np.flatnonzero(np.arange(n) + WINDOW <= self.last()[:n])
        best, place = hashes[begin], begin.copy()
        for j in range(1, KEPT_OF):
            other = hashes[begin + j]
            lower = other <= best
            best = np.where(lower, other, best)
            place = np.where(lower, begin + j, place)
        kept = np.unique(place)
        return kept, hashes[kept]

    def short(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of all runs of ``length`` words."""
        n = len(self.hashes) - length + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        begin = np.flatnonzero(np.arange(n) + length <= self.last()[:n])
        return begin, grams(self.hashes, length)[begin]

    def text(self, begin: int, length: int) -> bytes:
        return b" ".join(
            self.bytes[a:b]
            for a, b in zip(self.begin[begin : begin + length].tolist(), self.end[begin : begin + length].tolist())
        )

    def row_of(self, word: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, word, "right") - 1

    def around(self, kept: np.ndarray) -> np.ndarray:
        """Where the windows begin that contain a kept hash."""
        if not len(kept):
            return kept
        row = self.row_of(kept)
        low = np.maximum(kept - (KEPT_OF - 1), self.first[row])
        high = np.minimum(kept, self.first[row + 1] - WINDOW)
        spread = low[:, None] + np.arange(KEPT_OF)
        return np.unique(spread[spread <= high[:, None]])


class Index:
    """Kept hashes and windows of the benchmark."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        sets: dict[bytes, set] = {}
        kept, short = [np.zeros(0, np.uint64)], {}
        for item, text in items:
            w = _Words(strings(pa.array([text], pa.string())))
            n = len(w.begin)
            if n >= WINDOW:
                kept.append(w.kept()[1])
            elif n:
                short.setdefault(n, []).append(w.short(n)[1])
            for begin in range(n - WINDOW + 1) if n >= WINDOW else range(bool(n)):
                found = sets.setdefault(w.text(begin, min(n, WINDOW)), set())
                if item is not None:
                    found.add(item)
        self.kept = np.unique(np.concatenate(kept))
        self.short = {n: np.unique(np.concatenate(h)) for n, h in short.items()}
        groups: dict[frozenset, int] = {}
        self.windows = {text: groups.setdefault(frozenset(found), len(groups)) for text, found in sets.items()}
        self.groups = list(groups)

    def hits(self, w: _Words) -> Iterator[tuple[int, int, int]]:
        """(first word, words, group of items) of every occurrence of a window."""
        kept, hashes = w.kept()
        found = [(int(begin), WINDOW) for begin in w.around(kept[among(hashes, self.kept)])]
        for length, known in self.short.items():
            begin, hashes = w.short(length)
            found += [(int(x), length) for x in begin[among(hashes, known)]]
        for begin, length in found:
            group = self.windows.get(w.text(begin, length))
            if group is not None:
                yield begin, length, group


def items_digest(items) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def _found(texts: pa.Array, index: Index) -> tuple[np.ndarray, np.ndarray, list[set]]:
    """(words, hit words, items) of each text."""
    w = _Words(texts)
    mark = np.zeros(len(w.begin) + 1, np.int64)
    items: list[set] = [set() for _ in range(len(texts))]
    groups: list[set] = [set() for _ in range(len(texts))]
    for begin, length, group in index.hits(w):
        mark[begin] += 1
        mark[begin + length] -= 1
        groups[int(w.row_of(np.array([begin]))[0])].add(group)
    for row, found in enumerate(groups):
        for group in found:
            items[row] |= index.groups[group]
    hit = np.concatenate(([0], np.cumsum(np.cumsum(mark[:-1]) > 0)))
    return np.diff(w.first), hit[w.first[1:]] - hit[w.first[:-1]], items


def _small_index(benchmark: DataFrame, index_bytes: int) -> Index | None:
    """The index, if the benchmark's texts have at most ``index_bytes``."""
    size = benchmark.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    if (size[0] or 0) + 64 * size[1] > index_bytes:
        return None
    return Index([(r[0], r[1]) for r in benchmark.select("item_id", "text").collect()])


def contamination(docs: DataFrame, benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """Words, hit words and items found of every document; see the module for the rules."""
    send_code(docs.sparkSession)
    index = _small_index(benchmark, index_bytes)
    if index is None:
        return _by_shuffle(docs, benchmark)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def task(batches):
        for batch in batches:
            ids, texts = batch.column(0), strings(batch.column(1))
            for a, b in slices(texts):
                n_words, n_hit, items = _found(texts[a:b], shared.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[a:b],
                        pa.array(n_words, pa.int64()),
                        pa.array(n_hit, pa.int64()),
                        pa.array([len(x) for x in items], pa.int64()),
                        pa.array([items_digest(x) for x in items], pa.string()),
                        pa.array(n_hit > 0),
                    ],
                    ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(task, RESULT)


def clean_documents(docs: DataFrame, benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The documents without a hit word, with all their columns."""
    send_code(docs.sparkSession)
    index = _small_index(benchmark, index_bytes)
    if index is None:
        bad = _by_shuffle(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("_llm_id")).distinct()
        return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_llm_id"]), "left_anti")
    shared = docs.sparkSession.sparkContext.broadcast(index)
    column = docs.columns.index("text")

    def task(batches):
        for batch in batches:
            texts = strings(batch.column(column))
            for a, b in slices(texts):
                _, n_hit, _ = _found(texts[a:b], shared.value)
                yield batch.slice(a, b - a).filter(pa.array(n_hit == 0))

    return docs.mapInArrow(task, docs.schema)


def _spots(lengths: list[int]):
    """Task: the kept hashes of texts and those of their short runs, and where they are; no text."""

    def task(batches):
        for batch in batches:
            key, texts = batch.column(0), strings(batch.column(1))
            for a, b in slices(texts, 1 << 18):
                w = _Words(texts[a:b])
                for at, hashes, n in [(*w.kept(), WINDOW), *((*w.short(n), n) for n in lengths)]:
                    for c in range(0, len(at), 100_000):
                        place = at[c : c + 100_000]
                        row = w.row_of(place)
                        yield pa.RecordBatch.from_arrays(
                            [
                                key.take(pa.array(row + a)),
                                pa.array(hashes[c : c + 100_000].view(np.int64)),
                                pa.array(np.full(len(place), n, np.int64)),
                                pa.array(place - w.first[row]),
                            ],
                            ["key", "hash", "n", "place"],
                        )

    return task


def _windows(batches):
    """Task: the windows around the spots of each text, and where they begin."""
    for batch in batches:
        key, texts, spots = batch.column(0), strings(batch.column(1)), batch.column(2)
        for a, b in slices(texts, 1 << 18):
            w = _Words(texts[a:b])
            for row, found in enumerate(spots[a:b].to_pylist()):
                first, end, known = int(w.first[row]), int(w.first[row + 1]), set()
                for spot in found:
                    n, x = spot["n"], first + spot["place"]
                    if n < WINDOW:
                        known.add((x, n))
                    else:
                        known.update((y, n) for y in range(max(x - KEPT_OF + 1, first), min(x, end - WINDOW) + 1))
                windows = sorted(known)
                for c in range(0, len(windows), 10_000):
                    part = windows[c : c + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key[a + row].as_py()] * len(part), pa.string()),
                            pa.array([n for _, n in part], pa.int64()),
                            pa.array([x - first for x, _ in part], pa.int64()),
                            pa.array([w.text(x, n).decode("utf-8", "replace") for x, n in part], pa.string()),
                        ],
                        ["key", "n", "begin", "window"],
                    )


_SPOT, _WINDOW = "key string, hash long, n long, place long", "key string, n long, begin long, window string"


def _windows_at(texts: DataFrame, spots: DataFrame) -> DataFrame:
    """(key, n, begin, window) of the texts (key, text) around their spots (key, n, place)."""
    places = spots.groupBy("key").agg(F.collect_set(F.struct("n", "place")).alias("spots"))
    return texts.join(places, "key").select("key", "text", "spots").mapInArrow(_windows, _WINDOW)


def _by_shuffle(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The same result for a benchmark of any size.

    Hashes and places of all documents meet the benchmark's hashes first; only documents with a
    hash in common then move with their text, and windows are cut around the places found.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = plain.select(
        F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.sha2("text", 256)).alias("key"),
        "doc_id", "text",
    )
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    n_words = F.size(F.regexp_extract_all(F.lower("text"), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0)))
    lengths = [
        r[0]
        for r in items.where("text IS NOT NULL").select(n_words.alias("n")).where(f"n BETWEEN 1 AND {WINDOW - 1}")
        .distinct().collect()
    ]
    # short runs only of items that are no longer, so an item's own windows are told by length
    item_texts = stage_table(
        items.where("text IS NOT NULL").withColumn("size", n_words)
        .select(F.concat_ws(":", "size", F.xxhash64("text"), F.sha2("item", 256)).alias("key"), "item", "text").distinct(),
        "benchmark_items",
    )
    own = F.split("key", ":")[0].cast("int")
    item_spots = stage_table(
        item_texts.select("key", "text").mapInArrow(_spots(lengths), _SPOT)
        .where(F.when(own < WINDOW, F.col("n") == own).otherwise(F.col("n") == WINDOW)),
        "benchmark_spots",
    )
    windows = (
        _windows_at(item_texts.select("key", "text"), item_spots.select("key", "n", "place"))
        .join(item_texts.select("key", "item"), "key").groupBy("window")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    spots = keyed.select("key", "text").mapInArrow(_spots(lengths), _SPOT).join(
        item_spots.select("hash", "n").distinct(), ["hash", "n"], "left_semi")
    found = (
        _windows_at(keyed.select("key", "text").distinct(), spots.select("key", "n", "place")).join(windows, "window")
    )
    words_hit = (
        found.select("key", F.explode(F.sequence("begin", F.col("begin") + F.col("n") - 1)).alias("word"))
        .distinct().groupBy("key").agg(F.count("*").alias("n_hit"))
    )
    items_hit = (
        found.select("key", "items").distinct().select("key", F.explode("items").alias("item")).distinct()
        .groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    none = F.coalesce("items", F.array().cast("array<string>"))
    return (
        keyed.select("key", "doc_id", F.when(F.col("text").isNull(), 0).otherwise(n_words).cast("long").alias("n_words"))
        .join(words_hit, "key", "left").join(items_hit, "key", "left")
        .select(
            "doc_id", "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(none).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", none), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )
