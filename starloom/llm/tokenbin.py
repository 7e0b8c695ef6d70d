"""Token-id files with directly addressable codes.

An id is split into chunks of ``CHUNK_BITS`` bits, lowest first.  Level 0 has
the first chunk of every id, level 1 the second chunk of those that have one,
and so on.  A bitmap per level says which ids continue, and a rank directory
says how many did before each 512 bits.  An id is read by following its place
from level to level: no other id is decoded, whatever its position.

A segment holds whole documents in ascending order of doc_id:

    4 bytes  magic "DAC1"      u32 levels      u32 chunk bits     u64 ids      u64 documents
    documents: i64 doc_id, u64 position of the first id          (documents + 1 positions)
    flags: one byte a document, 1 if the doc_id is missing
    per level: u64 chunks, chunks (one byte each), bitmap words (u64, lowest bit first), directory (u32 each)

All numbers are little-endian.  Segments travel as rows (part, number, ids,
content): the parts are ranges of doc_id in order, the segments of a part are
numbered.  A segment is closed at ``SEGMENT_IDS`` ids; a document is never cut.

Null texts are empty: their only id is the end id.  A missing doc_id sorts
first.  Repeated rows are documents of their own; documents of one id, or without
one, are in order of a hash of their texts, by which many of them are dealt to several parts.  An empty
table gives no segment; further columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.arrow import send_code, strings
from starloom.session import stage_table

MAGIC = b"DAC1"
CHUNK_BITS = 8
RANK_BITS = 512
SEGMENT_IDS = 1 << 20

#: Words whose ids a task remembers; beyond it, it begins anew.
MEMORY = 800_000

_HEAD = struct.Struct("<4sIIQQ")

# --- codes ------------------------------------------------------------------------------------------------------


def _levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap words, directory) of each level."""
    out, rest = [], ids.astype(np.uint64)
    while True:
        chunk = (rest & np.uint64((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        more = rest >> np.uint64(CHUNK_BITS)
        goes_on = more > 0
        words = -(-len(rest) // RANK_BITS) * (RANK_BITS // 64)
        bits = np.zeros(words * 64, np.uint8)
        bits[: len(rest)] = goes_on
        bitmap = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(bitmap).reshape(-1, RANK_BITS // 64).sum(1)
        directory = np.concatenate(([0], np.cumsum(counts)))[:-1].astype("<u4")
        out.append((chunk, bitmap, directory))
        if not goes_on.any():
            return out
        rest = more[goes_on]


def encode_segment(doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    """The bytes of a segment; ``sizes`` are the documents' numbers of ids."""
    if ids.size and (ids.min() < 0 or ids.max() >= 1 << 63):
        raise ValueError("ids are not negative and have at most 63 bits")
    levels = _levels(ids)
    parts = [
        _HEAD.pack(MAGIC, len(levels), CHUNK_BITS, len(ids), len(doc_ids)),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
        np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))).astype("<u8").tobytes(),
        np.array([x is None for x in doc_ids], np.uint8).tobytes(),
    ]
    for chunk, bitmap, directory in levels:
        parts += [struct.pack("<Q", len(chunk)), chunk.tobytes(), bitmap.tobytes(), directory.tobytes()]
    return b"".join(parts)


class Segment:
    """A segment's documents and ids, read in place."""

    def __init__(self, content: bytes):
        if len(content) < _HEAD.size:
            raise ValueError("not a segment: too short")
        magic, levels, bits, n, documents = _HEAD.unpack_from(content)
        if magic != MAGIC or bits != CHUNK_BITS:
            raise ValueError("not a segment of this format")
        at = _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(content, kind, count, at)
            at += found.nbytes
            return found

        doc_ids, self.starts, missing = take("<i8", documents), take("<u8", documents + 1), take("u1", documents)
        self.doc_ids = [None if m else int(x) for x, m in zip(doc_ids, missing)]
        self.levels = []
        for _ in range(levels):
            size = int(take("<u8", 1)[0])
            blocks = -(-size // RANK_BITS)
            self.levels.append((take("u1", size), take("<u8", blocks * (RANK_BITS // 64)), take("<u4", blocks)))
        if at != len(content) or len(self.levels[0][0]) != n or int(self.starts[-1]) != n:
            raise ValueError("the segment's lengths disagree")

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, place: int) -> int:
        """One id, by its position alone."""
        if not 0 <= place < len(self):
            raise IndexError(place)
        value = 0
        for k, (chunk, bitmap, directory) in enumerate(self.levels):
            value |= int(chunk[place]) << CHUNK_BITS * k
            word, bit = divmod(place, 64)
            if not int(bitmap[word]) >> bit & 1:
                break
            block = place // RANK_BITS
            before = bitmap[block * (RANK_BITS // 64) : word]
            low = int(bitmap[word]) & ((1 << bit) - 1)
            place = int(directory[block]) + int(np.bitwise_count(before).sum()) + low.bit_count()
        return value

    def ids(self) -> np.ndarray:
        """All ids."""
        value = None
        for k, (chunk, bitmap, _) in reversed(list(enumerate(self.levels))):
            own = chunk.astype(np.uint64)
            if value is not None:
                goes_on = np.unpackbits(bitmap.view(np.uint8), count=len(chunk), bitorder="little").astype(bool)
                own[goes_on] |= value << np.uint64(CHUNK_BITS)
            value = own
        return value


# --- ids of texts -----------------------------------------------------------------------------------------------

#: Python's white space that is none to the tokenizer's pattern.
_NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")

_CUT = re.compile(r"[ \t\n\r]+")


def cut(text: str) -> list[str]:
    """A text's words, cut at characters that are white space to the tokenizer's pattern."""
    if any(c in text for c in _NOT_SPACE):
        return _CUT.split(text)
    return text.split()

#: Characters that may be cut off a word's end: never part of a letter run, nor of a special token.
TAIL = ".,;:!?%*#$&@()[]{}+-=/^_~"


def _byte_characters() -> dict[int, int]:
    """How byte-level tokenizers write each byte: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in plain]
    return {x: x for x in plain} | {x: 256 + i for i, x in enumerate(rest)}


_BYTE_CHARACTERS = _byte_characters()


def _simple(word: str) -> bool:
    """Letters up to U+017F, which the tokenizer only lower-cases and takes as one piece.

    All are composed already, and all but one have one character in lower case.
    """
    return word.isalpha() and (word.isascii() or (max(word) < "\u0180" and "\u0130" not in word))


class Words:
    """Ids by a word-level tokenizer file, remembering those of words.

    Only for tokenizers that turn white space into nothing but borders, so that
    a text's ids are those of its words one after the other; ``from_file``
    checks that the file is such a one.  A word of letters with a tail of
    punctuation is looked up as these two: the pattern always parts them.
    Letters are one piece, so they go to the tokenizer's model at once; any other
    word goes the whole way.
    """

    def __init__(self, tokenizer, memory: int = MEMORY):
        self._tokenizer, self._memory = tokenizer, memory
        self._model = tokenizer.model
        self._known: dict[str, bytes] = {}

    @classmethod
    def from_file(cls, path: str, memory: int = MEMORY) -> "Words":
        import json

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        split, level = ((said.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}])[:2]
        special = [x["content"] for x in said["added_tokens"]]
        if not (
            split.get("type") == "Split" and split.get("invert") and split.get("behavior") == "Removed"
            and split["pattern"]["Regex"].endswith("[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")
            and level.get("type") == "ByteLevel" and not level["add_prefix_space"] and not level["use_regex"]
            and [x["type"] for x in said["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
            and said.get("truncation") is None
            and not any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in said["added_tokens"])
            and not any(_CUT.search(x) or set(TAIL) & set(x) for x in special)
        ):
            raise ValueError(f"{path}: white space is not dropped by this tokenizer")
        return cls(Tokenizer.from_file(path), memory)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        split = [cut(t) for t in texts]
        new = set(chain.from_iterable(split)).difference(self._known)
        if new:
            if len(self._known) + len(new) > self._memory:
                self._known.clear()
                new = set(chain.from_iterable(split))
            self._learn(new)
        find = self._known.__getitem__
        return [np.frombuffer(b"".join(map(find, words)), "<u4") for words in split]

    def _learn(self, new: set[str]) -> None:
        known, tokenize, others = self._known, self._model.tokenize, []
        known[""] = b""
        for word in new:
            base = word.rstrip(TAIL)
            if not _simple(base):
                others.append(word)
                continue
            tail = word[len(base) :]
            if tail not in known:
                self._whole([tail])
            base = base.lower()
            if base not in known:
                written = base if base.isascii() else base.encode().decode("latin-1").translate(_BYTE_CHARACTERS)
                known[base] = _packed([t.id for t in tokenize(written)])
            if word is not base:
                known[word] = known[base] + known[tail]
        for begin in range(0, len(others), 4096):
            self._whole(others[begin : begin + 4096])

    def _whole(self, words: list[str]) -> None:
        for word, found in zip(words, self._tokenizer.encode_batch_fast(words, add_special_tokens=False)):
            self._known[word] = _packed(found.ids)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    return Words.from_file(path)


# --- tables -----------------------------------------------------------------------------------------------------


def write_segments(docs: DataFrame, path: str, end_id: int, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """(part, number, ids, content) of all documents, with ``end_id`` after each."""
    send_code(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # documents of one id differ by text, or it does not matter where they are
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64(F.coalesce("text", F.lit(""))).asc()]
    ordered = plain.repartitionByRange(*order).sortWithinPartitions(*order, "text")

    def task(batches):
        words, part, number = words_of(path), TaskContext.get().partitionId(), 0
        doc_ids, sizes, found, total = [], [], [], 0
        end = np.array([end_id], np.uint32)

        def segment():
            ids = np.concatenate(found)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.array([encode_segment(doc_ids, sizes, ids)], pa.binary())],
                ["part", "number", "ids", "content"])

        for batch in batches:
            names, texts = batch.column(0), strings(batch.column(1))
            for begin in range(0, len(texts), 64):
                for name, ids in zip(names[begin : begin + 64].to_pylist(), words.encode(texts[begin : begin + 64].to_pylist())):
                    doc_ids.append(name)
                    sizes.append(len(ids) + 1)
                    found += [ids, end]
                    total += len(ids) + 1
                    if total >= segment_ids:
                        yield segment()
                        doc_ids, sizes, found, total, number = [], [], [], 0, number + 1
        if doc_ids:
            yield segment()

    return ordered.mapInArrow(task, "part int, number int, ids long, content binary")


def read_segments(segments: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of stored segments."""
    send_code(segments.sparkSession)

    def task(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                segment = Segment(batch.column(2)[i].as_py())
                ids = segment.ids().astype("<u4")
                starts = segment.starts.astype(np.int64)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:])]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[i].as_py()] * n, pa.int32()), pa.array([batch.column(1)[i].as_py()] * n, pa.int32()),
                     pa.array(segment.doc_ids, pa.int64()), pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(crc, pa.int64())],
                    ["part", "number", "doc_id", "place", "n_tokens", "ids_crc32"])

    # sums by part first: one task only ever sees a row per part
    parts = segments.groupBy("part").agg(F.sum("ids").alias("total"))
    before = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("part_start"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        segments.select("part", "number", F.coalesce(F.sum("ids").over(inside), F.lit(0)).alias("part_place"))
        .join(parts, "part").select("part", "number", (F.col("part_start") + F.col("part_place")).alias("segment_start"))
    )
    read = segments.select("part", "number", "content").mapInArrow(
        task, "part int, number int, doc_id long, place long, n_tokens long, ids_crc32 long")
    return read.join(starts, ["part", "number"]).select(
        "doc_id", (F.col("segment_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Write the segments of all documents and describe what is read back from them."""
    return read_segments(stage_table(write_segments(docs, path, end_id), "token_segments"))
