"""Byte-level BPE by a tree of encoded parts.

A text is cut in halves until a part has at most ``leaf`` characters.  A part
is encoded on its own: the pattern splits it into matches, each of which is
merged by rank.  Two neighbours are joined by encoding again a window around
their border.

The left end of the window is the last match that cannot have seen the border:
a match is decided by at most two characters after it, so one that ends two
characters before the border stands.  From there the pattern runs on, and as
soon as one of its matches ends where the right part has one, all further
matches of the right part stand, since the pattern looks only forward.  The
window begins small and grows until that happens; a window that reaches the end
of the right part is right by itself.  Joining is associative: any tree over a
text gives the same ids.

Decoding joins the bytes of halves up the same kind of tree.

Null texts are empty and have no ids.  Repeated rows give a row each; an empty
table gives none; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.arrow import send_code, strings

#: Characters of a part that is encoded on its own.
LEAF = 8_192

#: Characters of the first window right of a border.
WINDOW = 64

#: How many characters after a match can have decided it.
LOOKAHEAD = 2

#: Tokens whose bytes are joined at once when decoding.
DECODE_LEAF = 65_536


@dataclass(frozen=True)
class Part:
    """A range of the text: where its matches end, and its ids with the number of ids up to each match's end."""

    begin: int
    ends: np.ndarray
    upto: np.ndarray
    ids: np.ndarray

    def cut(self, first: int, last: int) -> "Part":
        """The matches from number ``first`` to before ``last``."""
        start = int(self.upto[first - 1]) if first else 0
        stop = int(self.upto[last - 1]) if last else 0
        begin = int(self.ends[first - 1]) if first else self.begin
        return Part(begin, self.ends[first:last], self.upto[first:last] - start, self.ids[start:stop])


def _concat(parts: list[Part]) -> Part:
    offset, upto = 0, []
    for p in parts:
        upto.append(p.upto + offset)
        offset += len(p.ids)
    return Part(parts[0].begin, np.concatenate([p.ends for p in parts]), np.concatenate(upto),
                np.concatenate([p.ids for p in parts]))


class Codec:
    """Ids of texts by a rank file and a pattern, and texts of ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF, window: int = WINDOW):
        self.leaf, self.window = leaf, window
        self._pattern = regex.compile(pattern)
        self._encoding = tiktoken.Encoding("llm", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._bytes = {rank: token for token, rank in ranks.items()}
        self._size = np.zeros(max(self._bytes, default=0) + 1, np.int64)
        for rank, token in self._bytes.items():
            self._size[rank] = len(token)

    def _ends(self, text: str) -> np.ndarray:
        return np.fromiter((m.end() for m in self._pattern.finditer(text)), np.int64)

    def part(self, text: str, begin: int, end: int) -> Part:
        """A range of the text encoded on its own."""
        own = text[begin:end]
        ids = np.array(self._encoding.encode_ordinary(own), np.int64)
        ends = self._ends(own)
        if own.isascii():
            at = ends
        else:
            code = np.frombuffer(own.encode("utf-32-le", "surrogatepass"), np.uint32)
            at = np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))[ends - 1]
        return Part(begin, ends + begin, np.searchsorted(np.cumsum(self._size[ids]), at) + 1, ids)

    def join(self, text: str, left: Part, right: Part) -> Part:
        """The part of both ranges."""
        if not len(left.ends):
            return right
        if not len(right.ends):
            return left
        border, end = int(left.ends[-1]), int(right.ends[-1])
        stands = int(np.searchsorted(left.ends, border - LOOKAHEAD, "right"))
        begin = int(left.ends[stands - 1]) if stands else left.begin
        reach, common = self.window, np.zeros(0, np.int64)
        while True:
            stop = min(border + reach, end)
            ends = self._ends(text[begin:stop]) + begin
            if stop == end:
                break
            # matches near the window's end may have seen it
            sure = ends[: int(np.searchsorted(ends, stop - LOOKAHEAD, "right"))]
            common = np.flatnonzero((sure >= border) & np.isin(sure, right.ends))
            if len(common):
                break
            reach *= 2
        window = self.part(text, begin, stop)
        if not len(common):  # the window reaches the end of the range
            return _concat([left.cut(0, stands), window])
        last = int(common[0]) + 1
        rest = int(np.searchsorted(right.ends, ends[last - 1])) + 1
        return _concat([left.cut(0, stands), window.cut(0, last), right.cut(rest, len(right.ends))])

    def tree(self, text: str, begin: int, end: int) -> Part:
        if end - begin <= self.leaf:
            return self.part(text, begin, end)
        middle = (begin + end) // 2
        return self.join(text, self.tree(text, begin, middle), self.tree(text, middle, end))

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= self.leaf:  # the tree is one leaf
            return np.array(self._encoding.encode_ordinary(text), np.int64)
        return self.tree(text, 0, len(text)).ids

    def decode(self, ids) -> bytes:
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self._bytes.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@lru_cache(maxsize=2)
def codec(path: str, pattern: str, leaf: int = LEAF, window: int = WINDOW) -> Codec:
    """The codec of a rank file: lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return Codec(ranks, pattern, leaf, window)


def _texts(batch: pa.RecordBatch, column: int, step: int = 64):
    """Rows of a batch in small groups: (first row, texts)."""
    texts = strings(batch.column(column))
    for begin in range(0, len(texts), step):
        yield begin, texts[begin : begin + step].to_pylist()


def _encoded(docs: DataFrame, path: str, pattern: str, leaf: int, kinds: dict) -> DataFrame:
    """doc_id and, for each name, what its function makes of ids and decoded bytes."""

    send_code(docs.sparkSession)
    def task(batches):
        own = codec(path, pattern, leaf)
        for batch in batches:
            for begin, texts in _texts(batch, 1):
                ids = [own.encode(t) for t in texts]
                decoded = [own.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[begin : begin + len(texts)]]
                    + [pa.array(list(map(make, ids, decoded)), kind) for make, _, kind in kinds.values()],
                    ["doc_id", *kinds],
                )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(task, ", ".join(["doc_id long", *(f"{name} {kind}" for name, (_, kind, _) in kinds.items())]))


_IDS = {"ids": (lambda ids, decoded: ids.astype(np.int32), "array<int>", pa.list_(pa.int32()))}

_DECODED = {"decoded": (lambda ids, decoded: decoded, "binary", pa.binary())}

_DIGESTS = {
    "n_tokens": (lambda ids, decoded: len(ids), "long", pa.int64()),
    "ids_sha256": (lambda ids, decoded: hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), "string", pa.string()),
    "decoded_sha256": (lambda ids, decoded: hashlib.sha256(decoded).hexdigest(), "string", pa.string()),
}


def encode_documents(docs: DataFrame, path: str, pattern: str, leaf: int = LEAF) -> DataFrame:
    """doc_id, ids (array<int>) and decoded (binary) of every document."""
    return _encoded(docs, path, pattern, leaf, _IDS | _DECODED)


def encode_documents_with_digests(docs: DataFrame, path: str, pattern: str, leaf: int = LEAF) -> DataFrame:
    """doc_id, ids, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    return _encoded(docs, path, pattern, leaf, _IDS | _DIGESTS)


def digests(docs: DataFrame, path: str, pattern: str, leaf: int = LEAF) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256; ids and bytes stay in the task."""
    return _encoded(docs, path, pattern, leaf, _DIGESTS)
