"""Token counts of texts of any length by overlapping chunks.

A text of up to ``CHUNK`` characters is encoded whole.  A longer one is cut
into chunks that overlap; each is encoded with the place of every token.  Two
chunks are spliced where both have a token border and no token can cross: the
left chunk counts up to there, the right one from there.  If the overlap has no
such border, it is widened, up to the whole of both chunks.  Where both have none
in common, as in scripts without spaces, the text up to the next safe place
is encoded at once; so every character is encoded a bounded number of times.

Which borders are safe is proven from the vocabulary, once: a space is a piece's
first character or follows only spaces in it.  So no piece, and therefore no merge, crosses from
another character to a space, and the two sides of such a place are encoded
apart.  A vocabulary that has a piece with an inner space has no safe borders;
its texts are encoded whole.

Null texts are empty and have no tokens.  Repeated rows give a row each; an
empty table gives none; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.arrow import send_code, slices, strings

#: Characters of a chunk, and by how many it overlaps the next one at first.
CHUNK = 65_536
OVERLAP = 256

#: How a space is written in pieces.
SPACE = "▁"


@dataclass(frozen=True)
class Chunk:
    """Characters begin..end of a text and where its tokens end; the border itself is not one of them."""

    begin: int
    end: int
    ends: np.ndarray  # in characters of the text; bytes of a character end with it


class Counter:
    """Counts the pieces of a sentencepiece model."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        if not 0 < overlap < chunk:
            raise ValueError("the overlap is smaller than a chunk")
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk, overlap
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        plain = [p for i, p in enumerate(pieces) if not self._model.is_byte(i) and not self._model.is_control(i)]
        self.safe = not any(SPACE in p.lstrip(SPACE) for p in plain)
        self.widened = 0

    def count(self, texts: list[str]) -> list[int]:
        """The number of tokens of each whole text."""
        out = [0] * len(texts)
        whole = [i for i, t in enumerate(texts) if len(t) <= self.chunk or not self.safe]
        for i, found in zip(whole, self._model.encode([texts[i] for i in whole], num_threads=1) if whole else ()):
            out[i] = len(found)
        for i in set(range(len(texts))) - set(whole):
            out[i] = self.long(texts[i])
        return out

    def long(self, text: str) -> int:
        """The number of tokens by chunks."""
        left = self.encode(text, 0, min(self.chunk, len(text)))
        # tokens that end after ``done`` are still to be counted; an empty prefix may end at 0
        total, begin, done = 0, 0, -1
        while left.end < len(text):
            overlap, end = self.overlap, min(left.end - self.overlap + self.chunk, len(text))
            while True:
                start = max(left.end - overlap, begin)
                right = self.encode(text, start, end)
                border = self.common(text, left, right)
                if border is not None:
                    total += int(np.count_nonzero((left.ends > done) & (left.ends <= border)))
                    begin = done = border
                    break
                self.widened += 1
                safe = self.last_safe(text, begin, left.end)
                if start == begin or safe is None:  # both chunks in one have no border, either
                    border = self.next_safe(text, left.end)
                    total += self.whole(text, begin, border)
                    if border == len(text):
                        return total
                    begin = done = border
                    right = self.encode(text, begin, min(begin + self.chunk, len(text)))
                    break
                overlap = max(2 * overlap, left.end - safe + 1)
            left = right
        return total + int(np.count_nonzero(left.ends > done))

    def last_safe(self, text: str, begin: int, end: int) -> int | None:
        """The last safe place between two others."""
        at = text.rfind(" ", begin + 1, end)
        while at > begin and text[at - 1] in (" ", SPACE):
            at = text.rfind(" ", begin + 1, at)
        return at if at > begin else None

    def next_safe(self, text: str, at: int) -> int:
        """The first safe place from ``at`` on that more than a space follows, or the end of the text."""
        at = text.find(" ", at)
        while at > 0 and text[at - 1] in (" ", SPACE):
            at = text.find(" ", at + 1)
        return at if 0 < at < len(text) - 1 else len(text)

    def whole(self, text: str, begin: int, end: int) -> int:
        """How many tokens the part has, which lies between safe places."""
        return len(self._model.encode(text[begin + (begin > 0 and text[begin] == " ") : end]))

    def encode(self, text: str, begin: int, end: int) -> Chunk:
        """The chunk's tokens.

        The model puts a space before what it encodes.  A chunk that begins with
        a space leaves it out, so its begin is read as it is inside the text.
        """
        first = begin + (begin > 0 and text[begin] == " ")
        found = self._model.encode(text[first:end], out_type="offset_mapping")["offsets"]
        return Chunk(begin, end, np.array([last for _, last in found], np.int64) + first)

    def common(self, text: str, left: Chunk, right: Chunk) -> int | None:
        """The last safe border in the overlap that both chunks have.

        A border before the right chunk's first safe one may be wrong there, as
        may one after the left chunk's last: only what lies on the other side
        of a safe border is counted, and that no token reaches.
        """
        at = text.rfind(" ", right.begin + 1, left.end)
        while at > right.begin:
            if text[at - 1] not in (" ", SPACE) and at in left.ends and at in right.ends:
                return at
            at = text.rfind(" ", right.begin + 1, at)
        return None


@lru_cache(maxsize=2)
def counter(path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Counter:
    return Counter(path, chunk, overlap)


def token_counts(docs: DataFrame, path: str, limit: int = 4096, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""
    send_code(docs.sparkSession)

    def task(batches):
        own = counter(path, chunk, overlap)
        for batch in batches:
            texts = strings(batch.column(1))
            for a, b in slices(texts, 1 << 18):
                n = np.array(own.count(texts[a:b].to_pylist()), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(2)[a:b], pa.array(n), pa.array(n > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                        F.octet_length(text).cast("long").alias("n_bytes"))
    return plain.mapInArrow(task, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
