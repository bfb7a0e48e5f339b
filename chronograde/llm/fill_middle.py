"""Fill-in-the-middle: documents cut into prefix, middle and suffix at line ends, and put in another order.

Line ends are found without looking at single bytes. The UTF-8 of a batch of texts is viewed as 64-bit words; arithmetic on a
whole word marks its bytes that end a line, the marks of each word are counted, and a running sum of the counts answers two
questions: how many line ends lie before a byte (rank), and where the n-th line end is (select: a search of the sums for
the word, then the mark within the word). The same marks on continuation bytes give lengths in code points.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "7"
#: Shares in per cent: documents that are rearranged, and those of them that start with the suffix.
RATE, SUFFIX_FIRST = 100, 50

_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_HIGH = np.uint64(0x8080808080808080)
_ONES = np.uint64(0x0101010101010101)
_ONE, _EIGHT = np.uint64(1), np.uint64(8)


def words_of(data: np.ndarray) -> np.ndarray:
    """Bytes as little-endian 64-bit words, padded with zeros; at least one whole word of padding."""
    padded = np.zeros((len(data) // 8 + 2) * 8, np.uint8)
    padded[:len(data)] = data
    return padded.view("<u8")


def equal_bytes(words: np.ndarray, byte: int) -> np.ndarray:
    """High bit of every byte that equals ``byte``. The sum cannot carry into the next byte, so no other byte is marked."""
    other = words ^ (_ONES * np.uint64(byte))
    return ~(((other & _LOW7) + _LOW7) | other) & _HIGH


def continuation_bytes(words: np.ndarray) -> np.ndarray:
    """High bit of every byte of the form 10xxxxxx, which continues a code point."""
    return words & ~(words << _ONE) & _HIGH


class Marks:
    """Rank and select over marked bytes."""

    def __init__(self, marks: np.ndarray) -> None:
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before the positions ``at``."""
        word = at >> 3
        below = (_ONE << (_EIGHT * (at & 7).astype(np.uint64))) - _ONE
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, nth: np.ndarray) -> np.ndarray:
        """Position of the marked byte with ``nth`` marks before it."""
        word = np.searchsorted(self.before, nth, side="right") - 1
        left, rest = self.marks[word], nth - self.before[word]
        for passed in range(7):
            left = np.where(rest > passed, left & (left - _ONE), left)  # clears the lowest mark
        lowest = left & (~left + _ONE)
        return word * 8 + (np.bitwise_count(lowest - _ONE) >> 3).astype(np.int64)


def cut(data: np.ndarray, offsets: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lines, byte positions of both cuts, and code points of prefix and middle for each text of a batch.

    Text ``i`` is ``data[offsets[i]:offsets[i + 1]]``; the cuts come after the smaller and the larger of ``h1`` and
    ``h2`` modulo the number of lines plus one. What follows the last line end is a line too, unless empty.
    """
    words = words_of(data)
    ends, inner = Marks(equal_bytes(words, 10)), Marks(continuation_bytes(words))
    start, stop = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    first = ends.rank(start)
    whole = ends.rank(stop) - first
    last = data[np.maximum(stop - 1, 0)] if len(data) else np.zeros(len(start), np.uint8)
    n = whole + ((stop > start) & (last != 10))
    h1, h2 = h1 % (n + 1), h2 % (n + 1)

    def position(units: np.ndarray) -> np.ndarray:
        inside = (units > 0) & (units <= whole)
        at = np.where(units == 0, start, stop)
        at[inside] = ends.select((first + units - 1)[inside]) + 1
        return at

    a, b = position(np.minimum(h1, h2)), position(np.maximum(h1, h2))
    points = [p - inner.rank(p) for p in (start, a, b)]
    return n, a, b, points[1] - points[0], points[2] - points[1]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 of a string array and where each text starts in it."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0]:offsets[-1]], offsets - offsets[0]


def _rearranged(batch: pa.RecordBatch, rate: int, suffix_first: int) -> pa.RecordBatch:
    texts = pc.fill_null(batch.column(1), "")
    data, offsets = _bytes_of(texts)
    h = [batch.column(i).to_numpy() for i in (2, 3, 4, 5)]
    n, a, b, prefix, middle = cut(data, offsets, h[0], h[1])
    marked = pc.match_substring_regex(texts, f"{PREFIX}|{SUFFIX}|{MIDDLE}").to_numpy(zero_copy_only=False)
    plain = (offsets[1:] == offsets[:-1]) | marked | (h[2] % 100 >= rate)
    form = np.where(plain, "plain", np.where(h[3] % 100 < suffix_first, "spm", "psm"))
    view, out = memoryview(data), []
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    for f, i, j, k, e in zip(form.tolist(), offsets[:-1].tolist(), a.tolist(), b.tolist(), offsets[1:].tolist()):
        if f == "plain":
            out.append(bytes(view[i:e]))
        elif f == "psm":
            out.append(b"".join((p, view[i:j], s, view[k:e], m, view[j:k])))
        else:
            out.append(b"".join((s, view[k:e], p, view[i:j], m, view[j:k])))
    chars = [pa.array(x, pa.int64(), mask=plain) for x in (prefix, middle)]
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()), *chars, pa.array(out, pa.binary()).view(pa.string())],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def transform(docs: DataFrame, seed: str = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``doc_id``, ``n`` (lines), ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of every row, one for one.

    The cuts hang on ``seed`` and ``doc_id`` alone, so a repeated row comes back alike and a lost task gives the same rows
    again; a null id counts as an empty one. Null and empty texts, texts that hold one of the markers, and those beyond
    ``rate`` per cent stay as they are (form ``plain``, null lengths). An empty table gives an empty result; further
    columns are ignored. A batch is held whole with its words and marks, so memory follows the batch and its longest text.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    parts = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                yield _rearranged(batch.slice(at, 1024), rate, suffix_first)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *parts).mapInArrow(
        run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text behind an output. Markers have no end that is also a beginning, and no cut text holds one, so each occurs once."""
    out, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    body = F.substring(out, 4, 2**31 - 1)
    before, after = lambda c, mark: F.substring_index(c, mark, 1), lambda c, mark: F.substring_index(c, mark, -1)
    psm = F.concat(before(body, SUFFIX), after(body, MIDDLE), before(after(body, SUFFIX), MIDDLE))
    spm = F.concat(before(after(body, PREFIX), MIDDLE), after(body, MIDDLE), before(body, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(out)


def digests(cut_docs: DataFrame) -> DataFrame:
    """SHA-256 of the output and of the text rebuilt from it, in place of the output."""
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return cut_docs.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                           sha(restored()).alias("restored_sha256"))
