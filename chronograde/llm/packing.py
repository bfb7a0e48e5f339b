"""Packing of token ids into fixed-length sequences by best fit decreasing.

Documents are encoded and cut into pieces of at most the sequence length; the pieces of a document carry its id and a
number, so nothing is lost. Pieces are dealt into shards of bounded size by a hash, and each shard is packed from
the longest piece to the shortest: a segment tree over remaining capacities gives the fullest open sequence that
still has room. A shard is all that a task holds.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 2048
#: Tokens of a shard, about; the size of what is packed together and of what a task holds at once.
SHARD_TOKENS = 2_000_000
_encoders: dict[tuple[str, str], tiktoken.Encoding] = {}


def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    if (path, pattern) not in _encoders:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path, pattern] = tiktoken.Encoding("packed", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path, pattern]


class CapacityTree:
    """Open sequences by remaining capacity; finds the smallest capacity of at least a size in log time."""

    def __init__(self, length: int) -> None:
        self.width = 1 << max(1, length.bit_length())
        self.count = [0] * (2 * self.width)
        self.open: list[list[int]] = [[] for _ in range(length + 1)]

    def _add(self, capacity: int, by: int) -> None:
        i = capacity + self.width
        while i:
            self.count[i] += by
            i >>= 1

    def push(self, capacity: int, sequence: int) -> None:
        self.open[capacity].append(sequence)
        self._add(capacity, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """(capacity, sequence) of the tightest fit, the latest opened among equals, taken out of the tree."""
        i = size + self.width
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.width:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        capacity = i - self.width
        self._add(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit(sizes: Iterable[int], length: int) -> list[list[int]]:
    """Positions of the sizes (longest first) in each sequence, in the order in which sequences were opened."""
    tree, out = CapacityTree(length), []
    for k, size in enumerate(sizes):
        found = tree.take(size)
        if found is None:
            found = length, len(out)
            out.append([])
        out[found[1]].append(k)
        if found[0] > size:
            tree.push(found[0] - size, found[1])
    return out


def pieces(docs: DataFrame, path: str, pattern: str, length: int, shards: int) -> DataFrame:
    """``shard``, ``doc_id``, ``piece``, ``size`` and ``ids`` (32-bit little-endian) of every piece of every document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path, pattern).encode_ordinary
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                d, p, s, b = [], [], [], []
                for doc, text in zip(batch.column(0).slice(at, 128).to_pylist(), batch.column(1).slice(at, 128).to_pylist()):
                    ids = np.array(encode(text or ""), "<u4")
                    for k, cut in enumerate(range(0, len(ids), length)):
                        part = ids[cut:cut + length]
                        d.append(doc), p.append(k), s.append(len(part)), b.append(part.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(p, pa.int32()), pa.array(s, pa.int32()), pa.array(b, pa.binary())],
                                                 names=["doc_id", "piece", "size", "ids"])

    cut = docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, piece int, size int, ids binary")
    return cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids"), F.lit(shards)))


def pack(docs: DataFrame, path: str, pattern: str, length: int = LENGTH, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row for each sequence: its ids, where segments begin and end, and whose they are.

    ``input_ids`` and ``position_ids`` are ``length`` 32-bit little-endian integers, padded with zeros behind the
    last segment; ``cu_seqlens`` are the segments' cumulative lengths from 0; positions restart at every segment. ``doc_ids``
    and ``pieces`` name the segments. Null, empty and tokenless texts have no piece. Null ids are kept as null.
    Repeated rows are packed as often as they occur; further columns are ignored.
    """
    total = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    shards = max(1, -(-total // (2 * shard_tokens)))  # about two bytes a token; the table alone decides, never the cluster
    dealt = pieces(docs, path, pattern, length, shards).repartition(shards, "shard") \
        .sortWithinPartitions("shard", F.desc("size"), "doc_id", "piece", "ids")

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(k).to_pylist() for k in range(5)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, group in groupby(rows(batches), key=lambda r: r[4]):
            held = list(group)
            packed = best_fit([r[2] for r in held], length)
            for at in range(0, len(packed), 64):
                yield _sequences(shard, at, packed[at:at + 64], held, length)

    return dealt.select("doc_id", "piece", "size", "ids", "shard").mapInArrow(
        run, "shard bigint, sequence int, n_segments int, n_tokens int, doc_ids array<bigint>, pieces array<int>, "
             "cu_seqlens array<int>, input_ids binary, position_ids binary")


def _sequences(shard: int, first: int, packed: list[list[int]], held: list[tuple], length: int) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in range(9)]
    for k, members in enumerate(packed):
        sizes = [held[m][2] for m in members]
        ends = np.cumsum([0, *sizes])
        place = np.zeros(length, "<u4")
        for a, n in zip(ends, sizes):
            place[a:a + n] = np.arange(n)
        ids = b"".join(held[m][3] for m in members)
        row = (shard, first + k, len(members), int(ends[-1]), [held[m][0] for m in members], [held[m][1] for m in members],
               ends.tolist(), ids.ljust(4 * length, b"\0"), place.tobytes())
        for column, value in zip(columns, row):
            column.append(value)
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    names = ["shard", "sequence", "n_segments", "n_tokens", "doc_ids", "pieces", "cu_seqlens", "input_ids", "position_ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)
