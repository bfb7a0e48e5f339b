"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into blocks of ``BLOCK`` words; a passage is a run of blocks. Passages are TF-IDF vectors over hashed
words. A randomised SVD of corpus and benchmark passages gives a latent space: tasks multiply their passages with a
random matrix, the products are added up, and an orthogonal basis of the sum spans the leading directions. In that
space, scaled by the singular values, every passage of every document is compared with every item by cosine.
Candidates are verified on the words themselves: longest common subsequence against the item, and where that leaves
a doubt, half of the item's rarest words, which hold its answer, must be there.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronograde.llm.common import release, stage

FEATURES = 1 << 14
RANK = 64
BLOCK = 20
COSINE = 0.45
#: Share of an item that a passage must hold in order: enough by itself, or with half of the rarest words.
SURE = 0.7
LCS = 0.5
ANSWER = 0.5
#: Without effect: the latent space is fitted on every document. The name stays because callers set it.
SAMPLE_DOCS = 8_192
#: Items compared at once; more are searched for in further passes, which bounds what is broadcast.
ITEM_BLOCK = 4_096
#: Words of a long text handled at once, whole blocks: block ``n`` of a text starts at word ``n * BLOCK``.
CHUNK = BLOCK * 410
#: Words added up at once when the space is fitted; the more, the fewer times a feature's row is touched.
FIT_RUN = 4 * CHUNK
SEED = 7
#: Code points hashed at once; a longer word is hashed whole.
PIECE = 1 << 16
_WORDS = re.compile(r"[^\W_]+")
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


@cache
def _letters() -> np.ndarray:
    """Whether a code point belongs to words."""
    out = np.zeros(0x110000, bool)
    for m in _WORDS.finditer("".join(map(chr, range(len(out))))):
        out[m.start():m.end()] = True
    return out


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``2 ** bits`` powers of an odd number and of its inverse, modulo 2 ** 64."""
    size = 1 << bits
    both = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        both.append(np.cumprod(powers, dtype=np.uint64))
    return both[0], both[1]


def features_of(text: str | None) -> np.ndarray:
    """The hashed feature of each word, in order: the same words as ``words_of`` gives, without making them.

    A word's hash is a polynomial of its code points, read off running sums over the text, so it is the same wherever the word stands.
    """
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    edge = np.flatnonzero(np.diff(_letters()[points], prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    out = np.empty(len(start), np.int64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + PIECE, "right")))
        part = points[start[i]:end[j - 1]]
        up, down = _powers(max(10, int(len(part)).bit_length()))
        run = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[:len(part)], out=run[1:])
        first, last = start[i:j] - start[i], end[i:j] - start[i]
        h = (run[last] - run[first]) * down[first]
        h = (h ^ h >> np.uint64(32)) * _MIX
        h = (h ^ h >> np.uint64(32)) * _MIX
        out[i:j] = (h >> np.uint64(40)).astype(np.int64) & (FEATURES - 1)
        i = j
    return out


def ids_of(words: list[str]) -> np.ndarray:
    return features_of(" ".join(words))


def _features(docs: DataFrame) -> DataFrame:
    """``docs`` with ``ids``: the features of each document's words, as little-endian 16-bit integers."""

    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([features_of(t).astype("<u2").tobytes() for t in texts], dtype=object)

    return docs.withColumn("ids", run("text"))


def _frequency(features: DataFrame) -> np.ndarray:
    """Number of documents that each feature occurs in, over all of them; the last entry is their number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                own = np.sort(np.frombuffer(ids, "<u2"), kind="stable")
                n[own[np.flatnonzero(np.diff(own.view("<i2"), prepend=-1))]] += 1
                n[-1] += 1
        there = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(n[there])], names=["feature", "n"])

    rows = features.select("ids").mapInArrow(run, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    out = np.zeros(FEATURES + 1, np.int64)
    for r in rows.collect():  # at most FEATURES + 1 rows
        out[r["feature"]] = r["n"]
    return out


def document_frequency(docs: DataFrame) -> np.ndarray:
    """Number of documents that each feature occurs in, over all of them; the last entry is their number."""
    return _frequency(_features(docs))


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Features of whole documents side by side, ``FIT_RUN`` at a time, each document filled up to whole blocks with ``FEATURES``.

    Short documents share a run, so the work on a run is spread over many of them; a long one is cut at a block.
    """
    held, size = [], 0
    for batch in batches:
        for data in batch.column(0).to_pylist():
            ids = np.frombuffer(data, "<u2").astype(np.int64)
            for at in range(0, len(ids), FIT_RUN):
                part = ids[at:at + FIT_RUN]
                gap = -len(part) % BLOCK
                if size + len(part) + gap > FIT_RUN:
                    yield np.concatenate(held)
                    held, size = [], 0
                held += [part, np.full(gap, FEATURES)] if gap else [part]
                size += len(part) + gap
    if held:
        yield np.concatenate(held)


def _group_sums(rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the runs of rows that begin at ``first``, and the order of the runs they come in.

    The k-th rows of all runs long enough are added at once, which is far cheaper than run by run; the few longest runs end alone.
    """
    size = np.diff(first, append=len(rows))
    by = np.argsort(-size, kind="stable")
    size, first = size[by], first[by]
    sums = rows[first]
    k, active = 1, int(np.searchsorted(-size, -1, "left"))
    while active >= 16:
        sums[:active] += rows[first[:active] + k]
        k += 1
        active = int(np.searchsorted(-size, -k, "left"))
    for i in range(active):
        sums[i] += rows[first[i] + k:first[i] + size[i]].sum(axis=0)
    return by, sums


def _passages(ids: np.ndarray, weighted: np.ndarray) -> np.ndarray:
    """Sum of weighted basis rows for each block of words."""
    whole = len(ids) // BLOCK * BLOCK
    sums = np.matmul(np.ones((1, BLOCK), np.float32), weighted[ids[:whole]].reshape(-1, BLOCK, weighted.shape[1]))[:, 0]
    return sums if whole == len(ids) else np.vstack([sums, weighted[ids[whole:]].sum(axis=0, keepdims=True)])


@dataclass
class Space:
    """Weight of each feature, and its weighted place in the latent space."""

    idf: np.ndarray
    weighted: np.ndarray


def fit_space(features: DataFrame, blocks: Callable[[], Iterator[list[list[str]]]], frequency: np.ndarray) -> Space:
    """Two passes over all documents and all items: the range of the transposed product, then its singular values.

    ``features`` are those of all documents (see ``_features``). ``blocks`` gives the words of all items, a bounded number at a
    time; the space is one for all of them.
    """
    spark = features.sparkSession
    total = int(frequency[-1])
    idf = np.log((total + 1) / (frequency[:-1] + 0.5)).clip(0.1).astype(np.float32)
    rank = min(RANK, FEATURES)
    rng = np.random.default_rng(SEED)
    omega = rng.standard_normal((FEATURES, rank), dtype=np.float32)

    def own() -> Iterator[np.ndarray]:
        return (ids_of(w) for block in blocks() for w in block if w)

    def product(texts: Iterable[np.ndarray], left: np.ndarray) -> np.ndarray:
        """Transposed passages times passages times ``left``."""
        out, weighted = np.zeros((FEATURES, rank), np.float32), left * idf[:, None]
        for ids in texts:
            y = _passages(ids, weighted)
            y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-6)
            block = np.repeat(np.arange(len(y)), BLOCK)[:len(ids)]
            np.add.at(out, ids, y[block] * idf[ids, None])
        return out

    shared = spark.sparkContext.broadcast((idf, omega))

    def filled(left: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Weighted rows of a basis, and a row of zeros for the words that fill up a block."""
        return np.vstack([left * weights[:, None], np.zeros((1, left.shape[1]), np.float32)])

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, left = shared.value
        out, weighted = np.zeros((FEATURES + 1, rank)), filled(left, weights)
        for ids in _runs(batches):
            y = _passages(ids, weighted)
            y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-6)
            order = np.argsort(ids.astype(np.uint16), kind="stable")
            first = np.flatnonzero(np.diff(ids[order], prepend=-1))
            by, sums = _group_sums(y[order // BLOCK], first)
            out[ids[order[first[by]]]] += sums
        out = (out[:-1] * weights[:, None]).astype(np.float32)
        there = np.flatnonzero(np.abs(out).sum(axis=1))
        for at in range(0, len(there), 2048):
            part = there[at:at + 2048]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([r.tobytes() for r in out[part]], pa.binary())], names=["feature", "row"])

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[int, np.ndarray] = {}
        for batch in batches:
            for f, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row = np.frombuffer(r, np.float32).astype(np.float64)
                out[f] = out[f] + row if f in out else row
        for at in range(0, len(out), 2048):
            part = list(out)[at:at + 2048]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([out[f].astype(np.float32).tobytes() for f in part], pa.binary())], names=["feature", "row"])

    form = "feature bigint, row binary"
    features = features.select("ids")
    rows = features.mapInArrow(spread, form).repartition("feature").mapInArrow(add_up, form)
    y = np.zeros((FEATURES, rank))
    for r in rows.toLocalIterator():  # FEATURES rows in all
        y[r["feature"]] += np.frombuffer(r["row"], np.float32)
    # Items weigh as much as the corpus, so that the directions in which they differ are among the leading ones.
    held = product(own(), omega).astype(np.float64)
    y = y / max(np.linalg.norm(y), 1e-9) + held / max(np.linalg.norm(held), 1e-9)
    basis = np.linalg.qr(y)[0].astype(np.float32)
    whole = spark.sparkContext.broadcast((idf, basis))

    def squares(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, left = whole.value
        out, weighted = np.zeros((rank, rank)), filled(left, weights)
        for ids in _runs(batches):
            z = _passages(ids, weighted)
            out += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["square"])

    gram = np.zeros((rank, rank))
    for r in features.mapInArrow(squares, "square binary").toLocalIterator():
        gram += np.frombuffer(r["square"]).reshape(rank, rank)
    weighted, square = basis * idf[:, None], np.zeros((rank, rank))
    for ids in own():
        z = _passages(ids, weighted).astype(np.float64)
        square += z.T @ z
    gram = gram / max(np.trace(gram), 1e-9) + square / max(np.trace(square), 1e-9)
    value, vector = np.linalg.eigh(gram)
    scale = 1 / np.sqrt(np.maximum(value, 0) + 1e-3 * max(value.mean(), 1e-12))
    return Space(idf, (basis @ (vector * scale) * idf[:, None]).astype(np.float32))


def common_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence of two word lists, by bit vectors over ``a``."""
    places: dict[str, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        u = row & places.get(w, 0)
        row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


class Search:
    """Items of one block, grouped by the number of text blocks that a window needs to cover them."""

    def __init__(self, space: Space, items: list[tuple[int | None, list[str]]]) -> None:
        self.space = space
        self.items = [(i, w) for i, w in items if w]
        groups: dict[int, list[int]] = {}
        vectors = np.zeros((len(self.items), space.weighted.shape[1]), np.float32)
        self.answers: list[set[str]] = []
        for k, (_, words) in enumerate(self.items):
            ids = ids_of(words)
            vectors[k] = _passages(ids, space.weighted).sum(axis=0)
            groups.setdefault(-(-len(words) // BLOCK) + 1, []).append(k)
            weight = dict(zip(words, space.idf[ids].tolist()))
            rarest = sorted(weight, key=lambda w: (-weight[w], w))
            self.answers.append(set(rarest[:max(1, len(rarest) // 5)]))
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)
        self.groups = [(width, np.array(group), vectors[group]) for width, group in sorted(groups.items())]
        self.widest = max(groups, default=1)
        size = np.fromiter((len(w) for _, w in self.items), np.int64, len(self.items))
        self.least, self.first = LCS * size, np.cumsum(size) - size
        self.features = np.concatenate([ids_of(w) for _, w in self.items] or [np.empty(0, np.int64)])
        # Columns of the features that items have; then one for all others, and one that is never set, for the places behind an item's end.
        asked = np.unique(self.features)
        self.column = np.full(FEATURES, len(asked))
        self.column[asked] = np.arange(len(asked))
        self.columns = len(asked) + 2
        self.places = []
        for width, group, _ in self.groups:
            at = np.full((len(group), size[group].max()), self.columns - 1)
            for row, k in enumerate(group):
                at[row, :size[k]] = self.column[self.features[self.first[k]:self.first[k] + size[k]]]
            self.places.append(at)

    def hits(self, text: str | None) -> list[tuple[int | None, float, float]]:
        """(item, cosine, share of the item in order) of the items that a text contains, the best passage of each."""
        return self.hits_of(features_of(text), lambda: text)

    def hits_of(self, every: np.ndarray, text: Callable[[], str | None]) -> list[tuple[int | None, float, float]]:
        """The same from the features of a text's words; ``text`` is called when there is something to verify.

        A long text is handled in runs of ``CHUNK`` words, each with the blocks after it that a window may reach into.
        """
        if not len(every) or not self.items:
            return []
        words: list[str] = []  # made when there is something to verify

        def part(first: int, last: int) -> list[str]:
            words.extend(() if words else words_of(text()))
            return words[first:last]

        best: dict[int, tuple[float, float]] = {}
        reach = (self.widest - 1) * BLOCK
        for at in range(0, len(every), CHUNK):
            self._search(every[at:at + CHUNK + reach], at, part, best)
        out: dict[int | None, tuple[float, float]] = {}
        for k, found in best.items():  # of items that share an id the best
            i = self.items[k][0]
            out[i] = max(out.get(i, found), found)
        return [(i, c, s) for i, (s, c) in sorted(out.items(), key=lambda x: (x[0] is None, x[0]))]

    def _search(self, ids: np.ndarray, offset: int, words: Callable[[int, int], list[str]], best: dict[int, tuple[float, float]]) -> None:
        """Windows that start in the run of ``CHUNK`` words from word ``offset`` on; ``ids`` are the run and what a window may reach into."""
        # An item that has too few of its words anywhere in the run is in none of its passages. Two words may share a feature, which
        # can only keep an item.
        there_at_all = np.zeros(FEATURES, bool)
        there_at_all[ids] = True
        open_items = np.add.reduceat(there_at_all[self.features], self.first, dtype=np.int64) >= self.least
        if not open_items.any():
            return
        sums = _passages(ids, self.space.weighted)
        run = np.zeros((len(sums) + 1, sums.shape[1]))
        np.cumsum(sums, axis=0, dtype=np.float64, out=run[1:])
        held = np.zeros((len(sums), self.columns), bool)
        held[np.arange(len(ids)) // BLOCK, self.column[ids]] = True
        for (width, group, vectors), places in zip(self.groups, self.places):
            mine = np.flatnonzero(open_items[group])
            if not len(mine):
                continue
            n = min(CHUNK // BLOCK, len(sums) - width + 1)
            if n < 1:
                if offset:
                    continue  # the run before has reached to the text's end
                n = 1
            windows = (run[np.minimum(np.arange(n) + width, len(sums))] - run[:n]).astype(np.float32)
            windows /= np.maximum(np.linalg.norm(windows, axis=1, keepdims=True), 1e-6)
            near = windows @ vectors[mine].T
            before, part, there = -1, [], set()
            for at, g in self._with_enough_words(held, near, width, places[mine], self.least[group[mine]]):
                if at != before:
                    before, part = at, words(offset + at * BLOCK, min(offset + (at + width) * BLOCK, offset + len(ids)))
                    there = set(part)
                k = int(group[mine[g]])
                item = self.items[k][1]
                # no common subsequence is longer than the number of the item's words that the passage has at all
                if sum(map(there.__contains__, item)) < LCS * len(item):
                    continue
                share = common_length(item, part) / len(item)
                if share < SURE and len(self.answers[k] & there) < ANSWER * len(self.answers[k]):
                    continue
                if share >= LCS and (share, float(near[at, g])) > best.get(k, (0.0, 0.0)):
                    best[k] = (share, float(near[at, g]))


    @staticmethod
    def _with_enough_words(held: np.ndarray, near: np.ndarray, width: int, places: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, int]]:
        """The (window, item) pairs near enough whose window holds as many of the item's words as the verification asks for at least.

        ``held`` marks the items' features block by block; two words may share a feature, which can only add pairs.
        """
        at, g = np.nonzero(near >= COSINE)
        for i in range(0, len(at), 4096):
            window, item = at[i:i + 4096, None], g[i:i + 4096]
            there = held[window, places[item]]
            for j in range(1, width):
                there |= held[np.minimum(window + j, len(held) - 1), places[item]]
            enough = np.flatnonzero(there.sum(axis=1) >= least[item])
            yield from zip(window[enough, 0].tolist(), item[enough].tolist())


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``cosine``, ``overlap``: the items that each document holds, one row for each pair.

    Null, empty and wordless texts and items match nothing; an empty benchmark or corpus gives no rows. Repeated
    documents give repeated rows. All different texts of an ``item_id`` are searched for, and the best counts (twice, if they lie in
    two blocks of items); items without an id are reported under null, as documents without one are. Further columns are ignored.
    A long text is searched in runs of ``CHUNK`` words.
    """
    spark = docs.sparkSession
    named = stage(spark, benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct(), "items")

    def blocks() -> Iterator[list[tuple[int | None, list[str]]]]:
        rows = ((r["item_id"], words_of(r["text"])) for r in named.orderBy("item_id", "text").toLocalIterator())
        while block := list(islice(rows, ITEM_BLOCK)):
            yield block

    form = "doc_id bigint, item_id bigint, cosine double, overlap double"
    found = spark.createDataFrame([], form)
    if named.isEmpty():
        return found
    features = stage(spark, _features(docs.select("doc_id", "text")), "features")
    space = fit_space(features, lambda: ([w for _, w in block] for block in blocks()), _frequency(features))
    for block in blocks():
        found = found.union(_searched(spark, features, space, block, form))
    found = stage(spark, found, "found")
    release(features)
    return found


def _searched(spark: SparkSession, features: DataFrame, space: Space, rows: list, form: str) -> DataFrame:
    shared = spark.sparkContext.broadcast((space, rows))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*shared.value)
        for batch in batches:
            texts = batch.column(1)
            out = [(d, *h) for k, (d, ids) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()))
                   for h in search.hits_of(np.frombuffer(ids, "<u2").astype(np.int64), lambda k=k, texts=texts: texts[k].as_py())]
            d, i, c, s = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(i, pa.int64()), pa.array(c, pa.float64()),
                                              pa.array(s, pa.float64())], names=["doc_id", "item_id", "cosine", "overlap"])

    return features.select("doc_id", "text", "ids").mapInArrow(run, form)


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item. Rows are told apart by id and text, so a row without an id is judged too."""
    mark = next(x for x in (f"row_{k}" for k in range(len(docs.columns) + 1)) if x not in docs.columns)
    marked = docs.withColumn(mark, F.xxhash64("doc_id", "text"))
    hit = matches(marked.select(F.col(mark).alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias(mark)).distinct()
    return marked.join(hit, mark, "left_anti").select(docs.columns)
