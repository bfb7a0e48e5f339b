"""Document quality by gradient-boosted trees over document statistics.

One pass over the texts gives counts (words, symbols, repeated lines, repeated word windows, bytes). Hard rules on these
counts settle the plain cases; the rest is judged by boosted trees, fitted on labelled documents and flattened into node
arrays, so that a batch of documents walks through all trees at once. On chosen statistics the trees are monotonic: more of
it never makes a document better.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
SYMBOLS = "#*$%&|<>"
#: Labelled documents that the trees are fitted on, picked by a hash of their id.
SAMPLE = 20_000
TREES, DEPTH, RATE, BINS = 60, 4, 0.2, 48
RIDGE, LEAST_WEIGHT = 1.0, 2.0
THRESHOLD = 0.5

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics the trees see, with the direction (-1: more is never better, 0: free).
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": 0,
    "digit_share": 0, "distinct_share": 0, "top_word_share": -1, "exclamation_share": -1, "stop_share": 0,
    "comma_share": 0, "entropy": 0, "words_a_line": 0, "single_share": 0, "non_ascii_share": 0, "longest_word": 0,
}
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_UPPER, _DIGIT = slice(65, 91), slice(48, 58)


class _Ids(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def repeated_words(ids: np.ndarray, known: int) -> int:
    """Positions inside windows of ``WINDOW`` words that occur at least twice."""
    if len(ids) < WINDOW:
        return 0
    window, size = ids[:len(ids) - WINDOW + 1], known
    for k in range(1, WINDOW):
        if size * known >= 1 << 62:  # numbers the windows anew before they could overflow
            values, window = np.unique(window, return_inverse=True)
            size = len(values)
        window = window * known + ids[k:len(ids) - WINDOW + 1 + k]
        size *= known
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    twice = np.zeros(len(window) + 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for k in range(WINDOW):
        covered[k:k + len(window)] |= twice[:len(window)]
    return int(covered.sum())


def statistics(text: str, ids: _Ids) -> tuple[list[int], list[float]]:
    """Base counts and features of a whole text."""
    words = _WORD.findall(text)
    n, chars = len(words), len(text)
    numbers = np.fromiter(map(ids.__getitem__, words), np.int64, n)
    lengths = np.fromiter(map(len, words), np.int64, n)
    word_chars = int(lengths.sum())
    symbols = sum(map(text.count, SYMBOLS))
    lines, seen, dup = 0, set(), 0
    for line in text.split("\n"):
        if _WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    repeat = repeated_words(numbers, len(ids))
    byte = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    total, w = max(int(byte.sum()), 1), max(n, 1)
    share = byte[byte > 0] / total
    kinds = np.bincount(np.unique(numbers, return_inverse=True)[1]) if n else np.zeros(1)
    features = [
        float(np.log1p(n)), word_chars / w, symbols / max(chars, 1), dup / max(lines, 1), repeat / w,
        byte[_UPPER].sum() / total, byte[_DIGIT].sum() / total, len(kinds) / w, kinds.max() / w, byte[33] / w, byte[46] / w,
        byte[44] / w, float(-(share * np.log2(share)).sum()), n / max(lines, 1), float((lengths == 1).sum()) / w,
        byte[128:].sum() / total, float(np.log1p(lengths.max())) if n else 0.0]
    return [n, word_chars, symbols, dup, repeat], features


@dataclass
class Trees:
    """Node arrays of all trees; a leaf is its own child. ``start`` is the score before the first tree."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return self.start + self.value[node].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _split(grad: np.ndarray, weight: np.ndarray, ways: np.ndarray, low: float, high: float) -> tuple[float, int, int, float, float]:
    """Best (gain, feature, bin, left value, right value) of a node from its histograms (features x bins)."""
    g, h = np.cumsum(grad, axis=1), np.cumsum(weight, axis=1)
    g_all, h_all = g[:, -1:], h[:, -1:]
    best = lambda a, b: np.clip(-a / (b + RIDGE), low, high)
    loss = lambda a, b, v: a * v + 0.5 * (b + RIDGE) * v * v
    left, right, both = best(g, h), best(g_all - g, h_all - h), best(g_all, h_all)
    gain = loss(g_all, h_all, both) - loss(g, h, left) - loss(g_all - g, h_all - h, right)
    fits = (h >= LEAST_WEIGHT) & (h_all - h >= LEAST_WEIGHT) & ((right - left) * ways[:, None] >= 0)
    gain = np.where(fits, gain, -np.inf)
    f, b = divmod(int(np.argmax(gain)), gain.shape[1])
    return float(gain[f, b]), f, b, float(left[f, b]), float(right[f, b])


def grow(x: np.ndarray, y: np.ndarray, ways: np.ndarray, trees: int = TREES) -> Trees:
    """Boosted trees for the logistic loss on histograms of at most ``BINS`` bins a feature.

    A split on a constrained feature is taken only if its leaf values keep the direction, and the mean of the two
    values bounds everything below either side, so the whole sum is monotonic.
    """
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    start = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
    code = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)  # value <= edges[b] iff code <= b
    flat = code + np.arange(x.shape[1]) * BINS
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots, margin = [], np.full(len(y), start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, weight = p - y, np.maximum(p * (1 - p), 1e-6)
        roots.append(len(nodes))
        nodes.append([0, np.inf, 0, 0, 0.0])
        work = [(roots[-1], np.arange(len(y)), 0, -np.inf, np.inf, None)]
        while work:
            at, rows, depth, low, high, value = work.pop()
            if value is None:
                value = float(-grad[rows].sum() / (weight[rows].sum() + RIDGE))
            split = (0.0,)
            if depth < DEPTH and len(rows) > 1:
                hist = lambda v: np.bincount(flat[rows].ravel(), np.repeat(v[rows], x.shape[1]), x.shape[1] * BINS).reshape(-1, BINS)
                split = _split(hist(grad), hist(weight), ways, low, high)
            if split[0] <= 1e-6:
                nodes[at] = [0, np.inf, at, at, RATE * value]
                margin[rows] += RATE * value
                continue
            _, f, b, lv, rv = split
            child = len(nodes)
            nodes += [[0, np.inf, 0, 0, 0.0], [0, np.inf, 0, 0, 0.0]]
            nodes[at] = [f, float(edges[f][b]), child, child + 1, 0.0]
            goes, mid = code[rows, f] <= b, (lv + rv) / 2
            bounds = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid)), 0: ((low, high), (low, high))}[int(ways[f])]
            work.append((child, rows[goes], depth + 1, *bounds[0], lv))
            work.append((child + 1, rows[~goes], depth + 1, *bounds[1], rv))
    feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes))
    return Trees(feature, threshold, left, right, value, np.array(roots), start)


def constant(share: float) -> Trees:
    one = np.zeros(1, np.int64)
    return Trees(one, np.array([np.inf]), one, one, np.zeros(1), one, float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))


def _measured(batches: Iterable[pa.RecordBatch], keep: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with base counts and features of their column ``keep``."""
    ids = _Ids()
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            base, features = [], []
            for text in part.column(keep):
                if len(ids) > 300_000:
                    ids = _Ids()
                b, f = statistics(text.as_py() or "", ids)
                base.append(b)
                features.append(f)
            if base:
                yield part, np.array(base, np.int64), np.array(features, np.float64)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Fits on at most ``sample`` documents with label ``quality`` 0 or 1; ids with both labels or none don't count.

    Without documents of both classes every document scores the share of good labels (1 if there are none).
    """
    known = (labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id")
             .agg(F.min("quality").alias("y"), F.max("quality").alias("other")).where("y = other").select("doc_id", "y"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # bounded by the parameter
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", F.col("y").cast("double").alias("y"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, x in _measured(batches, 0):
            yield pa.RecordBatch.from_arrays([*map(pa.array, x.T), part.column(1)], names=[*FEATURES, "y"])

    seen = rows.mapInArrow(run, ", ".join(f"{c} double" for c in [*FEATURES, "y"])).toPandas().to_numpy(np.float64)
    if len(set(seen[:, -1].tolist())) < 2:
        return constant(float(seen[:, -1].mean()) if len(seen) else 1.0)
    seen = seen[np.lexsort(seen.T)]  # fits alike in whatever order the rows come
    return grow(seen[:, :-1], seen[:, -1], np.array(list(FEATURES.values())))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``kept`` and ``quality`` (score) of every row, one for one.

    A text fails the hard rules with fewer than ``MIN_WORDS`` words or with over ``MAX_REPEAT_PERCENT`` per cent of its words in
    repeated windows; null and empty texts have no words and fail. Any other text is kept if the trees give it the threshold or
    more. Rows without ``doc_id`` are judged but not learnt from; several rows of one labelled id all count (they may exceed
    the sample by their number); repeated rows come back repeated; further columns are ignored; an empty table gives an
    empty result. One text is held at a time with one number a word, so memory follows the longest text.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))  # at most TREES * 2^(DEPTH + 1) nodes

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, base, x in _measured(batches, 1):
            score = model.value.score(x)
            failed = (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > MAX_REPEAT_PERCENT * base[:, 0])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *map(pa.array, base.T), pa.array(failed), pa.array(~failed & (score >= threshold)), pa.array(score)],
                names=["doc_id", *BASE, "base_failed", "kept", "quality"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in BASE) + ", base_failed boolean, kept boolean, quality double")
