"""Toxic texts by a subsequence string kernel and a support vector machine on Nyström landmarks.

The kernel of two words counts common subsequences of three to five characters; each gap character inside a subsequence
costs the factor ``DECAY``, so words with inserted or exchanged characters stay close to the plain word. A word's
ends count as characters. Landmarks are words of labelled sentences; the Nyström map of the kernel on them feeds a linear
machine, which is folded back into one weight per subsequence, so scoring a word costs the same for any number
of landmarks.

The machine is trained on the labelled sentences themselves. A sentence is as toxic as its worst words, so it is a bag of words whose
label belongs to the worst: each round, every labelled sentence names the words that the machine so far finds worst, and the machine is
fitted anew on these, under the label of the sentence. Only the first round, which has no machine yet, starts from words that single
counts call typical of a class. A logistic curve fitted on labelled texts turns a text's worst words into its score. Labels are
only read to fit; a score depends on the text alone.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronograde.llm.common import release, stage

LENGTHS = (3, 4, 5)
DECAY = 0.5
GAPS = 2
LANDMARKS = 384
#: Labelled texts of either class that the machine is fitted on, and words of either class taken from them.
SAMPLE_TEXTS = 10_000
SAMPLE_WORDS = 1_500
THRESHOLD = 0.7
#: Rounds in which the labelled sentences name their worst words, and how many a clean sentence names (a toxic one: one).
ROUNDS = 3
NAMED = 2
COPY_HASHES = 5
TABLE_BITS = 20
#: Words whose scores a task keeps; when there are so many, further ones are scored anew for each batch.
CACHE_WORDS = 400_000
#: Longer words are scored in pieces of this size.
PIECE = 40
#: Texts whose new words are scored together.
BATCH = 128

_STRIP = string.punctuation + "“”„«»‘’…·•–—"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PATTERNS = [(p, (0, *rest), DECAY ** (rest[-1] + 1 - p))
             for p in LENGTHS for rest in combinations(range(1, p + GAPS), p - 1)]


def words_of(text: str | None) -> list[str]:
    """Lower-case words without punctuation; single characters in a row (``i d i o t``) are also taken as one word."""
    plain = (text or "").lower()
    for c in _STRIP:  # far cheaper than one table for all characters
        if c in plain:
            plain = plain.replace(c, "")
    words = plain.split()
    if sum(map((1).__eq__, map(len, words))) < 3:
        return words
    run, joined = [], []
    for w in [*words, ""]:
        if len(w) == 1:
            run.append(w)
        else:
            if len(run) >= 3:
                joined.append("".join(run))
            run = []
    return words + joined


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the gapped subsequences of each word (zero: none) and their weights, a column for each place and gap."""
    width = max(map(len, words)) + 2
    chars = np.zeros((len(words), width + max(LENGTHS) + GAPS), np.uint64)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words))
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) + 1
    chars[np.repeat(np.arange(len(words)), size), at] = flat
    chars[:, 0] = 2
    chars[np.arange(len(words)), size + 1] = 3
    codes, there = np.zeros((len(words), len(_PATTERNS) * width), np.uint64), chars != 0
    before, steps = (), []
    for i, (p, offsets, _) in enumerate(_PATTERNS):
        path = (p, *offsets)  # a pattern goes on from where it leaves the one before
        kept = next((k for k in range(min(len(path), len(before))) if path[k] != before[k]), 0)
        before, steps = path, steps[:kept] or [np.uint64(p)]
        for o in path[len(steps):]:
            code = (steps[-1] ^ chars[:, o:o + width]) * _MIX
            code ^= code >> np.uint64(29)
            steps.append(code)
        np.copyto(codes[:, i * width:(i + 1) * width], steps[-1], where=there[:, offsets[-1]:offsets[-1] + width])
    return codes, np.repeat([weight for _, _, weight in _PATTERNS], width)


def lengths_norm(size: np.ndarray) -> np.ndarray:
    """The kernel is scaled by a function of the word's length: the norm of its subsequences taken as different."""
    total = sum(np.maximum(size + 2 - offsets[-1], 0) * weight ** 2 for _, offsets, weight in _PATTERNS)
    return np.sqrt(np.maximum(total, 1e-9))


def _features(words: list[str], known: dict[int, int] | None = None) -> tuple[np.ndarray, dict[int, int]]:
    """Dense feature rows over the subsequences of ``words`` (or of ``known``), scaled by length."""
    codes, weights = subsequences(words)
    if known is None:
        known = {c: i for i, c in enumerate(np.unique(codes[codes != 0]).tolist())}
    keys = np.fromiter(known, np.uint64, len(known))
    column = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
    hit = (keys[column] == codes) & (codes != 0)
    rows = np.repeat(np.arange(len(words)), codes.shape[1]).reshape(codes.shape)
    out = np.bincount((rows * len(keys) + column)[hit], np.broadcast_to(weights, codes.shape)[hit], len(words) * len(keys))
    size = np.fromiter(map(len, words), np.int64, len(words))
    return (out.reshape(len(words), -1) / lengths_norm(size)[:, None]).astype(np.float32), known


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, squared: bool) -> np.ndarray:
    """Newton steps for a linear machine: squared hinge loss (support vectors), or logistic loss. Last entry: bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, eye = np.zeros(x.shape[1]), np.eye(x.shape[1])
    eye[-1, -1] = 1e-3
    for _ in range(40):
        margin = y * (x @ w)
        if squared:
            active = margin < 1
            slope, curve = -2 * weight * y * np.maximum(1 - margin, 0), 2 * weight * active
        else:
            p = 1 / (1 + np.exp(np.clip(margin, -30, 30)))
            slope, curve = -weight * y * p, weight * np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * curve[:, None]).T @ x + ridge * eye, x.T @ slope + ridge * eye @ w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    """Weights by subsequence in a hash table, the machine's bias, and the logistic curve over ``text_features``."""

    check: np.ndarray
    weight: np.ndarray
    bias: float
    curve: np.ndarray

    @cached_property
    def used(self) -> np.ndarray:
        """Whether a slot holds a subsequence: small enough to stay near the processor, and most slots don't."""
        return self.check != 0

    def score_words(self, words: list[str]) -> np.ndarray:
        codes, weights = subsequences(words)
        value, flat = np.zeros(codes.shape, np.float32), codes.reshape(-1)
        slot = (flat >> np.uint64(64 - TABLE_BITS)).view(np.int64)
        at = np.flatnonzero(self.used[slot])
        at = at[self.check[slot[at]] == flat[at]]
        value.reshape(-1)[at] = self.weight[slot[at]]
        size = np.fromiter(map(len, words), np.int64, len(words))
        return value @ weights.astype(np.float32) / lengths_norm(size) + self.bias

    def score(self, features: np.ndarray) -> np.ndarray:
        z = features @ self.curve[:-1] + self.curve[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self._known = model, {}

    def words(self, texts: list[str | None]) -> tuple[list[list[str]], np.ndarray]:
        """The different words of each text, long ones in pieces, and the scores of all of them, one text after the other."""
        sets = []
        for text in texts:
            words = set(words_of(text))
            for w in [w for w in words if len(w) > PIECE] if max(map(len, words), default=0) > PIECE else ():
                words.discard(w)
                words.update(w[i:i + PIECE] for i in range(0, len(w), PIECE // 2))
            sets.append(list(words))
        known = self._known
        new = sorted(set().union(*sets) - known.keys(), key=len)  # words of like length share an array
        if len(known) + len(new) > CACHE_WORDS:
            known = {w: known[w] for w in set().union(*sets) & known.keys()}
        for at in range(0, len(new), 2048):
            part = new[at:at + 2048]
            known.update(zip(part, self.model.score_words(part).tolist()))
        return sets, np.fromiter(map(known.__getitem__, chain.from_iterable(sets)), np.float64, sum(map(len, sets)))

    def worst(self, texts: list[str | None], n: list[int]) -> Iterator[list[str]]:
        """The ``n`` words of each text with the highest scores, ties by the word."""
        sets, scores = self.words(texts)
        at = 0
        for words, k in zip(sets, n):
            own = scores[at:at + len(words)]
            at += len(words)
            bar = np.partition(own, -k)[-k] if len(words) > k else -np.inf
            yield sorted((words[i] for i in np.flatnonzero(own >= bar)), key=lambda w, v=dict(zip(words, own)): (-v[w], w))[:k]

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Worst word, mean of the two worst, number of words the machine takes for insults, and the text's length."""
        sets, scores = self.words(texts)
        size = np.fromiter(map(len, sets), np.int64, len(sets))
        some, out = np.flatnonzero(size), np.zeros((len(sets), 4))
        out[:, :2], out[:, 3] = -2.0, np.log1p(size)
        if len(some):
            start = (np.cumsum(size) - size)[some]
            out[some, 0] = top = np.maximum.reduceat(scores, start)
            out[some, 2] = np.log1p(np.add.reduceat(scores > 0, start, dtype=np.int64))
            places = np.flatnonzero(scores == np.repeat(top, size[some]))
            scores[places[np.searchsorted(places, start)]] = -np.inf  # once where several words are worst
            second = np.maximum.reduceat(scores, start)
            out[some, 1] = np.where(size[some] > 1, (top + second) / 2, top)
        return out


def word_evidence(rows: DataFrame, words: int = SAMPLE_WORDS) -> list[tuple[str, int, float]]:
    """Words of labelled texts (``text``, ``label``) as (word, class, weight), at most ``words`` of either class.

    A word stands for the toxic class if it, or a beginning of four to eight letters that it shares with others,
    occurs in far more toxic texts than its share (likelihood ratio). The others are the most common words of clean
    texts, and those of clean texts that share a beginning with the toxic ones.
    """
    totals = rows.groupBy().agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")).first()
    toxic, clean = float(totals["t"] or 0), float(totals["c"] or 0)
    if not toxic or not clean:
        return []

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = [w for w in set(words_of(text)) if 2 <= len(w) <= PIECE]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.string()), pa.array([label] * len(own), pa.int64())], names=["word", "label"])

    def ratio(t: Column, c: Column) -> Column:
        n = t + c
        share = toxic / (toxic + clean)
        part = lambda k, e: F.when(k > 0, k * F.log(k / e)).otherwise(0.0)
        value = 2 * (part(t, n * share) + part(c, n * (1 - share)))
        return F.when(t / toxic > 4 * c / clean, value).otherwise(-value)

    counts = (rows.select("text", F.col("label").cast("bigint")).mapInArrow(split, "word string, label bigint")
              .groupBy("word").agg(F.sum("label").cast("double").alias("t"), F.sum(1 - F.col("label")).cast("double").alias("c"))
              .withColumn("own", ratio(F.col("t"), F.col("c"))))
    counts = stage(rows.sparkSession, counts, "words")
    starts = counts.select("word", "t", "c", F.explode(F.expr(
        "transform(sequence(4, greatest(4, least(8, length(word) - 1))), n -> substring(word, 1, n))")).alias("start")).where("length(word) > 4")
    stems = (starts.groupBy("start").agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").withColumn("stem", ratio(F.col("t"), F.col("c"))))
    best = starts.select("word", "start").join(stems.where("stem > 0").select("start", "stem"), "start") \
        .groupBy("word").agg(F.max("stem").alias("stem"))
    scored = counts.join(best, "word", "left").withColumn("stem", F.coalesce("stem", F.lit(0.0)))
    bar = 2 * float(np.log(counts.count() + 1))  # so many words are tried that chance alone seldom passes it
    positive = (scored.where((F.greatest("own", "stem") > bar) & (F.col("t") / toxic > 2 * F.col("c") / clean))
                .orderBy(F.desc(F.greatest("own", "stem")), "word").limit(words))
    common = scored.where("c > 0 AND t * %r <= 2 * c * %r" % (clean, toxic))
    negative = common.orderBy(F.desc("c"), "word").limit(words // 2)
    near = common.where("stem > 0 OR c = 1").orderBy(F.desc("stem"), F.xxhash64("word"), "word").limit(words // 2)
    take = lambda df, y: [(r["word"], y, r["own"]) for r in df.select("word", "own").collect()]
    chosen = {w: (w, y, v) for w, y, v in take(near, -1) + take(negative, -1) + take(positive, 1)}
    return sorted(chosen.values())


def _salted(k: int) -> Callable[[Column], Column]:
    return lambda w: F.xxhash64(w, F.lit(k))


def without_copies(rows: DataFrame) -> DataFrame:
    """One text of each group of copies and near copies of a label, which would count their words many times over.

    Near copies are texts whose word sets agree in all of ``COPY_HASHES`` min-wise hashes: the chance is the similarity of the
    sets to that power, so texts that merely share common words stay.
    """
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), "\\s+")
    low = F.array(*[F.array_min(F.transform(words, hashed)) for hashed in map(_salted, range(COPY_HASHES))])
    return rows.withColumn("low", low).dropDuplicates(["label", "low"]).drop("low")


def named_words(rows: DataFrame, model: Model) -> list[tuple[str, int, int]]:
    """(word, class, number of sentences): the words that the labelled texts (``text``, ``label``) name as their worst."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in (b.slice(at, BATCH) for b in batches for at in range(0, b.num_rows, BATCH)):
            labels = batch.column(1).to_pylist()
            named = scorer.worst(batch.column(0).to_pylist(), [1 if label else NAMED for label in labels])
            out = [(w, 1 if label else -1) for words, label in zip(named, labels) for w in words]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in out], pa.string()), pa.array([c for _, c in out], pa.int64())], names=["word", "class"])

    named = rows.select("text", F.col("label").cast("bigint")).mapInArrow(run, "word string, class bigint")
    return [tuple(r) for r in named.groupBy("word", "class").agg(F.count(F.lit(1)).alias("n")).collect()]  # at most 1 + NAMED for each sampled text


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_TEXTS) -> Model:
    """Fits on at most ``sample`` labelled texts of either class, picked by a hash of their id; null labels don't count.

    Without texts of both classes the model gives every text the share of toxic labels (0 if there are none).
    """
    spark = docs.sparkSession
    known = labels.select("doc_id", F.col("toxic").cast("bigint").alias("label")).where("label IN (0, 1)") \
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    picked = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    rows = stage(spark, docs.select("doc_id", "text").join(picked[0].union(picked[1]), "doc_id")
                 .dropDuplicates(["doc_id"]).select("doc_id", "text", "label"), "labelled")
    labelled = rows
    rows = stage(spark, without_copies(rows), "labelled_once")
    release(labelled)
    evidence = word_evidence(rows)
    if len({y for _, y, _ in evidence}) < 2:
        share = float(rows.agg(F.avg("label")).first()[0] or 0.0)
        return Model(np.zeros(1 << TABLE_BITS, np.uint64), np.zeros(1 << TABLE_BITS, np.float32), 0.0, np.array([0, 0, 0, 0, float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))]))
    words = [w for w, _, _ in evidence]
    y = np.array([c for _, c, _ in evidence], float)
    by_class = [sorted((i for i in range(len(words)) if y[i] == c), key=lambda i: (-abs(evidence[i][2]), words[i])) for c in (1, -1)]
    marks = sorted(by_class[0][:2 * LANDMARKS // 3] + by_class[1][:LANDMARKS // 3])
    z, known_codes = _features([words[i] for i in marks])
    kernel = z.astype(float) @ z.T
    value, vector = np.linalg.eigh(kernel)
    kept = value > 1e-8 * value[-1]
    root = vector[:, kept] / np.sqrt(value[kept])  # kernel to the power -1/2
    keys, onto = np.fromiter(known_codes, np.uint64, len(known_codes)), z.T @ root  # each subsequence's place in the landmarks' space
    places: dict[str, np.ndarray] = {}

    def mapped(some: list[str]) -> np.ndarray:
        new = sorted((w for w in some if w not in places), key=lambda w: (len(w), w))
        for at in range(0, len(new), 256):
            part = new[at:at + 256]
            found, heavy = subsequences(part)
            column = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            hit = (keys[column] == found) & (found != 0)
            norm = lengths_norm(np.fromiter(map(len, part), np.int64, len(part)))
            for i, w in enumerate(part):  # few of a word's subsequences are any landmark's
                places[w] = heavy[hit[i]] @ onto[column[i][hit[i]]] / norm[i]
        return np.vstack([places[w] for w in some])

    codes = np.fromiter(known_codes, np.uint64, len(known_codes))
    slot = (codes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def machine(some: list[str], label: np.ndarray, times: np.ndarray) -> Model:
        even = times[label < 0].sum() / max(times[label > 0].sum(), 1)
        weight = times / times.mean() * np.where(label > 0, np.clip(even, 0.2, 5), 1.0)
        w = _machine(mapped(some), label, weight, 0.1, True)
        folded = (root @ w[:-1]) @ z  # one weight for each subsequence of the landmarks
        check, value = np.zeros(1 << TABLE_BITS, np.uint64), np.zeros(1 << TABLE_BITS, np.float32)
        order = np.argsort(np.abs(folded), kind="stable")  # where two share a slot, the heavier stays
        check[slot[order]], value[slot[order]] = codes[order], folded[order]
        return Model(check, value, float(w[-1]), np.zeros(5))

    model = machine(words, y, np.ones(len(words)))
    seen_words: dict[tuple[str, int], int] = {}
    for _ in range(ROUNDS):
        now = {(w, c): n for w, c, n in named_words(rows, model)}
        # clean sentences keep what they named before, or the words that the last round has put right come back
        seen_words = {k: n for k, n in seen_words.items() if k[1] < 0} | now
        bag = sorted(seen_words)
        model = machine([w for w, _ in bag], np.array([c for _, c in bag], float), np.array([seen_words[k] for k in bag], float))
    shared = spark.sparkContext.broadcast(model)

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            f = scorer.features(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*(pa.array(f[:, k]) for k in range(4)), batch.column(1)], names=["a", "b", "c", "d", "label"])

    seen = rows.select("text", F.col("label").cast("double").alias("label")).mapInArrow(
        measure, "a double, b double, c double, d double, label double").toPandas().to_numpy()
    seen = seen[np.lexsort(seen.T)]  # fits alike in whatever order the rows come
    release(rows)
    model.curve = _machine(seen[:, :4], 2 * seen[:, 4] - 1, np.ones(len(seen)), 0.5, False)
    return model


def score_column(spark: SparkSession, model: Model, text: str = "text") -> Column:
    """The score of a text column; null and empty texts are scored as texts without words."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for batch in batches:
            parts = [scorer.features(batch.iloc[at:at + BATCH].tolist()) for at in range(0, len(batch), BATCH)]
            yield pd.Series(shared.value.score(np.vstack(parts) if parts else np.empty((0, 4))))

    return run(F.col(text))


def held_out() -> Column:
    return F.coalesce(F.expr("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1"), F.lit(False))


def train_and_score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row; held-out labels are not read.

    Empty tables give an empty result; repeated rows come back repeated; rows without ``doc_id`` are scored but never
    learnt from; further columns of either table are ignored.
    """
    model = fit(docs.where("doc_id IS NOT NULL"), labels.where(~held_out()))
    return docs.select("doc_id", held_out().alias("held_out"), score_column(docs.sparkSession, model).alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their columns.

    Null and empty texts are scored as texts without words; rows without ``doc_id`` are judged but not learnt from; repeated rows
    stay repeated; an empty table gives an empty result; columns named like the labels' are not read.
    """
    model = fit(docs.where("doc_id IS NOT NULL"), labels.where(~held_out()))
    return docs.where(score_column(docs.sparkSession, model) < threshold)
