"""BPE encoding through a minimal acyclic transducer of frequent words.

The tokenizer file gives vocabulary and merge ranks. The most frequent word forms of the corpus (counted over all documents,
see ``ship_lexicon``) are encoded once and compiled into a minimal automaton: words share prefixes and suffixes, and the
number of words that an arc skips adds up to a word's index, under which its ids are stored. The arrays are shipped
once to each executor and memory-mapped there, so workers of one machine share the pages. Other words are merged
exactly, by rank and position.
"""

from __future__ import annotations

import heapq
import io
import json
import re
import struct
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chronograde.llm.common import release, stage
from chronograde.session import shared_folder

#: Word forms in the automaton. More only saves merging; results do not depend on it.
LEXICON_WORDS = 60_000
#: Word forms that a worker keeps; the table is emptied when full.
CACHE_WORDS = 300_000
#: Longer forms are not kept, which bounds the table's memory.
CACHE_CHARS = 64
#: White space beyond tab, line ends and space, and the one letter whose lower case depends on its neighbours.
_UNUSUAL = re.compile("[\x1c-\x1f\x85\xa0  -     　Σ]")


#: Letters and numbers up to U+024F; texts with other characters go through the tokenizer's own splitter.
_L, _N = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe"
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^ \\t-\\r{_L}{_N}]+")
_BEYOND = re.compile("[^\x00-\x1b\x20-\x84\x86-\x9f\xa1-\u024f]")
_NONE = 1 << 62


def _byte_letters() -> list[str]:
    """The byte alphabet: printable Latin-1 bytes stand for themselves, the others for characters from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class WordBpe:
    """Normalisation, word forms and merges of a tokenizer file with word-end marks (byte alphabet, no decoder)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.end: str = spec["model"]["end_of_word_suffix"] or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        #: rank of a pair of ids, and the id that a rank makes
        self.ranks = {self.vocab[a] << 32 | self.vocab[b]: rank for rank, (a, b) in enumerate(merges)}
        self.made = [self.vocab[a + b] for a, b in merges]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        own = Tokenizer.from_file(path)
        self._normalizer, self._words = own.normalizer, own.pre_tokenizer
        letters = _byte_letters()
        self._inner = [self.vocab[c] for c in letters]
        self._last = [self.vocab[c + self.end] for c in letters]

    def normalized(self, text: str) -> str:
        if _UNUSUAL.search(text) or not unicodedata.is_normalized("NFC", text):
            return self._normalizer.normalize_str(text)
        return text.lower()

    def forms(self, text: str) -> list[str]:
        """The words of a text, which encode independently, and its special tokens."""
        if self._special is None or "<|" not in text:
            return self._words_of(text)
        out: list[str] = []
        for k, part in enumerate(self._special.split(text)):
            out += [part] if k % 2 else self._words_of(part)
        return out

    def _words_of(self, text: str) -> list[str]:
        plain = self.normalized(text)
        if not _BEYOND.search(plain):
            return _WORDS.findall(plain)
        out: list[str] = []
        # Unusual white space separates nothing here unless the normaliser has made it a space.
        for run in plain.split(" ") if _UNUSUAL.search(plain) else plain.split():
            if not _BEYOND.search(run):
                out += _WORDS.findall(run)
            elif run.isalpha():
                out.append(run)
            else:  # offsets count characters, so the words are cut from the run itself
                out += [run[i:j] for _, (i, j) in self._words.pre_tokenize_str(run)]
        return out

    def encode_form(self, form: str) -> list[int]:
        return [self.special[form]] if form in self.special else self._merged(form.encode("utf-8"))

    def _merged(self, word: bytes) -> list[int]:
        """Merges the pair of lowest rank, leftmost first, until none is left."""
        ids = [self._inner[c] for c in word[:-1]]
        ids.append(self._last[word[-1]])
        if len(ids) > 48:
            return self._merged_long(ids)
        rank = self.ranks.get
        pairs = [rank(a << 32 | b, _NONE) for a, b in zip(ids, ids[1:])]
        while pairs and (low := min(pairs)) != _NONE:
            i = pairs.index(low)
            ids[i:i + 2] = [self.made[low]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(ids[i - 1] << 32 | ids[i], _NONE)
            if i < len(pairs):
                pairs[i] = rank(ids[i] << 32 | ids[i + 1], _NONE)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs: n log n in the word's length."""
        rank, n = self.ranks.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.made[r], -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := rank(ids[left] << 32 | ids[right])) is not None:
                    heapq.heappush(heap, (r, left, ids[left], ids[right]))
        return [x for x in ids if x >= 0]

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join([self.tokens[i] for i in ids])


def build_automaton(words: list[bytes]) -> dict[str, np.ndarray]:
    """Minimal acyclic automaton of sorted distinct words, as arrays.

    Arcs are sorted by ``state * 256 + byte`` (``keys``) with target (``to``) and the number of words that sort
    before those behind the arc (``skip``); ``final`` marks states that end a word. The sum of the skips, plus one for
    each final state passed, is the word's position in ``words``.
    """
    register: dict[tuple, int] = {}
    made: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def close(node: list) -> int:
        sign = (node[0], tuple(node[1]))
        if sign not in register:
            register[sign] = len(made)
            made.append(sign)
        return register[sign]

    path: list[list] = [[False, []]]
    last = b""
    for word in words:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        while len(path) > same + 1:
            state = close(path.pop())
            path[-1][1].append((last[len(path) - 1], state))
        path += [[False, []] for _ in word[same:]]
        path[-1][0] = True
        last = word
    while len(path) > 1:
        state = close(path.pop())
        path[-1][1].append((last[len(path) - 1], state))
    root = close(path[0])
    count = np.zeros(len(made), np.int64)
    keys, to, skip = [], [], []
    for state, (final, arcs) in enumerate(made):  # targets are made before their sources
        passed = int(final)
        for byte, target in arcs:
            keys.append(state * 256 + byte)
            to.append(target)
            skip.append(passed)
            passed += int(count[target])
        count[state] = passed
    return {"keys": np.array(keys, np.int64), "to": np.array(to, np.int32), "skip": np.array(skip, np.int32),
            "final": np.array([f for f, _ in made], np.bool_), "root": np.array([root], np.int32)}


class Lexicon:
    """The automaton and the ids of its words, looked up for many words at a time."""

    FILES = ("keys", "to", "skip", "final", "root", "offsets", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.__dict__.update(arrays)

    @classmethod
    def compiled(cls, bpe: WordBpe, words: Iterable[str]) -> dict[str, np.ndarray]:
        coded = {w.encode("utf-8"): w for w in words if w}
        order = sorted(coded)
        ids = [bpe.encode_form(coded[w]) for w in order]
        return build_automaton(order) | {
            "offsets": np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int64),
            "ids": np.array([i for x in ids for i in x], np.uint32)}

    @classmethod
    def mapped(cls, read) -> Lexicon:
        """``read`` gives the path of a file name; the arrays stay on disk and are paged in."""
        return cls({k: np.load(read(k), mmap_mode="r") for k in cls.FILES})

    def find(self, words: list[str]) -> np.ndarray:
        """Positions of words, -1 for those that the automaton does not hold."""
        if not len(self.keys) or not words:
            return np.full(len(words), -1, np.int64)
        coded = [w.encode("utf-8") for w in words]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        order = np.argsort(-size, kind="stable")
        data = np.frombuffer(b"".join(coded), np.uint8)
        start = np.concatenate(([0], np.cumsum(size)[:-1]))[order]
        size = size[order]
        state, index = np.full(len(coded), int(self.root[0]), np.int64), np.zeros(len(coded), np.int64)
        alive = np.arange(len(coded))
        for at in range(int(size[0]) if len(size) else 0):
            alive = alive[size[alive] > at]
            if not len(alive):
                break
            key = state[alive] * 256 + data[start[alive] + at]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            index[alive[~hit]] = -1
            state[alive[~hit]] = -1
            alive, arc = alive[hit], arc[hit]
            index[alive] += self.skip[arc]
            state[alive] = self.to[arc]
        ended = (state >= 0) & (size > 0)
        ended[ended] = self.final[state[ended]]
        index[~ended] = -1
        out = np.empty(len(coded), np.int64)
        out[order] = index
        return out


class Encoder:
    """Encodes and decodes texts; forms come from the table, then the automaton, then the merges."""

    def __init__(self, bpe: WordBpe, lexicon: Lexicon) -> None:
        self.bpe, self.lexicon = bpe, lexicon
        self._ids: dict[str, bytes] = {}
        self._decoded: dict[str, str] = {}

    def batch(self, texts: list[str | None]) -> Iterator[tuple[bytes, str]]:
        """Ids as little-endian 32-bit integers and the decoded text, for each text."""
        forms = [self.bpe.forms(t or "") for t in texts]
        if len(self._ids) > CACHE_WORDS:
            self._ids.clear()
            self._decoded.clear()
        # one by one: the set difference with a dictionary's keys would pass through the whole table for every batch
        new = [f for f in set().union(*forms) if f not in self._ids]
        for form, at in zip(new, self.lexicon.find(new).tolist()):
            if at >= 0:
                ids = self.lexicon.ids[self.lexicon.offsets[at]:self.lexicon.offsets[at + 1]].tolist()
            else:
                ids = self.bpe.encode_form(form)
            self._ids[form], self._decoded[form] = struct.pack(f"<{len(ids)}I", *ids), self.bpe.decode(ids)
        ids_of, decoded_of = self._ids.__getitem__, self._decoded.__getitem__
        for fs in forms:
            yield b"".join(map(ids_of, fs)), " ".join(map(decoded_of, fs))
        for form in new:
            if len(form) > CACHE_CHARS:
                del self._ids[form], self._decoded[form]


_workers: dict[tuple, Encoder] = {}
_tokenizers: dict[str, WordBpe] = {}


def _tokenizer(path: str) -> WordBpe:
    """The tokenizer of a worker, read once and not by every task."""
    if path not in _tokenizers:
        _tokenizers[path] = WordBpe(path)
    return _tokenizers[path]


def _worker(tokenizer: str, name: str) -> Encoder:
    if (tokenizer, name) not in _workers:
        _workers.clear()
        _workers[tokenizer, name] = Encoder(
            _tokenizer(tokenizer), Lexicon.mapped(lambda k: SparkFiles.get(f"{name}-{k}.npy")))
    return _workers[tokenizer, name]


def word_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``form``, ``n``: how often each word form of up to ``CACHE_CHARS`` characters occurs in the documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, counts = _tokenizer(tokenizer), Counter()

        def emit() -> pa.RecordBatch:
            kept = [(f, n) for f, n in counts.items() if len(f) <= CACHE_CHARS]
            return pa.RecordBatch.from_arrays([pa.array([f for f, _ in kept], pa.string()),
                                               pa.array([n for _, n in kept], pa.int64())], names=["form", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(bpe.forms(text or ""))
                if len(counts) > CACHE_WORDS:
                    yield emit()
                    counts.clear()
        if counts:
            yield emit()

    return docs.select("text").mapInArrow(run, "form string, n bigint").groupBy("form").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, words: int) -> list[str]:
    """At most ``words`` forms, the most frequent; where more share the last count, none of them.

    How many forms have each count says which count to start from; only the chosen forms come to the driver.
    """
    chosen, least = 0, None
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("forms")).orderBy(F.desc("n")).toLocalIterator():
        chosen += r["forms"]
        if chosen > words:
            break
        least = r["n"]
    return [] if least is None else sorted(r["form"] for r in counts.where(F.col("n") >= least).select("form").collect())


def ship_lexicon(spark: SparkSession, docs: DataFrame, tokenizer: str, words: int = LEXICON_WORDS) -> str:
    """Compiles the most frequent forms and gives the files to all executors; returns the files' common name.

    Forms are counted over every document. Which forms are in the lexicon only decides how fast they are encoded, never how. The
    files lie in the shared folder until the driver ends.
    """
    counts = stage(spark, word_counts(docs, tokenizer), "forms")
    top = frequent(counts, words)
    release(counts)
    name = f"lexicon-{uuid.uuid4().hex}"
    jvm = spark._jvm
    for key, array in Lexicon.compiled(WordBpe(tokenizer), top).items():
        held = io.BytesIO()
        np.save(held, array)
        path = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}-{key}.npy")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        out = files.create(path, False)
        try:
            out.write(bytearray(held.getvalue()))
        finally:
            out.close()
        files.deleteOnExit(path)
        spark.sparkContext.addFile(str(path))  # every executor fetches it, late ones included
    return name


def encode(docs: DataFrame, tokenizer: str, lexicon: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (little-endian 32-bit integers) and ``decoded`` of every document.

    Null and empty texts have no tokens and decode to an empty text. Rows come back one for one, repeated ids and
    null ids too; further columns are ignored; an empty table gives an empty result. A long word is merged by itself and not kept
    in a worker's table, so memory follows the longest text.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker(tokenizer, lexicon)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                made = list(encoder.batch(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(i) // 4 for i, _ in made], pa.int64()),
                     pa.array([i for i, _ in made], pa.binary()), pa.array([d for _, d in made], pa.string())],
                    names=["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
