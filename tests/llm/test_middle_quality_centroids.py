"""Fill-in-the-middle, document quality and centroids against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronograde.llm import centroids, fill_middle, quality, queries


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# Fill in the middle ---------------------------------------------------------------------------------------------------

def plain_fim(doc_id, text, rate=100, suffix_first=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    pre, mid, suf = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return doc_id, len(lines), "plain", None, None, text
    if h[3] % 100 < suffix_first:
        return doc_id, len(lines), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, len(lines), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


HARD_TEXTS = [None, "", "\n", "\n\n\n", "a", "a\n", "a\nb", "\na", "é\nü\n漢字\n😀😀\n", "\r\n\x00\n\x0b", "x<P>y\nz", "<S>", "a<\nS>b\nc", "<\n<\n<\n",
              "\n" * 40, "ab\n" * 5000 + "end", "😀" * 3000 + "\n" + "\n".join("ñ" * (i % 17) for i in range(2000)), "<\nP>\n<S\n>"]


def test_fill_middle_against_plain(spark):
    rng = random.Random(5)
    texts = HARD_TEXTS + ["".join(rng.choice("ab\n\n é漢😀<PSM>") for _ in range(rng.randrange(60))) for _ in range(1500)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no\nid\n"), (3, "other\ntext\n"), (3, "other\ntext\n"), (-5, "a\nb\nc\nd")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("output", F.lit("clash")).withColumn("form", F.lit(1)).withColumn("h1", F.lit(2))
    for rate, first in ((100, 50), (40, 50), (0, 50), (100, 0), (100, 100)):
        got = fill_middle.transform(docs, rate=rate, suffix_first=first)
        back = got.withColumn("text", fill_middle.restored()).select("doc_id", "text").collect()
        key = lambda r: tuple((x is not None, x) for x in r)
        assert sorted(map(tuple, got.collect()), key=key) == sorted((plain_fim(i, t, rate, first) for i, t in rows), key=key)
        assert sorted(map(tuple, back), key=key) == sorted(((i, t or "") for i, t in rows), key=key)
    assert fill_middle.transform(docs.limit(0)).count() == 0


def test_fill_middle_query_has_whole_table(spark):
    want = {(i, *row[1:5], sha(row[5]), sha(t or "")) for i, t in
            spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect() for row in [plain_fim(i, t)]}
    assert set(map(tuple, queries.op11_fill_middle(spark, SF).collect())) == want


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=200))
def test_marks_rank_and_select(data):
    flat = np.frombuffer(data, np.uint8)
    words = fill_middle.words_of(flat)
    for marks, hit in ((fill_middle.equal_bytes(words, 10), flat == 10), (fill_middle.continuation_bytes(words), flat & 0xC0 == 0x80)):
        m = fill_middle.Marks(marks)
        assert m.rank(np.arange(len(flat) + 1)).tolist() == [int(hit[:i].sum()) for i in range(len(flat) + 1)]
        at = np.flatnonzero(hit)
        assert m.select(np.arange(len(at))).tolist() == at.tolist()


# Quality --------------------------------------------------------------------------------------------------------------

def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else None
    if many is None:
        from collections import Counter
        many = {w for w, n in Counter(windows).items() if n > 1}
    covered = {j for i, w in enumerate(windows) if w in many for j in (i, i + 1, i + 2)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)]


def test_quality_base_counts(spark):
    rng = random.Random(3)
    texts = [None, "", " \t\n\x0b\x0c\r", "a a a a", "a b c a b c", "x\nx\n\n\nx\n y", " a b c\x1cd", "a" * 100_000, "tik tak " * 30_000,
             "#*$%&|<> # |", "a b\r\na b\r\n", " ".join(f"w{i}" for i in range(50)), "z " * 50, "q r s t " * 13]
    texts += [" ".join(rng.choice("abcd|\n😀é") for _ in range(rng.randrange(120))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id here"), (2, "again"), (2, "again")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("kept", F.lit("clash")).withColumn("y", F.lit(9))
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    got = sorted((tuple(r[:7]) for r in quality.judge(docs, none).drop("kept", "quality").collect()), key=repr)
    want = [(i, *b, b[0] < 50 or 100 * b[4] > 50 * b[0]) for i, t in rows for b in [plain_base(t)]]
    assert got == sorted(want, key=repr)
    assert all(r["kept"] == (not r["base_failed"]) for r in quality.judge(docs, none).collect())  # nothing learnt: the rules alone
    assert quality.judge(docs.limit(0), none).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=60), st.integers(0, 1))
def test_repeated_words_when_numbers_are_large(ids, wide):
    ids = np.array(ids, np.int64)
    known = (1 << 40) if wide else 5  # the wide case numbers windows anew
    windows = [tuple(ids[i:i + 3]) for i in range(len(ids) - 2)]
    want = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    assert quality.repeated_words(ids, known) == len(want)


def test_trees_are_monotonic_and_flat():
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 1, (3000, 4))
    y = ((np.sin(7 * x[:, 0]) + x[:, 1] + 0.4 * rng.normal(size=3000)) > 0.8).astype(float)  # not monotonic in the first
    trees = quality.grow(x, y, np.array([-1, 1, 0, 0]), 40)
    grid = np.linspace(0, 1, 200)
    for f, way in ((0, -1), (1, 1)):
        for row in x[:40]:
            line = np.repeat(row[None], len(grid), axis=0)
            line[:, f] = grid
            assert (np.diff(trees.margin(line)) * way >= -1e-12).all()

    def walk(row):
        total = trees.start
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            total += trees.value[node]
        return total

    assert np.allclose(trees.margin(x[:100]), [walk(r) for r in x[:100]])
    free = quality.grow(x, y, np.zeros(4, int), 40)
    assert ((free.score(x) > 0.5) == y).mean() > 0.85


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.expr("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1")
    result = quality.judge(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels.where(~held))
    truth = labels.select("doc_id", F.col("quality").alias("label"))
    seen = result.join(truth, "doc_id").where(held & ~F.col("base_failed")).select("kept", "label").collect()
    good, bad = [r.kept for r in seen if r.label == 1], [r.kept for r in seen if r.label == 0]
    assert len(good) > 1000 and len(bad) > 80
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.03


def test_quality_with_odd_labels(spark):
    text = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(i, text + str(i)) for i in range(30)] + [(None, text)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 0), (3, 7)], "doc_id bigint, quality int")
    assert all(r["kept"] for r in quality.judge(docs, labels).collect())  # no label that counts
    only_bad = spark.createDataFrame([(i, 0) for i in range(10)], "doc_id bigint, quality int")
    assert not any(r["kept"] for r in quality.judge(docs, only_bad).collect())


# Centroids ------------------------------------------------------------------------------------------------------------

def plain_lloyd(rows, k=8, rounds=10, dimensions=64, scale=1024):
    kept = [(i, [math.floor(float(np.float32(x)) * scale) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else sha(f"3:{r[0]}"), r[1]))
    c = [list(v) for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(c)):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine)]
    last = [(i, *near(v)) for i, v in kept]
    total = sum(d for _, d, _ in last)
    return [(i, j, d, sum(e for _, e, o in last if o == j), total, sha(",".join(map(str, c[j])))) for i, d, j in last]


def same(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<float>, cluster string")
    got = sorted(map(tuple, centroids.cluster(df, **options).collect()), key=repr)
    assert got == sorted(plain_lloyd(rows, **options), key=repr)


def test_centroids_against_plain(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=64).round(3).tolist()) for i in range(260)]
    rows += [(None, rows[0][1]), (5, rows[5][1]), (5, rows[9][1]), (300, None), (301, []), (302, [0.5] * 63), (303, [0.5] * 65),
             (304, [None] + [0.0] * 63), (305, [float("nan")] * 64), (306, [float("inf")] + [0.0] * 63), (307, [0.0] * 64), (308, [-0.0] * 64),
             (309, [300.0] * 64), (310, [-120000.0] * 64)]
    monkeypatch.setattr(centroids, "CHUNK", 37)
    same(spark, rows)
    same(spark, rows, k=3, rounds=2)


def test_centroids_odd_shapes(spark):
    rng = np.random.default_rng(8)
    same(spark, [(i, rng.normal(size=21).tolist()) for i in range(60)], dimensions=21, k=5, rounds=4)  # the last block is narrower
    same(spark, [(i, [1.0, 2.0]) for i in range(40)], dimensions=2, k=4, rounds=3)  # all alike: other clusters stay empty
    same(spark, [(i, [float(i)]) for i in range(3)], dimensions=1, k=8, rounds=3)  # fewer vectors than clusters
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert centroids.cluster(empty).collect() == []
    with pytest.raises(Exception, match="not below"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], "vec_id bigint, embedding array<float>")).collect()


