"""SimHash near-duplicates by multi-index hashing.

A fingerprint has two 32-bit segments. Two fingerprints that differ in at most three bits differ in at most one
bit of one segment, so every fingerprint enumerates the Hamming ball of radius one around each of its segments
(33 values each), fetches the table entries with such a segment and verifies the complete distance. Copies share
a fingerprint and are collapsed before; documents are joined back only at the end.

A table entry with very many fingerprints (they agree on half their bits) is looked up once more by the other half: its
fingerprints differ there in at most three of 32 bits, so at least one of four bytes is equal, and only fingerprints that agree on
such a byte are compared. See ``links``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronograde.llm.common import components, stage

SEED = 42
WIDTH = 3
DISTANCE = 3
#: Shingles hashed at once; bounds the memory of a very long text.
BLOCK = 1 << 16
#: Fingerprints of a table entry from which on the entry is divided by the bytes of the other segment.
CROWDED = 512
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """64-bit SimHash of the word shingles of a text, repeats counted; null and wordless texts give 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[width - 1:] if len(words) >= width else ends[-1:]
    first = starts[:len(last)]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros((8, 8), np.int64)
    for at in range(0, len(last), BLOCK):
        spans = zip(first[at:at + BLOCK].tolist(), last[at:at + BLOCK].tolist())
        hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], dtype="<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            ones[k] += np.bincount(hashes[:, k], minlength=256) @ _BITS
    bits = (ones.ravel() * 2 > len(last)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = WIDTH, carry: str | None = None) -> DataFrame:
    """``doc_id``, ``fp`` (the 64 bits as a signed long) of every document, and the bigint column ``carry`` if named."""
    more = [carry] if carry else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]], names=["doc_id", "fp", *more])

    return docs.select("doc_id", "text", *more).mapInArrow(run, "doc_id bigint, fp bigint" + "".join(f", {c} bigint" for c in more))


def _segments(fp) -> list:
    """The two segments of a fingerprint as table keys; the segment number is in bit 32."""
    return [F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit((1 << 32) - 1)).bitwiseOR(F.lit(1 << 32))]


def links(fps: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Pairs ``a < b`` of different fingerprints (column ``fp``, each once) with at most ``DISTANCE`` differing bits.

    The table has two rows a fingerprint and the probes 66, whatever the data. A pair is kept by the probe of its
    smaller member only; it may come more than once. Entries of ``crowded`` fingerprints or more, if there are any, are looked up
    with four bytes more.
    """
    held = fps.select(F.col("fp").alias("b"), F.explode(F.array(*_segments(F.col("fp")))).alias("key"))
    ball = [s if i is None else s.bitwiseXOR(F.lit(1 << i))
            for s in _segments(F.col("fp")) for i in (None, *range(32))]
    probes = fps.select(F.col("fp").alias("a"), F.explode(F.array(*ball)).alias("key"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE)
    full = stage(fps.sparkSession, held.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= crowded).select("key"), "crowded")
    if full.isEmpty():
        return probes.join(held, "key").where(near).select("a", "b")
    rest = probes.join(held.join(full, "key", "left_anti"), "key").where(near).select("a", "b")

    def divided(rows: DataFrame, fp: str) -> DataFrame:
        """Each row four times, with a byte of the segment that is not its key and the byte's place."""
        upper = F.col("key") < F.lit(1 << 32)  # the key is the upper segment
        other = F.when(upper, F.col(fp)).otherwise(F.shiftrightunsigned(fp, 32)).bitwiseAND(F.lit((1 << 32) - 1))
        part = [F.shiftrightunsigned(other, 8 * i).bitwiseAND(F.lit(255)).bitwiseOR(F.lit(i << 8)) for i in range(4)]
        return rows.join(full, "key", "left_semi").select(fp, "key", F.explode(F.array(*part)).alias("part"))

    return rest.union(divided(probes, "a").join(divided(held, "b"), ["key", "part"]).where(near).select("a", "b"))


def _components(fps: DataFrame) -> DataFrame:
    """``fp``, ``root``: the smallest fingerprint that links reach, for each different fingerprint."""
    own = fps.select("fp").distinct()
    roots = components(fps.sparkSession, links(own))
    return own.join(roots, own["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def classes(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, one row per input row.

    ``component_id`` is the smallest ``doc_id`` that links reach, the document itself included. A null, empty or
    wordless text has fingerprint zero and is linked like any other; rows without ``doc_id`` take part, and a group
    of only such rows has a null ``component_id``. An empty table gives an empty result; repeated rows come back
    repeated; further columns are ignored.
    """
    fps = stage(docs.sparkSession, fingerprints(docs, width), "fingerprints")
    own = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    placed = _components(fps).join(own, "fp")
    lowest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(lowest, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row of ``docs`` for each group: that with the smallest ``doc_id``, rows without one coming last.

    Of rows that share the id, the one with the smallest hash of its text stays; rows that share id and text are one
    document and give one row. Null, empty and wordless texts are one group. An empty table gives an empty result.
    """
    mark = next(x for x in (f"text_{k}" for k in range(len(docs.columns) + 1)) if x not in docs.columns)
    marked = docs.withColumn(mark, F.xxhash64("text"))
    fps = stage(docs.sparkSession, fingerprints(marked, width, mark).withColumnRenamed(mark, "mark"), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")
    firsts = fps.groupBy("fp").agg(F.min(row).alias("first")).join(_components(fps), "fp").groupBy("root").agg(F.min("first").alias("f"))
    kept = firsts.select(F.col("f.doc_id").alias("kept_id"), F.col("f.mark").alias(mark)).distinct()
    named = marked.join(kept, (marked["doc_id"].eqNullSafe(kept["kept_id"])) & (marked[mark] == kept[mark]), "left_semi")
    return named.dropDuplicates(["doc_id", mark]).select(docs.columns)
