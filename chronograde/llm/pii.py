"""Personal data: fixed formats, and identifiers found by patterns that those formats' surroundings induce.

The base formats are regular expressions with checks. Their matches are seeds: each seed's neighbouring words are
lexical patterns (word before, word after). Patterns and instances form a bipartite graph with one edge for
each pattern an instance occurs with. Scores go back and forth for ``ROUNDS`` rounds: a pattern is as good as the
share of all its occurrences in the corpus that are good instances, an instance is good if one of its patterns is.
Confident patterns then mark identifier-like words next to them that no base format covers, with the kind of the seeds.
Everything is a DataFrame expression; nothing runs in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronograde.llm.common import stage

KINDS = ("email", "ip", "card", "phone")
#: Fixed formats. Atomic runs and the start conditions only save retries that cannot succeed; matches are the same.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MARK = {"email": "@", "phone": "+"}
#: A word that could be an identifier: at least six characters, one of them a digit or an at sign.
CANDIDATE = r"(?<!\S)(?:[^\s0-9@]*+)[0-9@]\S*+"
#: Characters next to a span in which a whole neighbouring word must stand to be a pattern.
CONTEXT = 64
#: Characters of a piece that texts are cut into to look at places in them; more than a context.
CELL = 256
ROUNDS = 4
#: A pattern is used if so many different seeds support it and so large a share of its occurrences is good.
SUPPORT = 4
CONFIDENCE = 0.6
STEP = 256


def _located(text: Column, pattern: str) -> Column:
    """Matches of a pattern in order: value, start and end in code points, end exclusive.

    The pieces between matches and the matches cover the text; positions are running sums of their lengths, taken
    over blocks of ``STEP`` matches first, so a text with very many matches stays cheap.
    """
    return F.transform(
        F.array(F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))),
        lambda x: F.transform(
            F.array(F.struct(x["hits"].alias("hits"), F.zip_with(F.slice(x["gaps"], F.lit(1), F.size(x["hits"])), x["hits"],
                    lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("long"))).alias("sizes"))),
            lambda y: F.transform(
                F.array(F.struct(y["hits"].alias("hits"), y["sizes"].alias("sizes"), F.aggregate(
                    F.sequence(F.lit(0), F.floor(F.size(y["sizes"]) / STEP).cast("int")), F.array(F.lit(0)),
                    lambda acc, k: F.concat(acc, F.array(F.element_at(acc, -1) + F.aggregate(
                        F.slice(y["sizes"], k * STEP + 1, F.lit(STEP)), F.lit(0), lambda a, s: a + s["gap"] + s["long"])))).alias("base"))),
                lambda z: F.transform(z["hits"], lambda h, i: F.struct(
                    h.alias("value"),
                    (F.get(z["base"], F.floor(i / STEP).cast("int")) + F.aggregate(
                        F.slice(z["sizes"], F.floor(i / STEP).cast("int") * STEP + 1, i % STEP), F.lit(0), lambda a, s: a + s["gap"] + s["long"])
                     + F.get(z["sizes"], i)["gap"]).alias("start"),
                    F.length(h).alias("long"))))[0])[0])[0]


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    value = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda acc, i: acc + F.when(
        (n - i) % 2 == 0, F.substring(digits, i, F.lit(1)).cast("int")).otherwise(
        F.get(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substring(digits, i, F.lit(1)).cast("int"))))
    return value % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":  # compared as text first, so that a part of any length is safe
        return F.forall(F.split(value, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+(?=.)", "")).between(1, 3)
                        & (F.lpad(F.regexp_replace(p, "^0+(?=.)", ""), 3, "0") <= "255"))
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15)


def base_spans(text: Column, kind: str) -> Column:
    """Array of (start, order, kind, value, end) of one base format; empty where the text has none."""
    found = F.filter(_located(text, PATTERNS[kind]), lambda m: _valid(kind, m["value"]))
    made = F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"), F.lit(kind).alias("kind"),
        m["value"].alias("value"), (m["start"] + m["long"]).alias("end")))
    there = text.contains(MARK[kind]) if kind in MARK else text.rlike("[0-9]")
    empty = F.array().cast("array<struct<start:int,place:int,kind:string,value:string,end:int>>")
    return F.when(there, made).otherwise(empty)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _bare(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), r"^[^\p{L}]++|(?<=\p{L})[^\p{L}]++$", "")


def _cells(text: Column) -> Column:
    """A text in pieces of ``CELL`` characters, so that a place in it is found without counting from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CELL}}}"), F.lit(0))


def _between(cells: Column, start: Column, long: int) -> Column:
    """``long`` characters from ``start`` on (fewer at the text's ends), at most ``CELL``; before the start there are none."""
    first = F.greatest(start, F.lit(0))
    at = F.floor(first / CELL).cast("int")
    both = F.concat(F.coalesce(F.get(cells, at), F.lit("")), F.coalesce(F.get(cells, at + 1), F.lit("")))
    return F.substring(both, (first - at * CELL + 1).cast("int"), (F.lit(long) + F.least(start, F.lit(0))).cast("int"))


def _neighbours(cells: Column, start: Column, end: Column) -> list[Column]:
    """The bare words before and after a span, empty where none ends within ``CONTEXT`` characters."""
    # One character more than a context: a word that reaches its edge does not end there, and is no pattern.
    before, after = _between(cells, start - CONTEXT - 1, CONTEXT + 1), _between(cells, end, CONTEXT + 1)
    left = F.regexp_extract(F.when(start > CONTEXT, before).otherwise(F.concat(F.lit(" "), before)), r"\s(\S++)\s*$", 1)
    right = F.regexp_extract(F.when(F.length(after) > CONTEXT, after).otherwise(F.concat(after, F.lit(" "))), r"^\s*+(\S++)\s", 1)
    return [_bare(left).alias("l"), _bare(right).alias("r")]


def _contexts(rows: DataFrame) -> DataFrame:
    """One row for each pattern next to a span: ``side`` and ``word``, the neighbouring word."""
    sides = F.array(F.struct(F.lit("<").alias("side"), F.col("l").alias("word")), F.struct(F.lit(">").alias("side"), F.col("r").alias("word")))
    return rows.select("key", "kind", "value", "start", "end", "seed", F.explode(sides).alias("p")) \
        .where("p.word <> ''").select("key", "kind", "value", "start", "end", "seed", F.col("p.side").alias("side"), F.col("p.word").alias("word"))


def patterns(edges: DataFrame, totals: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT) -> DataFrame:
    """Scores of patterns (``kind``, ``side``, ``word``, ``score``) with enough different seeds.

    ``edges``: kind, side, word, value, seed, n (occurrences); ``totals``: word and its occurrences in the corpus.
    """
    spark = edges.sparkSession
    key = ["kind", "side", "word"]
    held = edges.groupBy(*key).agg(F.sum(F.col("seed").cast("int")).alias("seeds")).where(F.col("seeds") >= support)
    held = held.join(totals, "word").select(*key, "total")
    graph = stage(spark, edges.join(held, key), "graph")
    score = None
    for _ in range(rounds):
        if score is None:
            worth = graph.withColumn("good", F.col("seed").cast("double"))
        else:
            instance = graph.where("NOT seed").join(score, key).groupBy("kind", "value").agg(F.max("score").alias("good"))
            worth = graph.join(instance, ["kind", "value"], "left").withColumn(
                "good", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("good", F.lit(0.0))))
        score = stage(spark, worth.groupBy(*key, "total").agg(F.sum(F.col("n") * F.col("good")).alias("good"))
                      .select(*key, F.least(F.col("good") / F.col("total"), F.lit(1.0)).alias("score")), "patterns")
    return score


def find(docs: DataFrame, confidence: float = CONFIDENCE) -> DataFrame:
    """``doc_id``, counts of base spans by kind, ``base_sha256`` and ``spans`` of every row, one for one.

    Found spans are words of at least six characters with a digit or an at sign, next to a word that is a pattern; a
    neighbouring word counts if it ends within ``CONTEXT`` characters. Regular expressions look at each character a bounded number
    of times, so time is linear in a text. Null and empty texts have no spans. Spans are ``kind:start:end`` in code points, ordered by start and then kind;
    found ones follow the same order and never overlap a base span. Further columns are ignored; rows may repeat.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    base = F.concat(*[base_spans(F.col("text"), k) for k in KINDS])
    rows = docs.select("doc_id", text.alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    # A key is the id and the whole text, so rows that share one share every span.
    marked = stage(spark, rows.where(F.col("text").rlike("[0-9@]")).select("key", "text", F.sort_array(base).alias("base")), "base")
    held = marked.select("key", "text", "base", F.explode(F.array(_cells(F.col("text")))).alias("cells"))
    seeds = held.select("key", F.explode(F.transform("base", lambda s: F.struct(
        s["kind"].alias("kind"), s["value"].alias("value"), s["start"].alias("start"), s["end"].alias("end"), *_neighbours(F.col("cells"), s["start"], s["end"])))).alias("s")) \
        .select("key", "s.*", F.lit(True).alias("seed"))

    def trimmed(m: Column) -> Column:
        value = F.regexp_replace(m["value"], r"^[^\p{L}\p{N}@]++|(?<=[\p{L}\p{N}])[^\p{L}\p{N}]++$", "")
        return F.struct(value.alias("value"), (m["start"] + F.length(F.regexp_extract(m["value"], r"^[^\p{L}\p{N}@]*+", 0))).alias("start"))

    fits = lambda w: (F.length(w["value"]) >= 6) & w["value"].rlike("[0-9@]")
    words = stage(spark, held.select("key", "cells", F.filter(F.transform(_located(F.col("text"), CANDIDATE), trimmed), fits).alias("w")).select(
        "key", F.explode(F.transform("w", lambda w: F.struct(
            w["value"].alias("value"), w["start"].alias("start"), (w["start"] + F.length(w["value"])).alias("end"),
            *_neighbours(F.col("cells"), w["start"], w["start"] + F.length(w["value"]))))).alias("w")).select("key", "w.*"), "words")
    # Spans meet in the cells they cover; a word that overlaps a base span is part of it.
    covers = lambda start, end: F.explode(F.sequence(F.floor(start / CELL), F.floor((end - 1) / CELL)))
    taken = marked.select("key", F.explode("base").alias("b")).select("key", F.col("b.start").alias("from"), F.col("b.end").alias("to"), covers(F.col("b.start"), F.col("b.end")).alias("cell"))
    overlapping = words.select("key", "start", "end", covers(F.col("start"), F.col("end")).alias("cell")).join(
        taken, ["key", "cell"]).where("start < to AND end > from").select("key", "start", "end").distinct()
    free = words.join(overlapping, ["key", "start", "end"], "left_anti").select(
        "key", "start", "value", "end", "l", "r", F.lit(False).alias("seed"), F.explode(F.array(*[F.lit(k) for k in KINDS])).alias("kind"))
    cols = ["key", "kind", "value", "start", "end", "seed", "l", "r"]
    near = stage(spark, _contexts(seeds.select(*cols).union(free.select(*cols))), "contexts")
    # A run of other characters parts words if there is white space in it; each run is looked at once.
    gap = r"(?<![^\p{L}])(?=[^\p{L}\s]*+\s)[^\p{L}]++"
    totals = rows.select(F.explode(F.split(F.lower("text"), gap)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("total"))
    edges = near.groupBy("kind", "side", "word", "value", "seed").agg(F.count(F.lit(1)).alias("n"))
    good = patterns(edges, totals).where(F.col("score") >= confidence).select("kind", "side", "word")
    found = near.where("NOT seed").join(good, ["kind", "side", "word"]).groupBy("key", "start", "end") \
        .agg(F.min(F.when(F.col("kind") == "email", 0).when(F.col("kind") == "ip", 1).when(F.col("kind") == "card", 2).otherwise(3)).alias("place"))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    extra = found.groupBy("key").agg(F.collect_set(F.struct("start", "place", F.get(kinds, F.col("place")).alias("kind"), F.lit("").alias("value"), "end")).alias("extra"))
    own = marked.select("key", "base").dropDuplicates(["key"]).join(extra, "key", "left")
    none = F.array().cast("array<struct<start:int,place:int,kind:string,value:string,end:int>>")
    b, e = F.coalesce("base", none), F.coalesce("extra", none)

    def count(kind: str) -> Column:
        return F.size(F.filter(b, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return rows.select("doc_id", "key").join(own, "key", "left").select(
        "doc_id", *map(count, KINDS), F.sha2(_joined(b), 256).alias("base_sha256"), _joined(F.sort_array(F.concat(b, e))).alias("spans"))
