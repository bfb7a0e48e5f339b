"""The sliced neighbours must equal plain windows, also when one key holds most rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chronograde.functions.skew import salted_join
from chronograde.functions.timeline import Timeline


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = []
    for i in range(4000):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(300)}"
        rows.append((key, rng.randrange(40), i, rng.choice("ab"), rng.choice([None, None, None, i])))
    return spark.createDataFrame(rows, "key string, t int, id int, v string, mark int").repartition(7).cache()


@pytest.mark.parametrize("rows_per_slice, max_cuts", [(1, 4096), (5, 4096), (50, 64), (3, 10), (1 << 20, 4096)])
def test_neighbours_match_windows(skewed, rows_per_slice, max_cuts):
    line = Timeline(["key"], ["t", "id"], rows_per_slice, max_cuts)
    df = line.split(skewed)
    df = line.previous(df, "before", F.col("v"))
    df = line.following(df, "after", F.col("v"))
    df = Timeline.unsplit(line.fill_forward(df, {"latest": F.col("mark")}))
    w = Window.partitionBy("key").orderBy("t", "id")
    plain = (
        skewed.withColumn("before", F.lag("v").over(w)).withColumn("after", F.lead("v").over(w))
        .withColumn("latest", F.last("mark", True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    )
    assert sorted(map(str, df.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_hot_key_is_sliced_and_rare_keys_are_not(skewed):
    line = Timeline(["key"], ["t", "id"], 100)
    sizes = line.split(skewed).groupBy("key", "_slice").count().collect()
    hot = [r["count"] for r in sizes if r["key"] == "hot"]
    assert len(hot) > 5 and max(hot) < 0.5 * sum(hot)
    cuts = len(sizes) - len({r["key"] for r in sizes})
    assert cuts <= 4096


def test_cut_points_are_bounded(skewed):
    line = Timeline(["key"], ["t", "id"], 1, max_cuts=16)
    sizes = line.split(skewed).groupBy("key", "_slice").count().count()
    assert sizes <= 301 + 16


def test_salted_join_keeps_every_row(skewed):
    right = skewed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    joined = salted_join(skewed, right, ["key"], "n", spread_by=["id"], hot_rows=50)
    plain = skewed.join(right, "key", "left")
    assert sorted(map(str, joined.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
