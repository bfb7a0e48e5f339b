"""Derived views that give the generic test tables the shapes of this engine.

An order is a submission of its customer, its line items are the industry vector and the metric facts,
documents are landed files, events are file outcomes. Small side tables are only broadcast where their
size is fixed (nations); the optimizer decides on the others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronograde import fixed_values as fv
from chronograde.operators.rules import Rule, RuleSet

FIXTURE_ANCHOR = "[METRICS]"
FIXTURE_YEARS = list(range(1995, 2002))
METRIC_ROWS = {"A": 9, "N": 10}
OTHER_METRIC_ROW = 11
STATUS_COLUMN = 2 + len(FIXTURE_YEARS)

LABELS = {
    0: "Rated entity", 1: "Country of origin", 2: "CorporateSector", 3: "Accounting principles",
    4: "Reporting Currency/Units", 5: fv.INDUSTRY_FIELD, 6: fv.WEIGHT_FIELD, 7: fv.SCORE_FIELD, 13: "Notes",
}

# Domains deliberately leave out values of the test tables, so that violations occur. Random weights do
# not add up to 100, hence the chain over these views runs without the allocation total.
FIXTURE_RULES = RuleSet(
    rules=(
        Rule("Rated entity", required=True),
        Rule("Country of origin", required=True, allowed=[f"NATION_{i}" for i in range(24)]),
        Rule("CorporateSector", required=True, allowed=["MACHINERY", "BUILDING", "AUTOMOBILE", "FURNITURE", "HOUSEHOLD"]),
        Rule(fv.INDUSTRY_FIELD, required=True, allowed=["STANDARD", "ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"], kind="list"),
        Rule(fv.SCORE_FIELD, allowed=["O", "F", ""], default=""),
        Rule(fv.WEIGHT_FIELD, default="0", value_range=(0.0, 40.0)),
        Rule("Reporting Currency/Units", required=True, allowed=["O", "F", "P"]),
        Rule("Accounting principles", required=True, allowed=["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]),
    ),
    expected_rows=3,
    allocation_total=None,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def subs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = [table(spark, sf_dir, t) for t in ("orders", "customer", "nation")]
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("submission_id"), F.col("c_name").alias("natural_key"),
            F.col("n_name").alias("country_of_origin"), F.col("c_mktsegment").alias("sector"),
            F.col("o_orderpriority").alias("accounting_principles"), F.col("o_orderstatus").alias("currency"),
            F.lit("December").alias("year_end"), F.col("o_orderdate").alias("submitted_at"),
        )
    )


def _as_read(df: DataFrame, *_: str) -> DataFrame:
    return df


def inds(spark: SparkSession, sf_dir: str, place: Callable[..., DataFrame] = _as_read) -> DataFrame:
    """``place`` may arrange the line items by their order before they are grouped."""
    lineitem, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    items = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "p_type", "l_quantity", "l_linestatus")
    return (
        place(items, "l_orderkey")
        .groupBy(F.col("l_orderkey").alias("submission_id"), F.col("l_linenumber").alias("pos"))
        .agg(
            F.min("p_type").alias("sector"), F.min("l_quantity").cast("bigint").alias("weight"),
            F.min("l_linestatus").alias("score"),
        )
    )


def metrics(spark: SparkSession, sf_dir: str, place: Callable[..., DataFrame] = _as_read) -> DataFrame:
    """``place`` may arrange the line items by their order before they are grouped."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", F.year("l_shipdate").alias("calendar_year"), "l_extendedprice", "l_linestatus")
    return (
        place(items, "l_orderkey")
        .groupBy(F.col("l_orderkey").alias("submission_id"), F.col("l_returnflag").alias("metric_name"), "calendar_year")
        .agg(
            F.max("l_extendedprice").cast("decimal(18,4)").alias("metric_value"),
            F.max("l_linestatus").alias("processing_status"),
        )
        .withColumn("is_forecast", F.col("calendar_year") >= 2000)
    )


def filelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("n_chars") % 3 == 0
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ingest_seq"), F.col("source").alias("run_id"), F.col("text").alias("content"),
        F.when(failed, "failure").otherwise("success").alias("verdict"),
        F.when(failed, fv.STAGE_VALIDATION).otherwise(fv.STAGE_TRANSFORM).alias("stage"),
    )


def cells(spark: SparkSession, sf_dir: str, by_file: bool = False) -> DataFrame:
    """A grid per submission; see FIXTURES.md. Fixed rows come from literal arrays, not from cross joins.

    ``by_file`` gives the same cells in partitions of ``file_id``: orders and line items are shuffled, of which there are far fewer,
    and not the cells made of them. Spark then leaves out the shuffle of what is grouped by file.
    """
    place = DataFrame.repartition if by_file else _as_read
    s, i, m = place(subs(spark, sf_dir), "submission_id"), inds(spark, sf_dir, place), metrics(spark, sf_dir, place)

    def cell(row, col, value):
        return F.struct(
            F.lit(row).cast("int").alias("row_idx") if isinstance(row, int) else row.cast("int").alias("row_idx"),
            F.lit(col).cast("int").alias("col_idx") if isinstance(col, int) else col.cast("int").alias("col_idx"),
            (F.lit(value) if isinstance(value, str) else value).alias("value"),
        )

    labels = [cell(row, 1, text) for row, text in LABELS.items()]
    scalars = [
        cell(0, 2, F.col("natural_key")),
        cell(1, 2, F.concat(F.lit("  "), F.col("country_of_origin"), F.lit(" "))),
        cell(2, 2, F.col("sector")), cell(3, 2, F.col("accounting_principles")), cell(4, 2, F.col("currency")),
    ]
    years = [cell(8, 2 + y - 1995, f"{y}E" if y >= 2000 else str(y)) for y in FIXTURE_YEARS]
    has_anchor = F.col("file_id") % 97 != 0
    anchor = F.when(has_anchor, F.array(cell(8, 1, FIXTURE_ANCHOR))).otherwise(F.array().cast("array<struct<row_idx:int,col_idx:int,value:string>>"))
    sheet = s.withColumnRenamed("submission_id", "file_id").select(
        "file_id", F.inline(F.concat(F.array(*labels, *scalars, *years), anchor))
    )

    weight = F.when(F.col("weight") % 10 == 0, "n/a").otherwise(F.col("weight").cast("string"))
    col = F.col("pos") + 1
    vectors = i.select(
        F.col("submission_id").alias("file_id"),
        F.inline(F.array(cell(5, col, F.col("sector")), cell(6, col, weight), cell(7, col, F.col("score")))),
    )

    # name and status cells appear once per metric: they are written with the metric's first year
    name = F.col("metric_name")
    row = F.lit(OTHER_METRIC_ROW)
    for flag, at in METRIC_ROWS.items():
        row = F.when(name == flag, at).otherwise(row)
    matrix = (
        m.groupBy("submission_id", "metric_name")
        .agg(F.collect_list(F.struct("calendar_year", "metric_value")).alias("points"))
        .select(
            F.col("submission_id").alias("file_id"),
            F.inline(F.concat(
                F.array(cell(row, 1, name), cell(row, STATUS_COLUMN, "Locked")),
                F.transform("points", lambda p: cell(
                    row, p["calendar_year"] - 1993, p["metric_value"].cast("string")
                )),
            )),
        )
    )
    return sheet.unionByName(vectors).unionByName(matrix)


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions with a JSON document. Every third one has the fallback shape without ``metadata``.

    Orders and line items are shuffled once each, by order; what is grouped and joined by order then needs no further shuffle.
    """
    place = DataFrame.repartition
    s, i, m = place(subs(spark, sf_dir), "submission_id"), inds(spark, sf_dir, place), metrics(spark, sf_dir, place)
    vector = i.groupBy("submission_id").agg(
        F.sort_array(F.collect_list(F.struct(
            "pos", "sector", F.concat(F.col("weight").cast("string"), F.lit("%")).alias("w"), "score"
        ))).alias("v")
    ).select("submission_id", F.transform("v", lambda x: F.struct(
        x["sector"].alias("sector"), x["w"].alias(fv.WEIGHT_FIELD), x["score"].alias(fv.SCORE_FIELD)
    )).alias("industries"))
    label = F.when(F.col("is_forecast"), F.concat(F.col("calendar_year").cast("string"), F.lit("E"))).otherwise(
        F.col("calendar_year").cast("string")
    )
    matrix = (
        m.groupBy("submission_id", "metric_name")
        .agg(
            F.sort_array(F.collect_list(F.struct(label.alias("y"), F.col("metric_value").cast("string").alias("v")))).alias("p"),
            F.max("processing_status").alias("status"),
        )
        .withColumn("points", F.map_from_entries(F.concat("p", F.array(F.struct(F.lit("status").alias("y"), F.col("status").alias("v"))))))
        .groupBy("submission_id")
        .agg(F.sort_array(F.collect_list(F.struct("metric_name", F.map_entries("points").alias("e")))).alias("m"))
        .select("submission_id", F.map_from_entries(F.transform("m", lambda x: F.struct(
            x["metric_name"].alias("key"), F.map_from_entries(x["e"]).alias("value")
        ))).alias("metrics"))
    )
    joined = s.join(vector, "submission_id", "left").join(matrix, "submission_id", "left")
    entity = {label: F.col(name) for name, label in fv.ENTITY_FIELDS.items()}
    profile = {
        "Business risk profile": F.col("accounting_principles"),
        "Liquidity": F.col("currency"),
    }
    full = F.to_json(F.struct(
        F.struct(*[c.alias(n) for n, c in {**entity, **profile}.items()],
                 F.col("industries").alias(fv.INDUSTRY_FIELD)).alias(fv.METADATA_KEY),
        F.struct(F.col("metrics").alias("metrics")).alias(fv.METRICS_KEY),
    ))
    fallback = F.to_json(F.struct(
        F.struct(*[c.alias(n) for n, c in entity.items()]).alias(fv.FALLBACK_KEY),
        F.struct(F.col("metrics").alias("metrics")).alias(fv.METRICS_KEY),
    ))
    return joined.select(
        "submission_id", "submitted_at",
        F.when(F.col("submission_id") % 3 == 0, fallback).otherwise(full).alias("parsed_data"),
    )


def file_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file log as events: one row per processed file."""
    kind = F.col("event_type")
    outcome = F.when(kind == "error", "FAILURE").when(kind == "signup", "SKIPPED").otherwise("SUCCESS")
    message = (
        F.when(kind == "error", F.concat(F.lit("Value violation on '"), F.col("props"), F.lit("'")))
        .when(kind == "signup", fv.MSG_DUPLICATE)
    )
    stage = F.when(kind == "error", fv.STAGE_VALIDATION).when(kind == "signup", fv.STAGE_INITIAL).otherwise(fv.STAGE_TRANSFORM)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("run_id"),
        F.concat(F.lit("file_"), F.col("event_id").cast("string"), F.lit(".xlsm")).alias("file_name"),
        F.col("ts").alias("processed_at"), outcome.alias("outcome"), F.col("event_id").alias("submission_id"),
        stage.alias("execution_stage"), message.alias("error_message"),
    )
