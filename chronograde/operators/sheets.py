"""Grids without whole-document rows: one file may span many tasks.

:mod:`grid` puts each file into one row, which a sheet of a million rows makes as large as the sheet. Here the unit is the sheet row
(bounded by the format's 16,384 columns), hashed by file *and* the strip of ``STRIP`` rows it lies in. What a file needs to know
about itself are a few numbers and its header, found by aggregates that combine on the map side:

* the anchor, as a minimum over row numbers;
* the end of the metric block, by gaps and islands: each strip marks its labelled rows in one number and proposes the strip after
  it; the first row below the anchor that is not marked ends the block;
* the last of repeated keys, by ``max_by`` over row numbers.

They go back to the rows by one join that salts files with very many rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronograde import fixed_values as fv
from chronograde.functions.skew import HOT_ROWS, salted_join
from chronograde.functions.text import clean_text

STRIP_BITS = 5
STRIP = 1 << STRIP_BITS


def _strip() -> Column:
    return F.shiftright("row_idx", STRIP_BITS)


def _shifted(number: int, places: Column) -> Column:
    return F.call_function("shiftleft", F.lit(number).cast("bigint"), places)


def sheet_rows(cells: DataFrame, anchor: str = fv.METRICS_ANCHOR) -> DataFrame:
    """``file_id, row_idx, key, is_anchor, last_col, vals``: cleaned key and non-blank values of each sheet row."""
    is_key = F.col("col_idx") == fv.KEY_COLUMN
    prepared = cells.withColumn("strip", _strip()).repartition("file_id", "strip").select(
        "file_id", "strip", "row_idx", "col_idx", clean_text(F.col("value")).alias("text"),
        (is_key & (F.col("value") == anchor)).alias("at_anchor"),
    )
    is_value = (F.col("col_idx") >= fv.FIRST_VALUE_COLUMN) & F.col("text").isNotNull()
    value = F.struct("col_idx", F.col("text").alias("value"))
    return prepared.groupBy("file_id", "strip", "row_idx").agg(
        F.max(F.when(is_key, F.col("text"))).alias("key"),
        F.max(F.coalesce("at_anchor", F.lit(False))).alias("is_anchor"),
        F.max("col_idx").alias("last_col"),
        F.sort_array(F.collect_list(F.when(is_value, value))).alias("vals"),
    ).drop("strip")


def island_ends(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """``file_id, block_end``: the first row without a label below the anchor, which is labelled itself.

    ``anchors`` has ``file_id, anchor_row`` of each file.
    """
    marks = rows.groupBy("file_id", _strip().alias("strip")).agg(
        F.bit_or(F.when(F.col("key").isNotNull(), _shifted(1, F.col("row_idx").bitwiseAND(STRIP - 1))).otherwise(F.lit(0).cast("bigint"))).alias("marks"))
    after = marks.select("file_id", (F.col("strip") + 1).alias("strip"), F.lit(0).cast("bigint").alias("marks"))
    strips = marks.unionByName(after).groupBy("file_id", "strip").agg(F.bit_or("marks").alias("marks"))
    all_rows = F.lit((1 << STRIP) - 1).cast("bigint")
    above = F.least(F.greatest(F.col("anchor_row") + 1 - F.col("strip") * STRIP, F.lit(0)), F.lit(STRIP))  # rows of the strip not below the anchor
    free = all_rows.bitwiseAND(F.bitwise_not("marks")).bitwiseAND(_shifted(-1, above))
    place = F.bit_count(F.col("free").bitwiseXOR(F.col("free") - 1)) - 1  # of the lowest bit
    return (
        strips.join(anchors, "file_id").withColumn("free", free).filter("free <> 0")
        .groupBy("file_id").agg(F.min(F.col("strip") * STRIP + place).cast("int").alias("block_end"))
    )


def bounds(rows: DataFrame) -> DataFrame:
    """``file_id, anchor_row, block_end, last_col, n_rows, header`` of every file.

    ``block_end`` is the first row below the metric block, ``header`` the non-blank cells of the anchor row.
    """
    files = rows.groupBy("file_id").agg(
        F.min(F.when(F.col("is_anchor"), F.col("row_idx"))).alias("anchor_row"),
        F.max("last_col").alias("last_col"), F.count(F.lit(1)).alias("n_rows"),
    )
    ends = island_ends(rows, files.filter("anchor_row IS NOT NULL").select("file_id", "anchor_row"))
    header = rows.filter("is_anchor").groupBy("file_id").agg(F.min_by("vals", "row_idx").alias("header"))
    return files.join(ends, "file_id", "left").join(header, "file_id", "left")


def placed_rows(
    cells: DataFrame, anchor: str = fv.METRICS_ANCHOR, settle: Callable[[DataFrame, str], DataFrame] = lambda df, _: df,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Sheet rows of files that have an anchor, with their file's bounds. ``settle`` may write a result and read it back."""
    rows = settle(sheet_rows(cells, anchor), "sheet_rows")
    limits = settle(bounds(rows).filter("anchor_row IS NOT NULL"), "bounds")
    # one row a file: as many as the input has files, however few bytes they take on disk
    return salted_join(rows.drop("last_col"), limits, ["file_id"], "n_rows", ["row_idx"], "inner", hot_rows, broadcast=False)


def _texts(vals: str | Column) -> Column:
    return F.transform(vals, lambda v: v["value"])


def metadata_rows(placed: DataFrame) -> DataFrame:
    """``file_id, row_idx, key, vals`` of the labelled rows above the anchor."""
    return placed.filter("row_idx < anchor_row AND key IS NOT NULL").select("file_id", "row_idx", "key", _texts("vals").alias("vals"))


def metadata_last_wins(placed: DataFrame) -> DataFrame:
    """``file_id, key, vals``: of rows with the same key the last."""
    return metadata_rows(placed).groupBy("file_id", "key").agg(F.max_by("vals", "row_idx").alias("vals"))


def lineage(placed: DataFrame, sheet: str = fv.SHEET_NAME) -> DataFrame:
    """``file_id, key, source_sheet, excel_row, n_values`` of each key's last row, 1-based."""
    last = metadata_rows(placed).groupBy("file_id", "key").agg(F.max_by(F.struct("row_idx", F.size("vals").alias("n")), "row_idx").alias("r"))
    return last.select("file_id", "key", F.lit(sheet).alias("source_sheet"), (F.col("r.row_idx") + 1).alias("excel_row"), F.col("r.n").alias("n_values"))


def years(placed: DataFrame) -> DataFrame:
    """``file_id, years``: the non-blank cells of the anchor row, one row a file."""
    return placed.filter("row_idx = anchor_row").select("file_id", _texts("vals").alias("years"), "n_rows", "anchor_row", "last_col", "block_end")


def year_header(placed: DataFrame) -> DataFrame:
    return years(placed).select("file_id", F.posexplode("years").alias("pos", "year_label"))


def _block(placed: DataFrame) -> DataFrame:
    return placed.filter("row_idx > anchor_row AND row_idx < block_end AND key IS NOT NULL")


def metric_block(placed: DataFrame) -> DataFrame:
    """``file_id, row_idx, metric_name`` of the unbroken run of labelled rows right below the anchor."""
    return _block(placed).select("file_id", "row_idx", F.col("key").alias("metric_name"))


def metric_points(placed: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``file_id, metric_name, year_label, value, status``: the i-th year belongs to column ``2 + i``; blanks are null points.

    The header comes with the file's bounds, so nothing is joined here and ``hot_rows`` has no effect: rows are salted where they are placed.
    """
    at = F.map_from_entries("vals")  # column to text
    column = lambda i: i + fv.FIRST_VALUE_COLUMN
    return _block(placed).select("file_id", F.col("key").alias("metric_name"), _texts("header").alias("years"), at.alias("at")).select(
        "file_id", "metric_name", F.try_element_at("at", column(F.size("years"))).alias("status"), "at", F.posexplode("years").alias("i", "year_label"),
    ).select("file_id", "metric_name", "year_label", F.try_element_at("at", column(F.col("i"))).alias("value"), "status")


def extraction_errors(rows: DataFrame, limits: DataFrame, anchor: str = fv.METRICS_ANCHOR) -> DataFrame:
    """``file_id, error`` of files without a document: anchor missing or on top, no years, no status column."""
    n_years = F.size("header")
    status_col = n_years + fv.FIRST_VALUE_COLUMN
    error = (
        F.when(F.col("anchor_row").isNull(), F.lit(f"Anchor '{anchor}' not found in sheet"))
        .when(F.col("anchor_row") == 0, F.lit(fv.MSG_ANCHOR_ON_TOP))
        .when(n_years == 0, F.lit(fv.MSG_NO_YEARS))
        .when((F.col("block_end") > F.col("anchor_row") + 1) & (status_col > F.col("last_col")), F.lit("Status column missing after the last year"))
    )
    return limits.select("file_id", error.alias("error")).filter("error IS NOT NULL")
