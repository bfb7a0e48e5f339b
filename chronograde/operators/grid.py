"""Free-form grids to documents: anchor search, metadata map, lineage, metric matrix.

Input is the long table ``cells(file_id, row_idx, col_idx, value)`` with 0-based positions. One scan and one
shuffle by file serve everything: cells are grouped into sheet rows and rows into documents inside the
same partitions, without a join. A document is one output row by definition, so all of a file meets in
one task in any plan; the file format bounds it (1,048,576 rows of 16,384 cells), which is why files are
not salted. Queries that need no whole document (:func:`anchor_rows`, :func:`files_without_anchor`,
:func:`clean_cells`) do not assemble any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronograde import fixed_values as fv
from chronograde.functions.text import clean_text, json_text


def clean_cells(cells: DataFrame) -> DataFrame:
    """Each cell with its cleaned value."""
    return cells.withColumn("cleaned", clean_text(F.col("value")))


def anchor_rows(cells: DataFrame, anchor: str = fv.METRICS_ANCHOR) -> DataFrame:
    """First row of each file whose key column is exactly the anchor text (filter reaches the scan)."""
    return (
        cells.filter((F.col("col_idx") == fv.KEY_COLUMN) & (F.col("value") == anchor))
        .groupBy("file_id")
        .agg(F.min("row_idx").alias("anchor_row"))
    )


def files_without_anchor(files: DataFrame, cells: DataFrame, anchor: str = fv.METRICS_ANCHOR) -> DataFrame:
    """Files in which the anchor text does not occur."""
    return files.join(anchor_rows(cells, anchor), "file_id", "left_anti").select(
        "file_id", F.lit(f"Anchor '{anchor}' not found in sheet").alias("error")
    )


def sheet_rows(cells: DataFrame, anchor: str = fv.METRICS_ANCHOR) -> DataFrame:
    """One row per sheet row: cleaned key, non-blank values with their columns, anchor flag, width."""
    is_key = F.col("col_idx") == fv.KEY_COLUMN
    # Cleaned once per cell, before the grouping refers to it several times. The partitioning by file also
    # serves the grouping of rows into documents.
    prepared = cells.repartition("file_id").select(
        "file_id", "row_idx", "col_idx", clean_text(F.col("value")).alias("text"),
        (is_key & (F.col("value") == anchor)).alias("at_anchor"),
    )
    is_value = (F.col("col_idx") >= fv.FIRST_VALUE_COLUMN) & F.col("text").isNotNull()
    return prepared.groupBy("file_id", "row_idx").agg(
        F.max(F.when(is_key, F.col("text"))).alias("key"),
        F.max("at_anchor").alias("is_anchor"),
        F.max("col_idx").alias("last_col"),
        F.sort_array(
            F.collect_list(F.when(is_value, F.struct("col_idx", F.col("text").alias("value"))))
        ).alias("vals"),
    )


def documents(cells: DataFrame, anchor: str = fv.METRICS_ANCHOR) -> DataFrame:
    """One row per file: ``anchor_row, last_col, years, meta_rows, metric_rows, error``.

    ``meta_rows`` are the labelled rows above the anchor, ``metric_rows`` the unbroken run of labelled
    rows right below it. ``error`` says why a file has no document; null means it was extracted.
    """
    labelled = F.col("key").isNotNull() | F.col("is_anchor")
    at = F.min(F.when(F.col("is_anchor"), F.col("row_idx")))
    rows = F.sort_array(F.collect_list(F.when(labelled, F.struct("row_idx", "key", "vals"))))
    texts = lambda vals: F.transform(vals, lambda v: v["value"])
    above = F.filter(rows, lambda r: (r["row_idx"] < at) & r["key"].isNotNull())
    below = F.filter(rows, lambda r: (r["row_idx"] > at) & r["key"].isNotNull())
    # All of it is output of the aggregate itself: filters on these columns stay above the aggregate
    # instead of repeating the array work below it.
    return sheet_rows(cells, anchor).groupBy("file_id").agg(
        at.alias("anchor_row"),
        F.max("last_col").alias("last_col"),
        texts(F.get(F.filter(rows, lambda r: r["row_idx"] == at), 0)["vals"]).alias("years"),
        F.transform(above, lambda r: F.struct(
            r["row_idx"].alias("row_idx"), r["key"].alias("key"), texts(r["vals"]).alias("vals")
        )).alias("meta_rows"),
        F.filter(below, lambda r, i: r["row_idx"] == at + 1 + i).alias("metric_rows"),
    ).withColumn("error", _extraction_error(anchor))


def _extraction_error(anchor: str) -> Column:
    status_col = F.size("years") + fv.FIRST_VALUE_COLUMN
    return (
        F.when(F.col("anchor_row").isNull(), F.lit(f"Anchor '{anchor}' not found in sheet"))
        .when(F.col("anchor_row") == 0, F.lit(fv.MSG_ANCHOR_ON_TOP))
        .when(F.size("years") == 0, F.lit(fv.MSG_NO_YEARS))
        .when(
            (F.size("metric_rows") > 0) & (status_col > F.col("last_col")),
            F.lit("Status column missing after the last year"),
        )
    )


def _last_wins(entries: Column, key: str) -> Column:
    """Drop entries whose key occurs again later in the array; the keys are only searched where one is repeated."""
    keys = F.transform(entries, lambda e: e[key])
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(_without_repeats(entries, key, F.reverse(keys)))


def _without_repeats(entries: Column, key: str, backwards: Column) -> Column:
    """``backwards`` are the keys of ``entries`` from last to first."""
    return F.filter(entries, lambda e, i: F.size(backwards) - F.array_position(backwards, e[key]) == i)


def _final_meta_rows(docs: DataFrame) -> DataFrame:
    """Add ``final_meta_rows``: of rows with the same key only the last. The key list is a column of its
    own, so it is built once per document and not once per row."""
    keyed = docs.withColumn("_keys", F.reverse(F.transform("meta_rows", lambda r: r["key"])))
    return keyed.withColumn("final_meta_rows", _without_repeats(F.col("meta_rows"), "key", F.col("_keys"))).drop("_keys")


def with_metadata(docs: DataFrame) -> DataFrame:
    """Add ``metadata map<string,array<string>>``; the last row of a repeated key wins."""
    entries = F.transform("final_meta_rows", lambda r: F.struct(r["key"].alias("key"), r["vals"].alias("value")))
    return _final_meta_rows(docs).withColumn("metadata", F.map_from_entries(entries)).drop("final_meta_rows")


def with_lineage(docs: DataFrame, sheet: str = fv.SHEET_NAME) -> DataFrame:
    """Add ``lineage map<key, struct<source_sheet, excel_row, excel_columns>>`` with 1-based positions.

    Columns count the compacted values, so they shift left of the true ones when a row has gaps.
    """
    def trace(r: Column) -> Column:
        n = F.size(r["vals"])
        columns = F.when(n > 0, F.sequence(F.lit(3), n + 2)).otherwise(F.array().cast("array<int>"))
        return F.struct(
            r["key"].alias("key"),
            F.struct(
                F.lit(sheet).alias("source_sheet"),
                (r["row_idx"] + 1).alias("excel_row"),
                columns.alias("excel_columns"),
            ).alias("value"),
        )

    return _final_meta_rows(docs).withColumn(
        "lineage", F.map_from_entries(F.transform("final_meta_rows", trace))
    ).drop("final_meta_rows")


def with_metrics(docs: DataFrame) -> DataFrame:
    """Add ``metrics array<struct<name, points array<struct<year,value>>, status>>``.

    The i-th year belongs to column ``2 + i``; blank cells stay as null points.
    """
    def value_at(vals: Column, col: Column) -> Column:
        # without gaps, the cell of column 2 + i is element i; only rows with gaps are searched
        direct = F.get(vals, col - fv.FIRST_VALUE_COLUMN)
        searched = F.get(F.filter(vals, lambda v: v["col_idx"] == col), 0)["value"]
        return F.when(direct["col_idx"] == col, direct["value"]).otherwise(searched)

    def metric(r: Column) -> Column:
        points = F.transform(
            "years",
            lambda y, i: F.struct(y.alias("year"), value_at(r["vals"], i + fv.FIRST_VALUE_COLUMN).alias("value")),
        )
        status = value_at(r["vals"], F.size("years") + fv.FIRST_VALUE_COLUMN)
        return F.struct(r["key"].alias("name"), points.alias("points"), status.alias("status"))

    return docs.withColumn("metrics", F.transform("metric_rows", metric))


# --- long-form views of the documents ------------------------------------------------------------


def metadata_rows(docs: DataFrame) -> DataFrame:
    """``file_id, row_idx, key, vals`` for every labelled row above the anchor."""
    return _unnested(docs, "meta_rows").select("file_id", "item.*")


def metadata_shape(docs: DataFrame) -> DataFrame:
    """Cardinality of each metadata value: no value, one value, or a list."""
    n = F.size("vals")
    return metadata_rows(docs).select(
        "file_id", "row_idx", "key",
        F.when(n == 0, "null").when(n == 1, "scalar").otherwise("list").alias("shape"),
        F.when(n == 1, F.get("vals", 0)).alias("scalar_value"),
        n.alias("n_values"),
    )


def metadata_last_wins(docs: DataFrame) -> DataFrame:
    return with_metadata(docs).select("file_id", F.explode_outer("metadata").alias("key", "vals")).filter("key IS NOT NULL")


def year_header(docs: DataFrame) -> DataFrame:
    return docs.select("file_id", F.posexplode("years").alias("pos", "year_label"))


def metric_block(docs: DataFrame) -> DataFrame:
    return _unnested(docs, "metric_rows").select(
        "file_id", F.col("item.row_idx").alias("row_idx"), F.col("item.key").alias("metric_name")
    )


def metric_points(docs: DataFrame) -> DataFrame:
    """``file_id, metric_name, year_label, value, status``: the metric matrix in long form."""
    metrics = _unnested(with_metrics(docs), "metrics")
    return metrics.select(
        "file_id", F.col("item.name").alias("metric_name"), F.inline("item.points").alias("year_label", "value"),
        F.col("item.status").alias("status"),
    )


def metric_status(docs: DataFrame) -> DataFrame:
    return _unnested(with_metrics(docs), "metrics").select(
        "file_id", F.col("item.name").alias("metric_name"), F.col("item.status").alias("status")
    )


def _unnested(docs: DataFrame, column: str) -> DataFrame:
    """One row per array element. The outer form keeps the optimizer from testing the array's size in a
    pushed-down filter, which would compute a derived array twice."""
    return docs.select("file_id", F.explode_outer(column).alias("item")).filter(F.col("item").isNotNull())


# --- payload text --------------------------------------------------------------------------------


def metadata_pairs(metadata: Column) -> Column:
    """``"key":value`` texts in key order: no value is null, one value a string, several values a list."""
    def shaped(vals: Column) -> Column:
        return (
            F.when(F.size(vals) == 0, F.lit("null"))
            .when(F.size(vals) == 1, json_text(F.get(vals, 0)))
            .otherwise(F.to_json(vals))
        )

    return F.transform(
        F.array_sort(F.map_entries(metadata)), lambda e: F.concat(json_text(e["key"]), F.lit(":"), shaped(e["value"]))
    )


def metadata_json(metadata: Column) -> Column:
    """JSON object text of :func:`metadata_pairs`."""
    return F.concat(F.lit("{"), F.array_join(metadata_pairs(metadata), ","), F.lit("}"))


def metrics_json(years: Column, metrics: Column) -> Column:
    """``{"years":[..],"metrics":{name:{year:value..,"status":..}}}``; repeated names or years: last wins."""
    def text_or_null(v: Column) -> Column:
        return F.coalesce(json_text(v), F.lit("null"))

    def one(m: Column) -> Column:
        points = F.transform(
            _last_wins(m["points"], "year"), lambda p: F.concat(json_text(p["year"]), F.lit(":"), text_or_null(p["value"]))
        )
        status = F.concat(F.lit('"status":'), text_or_null(m["status"]))
        body = F.array_join(F.concat(points, F.array(status)), ",")
        return F.concat(json_text(m["name"]), F.lit(":{"), body, F.lit("}"))

    return F.concat(
        F.lit('{"years":'), F.to_json(years), F.lit(',"metrics":{'),
        F.array_join(F.transform(_last_wins(metrics, "name"), one), ","), F.lit("}}"),
    )


def document_json(metadata: Column, years: Column, metrics: Column) -> Column:
    """The payload of one sheet: ``{"metadata":{..},"scopeCreditMetrics":{"years":[..],"metrics":{..}}}``."""
    return F.concat(
        F.lit(f'{{"{fv.METADATA_KEY}":'), metadata_json(metadata), F.lit(f',"{fv.METRICS_KEY}":'), metrics_json(years, metrics), F.lit("}")
    )
