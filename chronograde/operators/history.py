"""Read queries over the dimensions and facts. Dates such as "today" are parameters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronograde import fixed_values as fv
from chronograde.functions.text import trimmed
from chronograde.functions.timeline import Timeline

COMPANY = [
    "natural_key", "entity_name", "country_of_origin", "is_current", "valid_from", "valid_to", "submission_id",
]


def _with_document(entities: DataFrame, submissions: DataFrame) -> DataFrame:
    return entities.join(submissions.select("submission_id", "parsed_data"), "submission_id", "left")


def metadata_document(parsed_data: Column) -> Column:
    """The ``metadata`` sub-document if it is an object, else the whole document, else ``{}``."""
    inner = F.get_json_object(parsed_data, f"$.{fv.METADATA_KEY}")
    return F.coalesce(
        F.when(F.startswith(inner, F.lit("{")), inner),
        F.when(F.startswith(parsed_data, F.lit("{")), parsed_data),
        F.lit("{}"),
    )


def companies(entities: DataFrame, submissions: DataFrame) -> DataFrame:
    """Company details: dimension columns plus the metadata document of the opening submission."""
    return _with_document(entities, submissions).select(*COMPANY, metadata_document(F.col("parsed_data")).alias("metadata"))


def active_companies(dim: DataFrame, submissions: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """A page of current entities by name. The page is cut before documents are joined."""
    page = dim.filter("is_current").orderBy("entity_name", "entity_key").offset(offset).limit(limit)
    return companies(page, submissions).orderBy("entity_name")


def company(dim: DataFrame, submissions: DataFrame, company_id: str | int) -> DataFrame:
    """Current entity by surrogate key if the id is a number, else by natural key."""
    try:
        match = F.col("entity_key") == int(company_id)
    except (TypeError, ValueError):
        match = F.col("natural_key") == company_id
    return companies(dim.filter(F.col("is_current") & match), submissions)


def entity_versions(dim: DataFrame, natural_key: str) -> DataFrame:
    return (
        dim.filter(F.col("natural_key") == natural_key)
        .select("submission_id", "valid_from", "valid_to", "is_current")
        .orderBy(F.col("valid_from").desc(), F.col("submission_id").desc())
    )


def pit_versions(dim: DataFrame, as_of: date, keys: Sequence[str] | None = None) -> DataFrame:
    """Every version touching the day (both ends inclusive), optionally for some trimmed keys."""
    day = F.lit(as_of)
    rows = dim.filter(
        (F.col("valid_from").cast("date") <= day)
        & ((F.col("valid_to").cast("date") >= day) | F.col("valid_to").isNull())
    )
    if keys is None:
        return rows
    wanted = [k.strip() for k in keys if k]
    return rows.filter(trimmed(F.col("natural_key")).isin(wanted))


def pit_compare(
    dim: DataFrame, submissions: DataFrame, as_of: date, keys: Sequence[str] | None = None
) -> DataFrame:
    return companies(pit_versions(dim, as_of, keys), submissions)


def pit_latest(dim: DataFrame, as_of: Column, keys: Sequence[str] | None = None) -> DataFrame:
    """The one version of each key valid at an instant: ``valid_from <= as_of < valid_to``."""
    rows = dim.filter((F.col("valid_from") <= as_of) & ((F.col("valid_to") > as_of) | F.col("valid_to").isNull()))
    return rows if keys is None else rows.filter(trimmed(F.col("natural_key")).isin([k.strip() for k in keys if k]))


def pit_join(points: DataFrame, dim: DataFrame, rows_per_slice: int = 1 << 16) -> DataFrame:
    """For each ``(natural_key, as_of, point_id)`` the entity version valid then (null before the first).

    Points and versions are merged into one timeline and the latest version is carried forward: one
    shuffle, no pairs of points and versions, and a key with very many rows is sliced.
    """
    versions = dim.select(
        "natural_key", F.col("valid_from").alias("as_of"), F.lit(0).alias("kind"),
        F.col("entity_key").alias("point_id"), F.col("entity_key").alias("version"),
    )
    probes = points.select(
        "natural_key", "as_of", F.lit(1).alias("kind"), "point_id", F.lit(None).cast("bigint").alias("version")
    )
    timeline = Timeline(["natural_key"], ["as_of", "kind", "point_id"], rows_per_slice)
    filled = timeline.fill_forward(
        timeline.split(versions.unionByName(probes)), {"entity_key": F.col("version")}
    )
    return filled.filter(F.col("kind") == 1).select("natural_key", "as_of", "point_id", "entity_key")


def metric_history(
    facts: DataFrame, dim: DataFrame, company_id: str | None = None, metrics: Sequence[str] | None = None
) -> DataFrame:
    """One point per company, metric and year; the newest entity version, then the newest fact wins.

    ``company_id`` is a case-insensitive pattern (``%`` and ``_`` are wildcards); without it all
    companies are returned. Facts are reduced per entity version before they meet the dimension.
    """
    rows = facts if not metrics else facts.filter(F.col("metric_name").isin(list(metrics)))
    entities = dim.select("entity_key", "natural_key", "valid_from")
    if company_id is not None:
        entities = entities.filter(F.ilike(trimmed(F.col("natural_key")), F.lit(company_id.strip())))
        rows = rows.join(entities.select("entity_key"), "entity_key", "left_semi")
    return newest_points(version_points(rows, entities))


def version_points(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """The newest point of every entity version, metric and year, with the version's natural key and start."""
    point = ["year_label", "metric_value", "metric_value_formatted", "is_forecast", "processing_status"]
    per_version = facts.groupBy("entity_key", "metric_name", "calendar_year").agg(
        F.max_by(F.struct(*point), F.struct("updated_at", "submission_id")).alias("point")
    )
    return per_version.join(dim.select("entity_key", "natural_key", "valid_from"), "entity_key")


def newest_points(points: DataFrame) -> DataFrame:
    """Of the points of a company's versions the newest version's."""
    return (
        points.groupBy("natural_key", "metric_name", "calendar_year")
        .agg(F.max_by("point", F.struct("valid_from", "entity_key")).alias("point"))
        .select("natural_key", "metric_name", "calendar_year", "point.*")
    )


def nested_history(history: DataFrame) -> DataFrame:
    """One row per company and metric with its points in year order (at most one point per year)."""
    point = F.struct(
        "calendar_year", "year_label", "metric_value", "metric_value_formatted", "is_forecast", "processing_status"
    )
    return history.groupBy("natural_key", "metric_name").agg(F.sort_array(F.collect_list(point)).alias("history"))


def snapshots(
    dim: DataFrame, company_id: str | None = None, from_date: date | None = None, to_date: date | None = None,
    sector: str | None = None, country: str | None = None, currency: str | None = None,
) -> DataFrame:
    """Snapshot list with optional filters. ``to_date`` bounds the end of validity."""
    rows = dim
    if company_id:
        rows = rows.filter(F.ilike(trimmed(F.col("natural_key")), F.lit(company_id.strip())))
    if from_date:
        rows = rows.filter(F.col("valid_from").cast("date") >= F.lit(from_date))
    if to_date:
        rows = rows.filter((F.col("valid_to").cast("date") <= F.lit(to_date)) | F.col("valid_to").isNull())
    if country:
        rows = rows.filter(F.ilike("country_of_origin", F.lit(country.strip())))
    if sector:
        rows = rows.filter(F.ilike("sector", F.lit(f"%{sector.strip()}%")))
    if currency:
        rows = rows.filter(F.ilike("currency", F.lit(currency.strip())))
    return rows.select(*COMPANY, "sector", "currency").orderBy(
        "natural_key", F.col("valid_from").desc(), F.col("submission_id").desc()
    )


def snapshots_exact(
    dim: DataFrame, submissions: DataFrame, today: date, company_id: str | None = None,
    from_date: date | None = None, to_date: date | None = None, sector: str | None = None,
    country: str | None = None, currency: str | None = None,
) -> DataFrame:
    """Snapshot documents with exact filters. ``to_date`` bounds the start of validity."""
    rows = dim
    for column, value in [("natural_key", company_id), ("country_of_origin", country),
                          ("sector", sector), ("currency", currency)]:
        if value:
            rows = rows.filter(F.col(column) == value)
    if from_date:
        rows = rows.filter(F.col("valid_from") >= F.lit(from_date).cast("timestamp_ntz"))
    if to_date:
        rows = rows.filter(F.col("valid_from") <= F.lit(to_date).cast("timestamp_ntz"))
    return _snapshot_documents(rows, submissions, F.coalesce(F.col("valid_from").cast("date"), F.lit(today)))


def snapshot(dim: DataFrame, submissions: DataFrame, snapshot_id: int, today: date) -> DataFrame:
    """One version, current or not, by surrogate key."""
    rows = dim.filter(F.col("entity_key") == snapshot_id)
    return _snapshot_documents(rows, submissions, F.coalesce(F.col("valid_from").cast("date"), F.lit(today)))


def latest_snapshots(dim: DataFrame, submissions: DataFrame, today: date) -> DataFrame:
    return _snapshot_documents(dim.filter("is_current"), submissions, F.lit(today))


def _snapshot_documents(entities: DataFrame, submissions: DataFrame, as_of: Column) -> DataFrame:
    return _with_document(entities, submissions).select(
        F.col("entity_key").alias("snapshot_id"), F.col("natural_key").alias("company_id"),
        as_of.alias("as_of_date"), F.coalesce("parsed_data", F.lit("{}")).alias("data"),
    )
