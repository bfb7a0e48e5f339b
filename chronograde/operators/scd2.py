"""Hash-based type-2 history for entities, profiles and industries, for all submissions at once.

Comparing each submission with "the current row" and expiring it on change equals, over the ordered
submissions of one entity, a new version wherever the hash differs from the row before. A profile
version also starts wherever an entity version does, so one pass over one partitioning yields both
levels; industries hang off their profile version. Windows run on a :class:`Timeline`, which keeps an
entity with very many submissions parallel.

Surrogate keys are the id of the submission that opened the version: unique (a submission opens at most
one version per level), stable under re-runs, and free of any global numbering.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronograde import fixed_values as fv
from chronograde import schemas
from chronograde.functions.hashing import industry_hash, industry_vector_hash, joined_hash
from chronograde.functions.text import beyond_numeric, calendar_year, parse_weight
from chronograde.functions.timeline import Timeline

ENTITY_COLUMNS = list(fv.ENTITY_FIELDS)
PROFILE_COLUMNS = list(fv.PROFILE_FIELDS)

LOAD_ORDER = Timeline(["natural_key"], ["load_rank", "submitted_at", "submission_id"])


# --- projections of the payload ------------------------------------------------------------------


def parse_payload(submissions: DataFrame) -> DataFrame:
    """Add ``payload``, the typed part of ``parsed_data`` the warehouse needs (one parse per document)."""
    return submissions.withColumn("payload", F.from_json("parsed_data", schemas.PAYLOAD))


def entity_columns() -> dict[str, Column]:
    """Entity attributes: ``metadata`` first, then the fallback sub-document."""
    def pick(label: str) -> Column:
        return F.coalesce(F.col(f"payload.{fv.METADATA_KEY}")[label], F.col(f"payload.{fv.FALLBACK_KEY}")[label])

    return {name: pick(label) for name, label in fv.ENTITY_FIELDS.items()}


def profile_columns() -> dict[str, Column]:
    return {name: F.col(f"payload.{fv.METADATA_KEY}")[label] for name, label in fv.PROFILE_FIELDS.items()}


def industry_vector() -> Column:
    """Ordered industries with parsed weights; a missing vector is empty."""
    raw = F.coalesce(
        F.col(f"payload.{fv.METADATA_KEY}")[fv.INDUSTRY_FIELD], F.array().cast(T.ArrayType(schemas.INDUSTRY))
    )
    return F.transform(raw, lambda i: F.struct(
        i["sector"].alias("sector"),
        parse_weight(i[fv.WEIGHT_FIELD]).alias("weight"),
        i[fv.SCORE_FIELD].alias("score"),
    ))


def entity_hash() -> Column:
    return joined_hash(ENTITY_COLUMNS)


def profile_hash() -> Column:
    return joined_hash([*PROFILE_COLUMNS, "industry_aggregate_hash_key"])


def warehouse_rows(submissions: DataFrame) -> DataFrame:
    """Everything the dimensions and facts need from each submission, without the document itself."""
    return warehouse_rows_of(submissions, keep=["submitted_at"])


def warehouse_rows_of(submissions: DataFrame, keep: Sequence[str]) -> DataFrame:
    projected = parse_payload(submissions).select(
        "submission_id", *keep,
        *[c.alias(n) for n, c in entity_columns().items()],
        *[c.alias(n) for n, c in profile_columns().items()],
        industry_vector().alias("industries"),
        F.col(f"payload.{fv.METRICS_KEY}.metrics").alias("metrics"),
    )
    return (
        projected
        .withColumn("industry_aggregate_hash_key", industry_vector_hash(F.col("industries")))
        .withColumn("entity_hash_key", entity_hash())
        .withColumn("profile_hash_key", profile_hash())
    )


def transform_error() -> Column:
    """Why a parsed submission cannot enter the warehouse; null if it can."""
    def repeated_year(points: Column) -> Column:
        years = F.transform(F.filter(F.map_keys(points), lambda y: y != "status"), calendar_year)
        return (F.size(F.array_distinct(years)) < F.size(years)) | F.exists(years, lambda y: y.isNull())

    def too_large(points: Column) -> Column:
        return F.exists(F.map_entries(points), lambda e: (e["key"] != "status") & beyond_numeric(e["value"]))

    all_points = F.coalesce(F.map_values("metrics"), F.array().cast("array<map<string,string>>"))
    has_fact = F.exists(all_points, lambda p: F.exists(F.map_keys(p), lambda y: y != "status"))
    return (
        F.when(F.col("natural_key").isNull(), F.lit("Rated entity is missing"))
        .when(F.exists("industries", lambda i: i["sector"].isNull()), F.lit("Industry without a sector name"))
        .when(F.exists("industries", lambda i: i["weight"].isNull()), F.lit("Industry weight is not a number"))
        .when(F.exists(all_points, repeated_year), F.lit("Year label repeated or without digits"))
        .when(F.exists(all_points, too_large), F.lit("Metric value has more than 14 digits before the point"))
        .when((F.size("industries") == 0) | ~has_fact, F.lit(fv.MSG_TRANSFORM))
    )


# --- history -------------------------------------------------------------------------------------


def batch_rows(rows: DataFrame) -> DataFrame:
    """New submissions as candidate versions; they follow every stored version of their entity."""
    return rows.withColumns({
        "load_rank": F.lit(1),
        "opened_entity": F.col("submission_id"), "entity_from": F.col("submitted_at"),
        "opened_profile": F.col("submission_id"), "profile_from": F.col("submitted_at"),
    })


def stored_rows(dim_entities: DataFrame, dim_profiles: DataFrame) -> DataFrame:
    """Current stored versions in the same shape, so that they start each entity's timeline."""
    e = dim_entities.filter("is_current").select(
        F.col("entity_key").alias("opened_entity"), F.col("valid_from").alias("entity_from"),
        F.col("submission_id").alias("entity_submission"), "entity_hash_key", *ENTITY_COLUMNS,
    )
    p = dim_profiles.filter("is_current").select(
        F.col("entity_key").alias("opened_entity"), F.col("profile_key").alias("opened_profile"),
        F.col("valid_from").alias("profile_from"), "profile_hash_key", "industry_aggregate_hash_key",
        *PROFILE_COLUMNS,
    )
    return e.join(p, "opened_entity", "left").withColumns({
        "load_rank": F.lit(0),
        "submitted_at": F.greatest("entity_from", "profile_from"),
        "submission_id": F.col("entity_submission"),
    }).drop("entity_submission")


def annotate_versions(rows: DataFrame, timeline: Timeline = LOAD_ORDER) -> DataFrame:
    """Mark where versions start and give every row its ``entity_key`` and ``profile_key``."""
    placed = timeline.split(rows.filter(F.col("natural_key").isNotNull()))
    compared = timeline.previous(placed, "before", F.struct("entity_hash_key", "profile_hash_key"))
    same_entity = F.col("before").isNotNull() & F.col("entity_hash_key").eqNullSafe(F.col("before.entity_hash_key"))
    same_profile = same_entity & F.col("profile_hash_key").eqNullSafe(F.col("before.profile_hash_key"))
    flagged = (
        compared
        .withColumn("entity_changed", ~same_entity)
        .withColumn("profile_changed", ~same_profile)
        .drop("before")
    )
    return timeline.fill_forward(flagged, {
        "entity_key": F.when(F.col("entity_changed"), F.col("opened_entity")),
        "profile_key": F.when(F.col("profile_changed"), F.col("opened_profile")),
    })


def scd2_history(
    df: DataFrame, keys: Sequence[str], hash_column: str, order: Sequence[str], valid_from: str,
    rows_per_slice: int = LOAD_ORDER.rows_per_slice,
) -> DataFrame:
    """Generic one-level history: rows where ``hash_column`` changes, with validity columns added."""
    timeline = Timeline(list(keys), list(order), rows_per_slice)
    compared = timeline.previous(timeline.split(df), "before", F.struct(hash_column))
    changed = compared.filter(
        F.col("before").isNull() | ~F.col(hash_column).eqNullSafe(F.col(f"before.{hash_column}"))
    ).drop("before")
    return Timeline.unsplit(_with_validity(timeline.following(changed, "valid_to", F.col(valid_from)), valid_from))


def _with_validity(versions: DataFrame, valid_from: str) -> DataFrame:
    return versions.withColumn("valid_from", F.col(valid_from)).withColumn("is_current", F.col("valid_to").isNull())


def entity_history(annotated: DataFrame, timeline: Timeline = LOAD_ORDER) -> DataFrame:
    versions = timeline.following(annotated.filter("entity_changed"), "valid_to", F.col("entity_from"))
    return _with_validity(versions, "entity_from").select(
        "entity_key", "natural_key", F.col("natural_key").alias("entity_name"),
        *[c for c in ENTITY_COLUMNS if c != "natural_key"],
        "entity_hash_key", "is_current", "valid_from", "valid_to", F.col("entity_key").alias("submission_id"),
    )


def _profile_versions(annotated: DataFrame, timeline: Timeline, close_children: bool) -> DataFrame:
    following = timeline.following(
        annotated.filter("profile_changed"), "_next", F.struct("entity_key", "profile_from")
    )
    ends = F.lit(True) if close_children else F.col("_next.entity_key") == F.col("entity_key")
    versions = following.withColumn("valid_to", F.when(ends, F.col("_next.profile_from"))).drop("_next")
    return _with_validity(versions, "profile_from")


def profile_history(
    annotated: DataFrame, timeline: Timeline = LOAD_ORDER, close_children: bool = True
) -> DataFrame:
    """Profile versions. ``close_children=False`` leaves profiles of a replaced entity version current."""
    return _profile_versions(annotated, timeline, close_children).select(
        "profile_key", "entity_key", "natural_key", "entity_hash_key", "profile_hash_key",
        "industry_aggregate_hash_key", *PROFILE_COLUMNS,
        "is_current", "valid_from", "valid_to", F.col("profile_key").alias("submission_id"),
    )


def industry_history(
    annotated: DataFrame, timeline: Timeline = LOAD_ORDER, close_children: bool = True
) -> DataFrame:
    """Industries of every profile version opened by the batch.

    An industry is unique per (profile, sector, hash) and a profile version reads one vector, so
    ``array_distinct`` before the explode does the insert-if-absent without a shuffle.
    """
    opened = _profile_versions(annotated, timeline, close_children).filter(F.col("load_rank") == 1)
    return (
        opened.withColumn("i", F.explode(F.array_distinct("industries")))
        .withColumn("industry_hash_key", industry_hash(F.col("i.sector"), F.col("i.weight"), F.col("i.score")))
        .select(
            F.xxhash64("profile_key", "i.sector", "industry_hash_key").alias("industry_profile_key"),
            "profile_key", "profile_hash_key", "industry_hash_key", "industry_aggregate_hash_key",
            F.col("i.sector").alias("sector_name"), F.col("i.weight").alias("industry_weight_percentage"),
            F.col("i.score").alias("industry_risk_score"),
            "is_current", "valid_from", "valid_to", F.col("profile_key").alias("submission_id"),
        )
    )


def close_industries(current: DataFrame, profiles: DataFrame) -> DataFrame:
    """Stored current industries with the validity end of their profile."""
    ends = profiles.select("profile_key", F.col("valid_to").alias("_end"))
    return (
        current.join(ends, "profile_key", "left")
        .withColumn("valid_to", F.col("_end"))
        .withColumn("is_current", F.col("_end").isNull())
        .select(*schemas.DIM_INDUSTRIES.fieldNames())
    )


def merge_dimensions(
    rows: DataFrame, dim_entities: DataFrame, dim_profiles: DataFrame, dim_industries: DataFrame,
    timeline: Timeline = LOAD_ORDER, close_children: bool = True,
    settle: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> dict[str, DataFrame]:
    """Merge a batch into stored dimensions.

    ``settle`` may write the annotated timeline and read it back: all dimensions and the facts derive from
    it, so writing it once saves their repeating the shuffle by entity.

    Returns the rows to keep *besides* the already closed ones, per dimension: current versions (possibly
    closed now) and new versions; plus ``annotated``, the batch with its keys. Closed rows never change,
    so a merge reads and rewrites only the current part of each dimension, in one shuffle by entity.
    """
    stored = stored_rows(dim_entities, dim_profiles)
    annotated = settle(annotate_versions(batch_rows(rows).unionByName(stored, allowMissingColumns=True), timeline))
    profiles = profile_history(annotated, timeline, close_children)
    industries = close_industries(dim_industries.filter("is_current"), profiles).unionByName(
        industry_history(annotated, timeline, close_children)
    )
    return {
        "dim_entities": entity_history(annotated, timeline),
        "dim_profiles": profiles,
        "dim_ind_profile": industries,
        "annotated": annotated.filter(F.col("load_rank") == 1),
    }


def insert_if_absent(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``target``; of equal keys the first by ``order`` is kept."""
    keys = list(keys)
    rest = [c for c in incoming.columns if c not in keys]
    first = incoming.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return first.join(target.select(*keys), keys, "left_anti").select(*keys, "_row.*")


def current_keys(dim: DataFrame, key_column: str, where: str, value) -> DataFrame:
    """Surrogate keys of the current rows with ``where == value``."""
    return dim.filter(F.col("is_current") & (F.col(where) == value)).select(key_column)
