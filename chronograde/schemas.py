"""Fixed schemas: the long cell table, the parsed payload and the warehouse tables.

The bytes of landed files have a table of their own next to the file log: they are written once, straight
from the scan, and never move through a shuffle.
"""

from __future__ import annotations

from pyspark.sql import types as T

from chronograde import fixed_values as fv

STR, LONG, INT, BOOL, DBL, NTZ = (
    T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.DoubleType(), T.TimestampNTZType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


CELLS = _struct(file_id=LONG, row_idx=INT, col_idx=INT, value=STR)

INDUSTRY = T.StructType([
    T.StructField("sector", STR),
    T.StructField(fv.WEIGHT_FIELD, STR),
    T.StructField(fv.SCORE_FIELD, STR),
])

# The slice of the payload document that the warehouse reads; one from_json call fetches all of it.
# Every attribute is declared as text, so a list-valued attribute arrives as its JSON text.
PAYLOAD = T.StructType([
    T.StructField(fv.METADATA_KEY, T.StructType(
        [T.StructField(label, STR) for label in [*fv.ENTITY_FIELDS.values(), *fv.PROFILE_FIELDS.values()]]
        + [T.StructField(fv.INDUSTRY_FIELD, T.ArrayType(INDUSTRY))]
    )),
    T.StructField(fv.FALLBACK_KEY, T.StructType(
        [T.StructField(label, STR) for label in fv.ENTITY_FIELDS.values()]
    )),
    T.StructField(fv.METRICS_KEY, T.StructType([
        T.StructField("metrics", T.MapType(STR, T.MapType(STR, STR))),
    ])),
])

SUBMISSIONS = _struct(
    submission_id=LONG, filename=STR, final_status=STR, current_status=STR, current_status_time=NTZ,
    submitted_at=NTZ, execution_duration_seconds=T.DecimalType(18, 3), file_metadata=STR,
    parsed_data=STR, lineage_trace=STR, run_id=LONG,
)
AUDIT_LOG = _struct(
    id=LONG, filename=STR, submission_id=LONG, execution_status=STR, processed_records=LONG,
    error_message=STR, started_at=NTZ, completed_at=NTZ,
)
SUBMISSION_ERRORS = _struct(submission_id=LONG, error_no=INT, filename=STR, error_message=STR)

_VALIDITY = dict(is_current=BOOL, valid_from=NTZ, valid_to=NTZ, submission_id=LONG)

DIM_ENTITIES = _struct(
    entity_key=LONG, natural_key=STR, entity_name=STR, country_of_origin=STR, sector=STR,
    accounting_principles=STR, currency=STR, year_end=STR, entity_hash_key=STR, **_VALIDITY,
)
DIM_PROFILES = _struct(
    profile_key=LONG, entity_key=LONG, natural_key=STR, entity_hash_key=STR, profile_hash_key=STR,
    industry_aggregate_hash_key=STR, **{c: STR for c in fv.PROFILE_FIELDS}, **_VALIDITY,
)
DIM_INDUSTRIES = _struct(
    industry_profile_key=LONG, profile_key=LONG, profile_hash_key=STR, industry_hash_key=STR,
    industry_aggregate_hash_key=STR, sector_name=STR, industry_weight_percentage=DBL,
    industry_risk_score=STR, **_VALIDITY,
)
FACTS = _struct(
    fact_metric_key=LONG, entity_key=LONG, profile_key=LONG, industry_aggregate_hash_key=STR,
    submission_id=LONG, metric_name=STR, year_label=STR, calendar_year=INT, is_forecast=BOOL,
    metric_value=T.DecimalType(18, 4), metric_value_formatted=STR, processing_status=STR, updated_at=NTZ,
)
RUNS = _struct(
    run_id=LONG, started_at=NTZ, status=STR, total_files=LONG, success_count=LONG,
    failure_count=LONG, skipped_count=LONG,
)
FILE_LOG = _struct(
    id=LONG, run_id=LONG, file_name=STR, processed_at=NTZ, outcome=STR, submission_id=LONG,
    execution_stage=STR, error_message=STR, path=STR, checksum=STR, route=STR,
)
FILE_CONTENTS = _struct(
    run_id=LONG, path=STR, filename=STR, file_size=LONG, modified_at=NTZ, checksum=STR, content=T.BinaryType(),
)
# Contents that were loaded successfully, by checksum: what the duplicate test needs of all earlier batches.
KNOWN_CONTENTS = _struct(checksum=STR, submission_id=LONG)

# Trigram postings of natural keys, and counters of the reports that are kept up to date.
NAME_GRAMS = _struct(gram=STR, name=STR)
GRAM_COUNTS = _struct(gram=STR, names=LONG)
REPORT_UPLOADS = _struct(run_id=LONG, outcome=STR, execution_stage=STR, error_prefix=STR, file_count=LONG)
REPORT_ERRORS = _struct(submission_id=LONG, error_type=STR, error_per_file=LONG)
REPORT_RUNS = _struct(run_id=LONG, total_files=LONG, success_count=LONG, failure_count=LONG, skipped_count=LONG)

TABLES = {
    "submissions": SUBMISSIONS,
    "pipeline_audit_logs": AUDIT_LOG,
    "submission_errors": SUBMISSION_ERRORS,
    "dim_entities": DIM_ENTITIES,
    "dim_profiles": DIM_PROFILES,
    "dim_ind_profile": DIM_INDUSTRIES,
    "fct_rating_metric": FACTS,
    "pipeline_runs": RUNS,
    "pipeline_file_details": FILE_LOG,
    "pipeline_file_contents": FILE_CONTENTS,
    "known_contents": KNOWN_CONTENTS,
    "name_grams": NAME_GRAMS,
    "gram_counts": GRAM_COUNTS,
    "report_uploads": REPORT_UPLOADS,
    "report_errors": REPORT_ERRORS,
    "report_runs": REPORT_RUNS,
}
