"""Fixed schemas of the stored tables."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


POSTING_TEXT = ("title", "location", "contract_type", "deadline", "description_raw", "url")

LEGACY_POSTINGS = _struct(
    job_id=StringType(),
    **{name: StringType() for name in POSTING_TEXT},
    scraped_at=TimestampType(),
)

POSTINGS = _struct(
    job_id=StringType(),
    source_id=StringType(),
    **{name: StringType() for name in POSTING_TEXT},
    scraped_at=StringType(),
)

POSTINGS_WITH_EXTRA = StructType(
    POSTINGS.fields + [StructField("extra", MapType(StringType(), StringType()), True)]
)

USERS = _struct(
    user_id=StringType(),
    email=StringType(),
    name=StringType(),
    profile_text=StringType(),
    score_threshold=IntegerType(),
    enabled_sources=ArrayType(StringType()),
    notification_email=StringType(),
    verified=BooleanType(),
    verification_token=StringType(),
    created_at=StringType(),
    updated_at=StringType(),
)

LEGACY_EVALUATIONS = _struct(
    job_id=StringType(),
    score=IntegerType(),
    summary=StringType(),
    evaluated_at=TimestampType(),
    email_sent=BooleanType(),
)

EVALUATIONS = _struct(
    user_id=StringType(),
    job_id=StringType(),
    source_id=StringType(),
    score=IntegerType(),
    summary=StringType(),
    email_sent=BooleanType(),
    evaluated_at=StringType(),
)

RUN_HISTORY = _struct(
    run_at=TimestampType(),
    trigger=StringType(),
    jobs_in_db=LongType(),
    new_jobs=LongType(),
    evaluated=LongType(),
    emails_sent=LongType(),
    duration_s=DoubleType(),
    status=StringType(),
    notes=StringType(),
)

SOURCES = _struct(
    source_id=StringType(),
    display_name=StringType(),
    label=StringType(),
    enabled=BooleanType(),
    enabled_by_default=BooleanType(),
    base_url=StringType(),
    color=StringType(),
    search_keywords=ArrayType(StringType()),
)
