"""Strict reading of a scorer's answers and classification of its errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip

MIN_SCORE, MAX_SCORE = 1, 10

# Seconds to wait after a quota error and after any other attempt.
QUOTA_WAIT_S = 65
ATTEMPT_WAIT_S = 2

# Closing member of the wrapper object in `_wrapped`; text behind the answer keeps it from being seen.
_END = "jobweave:end"

# An answer of a whole number and a text without escapes, and nothing else. Longer texts are
# read as JSON.
_PLAIN = (
    r'\A\{[ \t\r\n]*+"score"[ \t\r\n]*+:[ \t\r\n]*+(0|-?[1-9][0-9]{0,8})[ \t\r\n]*+,[ \t\r\n]*+'
    r'"summary"[ \t\r\n]*+:[ \t\r\n]*+"([^"\\\x00-\x1F]{0,100000}+)"[ \t\r\n]*+\}\z'
)


def strip_fences(response: Column) -> Column:
    """The answer without surrounding white space and Markdown code fences."""
    text = strip(response)
    # One capture between an optional fence line and an optional closing fence, lazily, so that the latter goes.
    inner = F.regexp_extract(text, r"(?sU)\A(?:`{3}(?:json)?\s*)?(.*?)(?:\s*`{3})?\z", 1)
    return F.when(text.contains("```"), inner).otherwise(text)


def _wrapped(answer: Column) -> Column:
    return F.concat(F.lit('{"r":'), answer, F.lit(f',"{_END}":0}}'))


def _integer_of(kind: Column, text: Column) -> Column:
    """Integer value as `int()` reads it: decimals are cut off, quoted text must be a whole number."""
    quoted = F.when(
        text.rlike(r"^\s*[+-]?\d+(_\d+)*\s*$"),
        F.regexp_replace(strip(text), "_", "").try_cast("decimal(38,0)"),
    )
    number = text.try_cast("double")
    return (
        F.when(kind == "STRING", quoted.try_cast("double"))
        .when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0))
        .when(F.isnan(number), F.lit(None).cast("double"))
        .when(number >= 0, F.floor(number).cast("double"))
        .otherwise(F.ceil(number).cast("double"))
    )


def _text_of(kind: Column, text: Column) -> Column:
    return (
        F.when(kind == "VOID", F.lit("None"))
        .when(kind == "BOOLEAN", F.initcap(text))
        .otherwise(text)
    )


def parse_responses(df: DataFrame, response: str = "response") -> DataFrame:
    """Add `score`, `summary` and `error`. An answer is either a score with a summary or an error.

    The answer is read inside a wrapper object whose last member can only be reached when nothing
    follows the answer, so trailing text is an error. Fields are read as variants, which keep quoted
    and unquoted numbers apart. Plain answers (`_PLAIN`) are read by their pattern, with the same result.
    """
    answer = strip_fences(F.coalesce(F.col(response), F.lit("")))
    schema = f"r STRUCT<score: VARIANT, summary: VARIANT>, `{_END}` INT"
    # Each row passes through one projection per stage, so the JSON is parsed once, and not for a plain answer.
    staged = df.withColumn("_answer", answer).withColumn("_digits", F.regexp_extract("_answer", _PLAIN, 1))
    plain = F.col("_digits") != ""
    staged = staged.withColumn("_wrapped", F.when(~plain, _wrapped(F.col("_answer")))).withColumn(
        "_parsed", F.from_json("_wrapped", schema, {"allowSingleQuotes": "false"})
    )
    # An answer can only add members to the wrapper after closing its own object; just then they are counted.
    reached = F.col(f"_parsed.`{_END}`").isNotNull()
    alone = F.when(F.col("_wrapped").rlike(r"(?s)\}\s*,.*,"), F.size(F.json_object_keys("_wrapped")) == 2).otherwise(True)
    staged = staged.withColumn("_valid", plain | F.coalesce(reached & alone, F.lit(False)))
    read = {"score": ("BIGINT", F.col("_digits")), "summary": ("STRING", F.regexp_extract("_answer", _PLAIN, 2))}
    for field, (kind, text) in read.items():
        staged = staged.withColumn(
            f"_{field}_kind", F.when(plain, kind).otherwise(F.expr(f"schema_of_variant(_parsed.r.{field})"))
        ).withColumn(
            f"_{field}_text", F.when(plain, text).otherwise(F.expr(f"try_variant_get(_parsed.r.{field}, '$', 'string')"))
        )
    number = F.coalesce(_integer_of(F.col("_score_kind"), F.col("_score_text")), F.lit(None))
    staged = staged.withColumn("_number", F.when(plain, F.col("_digits").cast("double")).otherwise(number))
    in_range = F.col("_number").between(MIN_SCORE, MAX_SCORE)
    error = (
        F.when(~F.col("_valid"), F.lit("invalid JSON"))
        .when(F.col("_score_kind").isNull(), F.lit("missing score"))
        .when(F.col("_number").isNull(), F.lit("score is not an integer"))
        .when(F.col("_summary_kind").isNull(), F.lit("missing summary"))
        .when(~in_range, F.lit("score out of bounds"))
    )
    summary = _text_of(F.col("_summary_kind"), F.col("_summary_text"))
    return (
        staged.withColumn("error", error)
        .withColumn("score", F.when(F.col("error").isNull(), F.col("_number").cast("int")))
        .withColumn("summary", F.when(F.col("error").isNull(), summary))
        .select(*df.columns, "score", "summary", "error")
    )


def error_class(message: Column) -> Column:
    """'daily_quota', 'quota' or 'other'; null without a message. The markers looked for are fixed values.

    Any text with "rate" in it counts as quota, also "generate".
    """
    lowered = F.lower(message)
    daily = message.contains("PerDay") | lowered.contains("per_day")
    quota = message.contains("429") | lowered.contains("quota") | lowered.contains("rate")
    return (
        F.when(message.isNull(), F.lit(None).cast("string"))
        .when(daily, F.lit("daily_quota"))
        .when(quota, F.lit("quota"))
        .otherwise(F.lit("other"))
    )


def wait_seconds(error_kind: Column) -> Column:
    """Seconds to wait before the next attempt; none after an exhausted daily quota."""
    return (
        F.when(error_kind == "daily_quota", F.lit(0))
        .when(error_kind == "quota", F.lit(QUOTA_WAIT_S))
        .when(error_kind == "other", F.lit(ATTEMPT_WAIT_S))
    )
