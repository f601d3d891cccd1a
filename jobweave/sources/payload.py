"""Search-result payloads (JSON) to posting stubs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import absolute_url, href_of

PAYLOAD_SCHEMA = "rows ARRAY<STRUCT<columns: ARRAY<STRUCT<name: STRING, value: STRING, html: STRING>>>>"

# Column names in the payload.
ID_COLUMN = "job_posting_ref"
FIELD_COLUMNS = {
    "title": "title",
    "location": "location",
    "contract_type": "job_type_text",
    "deadline": "end_date",
}


def _last(columns: Column, name: str) -> Column:
    """The last column of that name; a repeated name overrides the earlier one."""
    return F.try_element_at(F.filter(columns, lambda c: c["name"] == name), F.lit(-1))


def payload_stubs(payloads: DataFrame, base_url: str, payload: str = "payload") -> DataFrame:
    """One stub per payload row that has an id. Unreadable payloads give none."""
    rows = payloads.select(
        *[c for c in payloads.columns if c != payload],
        F.explode(F.from_json(payload, PAYLOAD_SCHEMA)["rows"]["columns"]).alias("_columns"),
    )
    reference = _last(F.col("_columns"), ID_COLUMN)
    fields = {
        field: F.coalesce(_last(F.col("_columns"), name)["value"], F.lit(""))
        for field, name in FIELD_COLUMNS.items()
    }
    return (
        rows.withColumns({"_ref": reference, **fields})
        .withColumn("job_id", F.col("_ref")["value"])
        .filter(F.length("job_id") > 0)
        .withColumn("url", absolute_url(href_of(F.coalesce(F.col("_ref")["html"], F.lit(""))), base_url))
        .drop("_columns", "_ref")
    )
