"""Physical plans: what must not appear, what must be pushed down."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from fixtures import postings
from jobweave import schemas
from jobweave.operators import store
from jobweave.sources import tables

# Windows over whole groups: the numbering of range-partitioned rows and the subscriptions in a user's row.
# The alert rule's windows see a row for each hour of a key, whatever the number of events.
FULL_WINDOWS = {"digest_lines": 2, "user_feed": 2, "feed_page": 2, "report_by_title": 2, "alert_transitions": 2}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_no_pairs_and_no_whole_group_windows(spark, data, name):
    plan = plan_of(contract.queries()[name](spark, data))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    windows = len(re.findall(r"\bWindow \[", plan))
    limited = len(re.findall(r"WindowGroupLimit .* Final", plan))
    assert windows - limited == FULL_WINDOWS.get(name, 0)


def read_schemas(plan):
    return [set(re.findall(r"(\w+):", part)) for part in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]


def test_scans_read_needed_columns_only(spark, data):
    plans = {n: plan_of(contract.queries()[n](spark, data)) for n in ("known_ids", "report_kpis", "new_by_source")}
    assert all(read == {"p_partkey", "p_brand"} for read in read_schemas(plans["known_ids"]))
    for name in ("report_kpis", "new_by_source"):
        read = set().union(*read_schemas(plans[name]))
        assert not read & {"p_name", "p_type", "l_extendedprice", "o_totalprice"}


def test_source_filter_reaches_the_scan(spark, data):
    plan = plan_of(contract.queries()["jobs_for_sources"](spark, data))
    assert "In(p_brand, [Brand#14,Brand#21,Brand#3])" in plan


def test_stored_postings_prune_by_source(spark, tmp_path):
    jobs = postings(spark).unionByName(postings(spark).withColumn("source_id", F.lit("second")))
    path = tables.write_snapshot(jobs, str(tmp_path), 1, ["source_id"])
    stored = spark.read.schema(schemas.POSTINGS).parquet(path)
    plan = plan_of(store.postings_of_sources(stored, ["second"]))
    assert re.search(r"PartitionFilters: \[.*source_id.*second", plan)
    assert store.postings_of_sources(stored, ["second"]).count() == 2
