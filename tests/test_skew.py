"""One key with a third of all rows, in every table, against the SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import check
from fixtures import keys
from jobweave.operators import alerts, feed, worklist

# A third of the postings on one board, of the line items on one posting, of the orders on one customer,
# of the documents with one text.
HOT = {
    "part": "* REPLACE (CASE WHEN p_partkey % 3 = 1 THEN 'Brand#13' ELSE p_brand END AS p_brand)",
    "lineitem": "* REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN CAST(7 AS BIGINT) ELSE l_partkey END AS l_partkey)",
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 1 THEN CAST(12 AS BIGINT) ELSE o_custkey END AS o_custkey)",
    "customer": "* REPLACE (CASE WHEN c_custkey = 12 THEN 100.0 ELSE c_acctbal END AS c_acctbal)",
    "documents": "* REPLACE (CASE WHEN doc_id % 3 = 0 THEN 'One text\non many boards' ELSE text END AS text)",
    "embeddings": "* REPLACE (CASE WHEN vec_id % 3 = 0 THEN 1 ELSE label END AS label)",
}

QUERIES = [
    "latest_evaluations", "evaluation_worklist", "worklist_summary", "user_feed", "feed_page", "feed_min_score", "digest_lines",
    "user_digest", "mark_sent", "upsert_jobs", "insert_if_absent", "new_by_source", "register_accounts", "identity_resolve",
    "attempt_outcome", "quota_cutoff", "cross_source_dedup", "near_copies", "vector_shortlist", "best_by_tags", "tag_match", "score_pairs", "stream_ingest",
]


@pytest.fixture(scope="module")
def hot_folder(data, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hot"))
    con = duckdb.connect()
    for name in check.TABLES:
        con.execute(f"COPY (SELECT {HOT.get(name, '*')} FROM '{data}/{name}.parquet') TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", QUERIES)
def test_hot_keys(spark, hot_folder, name):
    same, note = check.compare(spark, check.connect(hot_folder), contract.queries()[name], contract.oracle_sql()[name], hot_folder)
    assert same, note


# Small thresholds, so that AQE treats the fixture like a large table, and no broadcasts.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}


@pytest.fixture
def small_partitions(spark):
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def one_user_holds_a_third(spark):
    """40,000 postings and 60,000 evaluations; one user has 20,000 of them, and board b0 most postings."""
    n = F.col("id")
    jobs = spark.range(40_000, numPartitions=8).select(
        F.when(n % 3 > 0, "b0").otherwise(F.concat(F.lit("b"), n % 50)).alias("source_id"), n.cast("string").alias("job_id")
    )
    evals = spark.range(60_000, numPartitions=8).select(
        F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), n % 997)).alias("user_id"),
        F.when(F.floor(n / 3) % 3 > 0, "b0").otherwise(F.concat(F.lit("b"), F.floor(n / 3) % 50)).alias("source_id"),
        F.floor(n / 3).cast("string").alias("job_id"),
        (n % 10 + 1).cast("int").alias("score"),
        F.concat(F.lit("s"), n).alias("summary"),
        F.lit(False).alias("email_sent"),
    )
    people = spark.range(998, numPartitions=8).select(
        F.when(n == 997, "hot").otherwise(F.concat(F.lit("u"), n)).alias("user_id"),
        F.lit(6).alias("score_threshold"),
        F.array(F.lit("b0"), F.concat(F.lit("b"), n % 50)).alias("enabled_sources"),
    )
    return people, jobs, evals


def test_hot_user_is_split_in_joins(small_partitions, one_user_holds_a_third):
    people, jobs, evals = one_user_holds_a_third
    due = alerts.due_matches(evals, people, jobs)
    rows = due.collect()
    plan = due._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "skew=true" in plan
    sources = {j: s for s, j in keys(jobs, "source_id", "job_id")}
    enabled = {r.user_id: r.enabled_sources for r in people.collect()}
    expected = {
        (u, j) for u, j, s in keys(evals, "user_id", "job_id", "score") if s >= 6 and sources[j] in enabled[u]
    }
    assert {(r.user_id, r.job_id) for r in rows} == expected and len(rows) == len(expected)


def test_hot_board_and_user_in_counts_and_pages(spark, small_partitions, one_user_holds_a_third):
    people, jobs, evals = one_user_holds_a_third
    counts = {r.user_id: r.n_todo for r in worklist.worklist_counts(people, jobs, evals).collect()}
    per_source = {r.source_id: r["count"] for r in jobs.groupBy("source_id").count().collect()}
    sources = {j: s for s, j in keys(jobs, "source_id", "job_id")}
    enabled = {r.user_id: set(r.enabled_sources) for r in people.collect()}
    expected = {u: sum(per_source.get(s, 0) for s in boards) for u, boards in enabled.items()}
    for u, j in keys(evals, "user_id", "job_id"):
        expected[u] -= sources[j] in enabled[u]
    assert counts == expected
    texts = {c: F.lit("") for c in ("title", "location", "contract_type", "deadline", "url", "scraped_at")}
    page = feed.feed(people, jobs.withColumns(texts), evals, page=2, limit=100)
    sizes = {r.user_id: r["count"] for r in page.groupBy("user_id").count().collect()}
    assert sizes == {u: 100 for u in enabled}
