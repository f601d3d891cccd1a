"""Rankings with one hot group, against plain Python."""

import pytest
from pyspark.sql import functions as F

from jobweave.operators import ranking


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows belong to one group."""
    group = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string")))
    return spark.range(6000).select(group.alias("g"), ((F.col("id") * 7919) % 101).alias("v"), "id").cache()


def expected(df):
    groups = {}
    for row in df.collect():
        groups.setdefault(row.g, []).append((-row.v, row.id))
    return {(g, i): n for g, rows in groups.items() for n, (_, i) in enumerate(sorted(rows), 1)}


def order():
    return [F.desc("v"), F.col("id")]


def test_number_rows_spans_partitions(skewed):
    numbered = ranking.number_rows(skewed, ["g"], order())
    assert {(r.g, r.id): r.position for r in numbered.collect()} == expected(skewed)


@pytest.mark.parametrize("k", [1, 7, 1500])
def test_top_per_group(skewed, k):
    top = ranking.top_per_group(skewed, ["g"], order(), k)
    assert {(r.g, r.id): r.position for r in top.collect()} == {x: n for x, n in expected(skewed).items() if n <= k}


def test_small_k_cuts_groups_before_the_shuffle(skewed):
    plan = ranking.first_per_group(skewed, ["g"], order())._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
