"""Best postings by tags against listing all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from jobweave.operators import tag_search

POSTINGS = "source_id string, job_id string, tags array<string>, n int"
USERS = "user_id string, tags array<string>, tag string"


def tables(spark, n_jobs=400, n_users=60, seed=1):
    rng = random.Random(seed)
    tags = [f"t{i}" for i in range(40)]
    some = lambda: [t for i, t in enumerate(tags) if rng.random() < 3 / (3 + i)]  # noqa: E731  t0 is on every posting
    jobs = [(f"b{i % 3}", f"J{i}", some(), i) for i in range(n_jobs)] + [("b0", f"E{i}", ["t0", "t1"], i) for i in range(n_jobs // 2)]
    jobs += [("b0", "none", [], 0), ("b1", "null", None, 0), ("b1", "twice", ["t9", "t9", "t8"], 0)]
    people = [(f"u{i}", some() + ["unknown"] * (i % 2), "x") for i in range(n_users)]
    people += [("empty", [], "x"), ("null", None, "x"), ("none", ["unknown"], "x"), ("hot", ["t0"], "x"), ("twice", ["t9", "t9", "t30"], "x")]
    return spark.createDataFrame(people, USERS), spark.createDataFrame(jobs, POSTINGS), people, jobs


def by_hand(people, jobs, k):
    out = []
    for user, tags, _ in people:
        mine = set(tags or [])
        found = sorted((-len(mine & set(t or [])), s, j) for s, j, t, _ in jobs if mine & set(t or []))
        out += [(user, n, s, j, -m, max(1, -(-10 * -m // len(mine)))) for n, (m, s, j) in enumerate(found[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("k, tile_rows", [(10, 512), (1, 7), (300, 20)])
def test_equals_all_pairs(spark, monkeypatch, k, tile_rows):
    monkeypatch.setattr(tag_search, "TILE_ROWS", tile_rows)
    people, jobs, *rows = tables(spark)
    assert sorted(tuple(r) for r in tag_search.best_by_tags(people, jobs, k).collect()) == by_hand(*rows, k)


def test_common_tags_stay_closed(spark):
    """A user with rare tags and one that every posting has does not read the list of the common one."""
    jobs = [("b", f"J{i:03}", ["common", f"rare{i // 20}", f"also{i // 20}"], i) for i in range(400)]
    people = [(f"u{i}", ["common", f"rare{i}", f"also{i}"], "x") for i in range(20)]
    tagged, users = spark.createDataFrame(jobs, POSTINGS), spark.createDataFrame(people, USERS)
    lists, firsts = tag_search._job_sets(tagged, 10)
    sets = users.select("user_id", F.array_sort("tags").alias("user_tags"))
    terms = tag_search._rarest_first(sets, lists, 10).withColumn("last", F.col("place") == F.col("n_tags") - 1)
    near = tag_search._best(tag_search.opened(terms.where("first"), lists), firsts, 10)
    assert terms.where("first AND tag = 'common'").count() == 0
    assert tag_search.visits(terms, near, 10).where("tag = 'common'").count() == 0
    assert sorted(tuple(r) for r in tag_search.best_by_tags(users, tagged, 10).collect()) == by_hand(people, jobs, 10)


def test_empty_tables(spark):
    people, jobs, *_ = tables(spark, 20, 3)
    assert tag_search.best_by_tags(people.limit(0), jobs).collect() == []
    assert tag_search.best_by_tags(people, jobs.limit(0)).collect() == []
