import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import check
from jobweave.llm import exhaustive
from jobweave.llm.oracles import ORACLES
from jobweave.llm.queries import QUERIES


def is_query():
    return F.pmod(F.col("vec_id"), F.lit(5)) == 0



def by_hand(rows, k):
    rows = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    rows = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    out = []
    for q, (qid, qv) in enumerate(rows):
        if qid is None or qid % 5:
            continue
        clip = lambda s: min(max(s, -(2**63)), 2**63 - 1)
        found = [(-clip(sum(a * b for a, b in zip(qv, v))), i is None, i or 0) for c, (i, v) in enumerate(rows) if c != q]
        for rank, (s, none, i) in enumerate(sorted(found)[:k], 1):
            out.append((qid, rank, None if none else i, -s))
    return sorted(out, key=str)


def got(df):
    return sorted([(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()], key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, row_no int, score string")


@pytest.mark.parametrize("k, query_rows, candidate_rows", [(5, 16_384, 131_072), (3, 2, 40), (700, 4, 64)])
def test_equals_brute_force(spark, k, query_rows, candidate_rows, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(int(i), np.round(rng.normal(size=8), 2).tolist()) for i in range(300)]
    rows += [(int(i), (np.round(rng.normal(size=12), 1) * (rng.random(12) < 0.3)).tolist()) for i in range(300, 400)]  # sparse, longer
    rows += [(i, [0.5] * 8) for i in range(400, 460)] + [(i, rows[3][1]) for i in range(460, 480)]  # ties and copies
    rows += [(10, [0.25] * 8), (10, [0.25] * 8), (None, [3.0] * 8), (None, [3.0] * 8)]  # repeated and null ids
    rows += [(500, None), (505, [1.0, None]), (510, [float("nan")]), (515, [float("inf"), 1.0]), (520, []), (525, [0.0] * 8)]
    monkeypatch.setattr(exhaustive, "LEAST_CANDIDATES", 32)
    assert got(exhaustive.search(table(spark, rows), is_query(), k, query_rows, candidate_rows)) == by_hand(rows, k)


def test_scores_beyond_64_bits(spark):
    rows = [(0, [1e20, 1.0]), (1, [1e20, 2.0]), (2, [-1e30, 0.0]), (3, [1e12, 5.0]), (4, [0.0, 7.0]), (5, [1e9, 1e9])]
    assert got(exhaustive.search(table(spark, rows), is_query())) == by_hand(rows, 5)


def test_blocks_of_one_task_are_merged(monkeypatch):
    rng = np.random.default_rng(2)
    vectors = rng.integers(-3, 4, (90, 6)) / 256
    monkeypatch.setattr(exhaustive, "BLOCK_ROWS", 16)
    monkeypatch.setattr(exhaustive, "BLOCK_QUERIES", 4)
    lists = pa.array(vectors.tolist(), pa.list_(pa.float64()))
    number = pa.array(range(90))
    found = exhaustive.search_tile(
        pa.table({"row_no": number, "query_id": number, "vector": lists}), pa.table({"place": number, "vec_id": number, "offered": lists}), 7
    ).to_pylist()
    rows = [(i * 5, v) for i, v in enumerate(vectors.tolist())]
    want = {(q // 5, i // 5, s) for q, _, i, s in by_hand(rows, 7)}
    assert {(r["query_id"], r["vec_id"], r["score"]) for r in found} == want and len(found) == 90 * 7


def test_scatter_equals_products():
    rng = np.random.default_rng(3)
    left, right = rng.integers(-9, 9, (50, 20)) * (rng.random((50, 20)) < 0.2), rng.integers(-9, 9, (30, 20)) * (rng.random((30, 20)) < 0.5)
    make = lambda x: exhaustive.blocks(pa.array((x / 256).tolist(), pa.list_(pa.float64())), 100)[0][1]
    assert (make(left).scores(make(right)) == left @ right.T).all()


def test_empty_and_lonely(spark):
    assert got(exhaustive.search(table(spark, []), is_query())) == []
    assert got(exhaustive.search(table(spark, [(5, [1.0])]), is_query())) == []
    assert got(exhaustive.search(table(spark, [(1, [1.0]), (2, [1.0])]), is_query())) == []


def test_query_matches_sql(spark, data):
    same, note = check.compare(spark, check.connect(data), QUERIES["op11_exact_topk"], ORACLES["op11_exact_topk"], data)
    assert same, note


def test_equal_scores_go_by_id(spark):
    rows = [(i, [1.0]) for i in itertools.chain(range(30, 0, -1), [0])]
    assert got(exhaustive.search(table(spark, rows), F.col("vec_id") == 0)) == sorted([(0, r, r, 65536) for r in range(1, 6)], key=str)
