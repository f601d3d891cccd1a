import math
import re
from collections import Counter

import numpy as np
import pytest

import check
from jobweave.llm import backoff
from jobweave.llm.oracles import ORACLES
from jobweave.llm.queries import QUERIES


def by_hand(rows):
    texts = [(i, [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]) for i, t in rows]
    one = Counter(w for _, ws in texts for w in ws)
    two = Counter(p for _, ws in texts for p in zip(ws, ws[1:]))
    total = sum(one.values())
    out = {i: [0, 0] for i, _ in texts}
    for i, ws in texts:
        own, pairs = Counter(ws), Counter(zip(ws, ws[1:]))
        out[i][0] += len(ws)
        for k, w in enumerate(ws):
            v = ws[k - 1] if k else None
            if k and two[v, w] > pairs[v, w]:
                out[i][1] += math.log((two[v, w] - pairs[v, w]) / (one[v] - own[v]))
            else:
                out[i][1] += math.log((0.4 if k else 1) * (one[w] - own[w] or 0.4) / total)
    return out


ODD = [(1, "The cat sat on the mat"), (2, "the CAT sat"), (3, None), (4, ""), (5, " \n"), (6, "É é the the the the"), (7, "one"), (2, "sat on"), (None, "the cat"),
       (8, "the mat " * 5000), (9, "zyx wvu tsr"), (10, "zyx wvu tsr"), (11, "own of its own"), (7, "one"), (12, "\u00a0 x"), (13, "zyx the")]


# Which words have numbers and which bigrams are hot changes no score.
@pytest.mark.parametrize(
    "most, hot, sample, bucket", [(500_000, 1, 1, 10), (500_000, 300_000, 1, 10), (500_000, 300_000, 2, 9999), (30, 10, 1, 2000), (4, 300_000, 1, 100), (1, 1, 16, 10**9)]
)
def test_scores_are_those_by_hand(spark, monkeypatch, most, hot, sample, bucket):
    monkeypatch.setattr(backoff.hot_bigrams, "__defaults__", (hot, sample))
    docs = spark.createDataFrame([(*r, 1, "x") for r in ODD], "doc_id long, text string, key int, score string")
    got = {r.doc_id: (r.n_words, r.score) for r in backoff.scored(docs, most, hot, bucket).collect()}
    want = by_hand(ODD)
    assert got.keys() == want.keys()
    for i, (n, score) in want.items():
        assert got[i][0] == n and abs(got[i][1] - score) < 2e-6 * max(1, n)


def test_slices_change_no_score(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").coalesce(1)
    want = sorted(backoff.scored(docs, bucket_rows=100).collect(), key=str)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    try:
        spark.conf.set(rows, "2")
        assert sorted(backoff.scored(docs, bucket_rows=100).collect(), key=str) == want
    finally:
        spark.conf.set(rows, before)


def test_packed_arrays_come_back():
    v, w = np.array([0, 5, -7, (1 << 22) - 1, -7]), np.array([-9, 1 << 20, backoff.SIGN, 3, -1])
    text, many, n, nv, nw = np.array([3, 900]), np.array([1, 4]), np.array([1, 255, 256, 1 << 40, 2]), np.array([254, 255, 1, 1, 300]), np.ones(5, np.int64)
    for got, want in zip(backoff._unpack(backoff._pack(text, many, v, w, [n, nv, nw])), (text, many, v, w, n, nv, nw)):
        assert got.tolist() == want.tolist()
    got = backoff._unpack_sums(backoff._pack_sums(text, np.array([-(1 << 50), 7])))
    assert [x.tolist() for x in got] == [[3, 900], [-(1 << 50), 7]]


def test_invented_words_rank_last(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, " ".join(f"q{i}zx" for i in range(500))), *[(-2 - k, " ".join(f"twice{i}zx" for i in range(500))) for k in (0, 1)]], docs.schema)
    rows = backoff.scored(docs.unionByName(odd)).collect()
    mean = {r.doc_id: r.score / r.n_words for r in rows if r.n_words}
    assert min(mean, key=mean.get) == -1
    assert mean[-2] == mean[-3] > -0.1  # copies have seen each other


def test_empty_table(spark):
    assert backoff.scored(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_matches_sql(spark, data):
    same, note = check.compare(spark, check.connect(data), QUERIES["op6_backoff"], ORACLES["op6_backoff"], data)
    assert same, note
