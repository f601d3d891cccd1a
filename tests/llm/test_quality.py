import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from jobweave.llm import quality
from jobweave.llm.queries import QUERIES


def good(rng):
    return " ".join(rng.choice(["stone", "river", "walks", "under", "a", "the", "bridge."]) for _ in range(rng.randint(20, 120)))


def bad(rng):
    return " ".join(rng.choice(["BUY!!", "w1n###", "$$$", "click|here", "NOW!!"]) for _ in range(rng.randint(20, 120)))


def fitted(n=60):
    rng = random.Random(2)
    texts = [good(rng) for _ in range(n)] + [bad(rng) for _ in range(n)]
    counts = np.concatenate([c for _, _, c in quality.term_counts(pa.array(texts))])
    df = (counts[:, : quality.TERMS] > 0).sum(axis=0)
    return quality.fit(counts, [1] * n + [0] * n, len(texts), df, rank=12)


def test_votes_are_those_of_all_cosines():
    voters = fitted()
    rng = random.Random(3)
    texts = [good(rng) for _ in range(5)] + [bad(rng) for _ in range(5)] + ["river $$$ stone NOW!!"]
    rows = quality.weighted(np.concatenate([c for _, _, c in quality.term_counts(pa.array(texts))]), voters.idf) @ voters.space
    for row, score in zip(rows, quality.scores(voters, pa.array(texts))):
        cosines = [float(row @ v / np.linalg.norm(row)) for v in voters.vectors]
        near = sorted(range(len(cosines)), key=lambda i: -cosines[i])[: quality.NEIGHBOURS]
        weight = {i: max(cosines[i], 0) ** quality.SHARPNESS + 1e-12 for i in near}
        expected = sum(w for i, w in weight.items() if voters.labels[i] == 1) / sum(weight.values())
        assert abs(expected - score) < 1e-3


def test_scores_and_odd_texts():
    voters, rng = fitted(), random.Random(4)
    texts = [good(rng), bad(rng), None, "", " \n\t", "é", good(rng) * 300]
    got = quality.scores(voters, pa.array(texts))
    assert got[0] > 0.9 and got[1] < 0.1 and got[6] > 0.5 and list(got[2:5]) == [0, 0, 0]
    assert ((0 <= got) & (got <= 1)).all()
    alone = [quality.scores(voters, pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(alone, got, atol=1e-4)


def test_counts_are_the_same_in_any_slices(monkeypatch):
    rng = random.Random(5)
    texts = pa.array([good(rng), None, bad(rng) * 50, "", "ab"])
    whole = np.concatenate([c for _, _, c in quality.term_counts(texts)])
    monkeypatch.setattr(quality, "SLICE_BYTES", 700)
    assert np.array_equal(np.concatenate([c for _, _, c in quality.term_counts(texts)]), whole)


def test_tables(spark):
    rng = random.Random(6)
    rows = [(i, good(rng) if i % 2 else bad(rng)) for i in range(80)] + [(3, "other text of the same id"), (None, good(rng)), (200, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 0), (None, 1), (70, None), (999, 1)], "doc_id long, quality int")
    voters = quality.learn(docs, labels, F.col("doc_id") >= 0)
    assert len(voters.labels) == 60
    out = quality.with_quality(docs, voters).collect()
    assert len(out) == len(rows) and {r.score for r in out} == {"x"}
    by = {r.doc_id: r.quality_score for r in out if r.doc_id is not None and 60 <= r.doc_id < 80}
    assert all((s >= 0.5) == (i % 2 == 1) for i, s in by.items())
    assert quality.with_quality(docs, voters, keep=0.5).columns == docs.columns
    nobody = quality.learn(docs.limit(0), labels, F.col("doc_id") >= 0)
    assert {r.quality_score for r in quality.with_quality(docs, nobody).collect()} == {0.0}
    assert quality.with_quality(docs.limit(0), voters).collect() == []


def test_held_out_accuracy(spark, data):
    got = QUERIES["op9_quality"](spark, data)
    rows = got.join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(rows) > 15 and sum(r.quality == r.predicted for r in rows) >= 0.9 * len(rows)


def test_a_column_of_the_same_name(spark):
    voters, rng = fitted(), random.Random(9)
    docs = spark.createDataFrame([(1, good(rng), "x", "y"), (2, None, None, "z")], "doc_id long, text string, QUALITY_SCORE string, score string")
    got = {r.doc_id: r for r in quality.with_quality(docs, voters).collect()}
    assert got[1].quality_score > 0.5 and got[2].quality_score == 0 and [got[i].score for i in (1, 2)] == ["y", "z"]
    assert [r.QUALITY_SCORE for r in quality.with_quality(docs, voters, keep=0.5).collect()] == ["x"]
    assert quality.with_quality(docs.where("doc_id < 0"), voters).collect() == []
