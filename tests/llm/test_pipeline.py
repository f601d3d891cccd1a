"""The pipeline against plain Python over the same rows, and on an empty table."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline as pipeline
from jobweave.llm import langid, quality, segment
from test_decontaminate import words
from test_simhash import by_hand, groups


@pytest.fixture(scope="module")
def folder(spark, data, tmp_path_factory):
    """The given tables with odd rows: nulls, repeated rows and ids, an extra column."""
    root = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{data}/documents.parquet")
    odd = spark.createDataFrame(
        [(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "12 34 56", "en", "s", 8), (0, "another text with the id of the first one", "en", "s", 41)], docs.schema
    )
    rows = docs.unionByName(odd).unionByName(docs.limit(3)).selectExpr("*", "'extra' AS fp")
    rows.write.parquet(f"{root}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{data}/{name}.parquet").write.parquet(f"{root}/{name}.parquet")
    return root


def test_against_plain_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    usable = lambda i, n, rest: zlib.crc32(str(i).encode()) % n != rest

    # Language and quality, with the models the stages learn.
    net = langid.train(langid.training_rows(docs, pipeline.crc_mod("doc_id", 5) != 0))
    names, score, _ = langid.predict(net, pa.array([t for _, t in rows], pa.string()))
    rows = [r for r, n, s in zip(rows, names, score) if n != "und" and s >= pipeline.LEAST_LANGUAGE]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    hashed = lambda t: xxhash.xxh64_intdigest(t, 42) - (xxhash.xxh64_intdigest(t, 42) >> 63 << 64)
    texts = {i: min((t for j, t in rows if j == i), key=hashed) for i in {i for i, _ in rows if i in labels and usable(i, 3, 1)}}
    df = np.zeros(quality.TERMS, np.int64)
    for _, _, counts in quality.term_counts(pa.array([t for _, t in rows])):
        df += (counts[:, : quality.TERMS] > 0).sum(axis=0)
    counted = np.concatenate([c for i in sorted(texts) for _, _, c in quality.term_counts(pa.array([texts[i]]))])
    voters = quality.fit(counted, [labels[i] for i in sorted(texts)], len(rows), df)
    good = quality.scores(voters, pa.array([t for _, t in rows]))
    rows = sorted({r for r, s in zip(rows, good) if s >= pipeline.LEAST_QUALITY})

    # One of each group, then nothing of the benchmark.
    group = groups([by_hand(t) for _, t in rows], 2)
    rows = [r for k, r in enumerate(rows) if group[k] == k]
    items = [" ".join(words(r.text)) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rows = [r for r in rows if not any(i in " ".join(words(r[1])) for i in items)]

    got = pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} == {i for i, _ in rows}
    pieces = segment.load()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(segment.decode(r.ids, pieces))
    assert by == {i: {t for j, t in rows if j == i} for i, _ in rows}
    assert all(sum(r.doc_id == i for r in got) % 3 == 0 for i in by)


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in pipeline.STAGES[2:4]:
        assert stage(spark, docs, folder).columns == docs.columns, name
    assert [name for name, _ in pipeline.STAGES] == ["language", "quality", "duplicates", "benchmark", "pieces"]


def test_an_empty_table(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []
