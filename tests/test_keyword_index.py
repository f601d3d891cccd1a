"""Keyword search by index against `contains`."""

import random

from jobweave.operators.keyword_index import indexed_keyword_hits, keyword_index

POSTINGS = "source_id string, job_id string, title string, description_raw string, gram int"
SOURCES = "source_id string, search_keywords array<string>, word string"


def by_hand(jobs, boards):
    lists = {s: set(k for k in words or [] if k is not None) for s, words, _ in boards}
    out = {}
    for source, job, title, body, _ in jobs:
        text = " ".join(x for x in (title, body) if x is not None).lower()
        hits = sorted(k for k in lists.get(source, ()) if k.lower() in text)
        if hits:
            out[source, job] = hits
    return out


def got(found):
    rows = found.collect()
    assert len({(r.source_id, r.job_id) for r in rows}) == len(rows)
    return {(r.source_id, r.job_id): r.keywords for r in rows}


def test_odd_texts_and_keywords(spark):
    jobs = [
        ("a", "1", "Data Engineer", "Works with SQL.", 1), ("a", "2", None, None, 1), ("a", "3", "", "Ökonom/in für Größe", 1),
        ("a", "4", "x", "dataengineer DATA", 1), ("b", "1", "Data Engineer", None, 1), ("none", "1", "Data", "", 1), ("c", "1", "anything", "", 1),
    ]
    boards = [("a", ["data engineer", "Data", "sql", "r", "ö", "größe", "missing", "data", None, "with SQL."], "x"), ("b", [], "x"), ("c", ["", "a"], "x"), ("d", None, "x")]
    found = indexed_keyword_hits(spark.createDataFrame(jobs, POSTINGS), spark.createDataFrame(boards, SOURCES))
    assert got(found) == by_hand(jobs, boards)


def test_a_board_with_very_many_keywords(spark):
    rng = random.Random(1)
    letters = "abcdefghij "
    words = ["".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(50_000)]
    jobs = [(f"b{i % 3 % 2}", str(i), "".join(rng.choices(letters, k=60)), "".join(rng.choices(letters.upper(), k=200)), i) for i in range(60)]
    boards = [("b0", words, "x"), ("b1", words[:50], "x")]
    table = spark.createDataFrame(boards, SOURCES)
    assert got(indexed_keyword_hits(spark.createDataFrame(jobs, POSTINGS), table)) == by_hand(jobs, boards)
    index = keyword_index(table)
    assert index.count() == len(set(words)) + len(set(words[:50]))


def test_empty_tables(spark):
    jobs, boards = spark.createDataFrame([], POSTINGS), spark.createDataFrame([("a", ["x"], "x")], SOURCES)
    assert indexed_keyword_hits(jobs, boards).collect() == []
    one = spark.createDataFrame([("a", "1", "x", "y", 1)], POSTINGS)
    assert indexed_keyword_hits(one, boards.limit(0)).collect() == []
