import itertools
import random

import pyarrow as pa
import pytest
import xxhash

from jobweave.llm import simhash


def by_hand(text, size=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, distance):
    """{position: smallest position reachable}"""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= distance:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(fps))]


TEXTS = [None, "", " \t\n", "One", "one two", "One TWO three", "é É two", "a b c d e f", "x y z w " * 400, "x y  z\nw " * 400]


def test_fingerprints_are_those_by_hand():
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(1, 900))) for _ in range(40)]
    assert simhash.fingerprints(pa.array(texts)).tolist() == [by_hand(t) for t in texts]


def test_groups_of_texts(spark):
    base = " ".join(f"w{i}" for i in range(400))
    texts = TEXTS + [base] * 3 + [base.replace(f"w{i} ", "q ", 1) for i in range(0, 400, 9)]
    rows = [(100 + 3 * i, t, "extra", "extra") for i, t in enumerate(texts)] + [(None, base, "", ""), (100, None, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id string")
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    fps = [by_hand(r[1]) for r in order]
    want = {(r[0], f"{fp:016x}", order[g][0]) for r, fp, g in zip(order, fps, groups(fps, 2))}
    assert {(r.doc_id, f"{r.fp & (2**64 - 1):016x}", r.component_id) for r in found} == want


@pytest.mark.parametrize("distance, bucket_pairs", [(0, 3), (1, 3), (2, 0), (2, 1000), (3, 3)])
def test_links_join_the_same_groups_as_all_pairs(spark, distance, bucket_pairs):
    rng = random.Random(distance)
    fps = {0, 1, 2**64 - 1, 2**63}
    while len(fps) < 300:
        start = rng.choice([0, rng.getrandbits(64)] + sorted(fps)[:40])
        for _ in range(rng.randint(0, 4)):
            start ^= 1 << rng.randrange(64)
        fps.add(start)
    fps = sorted(fps)
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = [(r.a, r.b) for r in simhash.links(df, distance, bucket_pairs).collect()]
    place = {f: i for i, f in enumerate(signed)}
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        assert bin((a ^ b) & (2**64 - 1)).count("1") <= distance
        i, j = sorted((find(place[a]), find(place[b])))
        root[j] = i
    assert [find(i) for i in range(len(fps))] == groups(fps, distance)


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_thresholds_add_up_and_are_the_cheapest():
    rows = [[0.0, 5.0, 50.0], [0.0, 100.0, 500.0], [0.0, 4.0, 9.0]]
    cost, chosen = simhash.allocate(rows, 2)
    assert sum(chosen) == 0 and (cost, chosen) == (14.0, [0, -1, 1])


def test_a_caller_keeps_all_columns(spark):
    rows = [(1, "one two three four", "a", "b"), (2, "one two three four", "c", "d"), (3, "other words altogether here", "e", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row_key string, __ROW_KEY_ string")
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [rows[0], rows[2]]
