"""Near copies against a comparison of all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from jobweave.operators import near_copies as near
from jobweave.operators.near_copies import near_copies

WORDS = [f"w{i}" for i in range(5000)]


def corpus(seed=1):
    rng = random.Random(seed)
    boiler = " ".join(rng.choices(WORDS, k=60))
    rows = []

    def add(text):
        rows.append((f"b{rng.randrange(4)}", str(len(rows)), text))

    for _ in range(60):
        words = rng.choices(WORDS, k=rng.randrange(1, 120))
        add(" ".join(words))
        if rng.random() < 0.5:
            for _ in range(rng.randrange(1, 5)):  # copies with some words changed
                changed = list(words)
                for _ in range(rng.randrange(0, 1 + len(words) // 15)):
                    changed[rng.randrange(len(words))] = rng.choice(WORDS)
                add("  ".join(changed).upper() if rng.random() < 0.3 else " ".join(changed))
    for _ in range(40):  # common boilerplate is no copy
        add(boiler + " " + " ".join(rng.choices(WORDS, k=80)))
    long = rng.choices(WORDS, k=200)
    for i in range(90):  # one large group of near copies, all different
        add(" ".join(long[: 190 + i % 10] + [f"end{i}"]))
    for text in [None, "", " \n", "one", "One", "two words", "a b c d e", "a b c d e", "word " * 4000]:
        add(text)
    return rows


def by_hand(rows):
    normal = [re.sub(r"\s+", " ", (t or "").lower()).strip() for _, _, t in rows]
    sets = {}
    for t in set(normal):
        w = t.split(" ") if t else []
        sets[t] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    texts = sorted(sets)
    linked = {t: {u for u in texts if u != t and (c := len(sets[t] & sets[u])) and 10 * c >= 8 * (len(sets[t]) + len(sets[u]) - c)} for t in texts}
    root = {}
    for t in texts:
        if t not in root:
            todo, root[t] = [t], t
            while todo:
                for u in linked[todo.pop()]:
                    if u not in root:
                        root[u] = t
                        todo.append(u)
    out = []
    for (source, job, _), t in zip(rows, normal):
        members = [(s, j, n) for (s, j, _), n in zip(rows, normal) if root[n] == root[t]]
        first = min((s, j) for s, j, _ in members)
        out.append((source, job, *first, len({n for *_, n in members}), len({s for s, *_ in members}), len(linked[t])))
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "source_id string, job_id string, text string, id string, root int")


@pytest.mark.parametrize("tile_rows", [256, 7])
def test_equals_all_pairs(spark, tile_rows):
    rows = corpus()
    got = sorted(tuple(r) for r in near_copies(table(spark, rows), F.col("text"), tile_rows=tile_rows).collect())
    assert got == by_hand(rows)


def test_recall_at_the_limit(spark):
    """Pairs just above the limit: at least 0.9 of them must be found."""
    rng = random.Random(3)
    rows = []
    for i in range(300):
        words = rng.choices(WORDS, k=104)  # 100 shingles, of which 11 or fewer are lost: 0.8 or more
        rows += [("a", f"{i}", " ".join(words)), ("b", f"{i}", " ".join(words[:-11] + rng.choices(WORDS, k=11)))]
    want = sum(r[-1] for r in by_hand(rows))
    found = sum(r.n_links for r in near_copies(table(spark, rows), F.col("text")).collect())
    assert want >= 500 and found >= 0.9 * want and found <= want


def test_a_hot_band_becomes_tiles_of_bounded_size(spark):
    rows = spark.range(900).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("band"))
    placed = near.in_parts(rows, ["band"], 50)
    sizes = [r["count"] for r in placed.groupBy("one", "other").count().collect()]
    assert len(sizes) == 18 * 19 // 2 and max(sizes) < 4 * 50
    pairs = placed.alias("a").join(placed.alias("b"), ["band", "one", "other"]).where(
        "a.id < b.id AND (one = other OR a.own <> b.own)"
    )
    assert pairs.count() == pairs.select("a.id", "b.id").distinct().count() == 900 * 899 // 2


def test_no_pair_is_listed(spark):
    """A group of n near copies costs rows in proportion to n, not to its pairs."""
    texts = table(spark, [r for r in corpus() if "end" in (r[2] or "")])
    keyed = texts.select(F.md5("text").alias("id"), near.shingle_hashes(F.col("text")).alias("hashes"))
    trees, numbers = near.links(keyed, tile_rows=16)
    parts = -(-90 // 16)
    assert trees.count() <= 90 * parts
    assert {r.n_links for r in numbers.collect()} <= set(range(1, 90))


def test_empty_table(spark):
    assert near_copies(table(spark, []), F.col("text")).collect() == []


def test_sketches_go_only_to_shared_buckets(spark, monkeypatch):
    """Texts are dealt to their buckets without sketches, which most buckets have no use for."""
    dealt, in_parts = [], near.in_parts

    def seen(rows, by, tile_rows):
        dealt.append((by, rows.columns))
        return in_parts(rows, by, tile_rows)

    monkeypatch.setattr(near, "in_parts", seen)
    hashes = [("a", list(range(40))), ("b", list(range(1, 40))), ("c", list(range(100, 140)))]
    _, numbers = near.links(spark.createDataFrame(hashes, "id string, hashes array<long>"))
    assert dealt[0] == (["band", "bucket"], ["id", "band", "bucket"])
    assert {tuple(r) for r in numbers.collect()} == {("a", 1), ("b", 1)}
