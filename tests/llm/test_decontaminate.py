import itertools
import random
import re

from jobweave.llm import decontaminate as dc
from jobweave.llm.queries import QUERIES


def words(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def best(doc, item, diagonal):
    """(score, start, n, equal) of the best segment of a diagonal, by looking at all segments."""
    lo, hi = max(diagonal, 0), min(len(doc), len(item) + diagonal)
    found = (0, 0, 0, 0)
    for a in range(lo, hi):
        score = equal = 0
        for b in range(a, hi):
            same = doc[b] == item[b - diagonal]
            score += 1 if same else -dc.PENALTY
            equal += same
            if score > found[0]:
                found = (score, a, b + 1 - a, equal)
    return found


def by_hand(docs, items):
    out = set()
    for doc_id, text in docs:
        d = words(text)
        for item_id, item_text in items:
            w, found = words(item_text), []
            for diagonal in range(-len(w) + 1, len(d)):
                seeded = any(
                    all(d[p + i] == w[p - diagonal + i] for i, c in enumerate(mask) if c == "1")
                    for mask in dc.MASKS
                    for p in range(max(diagonal, 0), min(len(d), len(w) + diagonal) - len(mask) + 1)
                )
                if seeded:
                    score, start, n, equal = best(d, w, diagonal)
                    if n >= min(dc.MIN_WORDS, len(w)) and equal >= dc.MIN_IDENTITY * n:
                        found.append((equal, n, -start, diagonal))
            if found:
                equal, n, early, diagonal = max(found)
                out.add((doc_id, item_id, n, equal, -early, -early - diagonal))
    return out


def sample():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "straße"]
    line = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, line(rng.choice([4, 12, 15, 30, 45]))) for i in range(12)]
    docs = []
    for i in range(60):
        text = line(rng.randint(0, 80))
        if i % 3 == 0:
            passage = list(rng.choice(items)[1])
            for _ in range(rng.choice([0, 0, 1, 3])):
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randint(0, len(text))
            text[at:at] = passage if i % 2 else passage[: max(10, len(passage) // 2)]
        docs.append((i, " ".join(text)))
    return docs, [(i, " ".join(w)) for i, w in items]


def test_overlaps_are_those_by_hand(spark):
    docs, items = sample()
    docs += [(900, None), (901, ""), (902, items[3][1].upper().replace(" ", ",\n")), (903, "x " * 30_000 + items[3][1])]
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, item_id int, key string")
    b = spark.createDataFrame([(*r, "x") for r in items] + [(50, None, ""), (51, "", ""), (52, "one two", "")], "item_id long, text string, hashes string")
    got = {tuple(r) for r in dc.overlaps(d, b, trimmed=True).collect()}
    want = by_hand(docs[:-1], items) | {(903, *r[1:4], r[4] + 30_000, r[5]) for r in by_hand([(903, items[3][1])], items)}
    assert got == want and len({r[0] for r in got}) > 6


def unseeded(docs, items):
    """Overlaps by looking at all segments of all diagonals."""
    out = set()
    for doc_id, text in docs:
        d = words(text)
        for item_id, item_text in items:
            w, found = words(item_text), []
            for diagonal in range(-len(w) + 1, len(d)):
                lo, hi = max(diagonal, 0), min(len(d), len(w) + diagonal)
                same = [d[p] == w[p - diagonal] for p in range(lo, hi)]
                good = []
                for a in range(len(same)):
                    equal = 0
                    for b in range(a, len(same)):
                        equal += same[b]
                        if 4 * equal >= 3 * (b + 1 - a):
                            good.append((b + 1 - a, equal, -a - lo))
                n, equal, early = max(good, default=(0, 0, 0))
                if n >= min(dc.MIN_WORDS, len(w)):
                    found.append((equal, n, early, diagonal))
            if found:
                equal, n, early, diagonal = max(found)
                out.add((doc_id, item_id, n, equal, -early, -early - diagonal))
    return out


def test_no_overlap_is_lost(spark):
    rng = random.Random(5)
    line = lambda n: [f"w{rng.randrange(200)}" for _ in range(n)]
    items = [(i, line(n)) for i, n in enumerate([1, 3, 5, 8, 9, 11, 12, 13, 14, 16, 20, 24, 130])]
    docs = []
    for i, (_, item) in enumerate(items[:-1]):
        for k in range(6):
            passage = list(item)
            differ = rng.sample(range(len(item)), len(item) // 4 + (k == 5))
            for p in [11, 12][:k] if len(item) == 13 and k < 3 else differ:  # near the end, where trimming cuts
                passage[p] = "changed"
            docs.append((10 * i + k, " ".join(line(rng.randrange(12)) + passage + line(rng.randrange(12)))))
    docs.append((900, " ".join(w if p % 5 else "changed" for p, w in enumerate(items[-1][1]))))
    rows = [(i, " ".join(w)) for i, w in items]
    want = unseeded(docs, rows)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(rows, "item_id long, text string")
    assert {tuple(r) for r in dc.overlaps(d, b, trimmed=False).collect()} == want
    assert {r[0] for r in want} >= {70, 71, 72, 73, 74, 900}  # 13 words with up to 3 differences, and a long item
    assert {r.doc_id for r in dc.without_overlaps(d, b).collect()} == {i for i, _ in docs} - {r[0] for r in want}


def test_masks_hit_whatever_differs():
    def hit(mask, n, differ):
        return any(all(mask[p - at] == "0" for p in differ if at <= p < at + len(mask)) for at in range(n - len(mask) + 1))

    for n in [*range(1, 18), 20]:
        masks = dc.whole_masks(n) if n < dc.MIN_WORDS else dc.MASKS
        assert all(any(hit(m, n, differ) for m in masks) for differ in itertools.combinations(range(n), n // 4)), n


def test_copies_ties_and_empty_tables(spark):
    _, items = sample()
    text = next(t for _, t in items if len(t.split()) >= 15)
    d = spark.createDataFrame([(1, text), (1, text), (2, text + " " + text), (None, "a b " + text)], "doc_id long, text string")
    b = spark.createDataFrame([(7, text), (5, text.upper()), (9, text + ".")], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.doc_start) for r in dc.overlaps(d, b).collect()), key=str)
    assert got == sorted([(1, 5, 0), (2, 5, 0), (None, 5, 2)], key=str)
    assert {tuple(r) for r in dc.item_classes(b).collect()} == {(7, 5), (5, 5), (9, 5)}
    assert dc.overlaps(d.limit(0), b).collect() == [] and dc.overlaps(d, b.limit(0)).collect() == []
    other = d.unionByName(spark.createDataFrame([(3, "clean words only"), (1, "clean too")], "doc_id long, text string"))
    assert sorted(r.text for r in dc.without_overlaps(other, b).collect()) == ["clean too", "clean words only"]


def test_rows_name_all_equal_items(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(15))
    items = [(7, text), (5, text.upper()), (9, text + "."), (8, text + " more")]
    spark.createDataFrame([(1, text), (2, "clean")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = QUERIES["op8_decontaminate"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.item_id, r.item_ids) for r in got) == [(1, 5, [5, 7, 9]), (1, 8, [8])]


def test_no_python_in_the_plan(spark):
    docs, items = sample()
    plan = dc.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_a_caller_keeps_all_columns(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(1, text, "a", "b"), (2, "clean words only", "c", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row_key string, `key` string")
    items = spark.createDataFrame([(7, text)], "item_id long, text string")
    got = dc.without_overlaps(docs, items)
    assert got.columns == docs.columns and list(map(tuple, got.collect())) == [rows[1]]
    assert dc.without_overlaps(docs, items.where("item_id < 0")).count() == 2
    assert dc.without_overlaps(docs.where("doc_id < 0"), items).count() == 0
