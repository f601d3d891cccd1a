import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import check
from jobweave.llm import reversedsearch
from jobweave.llm.oracles import ORACLES
from jobweave.llm.queries import QUERIES

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_hand(docs, items, k=10):
    found = [(i, Counter(terms(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n_docs, n_terms = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in found:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()], key=str)


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, item string"),
        spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, rank int, block string"),
    )


def corpus():
    rng = random.Random(1)
    words = ["Alpha", "beta", "été", "日本", "x1", "the", "THE", " ", "\x1c", "gamma", "[", "`", "{", "\x7f", "é\x00é"] + [f"w{i}" for i in range(60)]
    docs = [(i, rng.choice([" ", "-", "\n"]).join(rng.choices(words, k=rng.randrange(0, 40)))) for i in range(300)]
    docs += [(i, docs[7][1]) for i in range(1000, 1040)] + [(7, docs[7][1]), (None, docs[7][1]), (5000, None), (5001, ""), (5002, "... !"), (5003, "the w1 " * 5000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for i in range(30)]
    items += [(3, "the alpha"), (None, docs[7][1]), (100, None), (101, ""), (102, "nowhere found"), (103, "the")]
    return docs, items


@pytest.mark.parametrize("k, postings", [(10, 1 << 18), (3, 20)])
def test_equals_brute_force(spark, k, postings, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(reversedsearch, "SLICE_POSTINGS", 200)
    assert got(reversedsearch.ranked(*tables(spark, docs, items), k, postings)) == by_hand(docs, items, k)


def test_terms_are_those_of_the_pattern():
    for text in ["Ünï-cödé É", "a\x85b c", "\x1c\x1d1_2", "日本 語", "İI", "".join(map(chr, range(1, 300)))]:
        assert [t.decode() for t in reversedsearch.terms(text)] == terms(text)


def test_sums_beyond_doubles():
    index = reversedsearch._index([{b"a", b"b"}, {b"b"}])
    w = np.array([2**40, 2**40 + 1])
    counts = [(3, Counter({0: 1, 1: 2})), (1, Counter({1: 1}))]
    m = [10 + 90 * n * 2 // 4 for n, _ in counts]
    value = lambda t, tf, d: int(w[t]) * (10**9 * tf // (1000 * tf + 8 * m[d]))
    want = [[value(0, 1, 0) + value(1, 2, 0), value(1, 2, 0)], [value(1, 1, 1), value(1, 1, 1)]]
    assert reversedsearch.document_scores(counts, index, w, 2, 4).tolist() == want


def test_empty_tables(spark):
    docs, items = corpus()
    assert got(reversedsearch.ranked(*tables(spark, [], items))) == []
    assert got(reversedsearch.ranked(*tables(spark, docs, []))) == []
    assert got(reversedsearch.ranked(*tables(spark, [(1, "...")], items))) == []


def test_blocks_are_bounded(spark):
    _, items = corpus()
    found = list(reversedsearch.item_blocks(tables(spark, [], items)[1], postings=12, most=2))
    assert all(len(ids) <= 2 and (len(index.items) <= 12 or len(ids) == 1) for ids, index in found)
    assert sum(len(ids) for ids, _ in found) == sum(bool(terms(t)) for _, t in items)


def test_query_matches_sql(spark, data):
    same, note = check.compare(spark, check.connect(data), QUERIES["op13_reversed_search"], ORACLES["op13_reversed_search"], data)
    assert same, note
