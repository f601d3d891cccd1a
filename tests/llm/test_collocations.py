import random
import re
from collections import Counter

import numpy as np
import pytest

import check
from jobweave.llm import collocations
from jobweave.llm.oracles import ORACLES
from jobweave.llm.queries import QUERIES


def by_hand(rows, least, top):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", folded):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            own = counts.setdefault(lang, Counter())
            own.update(tuple(words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        found = {p: c for p, c in own.items() if c >= least}
        ranked = []
        for p, a in found.items():
            if len(p) < 2 or any(len(q) > len(p) and c >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, c in found.items()):
                continue
            cuts = [(1000 * a * totals[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "x") for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, n int, phrase string")


def corpus(seed=1):
    rng = random.Random(seed)
    some = ["a", "B", "c", "dé", "e\x01", "e", "\x00", " ", "f g", "日本"]
    rare = [f"r{i}" for i in range(200)]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "! "]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(0, 60)):
            words += [rng.choice(some) if rng.random() < 0.8 else rng.choice(rare), rng.choice(ends)]
            if rng.random() < 0.1:
                words += ["of the Green house here", rng.choice(ends)]
        rows.append(("".join(words), rng.choice(["en", "en", "de", None, "und"])))
    rows += [("same words again and again. " * 3, "en")] * 15 + [(None, "en"), ("", None), (" \n.", "xx"), ("x " * 3000, "en"), ("lonely", "zz")]
    return rows


@pytest.mark.parametrize("least, top, entries", [(3, 2000, 1 << 20), (10, 7, 40), (1, 50, 500)])
def test_equals_brute_force(spark, least, top, entries, monkeypatch):
    rows = corpus()
    assert got(collocations.collocations(table(spark, rows), least, top=top, entries=entries)) == by_hand(rows, least, top)


def test_chunks_bursts_spills_and_vocabularies_change_nothing(monkeypatch):
    rows = corpus(2)
    texts = [t for t, lang in rows if t and lang == "en"]
    want = Counter()
    for t in texts:
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), t)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            want.update(tuple(words[i : i + 5]) for i in range(len(words) - 2))
    for chunk, burst, words, entries in [(1 << 20, 8192, 1 << 20, 1 << 20), (7, 2, 5, 10), (50, 1, 1 << 20, 3), (1, 3, 1, 1000)]:
        monkeypatch.setattr(collocations, "CHUNK", chunk)
        monkeypatch.setattr(collocations, "BUFFER", 4 * chunk)
        monkeypatch.setattr(collocations, "WORDS", words)
        counting = collocations.Counting("en", 3, 5, None, None)
        counting.trie.burst = burst
        found = Counter()
        runs = []
        for t in texts:
            runs += counting.read(t.encode().translate(collocations._FOLD))
            if counting.trie.size > entries:
                runs += counting.spill(entries // 2)
                assert counting.trie.size <= entries // 2
        counting.count(last=True)
        for run in [*runs, *counting.spill(0)]:
            keys = [tuple(r["head"].split(" ")) + tuple(w for w in (r["w4"], r["w5"]) if w is not None) for r in run.to_pylist()]
            assert keys == sorted(keys, key=lambda p: [" ".join(p[:3]).encode(), *(w.encode() for w in p[3:])])
            found.update(dict(zip(keys, run["n"].to_pylist())))
        assert found == want


def test_packed_and_plain_counts_agree():
    rng = np.random.default_rng(4)
    columns = [rng.integers(0, 4, 500).astype(np.int32) for _ in range(3)]
    plain = collocations.window_counts([*columns, np.zeros(500, np.int32)])
    assert {k[:12]: n for k, n in plain.items()} == collocations.window_counts(columns)


def test_burst_keeps_all_windows():
    trie = collocations.HatTrie(3, burst=2)
    rng = np.random.default_rng(1)
    want = Counter()
    for _ in range(20):
        own = Counter(row.astype(">u4").tobytes() for row in rng.integers(1, 5, (40, 3)))
        want.update(own)
        trie.add(own)
    assert trie.size == len(want)
    assert isinstance(next(iter(trie.root.values())), collocations.Branch)
    found = Counter()
    for run in trie.spill(0):
        found.update(run)
    assert found == want and trie.size == 0


def test_empty_table(spark):
    assert got(collocations.collocations(table(spark, []))) == []


def test_query_matches_sql(spark, data):
    same, note = check.compare(spark, check.connect(data), QUERIES["op12_collocations"], ORACLES["op12_collocations"], data)
    assert same, note
