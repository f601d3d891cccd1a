import math
from collections import Counter

import numpy as np
import pytest

from jobweave.llm import segment

WORDS = {" ": -3.0, "a": -2.0, "b": -2.2, " a": -1.0, "ab": -1.5, " ab": -1.2, "ba": -1.9, "aba": -2.5, "c": -4.0}


@pytest.fixture(scope="module")
def pieces():
    names = list(WORDS)
    raw = [bytes([i]) for i in range(256)] + [n.encode() for n in names]
    normal = [(256 + i, n.replace(" ", "▁")) for i, n in enumerate(names)]
    return segment.build(normal, np.array([WORDS[n] for n in names]), raw, np.arange(256))


def all_segmentations(text):
    """{ids' texts: probability}, with byte pieces for characters that are no piece."""
    floor = min(WORDS.values()) - 1

    def paths(rest):
        if not rest:
            yield (), 0.0
            return
        first = rest[0]
        arcs = [(w, s) for w, s in WORDS.items() if rest.startswith(w)]
        if first not in WORDS:
            arcs.append((first, floor * len(first.encode())))
        for w, s in arcs:
            # No piece goes on after a blank that follows a word.
            for tail, t in paths(rest[len(w) :]):
                yield (w, *tail), s + t

    found = dict(paths(" " + text)) if text else {(): 0.0}
    top = max(found.values())
    total = sum(math.exp(v - top) for v in found.values())
    return {k: math.exp(v - top) / total for k, v in found.items()}


def named(ids, pieces):
    out, run = [], b""
    for i in ids:
        if i >= 256:
            out.append(pieces.bytes_[i].decode())
        else:
            run += pieces.bytes_[i]
            try:
                out.append(run.decode())
                run = b""
            except UnicodeDecodeError:
                pass
    return tuple(out)


@pytest.mark.parametrize("text", ["aba", "ab ab", "abé ba", "a  b", "cc", "▁a"])
def test_every_segmentation_comes_once_with_its_probability(pieces, text):
    want = all_segmentations(text)
    (got,) = segment.sampled([text], np.array([7], np.uint64), segment.Cache(pieces), k=len(want) + 3)
    assert sorted(named(ids, pieces) for ids, *_ in got) == sorted(want)
    for ids, logp, value, score in got:
        assert abs(math.exp(logp) - want[named(ids, pieces)]) < 1e-6 and score == 0.0
        assert segment.decode(ids, pieces) == text
    assert [g[2] for g in got] == sorted((g[2] for g in got), reverse=True)


def test_samples_follow_the_law_of_drawing_without_replacement(pieces):
    text, n = "ab aba", 6000
    want = all_segmentations(text)
    got = segment.sampled([text] * n, np.arange(n).astype(np.uint64) * np.uint64(7919), segment.Cache(pieces), k=2)
    first = Counter(named(s[0][0], pieces) for s in got)
    second = Counter(named(s[1][0], pieces) for s in got)
    for path, p in want.items():
        later = sum(q * p / (1 - q) for other, q in want.items() if other != path)
        for seen, expected in ((first, p), (second, later)):
            assert abs(seen[path] / n - expected) < 5 * math.sqrt(expected * (1 - expected) / n) + 1e-9
    # Inclusion scores make sums over the samples unbiased.
    sums = [sum(math.exp(logp - score) for _, logp, _, score in s) for s in got]
    assert abs(np.mean(sums) - 1) < 5 * np.std(sums) / math.sqrt(n)
    assert all(named(s[0][0], pieces) != named(s[1][0], pieces) for s in got)


def test_rows_do_not_depend_on_their_neighbours(pieces):
    texts = ["ab aba", "", "c ab", "ab aba " * 500, "b" * 3000]
    seeds = np.array([3, 4, 5, 6, 7], np.uint64)
    together = segment.sampled(texts, seeds, segment.Cache(pieces), k=3)
    cache = segment.Cache(pieces)
    segment.sampled(["c c c ba"], seeds[:1], cache, k=1)
    for text, seed, rows in zip(texts, seeds, together):
        (alone,) = segment.sampled([text], np.array([seed], np.uint64), cache, k=3)
        assert [r[0].tolist() for r in alone] == [r[0].tolist() for r in rows]
        assert np.allclose([r[1:] for r in alone], [r[1:] for r in rows], rtol=1e-5)
        assert all(segment.decode(r[0], pieces) == text for r in rows)


def test_the_public_model_on_rows(spark):
    texts = ["Hello world, this is a text.", None, "", "two\nlines\tand ▁ é 漢字 \U0001f600", "   ", "x" * 2000, "Hello world, this is a text."]
    rows = [(i if i < 6 else 0, t, "extra", "more") for i, t in enumerate(texts)] + [(None, "no key", "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, seed string")
    got = segment.encode(docs, decoded=True).collect()
    assert all(r.restored for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.sample for r in by[3]] == [1, 2, 3] and len({tuple(r.ids) for r in by[3]}) == 3
    assert [r.ids for r in by[1]] == [[]] and [r.ids for r in by[2]] == [[]] and len(by[None]) == 3
    assert len(by[0]) == 6 and Counter(tuple(r.ids) for r in by[0]).most_common(1)[0][1] == 2
    assert all(r.log_inclusion <= 0 and r.log_prob <= 1e-9 for r in got)
    assert segment.encode(docs.limit(0)).collect() == []


def test_chunks_are_looked_up_and_spellings_compared_without_a_step_per_piece(pieces):
    texts = ["", " ", "a", "a ", " a", "a  b", "a b a b", "  ab   c ", "\u2581 \ufffd", "caf\u00e9 \U0001f600 x"]
    for text in texts:
        assert [" " + c for c in segment._behind_blank(text)] == segment.chunks(text)
    cache = segment.Cache(pieces)
    split = [segment._behind_blank(t) for t in texts]
    numbers = cache.look_up(split).tolist()
    flat = [c for parts in split for c in parts]
    assert len(set(zip(flat, numbers))) == len(set(flat)) == len(cache.lattices.root)
    assert cache.look_up(split).tolist() == numbers and len(cache.lattices.root) == len(set(flat))
    ids = [segment.sampled([t], np.array([5], np.uint64), cache, k=1)[0][0][0] for t in texts]
    wrong = [t + "?" for t in texts]
    for against in (texts, wrong):
        got = segment.restored(np.concatenate(ids), np.cumsum([len(x) for x in ids]), against, segment._spelling(pieces), pieces)
        assert got == [segment.decode(x, pieces) == t for x, t in zip(ids, against)] == [against is texts] * len(texts)
    # Bytes that are no text are spelled as U+FFFD, and so may a text be.
    broken = pieces.byte_ids[[0x20, 0xFF]].astype(np.int32)
    assert segment.restored(broken, np.array([2]), ["\ufffd"], segment._spelling(pieces), pieces) == [True]


def test_a_cache_that_starts_anew_changes_nothing(pieces, monkeypatch):
    texts = [f"abc ab{i} caf\u00e9 {i % 3}" for i in range(40)]
    seeds = np.arange(40).astype(np.uint64)
    together = segment.sampled(texts, seeds, segment.Cache(pieces), k=2)
    monkeypatch.setattr(segment, "CACHED_ARCS", 30)
    cache, anew = segment.Cache(pieces), []
    rooms = cache.rooms
    for i in range(0, 40, 4):
        anew += segment.sampled(texts[i : i + 4], seeds[i : i + 4], cache, k=2)
    assert cache.rooms is rooms and len(cache.numbers) < len({c for t in texts for c in segment.chunks(t)})
    for got, want in zip(anew, together, strict=True):
        assert [r[0].tolist() for r in got] == [r[0].tolist() for r in want]
        assert np.allclose([r[1:] for r in got], [r[1:] for r in want])


def test_states_are_looked_up_by_hash_and_last_arcs_end_a_draw(pieces):
    rng = np.random.default_rng(5)
    letters = list("abcdefghé漢\U0001f600 ")
    names = sorted({"".join(rng.choice(letters, rng.integers(1, 9))) for _ in range(3000)})
    raw = [bytes([i]) for i in range(256)] + [n.encode() for n in names]
    normal = [(256 + i, n.replace(" ", "▁")) for i, n in enumerate(names)]
    many = segment.build(normal, -np.log(np.arange(len(names)) + 3.0), raw, np.arange(256))
    used = np.flatnonzero(many.keys >= 0)
    assert len(used) < len(many.keys) / 2 and sorted(many.states[used]) == sorted(set(many.states[used]))
    assert (segment._home(many.keys[used], len(many.keys)) != used).any()  # some stand behind others
    state, character = (many.keys[used] >> 21).astype(np.int32), (many.keys[used] & (1 << 21) - 1).astype(np.int32)
    assert (segment._after(many, state, character) == many.states[used]).all()
    known = set(many.keys[used].tolist())
    for shift in (1, 7):
        got = segment._after(many, state, character + shift)
        assert [bool(x) for x in got] == [(int(s) << 21 | int(c) + shift) in known for s, c in zip(state, character)]
    assert segment._after(pieces, state[:0], character[:0]).tolist() == []
    lat = segment.lattices([" ab", " aba", " c"], pieces)
    ends = np.unique(lat.last_arc[lat.first_arc <= lat.last_arc])
    assert (lat.upto[ends] == 2).all() and (np.delete(lat.upto, ends) < 1).all()
    # A vocabulary of single characters has no state to look up.
    single = segment.build([(256, "▁"), (257, "a")], np.array([-2.0, -1.0]), raw[:256] + [b" ", b"a"], np.arange(256))
    ((ids, *_),) = segment.sampled(["aab"], np.array([1], np.uint64), segment.Cache(single), k=2)[0]
    assert segment.decode(ids, single) == "aab"
