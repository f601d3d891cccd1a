import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from jobweave.llm import perplexity as px

WORD = "[^\x20\x09-\x0d]+"


def counts_by_hand(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_base_counts_are_those_by_hand():
    rng = random.Random(2)
    texts = [None, "", " \t\n", "a", "é# b\n\n a\nb c\na", "x " * 3000, "a\x1cb \x85 c"]
    texts += ["".join(rng.choice(["a ", "b ", "c\n", "# ", "dd ", "\n"]) for _ in range(rng.randint(1, 200))) for _ in range(60)]
    got = px.base_counts(pa.array(texts))
    assert [tuple(r) for r in got.itertuples(index=False)] == [counts_by_hand(t) for t in texts]


def test_lines_of_other_blanks_are_lines():
    texts = ["a\n\u00a0\n\u00a0\nb", "\u3000\n\u3000\n\u3000", "\x1c\n\x1c\n \n \n\t", "\x85\nx\n\x85"]
    got = px.base_counts(pa.array(texts))
    assert [tuple(r) for r in got.itertuples(index=False)] == [counts_by_hand(t) for t in texts]
    assert got["n_dup_lines"].tolist() == [1, 2, 1, 1]


def kneser_ney(grams):
    """p(c | a, b) by the formulas, from {(a, b, c): count}."""
    pairs, units = Counter(g[1:] for g in grams), Counter()
    for g in pairs:
        units[g[1:]] += 1
    tables = [units, pairs, grams]

    def discount(table):
        n = [sum(v == k for v in table.values()) for k in range(1, 5)]
        if not all(n):
            return [0, 0.5, 0.5, 0.5]
        y = n[0] / (n[0] + 2 * n[1])
        return [0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.01), 0.99 * k) for k in (1, 2, 3)]

    discounts = [discount(t) for t in tables]

    def p(gram):
        order = len(gram)
        if not order:
            return 1 / px.SYMBOLS
        table, d = tables[order - 1], discounts[order - 1]
        same = {g: n for g, n in table.items() if g[:-1] == gram[:-1]}
        low = p(gram[1:]) if order > 1 else 1 / px.SYMBOLS
        if not same:
            return low
        total = sum(same.values())
        gamma = sum(d[min(n, 3)] for n in same.values()) / total
        n = table.get(gram, 0)
        return (n - d[min(n, 3)]) / total * (n > 0) + gamma * low

    return p


def test_probabilities_are_those_by_the_formulas():
    rng = random.Random(9)
    text = "".join(rng.choice("aaaabbcde ") for _ in range(700)).encode()
    data = np.frombuffer(text, np.uint8)
    codes, _ = px.symbol_codes(data, np.array([0, len(data)]))
    grams, n = np.unique(codes, return_counts=True)
    model = px.fit(grams, n)
    split = lambda g: (int(g) // 128**2, int(g) // 128 % 128, int(g) % 128)
    p = kneser_ney({split(g): int(k) for g, k in zip(grams, n)})
    wanted = [*map(int, grams[::5]), *(rng.randrange(128**3) for _ in range(40)), *(int(g) // 128 * 128 + 70 for g in grams[::9])]
    assert np.allclose(model.log_probability(np.array(wanted)), [math.log(p(split(g))) for g in wanted])
    for g in grams[::40]:
        every = int(g) // 128 * 128 + np.arange(128)
        assert abs(np.exp(model.log_probability(every)).sum() - 1) < 1e-9


def test_trigrams_of_several_texts_do_not_mix():
    data, offsets = px.text_bytes(pa.array(["ab", None, "c"]))
    codes, owner = px.symbol_codes(data, offsets)
    a, b, c = (int(px._CLASS[ord(x)]) for x in "abc")
    assert owner.tolist() == [0, 0, 0, 1, 2, 2]
    assert codes.tolist() == [a, a * 128 + b, (a * 128 + b) * 128, 0, c, c * 128]


def test_verdicts(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 7)))
    common = [word() for _ in range(300)]
    clean = lambda: " ".join(rng.choice(common) for _ in range(150))
    rows = [(i, clean(), "en" if i % 4 else None) for i in range(160)]
    junk = [(1000 + i, "".join(chr(rng.randint(33, 126)) + " " * (rng.random() < 0.3) for _ in range(900)), "en") for i in range(4)]
    odd = [(2000, None, "en"), (2001, "", None), (2002, "too short", "en"), (2003, "again and again it is said " * 40, "en"), (None, clean(), "fr"), (0, clean(), "en")]
    docs = spark.createDataFrame([(*r, "extra", 1) for r in rows + junk + odd], "doc_id long, text string, lang string, name string, lower int")
    got = px.judged(docs).collect()
    assert len(got) == len(rows) + len(junk) + len(odd)
    kept = {r.doc_id: r.kept for r in got if r.doc_id is not None and r.doc_id >= 1000}
    assert not any(kept.values())
    assert sum(r.kept for r in got if r.doc_id is not None and r.doc_id < 1000) >= 157
    assert {r.doc_id for r in got if r.base_failed} == {2000, 2001, 2002, 2003}


def test_all_of_a_text_weighs_under_its_own_language(spark):
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 7)))
    common = {"en": [word("abcdefghil") for _ in range(100)], "xx": [word("mnoprstuvw") for _ in range(100)]}
    clean = lambda lang, n: " ".join(rng.choice(common[lang]) for _ in range(n))
    rows = [(i, clean(lang, 150), lang) for i, lang in enumerate(["en", "xx"] * 200)]
    text = clean("en", 150)
    junk = "".join(rng.choice("abcdefghil") + " " * (rng.random() < 0.2) for _ in range(len(text) * 7 // 10))
    rows += [(1000, text + " " + junk, "en"), (1001, clean("xx", 150), "en")]
    got = {r.doc_id: r for r in px.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not got[1000].kept  # its smaller half is noise
    assert not got[1001].kept  # wholly in another learned language than its own
    assert sum(r.kept for i, r in got.items() if i < 1000) >= 390


def test_empty_table(spark):
    assert px.judged(spark.createDataFrame([], "doc_id long, text string, lang string")).collect() == []


def points(text):
    """Symbols of the trigrams of a text by a plain loop: code points, and None for the frame."""
    framed = [None, None, *map(ord, text or ""), None]
    return [tuple(framed[i : i + 3]) for i in range(len(framed) - 2)]


ODD = ["é", "É", "\u00a0\u2003", "\t \n\r", "\x00\x01\x7f", "\u4e2d\u6587\u6a94", "\U0001f600\U0001f601\U0010ffff", "", None, "a\u0300b", "\u0430\u0431\u0432 ab"]


def test_every_code_point_is_a_symbol_of_its_own():
    rng = random.Random(12)
    texts = ODD + ["".join(chr(rng.choice([rng.randrange(256), rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(rng.randrange(30))) for _ in range(200)]
    codes, owner = px.symbol_codes(*px.text_bytes(pa.array(texts)))
    by_hand = [(i, g) for i, x in enumerate(texts) for g in points(x)]
    assert owner.tolist() == [i for i, _ in by_hand]
    code_of = {}
    for (_, gram), code in zip(by_hand, codes.tolist()):
        assert code_of.setdefault(gram, code) == code
    assert len(set(code_of.values())) == len(code_of)  # no two trigrams are one
    for order in (1, 2):
        assert len({(g[-order:], c) for g, c in zip(code_of, px.last(np.array([*code_of.values()]), order).tolist())}) == len({g[-order:] for g in code_of})
    assert len({(g[:2], c) for g, c in zip(code_of, px.before(np.array([*code_of.values()])).tolist())}) == len({g[:2] for g in code_of})


def mixed(n):
    rng = random.Random(6)
    letters = {"en": "abcde  ", "ru": "\u0430\u0431\u0432\u0433\u0434 ", None: "ab\u4e2d\u6587\U0001f600"}
    rows = [(i % 50, "".join(rng.choice(letters[x]) for _ in range(rng.randrange(60))), x) for i in range(n) for x in letters]
    return rows + [(i, x, "" if i % 2 else None) for i, x in enumerate(ODD)] + [(7, "\u4e2d\u6587 abc" * 9, "en"), (7, rows[0][1], "en")]


def test_trigrams_are_counted_whole_however_few_are_held(spark, monkeypatch):
    rows = mixed(40)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    wanted = Counter((px._name(lang), g) for _, x, lang in rows for g in points(x))
    code_of = {g: c for _, x, _ in rows for g, c in zip(points(x), px.symbol_codes(*px.text_bytes(pa.array([x], pa.string())))[0].tolist())}
    for held in (px.HELD, 5):
        got = {(r.name, r.gram): r.n for r in px.count_trigrams(docs, held).collect()}
        assert got == {(name, code_of[g]): n for (name, g), n in wanted.items()}
    data, offsets = px.text_bytes(pa.array(["".join(x or "" for x in ODD) * 3]))
    whole = px.symbol_codes(data, offsets)[0]
    for size in (1, 2, 3, 7):
        monkeypatch.setattr(px, "SLICE_BYTES", size)
        assert np.concatenate([*px._pieces(data, offsets)]).tolist() == whole.tolist()


def test_levels_are_those_of_one_process(spark):
    rows = mixed(60)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    table = px.learn(docs).toPandas()
    assert not table.duplicated(["name", "gram"]).any()
    for name, part in table.groupby("name"):
        part = part.sort_values("gram")
        grams = part["gram"].to_numpy()
        model = px.fit(grams, part["n"].to_numpy(), px.ALPHABET)
        assert np.allclose(model.log_probability(grams), part["logp"])
        p = {k: model.find(px.last(grams, k), k)[0] for k in (1, 2)}
        weight = {k: model.find(px.before(px.last(grams, k)), k, context=True)[0] for k in (2, 3)}
        assert np.allclose(weight[3] + p[2], part["logp2"])
        assert np.allclose(weight[3] + weight[2] + p[1], part["logp1"])
        held = Counter()
        for g, n in zip(px.last(grams, 2).tolist(), part["n"]):
            held[g] += n
        assert [held[g] for g in px.last(grams, 2).tolist()] == part["n_pair"].tolist()


def test_perplexity_is_that_by_hand_whatever_travels(spark):
    rows = mixed(60)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = px.learn(docs)
    values = {(r.name, r.gram): r for r in model.collect()}

    def by_hand(text, lang):
        codes = px.symbol_codes(*px.text_bytes(pa.array([text], pa.string())))[0].tolist()
        own, pairs = Counter(codes), Counter(px.last(np.array(codes), 2).tolist())
        total = 0.0
        for c in codes:
            v = values[px._name(lang), c]
            total += v.logp1 if pairs[int(px.last(c, 2))] == v.n_pair else v.logp2 if own[c] == v.n else v.logp
        return round(-total / len(codes), 9)

    wanted = sorted((i, lang or "-", len(x or "") + 1, by_hand(x, lang)) for i, x, lang in rows)
    for most in (px.HEAD, 60, 0):
        got = px.measured(docs, model, most).collect()
        assert sorted((r.doc_id, r.lang or "-", r.n_codes, round(r.log_perplexity, 9)) for r in got) == wanted


def test_a_script_of_its_own_does_not_vouch_for_itself(spark):
    rng = random.Random(3)
    common = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 7))) for _ in range(200)]
    rows = [(i, " ".join(rng.choice(common) for _ in range(120)), "en") for i in range(120)]
    rows += [(1000 + i, " ".join("".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(4)) for _ in range(100)), "en") for i in range(3)]
    got = {r.doc_id: r for r in px.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(not got[1000 + i].kept and got[1000 + i].perplexity > 10 * got[1000 + i].upper for i in range(3))
    assert sum(got[i].kept for i in range(120)) >= 117
