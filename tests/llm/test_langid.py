import math
import random

import numpy as np
import pyarrow as pa
import pytest

from jobweave.llm import langid, queries

PARTS = {"aa": ["ka", "lo", "mi", "ru"], "bb": ["sch", "ung", "ö", "keit"], "cc": ["é", "eau", "tion", "que"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def net():
    rng = random.Random(1)
    return langid.train([(k, text(rng, k, 60).encode()) for k in PARTS for _ in range(30)], epochs=2)


def test_gradients_agree_with_differences():
    net = langid.start_weights(["a", "b", "c"], hidden=3, seed=2)
    codes, lengths = langid._padded([b"abcd", b"ba", b"cadab"], 5)
    target = np.array([0, 2, 1])
    for w in net.arrays():
        w[...] = w.astype(np.float32)
    _, grads = langid.gradients(net, codes, lengths, target)
    rng = np.random.default_rng(0)
    for w, g in zip(net.arrays(), grads):
        for _ in range(6):
            place = tuple(rng.integers(0, s) for s in w.shape)
            if len(w) == 256:
                place = (int(rng.choice([97, 98, 99, 100])), place[1])
            old = w[place]
            sides = []
            for d in (1e-2, -1e-2):
                w[place] = old + d
                sides.append(langid.gradients(net, codes, lengths, target)[0])
            w[place] = old
            assert abs((sides[0] - sides[1]) / 2e-2 - g[place]) < 2e-3


def states_by_hand(net, d, text):
    """States after each byte, a number at a time."""
    table, u, bias = net.table[d].tolist(), net.recurrent[d].tolist(), net.bias[d].tolist()
    n = len(bias)
    h, out = [0.0] * n, []
    for byte in text:
        x = table[byte]
        inner = [sum(h[i] * u[i][j] for i in range(n)) for j in range(3 * n)]
        z = [1 / (1 + math.exp(-x[j] - inner[j])) for j in range(n)]
        r = [1 / (1 + math.exp(-x[n + j] - inner[n + j])) for j in range(n)]
        new = [math.tanh(x[2 * n + j] + r[j] * (inner[2 * n + j] + bias[j])) for j in range(n)]
        h = [(1 - z[j]) * h[j] + z[j] * new[j] for j in range(n)]
        out.append(h)
    return out


def test_labels_are_those_of_a_pass_by_hand(net):
    out, bias = net.out.tolist(), net.out_bias.tolist()
    texts = ["ka lo miru", "tion é que eau", "x"]
    names, score, share = langid.predict(net, pa.array(texts))
    for text, name, p, labelled in zip(texts, names, score, share):
        raw = text.encode()
        both = [a + b for a, b in zip(states_by_hand(net, 0, raw), states_by_hand(net, 1, raw[::-1])[::-1])]
        logp = []
        for state in both:
            logits = [sum(s * out[i][k] for i, s in enumerate(state)) + bias[k] for k in range(len(bias))]
            total = math.log(sum(math.exp(v) for v in logits))
            logp.append([v - total for v in logits])
        mean = [sum(row[k] for row in logp) / len(raw) for k in range(len(bias))]
        weights = [math.exp(v) for v in mean]
        best = max(range(len(bias)), key=lambda k: mean[k])
        assert name == net.languages[best] and p == pytest.approx(weights[best] / sum(weights), abs=1e-4)
        assert labelled == pytest.approx(sum(max(range(len(bias)), key=lambda k: row[k]) == best for row in logp) / len(raw))


def test_predictions_do_not_depend_on_the_batch(net):
    rng = random.Random(5)
    texts = [text(rng, k, n) for k in PARTS for n in (1, 7, 300, 4000)] + [None, "", "12 34 !!", "ß"]
    names, score, share = langid.predict(net, pa.array(texts))
    assert names[:12] == [k for k in PARTS for _ in range(4)]
    assert names[12:15] == ["und"] * 3 and names[15] != "und" and not score[12:15].any()
    assert ((0 <= score) & (score <= 1)).all() and ((0 <= share) & (share <= 1)).all()
    for i, t in enumerate(texts):
        alone = langid.predict(net, pa.array([t], pa.string()))
        assert alone[0][0] == names[i] and abs(alone[1][0] - score[i]) < 1e-4


def test_long_texts_go_through_in_slices(net, monkeypatch):
    rng = random.Random(6)
    texts = pa.array([text(rng, "aa", 900), text(rng, "bb", 5), text(rng, "cc", 2000)])
    whole = langid.predict(net, texts)
    monkeypatch.setattr(langid, "SLICE_BYTES", langid.SEGMENT * 4)
    cut = langid.predict(net, texts)
    assert cut[0] == whole[0] and np.allclose(cut[1], whole[1], atol=1e-3)


def test_one_language_and_none():
    only = langid.train([("aa", b"ka lo")])
    assert langid.predict(only, pa.array(["x", None]))[0] == ["aa", "und"]
    none = langid.train([])
    assert langid.predict(none, pa.array(["x"]))[0] == ["und"]


def test_extra_columns_stay_and_empty_tables_work(spark, net):
    rows = [(1, "ka lo mi", "x"), (1, "ka lo mi", "x"), (None, None, None)]
    out = langid.with_language(spark.createDataFrame(rows, "doc_id long, text string, score string"), net).collect()
    assert [r.lang_pred for r in out] == ["aa", "aa", "und"] and [r.score for r in out] == ["x", "x", None]
    clash = spark.createDataFrame([(1, "ka lo mi", "x", "y")], "doc_id long, text string, Lang_Pred string, lang_score string")
    got = langid.with_language(clash, net).collect()
    assert [(r.lang_pred, type(r.lang_score)) for r in got] == [("aa", float)] and got[0].__fields__ == ["doc_id", "text", "lang_pred", "lang_score", "lang_share"]
    assert [tuple(r) for r in langid.with_language(clash, net, keep=0.0).collect()] == [(1, "ka lo mi", "x", "y")]
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.with_language(empty, net).collect() == [] and langid.training_rows(empty, empty.doc_id >= 0) == []


def test_held_out_accuracy(spark, data):
    got = queries.QUERIES["op10_language"](spark, data)
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows)
