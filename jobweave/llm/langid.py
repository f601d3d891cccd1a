"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read a text's UTF-8 bytes forwards and backwards; at each position a softmax
over both states gives the probability of every language, and a document's probabilities are the
geometric mean of those of its positions. The network is trained in numpy by backpropagation through time
on windows of a bounded number of labelled documents for each language, and is a few kilobytes.

Texts are read whole, in segments of `SEGMENT` bytes that start from a zero state, so that all segments of
a batch advance in step; a segment's first positions see less on one side, as those of a text do.

Defined results: a text that is null, empty or has no letter is `und` with score 0. With fewer than two
languages to learn from, the only one is predicted with probability 1 (or all texts are `und`). Of languages
equally likely the first in order is predicted. Documents with equal ids are judged each by its text, equal texts
alike. An empty table gives an empty one. Extra columns are no input; they stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import extended, slices, text_bytes, without

UNKNOWN = "und"
HIDDEN = 8
SEGMENT = 192
# Bounds of the training sample: documents of a language, windows of a document, and their length.
DOCS_PER_LANGUAGE = 240
WINDOWS_PER_DOC = 10
WINDOWS_PER_LANGUAGE = DOCS_PER_LANGUAGE * WINDOWS_PER_DOC
WINDOW = 48
BATCH = 128
EPOCHS = 6
RATE = 0.02
SLICE_BYTES = 3 << 19
SEED = 7
# Bytes that can belong to a letter are looked up first; only texts without any go through a pattern.
LETTER = r"\p{L}"


@dataclass
class Network:
    """Weights of both directions: input table (256 x 3h), recurrent (h x 3h), and the output layer."""

    languages: list[str]
    table: list[np.ndarray]
    recurrent: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [*self.table, *self.recurrent, *self.bias, self.out, self.out_bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, -1, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def start_weights(languages: list[str], hidden: int = HIDDEN, seed: int = SEED) -> Network:
    rng = np.random.default_rng(seed)
    draw = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
    return Network(
        languages,
        [draw(256, 3 * hidden, s=0.5) for _ in range(2)],
        [draw(hidden, 3 * hidden, s=hidden**-0.5) for _ in range(2)],
        [np.zeros(hidden, np.float32) for _ in range(2)],
        draw(2 * hidden, len(languages), s=0.3),
        np.zeros(len(languages), np.float32),
    )


def _states(net: Network, d: int, codes: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (T x h x B) of one direction over codes (T x B); bytes are given in reading order.

    z and r are the update and reset gates: h' = (1 - z) h + z tanh(x + r (U h + b)).
    """
    steps, n = codes.shape
    table = net.table[d].T.copy()
    hidden = table.shape[0] // 3
    recurrent, bias = net.recurrent[d].T.copy(), net.bias[d][:, None]
    h, out = np.zeros((hidden, n), np.float32), np.empty((steps, hidden, n), np.float32)
    for t in range(steps):
        x = np.take(table, codes[t], axis=1)
        u = recurrent @ h
        gates = _sigmoid(x[: 2 * hidden] + u[: 2 * hidden])
        z, r = gates[:hidden], gates[hidden:]
        inner = u[2 * hidden :] + bias
        new = np.tanh(x[2 * hidden :] + r * inner)
        if keep is not None:
            keep.append((h, z, r, inner, new))
        h = h + z * (new - h)
        out[t] = h
    return out


def _backwards(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Row numbers (T x B) that read every column's first `lengths` entries from its end; its own inverse."""
    t = np.arange(codes.shape[0])[:, None]
    return np.where(t < lengths, lengths - 1 - t, t)


def position_logits(net: Network, codes: np.ndarray, lengths: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Scores (T x L x B) of every language at every position of codes (T x B)."""
    hidden = net.recurrent[0].shape[0]
    turn = _backwards(codes, lengths)
    kept = [[], []] if keep is not None else [None, None]
    forward = _states(net, 0, codes, kept[0])
    backward = _states(net, 1, np.take_along_axis(codes, turn, 0), kept[1])
    aligned = np.take_along_axis(backward, turn[:, None, :], 0)
    if keep is not None:
        keep += [kept, forward, aligned, turn]
    w = net.out.T
    return w[:, :hidden] @ forward + w[:, hidden:] @ aligned + net.out_bias[:, None]


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def gradients(net: Network, codes: np.ndarray, lengths: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all positions, and its gradient for every weight, through all time steps."""
    hidden, (steps, n) = net.recurrent[0].shape[0], codes.shape
    keep: list = []
    logp = _log_softmax(position_logits(net, codes, lengths, keep))
    kept, forward, aligned, turn = keep
    real = (np.arange(steps)[:, None] < lengths).astype(np.float32)
    total = real.sum()
    hit = np.take_along_axis(logp, np.broadcast_to(target[None, None, :], (steps, 1, n)), 1)[:, 0]
    loss = -float((hit * real).sum() / total)
    g = np.exp(logp)
    np.put_along_axis(g, np.broadcast_to(target[None, None, :], (steps, 1, n)), np.exp(hit)[:, None] - 1, 1)
    g *= (real / total)[:, None, :]
    both = np.concatenate([forward, aligned], axis=1)
    g_out = np.einsum("thb,tlb->hl", both, g, optimize=True)
    g_states = np.einsum("hl,tlb->thb", net.out, g, optimize=True)
    g_table, g_rec, g_bias = [], [], []
    for d in range(2):
        gs = g_states[:, d * hidden : (d + 1) * hidden]
        order = codes
        if d:
            gs, order = np.take_along_axis(gs, turn[:, None, :], 0), np.take_along_axis(codes, turn, 0)
        table, rec, bias = np.zeros_like(net.table[d]), np.zeros_like(net.recurrent[d]), np.zeros_like(net.bias[d])
        gh = np.zeros((hidden, n), np.float32)
        for t in range(steps - 1, -1, -1):
            h, z, r, inner, new = kept[d][t]
            gh = gh + gs[t]
            g_new = gh * z * (1 - new * new)
            gz = gh * (new - h) * z * (1 - z)
            gr = g_new * inner * r * (1 - r)
            gx = np.concatenate([gz, gr, g_new])
            gu = np.concatenate([gz, gr, g_new * r])
            np.add.at(table, order[t], gx.T)
            rec += h @ gu.T
            bias += (g_new * r).sum(axis=1)
            gh = gh * (1 - z) + net.recurrent[d] @ gu
        g_table.append(table)
        g_rec.append(rec)
        g_bias.append(bias)
    return loss, [*g_table, *g_rec, *g_bias, g_out, g.sum(axis=(0, 2))]


def _padded(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    codes = np.zeros((len(texts), width), np.uint8)
    for i, text in enumerate(texts):
        codes[i, : len(text)] = np.frombuffer(text, np.uint8)
    return codes.T.copy(), np.array([len(t) for t in texts])


def train(rows: list[tuple[str, bytes]], hidden: int = HIDDEN, seed: int = SEED, epochs: int = EPOCHS) -> Network:
    """Fit the network to (language, text) rows: windows drawn evenly from all of each language's texts."""
    rng = np.random.default_rng(seed)
    languages = sorted({lang for lang, _ in rows})
    net = start_weights(languages, hidden, seed)
    if len(languages) < 2:
        return net
    windows: list[tuple[int, bytes]] = []
    for number, lang in enumerate(languages):
        texts = [t for name, t in sorted(rows) if name == lang and t]
        for i in range(WINDOWS_PER_LANGUAGE if texts else 0):
            text = texts[i % len(texts)]
            at = int(rng.integers(0, max(1, len(text) - WINDOW + 1)))
            windows.append((number, text[at : at + WINDOW]))
    weights = net.arrays()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step, steps = 0, epochs * -(-len(windows) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            batch = [windows[i] for i in order[at : at + BATCH]]
            codes, lengths = _padded([t for _, t in batch], WINDOW)
            _, grads = gradients(net, codes, lengths, np.array([k for k, _ in batch]))
            step += 1
            norm = max(1.0, float(np.sqrt(sum((g * g).sum() for g in grads))))
            rate = RATE * (1 - step / (steps + 1))
            for w, g, a, b in zip(weights, grads, first, second):
                g = g / norm
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                w -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return net


def label_segments(net: Network, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each segment: log probabilities summed over its positions, and how many positions each language
    labels, both (B x L)."""
    logp = _log_softmax(position_logits(net, codes, lengths))
    real = np.arange(len(codes))[:, None] < lengths
    best = logp.argmax(axis=1)
    votes = np.stack([((best == k) & real).sum(axis=0) for k in range(logp.shape[1])], axis=1)
    return np.where(real[:, None, :], logp, 0).sum(axis=0, dtype=np.float64).T, votes


def predict(net: Network, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, its probability, and the share of positions labelled with it, for every text."""
    n, k = len(texts), len(net.languages)
    data, offsets = text_bytes(texts)
    sums, votes = np.zeros((n, max(k, 1))), np.zeros((n, max(k, 1)))
    for lo, hi in slices(np.diff(offsets), SLICE_BYTES) if k > 1 else []:
        # A single long text is cut too: its segments go through in slices.
        for part in range(int(offsets[lo]), int(offsets[hi]), SLICE_BYTES - SLICE_BYTES % SEGMENT):
            end = min(int(offsets[hi]), part + SLICE_BYTES - SLICE_BYTES % SEGMENT)
            a = np.maximum(offsets[lo:hi], part)
            size = np.maximum(np.minimum(offsets[lo + 1 : hi + 1], end) - a, 0)
            pieces = -(-size // SEGMENT)
            owner = np.repeat(np.arange(lo, hi), pieces)
            if not len(owner):
                continue
            number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = np.repeat(a, pieces) + number * SEGMENT
            lengths = np.minimum(np.repeat(a + size, pieces) - start, SEGMENT)
            # Short segments go together, so that a slice of short texts takes no more steps than it must.
            order = np.argsort(lengths, kind="stable")
            for chosen in np.array_split(order, max(1, len(order) // 1024)):
                width = int(lengths[chosen].max())
                places = np.minimum(start[chosen] + np.arange(width)[:, None], len(data) - 1)
                s, v = label_segments(net, data[places], lengths[chosen])
                np.add.at(sums, owner[chosen], s)
                np.add.at(votes, owner[chosen], v)
    length = np.maximum(np.diff(offsets), 1)[:, None]
    mean = sums / length
    p = np.exp(mean - mean.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    known = pc.match_substring_regex(texts, LETTER).fill_null(False).to_numpy(zero_copy_only=False) if k else np.zeros(n, bool)
    names = [net.languages[b] if ok else UNKNOWN for b, ok in zip(best, known)]
    share = votes[np.arange(n), best] / length[:, 0] if k > 1 else np.ones(n)
    return names, np.where(known, p[np.arange(n), best], 0.0), np.where(known, share, 0.0)


def training_rows(docs: DataFrame, usable: Column, per_language: int = DOCS_PER_LANGUAGE) -> list[tuple[str, bytes]]:
    """(language, window) from at most `per_language` usable documents of each language: those with the smallest
    hash of id and language, so that the sample is spread over the table. Ids are ranked first, in parts
    before the shuffle. Of each chosen text, however long, `WINDOWS_PER_DOC` windows reach the driver, from
    places all over it that follow from a hash."""
    rank = Window.partitionBy("lang").orderBy("h", "doc_id")
    ids = docs.where(usable & F.col("lang").isNotNull() & (F.octet_length("text") > 0)).select(
        "doc_id", "lang", F.xxhash64("doc_id", "lang").alias("h")
    )
    chosen = ids.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= per_language)
    keys = {(r["doc_id"], r["lang"]) for r in chosen.select("doc_id", "lang").collect()}
    if not keys:
        return []
    places = F.greatest(F.length("text") - WINDOW + 1, F.lit(1))
    cut = F.transform(
        F.sequence(F.lit(1), F.lit(WINDOWS_PER_DOC)),
        lambda i: F.substring(F.col("text"), F.pmod(F.xxhash64("doc_id", i), places).cast("int") + 1, F.lit(WINDOW)),
    )
    texts = docs.where(usable & F.col("doc_id").isin([k for k, _ in keys])).select("doc_id", "lang", F.array_distinct(cut).alias("windows"))
    return sorted(
        (r["lang"], w.encode()) for r in texts.distinct().collect() if (r["doc_id"], r["lang"]) in keys for w in r["windows"] or [] if w
    )


def with_language(docs: DataFrame, net: Network, text: str = "text", keep: float | None = None) -> DataFrame:
    """All columns of `docs` with lang_pred, lang_score and lang_share, which replace columns so named; with
    `keep`, only the columns of `docs`, unchanged, and only rows with a language of at least that score."""
    new = [("lang_pred", "string"), ("lang_score", "double"), ("lang_share", "double")] if keep is None else []
    docs = without(docs, *(name for name, _ in new))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score, share = predict(net, batch[text])
            if keep is not None:
                yield batch.filter(pa.array([n != UNKNOWN and s >= keep for n, s in zip(names, score)], pa.bool_()))
                continue
            for (name, _), values in zip(new, (pa.array(names, pa.string()), pa.array(score), pa.array(share))):
                batch = batch.append_column(name, values)
            yield batch

    return docs.mapInArrow(work, extended(docs, *new))
