"""SentencePiece encoding with sampled segmentations, and decoding.

A text is cut into chunks, a run of blanks with the word behind it, as no piece goes on after a word's end.
The lattice of a chunk has an arc for every piece of the vocabulary that stands in it, and byte pieces for
characters without one. Arc weights are the model's log probabilities; a BPE model has merge ranks only, and
piece number r gets the Zipf weight log(1 / (r + `ZIPF`)). A segmentation of the text is a path through the
lattices of all chunks, and its probability that of the path among all paths.

Gumbel top-k without replacement: every set of segmentations has a perturbed log probability, its log
probability plus the maximum of Gumbel noise, and the sets are split best first. A* search needs no estimate
here, as backward sums give the exact value of a set. The best set is followed down to one segmentation: its
parts inherit the set's value along the way and are drawn chunk by chunk, arc by arc; at each chunk what
differs from the drawn path there is a set of its own, with a value drawn below that of its parent. Popping
the k best of these sets in turn gives k distinct segmentations, drawn in proportion to their probabilities
without replacement. With the (k + 1)-th value as threshold t, the inclusion score of a segmentation with log
probability l is log(1 - exp(-exp(l - t))), the probability to be among those above t; 0 if there are no more.

All noise comes from a hash of the row's key, the sample, the chunk and the step, so that rows do not depend on
partitioning and a repeated task repeats them.

Chunks that occur often share their lattice; chunks of many texts are drawn side by side. Texts are whole, in
slices of `SLICE_CHARS` characters, or single ones beyond it.

Defined results: null and empty texts have one segmentation, without pieces; a text with fewer than k
segmentations gives all it has. Rows with equal keys and texts get equal samples; a null key is a key like any
other; extra columns are ignored, and an empty table gives an empty one.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 3
ZIPF = 2.7
SEED = 20_240_601
SLICE_CHARS = 1 << 18
CACHED_ARCS = 2_500_000
SPACE, LITERAL_SPACE = 0x2581, 0x110000  # the piece for a blank, and that character standing in a text
NARROW = 0x250
_CHUNK = re.compile(" *[^ ]+| +")
_EMPTY = 1e-12


@dataclass
class Pieces:
    """A vocabulary as a trie: states by first character, by the first two where both are narrow, and by
    (state, character) in the hash table `keys`, where -1 is free; `ends` has the piece that ends in a state."""

    first: np.ndarray
    pairs: np.ndarray
    keys: np.ndarray
    states: np.ndarray
    ends: np.ndarray
    scores: np.ndarray
    bytes_: list[bytes]
    byte_ids: np.ndarray
    byte_score: float


def load(path: str = MODEL) -> Pieces:
    """The vocabulary of a SentencePiece model with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    byte_ids = np.zeros(256, np.int64)
    raw: list[bytes] = []
    normal = []
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            raw.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            raw.append(b"")
        else:
            raw.append(piece.replace("▁", " ").encode())
            normal.append((i, piece))
    scores = np.array([model.get_score(i) for i in range(n)])
    own = scores[[i for i, _ in normal]]
    if np.mean(own == -np.arange(len(own))) > 0.9:  # merge ranks
        own = -np.log(np.arange(len(own)) + ZIPF)
        own -= np.log(np.exp(own).sum())
    return build(normal, own, raw, byte_ids)


def _narrow(c):
    """Characters below `NARROW` - 1, and the blank, numbered for the table of pairs; `NARROW` for others."""
    return np.where(c < NARROW - 1, c, np.where(c == SPACE, NARROW - 1, NARROW))


def build(normal: list[tuple[int, str]], own: np.ndarray, raw: list[bytes], byte_ids: np.ndarray) -> Pieces:
    scores = np.zeros(len(raw))
    for (i, _), s in zip(normal, own):
        scores[i] = s
    nodes: dict[tuple[int, int], int] = {}
    ends = [-1]
    for i, piece in normal:
        state = 0
        for c in map(ord, piece):
            after = nodes.get((state, c))
            if after is None:
                after = nodes[(state, c)] = len(ends)
                ends.append(-1)
            state = after
        ends[state] = i
    first = np.zeros(LITERAL_SPACE + 1, np.int32)
    for (state, c), after in nodes.items():
        if not state:
            first[c] = after
    pairs = np.zeros((NARROW, NARROW), np.int32)
    near = {c: i for i, c in enumerate((*range(NARROW - 1), SPACE))}
    began = {after: near[c] for (state, c), after in nodes.items() if not state and c in near}
    for (state, c), after in nodes.items():
        if state in began and c in near:
            pairs[began[state], near[c]] = after
    inner = sorted(((s << 21 | c), after) for (s, c), after in nodes.items() if s)
    size = 4 << len(inner).bit_length()
    keys, states = np.full(size, -1, np.int64), np.zeros(size, np.int32)
    homes = _home(np.array([k for k, _ in inner], np.int64), size)
    for (key, after), slot in zip(inner, homes.tolist()):
        while keys[slot] >= 0:
            slot = (slot + 1) & (size - 1)
        keys[slot], states[slot] = key, after
    return Pieces(first, pairs, keys, states, np.array(ends, np.int32), scores, raw, byte_ids, float(own.min()) - 1.0)


def _home(keys: np.ndarray, size: int) -> np.ndarray:
    """Where a key stands in a table of `size` places, a power of two, or the first place to look for it."""
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(65 - size.bit_length())).astype(np.int64)


def chunks(text: str) -> list[str]:
    return _CHUNK.findall(" " + text) if text else []


def _behind_blank(text: str) -> list[str]:
    """The chunks of a text without their first character, which is a blank in all of them."""
    if "  " in text or text.startswith(" "):
        return [c[1:] for c in chunks(text)]
    return text.split(" ") if text else []


@dataclass
class Lattices:
    """Lattices of distinct chunks behind one another: nodes are places between characters; the arcs of a node
    stand together, with conditional log probabilities and the sum of probabilities up to each arc, 2 for the last."""

    root: np.ndarray
    last: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    logp: np.ndarray
    upto: np.ndarray
    first_arc: np.ndarray
    last_arc: np.ndarray


def _after(pieces: Pieces, state: np.ndarray, character: np.ndarray, which: np.ndarray | None = None) -> np.ndarray:
    """States after one more character, 0 where the trie ends; only for the entries `which`, if given."""
    if which is not None:
        out = np.zeros(len(state), np.int32)
        chosen = np.flatnonzero(which)
        out[chosen] = _after(pieces, state[chosen], character[chosen])
        return out
    wanted = state.astype(np.int64) << 21 | character
    size = len(pieces.keys)
    slot = _home(wanted, size)
    found = pieces.keys[slot]
    out = np.where(found == wanted, pieces.states[slot], 0)
    left = np.flatnonzero((found != wanted) & (found >= 0))
    while len(left):  # the place is another's
        slot[left] = (slot[left] + 1) & (size - 1)
        found = pieces.keys[slot[left]]
        hit = found == wanted[left]
        out[left[hit]] = pieces.states[slot[left[hit]]]
        left = left[~hit & (found >= 0)]
    return out


def lattices(texts: list[str], pieces: Pieces) -> Lattices:
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.int32).copy()
    flat[flat == SPACE] = LITERAL_SPACE
    flat[flat == 32] = SPACE
    node = np.arange(len(flat), dtype=np.int32) + np.repeat(np.arange(len(texts), dtype=np.int32), size)  # each chunk has one node more than characters
    stop = np.repeat(np.cumsum(size).astype(np.int32), size)
    narrow = _narrow(flat)
    starts, ends, found = [], [], []
    place = np.arange(len(flat), dtype=np.int32)
    state = pieces.first[flat]
    length = 1
    while len(place):
        alive = state > 0
        place, state = place[alive], state[alive]
        piece = pieces.ends[state]
        hit = piece >= 0
        starts.append(place[hit])
        ends.append(place[hit] + length)
        found.append(piece[hit])
        more = place + length < stop[place]
        place, state = place[more], state[more]
        if not len(place):
            break
        if length == 1:
            a, b = narrow[place], narrow[place + 1]
            easy = (a < NARROW) & (b < NARROW)
            state = np.where(easy, pieces.pairs[np.where(easy, a, 0), np.where(easy, b, 0)], _after(pieces, state, flat[place + 1], ~easy))
        else:
            state = _after(pieces, state, flat[place + length])
        length += 1
    covered = np.zeros(len(flat), bool)
    if starts:
        covered[starts[0]] = True
    bare = np.flatnonzero(~covered).astype(np.int32)
    character = np.where(flat[bare] == LITERAL_SPACE, SPACE, flat[bare])
    width = 1 + (character > 0x7F) + (character > 0x7FF) + (character > 0xFFFF)
    start = np.concatenate([*starts, bare])
    end = np.concatenate([*ends, bare + 1])
    # One byte is a piece of its own; more are written out by `_ids`.
    piece = np.concatenate([*found, np.where(width == 1, pieces.byte_ids[np.where(width == 1, character, 0)], -1 - character).astype(np.int32)])
    score = np.concatenate([pieces.scores[np.concatenate(found)] if found else np.zeros(0), pieces.byte_score * width])
    distance = stop[start] - start
    # By distance from the chunk's end, then node, then length: the longest piece is mostly the likeliest.
    order = np.argsort((distance.astype(np.int64) << 34) | (start.astype(np.int64) << 6) | (63 - np.minimum(end - start, 63)))
    start, end, piece, score, distance = start[order], end[order], piece[order], score[order], distance[order]
    start, end = node[start], node[end - 1] + 1
    # Backward sums, a distance from the chunks' ends at a time.
    beta = np.zeros(len(flat) + len(texts))
    edges = np.flatnonzero(np.concatenate([[True], distance[1:] != distance[:-1]])) if len(start) else np.zeros(0, int)
    for a, b in zip(edges, np.append(edges[1:], len(start))):
        value = score[a:b] + beta[end[a:b]]
        new = np.flatnonzero(np.concatenate([[True], start[a + 1 : b] != start[a : b - 1]]))
        top = np.maximum.reduceat(value, new)
        many = np.diff(np.append(new, b - a))
        beta[start[a:b][new]] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, many)), new))
    logp = np.minimum(score + beta[end] - beta[start], 0.0)
    new = np.flatnonzero(np.concatenate([[True], start[1:] != start[:-1]])) if len(start) else np.zeros(0, int)
    many = np.diff(np.append(new, len(start)))
    total = np.concatenate([[0.0], np.cumsum(np.exp(logp))])
    upto = (total[1:] - np.repeat(total[new], many)).astype(np.float32)
    upto[new + many - 1] = 2.0  # nothing is drawn beyond a node's last arc
    first_arc, last_arc = np.zeros(len(beta), np.int64), np.zeros(len(beta), np.int64)
    first_arc[start[new]], last_arc[start[new]] = new, new + many - 1
    root = np.cumsum(size + 1) - size - 1
    nodes = (root.astype(np.int32), (root + size).astype(np.int32))
    arcs = (end.astype(np.int32), piece.astype(np.int32), logp, upto)
    return Lattices(*nodes, *arcs, first_arc.astype(np.int32), last_arc.astype(np.int32))


class Cache:
    """Lattices of the chunks that a task has met, up to `CACHED_ARCS` arcs; beyond it starts anew. Arrays grow
    in place, with room for more behind what is used."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces, self.rooms = pieces, {}
        self.clear()

    def clear(self) -> None:
        """Forget all chunks; the room of the arrays stays."""
        self.numbers, self.lattices = {}, lattices([], self.pieces)

    def _appended(self, name: str, used: np.ndarray, new: np.ndarray) -> np.ndarray:
        n = len(used) + len(new)
        room = self.rooms.get(name)
        if room is None or len(room) < n:
            room = np.empty(n * 3 // 2, new.dtype)
            room[: len(used)] = used
            self.rooms[name] = room
        room[len(used) : n] = new
        return room[:n]

    def look_up(self, rests: list[list[str]]) -> np.ndarray:
        """Numbers in `lattices` of the chunks of some texts, given without their first blanks."""
        if len(self.lattices.end) > CACHED_ARCS:
            self.clear()
        numbers = self.numbers
        fresh = [c for c in dict.fromkeys(chain.from_iterable(rests)) if c not in numbers]
        numbers.update(zip(fresh, range(len(numbers), len(numbers) + len(fresh))))
        found = np.fromiter(map(numbers.__getitem__, chain.from_iterable(rests)), np.int64, sum(map(len, rests)))
        if fresh:
            old, made = self.lattices, lattices([" " + c for c in fresh], self.pieces)
            nodes, arcs = np.int32(len(old.first_arc)), np.int32(len(old.end))
            made.root += nodes
            made.last += nodes
            made.end += nodes
            made.first_arc += arcs
            made.last_arc += arcs
            self.lattices = Lattices(**{n: self._appended(n, x, getattr(made, n)) for n, x in vars(old).items()})
        return found


_ALL = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def uniform(seeds: np.ndarray, sample: int, owner: np.ndarray, place: np.ndarray, step: int) -> np.ndarray:
    """Numbers in (0, 1) from the seed of the row that owns a chunk, the sample, the chunk's place and the step."""
    return _uniform(seeds, sample, owner, _spread(place), step)


def _spread(place: np.ndarray) -> np.ndarray:
    return place.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)


def _uniform(seeds: np.ndarray, sample: int, owner: np.ndarray, spread: np.ndarray, step: int) -> np.ndarray:
    salt = np.uint64((sample * 0x9E3779B97F4A7C15 + step * 0xD1B54A32D192ED03) & (2**64 - 1))
    x = _mix(seeds + salt)[owner]
    x += spread
    out = (_mix(x) >> np.uint64(11)).astype(np.float64)
    out += 0.5
    out *= 2.0**-53
    return out


ROOT_STEP, SIBLING_STEP = 1 << 20, (1 << 20) + 1


def again(seed: int, sample: int, place: int) -> Iterator[float]:
    """Further numbers in (0, 1) for one chunk."""
    x = seed ^ (sample * 0x9E3779B97F4A7C15 + place * 0x2545F4914F6CDD1D + 0x632BE59BD9B4E019) & _ALL
    while True:
        x = (x + 0x9E3779B97F4A7C15) & _ALL
        y = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _ALL
        y = (y ^ (y >> 27)) * 0x94D049BB133111EB & _ALL
        yield (((y ^ (y >> 31)) >> 11) + 0.5) * 2.0**-53


def draw(
    lat: Lattices, kind: np.ndarray, seeds: np.ndarray, owner: np.ndarray, place: np.ndarray, sample: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A path for every chunk (lattice `kind`) of the rows `owner`: arcs behind one another, where each chunk's begin, and its log
    probability."""
    root, last = lat.root[kind], lat.last[kind]
    logp, count = np.zeros(len(kind)), np.zeros(len(kind), np.int64)
    active, taken = np.flatnonzero(root < last), []
    # What goes on stands close together: place, end, owner, the place's part in the noise and the sum so far.
    at, stop, own, spread, total = root[active], last[active], owner[active], _spread(place[active]), np.zeros(len(active))
    step = 0
    while len(active):
        u = _uniform(seeds, sample, own, spread, step)
        arc = lat.first_arc[at]
        beyond = np.flatnonzero(u > lat.upto[arc])
        while len(beyond):
            arc[beyond] += 1
            beyond = beyond[u[beyond] > lat.upto[arc[beyond]]]
        taken.append((active, arc))
        total += lat.logp[arc]
        at = lat.end[arc]
        step += 1
        on = at < stop
        done = np.flatnonzero(~on)
        over = active[done]
        logp[over], count[over] = total[done], step
        on = np.flatnonzero(on)
        active, at, stop, own, spread, total = active[on], at[on], stop[on], own[on], spread[on], total[on]
    begin = np.concatenate([[0], np.cumsum(count)])
    arcs = np.empty(begin[-1], np.int32)
    for step, (who, arc) in enumerate(taken):
        arcs[begin[who] + step] = arc
    return arcs, begin, np.minimum(logp, 0.0)


def draw_other(lat: Lattices, kind: int, excluded: list[tuple[int, ...]], numbers: Iterator[float]) -> tuple[tuple[int, ...], float] | None:
    """A path of one chunk that is none of `excluded`, and its log probability; None if there is no other."""
    node, stop, path, logp = int(lat.root[kind]), int(lat.last[kind]), (), 0.0
    left = [(x, lat.logp[list(x)].tolist()) for x in excluded]
    while node < stop:
        begin = int(lat.first_arc[node])
        logs = lat.logp[begin : int(lat.last_arc[node]) + 1].tolist()
        mass = []
        for a, value in enumerate(logs, begin):
            p = exp(value)
            gone = sum(exp(sum(logp_x[len(path) :])) for x, logp_x in left if x[len(path)] == a)
            mass.append(0.0 if p - gone <= _EMPTY * p else p - gone)
        total = sum(mass)
        if total <= 0:
            return None
        u, chosen = next(numbers) * total, -1
        for a, m in enumerate(mass):
            if m > 0:
                chosen = a
                u -= m
                if u <= 0:
                    break
        logp += logs[chosen]
        chosen += begin
        left = [x for x in left if x[0][len(path)] == chosen]
        path, node = (*path, chosen), int(lat.end[chosen])
    return path, logp


def _below(phi: np.ndarray, limit, noise: np.ndarray) -> np.ndarray:
    """Gumbel values at `phi`, drawn below `limit`."""
    with np.errstate(over="ignore", divide="ignore"):
        return np.where(phi > -np.inf, phi - np.log(np.exp(phi - limit) - np.log(noise)), -np.inf)


@dataclass
class Sample:
    arcs: np.ndarray
    begin: np.ndarray
    logp: np.ndarray
    value: float


def sampled(texts: list[str], seeds: np.ndarray, cache: Cache, k: int = SAMPLES) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text its samples: ids, log probability, perturbed value, inclusion score."""
    split = [_behind_blank(t) for t in texts]
    size = np.array([len(x) for x in split], np.int64)
    begin = np.concatenate([[0], np.cumsum(size)])
    kind = cache.look_up(split)
    lat = cache.lattices
    place = np.arange(len(kind)) - np.repeat(begin[:-1], size)
    owner = np.repeat(np.arange(len(texts)), size)
    samples: list[list[Sample]] = [[] for _ in texts]
    heaps: list[list[tuple]] = [[] for _ in texts]
    roots = -np.log(-np.log(uniform(seeds, 0, np.arange(len(texts)), np.zeros(len(texts)), ROOT_STEP)))
    fresh = np.ones(len(kind), bool)
    start: list[tuple | None] = [(float(g), -1, 0, (), 0.0) for g in roots]
    for r in range(k):
        # What is drawn anew: all chunks behind the one where a sample leaves its predecessor.
        chosen = np.flatnonzero(fresh)
        arcs, at, logp = draw(lat, kind[chosen], seeds, owner[chosen], place[chosen], r)
        noise = uniform(seeds, r, owner[chosen], place[chosen], SIBLING_STEP)
        with np.errstate(divide="ignore"):
            rest = np.log(np.maximum(-np.expm1(logp), 0.0))
        rest[logp > -_EMPTY] = -np.inf
        where = np.concatenate([[0], np.cumsum(fresh)])
        spans, before, limit = np.zeros((len(texts), 2), np.int64), np.zeros(len(texts)), np.zeros(len(texts))
        for d, made in enumerate(start):
            if made is None:
                continue
            value, source, i, path, path_logp = made
            lo, hi = begin[d], begin[d + 1]
            a, b = spans[d] = where[[min(lo + i + (source >= 0), hi), hi]]
            new_arcs, new_logp, new_at = arcs[at[a] : at[b]], logp[a:b], at[a : b + 1] - at[a]
            limit[d] = value
            if source >= 0:
                old = samples[d][source]
                cut = old.begin[i]
                new_arcs = np.concatenate([old.arcs[:cut], np.array(path, np.int32), new_arcs])
                new_at = np.concatenate([old.begin[: i + 1], cut + len(path) + new_at])
                new_logp = np.concatenate([old.logp[:i], [path_logp], new_logp])
                before[d] = new_logp[: i + 1].sum()
            samples[d].append(Sample(new_arcs, new_at, new_logp, value))
        length = spans[:, 1] - spans[:, 0]
        upto = np.cumsum(logp) - logp
        shift = before - np.concatenate([upto, [0.0]])[np.minimum(spans[:, 0], len(upto))]
        below = _below(upto + np.repeat(shift, length) + rest, np.repeat(limit, length), noise)
        for d in np.flatnonzero(length):
            a, b = spans[d]
            values = below[a:b]
            sample = samples[d][-1]
            first = size[d] - (b - a)
            for j in np.argpartition(-values, k)[: k + 1] if b - a > k + 1 else range(b - a):
                if values[j] > -np.inf:
                    spot = int(first + j)
                    drawn = tuple(sample.arcs[sample.begin[spot] : sample.begin[spot + 1]].tolist())
                    heapq.heappush(heaps[d], (-float(values[j]), len(samples[d]) - 1, spot, [drawn]))
        start = [None] * len(texts)
        if r == k - 1:
            break
        fresh[:] = False
        for d, heap in enumerate(heaps):
            while heap:
                minus, source, i, excluded = heapq.heappop(heap)
                numbers = again(int(seeds[d]), r + 1, i)
                word = int(kind[begin[d] + i])
                other = draw_other(lat, word, excluded, numbers)
                if other is None:
                    continue
                sources = samples[d][source]
                gone = sum(float(np.exp(lat.logp[list(x)].sum())) for x in excluded) + float(np.exp(other[1]))
                if 1 - gone > _EMPTY:
                    phi = float(sources.logp[:i].sum()) + log1p(-gone)
                    value = phi - log(exp(phi + minus) - log(next(numbers)))
                    heapq.heappush(heap, (-value, source, i, [*excluded, other[0]]))
                start[d] = (-minus, source, i, *other)
                fresh[begin[d] + i + 1 : begin[d + 1]] = True
                break
    out = []
    for d in range(len(texts)):
        limit = -heaps[d][0][0] if heaps[d] else -np.inf
        rows = []
        for s in samples[d]:
            total = float(s.logp.sum())
            gap = total - limit
            score = 0.0 if limit == -np.inf or gap > 5 else float(np.log(-np.expm1(-np.exp(gap)))) if gap > -30 else gap
            rows.append((_ids(lat.piece[s.arcs], cache.pieces), total, s.value, score))
        out.append(rows)
    return out


def _ids(piece: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Piece ids of arcs, with byte pieces written out."""
    if not len(piece) or piece.min() >= 0:
        return piece.astype(np.int32)
    parts: list[np.ndarray] = []
    bare = np.flatnonzero(piece < 0)
    done = 0
    for i in bare:
        parts += [piece[done:i], pieces.byte_ids[np.frombuffer(chr(-1 - int(piece[i])).encode("utf-8", "surrogatepass"), np.uint8)]]
        done = i + 1
    return np.concatenate([*parts, piece[done:]]).astype(np.int32)


def decode(ids, pieces: Pieces) -> str:
    """The text that a segmentation encodes."""
    raw = pieces.bytes_
    return b"".join([raw[i] for i in np.asarray(ids).tolist()])[1:].decode("utf-8", "replace")


def _spelling(pieces: Pieces) -> pa.Array:
    return pa.array(pieces.bytes_, pa.large_binary())


def restored(ids: np.ndarray, ends: np.ndarray, texts: list[str], spelling: pa.Array, pieces: Pieces) -> list[bool]:
    """Whether segmentations that stand behind one another, each up to one of `ends`, decode to their texts."""
    # What is taken stands behind one another in one buffer: the bytes of all segmentations.
    taken = spelling.take(pa.array(ids))
    places = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset :]
    data = taken.buffers()[2].to_pybytes() if len(ids) else b""
    out, begin = [], 0
    for end, text in zip(ends.tolist(), texts):
        same = data[places[begin] + 1 : places[end]] == text.encode() if end > begin else not text
        out.append(same or decode(ids[begin:end], pieces) == text)
        begin = end
    return out


def encode(docs: DataFrame, model: str = MODEL, k: int = SAMPLES, seed: int = SEED, decoded: bool = False) -> DataFrame:
    """doc_id, sample (from 1), ids, log_prob, perturbed and log_inclusion of every sampled segmentation;
    with `decoded` also whether decoding gives the text back."""
    shared = docs.sparkSession.sparkContext.broadcast(load(model))
    names = ["doc_id", "sample", "ids", "log_prob", "perturbed", "log_inclusion", *(["restored"] if decoded else [])]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        cache, spelling = Cache(pieces), _spelling(pieces)
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            seeds = batch["seed"].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for lo, hi in slices(np.array([len(t) for t in texts]), SLICE_CHARS):
                found = sampled(texts[lo:hi], seeds[lo:hi], cache, k)
                rows = [(i, j + 1, *s) for i, got in enumerate(found, lo) for j, s in enumerate(got)]
                ids = [r[2] for r in rows]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32)
                columns = [
                    batch["doc_id"].take(pa.array([r[0] for r in rows], pa.int64())),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    *(pa.array([r[c] for r in rows], pa.float64()) for c in (3, 4, 5)),
                ]
                if decoded:
                    columns.append(pa.array(restored(flat, offsets[1:], [texts[r[0]] for r in rows], spelling, pieces), pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", "text", F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")).alias("seed"))
    schema = f"doc_id {kind}, sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double"
    return keyed.mapInArrow(work, schema + (", restored boolean" if decoded else ""))
