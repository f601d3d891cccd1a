"""SimHash near-duplicates by the generalised pigeonhole principle.

A text's fingerprint has a bit for each bit of 64 that is set in over half of its shingles' hashes. Texts
whose fingerprints differ in few bits are linked, and linked texts form groups.

Links are found on distinct fingerprints. The 64 bits are put into partitions so that correlated bits stand
together; each partition gets a threshold of its own, between -1 (not probed) and the distance. Two
fingerprints within distance d differ by at most t_i bits in some partition i whenever the thresholds add up
to d - m + 1, so each fingerprint is filed under its value in every probed partition and probes the values
within t_i of it. Number of partitions and thresholds minimise the estimated rows: the signatures filed and
probed, and the candidate pairs, estimated from counts of all fingerprints' partition values. Candidates are
verified by their whole distance.

A bucket with more members than `BUCKET_PAIRS` lists no pairs. Its members are joined through midpoints:
two fingerprints differ in at most 2k bits exactly if some value is within k bits of both (for odd
distances, of one and within k + 1 of the other), so filing every member under all values within k bits of
it, and linking each to the smallest member filed there, links precisely the same groups in a number of
rows that is linear in the members.

Defined results: null and empty texts have fingerprint zero, and are linked like any other. Rows with a
null id take part; a group's id is the smallest id that is not null, or null if there is none. Repeated
rows are returned as often as they come. An empty table gives an empty one. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import free_name, row_key, slices, text_bytes, written
from .components import components

BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
# Members of a bucket up to which its pairs are listed; larger ones go through midpoints.
BUCKET_PAIRS = 24
SLICE_BYTES = 1 << 20
ROW_KEY = "__row_key"


def shingle_hashes(text: bytes, size: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of every run of `size` words joined by blanks; of the whole sequence if it is shorter."""
    words = text.lower().split()  # bytes: A-Z only, and white space 9 to 13 and 32 only
    if not words:
        return []
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths).tolist()
    ends = (ends - 1).tolist()
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(joined, SEED)]
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :])]


def fingerprints(texts: pa.Array, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Unsigned 64-bit fingerprints of a batch of texts."""
    data, offsets = text_bytes(texts)
    out = np.zeros(len(texts), np.uint64)
    raw = data.tobytes()
    for lo, hi in slices(np.diff(offsets), SLICE_BYTES):
        hashes = [shingle_hashes(raw[offsets[i] : offsets[i + 1]], size) for i in range(lo, hi)]
        counts = np.array([len(h) for h in hashes])
        some = np.flatnonzero(counts)
        if not len(some):
            continue
        flat = np.fromiter(itertools.chain.from_iterable(hashes), np.uint64, int(counts.sum()))
        # Bit sums without a 64-fold expansion: bit b of all eight bytes side by side, which hold sums of up
        # to 255 hashes; those runs are then added up for each text.
        runs = -(-counts[some] // 255)
        first = np.concatenate([[0], np.cumsum(counts[some])[:-1]])
        run_of = np.repeat(np.arange(len(some)), runs)
        run_no = np.arange(len(run_of)) - np.repeat(np.cumsum(runs) - runs, runs)
        starts, lanes = first[run_of] + 255 * run_no, np.uint64(0x0101010101010101)
        sums = np.empty((len(some), 8, 8), np.int64)
        for b in range(8):
            part = np.add.reduceat((flat >> np.uint64(b)) & lanes, starts).view(np.uint8).reshape(-1, 8)
            sums[:, :, b] = np.add.reduceat(part, np.cumsum(runs) - runs, axis=0, dtype=np.int64)
        over = sums.reshape(len(some), BITS) * 2 > counts[some][:, None]
        out[lo + some] = np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def with_fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, row_key (a hash of id and text) and fp, the fingerprint as a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprints(batch["text"], size).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["row_key"], pa.array(fp)], names=["doc_id", "row_key", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", row_key().alias("row_key"), "text").mapInArrow(work, f"doc_id {kind}, row_key long, fp long")


def bit_moments(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how often each pair of bits is set together."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 16):
                part = batch["fp"].slice(at, 1 << 16).to_numpy(zero_copy_only=False)
                bits = np.unpackbits(part.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                both += bits.T @ bits
                n += len(part)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([both.ravel()], pa.list_(pa.float64()))], names=["n", "both"])

    rows = fps.select("fp").mapInArrow(work, "n long, both array<double>")
    # One row per task, summed cell by cell before it reaches the driver: 4,096 numbers.
    cells = rows.select("n", F.posexplode("both").alias("cell", "x")).groupBy("cell").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    both, n = np.zeros(BITS * BITS), 0
    for row in cells.collect():
        both[row["cell"]], n = row["x"], row["n"]
    return n, both.reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """`m` partitions of bits of equal size: each starts at the free bit most correlated with the rest and
    takes the free bits most correlated with those it has. Ties go to the lowest bit."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    rho = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(rho, 0)
    free, groups = list(range(BITS)), []
    for i in range(m):
        size = BITS // m + (i < BITS % m)
        group = [max(free, key=lambda b: (round(rho[b, free].sum(), 6), -b))]
        free.remove(group[0])
        while len(group) < size:
            best = max(free, key=lambda b: (round(rho[b, group].sum(), 6), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _mask(bits: list[int]) -> int:
    return _signed(sum(1 << b for b in bits))


def near_values(value: Column, bits: list[int], distance: int) -> Column:
    """All values that differ from `value` in at most `distance` of `bits`."""
    flips = [0] + [_mask(list(c)) for d in range(1, distance + 1) for c in itertools.combinations(bits, d)]
    return F.transform(F.array(*[F.lit(f).cast(LongType()) for f in flips]), lambda f: value.bitwiseXOR(f))


def estimated_rows(fps: DataFrame, groups: list[list[int]], most: int) -> list[list[float]]:
    """For each partition and threshold -1 ... `most`: signatures plus estimated candidate pairs.

    Pairs with equal values come from the counts of all values; pairs that differ in t of the partition's
    bits are estimated from the counts of values cut by t bits, as a pair at distance t agrees in all but t.
    """
    n = fps.count()
    kept = []
    for bits in groups:
        for t in range(most + 1):
            kept.append(F.lit(_mask(bits[t:])))
    values = fps.select(F.posexplode(F.array(*[F.col("fp").bitwiseAND(k) for k in kept])).alias("k", "value"))
    counts = values.groupBy("k", "value").agg(F.count(F.lit(1)).alias("c"))
    pairs = {r["k"]: r["s"] for r in counts.groupBy("k").agg(F.sum(F.col("c").cast("double") * (F.col("c") - 1) / 2).alias("s")).collect()}
    table = []
    for i, bits in enumerate(groups):
        row = [0.0]
        for t in range(most + 1):
            probes = sum(_choose(len(bits), d) for d in range(t + 1))
            row.append(n * (1.0 + probes * (t > 0)) + pairs.get(i * (most + 1) + t, 0.0) * _choose(len(bits), t))
        table.append(row)
    return table


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def allocate(rows: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """Thresholds that add up to distance - m + 1 at the least estimated rows, by dynamic programming over
    the partitions."""
    m = len(rows)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in rows:
        then: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, chosen) in best.items():
            for t in range(-1, len(row) - 1):
                got = (cost + row[t + 1], [*chosen, t])
                if total + t not in then or got < then[total + t]:
                    then[total + t] = got
        best = then
    return best[distance - m + 1]


def plan_partitions(fps: DataFrame, distance: int = MAX_DISTANCE) -> list[tuple[list[int], int]]:
    """Partitions and their thresholds, for the number of partitions with the least estimated rows."""
    n, both = bit_moments(fps)
    found = []
    for m in range(2, distance + 2):
        groups = group_bits(n, both, m)
        cost, thresholds = allocate(estimated_rows(fps, groups, min(1, distance)), distance)
        found.append((cost, m, list(zip(groups, thresholds))))
    return min(found, key=lambda x: x[:2])[2] if found else [(list(range(BITS)), distance)]


def links(fps: DataFrame, distance: int = MAX_DISTANCE, bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """a, b: links between distinct fingerprints that join the same groups as all pairs within `distance`.

    `fps` holds distinct fingerprints, written before.
    """
    filed = probes = None
    for i, (bits, t) in enumerate(plan_partitions(fps, distance)):
        if t < 0:
            continue
        value = F.col("fp").bitwiseAND(F.lit(_mask(bits)))
        own = fps.select(F.lit(i).alias("part"), value.alias("value"), "fp")
        filed = own if filed is None else filed.unionByName(own)
        near = own.select("part", F.explode(near_values(F.col("value"), bits, t)).alias("value"), "fp") if t else own
        probes = near if probes is None else probes.unionByName(near)
    sizes = probes.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    small = probes.join(sizes.where(F.col("n") <= bucket_pairs).drop("n"), ["part", "value"])
    left = filed.withColumnRenamed("fp", "a")
    far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = left.join(small.withColumnRenamed("fp", "b"), ["part", "value"]).where((F.col("a") != F.col("b")) & (far <= distance)).select("a", "b")
    crowded = probes.join(sizes.where(F.col("n") > bucket_pairs).select("part", "value"), ["part", "value"]).select("fp").distinct()
    return pairs.unionByName(midpoint_links(crowded, distance)).distinct()


def midpoint_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links through values within half the distance: linear in the fingerprints, whatever their groups."""
    bits, half = list(range(BITS)), distance // 2
    near = fps.select("fp", F.explode(near_values(F.col("fp"), bits, half)).alias("mid"))
    centre = near.groupBy("mid").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n"))
    if distance % 2 == 0:
        return near.join(centre.where("n > 1").drop("n"), "mid").where("a <> fp").select("a", F.col("fp").alias("b"))
    wide = fps.select("fp", F.explode(near_values(F.col("fp"), bits, half + 1)).alias("mid"))
    return wide.join(centre.drop("n"), "mid").where("a <> fp").select("a", F.col("fp").alias("b")).unionByName(
        near.join(centre.drop("n"), "mid").where("a <> fp").select("a", F.col("fp").alias("b")).where(
            F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
        )
    )


def near_duplicates(docs: DataFrame, distance: int = MAX_DISTANCE, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, row_key, fp, root and component_id for every row: documents linked by fingerprints at most
    `distance` apart. root, the smallest fingerprint of a group, tells groups apart where ids repeat."""
    rows = written(with_fingerprints(docs, size), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    # Fingerprints in a component carry its smallest id; the others their own.
    member = components(links(fps.select("fp"), distance))
    of = fps.join(member.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = of.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = written(of.join(smallest, "root").select("fp", "root", "component_id"), "components")
    return rows.join(named, "fp").select("doc_id", "row_key", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, distance: int = MAX_DISTANCE, size: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each group the row with the smallest id (null last, then
    the smallest fingerprint) stays, with all its columns, and of equal rows one."""
    found = near_duplicates(docs, distance, size)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "row_key"))
    kept = written(found.groupBy("root").agg(first.alias("f")).select("f.row_key").distinct(), "kept-rows")
    name = free_name(docs, ROW_KEY)
    keyed = docs.withColumn(name, row_key()).join(kept.withColumnRenamed("row_key", name), name, "left_semi")
    return keyed.dropDuplicates([name]).drop(name)


def hex_fingerprint(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
