"""Near duplicates by 64-bit SimHash fingerprints within a Hamming distance.

The generalised pigeonhole principle: cut the bits into m partitions with thresholds t_i,
each from -1 (not probed) up, that sum to distance - m + 1. Two fingerprints within the
distance then agree within t_i bits in at least one partition i. Every distinct
fingerprint is a query against all: correlated bits are grouped into one partition, since
then the others tell fingerprints apart; for each query a dynamic program over the
partitions picks the thresholds of least cost (probes plus estimated candidates); its
probes meet the index of partition values, and what they find is verified on all bits.

A query whose cheapest thresholds still cost more than LIMIT lies in a crowd (a large group
of near copies). Crowded fingerprints are searched as one partition that holds all 64 bits
instead, its threshold split between both sides: two fingerprints are within 2 bits
exactly when some value is within 1 bit of both. Each sends out its 65 such values; a value
receives at most 65 distinct fingerprints, all linked to each other, so tying them to
the smallest is enough. A pair with at least one fingerprint outside the crowds is
found by that one's probes. So no fingerprint costs more than a constant, however
large its group is, and no link is lost.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import Shared, discard, join_groups, map_batches, shared_table
from cartwheel.llm.graph import components

BITS, PARTITIONS, DISTANCE, SHINGLE, SEED = 64, 3, 2, 3, 42
LIMIT = 65  # cost of a query beyond which it counts as crowded: that of its 65 neighbours
LIGHT = 16  # partition values of so many fingerprints count with the mean, others exactly


def fingerprint(raw: bytes, n: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one UTF-8 text, as a signed number."""
    words = raw.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(n, len(words))
    starts = np.r_[0, ends[: len(words) - k] + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[s:e], seed) for s, e in zip(starts, ends[k - 1 :].tolist())), np.uint64, len(starts))
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 15):
        ones += np.unpackbits(hashes[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, seed: int = SEED, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: ``_id``, ``fp`` (long), and the ``extra`` string columns."""
    names = list(extra or {})
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            fp = [fingerprint(raw or b"", n, seed) for raw in b.column(1).cast(pa.binary()).to_pylist()]
            yield {"_id": b.column(0), "fp": fp} | {c: b.column(2 + i) for i, c in enumerate(names)}

    source = docs.select(F.col(id_col), F.col(text_col), *[c.alias(k) for k, c in (extra or {}).items()])
    return map_batches(source, run, f"_id {id_type}, fp long" + "".join(f", {c} string" for c in names))


def bits_of(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype(np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def partition_bits(both: np.ndarray, n: int, m: int = PARTITIONS) -> list[list[int]]:
    """Bits in m partitions of about equal width. ``both[i, j]``: how many of n
    fingerprints have bits i and j set. A partition starts with the most correlated pair
    left and takes the bit of greatest total correlation with it until it is full."""
    p = both / max(n, 1)
    one = np.diag(p)
    spread = np.sqrt(np.maximum(one * (1 - one), 1e-12))
    tied = np.abs((p - np.outer(one, one)) / np.outer(spread, spread))
    np.fill_diagonal(tied, 0)
    left, out = list(range(len(one))), []
    for k in range(m):
        width = -(-len(left) // (m - k))
        sub = tied[np.ix_(left, left)]
        own = [left[int(np.argmax(sub)) // len(left)]]
        left.remove(own[0])
        while len(own) < width:
            best = left[int(np.argmax(tied[np.ix_(left, own)].sum(1)))]
            own.append(best)
            left.remove(best)
        out.append(own)
    return out


def values_of(fps: np.ndarray, parts: list[list[int]]) -> np.ndarray:
    """(fingerprints, partitions): the bits of each partition as one number."""
    u = fps.astype(np.int64).view(np.uint64)
    out = np.zeros((len(fps), len(parts)), np.int64)
    for i, bits in enumerate(parts):
        for j, bit in enumerate(bits):
            out[:, i] |= ((u >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << j
    return out


def flips(width: int, most: int) -> list[np.ndarray]:
    """Per number of flipped bits, the masks that flip so many of ``width`` bits."""
    return [np.array([sum(1 << b for b in c) for c in combinations(range(width), k)], np.uint64).view(np.int64) for k in range(most + 1)]


def allocate(costs: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds of least cost: ``costs[q, i, t + 1]`` is what threshold t costs query q in
    partition i; the thresholds of a query sum to ``total``. Returns (thresholds, cost)."""
    n, m, options = costs.shape
    low, high = -m, m * (options - 2)
    best = np.full((n, high - low + 1), np.inf)
    best[:, -low] = 0
    picks = []
    for i in range(m):
        new, pick = np.full_like(best, np.inf), np.zeros(best.shape, np.int8)
        for t in range(-1, options - 1):
            moved = np.full_like(best, np.inf)
            src = best[:, max(0, -t) : best.shape[1] - max(0, t)]
            moved[:, max(0, t) : best.shape[1] - max(0, -t)] = src + costs[:, i, t + 1][:, None]
            better = moved < new
            new[better], pick[better] = moved[better], t
        best, picks = new, [*picks, pick]
    at = np.full(n, total - low)
    cost, out = best[:, total - low], np.zeros((n, m), np.int64)
    for i in reversed(range(m)):
        out[:, i] = picks[i][np.arange(n), at]
        at = at - out[:, i]
    return out, cost


class Plan:
    """Partitions and value counts, from which tasks allocate the thresholds of a query."""

    def __init__(self, parts: list[list[int]], n: int, heavy: np.ndarray, distance: int):
        self.parts, self.n, self.heavy, self.distance = parts, n, heavy, distance
        self.counts: list[np.ndarray] | None = None

    def tables(self) -> list[np.ndarray]:
        """Per partition, the (estimated) number of fingerprints of every value."""
        if self.counts is None:
            self.counts = [np.full(1 << len(p), 1 + self.n / (1 << len(p)), np.float32) for p in self.parts]
            for i, table in enumerate(self.counts):
                own = self.heavy[self.heavy[:, 0] == i]
                table[own[:, 1]] = own[:, 2]
        return self.counts

    def probes(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(values, thresholds, cost, index mask) of a batch of fingerprints."""
        values, tables = values_of(fps, self.parts), self.tables()
        costs = np.zeros((len(fps), len(self.parts), self.distance + 2))
        for i, bits in enumerate(self.parts):
            so_far = np.zeros(len(fps))
            for t, masks in enumerate(flips(len(bits), self.distance)):
                for mask in masks.tolist():
                    so_far += tables[i][values[:, i] ^ mask]
                so_far += len(masks)
                costs[:, i, t + 1] = so_far
        thresholds, cost = allocate(costs, self.distance - len(self.parts) + 1)
        own = np.stack([tables[i][values[:, i]] for i in range(len(self.parts))], 1)
        return values, thresholds, cost, own <= LIMIT


def plan(fps: DataFrame, n: int, distance: int, m: int) -> Plan:
    """Partition by the correlation of all fingerprints and count the partition values."""

    def pairs(batches):
        both = np.zeros((BITS, BITS), np.int64)
        for b in batches:
            x = bits_of(b.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            both += (x.T @ x).astype(np.int64)
        i, j = np.nonzero(both)
        yield {"i": i, "j": j, "n": both[i, j]}

    both = np.zeros((BITS, BITS), np.int64)
    for r in map_batches(fps, pairs, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        both[r["i"], r["j"]] = r["n"]
    parts = partition_bits(both, n, m)

    def spread(batches):
        for b in batches:
            v = values_of(b.column(0).to_numpy(zero_copy_only=False), parts)
            yield {"part": np.tile(np.arange(m), len(v)), "value": v.ravel()}

    many = map_batches(fps, spread, "part int, value long").groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LIGHT)
    heavy = many.select("part", "value", F.least("n", F.lit(1 << 20)).alias("n")).toPandas().to_numpy(np.int64).reshape(-1, 3)
    return Plan(parts, n, heavy, distance)


def links(fps: DataFrame, n: int, distance: int = DISTANCE, m: int = PARTITIONS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (column ``fp``) within the distance whose
    components are those of all such pairs: all pairs but those between two crowded ones,
    and for these the ties to the smallest fingerprint around a common neighbour."""
    if distance != 2:
        raise ValueError("crowded fingerprints are split for a distance of 2")
    shared = Shared(fps.sparkSession, plan(fps, n, distance, m))
    near = np.concatenate(flips(BITS, 1))

    def send(batches):
        own = shared.get()
        masks = [flips(len(p), distance) for p in own.parts]
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            values, thresholds, cost, listed = own.probes(fp)
            open_ = cost <= LIMIT
            out: list[tuple[int, np.ndarray, np.ndarray]] = []
            for i in range(m):
                key = (np.int64(i) << 40) | values[:, i]
                out.append((0, key[listed[:, i]], fp[listed[:, i]]))  # index
                for t in range(distance + 1):
                    q = open_ & (thresholds[:, i] >= t)
                    for mask in masks[i][t].tolist() if q.any() else ():
                        out.append((1, key[q] ^ mask, fp[q]))  # probes
            crowd = fp[~open_]
            if len(crowd):
                out.append((2, (crowd[:, None] ^ near).ravel(), np.repeat(crowd, len(near))))
            yield {"kind": np.repeat([k for k, *_ in out], [len(x) for _, x, _ in out]), "key": np.concatenate([x for _, x, _ in out]), "fp": np.concatenate([x for *_, x in out])}

    sent = shared_table(map_batches(fps, send, "kind tinyint, key long, fp long").repartition("kind", "key"), "simhash-probes")
    index = sent.filter("kind = 0").select("key", F.col("fp").alias("b"))
    probes = sent.filter("kind = 1").select("key", F.col("fp").alias("a"))
    close = (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    found = probes.join(index, "key").filter(close).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # at most 65 distinct fingerprints are within one bit of a key
    around = sent.filter("kind = 2").groupBy("key").agg(F.collect_list("fp").alias("all")).filter("size(all) > 1")
    tied = around.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).filter("a != b")
    out = shared_table(found.unionByName(tied).distinct(), "simhash-links")
    discard(sent)
    return out


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, seed: int = SEED, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: id, ``fp`` (the fingerprint as a signed number),
    ``component_id`` (smallest id reachable by links of at most 2 differing bits, its own
    included), ``members`` (rows of the component), ``component`` (a number naming it).

    A fingerprint bit is set when it is set in over half the XXH64 hashes of the text's
    word n-grams, repeats included; words are WORD_PATTERN, A-Z as a-z; a shorter text is
    one n-gram. Null, empty and blank texts have the fingerprint 0 and link like others.
    Equal texts share a fingerprint; repeated rows repeat. Null ids are never the smallest
    unless all ids of a component are null. An empty table gives an empty result; other
    columns are ignored.
    """
    rows = shared_table(fingerprints(docs, id_col, text_col, n, seed, extra), "simhash-rows")
    total = rows.count()
    own = shared_table(rows.groupBy("fp").agg(F.min("_id").alias("low"), F.count(F.lit(1)).alias("rows")), "simhash-classes")
    pairs = links(own.select("fp"), own.count())
    labels = components(pairs).withColumnRenamed("node", "fp")
    tied = own.join(labels, "fp", "left").withColumn("component", F.coalesce("label", "fp"))
    tied = shared_table(tied.select("fp", "low", "rows", "component"), "simhash-labels")
    sums = tied.groupBy("component").agg(F.min("low").alias("component_id"), F.sum("rows").alias("members"), F.count(F.lit(1)).alias("fps"))
    comps = join_groups(tied.select("fp", "rows", "component"), shared_table(sums, "simhash-sums"), ["component"], "fps", max(total, 1))
    comps = shared_table(comps.select("fp", "rows", "component", "component_id", "members"), "simhash-components")
    out = join_groups(rows, comps, ["fp"], "rows", total)
    return out.select(F.col("_id").alias(id_col), "fp", "component_id", "members", "component", *(extra or {}))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
