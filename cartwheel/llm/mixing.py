"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is cut into blocks by a seeded hash of its rows; a row longer than the share
LONG of a block is a block of its own. Its target, in words, is met by whole passes over
all its blocks, then by blocks in a seeded permutation, where a long row that does not fit
the remainder is passed over, then by rows of one last block. The blocks each source owes (its quota) are divided among the
output shards by a tree: every node splits its quotas between its two halves by one
multivariate-hypergeometric draw, so the shards together use each quota exactly. A
shard's blocks are disjoint stretches of each source's permutation, and its rows are
shuffled within the shard.

What reaches the driver is one row per source; block lists hold at most (1 + 1 / LONG) *
MAX_BLOCKS rows per source and are ordered within Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from cartwheel.llm.common import WORD_PATTERN, shared_table

WEIGHTS = (5.0, 2.0, 1.0)
BLOCK_WORDS, MAX_BLOCKS = 20_000, 4096
LONG = 0.25  # of a block's mean words
SHARD_WORDS, MAX_SHARDS = 2_000_000, 4096
BROADCAST_SOURCES = 100_000  # beyond so many sources their table is joined, not broadcast


def targets(sizes: list[int], weights: list[float], share: float = 1.5, cap: float = 2.0) -> list[float]:
    """Words per source: ``share`` of all words dealt by weight; none above ``cap`` times
    its size, the excess dealt again by weight among the others until none is above."""
    out = [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    left = min(share, cap) * sum(sizes)
    while open_:
        per = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * per >= cap * sizes[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * per
            break
        for i in full:
            out[i] = cap * sizes[i]
            left -= out[i]
        open_ = [i for i in open_ if out[i] == 0]
    return out


def split_tree(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(shards, sources) block counts whose column sums are ``quotas``."""
    out = np.zeros((shards, len(quotas)), np.int64)
    todo = [(0, shards, np.asarray(quotas, np.int64))]
    while todo:
        lo, hi, q = todo.pop()
        if hi - lo == 1:
            out[lo] = q
            continue
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        take = int(q.sum()) * (mid - lo) // (hi - lo)
        left = _hypergeometric(rng, q, take)
        todo += [(lo, mid, left), (mid, hi, q - left)]
    return out


def _hypergeometric(rng: np.random.Generator, colors: np.ndarray, take: int) -> np.ndarray:
    """One draw of ``take`` balls; colour by colour, each conditional on the ones before."""
    out = np.zeros_like(colors)
    rest = int(colors.sum())
    for i, c in enumerate(colors):
        rest -= int(c)
        out[i] = rng.hypergeometric(int(c), rest, take) if take and c else 0
        take -= int(out[i])
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: int = 20_24) -> tuple[DataFrame, DataFrame]:
    """Returns (rows, draws).

    rows: one per input row: ``rid``, id, ``source``, ``size`` (words; null text has 0),
    ``source_size``, ``target`` (of its source). draws: one per copy the mix takes:
    ``rid``, ``size``, ``copy`` (0, 1, ...), ``shard``, ``position`` within the shard.
    Sources are ordered by code point, null last, and weigh ``weights`` in turn. Rows
    without words are never drawn. Repeated rows are separate rows. An empty table gives
    empty results. The same table gives the same mix.
    """
    spark = docs.sparkSession
    base = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(source_col), F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0))).alias("_h"),
    )
    base = shared_table(base, "mix-rows")
    per_source = [(r["source"], r["n"]) for r in base.groupBy("source").agg(F.sum("size").alias("n")).toLocalIterator()]
    per_source.sort(key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [n for _, n in per_source]
    aims = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, cap)
    n_blocks = [int(min(MAX_BLOCKS, max(1, -(-n // BLOCK_WORDS)))) for n in sizes]
    passes = [int(a // n) if n else 0 for a, n in zip(aims, sizes)]
    rest = [a - p * n for a, p, n in zip(aims, passes, sizes)]
    known = spark.createDataFrame(
        [(i, s, n, a, b, p, r) for i, ((s, n), a, b, p, r) in enumerate(zip(per_source, aims, n_blocks, passes, rest))],
        "sidx int, source string, source_size long, target double, n_blocks int, passes int, rest double",
    )
    small = F.broadcast(known) if len(per_source) <= BROADCAST_SOURCES else known
    rows = base.join(small, base["source"].eqNullSafe(known["source"]), "inner").drop(known["source"])
    alone = (F.col("n_blocks") > 1) & (F.col("size") * F.col("n_blocks") > LONG * F.col("source_size"))
    rows = rows.withColumn("block", F.when(alone, -1 - F.col("rid")).otherwise(F.pmod(F.xxhash64(F.lit(seed + 1), "_h"), F.col("n_blocks"))))
    filled = rows.filter("size > 0")

    # blocks in the source's permutation; those that fit the remainder are taken whole
    key = F.when(F.col("block") < 0, F.xxhash64(F.lit(seed + 2), "_h")).otherwise(F.xxhash64(F.lit(seed + 2), "sidx", "block"))
    blocks = filled.withColumn("key", key).groupBy("sidx", "block", "passes", "rest", "key").agg(F.sum("size").alias("words"))
    blocks = shared_table(
        blocks.groupBy("sidx").applyInArrow(_plan, "sidx int, block long, passes int, rank int, whole boolean, last boolean, room double"),
        "mix-blocks",
    )

    # quotas in blocks and their shards
    quota = [0] * len(sizes)
    for r in blocks.groupBy("sidx").agg(F.sum(F.col("passes") + F.when(F.col("whole") | F.col("last"), 1).otherwise(0)).alias("n")).toLocalIterator():
        quota[r["sidx"]] = int(r["n"])
    shards = int(min(MAX_SHARDS, max(1, -(-int(sum(aims)) // SHARD_WORDS))))
    dealt = split_tree(np.array(quota, np.int64), shards, seed)
    ends = dealt.cumsum(axis=0)
    spans = spark.createDataFrame([(i, [int(x) for x in ends[:, i]]) for i in range(len(sizes))], "sidx int, ends array<long>")
    copies = blocks.withColumn(
        "copy", F.explode(F.when(F.col("whole") | F.col("last"), F.sequence(F.lit(0), F.col("passes"))).when(F.col("passes") > 0, F.sequence(F.lit(0), F.col("passes") - 1)))
    )
    turn = W.Window.partitionBy("sidx").orderBy("copy", "rank")
    # the i-th block of a source goes to the first shard whose running quota exceeds i
    copies = (
        copies.withColumn("_i", F.row_number().over(turn) - 1)
        .join(F.broadcast(spans) if len(sizes) * shards <= 10_000_000 else spans, "sidx")
        .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("_i"))))
        .withColumn("partial", F.col("last") & (F.col("copy") == F.col("passes")))
        .select("sidx", "block", "copy", "shard", "partial", "room")
    )
    hit = filled.select("rid", "size", "_h", "sidx", "block").join(copies, ["sidx", "block"])
    whole = hit.filter(~F.col("partial")).select("rid", "size", "copy", "shard", "_h")
    part = hit.filter("partial").groupBy("sidx").applyInArrow(_fill, "rid long, size long, copy int, shard int, _h long")
    spot = W.Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 3), "_h", "copy", "rid"), "rid")
    draws = whole.unionByName(part).withColumn("position", F.row_number().over(spot)).drop("_h")
    return rows.select("rid", F.col("_id").alias(id_col), "source", "size", "source_size", "target"), draws


def _plan(t: pa.Table) -> pa.Table:
    """A source's blocks in their permutation, each taken whole if it still fits; the first
    block of several rows that does not is the last one. If only long rows are left over,
    they are added or swapped to come nearer to the target."""
    t = t.sort_by([("key", "ascending"), ("block", "ascending")])
    words, room, n = t.column("words").to_numpy(), t.column("rest")[0].as_py(), len(t)
    alone, whole, last = t.column("block").to_numpy() < 0, np.zeros(n, bool), np.zeros(n, bool)
    for i, w in enumerate(words.tolist()):
        if w <= room:
            room -= w
            whole[i] = True
        elif not alone[i]:
            last[i] = room > 0
            break
    if not last.any() and room > 0 and alone.any():
        whole[alone] = _nearest(words[alone], whole[alone], room)
    out = t.select(["sidx", "block", "passes"]).append_column("rank", pa.array(np.arange(1, n + 1, dtype=np.int32)))
    return out.append_column("whole", pa.array(whole)).append_column("last", pa.array(last)).append_column("room", pa.array(np.full(n, room, float)))


def _fill(t: pa.Table) -> pa.Table:
    """Rows of a source's last block, in hashed order, each taken if it still fits; then
    single additions or swaps while they bring the sum nearer to the room."""
    t = t.sort_by([("_h", "ascending"), ("rid", "ascending")])
    sizes = t.column("size").to_numpy()
    room, taken = t.column("room")[0].as_py(), np.zeros(len(sizes), bool)
    for i, n in enumerate(sizes.tolist()):
        if n <= room:
            room -= n
            taken[i] = True
    taken = _nearest(sizes, taken, room)
    return t.take(pa.array(np.flatnonzero(taken))).select(["rid", "size", "copy", "shard", "_h"])


def _nearest(sizes: np.ndarray, taken: np.ndarray, room: float) -> np.ndarray:
    """``taken`` after single additions or swaps that bring its sum nearer to ``room`` more."""
    taken = taken.copy()
    for _ in range(8):
        out = np.flatnonzero(~taken)
        out = out[np.argsort(sizes[out], kind="stable")]
        if not len(out) or abs(room) < 1:
            break
        ins = np.r_[-1, np.flatnonzero(taken)]  # -1: add without taking one away
        want = np.r_[0, sizes[taken]] + room
        spot = np.searchsorted(sizes[out], want)
        spot = np.stack([np.maximum(spot - 1, 0), np.minimum(spot, len(out) - 1)])
        miss = np.abs(sizes[out][spot] - want)
        side, k = np.unravel_index(miss.argmin(), miss.shape)
        if miss[side, k] >= abs(room):
            break
        new = out[spot[side, k]]
        room = float(want[k] - sizes[new])
        taken[new] = True
        if ins[k] >= 0:
            taken[ins[k]] = False
    return taken


def mixed(docs: DataFrame, **kw) -> DataFrame:
    """One row per document: id, size, source_size, target, taken, n_copies, and
    ``places``: where the splitting tree and the local shuffle put its copies, an array of
    (copy, shard, position) by copy, null if none is taken."""
    rows, draws = mix(docs, **kw)
    places = F.sort_array(F.collect_list(F.struct("copy", "shard", "position"))).alias("places")
    taken = draws.groupBy("rid").agg(F.count(F.lit(1)).alias("n_copies"), places)
    return rows.join(taken, "rid", "left").select(
        kw.get("id_col", "doc_id"), "size", "source_size", "target",
        (F.coalesce("n_copies", F.lit(0)) * F.col("size")).cast(T.LongType()).alias("taken"), F.coalesce("n_copies", F.lit(0)).alias("n_copies"), "source", "places",
    )
