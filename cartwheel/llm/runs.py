"""Periodic runs of words: stretches that repeat a block of words several times.

A run of period q is, seen as the positions i with word[i] == word[i + q], a *stretch* of
(length - q) positions. The work is dealt out by scale: for every octave of periods
S <= q < 2S a text is cut into overlapping tiles with a boundary every S words. A stretch
of an exponent of 3 or more holds a whole block of S positions between two boundaries, so
a boundary whose block does not recur S to 2S - 1 words on (compared by rolling hashes,
which never miss) needs no work. At the others, one Z-function forwards and one backwards
give the extension of every period of the octave, and periods that are powers of a
smaller one go: the smaller octave finds those.

A tile is solved without looking at any other, so its stretches are fragments where they
reach its edge. Fragments are shuffled by document and period and stitched there: two that
touch are one stretch. Tiles are cut in the task that holds the text, since shipping them
would move every word once per octave; only fragments, and the words of texts that have
any, leave the task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from cartwheel.llm.common import map_batches, mix64, shared_table

TILE = 1 << 14  # words of a tile, or 16 blocks where that is more
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64


def tiles(n: int, min_exponent: int) -> Iterator[tuple[int, int, int]]:
    """(S, first, end): the octave's block size and the boundaries a tile owns."""
    size = 1
    while min_exponent * size <= n:
        step = max(TILE, 16 * size)
        for first in range(0, n, step):
            yield size, first, min(first + step, n)
        size *= 2


def codes_of(words: list[bytes]) -> np.ndarray:
    """Words as numbers, equal only for equal words."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def z_function(x: list[int]) -> list[int]:
    """z[i]: how many items from i on equal those from 0 on (z[0] is the length)."""
    n = len(x)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = z[i - left] if i < right else 0
        if i + k >= right:
            k = max(0, right - i)
            while i + k < n and x[k] == x[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def recurring(x: np.ndarray, size: int) -> np.ndarray:
    """(block, shift) of the blocks of ``size`` items that look the same (by hash) as the
    items ``size + shift`` further on, 0 <= shift < size."""
    m = len(x) - size + 1
    if m <= size:
        return np.zeros((0, 2), np.int64)
    if size == 1:
        same = x[1:] == x[:-1]
        return np.stack([np.flatnonzero(same), np.zeros(int(same.sum()), np.int64)], 1)
    power, inverse = _powers(len(x))
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(mix64(x.astype(np.uint64) + np.uint64(1)) * power, out=total[1:])
    h = (total[size:] - total[:m]) * inverse[:m]
    whole = -(-m // size)
    padded = np.zeros(whole * size, np.uint64)
    padded[:m] = h
    blocks = padded.reshape(whole, size)
    hits = np.argwhere(blocks[1:] == blocks[:-1, :1])
    return hits[(hits[:, 0] + 1) * size + hits[:, 1] < m]


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept while a task needs no longer ones."""
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS.clear()
        size = max(n, 1 << 12)
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            ones = np.full(size, np.uint64(base))
            ones[0] = 1
            _POWERS.append(np.multiply.accumulate(ones))
    return _POWERS[0][:n], _POWERS[1][:n]


def primitive(z: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """The periods q whose first q items are no power of a shorter block."""
    last = int(periods[-1])
    open_ = np.zeros(last + 1, bool)
    roots = np.arange(1, min(last + 1, len(z)))
    open_[1 : 1 + len(roots)] = z[1 : 1 + len(roots)] >= roots  # squares start here
    composed = np.zeros(last + 1, bool)
    rest = np.flatnonzero(open_)
    while len(rest) and 2 * rest[0] <= last:
        p = int(rest[0])
        composed[2 * p : min(last, int(z[p]) + p) + 1 : p] = True
        rest = rest[1:][~composed[rest[1:]]]
    return periods[~composed[periods]]


def chains(hits: np.ndarray, least: int, last: int) -> np.ndarray:
    """(first block, blocks, shift) of the blocks in a row with the same shift: of rows of
    ``least`` blocks or more, and of those that reach the tile's first or last block."""
    hits = hits[np.lexsort((hits[:, 0], hits[:, 1]))]
    new = np.flatnonzero(np.r_[True, (hits[1:, 1] != hits[:-1, 1]) | (hits[1:, 0] != hits[:-1, 0] + 1)])
    sizes = np.diff(np.r_[new, len(hits)])
    first = hits[new, 0]
    out = np.stack([first, sizes, hits[new, 1]], 1)[(sizes >= least) | (first == 0) | (first + sizes > last)]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


class Tile:
    """The boundaries first, first + size, ... below ``end`` of one text, with the words
    they can see."""

    def __init__(self, x: np.ndarray, size: int, first: int, end: int):
        self.lo, self.size = max(0, first - size), size
        self.x = x[self.lo : min(len(x), end + 5 * size)]
        self.skip, self.last = first - self.lo, (end - first - 1) // size
        self.ahead: dict[int, np.ndarray] = {}
        self.behind: dict[int, tuple[list[int], int]] = {}

    def forward(self, b: int) -> np.ndarray:
        """z[q]: how far the words from b on equal those from b + q on."""
        if b not in self.ahead:
            self.ahead[b] = np.array(z_function(self.x[b : b + 4 * self.size].tolist()))
        return self.ahead[b]

    def backward(self, b: int, q: int) -> int:
        """How many words before b equal those before b + q, at most ``size``."""
        if b not in self.behind:
            back = self.x[max(0, b - self.size) : b][::-1].tolist()
            ahead = self.x[max(0, b - self.size) : b + 2 * self.size][::-1].tolist()
            self.behind[b] = z_function([*back, -1, *ahead]), len(ahead)
        z, n = self.behind[b]
        # read backwards, the words before b + q start n - len(back) - q items into ``ahead``
        return z[1 + n - q] if len(z) > 1 + n else 0

    def solve(self, least: int) -> dict[int, list[tuple[int, int]]]:
        """Period -> stretches [from, to) that these boundaries can see. A stretch that
        counts holds ``least`` whole blocks. Within a row of equal blocks only the first
        and the last boundary need their Z-functions; the words between are compared."""
        found: dict[int, list[tuple[int, int]]] = {}
        hits = recurring(self.x[self.skip :], self.size)
        hits = hits[hits[:, 0] <= self.last]
        rows = chains(hits, least, self.last) if len(hits) else hits
        if not len(rows):
            return found
        at, starts = np.unique(rows[:, 0], return_index=True)
        for block, own in zip(at.tolist(), np.split(rows, starts[1:])):
            b = self.skip + block * self.size
            good = set(primitive(self.forward(b), self.size + own[:, 2]).tolist())
            for _, blocks, shift in own.tolist():
                if (q := self.size + shift) in good:
                    self.extend(b, blocks, q, found)
        return found

    def extend(self, b: int, blocks: int, q: int, found: dict[int, list[tuple[int, int]]]) -> None:
        end = b + (blocks - 1) * self.size  # the last boundary
        if not np.array_equal(self.x[b:end], self.x[b + q : end + q]):  # hashes agreed by chance
            if blocks > 1:
                for i in range(blocks):
                    self.extend(b + i * self.size, 1, q, found)
            return
        reach = min(int(self.forward(end)[q]), 2 * self.size)
        if reach >= self.size:
            found.setdefault(q, []).append((self.lo + b - self.backward(b, q), self.lo + end + reach))


def fragments(x: np.ndarray, min_length: int, min_exponent: int) -> list[dict]:
    """The stretches of all tiles of one text; of those that end inside their tile, only
    the ones of a run that is long enough."""
    out = []
    n = len(x)
    for size, first, end in tiles(n, min_exponent):
        shortest = max(min_length - 2 * size + 1, (min_exponent - 1) * size)
        for q, own in Tile(x, size, first, end).solve(max(1, (shortest - size + 1) // size)).items():
            need = max(min_length, min_exponent * q) - q
            for s, e in own:
                if e - s >= need or (s <= first and first) or (e >= end and end < n):
                    out.append({"period": q, "s": s, "e": e})
    return out


def kept_words(words: list[bytes], runs: list[dict]) -> list[bytes]:
    """The words outside the repeats of every run (all of a run but its first period)."""
    gone = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        gone[r["start"] + r["period"]] += 1
        gone[r["start"] + r["length"]] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_exponent: int = 4, digest: bool = False) -> DataFrame:
    """One row per input row: id, ``n_words``, ``runs`` (start, length, period in words, by
    start and period) and ``collapsed``, the text whose runs are cut to their first period,
    words joined by one space (``digest``: its SHA-256 in lowercase hex instead).

    A run is a longest stretch of words with smallest period q, of at least ``min_length``
    words and ``min_exponent`` (3 or more) periods. Words are WORD_PATTERN, compared as
    they are. Null, empty and blank texts have no words and no runs. Repeated rows repeat;
    null ids stay null; an empty table gives an empty result; other columns are ignored.
    """
    if min_exponent < 3:
        raise ValueError("min_exponent must be 3 or more")
    id_type = docs.schema[id_col].dataType.simpleString()

    def shown(words: list[bytes]) -> bytes:
        text = b" ".join(words)
        return hashlib.sha256(text).hexdigest().encode() if digest else text

    def first_pass(batches):
        for b in batches:
            out = {"_id": b.column(0), "n_words": [], "collapsed": [], "open": [], "frags": []}
            for raw in b.column(1).cast(pa.binary()).to_pylist():
                words = raw.split() if raw else []
                frags = fragments(codes_of(words), min_length, min_exponent)
                out["n_words"].append(len(words))
                out["collapsed"].append(None if frags else shown(words))
                out["open"].append(b" ".join(words) if frags else None)
                out["frags"].append(frags or None)
            for c in ("collapsed", "open"):
                out[c] = pa.array(out[c], pa.binary()).cast(pa.string())
            yield out

    schema = f"_id {id_type}, n_words long, collapsed string, open string, frags array<struct<period:bigint,s:bigint,e:bigint>>"
    rows = map_batches(docs.select(F.col(id_col), F.col(text_col)), first_pass, schema)
    rows = shared_table(rows.withColumn("rid", F.monotonically_increasing_id()), "runs-texts")
    done = rows.filter("open is null").select(F.col("_id").alias(id_col), "n_words", F.array().cast(RUNS).alias("runs"), "collapsed")
    open_ = rows.filter("open is not null")
    runs = stitch(open_.select("rid", F.inline("frags")), min_length, min_exponent)
    per_text = runs.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "length", "period")), _by_start).alias("runs"))
    joined = open_.select("rid", "_id", "n_words", "open").join(per_text, "rid", "left")

    def second_pass(batches):
        for b in batches:
            runs = [r or [] for r in b.column(3).to_pylist()]
            texts = [shown(kept_words(t.split(), r)) for t, r in zip(b.column(2).cast(pa.binary()).to_pylist(), runs)]
            yield {id_col: b.column(0), "n_words": b.column(1), "runs": runs, "collapsed": pa.array(texts, pa.binary()).cast(pa.string())}

    rest = map_batches(joined.select("_id", "n_words", "open", "runs"), second_pass, f"`{id_col}` {id_type}, n_words long, runs {RUNS}, collapsed string")
    return done.unionByName(rest)


def _by_start(x, y):
    """Order of runs by start, then period."""
    return F.when(x["start"] != y["start"], F.signum(x["start"] - y["start"])).otherwise(F.signum(x["period"] - y["period"])).cast("int")


def stitch(frags: DataFrame, min_length: int, min_exponent: int) -> DataFrame:
    """(rid, start, length, period) of the runs that fragments (rid, period, s, e) form:
    fragments of one document and period that touch or overlap are one stretch."""
    ahead = W.Window.partitionBy("rid", "period").orderBy("s", "e")
    before = F.max("e").over(ahead.rowsBetween(W.Window.unboundedPreceding, -1))
    parted = frags.withColumn("new", F.when(F.col("s") <= before, 0).otherwise(1)).withColumn("part", F.sum("new").over(ahead))
    whole = parted.groupBy("rid", "period", "part").agg(F.min("s").alias("start"), F.max("e").alias("e"))
    whole = whole.withColumn("length", F.col("e") - F.col("start") + F.col("period"))
    return whole.filter((F.col("length") >= min_length) & (F.col("length") >= min_exponent * F.col("period"))).select("rid", "start", "length", "period")


def repeat_tail(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` (id and text) with planted repeats, a test bed for :func:`scan`: with h the
    crc32 of the id as text and g = h / 10, of every text with h % 10 = 0 and n > 0 words
    the words from a = g % n on repeat those of the first p = 1 + (n - a) / (3 + g % 8)."""
    from cartwheel.llm.common import WORD_PATTERN

    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"), (h % 10 == 0).alias("_on"), F.floor(h / 10).cast("long").alias("_g"))
    words = F.when(F.col("_on"), F.regexp_extract_all(F.col("_t"), F.lit(f"({WORD_PATTERN})"), F.lit(1)))
    base = base.withColumn("_w", words).withColumn("_n", F.coalesce(F.size("_w"), F.lit(0)).cast("long"))
    on = F.col("_on") & (F.col("_n") > 0)
    base = base.withColumn("_a", F.when(on, F.col("_g") % F.col("_n"))).withColumn("_p", F.when(on, 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))))
    shifted = F.expr("transform(_w, (w, i) -> if(i < _a, w, element_at(_w, cast(1 + _a + (i - _a) % _p as int))))")
    return base.select(F.col("_id").alias(id_col), F.when(on, F.array_join(shifted, " ")).otherwise(F.col("_t")).alias(text_col))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the run of greatest exponent (exact; ties: smallest start, then period) and
    hashes of a :func:`scan` with ``digest``."""
    def better(x, y):
        left, right = x["length"] * y["period"], y["length"] * x["period"]
        return F.when(left != right, F.signum(right - left).cast("int")).otherwise(_by_start(x, y))

    best = F.get(F.array_sort("runs", better), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_b", best).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), F.col("_b.start").alias("start"), F.col("_b.length").alias("length"),
        F.col("_b.period").alias("period"), F.floor(1000 * F.col("_b.length") / F.col("_b.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"),
    )
