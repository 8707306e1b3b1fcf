"""Vector codes: every part of a vector is replaced by the number of its nearest codebook
entry, with codebooks trained by whole-number k-means.

The nearest entry is found by slice and intersect. For each dimension the entries'
coordinates are sorted, and beside every place of that order stands the mask (four uint64
for 256 entries) of the entries before it. A radius around a query then selects a range of
each order; the masks of its two ends give the entries inside that slice, and the AND over
all dimensions the entries inside the box. The initial radius is the distance to a nearby
entry, so every entry at most that far (all ties of the nearest too) is in the box, and
only the box is measured exactly. Everything is computed in whole numbers.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import Shared, join_groups, map_batches, shared_table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
MOST = 1 << 26  # scaled components beyond this are moved to it, so that distances fit 64 bits
GUESSES = 8  # dimensions whose nearest coordinate is tried for the initial radius
PAIRS = 1 << 20  # pairs measured at once


class Slices:
    """Sorted coordinates and prefix masks of the entries (k, w) of one codebook."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        k, w = entries.shape
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, 0)
        words = -(-k // 64)
        self.masks = np.zeros((w, k + 1, words), np.uint64)  # [d, p]: the p entries of least coordinate d
        for d in range(w):
            one = np.zeros((k, words), np.uint64)
            one[np.arange(k), self.order[:, d] >> 6] = np.uint64(1) << (self.order[:, d] & 63).astype(np.uint64)
            self.masks[d, 1:] = np.bitwise_or.accumulate(one, axis=0)
        self.wide = np.argsort(self.sorted[0] - self.sorted[-1], kind="stable")[:GUESSES]  # widest dimensions

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of x; of equally near entries the lowest."""
        n, w = x.shape
        bound = np.full(n, np.iinfo(np.int64).max)
        for d in self.wide:
            at = np.clip(np.searchsorted(self.sorted[:, d], x[:, d]), 0, len(self.sorted) - 1)
            bound = np.minimum(bound, ((x - self.entries[self.order[at, d]]) ** 2).sum(1))
        radius = np.sqrt(bound.astype(np.float64)).astype(np.int64) + 1
        inside = np.full((n, self.masks.shape[2]), ~np.uint64(0))
        for d in range(w):
            low = np.searchsorted(self.sorted[:, d], x[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], x[:, d] + radius, "right")
            inside &= self.masks[d, high] & ~self.masks[d, low]
        code, error = np.empty(n, np.int64), np.empty(n, np.int64)
        step = max(1, PAIRS // len(self.entries))
        for i in range(0, n, step):
            code[i : i + step], error[i : i + step] = self._measure(x[i : i + step], inside[i : i + step])
        return code, error

    def _measure(self, x: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bits = np.unpackbits(np.ascontiguousarray(inside).view(np.uint8), axis=1, bitorder="little")
        row, entry = np.nonzero(bits)  # by row, then entry; every row has one at least
        apart = np.zeros(len(row), np.int64)
        for d in range(x.shape[1]):
            apart += (x[row, d] - self.entries[entry, d]) ** 2
        least = np.minimum.reduceat(apart, np.searchsorted(row, np.arange(len(x))))
        ties = np.flatnonzero(apart == least[row])
        rows, first = np.unique(row[ties], return_index=True)
        return entry[ties[first]], least


def whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), within MOST."""
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -MOST, MOST).astype(np.int64)


def usable(docs: DataFrame, id_col: str, vec_col: str, label_col: str | None) -> DataFrame:
    """(_id, _v, _l) of the rows whose vector has finite components only."""
    fine = F.forall(F.col("_v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    base = docs.select(F.col(id_col).alias("_id"), F.col(vec_col).cast("array<double>").alias("_v"), label.alias("_l"))
    return base.filter(F.col("_v").isNotNull() & fine)


def _vectors(column: pa.Array, dims: int, padded: int) -> np.ndarray:
    flat = whole(column.flatten().to_numpy(zero_copy_only=False)).reshape(-1, dims)
    return np.pad(flat, ((0, 0), (0, padded - dims)))


def first_books(rows: DataFrame, parts: int, entries: int) -> tuple[list[np.ndarray], int]:
    """Codebooks from the rows of smallest id, and the number of components of a vector."""
    first = rows.orderBy(F.col("_id").asc_nulls_last(), "_v").limit(entries).collect()
    if not first:
        return [], 0
    dims = len(first[0]["_v"])
    x = whole(np.array([r["_v"] for r in first if len(r["_v"]) == dims], np.float64).reshape(-1, dims))
    return np.split(np.pad(x, ((0, 0), (0, -dims % parts))), parts, axis=1), dims


def train(rows: DataFrame, books: list[np.ndarray], dims: int, rounds: int) -> list[np.ndarray]:
    """``rounds`` of assigning every vector and moving each entry to the floor of its mean.

    A task sends one sum per entry it used; sums are added by Spark, so the driver gets
    one row per entry."""
    width = books[0].shape[1] if books else 0
    names = [f"s{d}" for d in range(width)]
    some = rows.filter(F.size("_v") == dims).select("_v")
    for _ in range(rounds if width else 0):
        shared = Shared(rows.sparkSession, [Slices(b) for b in books])

        def sums(batches, shared=shared):
            own = shared.get()
            total = np.zeros((len(own), len(own[0].entries), width + 1), np.int64)
            for b in batches:
                x = _vectors(b.column(0), dims, width * len(own))
                for i, s in enumerate(own):
                    part = x[:, i * width : (i + 1) * width]
                    code, _ = s.nearest(part)
                    order = np.argsort(code, kind="stable")
                    used, starts = np.unique(code[order], return_index=True)
                    total[i, used, :width] += np.add.reduceat(part[order], starts)
                    total[i, used, width] += np.diff(np.r_[starts, len(code)])
            part, entry = np.nonzero(total[:, :, width])
            found = total[part, entry]
            yield {"part": part, "entry": entry, "n": found[:, width]} | {c: found[:, d] for d, c in enumerate(names)}

        schema = "part int, entry int, n long" + "".join(f", {c} long" for c in names)
        added = map_batches(some, sums, schema).groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in names])
        books = [b.copy() for b in books]
        for r in added.collect():
            books[r["part"]][r["entry"]] = [int(r[c]) // r["n"] for c in names]
    return books


def digest(books: list[np.ndarray]) -> str:
    numbers = ",".join(str(v) for b in books for v in b.ravel().tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def compress(docs: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """Returns (rows, codebooks). rows: one per usable input row: id, ``code`` (two hex
    digits per part), ``error`` (squared distance to its entries, summed over the parts),
    ``label_error`` (``error`` summed over the rows of the same label; null labels belong
    together).

    Rows whose vector is null or holds a null or non-finite component are dropped.
    Components become floor(1024 * x); beyond 2**26 they are moved there. Vectors have as
    many components as that of the smallest id; rows of another length stay, with null code
    and error, and train nothing. Components are padded with zeros to a multiple of
    ``parts``. Fewer than ``entries`` rows make smaller codebooks. Repeated rows repeat;
    null ids stay null and rank last for the first codebooks, ties by the vector. An empty
    table gives an empty result and no codebooks; other columns are ignored.
    """
    rows = usable(docs, id_col, vec_col, label_col)
    books, dims = first_books(rows, parts, entries)
    books = train(rows, books, dims, rounds)
    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("_id", "_l"))
    shared = Shared(docs.sparkSession, [Slices(b) for b in books if b.size])

    def run(batches):
        own = shared.get()
        for b in batches:
            sizes = b.column(1).value_lengths().to_numpy(zero_copy_only=False)
            fit = (sizes == dims) & bool(own)
            code, error = np.zeros((len(sizes), parts), np.int64), np.zeros(len(sizes), np.int64)
            if fit.any():
                width = own[0].entries.shape[1]
                x = _vectors(b.column(1).filter(pa.array(fit)), dims, width * parts)
                for i, s in enumerate(own):
                    code[fit, i], far = s.nearest(x[:, i * width : (i + 1) * width])
                    error[fit] += far
            text = [bytes(c).hex() if f else None for c, f in zip(code.astype(np.uint8), fit)]
            yield {"_id": b.column(0), "_l": b.column(2), "code": text, "error": pa.array(error, mask=~fit)}

    coded = map_batches(rows.select("_id", "_v", "_l"), run, f"_id {id_type}, _l {label_type}, code string, error long")
    coded = coded.withColumns({"_none": F.col("_l").isNull(), "_k": F.coalesce(F.col("_l").cast("string"), F.lit(""))}).drop("_l")
    coded = shared_table(coded, "codes-rows")
    sums = shared_table(coded.groupBy("_none", "_k").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_rows")), "codes-labels")
    out = join_groups(coded, sums, ["_none", "_k"], "_rows", coded.count())
    return out.select(F.col("_id").alias(id_col), "code", "error", "label_error"), books


def decode(code: str, books: list[np.ndarray]) -> np.ndarray:
    """The vector (scaled whole numbers) that a code stands for."""
    return reduce(lambda x, y: np.concatenate([x, y]), (b[i] for b, i in zip(books, bytes.fromhex(code))))
