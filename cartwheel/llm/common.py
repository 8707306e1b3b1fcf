"""Helpers shared by the training-data operators.

Row identity: several operators give every input row a number (``rid``) and write it
down in the shared checkpoint folder before anything else depends on it, so null or
repeated ids never merge two rows and a recomputed task cannot renumber them.
"""

from __future__ import annotations

import ctypes
import pickle
import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.sources.sinks import scratch_root

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
MEMO_ENTRIES = 250_000  # entries of a per-task word memo before it starts anew


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (cuts lineage,
    survives lost executors); the folder goes when the session ends."""
    path = scratch_root(df.sparkSession, name)
    made.append(path)
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


made: list[str] = []  # folders of the shared tables written so far


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Delete shared tables that nothing reads any more, before the session ends."""
    for t in tables:
        _delete(t.sparkSession, t._scratch)


def discard_since(mark: int, keep: DataFrame) -> None:
    """Delete all shared tables written since ``made`` had ``mark`` entries but ``keep``,
    a written table, on whose way they were."""
    for path in made[mark:]:
        if path != keep._scratch:
            _delete(keep.sparkSession, path)
    made[mark:] = [keep._scratch]


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % modulus


class Shared:
    """A broadcast of any object of this package; ``get()`` unpacks it, once per task."""

    def __init__(self, spark: SparkSession, value):
        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self):
        return pickle.loads(self.packed.value)


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, split at space, tab, LF, VT, FF, CR: exactly WORD_PATTERN."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class Memo(dict):
    """word -> value, filled on first use; ``trim()`` between batches bounds its memory."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value

    def trim(self) -> None:
        if len(self) > MEMO_ENTRIES:
            self.clear()


# Arrow batch bounds of the session, where they are still Spark's own: texts may be long, and a
# worker and its executor each hold a few copies of a batch
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m")}


def bound_batches(spark: SparkSession) -> None:
    for key, (own, bound) in BATCHES.items():
        if spark.conf.get(key, own) == own:
            spark.conf.set(key, bound)


def release() -> None:
    """Give freed memory back to the system: the worker lives on, idle."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` whose function yields plain dicts of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    bound_batches(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for out in fn(batches):
            arrays = [x.cast(f.type) if isinstance(x := out[f.name], pa.Array) else pa.array(x, type=f.type) for f in arrow]
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
                del arrays, out
        release()

    return df.mapInArrow(run, schema)


def pack(x: np.ndarray) -> bytes:
    return zlib.compress(x.tobytes(), 1)


def sum_blocks(df: DataFrame, dtype: str, parts: int = 16) -> DataFrame:
    """Sum equally long packed vectors per ``block``. Vectors are added as they stream
    past, so a task holds one vector per block however many tasks sent one."""

    def run(batches):
        acc: dict[int, np.ndarray] = {}
        for b in batches:
            for key, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(zlib.decompress(raw), dtype)
                acc[key] = acc[key] + x if key in acc else x
        yield {"block": list(acc), "data": [pack(x) for x in acc.values()]}

    return map_batches(df.select("block", "data").repartition(parts, "block"), run, "block int, data binary")


def collect_blocks(df: DataFrame, dtype: str, length: int, per_block: int) -> np.ndarray:
    """The whole vector on the driver; its length is a parameter, not a data size."""
    out = np.zeros(length, dtype)
    for r in df.toLocalIterator():
        x = np.frombuffer(zlib.decompress(bytes(r["data"])), dtype)
        out[r["block"] * per_block : r["block"] * per_block + len(x)] = x
    return out


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, share: float = 0.001) -> DataFrame:
    """Left join of ``rows`` with ``groups`` (one row per key, ``size`` rows each).

    Keys holding more than ``share`` of all ``total`` rows number fewer than 1/share,
    which bounds the broadcast; only the other keys go through the shuffle join, so no
    task receives a hot group. Keys must not be null.
    """
    floor = total * share
    hot = F.broadcast(groups.filter(F.col(size) > floor))
    cold = rows.join(hot.select(*keys), keys, "left_anti").join(groups.filter(F.col(size) <= floor), keys, "left")
    return rows.join(hot, keys, "inner").unionByName(cold)


class Bloom:
    """Membership pre-filter over 64-bit keys with a fixed memory bound.

    ``maybe`` is true for every key that was added, and for few others; callers follow
    it with an exact step, so its size changes cost, never results.
    """

    BLOCK = 1 << 16  # bytes of one block of the bit array

    def __init__(self, keys: DataFrame, n: int, max_bytes: int = 32 << 20):
        """``keys``: one long column; ``n``: about how many rows it has."""
        spark = keys.sparkSession
        size = self.BLOCK
        while size < min(max_bytes, 2 * n):
            size *= 2
        self.bits = size * 8
        bits, step = self.bits, self.BLOCK

        def build(batches):
            own = np.zeros(size, np.uint8)
            for b in batches:
                for i in Bloom.spots(b.column(0).to_numpy(zero_copy_only=False), bits):
                    np.bitwise_or.at(own, i >> 3, np.left_shift(np.uint8(1), (i & 7).astype(np.uint8)))
            used = [k for k in range(size // step) if own[k * step : (k + 1) * step].any()]
            yield {"block": used, "data": [pack(own[k * step : (k + 1) * step]) for k in used]}

        def unite(batches):
            acc: dict[int, np.ndarray] = {}
            for b in batches:
                for key, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    x = np.frombuffer(zlib.decompress(raw), np.uint8)
                    acc[key] = acc[key] | x if key in acc else x
            yield {"block": list(acc), "data": [pack(x) for x in acc.values()]}

        parts = map_batches(keys, build, "block int, data binary")
        whole = map_batches(parts.repartition(8, "block"), unite, "block int, data binary")
        out = np.zeros(size, np.uint8)
        for r in whole.collect():  # one job; together no longer than the bit array
            out[r["block"] * step : (r["block"] + 1) * step] = np.frombuffer(zlib.decompress(r["data"]), np.uint8)
        self.array = spark.sparkContext.broadcast(out)

    @staticmethod
    def spots(keys: np.ndarray, bits: int) -> list[np.ndarray]:
        k = keys.astype(np.int64).view(np.uint64)
        second = (k >> np.uint64(32)) | np.uint64(1)
        return [((k + np.uint64(i) * second * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(bits)).astype(np.int64) for i in range(3)]

    def tester(self) -> Callable[[np.ndarray], np.ndarray]:
        """The test as a function that tasks may call."""
        shared, bits = self.array, self.bits

        def test(keys: np.ndarray) -> np.ndarray:
            own = shared.value
            hit = np.ones(len(keys), bool)
            for i in Bloom.spots(keys, bits):
                hit &= (own[i >> 3] >> (i & 7).astype(np.uint8)) & 1 == 1
            return hit

        return test

    def maybe(self, key: Column) -> Column:
        import pandas as pd

        test = self.tester()

        def column(keys):
            return pd.Series(test(keys.to_numpy()))

        column.__annotations__ = {"keys": pd.Series, "return": pd.Series}
        return F.pandas_udf(column, "boolean")(key)


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A digest of id and text; equal only for rows that agree in both (the length of the
    id goes first, so no id can run into the text; "-" stands for a null id)."""
    own = F.col(id_col).cast("string")
    named = F.coalesce(F.concat(F.length(own).cast("string"), F.lit(":"), own), F.lit("-"))
    return F.sha2(F.concat(named, F.coalesce(F.col(text_col), F.lit(""))), 256)


def drop_listed(docs: DataFrame, listed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows listed by their ``row_key`` (column ``_key``, no key twice).

    Where ``_stays`` is true, the key belongs to repeated rows of which one stays: of rows
    that differ in other columns, the one with the smallest hash of the whole row. Rows
    that a Bloom filter of the keys rules out pass straight through; only the remaining
    few are shuffled for the exact anti join.
    """
    listed = shared_table(listed, "listed")
    n = listed.count()
    if not n:
        return docs
    bloom = Bloom(listed.select(F.xxhash64("_key")), n)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")  # no column of docs can clash
    keyed = docs.select(whole, row_key(id_col, text_col).alias("_key")).withColumn("_maybe", bloom.maybe(F.xxhash64("_key")))
    rest = keyed.filter("_maybe")
    out = keyed.filter(~F.col("_maybe")).select("_row.*").unionByName(rest.join(listed, "_key", "left_anti").select("_row.*"))
    again = listed.filter("_stays")
    if again.isEmpty():
        return out
    one = rest.join(again, "_key", "left_semi").groupBy("_key").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return out.unionByName(one.select("_row.*"))


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising bit mixer on uint64 (multiply-xorshift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SEGMENT, LONG_WORD = 1 << 18, 512
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_VALUE[0x41:0x5B] = _VALUE[0x61:0x7B]  # A-Z count as a-z
_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 32
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64


class WordHasher:
    """64-bit hashes of the words (WORD_PATTERN, A-Z as a-z) of Arrow strings, computed on
    the UTF-8 buffer without making a Python object per word: a polynomial over the bytes,
    cut out of a running sum, then mixed. Long words are hashed one by one."""

    def __init__(self):
        ones = np.ones(SEGMENT + 1, np.uint64)
        ones[1:] = np.uint64(_BASE)
        self.power = np.multiply.accumulate(ones)
        ones[1:] = np.uint64(pow(_BASE, -1, 1 << 64))
        self.inverse = np.multiply.accumulate(ones)

    def chunks(self, column: pa.Array, most: int = 1 << 20, tails: bool = False) -> Iterator[tuple]:
        """(first row, word hashes, words per row) of stretches of rows of about ``most``
        bytes; with ``tails`` also the last two bytes of each word as one number (0 before
        a single byte)."""
        n = len(column)
        if not n:
            return
        wide = pa.types.is_large_string(column.type)
        offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32).astype(np.int64, copy=False)[column.offset : column.offset + n + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
            yield lo, *self.rows(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], tails)
            lo = hi

    def rows(self, data: np.ndarray, offsets: np.ndarray, tails: bool) -> tuple:
        word = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.empty(len(data), bool)
        before[:1], before[1:] = True, ~word[:-1]
        after = np.empty(len(data), bool)
        after[-1:], after[:-1] = True, ~word[1:]
        starts = np.flatnonzero(word & (before | edge[:-1]))
        ends = np.flatnonzero(word & (after | edge[1:])) + 1
        h = np.zeros(len(starts), np.uint64)
        length = ends - starts
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, "right")))
            at = starts[i]
            part = data[at : ends[j - 1]]
            if len(part) <= SEGMENT:
                total = np.zeros(len(part) + 1, np.uint64)
                np.cumsum(_VALUE[part] * self.power[: len(part)], out=total[1:])
                own = starts[i:j] - at
                h[i:j] = (total[ends[i:j] - at] - total[own]) * self.inverse[own]
            i = j
        h = mix64(h + length.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        for k in np.flatnonzero(length > LONG_WORD):
            h[k] = word_hash(data[starts[k] : ends[k]].tobytes().lower())
        sizes = np.diff(np.searchsorted(starts, offsets))
        if not tails:
            return h, sizes
        last, prior = _LOWER[data[ends - 1]], _LOWER[data[np.maximum(ends - 2, 0)]]
        return h, sizes, np.where(length > 1, prior, 0) * 256 + last
