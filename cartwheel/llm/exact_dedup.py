"""Exact duplicates by progressive refinement (length, prefix hash, full hash).

1. Count texts per length. 2. Texts whose length is shared: count per (length, hash of
the first characters). 3. Only texts still sharing a key are read whole and hashed.
Lengths and prefixes only rule texts out; equality is decided by the full SHA-256, so
prefixes never stand for whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import Bloom, drop_listed, join_groups, row_key, shared_table

PREFIX_CHARS = 64


def refine(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: id, ``rid``, ``n_chars``, ``keep_id`` (largest id of the
    equal texts), ``group_size``, ``kept``, ``text_sha256``.

    Null text counts as empty. Null ids rank below all others. Of repeated rows (same id
    and text) exactly one is kept. An empty table gives an empty result. Other columns
    of ``docs`` are ignored, whatever their names. ``text_sha256`` is null for texts that
    refinement ruled out, unless ``digest_all`` asks for the digest of every text.
    ``extra`` adds columns computed from ``_id`` and ``_t`` (the text) to the result.
    """
    base = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t")).withColumn("_n", F.length("_t").cast("long"))
    prefix = F.xxhash64("_n", F.substring("_t", 1, PREFIX_CHARS))

    def shared(keys: DataFrame) -> Bloom | None:
        """Keys seen more than once (a Bloom filter: what it lets through by mistake is
        hashed in full and found to be single)."""
        many = shared_table(keys.groupBy("_k").count().filter("count > 1").select("_k"), "dedup-keys")
        n = many.count()
        return Bloom(many, n) if n else None

    lengths = shared(base.select(F.xxhash64("_n").alias("_k")))
    prefixes = lengths and shared(base.filter(lengths.maybe(F.xxhash64("_n"))).select(prefix.alias("_k")))
    open_ = prefixes.maybe(prefix) if prefixes else F.lit(False)
    sha = F.sha2("_t", 256)
    rows = base.withColumn("_open", open_).select(
        "_id", F.monotonically_increasing_id().alias("rid"), F.col("_n").alias("n_chars"), "_open",
        (sha if digest_all else F.when(F.col("_open"), sha)).alias("text_sha256"), *[c.alias(k) for k, c in (extra or {}).items()],
    )
    rows = shared_table(rows, "dedup-rows")
    total = rows.count()
    single = rows.filter(~F.col("_open")).withColumns({"keep_id": F.col("_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
    candidates = rows.filter("_open")
    groups = shared_table(
        candidates.groupBy("n_chars", "text_sha256").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("_id", "rid")).alias("_top")), "dedup-groups"
    )
    grouped = (
        join_groups(candidates, groups, ["n_chars", "text_sha256"], "group_size", total)
        .withColumns({"keep_id": F.col("_top._id"), "kept": F.col("rid") == F.col("_top.rid")})
        .drop("_top")
    )
    return single.unionByName(grouped.select(*single.columns)).drop("_open").withColumnRenamed("_id", id_col)


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each distinct text (the largest id), all columns kept."""
    found = refine(docs, id_col, text_col, extra={"_key": row_key("_id", "_t")})
    listed = found.groupBy("_key").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("_stays")).filter("n > 1 or not _stays")
    return drop_listed(docs, listed.select("_key", "_stays"), id_col, text_col)
