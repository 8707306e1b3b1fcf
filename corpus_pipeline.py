"""The corpus pipeline: documents in, a weighted mix of clean documents out.

Every stage takes a table with the columns of ``documents`` and decides by ``doc_id``,
``text`` and (language identification, mixing) ``lang`` and ``source``; other columns pass
through. All of them hold for any table: null ids stay null and never merge rows, null text
counts as empty, rows repeated in full count as copies, and an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm import decontaminate, exact_dedup, jaccard_join, langid, mixing
from cartwheel.llm.common import discard_since, made, shared_table, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows. Texts that are null or without a letter go;
    without a single row to learn from, all go."""
    return langid.keep_known(docs, langid.train(docs))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the largest id of each distinct text (null ids rank lowest; of rows
    equal in id and text, the one with the smallest hash of all columns)."""
    return exact_dedup.drop_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group linked by the Jaccard similarity of three-word shingles
    (90 %). Texts without words are linked with nothing and stay."""
    return jaccard_join.drop_linked(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item; all, if there is no item with words."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of every remaining document the mix takes (a null source is one more
    source, the last)."""
    return mixing.mixed(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("jaccard_join", near_duplicates),
    ("decontamination", benchmark_passages),
    ("mixing", source_mix),
]
# language identification and the seeded mix have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written and reread. Once a stage is
    written, its input and the tables it made on its way are deleted."""
    docs = table(spark, sf_dir, "documents")
    start = len(made)
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard_since(start, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
