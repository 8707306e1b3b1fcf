"""Registered queries against their SQL, and the pipeline against a plain composition."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from cartwheel.llm import exact_dedup, jaccard_join, langid, mixing, oracles, queries
from cartwheel.llm.common import table
from conftest import SF_ORACLE, SF_SMALL
from llm.test_brute_force import brute_components, brute_contamination

TABLES = ("documents", "benchmark", "labels", "pages", "embeddings")


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    res = con.execute(oracles.ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(repr, res.fetchall()))


def test_all_queries_are_registered():
    names = [q for q in E.queries() if q.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14)) and "pipeline" in E.queries()


def test_pipeline_equals_the_stages_one_by_one(spark):
    docs = [r.asDict() for r in table(spark, SF_SMALL, "documents").collect()]
    text = {d["doc_id"]: d["text"] for d in docs}
    # 1: texts with a letter; 2: largest id of equal texts; 3: smallest id of a component; 4: no benchmark window
    kept = {i for i, t in text.items() if any(c.isalpha() for c in t or "")}
    last = {}
    for i in sorted(kept):
        last[text[i] or ""] = i
    kept = set(last.values())
    comps = brute_components([(i, text[i]) for i in kept])
    kept = {i for i in kept if comps[i][1] == i}
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    kept = {i for i, (_, hits, _) in brute_contamination([(i, text[i]) for i in kept], items).items() if not hits}
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in out} == kept and len(out) == len(kept)
    source = {d["doc_id"]: d["source"] for d in docs}
    per = {}
    for r in out:
        per.setdefault(source[r["doc_id"]], []).append(r)
    names = sorted(per)
    aims = mixing.targets([sum(r["size"] for r in per[s]) for s in names], [mixing.WEIGHTS[i % 3] for i in range(len(names))])
    for s, aim in zip(names, aims):
        assert {r["target"] for r in per[s]} == {aim} and abs(math.fsum(r["taken"] for r in per[s]) - aim) <= 0.2 * aim + 20


def test_stages_keep_the_columns_of_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).dtypes == docs.dtypes
    assert exact_dedup.drop_duplicates(docs).count() <= docs.count()
    assert jaccard_join.drop_linked(docs).count() <= docs.count()
    assert langid.train(docs) is not None
    assert table(spark, SF_ORACLE, "documents").columns == docs.columns
