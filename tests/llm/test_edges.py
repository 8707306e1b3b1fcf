"""Every operator on nulls, empty and very long texts, repeated rows, empty tables and
extra columns whose names clash with its own."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import decontaminate, exact_dedup, html_text, jaccard_join, langid, licenses, lm, mixing, secrets, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, _key string, digest string, n int, block string, label string, size int"
LONG = " ".join(f"word{i % 977} und" for i in range(40_000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away today", "en", "a"),
    (2, "the quick brown fox jumps over the lazy dog and runs away today", "en", "b"),
    (2, "the quick brown fox jumps over the lazy dog and runs away today", "en", "b"),  # repeated row
    (3, "", "en", None),
    (4, None, None, "a"),
    (None, "ein kurzer satz", "de", None),
    (None, None, None, None),
    (5, " \t\n\x0b\x0c\r ", "de", "b"),
    (6, "1234 !!", None, "a"),
    (7, LONG, "de", "b"),
    (8, "x", "en", "c"),
    (9, "der die und das ist nicht ein satz", "de", "c"),
    (2, "another text under the same id", "en", "c"),
]


@pytest.fixture(scope="module")
def nasty(spark):
    return spark.createDataFrame([(*r, 0, 99, "k", "d", 1, "b", "l", 2) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def test_lm(spark, nasty, empty):
    out = rows(lm.score_documents(nasty))
    assert len(out) == len(ROWS)
    assert all(r["score"] <= 0 and r["n_tokens"] >= 1 for r in out)
    assert {r["n_tokens"] for r in out if r["doc_id"] in (3, 4, 5)} == {1}
    assert lm.score_documents(empty).count() == 0
    unseen = lm.score_documents(nasty.filter((F.crc32(F.col("doc_id").cast("string")) % 7) == 2))
    assert all(r["train_tokens"] == 0 and r["base_score"] == 0 for r in rows(unseen))


def test_langid(nasty, empty):
    model = langid.train(nasty)
    out = rows(langid.predict(nasty, model))
    assert len(out) == len(ROWS)
    for r in out:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["language"]["lang"] != "und") == letters
        assert 0 <= r["language"]["score"] <= 1
    kept = langid.keep_known(nasty, model)
    assert kept.columns == nasty.columns and kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in ROWS)
    assert langid.train(empty) is None
    assert {r["language"]["lang"] for r in rows(langid.predict(nasty, None))} == {"und"}
    assert langid.predict(empty, model).count() == 0


def test_exact_dedup(nasty, empty):
    out = rows(exact_dedup.refine(nasty))
    assert len(out) == len(ROWS)
    by_text = [r for r in out if r["n_chars"] == len(ROWS[0][1])]
    assert [r["group_size"] for r in by_text] == [3] * 3 and {r["keep_id"] for r in by_text} == {2} and sum(r["kept"] for r in by_text) == 1
    blank = [r for r in out if r["n_chars"] == 0]  # ids 3, 4, null: null text counts as empty
    assert {r["keep_id"] for r in blank} == {4} and len(blank) == 3
    kept = rows(exact_dedup.drop_duplicates(nasty))
    texts = {r[1] or "" for r in ROWS}
    assert len(kept) == len(texts) and {r["text"] or "" for r in kept} == texts
    assert all(r["_key"] == "k" and r["rid"] == 99 for r in kept)
    assert exact_dedup.refine(empty).count() == 0 and exact_dedup.drop_duplicates(empty).count() == 0


def test_licenses(spark, nasty, empty):
    model = licenses.train(nasty)
    out = rows(licenses.scan(nasty, model))
    assert len(out) == len(ROWS) and not any(r["licenses"] for r in out)
    assert licenses.scan(empty, model).count() == 0
    assert licenses.scan(empty).count() == 0


def test_decontaminate(spark, nasty, empty):
    bench = spark.createDataFrame([(1, "the Quick brown fox-jumps over"), (2, None), (3, ""), (None, "und word1 und word2"), (4, "ein kurzer satz mehr")], "item_id long, text string")
    out = rows(decontaminate.find_matches(nasty, bench))
    assert len(out) == len(ROWS)
    assert {tuple(r["items"]) for r in out if r["doc_id"] == 1} == {("1",)}
    assert [r["items"] for r in out if r["doc_id"] == 7] == [["null"]]
    assert all(r["n_words"] == 0 and r["n_hit"] == 0 for r in out if r["doc_id"] in (3, 4, 5))
    assert all(r["n_hit"] == 0 for r in rows(decontaminate.find_matches(nasty, bench.limit(0))))
    assert decontaminate.find_matches(empty, bench).count() == 0
    clean = decontaminate.remove_contaminated(nasty, bench)
    assert sorted(str(r["doc_id"]) for r in rows(clean)) == sorted(str(r[0]) for r in ROWS if r[0] not in (1, 7) and r[1] != ROWS[0][1])
    assert clean.columns == nasty.columns


def test_jaccard(nasty, empty):
    out = rows(jaccard_join.classes(nasty))
    assert len(out) == len(ROWS)
    fox = [r for r in out if r["n_shingles"] == 11]
    assert {r["component_id"] for r in fox} == {1} and {r["members"] for r in fox} == {3}
    assert all(r["component_id"] == r["doc_id"] for r in out if r["n_shingles"] == 0)
    kept = jaccard_join.drop_linked(nasty)
    assert kept.columns == nasty.columns and kept.count() == len(ROWS) - 2
    assert jaccard_join.classes(empty).count() == 0 and jaccard_join.drop_linked(empty).count() == 0


def test_secrets(nasty, empty):
    out = rows(secrets.digest(secrets.scan(nasty)))
    assert len(out) == len(ROWS) and {r["spans"] for r in out} == {""}
    assert secrets.scan(empty).count() == 0


def test_html(spark, empty):
    pages = spark.createDataFrame(
        [(1, "u", None, 0), (2, None, "", 0), (None, "u", "plain text, no markup at all", 0), (3, "u", "<p>" * 5000 + "deep", 0), (3, "u", "<p>" * 5000 + "deep", 0), (4, "u", "<article><p>one", 0)],
        "page_id long, url string, html string, text int",
    )
    out = rows(html_text.extract_pages(pages))
    assert sorted((str(r["page_id"]), r["text"]) for r in out) == [("1", ""), ("2", ""), ("3", "deep"), ("3", "deep"), ("4", "one"), ("None", "plain text, no markup at all")]
    assert html_text.extract_pages(pages.limit(0)).count() == 0


def test_toxicity(spark, nasty, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (2, 1, 1), (9, 1, None), (None, 1, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(nasty, labels)
    out = rows(toxicity.score(nasty, model))
    assert len(out) == len(ROWS) and all(0 <= r["toxicity"] <= 1 for r in out)
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.train(empty, labels.limit(0)).bias == 0


def test_mixing(nasty, empty):
    out = rows(mixing.mixed(nasty))
    assert len(out) == len(ROWS)
    assert all(r["size"] == 0 and r["taken"] == 0 for r in out if r["doc_id"] in (3, 4, 5))
    assert all(r["taken"] <= 2 * r["size"] for r in out)
    assert mixing.mixed(empty).count() == 0


def test_pipeline_stages(spark, nasty, empty, tmp_path):
    """Every stage on null, empty, repeated and long rows, and on an empty table."""
    import corpus_pipeline

    bench = spark.createDataFrame([(1, "no such passage in any document"), (2, None)], "item_id long, text string")
    for items in (bench, bench.limit(0)):
        items.write.mode("overwrite").parquet(str(tmp_path / "benchmark.parquet"))
        docs, none = nasty, empty
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs, none = stage(spark, docs, str(tmp_path)), stage(spark, none, str(tmp_path))
            assert docs.columns == nasty.columns and none.columns == nasty.columns and none.count() == 0
        kept = rows(docs)
        assert sorted(r["text"] for r in kept) == sorted({r[1] for r in ROWS if any(c.isalpha() for c in r[1] or "")})
        assert [r["doc_id"] for r in kept if r["text"] == ROWS[0][1]] == [2] and sum(r["doc_id"] is None for r in kept) == 1
        mix = rows(corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)))
        assert len(mix) == len(kept) and corpus_pipeline.STAGES[-1][1](spark, none, str(tmp_path)).count() == 0


def test_pipeline_leaves_only_its_last_table(spark):
    import os

    import corpus_pipeline
    from cartwheel.llm.common import made
    from conftest import SF_SMALL

    before = len(made)
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.count() > 0
    left = [p for p in made[before:] if os.path.exists(p.removeprefix("file:"))]
    assert sum("pipeline-" in p for p in left) == 1 and not any("jaccard" in p or "dedup" in p or "listed" in p for p in left)
