"""Cases that once went wrong: odd markup, long texts, repeated rows, ids that run into
texts, pairs of words that tell something only together."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from cartwheel.llm import decontaminate, exact_dedup, html_text, langid, licenses, mixing, secrets, toxicity
from cartwheel.llm.common import table
from conftest import SF_SMALL

LONG = "a long paragraph of plain text that says something, " * 4


# 8 ------------------------------------------------------------------------------------


@pytest.mark.parametrize("tag", ["article", "div"])
def test_an_unclosed_anchor_is_no_link(tag):
    text = html_text.extract(f"<{tag}><h1>Title</h1><a name='top'><p>{LONG}<p>{LONG}<p>{LONG}</{tag}>")
    assert text == " ".join(("Title " + 3 * LONG).split())


def test_an_unclosed_link_ends_with_its_block():
    text = html_text.extract(f"<article><p>See <a href='/x'>here</p><p>{LONG}</p></article>")
    assert text == " ".join(("See here " + LONG).split())
    menu = html_text.extract(f"<ul><li><a href='/a'>One link</a><li><a href='/b'>Another link</a></ul><div><p>{LONG}</p></div>")
    assert menu == LONG.strip()


def test_names_alone_take_no_text_from_an_article():
    page = (
        f"<article><div class='meta'>By Ann, 3 May 2024</div><p>{LONG}</p><div class='legal'>A legal point.</div>"
        "<section id='social'>On social matters.</section><p>As <math>E = mc</math> says.</p><div class='related'><a href='/x'>More of this</a></div></article>"
    )
    assert html_text.extract(page) == f"By Ann, 3 May 2024 {LONG}A legal point. On social matters. As E = mc says."


def test_deep_and_unmatched_tags_take_linear_time():
    assert html_text.extract("<div>" * 30_000 + LONG + "</section>" * 30_000 + "</div>" * 30_000) == LONG.strip()


# 7 ------------------------------------------------------------------------------------


def test_spans_outside_others_equal_all_comparisons():
    rng = random.Random(1)
    for _ in range(300):
        draw = lambda: sorted((s, s + rng.randrange(1, 9)) for s in (rng.randrange(40) for _ in range(rng.randrange(8))))
        spans, others = [(*s, "k") for s in draw()], draw()
        assert secrets.outside(spans, others) == [s for s in spans if not any(a <= s[0] and s[1] <= b for a, b in others)]


def test_a_long_list_of_hashes(spark):
    lines = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(20_000)]
    out = secrets.digest(secrets.scan(spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string"))).first()
    assert out["n_hex"] == 20_000 and out["spans"].count(",") == 19_999


# 2, 4 ---------------------------------------------------------------------------------


def test_a_repeated_row_is_drawn_once(spark, monkeypatch):
    seen = []
    plain = licenses._plain
    monkeypatch.setattr(licenses, "_plain", lambda t: seen.append(t) or plain(t))
    docs = spark.createDataFrame([(1, "the same words again and again", "en")] * 3000 + [(2, "ein anderer text", "de"), (3, "x" * 200_000, "de")], "doc_id long, text string, lang string")
    licenses.train(docs)
    assert sorted(seen) == ["ein anderer text", "the same words again and again"]
    model = langid.train(docs.withColumnRenamed("doc_id", "id").selectExpr("id + 10 AS doc_id", "text", "lang"))
    assert model is not None


# 3, 5 ---------------------------------------------------------------------------------


def test_ids_cannot_run_into_texts(spark):
    docs = spark.createDataFrame([("a", "b\n alpha beta gamma"), ("a\nb", " alpha beta gamma"), (None, "x"), ("null", "x y")], "doc_id string, text string")
    bench = spark.createDataFrame([(1, "b alpha beta gamma")], "item_id long, text string")
    kept = [tuple(r) for r in decontaminate.remove_contaminated(docs, bench).collect()]
    assert ("a\nb", " alpha beta gamma") in kept and len(kept) == 3


def test_of_repeated_rows_the_same_one_stays(spark):
    rows = [(1, "the same text", s) for s in "abcdefgh"] + [(0, "the same text", "z")]
    kept = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(1 + seed)
        kept.add(tuple(exact_dedup.drop_duplicates(docs).collect()[0]))
    assert len(kept) == 1


# 9 ------------------------------------------------------------------------------------


def test_a_pair_that_tells_nothing_apart():
    """The label is "both words or neither", among noise: no single word tells anything."""
    rng = np.random.default_rng(0)
    n = 4000
    a, b = rng.random(n) < 0.5, rng.random(n) < 0.5
    y = (a == b).astype(np.float32)
    noise = rng.integers(100, 2000, (n, 12))
    docs = [np.unique(np.r_[noise[i], [5] if a[i] else [], [9] if b[i] else []].astype(np.int64)) for i in range(n)]
    model = toxicity.Model().fit(docs[:3000], y[:3000])
    own = np.repeat(np.arange(1000), [len(d) for d in docs[3000:]])
    margins, _ = model.margins(np.concatenate(docs[3000:]), own, 1000)
    assert ((margins > 0) == (y[3000:] > 0)).mean() > 0.95 and model.v[5] @ model.v[9] > 1


# 10 -----------------------------------------------------------------------------------


def test_places_are_the_copies_taken(spark):
    out = mixing.mixed(table(spark, SF_SMALL, "documents")).collect()
    by_shard = {}
    for r in out:
        places = r["places"] or []
        assert [p["copy"] for p in places] == list(range(r["n_copies"])) or len(places) == r["n_copies"]
        for p in places:
            by_shard.setdefault(p["shard"], []).append(p["position"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in by_shard.values())
    assert sum(map(len, by_shard.values())) == sum(r["n_copies"] for r in out) > 0
