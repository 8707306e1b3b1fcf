"""The Jaccard join on large groups: what its joins make, and what its filters let through."""

from __future__ import annotations

import random

import numpy as np
import pytest

from cartwheel.llm import jaccard_join
from llm.test_brute_force import brute_components


def changed(rng, words, n):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"x{rng.random()}"
    return words


@pytest.fixture
def sizes(monkeypatch):
    """Rows of every table the join wrote, by name."""
    found, write = {}, jaccard_join.shared_table

    def counted(df, name):
        out = write(df, name)
        found.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "shared_table", counted)
    return found


def frame(spark, texts):
    return spark.createDataFrame([(i, " ".join(ws)) for i, ws in enumerate(texts)], "doc_id long, text string").repartition(4)


def test_a_group_short_of_the_threshold_makes_few_pairs(spark, sizes):
    """60 copies, any two of which are some 83 % alike: 1,770 pairs share prefix shingles."""
    rng = random.Random(1)
    base = [f"w{i}" for i in range(400)]
    out = jaccard_join.classes(frame(spark, [changed(rng, base, 7) for _ in range(60)])).collect()
    assert all(r["component_id"] == r["doc_id"] for r in out)
    assert sum(sizes["jaccard-pairs"]) <= 60


def test_links_between_tied_groups_are_one(spark, sizes):
    """Chains of copies: many links between few components."""
    rng = random.Random(2)
    texts = []
    for k in range(3):
        base = [f"v{k}-{i}" for i in range(300)]
        for _ in range(40):
            texts.append(changed(rng, base, rng.randrange(0, 5)))
    docs = frame(spark, texts)
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.classes(docs).collect()}
    assert out == brute_components([(i, " ".join(ws)) for i, ws in enumerate(texts)])
    assert sum(sizes.get("jaccard-ties", sizes["jaccard-links"])) <= 2 * len(texts)


def test_a_pair_is_met_once_in_a_shared_stretch(spark):
    """Of shared shingles in a row only the first makes a row; others in between start anew."""
    rows = [(s, c, 10, i + 1, c, (at[i - 1] if i else None), [0] * 8) for c, at in ((1, [5, 6, 7, 9]), (2, [5, 6, 8, 9])) for i, s in enumerate(at)]
    open_ = spark.createDataFrame(rows, "shingle long, class long, n int, pos int, label long, before long, odd array<long>")
    assert [tuple(r) for r in jaccard_join.meetings(open_, 50).collect()] == [(2, 1), (2, 1)]


@pytest.mark.parametrize("size", [3, 200, 1500, 6000])
def test_filters_never_exceed_the_difference(size):
    rng = np.random.default_rng(size)
    for gone in (0, 1, size // 20, size):
        a = rng.integers(0, 2**64, size, np.uint64)
        b = np.r_[a[gone:], rng.integers(0, 2**64, gone, np.uint64)]
        apart = len(np.setxor1d(a, b))
        assert sum(int(x).bit_count() for x in (jaccard_join.parity(a) ^ jaccard_join.parity(b)).view(np.uint64)) <= apart
        assert np.abs(jaccard_join._parts(a, jaccard_join.PARTS) - jaccard_join._parts(b, jaccard_join.PARTS)).sum() <= apart


def test_large_sets_around_the_threshold(spark):
    """Sets on both sides of the size from which parts are compared."""
    rng = random.Random(3)
    texts = []
    for k, size in enumerate((1000, 1024, 1100, 3000)):
        base = [f"u{k}-{i}" for i in range(size)]
        texts += [changed(rng, base[: size - cut], n) for cut in (0, size // 12) for n in (0, size // 60, size // 55, size // 40)]
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.classes(frame(spark, texts)).collect()}
    assert out == brute_components([(i, " ".join(ws)) for i, ws in enumerate(texts)])
    assert len({c for _, c in out.values()}) > 4
