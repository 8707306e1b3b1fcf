"""Periodic runs, SimHash classes and vector codes against plain-Python versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from cartwheel.llm import codes, graph, queries, runs, simhash
from cartwheel.llm.common import table
from conftest import SF_SMALL

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i % 977} und" for i in range(40_000))
SCHEMA = "doc_id long, text string, lang string, source string, fp long, rid long, rows int, component int, n_words int, runs int, open string, _k int"
ROWS = [(1, "a b a b a b a b a b"), (1, "a b a b a b a b a b"), (2, ""), (3, None), (None, "x x x x x x x"), (None, None), (4, " \t\n\x0b\x0c\r "), (5, LONG), (6, "eins"), (7, "A b a B"), (1, "other text, same id")]


@pytest.fixture(scope="module")
def nasty(spark):
    return spark.createDataFrame([(*r, "l", "s", 1, 2, 3, 4, 5, 6, "o", 7) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# 11 -----------------------------------------------------------------------------------


def brute_runs(x, min_length=6, min_exponent=4):
    """(start, length, period), by start and period: every maximal stretch of every period."""
    out = {}
    for q in range(1, len(x) // min_exponent + 1):
        i = 0
        while i < len(x) - q:
            if x[i] != x[i + q]:
                i += 1
                continue
            s = i
            while i < len(x) - q and x[i] == x[i + q]:
                i += 1
            if i - s + q >= max(min_length, min_exponent * q):
                out.setdefault((s, i - s + q), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def random_words(rng):
    n, k = rng.randrange(0, 120), rng.choice([1, 2, 3, 8])
    x = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randrange(3) if n else 0):
        a = rng.randrange(n)
        p, e = 1 + rng.randrange(max(1, (n - a) // 3)), rng.randrange(a, n + 1)
        for i in range(a, e):
            x[i] = x[a + (i - a) % p]
    return x


@pytest.mark.parametrize("tile", [4, 16, runs.TILE])
def test_fragments_of_all_tiles_hold_every_run(monkeypatch, tile):
    monkeypatch.setattr(runs, "TILE", tile)
    rng = random.Random(tile)
    for _ in range(400):
        x = random_words(rng)
        for length, exponent in ((6, 4), (9, 3)):
            by = {}
            for f in runs.fragments(np.array(x, np.int64), length, exponent):
                by.setdefault(f["period"], []).append((f["s"], f["e"]))
            got = []
            for q, parts in by.items():
                parts.sort()
                merged = [list(parts[0])]
                for s, e in parts[1:]:
                    if s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                got += [(s, e - s + q, q) for s, e in merged if e - s + q >= max(length, exponent * q)]
            assert sorted(got) == brute_runs(x, length, exponent)


@pytest.mark.parametrize("tile", [8, runs.TILE])  # 8: most runs cross tiles and are stitched
def test_scan_equals_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(runs, "TILE", tile)
    rng = random.Random(5)
    texts = [" ".join(f"w{v}" for v in random_words(rng)) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    out = {r["doc_id"]: r for r in runs.scan(docs).collect()}
    for i, t in enumerate(texts):
        words = t.split()
        want = brute_runs(words)
        assert [(r["start"], r["length"], r["period"]) for r in out[i]["runs"]] == want
        gone = {k for s, n, q in want for k in range(s + q, s + n)}
        assert out[i]["collapsed"] == " ".join(w for k, w in enumerate(words) if k not in gone)


def test_op11_equals_brute_force(spark):
    out = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, SF_SMALL).collect()}
    docs = table(spark, SF_SMALL, "documents").collect()
    assert len(out) == len(docs)
    for d in docs:
        words = WORDS.findall(d["text"] or "")
        n, h = len(words), zlib.crc32(str(d["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 3000:
            continue  # the plain version is quadratic
        want, r = brute_runs(words), out[d["doc_id"]]
        best = min(want, key=lambda x: (-x[1] / x[2], x[0], x[2])) if want else (None, None, None)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(want), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if want else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{x},{q}\n" for s, x, q in want).encode()).hexdigest()
        gone = {k for s, x, q in want for k in range(s + q, s + x)}
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest()


def test_runs_on_odd_rows(nasty, empty):
    out = [r.asDict(recursive=True) for r in runs.scan(nasty).collect()]
    assert len(out) == len(ROWS)
    one = [r for r in out if r["runs"] and r["doc_id"] == 1]
    assert len(one) == 2 and all(r["runs"] == [{"start": 0, "length": 10, "period": 2}] and r["collapsed"] == "a b" for r in one)
    assert [(r["n_words"], r["collapsed"]) for r in out if r["doc_id"] is None and r["runs"]] == [(7, "x")]
    assert all(r["n_words"] == 0 and r["collapsed"] == "" for r in out if r["doc_id"] in (2, 3, 4))
    long = next(r for r in out if r["doc_id"] == 5)
    assert long["runs"] == [{"start": 0, "length": 80_000, "period": 1954}] and long["collapsed"].split() == LONG.split()[:1954]
    assert runs.scan(empty).count() == 0 and runs.digest(runs.scan(empty, digest=True)).count() == 0


def test_runs_of_one_word_are_found_in_linear_time():
    assert runs.fragments(np.zeros(50_000, np.int64), 6, 4)[0] == {"period": 1, "s": 0, "e": runs.TILE + 1}


# 12 -----------------------------------------------------------------------------------


def brute_fingerprint(text, n=3):
    w = WORDS.findall((text or "").translate(LOWER))
    grams = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(fps, distance=2):
    """Smallest index reachable by links, per index."""
    up = list(range(len(fps)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    a = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a[:i] ^ a[i]) <= distance):
            x, y = top(i), top(int(j))
            up[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(fps))]


def test_op12_equals_brute_force(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in table(spark, SF_SMALL, "documents").collect())
    out = {r["doc_id"]: r for r in queries.op12_simhash(spark, SF_SMALL).collect()}
    fps = [brute_fingerprint(t) for _, t in docs]
    for (i, _), fp, c in zip(docs, fps, brute_classes(fps)):
        assert (out[i]["fingerprint"], out[i]["component_id"]) == (f"{fp:016x}", docs[c][0])


@pytest.mark.parametrize("limit", [simhash.LIMIT, 4])  # 4: all but the loneliest count as crowded
def test_links_of_crowds_and_loners(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "LIMIT", limit)
    rng = random.Random(3)
    seen = {rng.getrandbits(64) for _ in range(800)}
    for centre in [rng.getrandbits(64) for _ in range(3)]:
        for _ in range(700):
            fp = centre
            for _ in range(rng.randrange(0, 5)):
                fp ^= 1 << rng.randrange(64)
            seen.add(fp)
    x = np.array(sorted(seen), np.uint64)
    fps = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long").repartition(5)
    label = {r["node"]: r["label"] for r in graph.components(simhash.links(fps, len(x))).collect()}
    want = brute_classes(x.tolist())
    groups = {}
    for i, v in enumerate(x.view(np.int64).tolist()):
        groups.setdefault(label.get(v, v), set()).add(want[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_thresholds_are_the_cheapest_that_cover():
    rng = np.random.default_rng(1)
    costs = np.concatenate([np.zeros((50, 3, 1)), np.cumsum(rng.random((50, 3, 3)), 2)], 2)
    t, cost = simhash.allocate(costs, 0)
    assert (t.sum(1) == 0).all()
    every = [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 0]
    for q in range(50):
        assert cost[q] == pytest.approx(min(sum(costs[q, i, v + 1] for i, v in enumerate(x)) for x in every))


def test_correlated_bits_share_a_partition():
    rng = np.random.default_rng(2)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, [5, 20, 41, 63]] = bits[:, [5]]
    parts = simhash.partition_bits(bits.T @ bits, 4000)
    assert sorted(b for p in parts for b in p) == list(range(64)) and {5, 20, 41, 63} <= set(parts[0])


def test_simhash_on_odd_rows(nasty, empty):
    out = [r.asDict() for r in simhash.classes(nasty).collect()]
    assert len(out) == len(ROWS)
    blank = [r for r in out if r["doc_id"] in (2, 3, 4)]
    assert {(r["fp"], r["component_id"], r["members"]) for r in blank} == {(0, 2, 4)}
    assert [r["component_id"] for r in out if r["doc_id"] == 7] == [1]  # its two n-grams are those of id 1, as often each
    assert [r["component_id"] for r in out if r["doc_id"] is None and r["fp"]] == [None]
    assert simhash.classes(empty).count() == 0


# 13 -----------------------------------------------------------------------------------


def brute_codes(vectors, parts=4, entries=256, rounds=4):
    x = np.floor(np.array(vectors, np.float64) * 1024).astype(object)
    w = x.shape[1] // parts
    books = [[list(v) for v in x[:entries, i * w : (i + 1) * w]] for i in range(parts)]

    def near(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for i, book in enumerate(books):
            own = {}
            for v in x[:, i * w : (i + 1) * w]:
                own.setdefault(near(v, book)[1], []).append(v)
            for k, vs in own.items():
                book[k] = [sum(c) // len(vs) for c in zip(*vs)]
    found = [[near(v[i * w : (i + 1) * w], books[i]) for i in range(parts)] for v in x]
    return ["".join(f"{k:02x}" for _, k in f) for f in found], [sum(d for d, _ in f) for f in found], books


def test_op13_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    vectors = np.concatenate([rng.normal(0, 0.2, (150, 8)), np.repeat(rng.normal(0, 0.2, (1, 8)), 80, 0), rng.integers(-2, 3, (70, 8)) / 4]).astype(np.float32)
    rows = [(i, v.tolist(), int(i % 3) if i % 7 else None) for i, v in enumerate(vectors)]
    found, books = codes.compress(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4), entries=32)
    want, error, brute = brute_codes(vectors, entries=32)
    out = {r["vec_id"]: r for r in found.collect()}
    assert [b.tolist() for b in books] == brute
    sums = {}
    for (i, _, lab), e in zip(rows, error):
        sums[lab] = sums.get(lab, 0) + e
    for i, _, lab in rows:
        assert (out[i]["code"], out[i]["error"], out[i]["label_error"]) == (want[i], error[i], sums[lab])
    assert codes.decode(want[0], books).shape == (8,)


def test_nearest_entry_with_ties_and_far_queries():
    rng = np.random.default_rng(6)
    book = rng.integers(-3, 4, (200, 4))
    s = codes.Slices(book)
    x = np.concatenate([rng.integers(-4, 5, (500, 4)), rng.integers(-(1 << 26), 1 << 26, (50, 4))])
    code, error = s.nearest(x)
    apart = ((x[:, None, :] - book[None]) ** 2).sum(2)
    assert (error == apart.min(1)).all() and (code == apart.argmin(1)).all()


def test_codes_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [0.1, 0.2, 0.3, 0.4, 0.5], "a"), (1, [0.0] * 5, None), (1, [0.0] * 5, None), (2, None, "a"), (3, [0.1, None, 0.3, 0.4, 0.5], "a"), (4, [nan] * 5, "a"),
        (6, [inf] * 5, "a"), (None, [1e30] * 5, "b"), (7, [0.5] * 3, "b"), (8, [], "b"), (9, [-0.0001] * 5, ""),
    ]
    docs = spark.createDataFrame([(*r, 0, "c", 1) for r in rows], "vec_id long, embedding array<double>, label string, error int, code string, _rows int")
    found, books = codes.compress(docs.repartition(3))
    out = [(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in found.collect()]
    assert sorted(str(r[0]) for r in out) == ["1", "1", "5", "7", "8", "9", "None"]
    assert all((c is None) == (i in (7, 8)) for i, c, *_ in out) and all(e == 0 for i, c, e, _ in out if c)
    assert [b.shape for b in books] == [(5, 2)] * 4  # five components are padded to eight
    none, books = codes.compress(docs.limit(0))
    assert none.count() == 0 and books == [] and codes.digest(books) == hashlib.sha256(b"").hexdigest()
