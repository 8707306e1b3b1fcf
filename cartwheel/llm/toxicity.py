"""Toxicity scores from a factorization machine over hashed terms.

A document is the set of its hashed terms. Besides a weight, every term has a short
factor vector; the product of two terms' vectors is the weight of their pair, so that an
insult next to a group mention can weigh more than the two apart, which a linear model
cannot express. Fitted in numpy on the driver from a bounded sample of labelled rows
(at most SAMPLE_ROWS, those with the smallest row hash, and SAMPLE_TERMS terms in all);
scores read whole texts.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import Memo, Shared, bound_batches, map_batches, remainder

DIM, FACTORS = 1 << 16, 4
SAMPLE_ROWS, SAMPLE_TERMS = 20_000, 8_000_000
MIN_EVIDENCE = 10.0  # likelihood-ratio statistic (G squared) a term needs to get weights
# pairs of the PAIR_TERMS terms in most documents are tried too; a pair needs more, as there are many
PAIR_TERMS, PAIR_EVIDENCE = 1024, 36.0
EPOCHS, MIN_STEPS, BATCH, RATE = 12, 1500, 256, 0.1
EDGE = re.compile(r"^\W+|\W+$")


def term(word: str) -> int:
    w = EDGE.sub("", word.lower())
    return xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) >> 48 if w else -1


def terms_of(text: str | None, memo: Memo) -> np.ndarray:
    ws = text.split() if text else []
    ids = np.unique(np.fromiter(map(memo.__getitem__, ws), np.int64, len(ws)))
    return ids[1:] if len(ids) and ids[0] < 0 else ids


def g_squared(both: list[np.ndarray], n: list[float]) -> np.ndarray:
    """Likelihood-ratio statistic of a presence against the label: ``both[k]`` counts the
    rows of label k that have it, n[k] all rows of label k."""
    total, held = sum(n), both[0] + both[1]
    out = np.zeros(held.shape)
    for k in (0, 1):
        for seen, expected in ((both[k], held * n[k] / max(total, 1)), (n[k] - both[k], (total - held) * n[k] / max(total, 1))):
            ok = (seen > 0) & (expected > 0)
            out[ok] += 2 * seen[ok] * np.log(seen[ok] / expected[ok])
    return out


def evidence(docs: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Which terms get weights: those whose presence tells something about the label, alone
    or together with another term (two words may tell much as a pair and nothing apart).
    Without this screen thousands of terms would add up to noise."""
    sides = [[d for d, k in zip(docs, y) if (k > 0) == side] for side in (False, True)]
    n = [float(len(s)) for s in sides]
    both = [np.bincount(np.concatenate([*s, np.zeros(0, np.int64)]), minlength=DIM).astype(float) for s in sides]
    good = g_squared(both, n) >= MIN_EVIDENCE
    often = np.argsort(-(both[0] + both[1]), kind="stable")[:PAIR_TERMS]
    often = often[(both[0] + both[1])[often] >= 2]
    place = np.full(DIM, -1)
    place[often] = np.arange(len(often))
    pairs = []
    for s in sides:
        held = np.zeros((len(often), len(often)))
        for lo in range(0, len(s), 2048):
            x = np.zeros((len(s[lo : lo + 2048]), len(often)), np.float32)
            for i, d in enumerate(s[lo : lo + 2048]):
                at = place[d]
                x[i, at[at >= 0]] = 1
            held += x.T @ x
        pairs.append(held)
    told = g_squared(pairs, n)
    np.fill_diagonal(told, 0)
    # a pair counts for what it tells beyond each of its terms
    alone = g_squared([b[often] for b in both], n)
    beyond = told - np.maximum(alone[:, None], alone[None, :]) >= PAIR_EVIDENCE
    good[often[beyond.any(1)]] = True
    return good


class Model:
    """bias + sum of w_i + sum over pairs of <v_i, v_j>, through a sigmoid."""

    def __init__(self, seed: int = 7):
        self.bias = 0.0
        self.w = np.zeros(DIM, np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.01, (DIM, FACTORS)).astype(np.float32)

    def margins(self, ids: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        v = self.v[ids]
        total = np.stack([np.bincount(owner, v[:, f], rows) for f in range(FACTORS)], axis=1)
        own = np.bincount(owner, (v * v).sum(axis=1), rows)
        linear = np.bincount(owner, self.w[ids], rows)
        return self.bias + linear + 0.5 * ((total * total).sum(axis=1) - own), total

    def fit(self, docs: list[np.ndarray], y: np.ndarray, seed: int = 7, l1: float = 1e-5, l2: float = 1e-4) -> "Model":
        """AdaGrad on the log loss with a soft threshold on the weights."""
        rng = np.random.default_rng(seed)
        seen = evidence(docs, y)
        self.w[~seen] = 0
        self.v[~seen] = 0
        docs = [d[seen[d]] for d in docs]
        rate = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        self.bias = float(np.log(rate / (1 - rate)))
        gw, gv, gb = np.full(DIM, 1e-4, np.float32), np.full((DIM, FACTORS), 1e-4, np.float32), 1e-4
        for _ in range(max(EPOCHS, MIN_STEPS * BATCH // max(1, len(docs)))):
            order = rng.permutation(len(docs))
            for lo in range(0, len(order), BATCH):
                pick = order[lo : lo + BATCH]
                sizes = [len(docs[i]) for i in pick]
                owner = np.repeat(np.arange(len(pick)), sizes)
                ids = np.concatenate([docs[i] for i in pick])
                m, total = self.margins(ids, owner, len(pick))
                err = (1 / (1 + np.exp(-np.clip(m, -30, 30))) - y[pick]).astype(np.float32) / len(pick)
                used, where = np.unique(ids, return_inverse=True)
                e = err[owner]
                dw = np.bincount(where, e, len(used)).astype(np.float32)
                pull = e[:, None] * (total[owner] - self.v[ids])
                dv = np.stack([np.bincount(where, pull[:, f], len(used)) for f in range(FACTORS)], axis=1) + l2 * self.v[used]
                gw[used] += dw * dw
                gv[used] += (dv * dv).astype(np.float32)
                step = RATE / np.sqrt(gw[used])
                w = self.w[used] - step * dw
                self.w[used] = np.sign(w) * np.maximum(0, np.abs(w) - step * l1)
                self.v[used] -= (RATE / 4 / np.sqrt(gv[used]) * dv).astype(np.float32)
                db = float(err.sum())
                gb += db * db
                self.bias -= RATE * db / np.sqrt(gb)
        return self


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on labelled documents whose crc32(id) mod 5 is not 0. Null labels and ids are
    left out; without any labelled row every score is one half or so."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (remainder(id_col, 5) != 0))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_y"))
    known = known.withColumn("_h", F.xxhash64("_id"))
    n = known.count()
    if n > SAMPLE_ROWS:  # the rows with the smallest hashes: their bound is a quantile
        last = known.select("_h").orderBy("_h").limit(SAMPLE_ROWS).agg(F.max("_h")).first()[0]
        known = known.filter(F.col("_h") <= last)
    known = F.broadcast(known)  # at most SAMPLE_ROWS rows
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(known, "_id").select("_h", "_y", "_t")

    def run(batches):
        memo = Memo(term)
        for b in batches:
            yield {"h": b.column(0), "y": b.column(1), "ids": [terms_of(t, memo).tolist() for t in b.column(2).to_pylist()]}
            memo.trim()

    # rows in order of hash until their terms reach the bound, in whatever order they come
    heap, held, bound = [], 0, None  # the largest key first; rows from bound on are out
    for at, r in enumerate(map_batches(rows, run, "h long, y int, ids array<int>").toLocalIterator()):
        key = (-r["h"], -r["y"], -len(r["ids"]))
        if bound is None or key > bound:
            heapq.heappush(heap, (key, at, np.array(r["ids"], np.int64)))
            held += len(r["ids"])
            while len(heap) > 1 and (held > SAMPLE_TERMS or heap[0][0] == bound):
                bound, _, ids = heapq.heappop(heap)
                held -= len(ids)
    found = [(-key[0], -key[1], ids) for key, _, ids in heap]
    found.sort(key=lambda x: (x[0], x[1], len(x[2])))
    return Model().fit([x[2] for x in found], np.array([x[1] for x in found], np.float32)) if found else Model()


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``toxicity`` (0 to 1). Null and empty texts get the score of
    a text without terms. Whole texts are read; no other column is."""
    bound_batches(docs.sparkSession)
    shared = Shared(docs.sparkSession, model)

    def run(batches):
        own, memo = shared.get(), Memo(term)
        for texts in batches:
            out = np.zeros(len(texts))
            group, at, held = [], 0, 0
            for i, t in enumerate(texts):
                ids = terms_of(t, memo)
                group.append(ids)
                held += len(ids)
                if held > 500_000 or i == len(texts) - 1:
                    owner = np.repeat(np.arange(len(group)), [len(g) for g in group])
                    m, _ = own.margins(np.concatenate(group), owner, len(group))
                    out[at : at + len(group)] = 1 / (1 + np.exp(-np.clip(m, -30, 30)))
                    group, at, held = [], i + 1, 0
            memo.trim()
            yield pd.Series(out)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn("toxicity", F.pandas_udf(run, "double")(F.col(text_col)))
