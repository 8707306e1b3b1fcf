"""Scoring texts with a log-bilinear neural language model.

Units. The UNITS most frequent training tokens and the end of text are units of their own;
all other tokens belong to the unit of their ending (their last two bytes, if that ending
is among the most frequent, else one unit for the rest). The model predicts the next unit;
within an ending unit a token has its smoothed training frequency, one count reserved for
unseen tokens. Both factors are normalised, so a text's score is a proper probability.

Model. A unit's target vector is scored against the sum of the CONTEXT preceding units'
context vectors, each scaled by a vector of its position, plus a bias:
s(w | h) = <q(h), r_w> + b_w. Training is noise-contrastive, with noise from the unit
frequencies and shared by a mini-batch, so its products are matrix products. Every Spark
task trains on all training texts of its partition, starting from common parameters; the
tasks' parameters are averaged, weighted by tokens, and go round again. Scoring normalises
with one matrix product per block of distinct contexts and a log-sum-exp.

Counts. Token counts cover all training texts; a token is known by its 64-bit hash. The TOP
most frequent ones travel to the tasks (a fixed bound); scarcer ones are joined with the
count table.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import Shared, WordHasher, collect_blocks, map_batches, pack, remainder, shared_table, sum_blocks

UNITS, ENDINGS = 1024, 160  # units of single tokens, and of endings
TOP = 1 << 19  # token counts sent to every task, as 64-bit hashes
DIM, CONTEXT = 32, 2
BATCH, NOISE, RATE, ROUNDS = 4096, 128, 0.08, 2
LN10 = math.log(10.0)


class Vocabulary:
    """Units and the counts within them; ``start`` is the unit before a text."""

    def __init__(self, tokens: np.ndarray, endings: list[int]):
        """tokens: hashes of the frequent tokens, by rank; endings: their last two bytes."""
        self.order = np.argsort(tokens)
        self.tokens = tokens[self.order]
        self.open = len(tokens) + 1  # units from here on hold many tokens
        self.other = self.open + len(endings)
        self.size = self.other + 1
        self.start = self.size  # as context only
        self.by_ending = np.full(1 << 16, self.other, np.int64)
        self.by_ending[endings] = self.open + np.arange(len(endings))

    def units(self, hashes: np.ndarray, tails: np.ndarray) -> np.ndarray:
        """0 is the end of text, then the frequent tokens, then the endings."""
        out = self.by_ending[tails]
        if len(self.tokens):
            spot = np.minimum(np.searchsorted(self.tokens, hashes), len(self.tokens) - 1)
            found = self.tokens[spot] == hashes
            out[found] = self.order[spot[found]] + 1
        return out


class Params:
    """Target vectors, context vectors, position scales and biases in one flat array."""

    def __init__(self, flat: np.ndarray, size: int):
        self.flat = flat
        n, at, views = size, 0, []
        for shape in ((n, DIM), (n + 1, DIM), (CONTEXT, DIM), (n,)):
            length = int(np.prod(shape))
            views.append(flat[at : at + length].reshape(shape))
            at += length
        self.r, self.q, self.c, self.b = views

    @staticmethod
    def length(size: int) -> int:
        return (2 * size + 1 + CONTEXT) * DIM + size

    @staticmethod
    def initial(size: int, counts: np.ndarray, seed: int = 11) -> "Params":
        p = Params(np.random.default_rng(seed).normal(0, 0.1, Params.length(size)).astype(np.float32), size)
        p.c[:] = 1.0 / CONTEXT
        p.b[:] = np.log((counts + 1) / (counts + 1).sum())
        return p


class Trainer:
    """Noise-contrastive training of one task's copy, with AdaGrad."""

    def __init__(self, start: np.ndarray, size: int, noise: np.ndarray, rate: float):
        self.p = Params(start.copy(), size)
        self.g = Params(np.full(len(start), 1e-2, np.float32), size)
        self.size, self.rate = size, rate
        self.cum = np.cumsum(noise)
        self.log_noise = np.log(noise).astype(np.float32)
        self.rng = np.random.default_rng(5)

    def fit(self, codes: np.ndarray, weight: np.ndarray) -> None:
        """Distinct (context, unit) rows, most recent word last, with their counts."""
        order = self.rng.permutation(len(codes))
        for lo in range(0, len(order), BATCH):
            pick = order[lo : lo + BATCH]
            self.step(codes[pick], weight[pick].astype(np.float32))

    def step(self, codes: np.ndarray, weight: np.ndarray) -> None:
        p, base = self.p, self.size + 1
        w = codes % base
        h = [(codes // base ** (CONTEXT - i)) % base for i in range(CONTEXT)]
        weight = weight / weight.sum()
        vectors = [p.q[x] for x in h]
        q = sum(v * p.c[i] for i, v in enumerate(vectors))
        noise = np.minimum(np.searchsorted(self.cum, self.rng.random(NOISE)), self.size - 1)
        lk = np.float32(math.log(NOISE))
        true = np.einsum("ij,ij->i", q, p.r[w]) + p.b[w] - self.log_noise[w] - lk
        false = q @ p.r[noise].T + (p.b[noise] - self.log_noise[noise] - lk)
        et = (_sigmoid(true) - 1) * weight  # gradients of the two log losses
        ef = _sigmoid(false) * weight[:, None]
        dq = et[:, None] * p.r[w] + ef @ p.r[noise]
        self.rows(p.r, self.g.r, np.concatenate([w, noise]), np.concatenate([et[:, None] * q, ef.T @ q]))
        self.rows(p.b[:, None], self.g.b[:, None], np.concatenate([w, noise]), np.concatenate([et, ef.sum(axis=0)])[:, None])
        for i, v in enumerate(vectors):
            self.rows(p.q, self.g.q, h[i], dq * p.c[i])
            dc = (dq * v).sum(axis=0)
            self.g.c[i] += dc * dc
            p.c[i] -= self.rate * 0.1 * dc / np.sqrt(self.g.c[i])

    def rows(self, x: np.ndarray, g: np.ndarray, at: np.ndarray, grad: np.ndarray) -> None:
        """Add up the gradients of each row, then one AdaGrad step on the rows met."""
        order = np.argsort(at, kind="stable")
        sorted_ = at[order]
        heads = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
        total = np.add.reduceat(grad[order], heads, axis=0) * np.float32(BATCH**0.5)
        used = sorted_[heads]
        g[used] += total * total
        x[used] -= self.rate * total / np.sqrt(g[used])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def encode(inner: np.ndarray, sizes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes of (context, unit) for every token, units, whether the token is a word) of
    texts given as the units of their words; every text gets an end, unit 0."""
    total = sizes + 1
    ends = np.cumsum(total)
    units = np.zeros(int(total.sum()), np.int64)
    word = np.ones(len(units), bool)
    word[ends - 1] = False
    units[word] = inner
    place = np.arange(len(units)) - np.repeat(ends - total, total)
    code, base = np.zeros(len(units), np.int64), start + 1
    for i in range(CONTEXT, 0, -1):
        prior = np.full(len(units), start, np.int64)
        prior[i:] = units[: len(units) - i]
        prior[place < i] = start
        code = code * base + prior
    return code * base + units, units, word


def count_tokens(texts: DataFrame, text_col: str, most: int = 1_000_000) -> DataFrame:
    """(token as its 64-bit hash, its last two bytes, n) over all texts; the end of text is
    not counted here."""

    def merged(parts):
        h, tail, n = (np.concatenate(x) for x in zip(*parts))
        own, first, where = np.unique(h, return_index=True, return_inverse=True)
        return own, tail[first], np.bincount(where, n, len(own)).astype(np.int64)

    def run(batches):
        hasher, parts, held = WordHasher(), [], 0
        for b in batches:
            for _, h, _, tails in hasher.chunks(b.column(0), tails=True):
                parts.append(merged([(h, tails, np.ones(len(h), np.int64))]))
                held += len(parts[-1][0])
                if held > most:
                    parts = [merged(parts)]
                    held = len(parts[0][0])
                    if held > most // 2:
                        yield dict(zip(("token", "tail", "n"), (parts[0][0].view(np.int64), *parts[0][1:])))
                        parts, held = [], 0
        if parts:
            own = merged(parts)
            yield dict(zip(("token", "tail", "n"), (own[0].view(np.int64), *own[1:])))

    found = map_batches(texts.select(text_col), run, "token long, tail int, n long")
    return found.groupBy("token").agg(F.first("tail").alias("tail"), F.sum("n").alias("n"))


class LanguageModel:
    """The vocabulary, token counts and parameters learnt from a corpus."""

    def __init__(self, texts: DataFrame, text_col: str = "text", rounds: int = ROUNDS):
        self.spark = texts.sparkSession
        self.counts = shared_table(count_tokens(texts, text_col), "lm-counts")
        row = self.counts.agg(F.count(F.lit(1)), F.sum("n")).first()
        self.n_texts = texts.count()
        self.distinct = int(row[0]) + (self.n_texts > 0)  # the end of text is a token
        self.total = int(row[1] or 0) + self.n_texts
        # the least count such that no more than TOP tokens have it
        room, floor = TOP, None
        for r in self.counts.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
            room -= r["count"]
            if room < 0:
                break
            floor = r["n"]
        self.whole = room >= 0  # all tokens fit
        top = self.counts.filter(F.col("n") >= (floor if floor is not None else self.total + 1)).toArrow()
        h, n, tails = (top.column(k).to_numpy() for k in ("token", "n", "tail"))
        rank = np.lexsort((h, -n))
        h, n, tails = h[rank].view(np.uint64), n[rank], tails[rank]
        frequent = list(zip(n[:UNITS].tolist(), tails[:UNITS].tolist()))
        own: dict[int, list[int]] = {}  # ending -> tokens in all, distinct tokens; at most 65,536 endings
        for r in self.counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).toLocalIterator():
            own[r["tail"]] = [r["n"], r["v"]]
        for c, tail in frequent:  # frequent tokens are units of their own
            own[tail][0] -= c
            own[tail][1] -= 1
        ranked = sorted(((e, c, k) for e, (c, k) in own.items() if k), key=lambda x: (-x[1], x[0]))
        self.vocab = v = Vocabulary(h[:UNITS], [e for e, _, _ in ranked[:ENDINGS]])
        unit_n = np.zeros(v.size, np.float64)
        unit_v = np.zeros(v.size, np.float64)
        unit_n[0] = self.n_texts
        unit_n[1 : v.open] = n[:UNITS]
        for e, c, k in ranked:
            unit_n[v.by_ending[e]] += c
            unit_v[v.by_ending[e]] += k
        self.unit_n = unit_n
        self.inside = np.zeros(v.size)  # log of the divisor within an open unit
        self.inside[v.open :] = np.log(unit_n[v.open :] + unit_v[v.open :] + 1)
        order = np.argsort(h)
        self.top = (h[order], n[order])
        self.flat = Params.initial(v.size, unit_n).flat
        if self.n_texts:
            for k in range(rounds):
                self.flat = self.train(texts, text_col, RATE / (1 + k))

    def train(self, texts: DataFrame, text_col: str, rate: float) -> np.ndarray:
        """One round: every task trains a copy on its texts, the copies are averaged."""
        noise = (self.unit_n + 1) / (self.unit_n + 1).sum()
        shared = Shared(self.spark, (self.flat, self.vocab, noise))
        step = 1 << 14

        def run(batches):
            start, vocab, noise = shared.get()
            trainer, seen, hasher = Trainer(start, vocab.size, noise, rate), 0, WordHasher()
            for b in batches:
                for _, h, sizes, tails in hasher.chunks(b.column(0), 4 << 20, tails=True):
                    codes, weight = np.unique(encode(vocab.units(h, tails), sizes, vocab.start)[0], return_counts=True)
                    trainer.fit(codes, weight)
                    seen += int(weight.sum())
            if seen:
                flat = np.concatenate([trainer.p.flat.astype(np.float64) * seen, [float(seen)]])
                yield {"block": list(range(-(-len(flat) // step))), "data": [pack(flat[i : i + step]) for i in range(0, len(flat), step)]}

        total = sum_blocks(map_batches(texts.select(text_col), run, "block int, data binary"), "float64")
        summed = collect_blocks(total, "float64", len(self.flat) + 1, step)
        return (summed[:-1] / summed[-1]).astype(np.float32)

    def score(self, docs: DataFrame, text_col: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
        """One row per input row: ``rid``, the ``extra`` columns, ``n_tokens``, ``n_known``,
        ``base_score``, ``score`` (log10), the last two summed over words and the end.

        Null and empty texts are just an end. Whole texts are read. Repeated rows repeat.
        """
        extra = extra or {}
        passed, whole = list(extra), self.whole
        shared = Shared(self.spark, (self.flat, self.vocab, self.inside, self.top, self.normalisers()))
        end_count = math.log(self.n_texts + 1)

        def run(batches):
            flat, vocab, inside, (top, top_n), log_z = shared.get()
            p, base = Params(flat, vocab.size), vocab.size + 1
            hasher = WordHasher()
            for b in batches:
                for at, h, sizes, tails in hasher.chunks(b.column(1), tails=True):
                    rows = len(sizes)
                    code, units, word = encode(vocab.units(h, tails), sizes, vocab.start)
                    count = np.zeros(len(h), np.int64) if whole else np.full(len(h), -1, np.int64)  # -1: look it up later
                    if len(top):
                        spot = np.minimum(np.searchsorted(top, h), len(top) - 1)
                        known = top[spot] == h
                        count[known] = top_n[spot[known]]
                    log_count = np.full(len(units), end_count)
                    log_count[word] = np.log(np.maximum(count, 0) + 1)
                    owner = np.repeat(np.arange(rows), sizes + 1)
                    context = code // base
                    q = sum(p.q[(context // base ** (CONTEXT - 1 - i)) % base] * p.c[i] for i in range(CONTEXT))
                    logp = (np.einsum("ij,ij->i", q, p.r[units]) + p.b[units]).astype(np.float64) - log_z[context]
                    logp += np.where(units >= vocab.open, log_count - inside[units], 0.0)
                    seen = np.bincount(owner[word], count > 0, rows) + (end_count > 0)
                    lost = np.flatnonzero(count < 0)
                    cut = np.searchsorted(owner[word][lost], np.arange(1, rows))
                    yield {
                        **{k: b.column(2 + i).slice(at, rows) for i, k in enumerate(passed)},
                        "rid": b.column(0).slice(at, rows), "n_tokens": sizes + 1, "n_known": seen.astype(np.int64),
                        "log_counts": np.bincount(owner, log_count, rows), "logp": np.bincount(owner, logp, rows),
                        "missed": [x.view(np.int64) for x in np.split(h[lost], cut)],
                    }

        types = "".join(f", {k} {docs.select(c.alias(k)).schema[k].dataType.simpleString()}" for k, c in extra.items())
        source = docs.select(F.monotonically_increasing_id(), F.col(text_col), *[c.alias(k) for k, c in extra.items()])
        schema = f"rid long, n_tokens long, n_known long, log_counts double, logp double, missed array<long>{types}"
        out = shared_table(map_batches(source, run, schema), "lm-scores")
        names = ["rid", *extra, "n_tokens", "n_known"]
        known, more = F.col("n_known"), F.lit(0.0)
        if not whole:  # counts of the scarce tokens; one not in the table counts zero and adds nothing
            lost = out.select("rid", F.explode("missed").alias("token"))
            found = lost.join(self.counts, "token").groupBy("rid").agg(F.count(F.lit(1)).alias("more_known"), F.sum(F.log(F.col("n") + 1.0)).alias("more"))
            out = out.join(found, "rid", "left")
            known, more = known + F.coalesce("more_known", F.lit(0)), F.coalesce("more", F.lit(0.0))
        divisor = math.log(max(1, self.total + self.distinct + 1))
        base = (F.col("log_counts") + more - F.col("n_tokens") * divisor) / LN10
        return out.withColumns({"n_known": known, "base_score": base, "score": (F.col("logp") + more) / LN10}).select(*names, "base_score", "score")

    def normalisers(self) -> np.ndarray:
        """log of the sum over all units, for every context: one matrix product and
        log-sum-exp per block of contexts, spread over tasks. (size + 1) ** CONTEXT
        numbers, fixed by the parameters."""
        base = self.vocab.size + 1
        shared = Shared(self.spark, (self.flat, self.vocab.size))

        def run(batches):
            flat, size = shared.get()
            p = Params(flat, size)
            for b in batches:
                for k in b.column(0).to_pylist():
                    context = np.arange(k * base, (k + 1) * base)
                    q = sum(p.q[(context // base ** (CONTEXT - 1 - i)) % base] * p.c[i] for i in range(CONTEXT))
                    logits = q @ p.r.T + p.b
                    most = logits.max(axis=1)
                    z = most.astype(np.float64) + np.log(np.exp(logits - most[:, None]).sum(axis=1, dtype=np.float64))
                    yield {"block": [k], "data": [pack(z)]}

        n = base ** (CONTEXT - 1)
        return collect_blocks(map_batches(self.spark.range(0, n, 1, min(n, 48)), run, "block int, data binary"), "float64", base**CONTEXT, base)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the documents whose crc32(id) mod 7 is not 2, score all of them.

    Returns id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score``. An empty table gives an empty result; with nothing to learn from, all
    tokens are unseen. Other columns are ignored.
    """
    held = remainder(id_col, 7) == 2
    model = LanguageModel(docs.filter(~held).select(text_col), text_col)
    scored = model.score(docs, text_col, {"_id": F.col(id_col), "held_out": held})
    return scored.select(
        F.col("_id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score"
    )
