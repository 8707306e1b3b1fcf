"""Language identification by hierarchical discrimination.

First the language family is predicted, then one-versus-one linear support vector
machines tell the languages of that family apart; the family level uses the same
machines between families. Features are relative frequencies of hashed character 1- to
3-grams inside words (letters only, lower case, with word boundaries). They add up over
words, so each distinct word's contribution to every machine is computed once per task
and a document is the mean over its words.

The machines are fitted on the driver from a bounded sample: of every language the
PER_LANGUAGE training documents with the smallest row hash (fewer if languages are many),
as hashed counts, never as text. Predictions read whole texts.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from cartwheel.llm.common import Memo, Shared, bound_batches, map_batches, remainder

DIM = 1 << 13
PER_LANGUAGE, SAMPLE = 400, 4000  # training documents per language, and in all
CHUNK = 100_000  # words whose contributions are summed at a time
UNKNOWN = "und"

# Fixed table: ISO 639-1 codes of related languages. A language not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is lb fy",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be bg mk sr hr bs sl cs sk pl",
    "uralic": "fi et hu",
    "baltic": "lt lv",
    "turkic": "tr az kk uz ky tk",
    "indic": "hi ur bn pa mr gu ne si",
    "semitic": "ar he mt am",
    "malayic": "id ms jv su",
}


def family_of(lang: str, families: dict[str, str] = FAMILIES) -> str:
    return next((f for f, members in families.items() if lang in members.split()), f"only-{lang}")


def letters(word: str) -> str:
    return "".join(filter(str.isalpha, word.lower()))


def gram_ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed n-gram ids of all words in a row, number of n-grams per word); words
    without letters have none."""
    clean = [letters(w) for w in words]
    joined = "".join(f"\x02{w}\x03" for w in clean)
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in clean], np.int64)
    owner = np.repeat(np.arange(len(clean)), sizes)
    letter = c > 3
    ids, owners = [], []
    h = np.zeros(len(c), np.uint64)
    for n in (1, 2, 3):
        h = h[: len(c) - n + 1] if n > 1 else h
        h = (h * np.uint64(0x100000001B3) + c[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        same = owner[n - 1 :] == owner[: len(c) - n + 1]
        good = same & (letter if n == 1 else (letter[: len(c) - n + 1] | letter[n - 1 :]))
        ids.append((h[good] >> np.uint64(64 - 13)).astype(np.int64))
        owners.append(owner[: len(c) - n + 1][good])
    ids, owners = np.concatenate(ids), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return ids[order], np.bincount(owners, minlength=len(clean))


def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 150) -> tuple[np.ndarray, float, float, float]:
    """Linear SVM (squared hinge, labels -1/+1, classes weighted alike) by accelerated
    gradient descent; then a sigmoid on its margins. Returns weights, bias, slope, shift."""
    one, two = 0.5 / max(1, int((y > 0).sum())), 0.5 / max(1, int((y < 0).sum()))
    weight = np.where(y > 0, one, two).astype(np.float32)
    lip = 2 * float((weight * (x * x).sum(axis=1) + weight).sum()) + penalty
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    pw, pb, t = w, b, 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ w + b))
        g = -2 * weight * slack * y
        nw, nb = w - (g @ x + penalty * w) / lip, b - float(g.sum()) / lip
        nt = (1 + math.sqrt(1 + 4 * t * t)) / 2
        w, b = nw + (t - 1) / nt * (nw - pw), nb + (t - 1) / nt * (nb - pb)
        pw, pb, t = nw, nb, nt
    margin = (x @ pw + pb).astype(np.float64)
    slope, shift = 2.0, 0.0
    for _ in range(25):  # Newton steps of a two-parameter logistic fit, held near the start
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        r, v = weight * (p - (y > 0)), weight * p * (1 - p)
        grad = np.array([(r * margin).sum() + 1e-3 * (slope - 2), r.sum() + 1e-3 * shift])
        hess = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        slope, shift = slope - float(np.clip(step[0], -1, 1)), shift - float(np.clip(step[1], -1, 1))
    return pw, pb, max(slope, 0.1), shift


class Model:
    """Machines between families, then between the languages of each family."""

    def __init__(self, langs: list[str], x: np.ndarray, y: np.ndarray):
        self.families = sorted({family_of(lang) for lang in langs})
        self.members = {f: [lang for lang in langs if family_of(lang) == f] for f in self.families}
        scale = x.std(axis=0) + 1e-4
        x = x / scale
        fam = np.array([self.families.index(family_of(lang)) for lang in langs], np.int64)[y] if len(y) else y
        weights, rest = [], []
        self.tasks: list[tuple[str, int, int]] = []  # level, first, second

        def add(level, a, b, pos, neg):
            both = pos | neg
            w, bias, slope, shift = fit_svm(x[both], np.where(pos[both], 1, -1).astype(np.float32))
            weights.append((w / scale).astype(np.float32)), rest.append((bias, slope, shift))
            self.tasks.append((level, a, b))

        for a, b in combinations(range(len(self.families)), 2):
            add("", a, b, fam == a, fam == b)
        for f, own in self.members.items():
            for a, b in combinations(range(len(own)), 2):
                add(f, a, b, y == langs.index(own[a]), y == langs.index(own[b]))
        self.w = np.array(weights, np.float32).T if weights else np.zeros((DIM, 0), np.float32)
        self.rest = np.array(rest, np.float64).reshape(-1, 3)

    def choose(self, level: str, names: list[str], prob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the winner, its share) of one level, for every row."""
        n = len(names)
        share = np.zeros((len(prob), n))
        for k, (at, a, b) in enumerate(self.tasks):
            if at == level:
                share[:, a] += prob[:, k]
                share[:, b] += 1 - prob[:, k]
        if n == 1:
            return np.zeros(len(prob), np.int64), np.ones(len(prob))
        best = share.argmax(axis=1)
        return best, share[np.arange(len(prob)), best] / (n - 1)

    def predict(self, means: np.ndarray) -> tuple[list[str], np.ndarray]:
        margin = means + self.rest[:, 0]
        prob = 1 / (1 + np.exp(-np.clip(margin * self.rest[:, 1] + self.rest[:, 2], -30, 30)))
        fam, sure = self.choose("", self.families, prob)
        langs, score = [""] * len(fam), np.zeros(len(fam))
        for i, f in enumerate(self.families):
            at = np.flatnonzero(fam == i)
            if at.size:
                best, own = self.choose(f, self.members[f], prob[at])
                score[at] = sure[at] * own
                for j, k in zip(at, best):
                    langs[j] = self.members[f][k]
        return langs, score


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Fit on documents whose crc32(id) mod 4 is not 2, with a language and a letter.
    None if there are none."""
    rows = docs.filter(F.col(lang_col).isNotNull() & (remainder(id_col, 4) != 2) & F.col(text_col).rlike(r"\p{L}"))
    rows = rows.select(F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).alias("_t"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("_h"))
    langs = sorted(r["_lang"] for r in rows.select("_lang").distinct().toLocalIterator())
    if not langs:
        return None
    most = max(20, min(PER_LANGUAGE, SAMPLE // len(langs)))
    order = W.Window.partitionBy("_lang").orderBy("_h")
    last = rows.select("_lang", "_h").distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= most).groupBy("_lang").agg(F.max("_h").alias("h"))
    limit = {r["_lang"]: r["h"] for r in last.toLocalIterator()}
    bound = F.create_map(*[F.lit(v) for kv in limit.items() for v in kv])

    def run(batches):
        for b in batches:
            found = [gram_ids(t.split()) for t in b.column(1).to_pylist()]
            counted = [np.unique(ids, return_counts=True) for ids, _ in found]
            yield {"lang": b.column(0), "ids": [x[0].tolist() for x in counted], "counts": [x[1].tolist() for x in counted]}

    drawn = rows.filter(F.col("_h") <= bound[F.col("_lang")]).dropDuplicates(["_lang", "_h"])  # a repeated row counts once
    sample = map_batches(drawn.select("_lang", "_t"), run, "lang string, ids array<int>, counts array<int>")
    x, y = [], []
    for r in sample.toLocalIterator():
        v = np.zeros(DIM, np.float32)
        v[r["ids"]] = r["counts"]
        if v.any():
            x.append(v / v.sum())
            y.append(langs.index(r["lang"]))
    order = np.lexsort((*np.array([v[:8] for v in x]).T, y)) if x else []  # a fixed order of rows
    return Model(langs, np.array(x, np.float32)[order], np.array(y, np.int64)[order]) if x else None


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``language``: struct of ``lang`` and ``score`` (0 to 1).

    Null texts and texts without a letter give "und" with score 0, as does any text if
    there was nothing to learn from. Whole texts are read; no other column is.
    """
    bound_batches(docs.sparkSession)
    shared = Shared(docs.sparkSession, model)

    def run(batches):
        own = shared.get()
        width = own.w.shape[1] if own else 0
        fresh: list[str] = []
        memo = Memo(lambda w: (fresh.append(w), len(memo))[1])
        table = np.zeros((0, width + 1), np.float32)
        for texts in batches:
            if own is None:
                yield pd.DataFrame({"lang": [UNKNOWN] * len(texts), "score": 0.0})
                continue
            sums = np.zeros((len(texts), width + 1))
            slots: list[int] = []
            sizes: list[int] = []
            first = 0

            def flush(upto):
                nonlocal table, slots, sizes, first
                if fresh:
                    ids, counts = gram_ids(fresh)
                    rows = np.zeros((len(fresh), width + 1), np.float32)
                    owner = np.repeat(np.arange(len(fresh)), counts)
                    for k in range(width):
                        rows[:, k] = np.bincount(owner, own.w[ids, k], len(fresh))
                    rows[:, width] = counts
                    table = np.concatenate([table, rows])
                    fresh.clear()
                at = np.array(slots, np.int64)
                owner = np.repeat(np.arange(first, upto), sizes)
                for k in range(width + 1):
                    sums[:, k] += np.bincount(owner, table[at, k], len(texts)) if at.size else 0
                slots, sizes, first = [], [], upto
                if len(memo) > 250_000:
                    memo.clear()
                    table = table[:0]

            for i, t in enumerate(texts):
                ws = t.split() if t else []
                slots.extend(map(memo.__getitem__, ws))
                sizes.append(len(ws))
                if len(slots) >= CHUNK:
                    flush(i + 1)
            flush(len(texts))
            grams = sums[:, width]
            langs, score = own.predict(sums[:, :width] / np.maximum(grams, 1)[:, None])
            known = grams > 0
            yield pd.DataFrame({"lang": np.where(known, langs, UNKNOWN), "score": np.where(known, score, 0.0)})

    run.__annotations__ = {}
    from collections.abc import Iterator

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return docs.withColumn("language", F.pandas_udf(run, "lang string, score double")(F.col(text_col)))


def keep_known(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents whose language cannot be told."""
    marked = predict(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text_col).alias("_text")), model, "_text")
    return marked.filter(F.col("language.lang") != UNKNOWN).select("_row.*")
