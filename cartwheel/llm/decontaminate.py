"""Benchmark decontamination with suffix arrays over the training documents.

Each task cuts its documents into shards of a bounded number of words and builds a word
suffix array per shard. Every suffix of every benchmark item is then binary-searched in
it; the range of shard suffixes that share its first words gives all occurrences of its
window, and occurrences that continue each other join into longest verbatim matches.
The benchmark goes round in blocks of bounded size, so neither side need be small.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import Shared, drop_listed, map_batches, row_key

ITEM_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # fixed pattern, after A-Z are lower-cased
WINDOW = 10
SHARD_WORDS = 400_000  # words per suffix array
BLOCK_WORDS = 1_000_000  # benchmark words per broadcast block


def item_words(text: str | None) -> list[bytes]:
    return ITEM_WORDS.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


class ItemBlock:
    """Some benchmark items as numbers: a vocabulary, all words in a row, item bounds."""

    def __init__(self, items: list[tuple[str, list[bytes]]]):
        self.ids = [i for i, _ in items]
        self.vocab: dict[bytes, int] = {}
        seqs = [np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in ws], np.int32) for _, ws in items]
        self.words = np.concatenate([*seqs, np.zeros(0, np.int32)])
        ends = np.cumsum([len(s) for s in seqs], dtype=np.int64)
        self.starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(seqs) else np.zeros(0, np.int64)
        at, owner, length = [], [], []
        for k, s in enumerate(seqs):
            n = min(len(s), WINDOW)
            for i in range(len(s) - n + 1) if n else ():
                at.append(int(self.starts[k]) + i), owner.append(k), length.append(n)
        self.at, self.owner, self.length = (np.array(x, np.int64) for x in (at, owner, length))


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions whose first word is in the vocabulary, ordered by their first ``depth``
    words (prefix doubling). 0 stands for any word that no item has; suffixes that start
    with it match nothing and are left out."""
    n = len(words)
    rank = words.astype(np.int64)
    width = 1
    while width < depth:
        nxt = np.zeros(n, np.int64)
        if width < n:
            nxt[: n - width] = rank[width:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + nxt
        _, rank = np.unique(key, return_inverse=True)
        width *= 2
    live = np.flatnonzero(words > 0)
    return live[np.argsort(rank[live], kind="stable")]


def ranges(sa: np.ndarray, words: np.ndarray, block: ItemBlock) -> tuple[np.ndarray, np.ndarray]:
    """For every window of the block: the suffix-array range that starts with it (all
    windows in one vectorised binary search)."""
    padded = np.concatenate([words, np.full(WINDOW, -1, np.int32)])

    def bound(upper: bool) -> np.ndarray:
        lo, hi = np.zeros(len(block.at), np.int64), np.full(len(block.at), len(sa), np.int64)
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) >> 1
            pos, at, length = sa[mid], block.at[open_], block.length[open_]
            order = np.zeros(len(open_), np.int8)  # of the shard suffix against the window
            for k in range(WINDOW):
                tied = np.flatnonzero((order == 0) & (k < length))
                if not tied.size:
                    break
                order[tied] = np.sign(padded[pos[tied] + k] - block.words[at[tied] + k])
            right = order <= 0 if upper else order < 0
            lo[open_[right]] = mid[right] + 1
            hi[open_[~right]] = mid[~right]
        return lo

    return bound(False), bound(True)


def matches(docs: list[list[bytes]], block: ItemBlock) -> list[list[tuple[int, int, int, int]]]:
    """Per document: (item, start in document, start in item, length) of every longest
    verbatim match that holds a window, in words."""
    sizes = [len(d) + 1 for d in docs]  # one separator after each document
    ends = np.cumsum(sizes)
    words = np.zeros(int(ends[-1]) if docs else 0, np.int32)
    at = 0
    for d, n in zip(docs, sizes):
        words[at : at + n - 1] = np.fromiter((block.vocab.get(w, 0) for w in d), np.int32, n - 1)
        at += n
    sa = suffix_array(words, WINDOW)
    lo, hi = ranges(sa, words, block)
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in docs]
    n = hi - lo
    hit = np.flatnonzero(n)
    if not hit.size:
        return out
    which = np.repeat(hit, n[hit])  # one entry per occurrence
    offset = np.arange(len(which)) - np.repeat(np.cumsum(n[hit]) - n[hit], n[hit])
    pos = sa[lo[which] + offset]
    owner, start, length = block.owner[which], block.at[which] - block.starts[block.owner[which]], block.length[which]
    doc = np.searchsorted(ends, pos, side="right")
    diagonal = pos - start  # occurrences on one diagonal that touch continue each other
    order = np.lexsort((pos, diagonal, owner, doc))
    doc, owner, start, length, pos, diagonal = (x[order] for x in (doc, owner, start, length, pos, diagonal))
    first = np.ones(len(pos), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1]) | (diagonal[1:] != diagonal[:-1]) | (pos[1:] != pos[:-1] + 1)
    heads = np.flatnonzero(first)
    tails = np.append(heads[1:], len(pos)) - 1
    begin = np.concatenate([[0], ends[:-1]])
    for h, t in zip(heads, tails):
        d = int(doc[h])
        out[d].append((int(owner[h]), int(pos[h] - begin[d]), int(start[h]), int(pos[t] + length[t] - pos[h])))
    return out


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int = BLOCK_WORDS):
    """Benchmark items with words, in blocks of about ``most`` words; one item at a time
    reaches the driver."""
    own: list[tuple[str, list[bytes]]] = []
    held = 0
    for r in benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        ws = item_words(r["t"])
        if ws:
            own.append((r["i"], ws))
            held += len(ws)
        if held >= most:
            yield ItemBlock(own)
            own, held = [], 0
    if own:
        yield ItemBlock(own)


def find_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                 key: str = "rid") -> DataFrame:
    """One row per document: ``rid`` (its number in the scan, or its row digest if ``key``
    is "row_key"), id, ``n_words``, ``n_hit`` (words inside any occurrence of a window),
    ``items`` (sorted distinct item ids, as text), ``spans``: array of (item_id, doc_start,
    item_start, length) in words, the longest verbatim matches that hold a window.

    Null text has no words; null item ids are an item called "null". Whole texts are
    searched. Repeated rows repeat. Either table may be empty. Other columns are ignored.
    """
    spark = docs.sparkSession
    number = F.monotonically_increasing_id() if key == "rid" else row_key(id_col, text_col)
    base = docs.select(number.alias("rid"), F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    kind = "bigint" if key == "rid" else "string"
    span = "array<struct<item_id: string, doc_start: int, item_start: int, length: int>>"
    id_type = docs.schema[id_col].dataType.simpleString()

    def searched(block: ItemBlock | None) -> DataFrame:
        shared = Shared(spark, block)

        def run(batches):
            own = shared.get() or ItemBlock([])
            shard: list[tuple] = []
            held = 0

            def result():
                found = matches([x[2] for x in shard], own) if own.ids else [[] for _ in shard]
                spans = [[{"item_id": own.ids[i] if own.ids[i] is not None else "null", "doc_start": a, "item_start": b, "length": c} for i, a, b, c in f] for f in found]
                return {"rid": [x[0] for x in shard], "_id": [x[1] for x in shard], "n_words": [len(x[2]) for x in shard], "spans": spans,
                        "hits": [covered(f) for f in found]}

            for b in batches:
                for rid, i, t in zip(*(b.column(k).to_pylist() for k in range(3))):
                    ws = item_words(t)
                    shard.append((rid, i, ws))
                    held += len(ws)
                    if held >= SHARD_WORDS or len(shard) >= 20_000:
                        yield result()
                        shard, held = [], 0
            if shard:
                yield result()

        return map_batches(base, run, f"rid {kind}, _id {id_type}, n_words bigint, spans {span}, hits array<struct<a: int, b: int>>")

    parts = [searched(b) for b in item_blocks(benchmark, item_col, item_text_col)] or [searched(None)]
    out = parts[0]
    if len(parts) > 1:  # results of the blocks meet per document
        for p in parts[1:]:
            out = out.unionByName(p)
        out = out.groupBy("rid").agg(
            F.first("_id").alias("_id"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits")
        )
    # hits are sorted disjoint intervals per block; count what any of them covers
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    n_hit = F.aggregate(
        "hits", state,
        lambda s, h: F.struct((s["n"] + F.greatest(F.lit(0), h["b"] - F.greatest(h["a"], s["end"]))).cast("long").alias("n"), F.greatest(s["end"], h["b"]).alias("end")),
        lambda s: s["n"],
    )
    items = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item_id"])))
    return out.select("rid", F.col("_id").alias(id_col), "n_words", n_hit.alias("n_hit"), items.alias("items"), "spans")


def covered(found: list[tuple[int, int, int, int]]) -> list[dict]:
    """Document intervals the matches cover, sorted and disjoint."""
    out: list[list[int]] = []
    for a, b in sorted((a, a + n) for _, a, _, n in found):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"a": a, "b": b} for a, b in out]


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; all columns kept."""
    found = find_matches(docs, benchmark, id_col, text_col, key="row_key", **kw)
    bad = found.filter("n_hit > 0").select(F.col("rid").alias("_key"), F.lit(False).alias("_stays")).distinct()
    return drop_listed(docs, bad, id_col, text_col)
