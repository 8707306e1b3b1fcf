"""Jaccard self-join of word n-gram sets with rare-first prefix filtering.

Documents with equal sets collapse to one *class* (a 128-bit digest of the set). Shingles
are ordered rare first: one in four of them, by hash, before the others, and these by a
frequency sketch of 2^24 counters over all documents (any global order gives the same
links; a good one gives few candidates, and a prefix holds a tenth of a set, so counting a
quarter of the shingles is enough and fills the sketch four times later). The sketch tells
shingles apart that are rarer than the mean load of a counter: some 2 at 0.5 GB of text,
some 110 at 30 GB. Two sets within the threshold share a
shingle of their prefixes, so prefixes are joined on their shingles under the length, the
positional and the parity filter, and every remaining pair is verified once on whole sets.

The parity filter compares, of two sets, 512 bits: of how many shingles fall into each of 512
parts of the hash range, odd or even. Every bit that differs takes a shingle that only one set
has, so no pair within the threshold is lost, and pairs short of it by some hundredths are
told apart while sets have up to some 2,000 shingles. Larger ones also compare their counts in
256 parts, once per pair.

Links only matter for the components they form, so the join runs in steps: first every
class meets the most central class (lowest position) of each of its prefix shingles, and, of
crowded shingles, some classes drawn by hash, which ties large groups of near copies together
in linear time; then all prefix pairs whose classes are still in *different* components are joined. A pair left out lies within one
component already, so no component changes. Near copies share stretches of their prefixes;
a pair that also shares the shingle before is left out, since it has been met there.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import Bloom, WordHasher, discard, drop_listed, join_groups, map_batches, mix64, pack, row_key, shared_table
from cartwheel.llm.graph import components

SKETCH, SKETCH_BLOCK = 1 << 24, 1 << 14  # counters of the frequency sketch
SKETCH_TASKS = 64  # tasks that add up the blocks of the sketch
FIRST = 4  # one shingle in so many, by hash, comes first in the order; only those are counted
LAST = np.uint16(256)  # rank of shingles that are not counted
ODD = 512  # bits of the parity filter
DRAWN = 8  # classes drawn of each shingle that more than four times as many hold
LARGE, PARTS = 1024, 256  # sets from this size on are counted in so many parts; counts above 127 stay 127, which keeps them a lower bound


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all runs of k words in a sequence of word hashes."""
    m = max(0, len(hashes) - k + 1)
    h = np.full(m, np.uint64(k))
    for i in range(k):
        h = mix64(h + hashes[i : m + i])
    return h


def _sets(column: pa.Array, hasher: WordHasher, n: int):
    """Per text its sorted distinct n-gram hashes (a shorter sequence counts as one
    shingle, an empty one has none) and their 128-bit digest."""
    for _, words, sizes in hasher.chunks(column):
        runs, at = shingle_hashes(words, n), 0
        for size in sizes.tolist():
            if size >= n:
                s = np.sort(runs[at : at + size - n + 1])
                s = s[np.r_[True, s[1:] != s[:-1]]]
            else:
                s = shingle_hashes(words[at : at + size], size) if size else words[:0]
            at += size
            yield s, (xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)


def _parts(s: np.ndarray, parts: int) -> np.ndarray:
    """How many hashes of a set fall into each of ``parts`` (a power of 2) parts of the range."""
    return np.bincount((s >> np.uint64(65 - parts.bit_length())).astype(np.int64), minlength=parts)


def parity(s: np.ndarray) -> np.ndarray:
    return np.packbits((_parts(s, ODD) & 1).astype(np.uint8)).view(np.int64)


def describe(docs: DataFrame, n: int, id_col: str, text_col: str, extra: dict[str, Column]) -> tuple[DataFrame, np.ndarray]:
    """(one row per document: id, row hash, set size, set digest, what the filters compare;
    the frequency sketch)."""
    types = "".join(f", {k} string" for k in extra)

    passed = list(extra)

    def run(batches):
        hasher, sketch = WordHasher(), np.zeros(SKETCH, np.uint8)
        for b in batches:
            sizes, digests, odd, parts, held, count = [], [], [], [], [], 0
            for s, d in _sets(b.column(2), hasher, n):
                sizes.append(len(s)), digests.append(d), held.append(s)
                odd.append(parity(s) if d else None)
                parts.append(np.minimum(_parts(s, PARTS), 127).astype(np.int8) if len(s) >= LARGE else None)
                count += len(s)
                if count > 1 << 20:
                    _tally(sketch, held)
                    held, count = [], 0
            _tally(sketch, held)
            none = [None] * len(sizes)
            out = {"_id": b.column(0), "row": b.column(1), "n": sizes, "digest": digests, "odd": odd, "parts": parts, "block": none, "data": none}
            yield out | {k: b.column(3 + i) for i, k in enumerate(passed)}
        used = [k for k in range(SKETCH // SKETCH_BLOCK) if sketch[k * SKETCH_BLOCK : (k + 1) * SKETCH_BLOCK].any()]
        none = [None] * len(used)
        out = {"_id": none, "row": none, "n": none, "digest": none, "odd": none, "parts": none, "block": used, "data": [pack(sketch[k * SKETCH_BLOCK : (k + 1) * SKETCH_BLOCK]) for k in used]}
        yield out | {k: none for k in passed}

    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col), _row(id_col, text_col), F.col(text_col), *[c.alias(k) for k, c in extra.items()])
    both = shared_table(map_batches(source, run, f"_id {id_type}, row long, n long, digest binary, odd array<long>, parts array<tinyint>, block int, data binary{types}"), "jaccard-sets")
    return both.filter("block is null").drop("block", "data"), _levels(both.filter("block is not null").select("block", "data"))


def _first(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(40)) % np.uint64(FIRST) == 0


def _tally(sketch: np.ndarray, sets: list[np.ndarray]) -> None:
    """Count the first shingles into a task's own counters, which stay at 255 from there on."""
    at = np.concatenate([*sets, np.zeros(0, np.uint64)])
    at, n = np.unique(at[_first(at)] & np.uint64(SKETCH - 1), return_counts=True)
    at = at.astype(np.int64)
    sketch[at] = np.minimum(sketch[at] + n, 255)


def _levels(tallies: DataFrame) -> np.ndarray:
    """The sketch on the driver: the tasks' counters added up block by block, each as one
    byte on a logarithmic scale (8 steps per doubling), which keeps the order."""

    def run(batches):
        acc: dict[int, np.ndarray] = {}
        for b in batches:
            for key, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(zlib.decompress(raw), np.uint8)
                acc[key] = acc[key] + x if key in acc else x.astype(np.int64)
        yield {"block": list(acc), "data": [pack(np.minimum(8 * np.log2(x + 1), 255).astype(np.uint8)) for x in acc.values()]}

    out = np.zeros(SKETCH, np.uint8)
    for r in map_batches(tallies.repartition(SKETCH_TASKS, "block"), run, "block int, data binary").collect():
        out[r["block"] * SKETCH_BLOCK : (r["block"] + 1) * SKETCH_BLOCK] = np.frombuffer(zlib.decompress(r["data"]), np.uint8)
    return out


def _row(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def prefixes(docs: DataFrame, counts: np.ndarray, n: int, percent: int, text_col: str) -> DataFrame:
    """(shingle, digest, n, pos): the rarest shingles of every set, as many as a partner
    within the threshold cannot all miss; pos from 1 in the rare-first order."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        hasher, seen, freq = WordHasher(), set(), shared.value
        for b in batches:
            out, rows = {k: [] for k in ("shingle", "digest", "n", "pos")}, 0
            for s, d in _sets(b.column(0), hasher, n):
                if d is None or d in seen:  # a copy met earlier in this task
                    continue
                if len(seen) < 50_000:
                    seen.add(d)
                most = len(s) + (-percent * len(s) // 100) + 1
                order = np.where(_first(s), freq[(s & np.uint64(SKETCH - 1)).astype(np.int64)], LAST)
                first = np.lexsort((s, order))[:most]
                out["shingle"].append(s[first].view(np.int64)), out["digest"].extend([d] * most)
                out["n"].append(np.full(most, len(s))), out["pos"].append(np.arange(1, most + 1))
                rows += most
                if rows > 100_000:
                    yield {k: v if k == "digest" else np.concatenate(v) for k, v in out.items()}
                    out, rows = {k: [] for k in out}, 0
            if rows:
                yield {k: v if k == "digest" else np.concatenate(v) for k, v in out.items()}

    return map_batches(docs.select(text_col), run, "shingle long, digest binary, n int, pos int")


def whole_sets(docs: DataFrame, classes: DataFrame, n: int, id_col: str, text_col: str, repeated: bool) -> DataFrame:
    """(digest, items): the whole sets of some classes, read from one row of each (its row
    hash ``row``; a Bloom filter lets few other rows through). ``repeated``: rows may
    agree in id and text, so one class may be read more than once."""
    wanted = Bloom(classes.select("row"), classes.count())
    test = wanted.tester()

    def run(batches):
        hasher = WordHasher()
        for b in batches:
            own = b.column(1).filter(pa.array(test(b.column(0).to_numpy(zero_copy_only=False))))
            digests, items, held = [], [], 0
            for s, d in _sets(own, hasher, n):
                if d is not None:
                    digests.append(d), items.append(s.tobytes())
                    held += len(s)
                    if held > 500_000:
                        yield {"digest": digests, "items": items}
                        digests, items, held = [], [], 0
            yield {"digest": digests, "items": items}

    found = map_batches(docs.select(_row(id_col, text_col), F.col(text_col)), run, "digest binary, items binary")
    return found.groupBy("digest").agg(F.first("items").alias("items")) if repeated else found


def verify(pairs: DataFrame, own: DataFrame, docs: DataFrame, n: int, percent: int, id_col: str, text_col: str, repeated: bool) -> DataFrame:
    """The pairs (a, b) whose whole sets are within the threshold."""
    both = written = shared_table(pairs, "jaccard-pairs")
    met = both.select(F.col("a").alias("class")).union(both.select("b")).distinct().join(own.select("class", "row", "digest"), "class")
    met = shared_table(met, "jaccard-met")
    sets = shared_table(whole_sets(docs, met, n, id_col, text_col, repeated), "jaccard-whole")
    for c in "ab":
        both = both.join(met.select(F.col("class").alias(c), F.col("digest").alias(f"d{c}")), c)

    def run(batches):
        for batch in batches:
            a, b, x, y = (batch.column(k) for k in range(4))
            good = []
            for i in range(len(a)):
                p, q = (np.frombuffer(z[i].as_buffer(), np.uint64) for z in (x, y))
                same = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * same >= percent * (len(p) + len(q) - same):
                    good.append(i)
            yield {"a": a.take(pa.array(good, pa.int64())), "b": b.take(pa.array(good, pa.int64()))}

    one = sets.select(F.col("digest").alias("da"), F.col("items").alias("x"))
    two = sets.select(F.col("digest").alias("db"), F.col("items").alias("y"))
    links = shared_table(map_batches(both.join(one, "da").join(two, "db").select("a", "b", "x", "y"), run, "a long, b long"), "jaccard-links")
    discard(sets, met, written)
    return links


def feasible(p: int, n: str, pos: str, m: str, pos2: str) -> Column:
    """Length and positional filter: the sizes allow the threshold, and so do the shingles
    from the shared one on (a qualifying pair passes at its first shared shingle)."""
    c = lambda name: F.col(name).cast("long")
    need = p * (c(n) + c(m))
    return (
        (100 * F.least(n, m) >= p * F.greatest(n, m))
        & ((c(n) - c(pos) + 1) * (100 + p) >= need)
        & ((c(m) - c(pos2) + 1) * (100 + p) >= need)
    )


def parity_feasible(p: int, odd: str, odd2: str, n: str, n2: str) -> Column:
    """Parity filter: no more bits differ than the threshold lets shingles differ."""
    apart = sum((F.bit_count(F.col(odd)[i].bitwiseXOR(F.col(odd2)[i])) for i in range(ODD // 64)), F.lit(0))
    return _near_enough(p, apart, n, n2)


def _near_enough(p: int, apart: Column, n: str, n2: str) -> Column:
    return apart.cast("long") * (100 + p) <= (F.col(n).cast("long") + F.col(n2)) * (100 - p)


def filtered(pairs: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass the parity filter and, if both are large, whose counts by
    parts differ by no more than the threshold lets sets differ."""
    for c in "ab":
        pairs = pairs.join(own.select(F.col("class").alias(c), *[F.col(k).alias(f"{k}_{c}") for k in ("size", "odd", "parts")]), c)
    apart = F.aggregate(F.zip_with("parts_a", "parts_b", lambda x, y: F.abs(x.cast("int") - y)), F.lit(0), lambda s, x: s + x)
    counted = F.coalesce(_near_enough(percent, apart, "size_a", "size_b"), F.lit(True))
    return pairs.filter(parity_feasible(percent, "odd_a", "odd_b", "size_a", "size_b") & counted).select("a", "b")


def classes(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` (smallest id reachable by
    links, its own included), ``members`` (rows in the component), ``component`` (a number
    naming it within this result, null for empty sets).

    Two rows link when 100 * |A and B| >= percent * |A or B| for their sets of distinct
    word n-grams. Null, empty and blank texts have empty sets and link with nothing. Rows
    with equal sets are linked; repeated rows repeat. A component whose ids are all null
    has a null component_id. An empty table gives an empty result. Other columns are
    ignored. ``extra`` adds string columns computed from the input.
    """
    rows, counts = describe(docs, n, id_col, text_col, extra or {})
    some = rows.filter("digest is not null")
    total = some.count()
    own = some.groupBy("digest").agg(F.count(F.lit(1)).alias("rows"), F.min("_id").alias("low"), F.min("row").alias("row"), *[F.first(k).alias(v) for k, v in (("n", "size"), ("odd", "odd"), ("parts", "parts"))])
    own = shared_table(own.withColumn("class", F.monotonically_increasing_id()), "jaccard-classes")
    repeated = not some.groupBy("row").count().filter("count > 1").isEmpty()
    links = all_links(docs, own, counts, n, percent, id_col, text_col, repeated)
    if links is None:
        comps = own.select("digest", F.col("low").alias("component_id"), F.col("class").alias("component"), F.col("rows").alias("members"), "rows")
    else:
        labels = components(links)
        tied = shared_table(own.drop("row", "size", "odd", "parts").join(labels.withColumnRenamed("node", "class"), "class", "left"), "jaccard-labels")
        linked = tied.filter("label is not null")
        sums = linked.groupBy("label").agg(F.min("low").alias("component_id"), F.sum("rows").alias("members"), F.count(F.lit(1)).alias("sets"))
        linked = join_groups(linked.select("digest", "label", "rows"), shared_table(sums, "jaccard-sums"), ["label"], "sets", total)
        alone = tied.filter("label is null").select("digest", F.col("low").alias("component_id"), F.col("class").alias("component"), F.col("rows").alias("members"), "rows")
        comps = alone.unionByName(linked.select("digest", "component_id", F.col("label").alias("component"), "members", "rows"))
    comps = shared_table(comps, "jaccard-components")
    names = [F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "members", "component", *(extra or {})]
    out = join_groups(some, comps, ["digest"], "rows", total).select(*names)
    empty = rows.filter("digest is null").withColumns({"component_id": F.col("_id"), "members": F.lit(1).cast("long"), "component": F.lit(None).cast("long")})
    return out.unionByName(empty.select(*names))


def drawn(open_: DataFrame, percent: int) -> DataFrame | None:
    """Pairs (a, b) of different labels, one of them drawn from those that hold a crowded
    shingle, that pass the filters; None if no shingle is crowded."""
    crowded = open_.groupBy("shingle").count().filter(F.col("count") > 4 * DRAWN).select("shingle")
    crowded = shared_table(open_.join(crowded, "shingle", "left_semi").select("shingle", "class", "n", "pos", "label", "odd"), "jaccard-crowded")
    if crowded.isEmpty():
        return None
    lot = F.xxhash64("shingle", "class")
    some = crowded.groupBy("shingle", F.pmod(lot, F.lit(DRAWN)).alias("lot")).agg(F.min(F.struct(lot.alias("lot"), "class", "n", "pos", "label", "odd")).alias("c"))
    some = some.select(F.col("shingle").alias("shingle2"), *[F.col(f"c.{c}").alias(f"{c}2") for c in ("class", "n", "pos", "label", "odd")])
    on = (F.col("shingle") == F.col("shingle2")) & (F.col("label") != F.col("label2"))
    on = on & feasible(percent, "n", "pos", "n2", "pos2") & parity_feasible(percent, "odd", "odd2", "n", "n2")
    return crowded.join(some, on).select(F.least("class", "class2").alias("a"), F.greatest("class", "class2").alias("b"))


def tied(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Links with the components of ``labels`` and ``links`` together: each class with its
    label, and one for all links between the same two labels."""
    for c in "ab":
        links = links.join(labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}")), c, "left")
    ends = [F.coalesce(f"label_{c}", c) for c in "ab"]
    links = links.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()
    return shared_table(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(links), "jaccard-ties")


def meetings(open_: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different labels that share a shingle and pass the filters. A pair
    whose shingles before (of all in ``open_``) are equal too has been met at that one,
    where every filter is as wide or wider."""
    # the smaller side (ties: by number) needs its shorter, index prefix only
    index = open_.filter(F.col("pos") * (100 + percent) <= F.col("n") * (100 - percent) + (100 + percent))
    index = index.select(*[F.col(c).alias(f"{c}2") for c in open_.columns])
    ahead = (F.col("n2") < F.col("n")) | ((F.col("n2") == F.col("n")) & (F.col("class2") < F.col("class")))
    first = F.coalesce(F.col("before") != F.col("before2"), F.lit(True))
    on = (F.col("shingle") == F.col("shingle2")) & ahead & (F.col("label") != F.col("label2")) & first
    on = on & feasible(percent, "n", "pos", "n2", "pos2") & parity_feasible(percent, "odd", "odd2", "n", "n2")
    return open_.join(index, on).select(F.col("class").alias("a"), F.col("class2").alias("b"))


def all_links(docs: DataFrame, own: DataFrame, counts: np.ndarray, n: int, percent: int, id_col: str, text_col: str, repeated: bool) -> DataFrame | None:
    """Links (a, b) between class numbers whose components are those of all links."""
    every = shared_table(prefixes(docs, counts, n, percent, text_col), "jaccard-prefixes")
    # shingles in the prefixes of two or more classes; others cannot make a pair
    code = F.xxhash64("digest")
    common = every.groupBy("shingle").agg(F.min(code).alias("x"), F.max(code).alias("y")).filter("x != y").select("shingle")
    common = shared_table(common, "jaccard-shingles")
    n_common = common.count()
    if not n_common:
        return None
    near = every.filter(Bloom(common, n_common).maybe(F.col("shingle")))
    near = shared_table(near.join(own.select("digest", "class"), "digest").select("shingle", "class", "n", "pos").distinct(), "jaccard-near")
    discard(every, common)
    whole = (own, docs, n, percent, id_col, text_col, repeated)

    # the most central class of each shingle, and the classes that meet it
    centre = near.groupBy("shingle").agg(F.min(F.struct("pos", "n", "class")).alias("c"))
    centre = centre.select("shingle", F.col("c.pos").alias("pos2"), F.col("c.n").alias("n2"), F.col("c.class").alias("centre"))
    met = near.join(centre, "shingle").filter((F.col("class") != F.col("centre")) & feasible(percent, "n", "pos", "n2", "pos2"))
    met = met.select(F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b")).distinct()
    first = verify(filtered(met, own, percent), *whole)
    labels = components(first)

    # all pairs that share a prefix shingle and are not in one component yet
    placed = near.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))
    placed = shared_table(placed, "jaccard-placed")
    split = placed.groupBy("shingle").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x != y").select("shingle")
    before = F.lag("shingle").over(Window.partitionBy("class").orderBy("pos"))
    open_ = placed.join(split, "shingle", "left_semi").withColumn("before", before).join(own.select("class", "odd"), "class")
    open_ = shared_table(open_.select("shingle", "class", "n", "pos", "label", "before", "odd"), "jaccard-open")
    more = drawn(open_, percent)
    if more is not None:
        labels = components(tied(labels, verify(filtered(more.distinct(), own, percent), *whole)))
        now = labels.select(F.col("node").alias("class"), F.col("label").alias("now"))
        found = open_.join(now, "class", "left").withColumn("label", F.coalesce("now", "class"))
    else:
        found = open_
    second = verify(filtered(meetings(found.select(open_.columns), percent).distinct(), own, percent), *whole)
    discard(near, placed, open_)
    return tied(labels, second)


def drop_linked(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component (the smallest id, nulls last), all columns."""
    found = classes(docs, n, percent, id_col, text_col, extra={"_key": row_key(id_col, text_col)}).filter("members > 1")
    found = shared_table(found.select("component", "_key", F.struct(F.col(id_col).isNull().alias("x"), F.col(id_col).alias("y"), F.col("_key").alias("z")).alias("rank")), "jaccard-members")
    first = found.groupBy("component").agg(F.min("rank").alias("r")).select(F.col("r.z").alias("_key"), F.lit(True).alias("_stays"))
    rows = found.groupBy("_key").agg(F.count(F.lit(1)).alias("rows"))
    listed = rows.join(first, "_key", "left").withColumn("_stays", F.coalesce("_stays", F.lit(False))).filter("not _stays or rows > 1")
    return drop_listed(docs, listed.select("_key", "_stays"), id_col, text_col)
