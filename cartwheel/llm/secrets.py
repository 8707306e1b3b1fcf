"""Secret scan: fixed patterns, and sliding-window entropy over candidate strings.

Fixed patterns give the base findings. Beyond them, every long run of key characters is
a candidate. Per character class (hexadecimal digits, base-64 characters) a window slides
over the candidate; character counts and the sum of count*log2(count) are updated by the
one character that enters and the one that leaves, so a window costs constant time.
Windows above the class's threshold merge into findings. The allow-list suppresses
candidates, or path segments of them, known to be harmless; it never suppresses base
findings.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import map_batches

# Fixed patterns (values that must match). Letters of the names in either ASCII case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
NAMES = re.compile(r"password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)
MIN_ASSIGN, MIN_ACCESS = 8, 16
BASE_KINDS = ("assign", "access", "hex")

LONG_HEX = re.compile(r"[0-9a-f]{32,}")  # the same as all runs less those under 32
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
SEGMENT = re.compile(r"[^/]+")
WINDOW = 20
# class -> (its characters, least bits per character in a window, least digits in a window)
CLASSES = {
    "entropy-hex": (frozenset("0123456789abcdefABCDEF"), 2.8, 3),
    "entropy-base64": (frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"), 3.6, 2),
}
ALLOW = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",  # UUID
    r"[A-Za-z/_-]+",  # words, paths, identifiers without a digit
    r"[0-9/_+-]+",  # numbers, dates
    r"(?:[A-Za-z]+[-_/])+[A-Za-z]*[0-9]{0,4}",  # slugs with a trailing number
    r"[^/]*(?:EXAMPLE|example)[^/]*",  # a single path segment
    r"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",  # the well-known sample key
)
XLOGX = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 1)]


def base_findings(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), leftmost non-overlapping per kind, short matches dropped."""
    found = []
    if NAMES.search(text):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(*m.span(), "hex") for m in LONG_HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[0], BASE_KINDS.index(f[2])))


def hot_windows(s: str, chars: frozenset, least_bits: float, least_digits: int) -> list[tuple[int, int]]:
    """Merged spans of windows of WINDOW class characters with enough entropy."""
    spans: list[list[int]] = []
    counts: dict[str, int] = {}
    total = 0.0  # sum of count*log2(count) over the window
    digits = size = 0
    for i, c in enumerate(s):
        if c not in chars:
            counts, total, digits, size = {}, 0.0, 0, 0
            continue
        n = counts.get(c, 0)
        total += XLOGX[n + 1] - XLOGX[n]
        counts[c] = n + 1
        digits += c <= "9"
        size += 1
        if size > WINDOW:
            old = s[i - WINDOW]
            n = counts[old]
            total += XLOGX[n - 1] - XLOGX[n]
            counts[old] = n - 1
            digits -= old <= "9"
            size = WINDOW
        if size == WINDOW and digits >= least_digits and math.log2(WINDOW) - total / WINDOW >= least_bits:
            lo = i - WINDOW + 1
            if spans and lo <= spans[-1][1]:
                spans[-1][1] = i + 1
            else:
                spans.append([lo, i + 1])
    return [(a, b) for a, b in spans]


def outside(spans: list[tuple[int, int, str]], others: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """The spans that lie within none of the others, by start: one sweep over both."""
    spans, others = sorted(spans), sorted(others)
    out, at, reach = [], 0, -1
    for span in spans:
        while at < len(others) and others[at][0] <= span[0]:
            reach = max(reach, others[at][1])
            at += 1
        if span[1] > reach:
            out.append(span)
    return out


def entropy_findings(text: str, allow: re.Pattern) -> list[tuple[int, int, str]]:
    """Hot spans of every class; a base-64 span within a hexadecimal one says nothing new.
    Harmless are candidates on the allow-list, and spans that reach only into path segments
    on it, at least one of them as long as a window."""
    found = []
    for m in CANDIDATE.finditer(text):
        run = m[0]
        if allow.fullmatch(run):
            continue
        spans: list[tuple[int, int, str]] = []
        for kind, (chars, bits, digits) in CLASSES.items():
            spans += outside([(lo, hi, kind) for lo, hi in hot_windows(run, chars, bits, digits)], [s[:2] for s in spans])
        if spans and "/" in run:
            segments = [(p.start(), p.end(), bool(allow.fullmatch(p[0]))) for p in SEGMENT.finditer(run)]
            starts, ends = [p[0] for p in segments], [p[1] for p in segments]
            spans = [s for s in spans if not _harmless(segments[bisect_right(ends, s[0]) : bisect_left(starts, s[1])])]
        found += [(m.start() + lo, m.start() + hi, kind) for lo, hi, kind in spans]
    return found


def _harmless(segments: list[tuple[int, int, bool]]) -> bool:
    return all(ok for _, _, ok in segments) and any(b - a >= WINDOW for a, b, _ in segments)


def scan(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """One row per input row: id, ``findings`` array of (start, end, kind) in code points,
    end exclusive, by start and then kind (assign, access, hex, then entropy kinds).

    Null and empty texts have no findings; texts are read whole. Rows are independent:
    repeated rows repeat, null ids stay null, other columns are ignored.
    """
    pattern = "|".join(f"(?:{p})" for p in allow) or r"(?!)"
    order = {k: i for i, k in enumerate((*BASE_KINDS, *CLASSES))}

    def run(batches):
        allowed = re.compile(pattern)
        for b in batches:
            texts, out = b.column(1).to_pylist(), []
            for t in texts:
                found = []
                if t:
                    found = base_findings(t)
                    # a window inside a base finding says nothing new
                    found += outside(entropy_findings(t, allowed), [(s, e) for s, e, _ in found])
                    found.sort(key=lambda f: (f[0], order[f[2]]))
                out.append([{"start": s, "end": e, "kind": k} for s, e, k in found])
            yield {"_id": b.column(0).to_pylist(), "findings": out}

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"_id {id_type}, findings array<struct<start: bigint, end: bigint, kind: string>>"
    return map_batches(docs.select(F.col(id_col), F.col(text_col)), run, schema).withColumnRenamed("_id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind and the digests of the findings."""
    base = F.filter("findings", lambda f: f["kind"].isin(*BASE_KINDS))
    joined = lambda c: F.array_join(F.transform(c, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("findings", lambda f: f["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(id_col, *[count(k) for k in BASE_KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))
