"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one per block element. Lines of page furniture (menus,
headers, footers, sidebars, notices, adverts, forms, comments; also scripts and styles)
count zero, as do lines that are mostly link text. Over windows of a few lines the text
lengths are summed; a region begins at a surge (the first line with text where the sum
rises above the threshold) and ends at the dive (the last line with text before the sum
falls to zero, a line of furniture, or the edge of a marked article). Lines in a marked
article weigh MARK times as much in the windows. Only regions near the densest one's size
stay; an article that stays keeps its short lines too.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import map_batches

WINDOW = 3  # lines per block
SURGE = 80  # characters in a window that start a region
MARK = 5  # a character in a marked article weighs as much as so many others
SHARE = 0.2  # a region stays if it holds this share of the largest region's text
LINKS = 0.5  # a line with more of its text inside links is furniture

# Fixed lists of HTML vocabulary
RAW = "script|style|noscript|template|iframe|textarea|title|svg|object|select|noembed|noframes|xmp"
BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE_TAGS = set("nav footer aside form button menu dialog head select label fieldset".split())
FURNITURE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|alerts?|gdpr|\w*nav|nav\w*|menu|breadcrumbs?|sidebar|footer|"
    r"share|sharing|recommend\w*|newsletter|subscribe|signup|login|popup|modal|overlay|comment\w*|respond|replies|disqus|pagination|pager|toolbar|skip)(?:$|[\s_-])",
    re.I,
)
# names that may also stand on article text: there only lines of links are furniture
LOOSE_NAMES = re.compile(r"(?:^|[\s_-])(?:side|social|related|widgets?|copyright|legal|tags|meta|byline)(?:$|[\s_-])", re.I)
HEADER_NAMES = re.compile(r"(?:^|[\s_-])(?:\w*header|masthead|topbar)(?:$|[\s_-])", re.I)  # furniture outside an article only
FURNITURE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
MARKUP = re.compile(
    rf"<!--.*?(?:-->|$)|<(?P<raw>{RAW})\b[^>]*?(?:/>|>.*?(?:</(?P=raw)\s*>|$))|<[!?][^>]*(?:>|$)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S | re.I
)
HREF = re.compile(r"""(?:^|[\s"'])href\s*=""", re.I)
ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)


def lines_of(html: str) -> list[tuple[str, int, bool, int]]:
    """(text, characters inside links, is furniture, number of the outermost marked article
    it is in or 0) of every block line."""
    lines, parts = [], []
    links = furniture = loose = article = articles = 0
    link = None  # depth of the stack where the open link began; it ends with the block around it
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, furniture, article, loosely named
    open_: Counter[str] = Counter()  # tags on the stack

    def flush():
        nonlocal parts, links
        text = " ".join(unescape("".join(parts)).split())
        if text:
            lines.append((text, links, furniture > 0 or (loose > 0 and links > LINKS * len(text)), articles if article else 0))
        parts, links = [], 0

    def pop():
        nonlocal furniture, article, loose, link
        tag, dull, marked, vague = stack.pop()
        open_[tag] -= 1
        furniture -= dull
        article -= marked
        loose -= vague
        if link is not None and len(stack) < link:
            link = None
        return tag

    at = 0
    for m in MARKUP.finditer(html):
        if m.start() > at:
            text = html[at : m.start()]
            parts.append(text)
            links += len(text.strip()) * (link is not None)
        at = m.end()
        if not (tag := m["tag"]):
            continue
        tag = tag.lower()
        if tag in BLOCK:
            flush()
        if tag == "a":
            link = len(stack) if not m["end"] and HREF.search(m["attrs"] or "") else None
        if m["end"]:
            if open_[tag]:
                while pop() != tag:
                    pass
        elif tag not in VOID and tag in BLOCK | FURNITURE_TAGS or tag in ("span", "b"):
            attrs = {k.lower(): v.strip("\"'") for k, v in ATTR.findall(m["attrs"] or "")}
            names = f"{attrs.get('class', '')} {attrs.get('id', '')}" if tag not in ("html", "body", "article", "main") else ""
            vague = bool(LOOSE_NAMES.search(names))
            named = FURNITURE_NAMES.search(names) or (not article and (vague or HEADER_NAMES.search(names)))
            hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "")
            dull = tag in FURNITURE_TAGS or bool(named) or attrs.get("role") in FURNITURE_ROLES or hidden or (tag == "header" and not article)
            marked = tag in ("article", "main") or attrs.get("role") in ("main", "article")
            if tag == "p":  # an open paragraph ends where the next one begins
                while stack and stack[-1][0] == "p":
                    pop()
            if tag in ("span", "b") and not dull and not vague:
                continue
            stack.append((tag, dull, marked, vague))
            open_[tag] += 1
            furniture += dull
            loose += vague
            articles += marked and not article
            article += marked
    if at < len(html):
        parts.append(html[at:])
    flush()
    return lines


def main_lines(lines: list[tuple[str, int, bool, int]], window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """The lines between surge and dive points, in page order."""
    n = len(lines)
    inside = [article for _, _, _, article in lines]
    linked = [links > LINKS * len(text) for text, links, _, _ in lines]
    # in an article a single line of links (a linked headline) is text, a run of them is a list
    listed = [linked[i] and (not inside[i] or any(0 <= k < n and linked[k] and inside[k] == inside[i] for k in (i - 1, i + 1))) for i in range(n)]
    weight = [0 if dull or listed[i] else len(text) * (MARK if article else 1) for i, (text, _, dull, article) in enumerate(lines)]
    total = [0, *accumulate(weight)]
    # text in the lines around each line, not reaching across furniture or the edge of an article
    barrier = [0, *accumulate(dull for _, _, dull, _ in lines)]
    regions: list[tuple[int, int]] = []
    start = None
    for i in range(n):
        hi = min(n, i + window)
        while hi > i and (barrier[hi] - barrier[i] or inside[hi - 1] != inside[i]):
            hi -= 1
        block = total[hi] - total[i]
        if start is not None and (not block or inside[i] != inside[start]):
            regions.append((start, i))  # dive
            start = None
        if start is None and weight[i] and block >= surge:
            start = i  # surge
    if start is not None:
        regions.append((start, n))
    if not regions:  # little text throughout: the window never surged
        marked = any(w and a for w, a in zip(weight, inside))
        return [lines[i][0] for i in range(n) if weight[i] and (inside[i] or not marked)]
    # an article stays or goes as a whole: its mass is that of all its lines
    mass: dict[int, int] = {}
    for w, a in zip(weight, inside):
        mass[a] = mass.get(a, 0) + w
    sizes = [mass[inside[a]] if inside[a] else total[b] - total[a] for a, b in regions]
    if not inside[regions[sizes.index(max(sizes))][0]]:  # the main text is in no article: the mark gives no weight
        sizes = [m // MARK if inside[a] else m for m, (a, _) in zip(sizes, regions)]
    keep = [r for r, m in zip(regions, sizes) if m >= SHARE * max(sizes)]
    articles = {inside[a] for a, _ in keep} - {0}
    spans = {i for a, b in keep for i in range(a, b)}
    return [lines[i][0] for i in range(n) if weight[i] and (i in spans or inside[i] in articles)]


def extract(html: str | None) -> str:
    return " ".join(main_lines(lines_of(html))) if html else ""


def extract_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per page: id, the ``keep`` columns, ``text``, ``n_chars`` (code points).

    Null or empty html gives empty text. The whole html is read. Rows are independent:
    repeated rows repeat, null ids stay null, other columns are ignored.
    """
    names = [id_col, *keep]
    types = ", ".join(f"_{i} {pages.schema[c].dataType.simpleString()}" for i, c in enumerate(names))

    def run(batches):
        for b in batches:
            texts = [extract(h) for h in b.column(len(names)).to_pylist()]
            yield {f"_{i}": b.column(i) for i in range(len(names))} | {"text": texts, "n_chars": [len(t) for t in texts]}

    out = map_batches(pages.select(*[F.col(c) for c in names], F.col(html_col)), run, f"{types}, text string, n_chars bigint")
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(names)], "text", "n_chars")
