"""Main text of web pages: markup roles, and a suffix array per host for what markup leaves open.

A page becomes blocks of text, each with a role: text inside an article is main text, text inside menus, footers, adverts
and the like is boilerplate by its markup, the rest is open. The tokens of a host's boilerplate and open blocks are
concatenated, page by page, and sorted by suffix (prefix doubling up to the least length of a repeat). Neighbours in that
order which agree on so many tokens and lie in distinct pages are repeats; an open block that repeats cover for the most
part is boilerplate, the others are kept. A hot host is cut into shards of bounded size. Its runs of so many tokens are
hashed and their pages counted over the whole host by Spark, and a shard gets those of its runs that other pages of the host
have, so that a repeat on a few pages is found wherever they are dealt.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain.llm.common import stored

#: Tokens that two pages must have in common for a repeat.
LEAST_REPEAT = 8
#: Share of an open block that repeats must cover.
COVERED = 0.8
#: Characters of html in one shard of a host, on the mean.
SHARD_CHARS = 4 * 2**20

SKIP, MAIN, OPEN = "skip", "main", "open"

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"']+))?")

# Fixed values of HTML and of common site markup.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe template svg math canvas object audio video".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot "
    "th thead tr ul".split())
_SKIP_TAGS = frozenset("nav footer aside form button select option dialog menu head search fieldset datalist".split())
_SKIP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_MAIN_NAMES = re.compile(
    r"(?:article|post|entry|story|news|page|main)[-_]*(?:body|content|text)|articlebody|article|hentry|main")
_SKIP_NAMES = re.compile(
    r"(?:(?:site|page|main|top|bottom|global|left|right|primary|secondary|user|reader|post|article|blog|cookie)[-_]*)?"
    r"(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banners?|cookies?|consent|gdpr|notices?|alerts?|disclaimer|newsletter|"
    r"subscri\w+|signup|login|nav\w*|menus?|breadcrumbs?|header|masthead|footer|sidebars?|aside|comments?|commentlist|replies|"
    r"respond|disqus\w*|share|sharing|social\w*|related|recommend\w*|popup|modal|overlay|widgets?|toolbar|pagination|pager|"
    r"search\w*|copyright|legal|skip\w*|tags?|teasers?)"
    r"(?:[-_]*(?:bar|box|list|item|container|wrapper|wrap|links?|area|section|block|unit|slot|text|form|thread|top|bottom|\d+))*")


@dataclass
class Block:
    text: str
    role: str


def _role(tag: str, attributes: str, above: str) -> str:
    """Role of an element's text, from its tag and names and from what holds it."""
    if above == SKIP:
        return SKIP
    named = {k.lower(): (v or "").strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)} if attributes.strip(" /") else {}
    if tag in _SKIP_TAGS or (tag == "header" and above != MAIN):
        return SKIP
    if "hidden" in named or named.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", named.get("style", "")):
        return SKIP
    if tag not in ("html", "body", "main"):
        if named.get("role") in _SKIP_ROLES:
            return SKIP
        names = [*named.get("class", "").split(), *named.get("id", "").split()]
        if any(_SKIP_NAMES.fullmatch(n) for n in names):
            return SKIP
        if any(_MAIN_NAMES.fullmatch(n) for n in names):
            return MAIN
    return MAIN if tag in ("article", "main") or named.get("role") == "main" else above


def blocks(html: str) -> list[Block]:
    """Blocks of text in page order with their roles; scripts, styles and other raw elements give none.

    Any text is accepted: end tags without a start are ignored, open elements end with the one around them.
    """
    out: list[Block] = []
    held: list[str] = []
    # Name and role of open elements; a skipped one inside a line keeps the text that stands before it.
    stack: list[tuple[str, str, list[str] | None]] = []
    depth: dict[str, int] = {}
    role, at, end = OPEN, 0, len(html)

    def flush() -> None:
        text = " ".join(unescape("".join(held)).split())
        held.clear()
        if text:
            out.append(Block(text, role))

    def close(tag: str) -> None:
        nonlocal role
        while stack:
            name, _, before = stack.pop()
            depth[name] -= 1
            if before is not None:
                flush()
                held.extend(before)
            if name == tag:
                break
            role = stack[-1][1] if stack else OPEN
        role = stack[-1][1] if stack else OPEN

    while at < end:
        m = _TAG.search(html, at)
        if m is None:
            held.append(html[at:])
            break
        if m.start() > at:
            held.append(html[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            if m[0].startswith("<![CDATA["):
                held.append(m[0][9:-3].replace("&", "&amp;"))
            continue
        tag, ending = name.lower(), bool(m[1] or m[4])
        attributes = m[3] or m[6] or ""
        if tag in _RAW:
            if not ending and not attributes.endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = stop.end() if stop else end
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in _BLOCK:
            flush()
            if not ending:
                # An open paragraph ends where a block begins, a list item or cell where the next one does.
                for sibling in ("p", tag if tag in ("li", "dd", "dt", "option", "td", "th", "tr") else ""):
                    if depth.get(sibling) and not (sibling in ("li", "td", "th", "tr") and _nested(stack, sibling)):
                        close(sibling)
        if ending:
            if depth.get(tag):
                # What is held belongs to the element that ends.
                if stack[-1][2] is None and role != (stack[-2][1] if len(stack) > 1 else OPEN):
                    flush()
                close(tag)
        elif tag not in _VOID:
            new, before = _role(tag, attributes, role), None
            if new == SKIP != role and tag not in _BLOCK:
                before = held.copy()
                held.clear()
            elif new != role:
                flush()
            stack.append((tag, new, before))
            depth[tag] = depth.get(tag, 0) + 1
            role = new
    flush()
    while stack:
        close(stack[-1][0])
        flush()
    return out


def _nested(stack: list[tuple], tag: str) -> bool:
    """Whether a list or table was opened inside the last open ``tag``."""
    for name, *_ in reversed(stack):
        if name == tag:
            return False
        if name in ("ul", "ol", "menu", "table"):
            return True
    return False


# ---- suffix array ---------------------------------------------------------------------------------------------------

def covered(tokens: np.ndarray, pages: np.ndarray, least: int = LEAST_REPEAT, known: np.ndarray | None = None) -> np.ndarray:
    """Which positions of a token stream lie in a run of ``least`` tokens that another page has as well.

    ``tokens`` are numbers, ``pages`` the page of each, in rising order; ``known`` tells of each position whether a page
    outside the stream has the run that starts there. Suffixes are sorted by their first ``least``
    tokens by prefix doubling; a run never goes across the end of its page.
    """
    n = len(tokens)
    if n == 0:
        return np.zeros(0, bool)
    rank, have = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    while have < least:
        step = min(have, least - have)
        after = np.full(n, -1, np.int64)
        m = max(0, n - step)
        after[:m] = np.where(pages[:m] == pages[step:], rank[step:], -1)
        rank = np.unique(rank * (n + 1) + after + 1, return_inverse=True)[1].astype(np.int64)
        have += step
    last = np.searchsorted(pages, pages, "right")
    whole = np.flatnonzero(np.arange(n) + least <= last)
    order = whole[np.argsort(rank[whole], kind="stable")]  # the suffix array, as far as suffixes are long enough
    ranks, at = rank[order], pages[order]
    first = np.r_[True, ranks[1:] != ranks[:-1]] if len(order) else np.zeros(0, bool)
    group = np.cumsum(first) - 1
    shared = np.zeros(int(group[-1]) + 1 if len(group) else 0, bool)
    shared[group[1:][(ranks[1:] == ranks[:-1]) & (at[1:] != at[:-1])]] = True
    marks = np.zeros(n + 1, np.int64)
    starts = order[shared[group] | (False if known is None else known[order])] if len(group) else order
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + least, n), -1)
    return np.cumsum(marks)[:n] > 0


def run_hashes(hashes: np.ndarray, pages: np.ndarray, least: int = LEAST_REPEAT) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the run of ``least`` tokens that starts at each position, and whether the page is long enough for it."""
    n = max(0, len(hashes) - least + 1)
    out = np.zeros(len(hashes), np.uint64)
    for k in range(least):
        out[:n] = out[:n] * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n]
    return out.view(np.int64), np.arange(len(pages)) + least <= np.searchsorted(pages, pages, "right")


def _token_hashes(tokens: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for t in tokens], np.uint64)


def page_runs(html: str, least: int = LEAST_REPEAT) -> tuple[np.ndarray, int]:
    """Hashes of a page's distinct runs outside main blocks, and a hash of the page that copies of it share."""
    page = blocks(html)
    tokens = [w for b in page if b.role != MAIN for w in b.text.split()]
    runs, whole = run_hashes(_token_hashes(tokens), np.zeros(len(tokens), np.int64), least)
    key = xxhash.xxh64_intdigest("\0".join(f"{b.role}\1{b.text}" for b in page).encode("utf-8", "surrogatepass"))
    return np.unique(runs[whole]), key - 2**63


def main_texts(htmls: list[str], least: int = LEAST_REPEAT, share: float = COVERED, elsewhere: np.ndarray | None = None) -> list[tuple[str, int]]:
    """(main text, tokens in repeats) for the pages of one host or shard.

    ``elsewhere`` are the hashes of runs that several pages of the host have, if these pages are a shard of it. Pages whose blocks are the same throughout count as one page, so copies do not make each other boilerplate.
    """
    parsed = [blocks(h) for h in htmls]
    numbers: dict[str, int] = {}
    tokens: list[int] = []
    pages: list[int] = []
    spans: dict[tuple, list[tuple[int, int]]] = {}
    keys = []
    for page in parsed:
        key = tuple((b.role, b.text) for b in page)
        keys.append(key)
        if key in spans:
            continue
        own = spans[key] = []
        number = len(spans)
        for role, text in key:
            if role == MAIN:
                continue
            ids = [numbers.setdefault(w, len(numbers)) for w in text.split()]
            own.append((len(tokens), len(tokens) + len(ids)))
            tokens += ids
            pages += [number] * len(ids)
    stream, of_page, known = np.array(tokens, np.int64), np.array(pages, np.int64), None
    if elsewhere is not None and len(tokens):
        known = np.isin(run_hashes(_token_hashes(list(numbers))[stream], of_page, least)[0], elsewhere)
    hit = np.r_[0, np.cumsum(covered(stream, of_page, least, known))]
    out = []
    for page, key in zip(parsed, keys):
        places, kept, repeated = iter(spans[key]), [], 0
        for b in page:
            if b.role == MAIN:
                kept.append(b.text)
                continue
            start, stop = next(places)
            inside = int(hit[stop] - hit[start])
            repeated += inside
            if b.role == OPEN and inside < share * (stop - start):
                kept.append(b.text)
        out.append(("\n".join(kept), repeated))
    return out


# ---- Spark ----------------------------------------------------------------------------------------------------------

TEXTS = "page_id bigint, url string, text string, n_chars bigint, n_repeated bigint"


def extract(pages: DataFrame, shard_chars: int = SHARD_CHARS, least: int = LEAST_REPEAT, share: float = COVERED) -> DataFrame:
    """page_id, url, text, n_chars and n_repeated (tokens in repeats) for every row of pages (page_id, url, html).

    A null html has an empty text; rows with a null url, or one without a host, form a host of their own. Repeated rows
    are extracted each for itself. Other columns are ignored; an empty table gives no rows. Sizes of hosts are sums of
    lengths; only hosts of several shards are kept, and a host's pages are dealt over its shards by a hash. Shards do not
    change the result, as each gets the runs that its pages have in common with others.
    """
    host = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    hot = stored(rows.groupBy("host").agg(
        F.ceil(F.sum(F.length("html")) / shard_chars).cast("int").alias("shards")).where("shards > 1"), "hosts")
    dealt = rows.join(hot, "host", "left").withColumn(
        "shard", F.pmod(F.xxhash64("page_id", "url", F.length("html")), F.coalesce("shards", F.lit(1)))).withColumn("hot", F.col("shards").isNotNull()).drop("shards")

    # Runs of hot hosts and how many pages have them: of one page both ends are equal.
    def runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            found = [page_runs(h, least) for h in pdf["html"]]
            sizes = [len(r) for r, _ in found]
            each = pd.DataFrame({
                "host": np.repeat(pdf["host"].to_numpy(), sizes), "shard": np.repeat(pdf["shard"].to_numpy(), sizes),
                "run": np.concatenate([r for r, _ in found]) if found else np.zeros(0, np.int64), "page": np.repeat(np.array([p for _, p in found], np.int64), sizes)})
            yield each.groupby(["host", "shard", "run"], sort=False, as_index=False).agg(low=("page", "min"), high=("page", "max"))

    placed = dealt.where("hot").select("host", "shard", "html").mapInPandas(runs, "host string, shard bigint, run bigint, low bigint, high bigint")
    repeats = placed.groupBy("host", "run").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.collect_set("shard").alias("shards")).where(
        (F.col("low") < F.col("high")) & (F.size("shards") > 1)).select("host", F.explode("shards").alias("shard"), "run")
    given = repeats.groupBy("host", "shard").agg(F.collect_list("run").alias("runs"))

    def of_host(pdf: pd.DataFrame) -> pd.DataFrame:
        told = pdf["runs"].notna()
        elsewhere = np.concatenate([np.asarray(r, np.int64) for r in pdf["runs"][told]]) if told.any() else None
        pdf = pdf[~told]
        found = main_texts(pdf["html"].tolist(), least, share, elsewhere)
        texts = [text for text, _ in found]
        return pd.DataFrame({
            "page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "n_chars": list(map(len, texts)),
            "n_repeated": [n for _, n in found]}, index=pdf.index)

    both = dealt.drop("hot").withColumn("runs", F.lit(None).cast("array<bigint>")).unionByName(given, allowMissingColumns=True)
    return both.groupBy("host", "shard").applyInPandas(of_host, TEXTS)
