"""Main text of HTML pages by structure and a suffix array per host.

A page is cut into text blocks by its markup; blocks in menus, headers, footers, sidebars, notices, adverts, forms and
reader comments are page furniture and go. Names that only mention furniture (``layout-sidebar-right``) and forms count as furniture
only where they cover at most half of the page's words, and nothing around an article or main element with more than half
makes that furniture. The words of all other blocks of a host's pages, laid end to end, are sorted
as a suffix array to the depth of the shortest run that counts; runs that distinct pages share stand side by side there.
Blocks that runs on a tenth of the host's pages cover are boilerplate and the unique runs stay. As articles quote and
copy each other, a run in a named article must also stand on three pages and on half of them in the same block from the
article's first or last, or else on half of the host's pages. A page most of which is repeated is a copy of another page, not
boilerplate: it keeps its blocks and does not count for others.

A host of many pages is sorted in parts of about ``PART`` pages, dealt by a hash of the page. A run on a tenth of the host
is on a tenth of some part, so the parts name their frequent runs, all parts count all runs named, and the sums decide.

Cases: null or empty html gives an empty text; a page without url belongs to the host ''; repeated rows are copies
of each other; unclosed elements end with their parent and an unfinished tag at the end is dropped.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.grams import byte_table, shingles, split_words, stored

PART = 200
RUN = 8

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math canvas object video audio xmp noembed noframes".split())
FURNITURE = frozenset("nav header footer aside form menu dialog button select option label datalist fieldset search".split())
ROLES = frozenset("navigation banner contentinfo complementary form search alert alertdialog dialog menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices popup modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs masthead header footer sidebar widget related "
    "recommended recommendations share sharing social comment comments disqus replies respond subscribe newsletter signup "
    "login pagination pager toolbar skip hidden".split()
)
# What a name that begins with furniture may go on with and still be sure: many of it in one place.
GATHERED = frozenset("area section list thread box block".split())
MAYBE = frozenset("form".split())
STATES = frozenset("has with no without is js not".split())
HEADS = frozenset("header masthead banner".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s>/]*)((?:[^'\">]++|\"[^\"]*\"|'[^']*')*+)>|(/?)([a-zA-Z][^\s>/]*)([^>]*)>|[!?/][^>]*>)", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/"']|$)""", re.I)
UNFINISHED = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")


def _named(value: str) -> tuple[set[str], set[str]]:
    """Furniture words that class and id names say surely (as their last or only part) and maybe (as another part).

    A name with a word like ``has`` or ``with`` says what its element has, not what it is.
    """
    sure, maybe = set(), set()
    for name in value.split():
        parts = [p for p in re.split(r"[_-]+", name) if p]
        found = WORDS.intersection(parts)
        if not found or STATES.intersection(parts):
            continue
        if parts[-1] in WORDS or (parts[0] in WORDS and GATHERED.issuperset(parts[1:])):
            sure |= found
        else:
            maybe |= found
    return sure, maybe


def _furniture(name: str, attributes: str, inside: bool) -> tuple[int, bool]:
    """2 for page furniture, 1 for the head of an article, whose headings stay, 0 for anything else; and whether only the element's size can tell."""
    if name in FURNITURE:
        return (1 if name == "header" and inside else 2), name in MAYBE
    if not attributes or attributes.isspace() or name in ("html", "body"):
        return 0, False
    found, guess = 0, 0
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m.group(1).lower(), (m.group(2) or m.group(3) or m.group(4) or "").lower()
        if key in ("class", "id"):
            sure, maybe = _named(value)
            if sure:
                found = max(found, 1 if inside and sure <= HEADS else 2)
            if maybe:
                guess = max(guess, 1 if inside and maybe <= HEADS else 2)
        elif key == "role":
            found = max(found, 2 * (value in ROLES))
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
            found = 2
    return (found, False) if found >= guess else (guess, True)


class _Blocks:
    """The text blocks of a page as its tags come, with the elements that cover them; every step is constant but for what it closes."""

    def __init__(self) -> None:
        self.texts: list[str] = []
        self.words: list[int] = []  # words up to each block
        self.inside: list[bool] = []  # in an article
        self.heading: list[bool] = []
        self.parts: list[str] = []
        self.stack: list[tuple[str, bool, int]] = []  # element, in an article, its number among those that count
        self.depth: Counter[str] = Counter()
        self.headings = 0
        self.spans: list[list[int]] = []  # first block, end block, furniture value, unsure

    def flush(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                self.texts.append(text)
                self.words.append((self.words[-1] if self.words else 0) + text.count(" ") + 1)
                self.inside.append(bool(self.stack) and self.stack[-1][1])
                self.heading.append(self.headings > 0)
            self.parts.clear()

    def pop(self) -> str:
        name, _, span = self.stack.pop()
        self.depth[name] -= 1
        self.headings -= name in HEADINGS
        if span >= 0:
            self.spans[span][1] = len(self.texts)  # an inline element does not decide over the block it lies in
        return name

    def close(self, name: str) -> None:
        while self.depth[name]:
            if self.pop() == name:
                return

    def end_before(self, name: str) -> None:
        """A block ends an open paragraph, an item the item before."""
        for i in range(len(self.stack) - 1, -1, -1):
            held = self.stack[i][0]
            if held == "p" or (held == name and name in ("li", "dt", "dd", "tr", "td", "th")):
                while len(self.stack) > i:
                    self.pop()
                return
            if held in BLOCKS:
                return

    def open(self, name: str, attributes: str) -> None:
        inside = bool(self.stack) and self.stack[-1][1]
        value, unsure = _furniture(name, attributes, inside)
        article = name in ("article", "main") or 'role="main"' in attributes
        span = -1
        if value or article:
            span = len(self.spans)
            self.spans.append([len(self.texts), -1, value, unsure, article and not value])
        self.stack.append((name, inside or article, span))
        self.depth[name] += 1
        self.headings += name in HEADINGS

    def done(self) -> tuple[list[str], list[int]]:
        """Blocks and places; furniture is what covers the smaller part of the page, where a name alone cannot tell."""
        self.flush()
        while self.stack:
            self.pop()
        n = len(self.texts)
        before = [0, *self.words]
        size = lambda s: before[min(s[1], n)] - before[min(s[0], n)]
        chief = [s for s in self.spans if s[4] and 2 * size(s) > before[-1]]
        chief = min(chief, key=size, default=None)  # the article with most of the page's words: nothing around it makes it furniture
        change = [0] * (n + 1)
        for s in self.spans:
            if not s[2] or (s[3] and 2 * size(s) > before[-1]):
                continue
            first, end = min(s[0], n), min(s[1], n)
            pieces = [(first, end)]
            if chief is not None and s[0] <= chief[0] and chief[1] <= s[1]:
                pieces = [(first, min(chief[0], n)), (min(chief[1], n), end)]
            for a, b in pieces:
                change[a] += s[2]
                change[b] -= s[2]
        places, depth = [], 0
        for i in range(n):
            depth += change[i]
            gone = depth and not (self.heading[i] and self.inside[i] and depth == 1)
            places.append(0 if gone else 2 if self.inside[i] else 1)
        return self.texts, places


def text_blocks(page: str) -> tuple[list[str], list[int]]:
    """The text blocks of a page in order and the place of each: 0 page furniture, 1 elsewhere, 2 in the article."""
    page = UNFINISHED.sub("", page)
    out = _Blocks()
    at = 0
    while True:
        m = TAG.search(page, at)
        if m is None:
            out.parts.append(page[at:])
            break
        if m.start() > at:
            out.parts.append(page[at : m.start()])
        at = m.end()
        name = m.group(2) or m.group(5)
        if name is None:
            continue
        name, closing = name.lower(), m.group(1) or m.group(4)
        attributes = m.group(3) or m.group(6) or ""
        if not closing and name in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name == "br":
            out.parts.append(" ")
            continue
        if name in BLOCKS or (name in FURNITURE and out.depth["form"]):  # a form's controls stand apart from its text
            out.flush()
        if closing:
            out.close(name)
        elif name not in VOID:
            if name in BLOCKS:
                out.end_before(name)
            out.open(name, attributes)
    return out.done()


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages = [text_blocks(x or "") for x in batch.column("html").to_pylist()]
        keep = [i for i, n in enumerate(batch.schema.names) if n != "html"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in keep], pa.array([p[0] for p in pages], pa.list_(pa.string())), pa.array([p[1] for p in pages], pa.list_(pa.int8()))],
            names=[*[batch.schema.names[i] for i in keep], "texts", "places"],
        )


def suffix_groups(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``depth`` tokens, and for each the number of its group of equal beginnings.

    Prefix doubling: ranks by 2h tokens follow from pairs of ranks by h tokens.
    """
    n = len(tokens)
    _, rank = np.unique(tokens, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    h = 1
    while h < depth:
        step = min(h, depth - h)
        following = np.zeros(n, dtype=np.int64)
        following[: max(0, n - step)] = rank[step:]
        _, rank = np.unique(rank * (n + 2) + following, return_inverse=True)
        rank = rank.astype(np.int64) + 1
        h += step
    order = np.argsort(rank, kind="stable")
    return order, rank[order]


def run_groups(words: np.ndarray, bounds: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """For each word of the pages laid end to end: the group of equal runs it begins, and on how many pages they stand."""
    pages = len(bounds) - 1
    owner = np.repeat(np.arange(pages), np.diff(bounds))
    # a mark of its own ends each page, so that no run leaves it
    at = np.arange(len(words)) + owner
    tokens = np.zeros(len(words) + pages, dtype=np.uint64)
    tokens[at] = words
    ends = bounds[1:] + np.arange(pages)
    tokens[ends] = np.arange(pages, dtype=np.uint64) + np.uint64(1)
    whose = np.zeros(len(tokens), dtype=np.int64)
    whose[at], whose[ends] = owner, np.arange(pages)
    order, group = suffix_groups(tokens, run)
    pairs = np.unique(group * pages + whose[order])
    support = np.bincount(pairs // pages, minlength=int(group.max(initial=0)) + 1)
    value = np.zeros(len(tokens), dtype=np.int64)
    value[order] = support[group]
    value[ends] = 0
    which = np.zeros(len(tokens), dtype=np.int64)
    which[order] = group
    return which[at], value[at]


def shared_runs(words: np.ndarray, bounds: np.ndarray, run: int = RUN) -> np.ndarray:
    """For each word of the pages laid end to end: on how many pages the best run of ``run`` words over it stands."""
    value = run_groups(words, bounds, run)[1]
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    best = value.copy()  # a word has the best of the runs that reach it
    for k in range(1, min(run, len(value))):
        same = owner[k:] == owner[:-k]
        best[k:][same] = np.maximum(best[k:][same], value[:-k][same])
    return best


class Part:
    """The runs of the pages of one part of a host: where each stands, on which page and in which block of it."""

    def __init__(self, rows: pd.DataFrame, run: int):
        self.texts, self.run = list(rows["texts"]), run
        self.places = [np.asarray(p, dtype=np.int64) for p in rows["places"]]
        kept = [np.flatnonzero(p > 0) for p in self.places]
        blocks = [page[k].encode() for page, of_page in zip(self.texts, kept, strict=True) for k in of_page]
        self.words, self.bounds = split_words(blocks, byte_table()) if blocks else (np.zeros(0, np.uint64), np.zeros(1, np.int64))
        self.counts = np.array([len(k) for k in kept], dtype=np.int64)
        self.firsts = np.cumsum(self.counts) - self.counts
        self.edges = np.concatenate([self.bounds[self.firsts], self.bounds[-1:]])
        owner = np.repeat(np.arange(len(kept)), np.diff(self.edges))
        self.at = np.flatnonzero(np.arange(len(self.words)) + run <= self.edges[owner + 1])
        self.page = owner[self.at]
        block = np.searchsorted(self.bounds, self.at, "right") - 1 - self.firsts[self.page]
        self.slots = (2 * block, 2 * (self.counts[self.page] - 1 - block) + 1)

    def hashes(self) -> np.ndarray:
        """A hash of each run that is the same in all parts."""
        return shingles(self.words, self.run)[self.at].view(np.int64) if len(self.at) else np.zeros(0, np.int64)

    def covered(self, flags: np.ndarray) -> np.ndarray:
        """The blocks, in order, all words of which stand in runs with a flag."""
        word = np.zeros(len(self.words), dtype=bool)
        for k in range(self.run):
            word[self.at[flags] + k] = True
        return np.logical_and.reduceat(word, self.bounds[:-1]) if len(word) else np.zeros(len(self.bounds) - 1, dtype=bool)

    def copies(self, flags: np.ndarray) -> np.ndarray:
        """The pages most of whose words such blocks hold."""
        held = np.concatenate([[0], np.cumsum(np.diff(self.bounds) * self.covered(flags))])
        ends = self.firsts + self.counts
        return 2 * (held[ends] - held[self.firsts]) > self.edges[1:] - self.edges[:-1]

    def support(self, keys: np.ndarray, named: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """The keys of the runs named, and for all slots (-1) and each slot (number of key, slot, distinct pages); copies do not count."""
        use = np.flatnonzero(named & ~self.copies(named)[self.page])
        known, number = np.unique(keys[use], return_inverse=True)
        pages, out = len(self.texts), []
        for slots in (np.full(len(self.at), -1), *self.slots):
            slot, width = slots[use] + 1, 2 * int(self.counts.max(initial=0)) + 2
            pairs, which = np.unique(number * width + slot, return_inverse=True)
            seen = np.unique(which * pages + self.page[use]) // max(1, pages)
            out.append((pairs // width, pairs % width - 1, np.bincount(seen, minlength=len(pairs))))
        return known, out

    def shared(self) -> tuple[np.ndarray, np.ndarray]:
        """The group of each run in the suffix array, and on how many pages of the part it stands."""
        group, value = run_groups(self.words, self.edges, self.run)
        return group[self.at], value[self.at]


def _frequent(rows: pd.DataFrame, run: int) -> pd.DataFrame:
    """Runs on a tenth of the pages of one part of a host, if the host has several parts."""
    if rows["parts"].iloc[0] < 2:
        return pd.DataFrame()
    part = Part(rows, run)
    found = np.unique(part.hashes()[10 * part.shared()[1] >= len(rows)])
    return pd.DataFrame({"host": rows["host"].iloc[0], "run": found})


def _counted(rows: pd.DataFrame, named: pd.DataFrame, run: int) -> pd.DataFrame:
    """Pages of one part, by slot, for the runs that any part of its host named."""
    if not len(rows) or not len(named):
        return pd.DataFrame()
    part = Part(rows, run)
    keys = part.hashes()
    known, counts = part.support(keys, np.isin(keys, np.asarray(named["runs"].iloc[0], dtype=np.int64)))
    number, slot, n = (np.concatenate(c) for c in zip(*counts, strict=True))
    return pd.DataFrame({"host": rows["host"].iloc[0], "run": known[number], "slot": slot, "n": n, "pages": rows["pages"].iloc[0]})


def _chosen(rows: pd.DataFrame, named: pd.DataFrame, run: int) -> pd.DataFrame:
    """Main text of the pages of one part, by the host's counts of its runs."""
    if not len(rows):
        return pd.DataFrame()
    part, pages = Part(rows, run), int(rows["pages"].iloc[0])
    if rows["parts"].iloc[0] < 2:
        keys, value = part.shared()
        known, counts = part.support(keys, (10 * value >= pages) & (value > 1))
        total, fixed = counts[0][2], np.zeros(len(known), dtype=np.int64)
        for number, _, n in counts[1:]:
            np.maximum.at(fixed, number, n)
    elif len(named):
        keys = part.hashes()
        known, total, fixed = (np.asarray(named[c].iloc[0], dtype=np.int64) for c in ("runs", "totals", "fixed"))
        order = np.argsort(known)
        known, total, fixed = known[order], total[order], fixed[order]
    else:
        keys, known = part.hashes(), np.zeros(0, np.int64)
    anywhere = article = np.zeros(len(keys), dtype=bool)
    if len(known):
        tenth = 10 * total >= pages
        inside = (total >= 3) & ((tenth & (2 * fixed >= total)) | (2 * total >= pages))
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        hit = known[at] == keys
        anywhere, article = hit & (tenth & (total >= 2))[at], hit & inside[at]
    low, high = part.covered(anywhere), part.covered(article)
    sizes, out, repeated = np.diff(part.bounds), [], []
    for i, (texts, place) in enumerate(zip(part.texts, part.places, strict=True)):
        a, b = part.firsts[i], part.firsts[i] + part.counts[i]
        place = place[place > 0]
        covered = np.where(place == 2, high[a:b], low[a:b])
        if 2 * sizes[a:b][covered].sum() > sizes[a:b].sum():
            covered[:] = False
        kept = [t for t, p in zip(texts, part.places[i], strict=True) if p > 0]
        out.append("\n\n".join(t for t, gone in zip(kept, covered, strict=True) if not gone))
        repeated.append(int(covered.sum()))
    return pd.DataFrame({
        "page_id": rows["page_id"], "url": rows["url"], "text": out,
        "n_chars": [len(t) for t in out], "n_repeated": repeated,
    })


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", run: int = RUN, part: int = PART) -> DataFrame:
    """page_id, url, text (blocks joined by an empty line), n_chars and n_repeated (blocks dropped as boilerplate)."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    rows = rows.withColumn("host", host)
    sizes = stored(rows.groupBy("host").agg(F.count("*").alias("pages")).withColumn("parts", F.ceil(F.col("pages") / part).cast("long")), "hosts")
    parsed = rows.mapInArrow(_parsed, "page_id long, url string, host string, texts array<string>, places array<tinyint>")
    dealt = parsed.join(sizes, "host").withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.col("parts")))
    # the three passes read one exchange: same columns, same keys
    several = sizes.filter("parts > 1").select("host", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    named = dealt.groupBy("host", "part").applyInPandas(lambda group: _frequent(group, run), "host string, run long")
    named = several.join(named.groupBy("host").agg(F.collect_set("run").alias("runs")), "host")
    counts = dealt.groupBy("host", "part").cogroup(named.groupBy("host", "part")).applyInPandas(
        lambda group, runs: _counted(group, runs, run), "host string, run long, slot long, n long, pages long")
    counts = counts.groupBy("host", "run", "slot").agg(F.sum("n").alias("n"), F.max("pages").alias("pages"))
    counts = counts.groupBy("host", "run").agg(F.max(F.when(F.col("slot") < 0, F.col("n"))).alias("total"), F.max(F.when(F.col("slot") >= 0, F.col("n"))).alias("most"), F.max("pages").alias("pages"))
    counts = counts.filter(F.col("total") * 10 >= F.col("pages")).groupBy("host").agg(F.collect_list(F.struct("run", "total", "most")).alias("all"))
    counts = counts.select("host", F.col("all.run").alias("runs"), F.col("all.total").alias("totals"), F.col("all.most").alias("fixed"))
    counts = several.join(counts, "host")
    return dealt.groupBy("host", "part").cogroup(counts.groupBy("host", "part")).applyInPandas(
        lambda group, runs: _chosen(group, runs, run), "page_id long, url string, text string, n_chars long, n_repeated int"
    )
