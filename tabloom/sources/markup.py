"""HTML pages as tables.

Key/value pages are read with JVM regular expressions, links and titles by a
streaming tokenizer. Listing pages need nesting ("the score inside this post"), for which a
small event handler on Python's tolerant HTML parser emits one row per post.
Either way a page is parsed where it lies; nothing is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.fixed_values import (
    DELETED,
    FORUM_BASE,
    FORUM_JSON_BASE,
    HIDDEN_VALUE,
    PAGE_LABELS,
    PAGE_TEXT_PATTERNS,
)
from tabloom.functions.text import capture, decode_entities, let, visible_text
from tabloom.functions.values import (
    absolute_url,
    bare_id,
    comment_number,
    epoch_millis_to_seconds,
    score_number,
    well_url,
)
from tabloom.sources import tokens

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_PARTS = ("title", "author", "score", "votes", "comments", "body")
_POST_SCHEMA = (
    "position int, classes string, fullname string, stamp string, title_href string, comments_href string, "
    + ", ".join(f"{p} array<string>" for p in _PARTS)
)


class _PostReader(HTMLParser):
    """Collects the ``div.thing`` elements of a page with their parts."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.posts: list[dict] = []
        # Open elements, and apart from them what text and parts look for: no step walks the whole stack.
        self.open: list[tuple[str, bool, dict | None, list]] = []
        self.depth: Counter[str] = Counter()
        self.open_posts: list[dict] = []
        self.wanted: list[list] = []
        self.expandos = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        given = {k: v or "" for k, v in attrs}
        classes = frozenset(given.get("class", "").split())
        started = None
        if tag == "div" and "thing" in classes:
            started = {
                "position": len(self.posts) + 1,
                "classes": given.get("class", ""),
                "fullname": given.get("data-fullname", ""),
                "stamp": given.get("data-timestamp", "0"),
            }
            self.posts.append(started)
        wanted = []
        for name in self._parts(tag, classes):
            for post in self.open_posts:
                if name not in post:
                    post[name] = []
                    wanted.append(post[name])
                    if name in ("title", "comments"):
                        post[f"{name}_href"] = given.get("href", "")
        if tag not in _VOID:
            expando = tag == "div" and "expando" in classes
            self.open.append((tag, expando, started, wanted))
            self.depth[tag] += 1
            self.expandos += expando
            self.wanted += wanted
            if started is not None:
                self.open_posts.append(started)

    def _parts(self, tag: str, classes: frozenset) -> Iterator[str]:
        if tag == "a":
            yield from (name for name in ("title", "author", "comments") if name in classes)
        if tag == "div" and "score" in classes:
            yield "score"
            if "unvoted" in classes:
                yield "votes"
        if "usertext-body" in classes and self.expandos:
            yield "body"

    def handle_endtag(self, tag: str) -> None:
        while self.depth[tag]:
            name, expando, started, wanted = self.open.pop()
            self.depth[name] -= 1
            self.expandos -= expando
            del self.wanted[len(self.wanted) - len(wanted) :]
            if started is not None:
                self.open_posts.pop()
            if name == tag:
                return

    def handle_data(self, data: str) -> None:
        for pieces in self.wanted:
            pieces.append(data)


def listing_elements(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """One row per post element: attributes and text pieces, NULL where absent."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["position", "classes", "fullname", "stamp", "title_href", "comments_href", *_PARTS]
        for batch in batches:
            rows = []
            for page, text in zip(batch[key], batch[html]):
                reader = _PostReader()
                reader.feed(text or "")
                reader.close()
                rows.extend([page, *(post.get(n) for n in names)] for post in reader.posts)
            yield pd.DataFrame(rows, columns=[key, *names])

    kind = dict(pages.dtypes)[key]
    return pages.select(key, html).mapInPandas(parse, f"`{key}` {kind}, {_POST_SCHEMA}")


def _joined(pieces: str, separator: str) -> Column:
    stripped = F.transform(pieces, lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", ""))
    return F.array_join(F.filter(stripped, lambda p: p != ""), separator)


def _whole(pieces: str) -> Column:
    return F.regexp_replace(F.array_join(pieces, ""), r"(?U)^\s+|\s+$", "")


def forum_posts(pages: DataFrame, key: str, html: str = "html", base: str = FORUM_BASE) -> DataFrame:
    """Typed posts; advertising, posts without id or without comment page are dropped."""
    elements = listing_elements(pages, key, html)
    labels = F.split("classes", r"\s+")
    organic = elements.where(
        ~F.arrays_overlap(labels, F.array(F.lit("promotedlink"), F.lit("promoted")))
        & (bare_id(F.col("fullname")) != "")
    )

    def text(pieces: str, separator: str, default: str = "") -> Column:
        return F.coalesce(_joined(pieces, separator), F.lit(default))

    return organic.select(
        key,
        "position",
        bare_id(F.col("fullname")).alias("post_id"),
        "fullname",
        epoch_millis_to_seconds(F.col("stamp")).alias("created_utc"),
        text("title", "").alias("title"),
        text("body", " ").alias("selftext"),
        text("author", "", DELETED).alias("author"),
        F.coalesce(score_number(_joined("votes", " ")), F.lit(0)).alias("score"),
        F.coalesce(comment_number(_joined("comments", " ")), F.lit(0)).alias("num_comments"),
        absolute_url(F.coalesce("title_href", F.lit("")), base).alias("url"),
        absolute_url(F.coalesce("comments_href", F.lit("")), base).alias("permalink"),
        F.lit(1).alias("is_self"),
        F.lit(0).alias("over_18"),
        F.lit(0).alias("stickied"),
    ).where(F.col("permalink").contains("/comments/"))


def listing_rows(
    pages: DataFrame, key: str, html: str, group: str, first: int = 20, now: Column | None = None
) -> DataFrame:
    """Untyped rows of the first post elements that have a title; position is kept as id."""
    elements = listing_elements(pages, key, html).where((F.col("position") <= first) & F.col("title").isNotNull())

    def text(pieces: str, default: str) -> Column:
        return F.coalesce(_whole(pieces), F.lit(default))

    return elements.select(
        key,
        F.col("position").alias("post_id"),
        text("title", "").alias("title"),
        text("author", "").alias("author"),
        text("score", "0").alias("score"),
        text("comments", "0").alias("comments"),
        absolute_url(F.coalesce("title_href", F.lit("")), FORUM_JSON_BASE).alias("url"),
        F.lit(group).alias("subreddit"),
        (F.current_timestamp() if now is None else now).alias("scraped_at"),
    )


def _element(name: str) -> str:
    """Pattern of a start tag; a ``>`` in a quoted value does not end it."""
    return rf"""(?i)<{name}(?=[\s/>])(?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+>"""


def _row_values(html: Column) -> Column:
    """Struct of the values that table rows give the known labels; every row is taken apart once."""
    rows = F.filter(F.split(html, _element("tr")), lambda _, i: i > 0)

    def pair(row: Column) -> Column:
        cells = F.slice(F.split(F.split(row, r"(?i)</tr\s*>")[0], _element("t[dh]")), 2, 2)
        return let(
            F.transform(cells, visible_text),
            lambda c: F.struct(F.lower(F.get(c, F.lit(0))).alias("label"), F.get(c, F.lit(1)).alias("value")),
        )

    pairs = F.filter(
        F.transform(rows, pair),
        lambda p: p["label"].isNotNull() & (p["value"] != "") & (F.lower(p["value"]) != HIDDEN_VALUE),
    )

    def value(held: Column, label: str) -> Column:
        return F.get(F.filter(held, lambda p: p["label"].contains(label)), F.lit(0))["value"]

    return let(pairs, lambda held: F.struct(*(value(held, label).alias(name) for label, name, _ in PAGE_LABELS)))


def _text_value(running: Column, name: str) -> Column:
    return let(
        F.btrim(capture(running, PAGE_TEXT_PATTERNS[name])),
        lambda v: F.when((v != "") & (F.lower(v) != HIDDEN_VALUE), v),
    )


def with_page_fields(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds the five page columns: known labels, by table rows first, by running text for the rest.

    Markup goes first and entities are resolved in the few values found, so escaped markup stays text
    and no page leaves the JVM. What several columns need is a column of its own, so that it is worked out once.
    """
    names = [name for _, name, _ in PAGE_LABELS]
    rows = pages.withColumn("_rows", _row_values(F.col(html)))
    missing = reduce(lambda a, b: a | b, (F.col(f"_rows.{n}").isNull() for n in names))
    texts = rows.withColumn("_running", F.when(missing, visible_text(F.col(html))))
    found = texts.withColumns({f"_{n}": F.coalesce(F.col(f"_rows.{n}"), _text_value(F.col("_running"), n)) for n in names})
    filled = found.withColumns(
        {name: F.substring(F.btrim(decode_entities(F.col(f"_{name}"))), 1, size) for _, name, size in PAGE_LABELS}
    )
    return filled.drop("_rows", "_running", *(f"_{n}" for n in names))


def page_lookup(wells: DataFrame, pages: DataFrame, first_county: Column, second_county: Column) -> DataFrame:
    """Page columns per well, from the page of its county or else the default one.

    ``pages`` holds ``url`` (unique) and the five columns. The second page
    counts only where the first gave nothing.
    """
    names = [name for _, name, _ in PAGE_LABELS]

    def page(prefix: str) -> DataFrame:
        return pages.select(F.col("url").alias(f"{prefix}_url"), F.struct(*names).alias(f"{prefix}_page"))

    addressed = wells.withColumns(
        {
            "_a_url": well_url(F.col("api_number"), F.col("well_name"), first_county),
            "_b_url": well_url(F.col("api_number"), F.col("well_name"), second_county),
        }
    )
    both = addressed.join(page("_a"), "_a_url", "left").join(page("_b"), "_b_url", "left")

    def filled(page: str) -> Column:
        return reduce(
            lambda a, b: a + b,
            (F.coalesce((F.col(f"{page}.{n}") != "").cast("int"), F.lit(0)) for n in names),
        )

    chosen = F.when(filled("_a_page") > 0, F.col("_a_page")).otherwise(F.col("_b_page"))
    return both.withColumn("_page", chosen).select(
        *wells.columns, *(F.col(f"_page.{n}").alias(n) for n in names)
    )


def page_links(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """One row per link: position, address and text. A page without links (or without html) has no row."""

    @F.arrow_udf("array<struct<href: string, text: string>>")
    def found(texts: pa.Array) -> pa.Array:
        rows = [[{"href": h, "text": t} for h, t in tokens.links(x or "")] for x in texts.to_pylist()]
        return pa.array(rows, pa.list_(pa.struct([("href", pa.string()), ("text", pa.string())])))

    links = pages.select(key, F.posexplode(found(F.col(html))).alias("position", "_link"))
    return links.select(key, "position", "_link.href", "_link.text")


def page_title(html: Column) -> Column:
    """Text of the title element, NULL for a NULL page."""

    @F.arrow_udf("string")
    def title(texts: pa.Array) -> pa.Array:
        return pa.array([None if x is None else tokens.title(x) for x in texts.to_pylist()], pa.string())

    return title(html)
