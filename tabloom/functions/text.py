"""Column functions on text. All are narrow: no shuffle, one row in, one row out."""

from __future__ import annotations

import html
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tabloom.functions.fixed_values import DELETED, NO_AUTHOR, STOP_WORDS


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a variable."""
    return F.transform(F.array(value), body)[0]


def or_default(value: Column, default: str) -> Column:
    """The default where the value is NULL or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def capture(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of a pattern, NULL (not empty) where there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


@F.pandas_udf(StringType())
def _unescape(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def decode_entities(text: Column) -> Column:
    """Resolve HTML entities.

    Spark has no function for it. Only texts with an ampersand travel to
    Python; the others pass a NULL through the Arrow batch and stay as they are.
    """
    return F.coalesce(_unescape(F.when(text.contains("&"), text)), text)


_HIDDEN_BLOCKS = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
# A quoted attribute value may hold a ``>``; a tag with an odd quote ends at the first one.
_TAGS = r"<[a-zA-Z/!?](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|<[a-zA-Z/!?][^>]*>"


def visible_text(text: Column) -> Column:
    """Markup gone and white space collapsed; entities stay as they are, so escaped markup stays text."""
    return F.btrim(F.regexp_replace(strip_markup(text), r"\s+", " "))


def strip_markup(text: Column) -> Column:
    """Replace comments, script and style blocks and tags by blanks."""
    return F.regexp_replace(F.regexp_replace(text, _HIDDEN_BLOCKS, " "), _TAGS, " ")


# Texts of a batch that are Python strings at a time.
_AT_A_TIME = 64


@F.arrow_udf(StringType())
def _escaped_markup_to_text(text: pa.Array) -> pa.Array:
    """Entities may hide markup and markup may hold entities: resolve on both sides.

    A few texts at a time, as a batch holds thousands of whole documents.
    """

    def plain(value: str) -> str:
        visible = re.sub(_HIDDEN_BLOCKS, " ", html.unescape(value))
        return html.unescape(re.sub(_TAGS, " ", visible))

    done = [pa.array([], pa.string())]
    for first in range(0, len(text), _AT_A_TIME):
        some = text.slice(first, _AT_A_TIME).to_pylist()
        done.append(pa.array([None if value is None else plain(value) for value in some], pa.string()))
    return pa.concat_arrays(done)


def markup_to_text(text: Column) -> Column:
    """Text of a marked-up value. Only values with an entity visit Python."""
    return F.coalesce(_escaped_markup_to_text(F.when(text.contains("&"), text)), strip_markup(text), F.lit(""))


def clean_text(text: Column) -> Column:
    """Plain words of a post: markup, links, user names and punctuation go."""
    no_links = F.regexp_replace(markup_to_text(text), r"(?U)http\S+|www\.\S+", " ")
    no_names = F.regexp_replace(no_links, r"(?U)/u/\w+", " USER ")
    # Joining the words found is several times faster than replacing what lies between them.
    return F.array_join(F.regexp_extract_all(no_names, F.lit("[a-zA-Z0-9]+"), F.lit(0)), " ")


def ascii_text(value: Column) -> Column:
    """Printable ASCII of a value, ``N/A`` where nothing is left."""
    untagged = F.regexp_replace(value, r"<[^>]+>", "")
    ascii_only = F.regexp_replace(untagged, r"[^\x20-\x7E]+", " ")
    return or_default(F.btrim(F.regexp_replace(ascii_only, r"\s{2,}", " ")), "N/A")


def numeric_text(value: Column) -> Column:
    """A number kept as text, without thousands commas; ``0`` where missing."""
    bare = F.replace(F.regexp_replace(value.cast("string"), r"(?U)^\s+|\s+$", ""), F.lit(","), F.lit(""))
    return F.when(bare.isNull() | (bare == "") | (F.lower(bare) == "none"), "0").otherwise(bare)


def mask_author(name: Column, salt: str = "") -> Column:
    """A stable pseudonym: the same name always gets the same number."""
    digest = F.substring(F.md5(F.concat(F.lit(salt), name)), 1, 8)
    number = F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(1_000_000))
    hidden = name.isNull() | (name == "") | name.isin(NO_AUTHOR)
    return F.when(hidden, DELETED).otherwise(
        F.concat(F.lit("user_"), F.lpad(number.cast("string"), 6, "0"))
    )


def keyword_tokens(text: Column) -> Column:
    """Lower-case words of at least three letters that carry meaning."""
    return F.filter(
        F.split(F.lower(text), r"(?U)\s+"),
        lambda w: (F.length(w) > 2) & ~w.isin(STOP_WORDS) & ~w.rlike(r"^\d+$"),
    )


def _run_starts(differs, items: Column) -> Column:
    marks = F.transform(items, lambda x, i: F.when((i == 0) | differs(F.get(items, i - 1), x), i))
    return F.filter(marks, lambda i: i.isNotNull())


def _run_length(starts: Column, j: Column, start: Column, items: Column) -> Column:
    return F.coalesce(F.get(starts, j + 1), F.size(items)) - start


def term_counts(terms: Column) -> Column:
    """``array<struct<token, n>>`` of a token array.

    Sorting the row's own tokens puts equal ones side by side, so run
    boundaries give counts. Everything happens inside the row: counting
    words per document moves no data between executors.
    """

    def runs(s: Column) -> Column:
        return let(
            _run_starts(lambda a, b: a != b, s),
            lambda starts: F.transform(
                starts,
                lambda i, j: F.struct(F.get(s, i).alias("token"), _run_length(starts, j, i, s).alias("n")),
            ),
        )

    return let(F.sort_array(terms), runs)


def token_counts(tokens: Column) -> Column:
    """As :func:`term_counts`, with the position at which a token appears first."""
    pairs = F.sort_array(F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.alias("p"))))

    def runs(s: Column) -> Column:
        return let(
            _run_starts(lambda a, b: a["t"] != b["t"], s),
            lambda starts: F.transform(
                starts,
                lambda i, j: F.struct(
                    F.get(s, i)["t"].alias("token"),
                    _run_length(starts, j, i, s).alias("n"),
                    F.get(s, i)["p"].alias("first_pos"),
                ),
            ),
        )

    return let(pairs, runs)


def top_keywords(text: Column, top_k: int = 8) -> Column:
    """The most frequent keywords of a text; the earlier word wins a tie."""
    ranked = F.sort_array(
        F.transform(
            token_counts(keyword_tokens(text)),
            lambda c: F.struct((-c["n"]).alias("n"), c["first_pos"].alias("p"), c["token"].alias("t")),
        )
    )
    return F.transform(F.slice(ranked, 1, top_k), lambda c: c["t"])


def topic_hint(keywords: Column) -> Column:
    """First keyword, or ``general``."""
    return F.coalesce(F.get(keywords, F.lit(0)), F.lit("general"))


def slug(name: Column) -> Column:
    """Lower-case words joined by dashes, as in page addresses."""
    dashed = F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-")
    return F.regexp_replace(dashed, "^-+|-+$", "")
