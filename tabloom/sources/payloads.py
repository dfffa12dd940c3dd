"""JSON payloads as tables. Parsing is narrow: one payload is one row.

Arrays are unfolded with the outer form, as Spark would parse the payload a
second time to drop empty ones; the NULL rows are filtered or never join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.fixed_values import ARTICLE_BASE, FORUM_JSON_BASE
from tabloom.functions.values import author_line, epoch_text

_LISTING_DDL = """data struct<children: array<struct<data: struct<
    title: string, author: string, score: int, num_comments: int, created_utc: double,
    selftext: string, permalink: string, subreddit: string>>>>"""
_SEARCH_DDL = "esearchresult struct<idlist: array<string>>"
_SUMMARY_DDL = "result map<string, string>"
_ARTICLE_DDL = (
    "title string, authors array<struct<name: string>>, fulljournalname string, pubdate string, source string"
)


def listing_posts(
    payloads: DataFrame, payload: str, keys: list[str], first: int = 20, now: Column | None = None
) -> DataFrame:
    """The first posts of each listing with their position, defaults filled in."""
    children = F.slice(F.from_json(payload, _LISTING_DDL)["data"]["children"], 1, first)
    posts = payloads.select(*keys, F.posexplode_outer(children).alias("_pos", "_child"))
    posts = posts.where(F.col("_child.data").isNotNull())

    def text(name: str) -> Column:
        return F.coalesce(F.col(f"_child.data.{name}"), F.lit(""))

    def number(name: str) -> Column:
        return F.coalesce(F.col(f"_child.data.{name}"), F.lit(0))

    return posts.select(
        *keys,
        (F.col("_pos") + 1).alias("post_id"),
        text("title").alias("title"),
        text("author").alias("author"),
        number("score").alias("score"),
        number("num_comments").alias("num_comments"),
        epoch_text(number("created_utc")).alias("created_utc"),
        F.substring(text("selftext"), 1, 200).alias("selftext"),
        F.concat(F.lit(FORUM_JSON_BASE), text("permalink")).alias("url"),
        text("subreddit").alias("subreddit"),
        (F.current_timestamp() if now is None else now).alias("scraped_at"),
    )


def search_articles(
    searches: DataFrame,
    summaries: DataFrame,
    term: str,
    search: str,
    summary: str,
    first: int = 5,
    now: Column | None = None,
) -> DataFrame:
    """Articles found per search term, in listing order; ids without summary are skipped.

    ``searches`` holds ``term, search``, ``summaries`` holds ``term, summary``.
    """
    ids = F.slice(F.from_json(search, _SEARCH_DDL)["esearchresult"]["idlist"], 1, first)
    found = searches.select(term, F.posexplode_outer(ids).alias("_pos", "pmid"))
    known = summaries.select(
        term, F.explode_outer(F.from_json(summary, _SUMMARY_DDL)["result"]).alias("pmid", "_json")
    )
    article = found.join(known, [term, "pmid"]).withColumn("_a", F.from_json("_json", _ARTICLE_DDL))

    def text(name: str) -> Column:
        return F.coalesce(F.col(f"_a.{name}"), F.lit(""))

    authors = F.coalesce(F.col("_a.authors"), F.array().cast("array<struct<name: string>>"))
    return article.select(
        "pmid",
        text("title").alias("title"),
        author_line(authors).alias("authors"),
        text("fulljournalname").alias("journal"),
        text("pubdate").alias("pub_date"),
        text("source").alias("source"),
        F.col(term).alias("search_term"),
        F.concat(F.lit(ARTICLE_BASE), F.col("pmid"), F.lit("/")).alias("article_url"),
        (F.current_timestamp() if now is None else now).alias("fetched_at"),
        (F.col("_pos") + 1).alias("position"),
    )
