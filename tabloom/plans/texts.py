"""Text cleaning and keywords over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.functions import text as tx
from tabloom.functions.fixed_values import STOP_WORDS
from tabloom.operators.posts import preprocess_posts
from tabloom.operators.vectors import cluster_keywords
from tabloom.plans import Query
from tabloom.session import load

# The same expression builds the marked-up post in Spark and in the SQL.
_POST = """concat('<p class="a">', text, '</p> see http://x.example/', CAST(doc_id AS VARCHAR(20)),
 '?q=1 or www.y.example and /u/user_', CAST(doc_id AS VARCHAR(20)),
 ' said &amp;amp; &lt;b&gt;bold&lt;/b&gt;<!-- note --><br>Tom &amp; Ann')"""


def _posts(spark, folder):
    return load(spark, folder, "documents").select("doc_id", "source", F.expr(_POST).alias("post"))


def clean_documents(spark, folder):
    return _posts(spark, folder).select("doc_id", tx.clean_text(F.col("post")).alias("clean_text"))


def ascii_clean(spark, folder):
    return load(spark, folder, "documents").select(
        "doc_id", tx.ascii_text(F.expr("concat('<i>', text, '</i>')")).alias("value"),
        tx.ascii_text(F.expr("CASE WHEN doc_id % 2 = 0 THEN concat('<b>', chr(233), '</b>') END")).alias("blank"),
    )


def numeric_clean(spark, folder):
    raw = load(spark, folder, "customer").select(
        "c_custkey",
        F.expr("""CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN '' WHEN c_custkey % 7 = 2 THEN 'None'
                  ELSE concat('  ', CAST(c_custkey AS VARCHAR(20)), ',', lpad(CAST(c_nationkey AS VARCHAR(20)), 3, '0'), ' ')
                  END""").alias("value"),
    )
    return raw.select("c_custkey", tx.numeric_text(F.col("value")).alias("value"))


def mask_customers(spark, folder):
    name = F.expr("CASE WHEN c_custkey % 10 = 0 THEN '[deleted]' WHEN c_custkey % 10 = 1 THEN NULL ELSE c_name END")
    return load(spark, folder, "customer").select("c_custkey", tx.mask_author(name, "s1").alias("author_masked"))


def doc_keywords(spark, folder):
    words = tx.top_keywords(tx.clean_text(F.col("text")))
    return load(spark, folder, "documents").select("doc_id", F.concat_ws(",", words).alias("keywords"))


def doc_token_counts(spark, folder):
    counts = tx.token_counts(tx.keyword_tokens(tx.clean_text(F.col("text"))))
    return load(spark, folder, "documents").select("doc_id", F.inline(counts)).select(
        "doc_id", "token", F.col("n").cast("bigint").alias("n"), F.col("first_pos").cast("bigint").alias("first_pos")
    )


def topic_hints(spark, folder):
    words = tx.top_keywords(tx.clean_text(F.col("text")))
    hints = load(spark, folder, "documents").select(tx.topic_hint(words).alias("topic_hint"))
    return hints.groupBy("topic_hint").agg(F.count("*").alias("docs"))


def preprocess_docs(spark, folder):
    posts = _posts(spark, folder).withColumn("title", F.concat(F.lit("Doc from "), "source"))
    return preprocess_posts(posts, "title", "post", "source").select(
        "doc_id", "clean_text", "keywords", "topic_hint", "author_masked"
    )


def source_keywords(spark, folder):
    docs = load(spark, folder, "documents").select(
        "doc_id", "source", tx.top_keywords(tx.clean_text(F.col("text"))).alias("keywords")
    )
    top = cluster_keywords(docs, "source", "keywords", [F.col("doc_id")])
    return top.select("source", "keyword", "n", F.col("rank").cast("bigint").alias("rank"))


_CLEAN = "trim(regexp_replace({}, '[^a-zA-Z0-9]+', ' ', 'g'))"
_TOKENS = """
{name} AS (
  SELECT doc_id, unnest(string_split(lower({clean}), ' ')) AS token,
         generate_subscripts(string_split({clean}, ' '), 1) AS place FROM {rows}),
{name}_kept AS (
  SELECT doc_id, token, row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS pos FROM {name}
  WHERE length(token) > 2 AND NOT regexp_full_match(token, '[0-9]+')
    AND token NOT IN (""" + ", ".join(f"'{w}'" for w in STOP_WORDS) + """)),
counts AS (SELECT doc_id, token, count(*) AS n, min(pos) AS first_pos FROM {name}_kept GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first_pos) AS rank FROM counts),
keys AS (SELECT doc_id, string_agg(token, ',' ORDER BY rank) AS keywords, min_by(token, rank) AS hint
         FROM ranked WHERE rank <= 8 GROUP BY doc_id)"""
DOC_KEYS = _TOKENS.format(name="words", clean=_CLEAN.format("text"), rows="documents")

_UNESCAPED = """regexp_replace(replace(replace(replace(replace(regexp_replace(
  replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&amp;', '&'),
  '<!--.*?-->', ' ', 'g'), '<b>', ' '), '</b>', ' '), '<br>', ' '), '&amp;', '&'),
  '</?p[^>]*>', ' ', 'g')"""
_PLAIN = (
    "regexp_replace(regexp_replace(" + _UNESCAPED.format("post")
    + ", 'http\\S+|www\\.\\S+', ' ', 'g'), '/u/\\w+', ' USER ', 'g')"
)
_POSTS_SQL = f"posts AS (SELECT doc_id, source, {_POST} AS post FROM documents)"

QUERIES = {
    "clean_documents": Query(
        clean_documents, f"WITH {_POSTS_SQL} SELECT doc_id, {_CLEAN.format(_PLAIN)} AS clean_text FROM posts"
    ),
    "ascii_clean": Query(
        ascii_clean,
        """SELECT doc_id, coalesce(nullif(trim(regexp_replace(regexp_replace(text, '[^\\x20-\\x7E]+', ' ', 'g'),
             '\\s{2,}', ' ', 'g')), ''), 'N/A') AS value, 'N/A' AS blank FROM documents""",
    ),
    "numeric_clean": Query(
        numeric_clean,
        """SELECT c_custkey, CASE WHEN c_custkey % 7 < 3 THEN '0'
             ELSE CAST(c_custkey AS VARCHAR) || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') END AS value FROM customer""",
    ),
    "mask_customers": Query(
        mask_customers,
        """SELECT c_custkey, CASE WHEN c_custkey % 10 < 2 THEN '[deleted]' ELSE 'user_' || lpad(CAST(
             CAST('0x' || substr(md5('s1' || c_name), 1, 8) AS BIGINT) % 1000000 AS VARCHAR), 6, '0') END AS author_masked
           FROM customer""",
    ),
    "doc_keywords": Query(
        doc_keywords,
        f"""WITH {DOC_KEYS} SELECT doc_id, coalesce(keywords, '') AS keywords
            FROM documents LEFT JOIN keys USING (doc_id)""",
    ),
    "doc_token_counts": Query(doc_token_counts, f"WITH {DOC_KEYS} SELECT doc_id, token, n, first_pos FROM counts"),
    "topic_hints": Query(
        topic_hints,
        f"""WITH {DOC_KEYS} SELECT coalesce(hint, 'general') AS topic_hint, count(*) AS docs
            FROM documents LEFT JOIN keys USING (doc_id) GROUP BY 1""",
    ),
    "preprocess_docs": Query(
        preprocess_docs,
        f"""WITH {_POSTS_SQL},
cleaned AS (SELECT doc_id, source, 'Doc from ' || source || ' ' || {_CLEAN.format(_PLAIN)} AS text FROM posts),
{_TOKENS.format(name="words", clean="text", rows="cleaned")}
SELECT doc_id, text AS clean_text, keywords, hint AS topic_hint,
       'user_' || lpad(CAST(CAST('0x' || substr(md5(source), 1, 8) AS BIGINT) % 1000000 AS VARCHAR), 6, '0')
         AS author_masked
FROM cleaned JOIN keys USING (doc_id)""",
    ),
    "source_keywords": Query(
        source_keywords,
        f"""WITH {DOC_KEYS},
per AS (SELECT source, token AS keyword, count(*) AS n, min(doc_id * 100 + rank) AS seen
        FROM ranked JOIN documents USING (doc_id) WHERE rank <= 8 GROUP BY 1, 2)
SELECT source, keyword, n, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, seen) AS rank FROM per) WHERE rank <= 10""",
    ),
}
