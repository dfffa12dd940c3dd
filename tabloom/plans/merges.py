"""Keyed merges: customers as the stored table, orders as the updates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import merge
from tabloom.plans import Query
from tabloom.session import load

# Orders in status P belong to customers the stored table does not know.
_KEY = "CASE WHEN o_orderstatus = 'P' THEN o_custkey + 1000000000 ELSE o_custkey END"
_SEGMENT = "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END"
_BALANCE = "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_totalprice END"


def _stored(spark, folder):
    return load(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"), F.lit("stored").alias("fetched"),
    )


def _updates(spark, folder):
    return load(spark, folder, "orders").select(
        F.expr(_KEY).alias("id"), F.expr(_BALANCE).alias("balance"), F.expr(_SEGMENT).alias("segment"),
        F.lit("updated").alias("fetched"), F.col("o_orderkey").alias("seq"),
    )


def upsert_replace(spark, folder):
    return merge.replace_upsert(_stored(spark, folder), _updates(spark, folder), "id", "seq", keep=("fetched",))


def upsert_coalesce(spark, folder):
    return merge.coalesce_upsert(
        _stored(spark, folder), _updates(spark, folder), "id", "seq", ["balance", "segment"]
    )


def child_replace(spark, folder):
    children = load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("parent"), F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("value")
    )
    new = load(spark, folder, "orders").where("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias("parent"), F.lit(0).alias("line"), F.col("o_totalprice").alias("value")
    )
    return merge.child_replace(children, new, "parent")


def child_replace_batches(spark, folder):
    """Orders as children of customers; each event day is a batch for its user."""
    children = load(spark, folder, "orders").select(
        F.col("o_custkey").alias("parent"), F.col("o_orderkey").alias("child"), F.col("o_totalprice").alias("value")
    )
    new = load(spark, folder, "events").select(
        F.col("user_id").alias("parent"), F.col("event_id").alias("child"), "value",
        F.to_date("ts").alias("batch"),
    )
    return merge.child_replace(children, new, "parent", batch="batch")


def update_join(spark, folder):
    found = load(spark, folder, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.max_by("o_totalprice", "o_orderkey").alias("balance"),
        F.nullif(F.max_by("o_orderpriority", "o_orderkey"), F.lit("5-LOW")).alias("segment"),
    )
    return merge.update_join(_stored(spark, folder), found, "id", ["balance", "segment"])


def keyword_upsert(spark, folder):
    stored = load(spark, folder, "nation").select(
        F.col("n_nationkey").alias("cluster_id"), F.col("n_name").alias("top_keywords"),
        F.lit("2024-01-01").cast("date").alias("updated_at"),
    )
    new = load(spark, folder, "supplier").select(
        (F.col("s_nationkey") + 5).alias("cluster_id"), F.col("s_name").alias("top_keywords"),
        F.col("s_suppkey").alias("seq"),
    )
    now = F.lit("2025-06-30").cast("date")
    return merge.stamped_upsert(stored, new, "cluster_id", "seq", "updated_at", now)


def orphans(spark, folder):
    return merge.orphans(
        load(spark, folder, "orders").select("o_orderkey", "o_custkey"),
        load(spark, folder, "lineitem"), "o_orderkey", "l_orderkey",
    )


def cascade_delete(spark, folder):
    remaining = load(spark, folder, "orders").where("o_orderstatus <> 'F'")
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return merge.cascade_delete(lines, remaining, "l_orderkey", "o_orderkey")


def cascade_rename(spark, folder):
    renames = load(spark, folder, "orders").where("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias("old"), (F.col("o_orderkey") + 1_000_000_000).alias("new")
    )
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return merge.cascade_rename(lines, renames, "l_orderkey", "old", "new")


def incremental_skip(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "source", "n_chars")
    return merge.not_done(docs, load(spark, folder, "labels"), "doc_id")


def first_seen(spark, folder):
    rows = load(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    return merge.first_per_key(rows, "user_id", "event_id")


_SIDES = f"""
stored AS (SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, 'stored' AS fetched FROM customer),
updates AS (SELECT {_KEY} AS id, {_BALANCE} AS balance, {_SEGMENT} AS segment, o_orderkey AS seq FROM orders),
last AS (SELECT id, balance, segment FROM
         (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS r FROM updates) WHERE r = 1)"""

QUERIES = {
    "upsert_replace": Query(
        upsert_replace,
        f"""WITH {_SIDES}
SELECT id, CASE WHEN u.id IS NOT NULL THEN u.balance ELSE s.balance END AS balance,
       CASE WHEN u.id IS NOT NULL THEN u.segment ELSE s.segment END AS segment,
       coalesce(s.fetched, 'updated') AS fetched
FROM stored s FULL JOIN last u USING (id)""",
    ),
    "upsert_coalesce": Query(
        upsert_coalesce,
        f"""WITH {_SIDES},
filled AS (SELECT id, arg_max(balance, seq) FILTER (balance IS NOT NULL) AS balance,
                  arg_max(segment, seq) FILTER (segment IS NOT NULL) AS segment FROM updates GROUP BY id)
SELECT id, coalesce(u.balance, s.balance) AS balance, coalesce(u.segment, s.segment) AS segment, s.fetched AS fetched
FROM stored s FULL JOIN filled u USING (id)""",
    ),
    "child_replace": Query(
        child_replace,
        """SELECT l_orderkey AS parent, l_linenumber AS line, l_quantity AS value FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT o_orderkey, 0, o_totalprice FROM orders WHERE o_orderstatus = 'P'""",
    ),
    "child_replace_batches": Query(
        child_replace_batches,
        """SELECT o_custkey AS parent, o_orderkey AS child, o_totalprice AS value FROM orders
WHERE o_custkey NOT IN (SELECT user_id FROM events)
UNION ALL
SELECT user_id, event_id, value FROM events e
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events x WHERE x.user_id = e.user_id)""",
    ),
    "update_join": Query(
        update_join,
        """WITH found AS (SELECT o_custkey AS id, arg_max(o_totalprice, o_orderkey) AS balance,
                         nullif(arg_max(o_orderpriority, o_orderkey), '5-LOW') AS segment FROM orders GROUP BY 1)
SELECT c_custkey AS id, CASE WHEN f.id IS NULL THEN c_acctbal ELSE f.balance END AS balance,
       CASE WHEN f.id IS NULL THEN c_mktsegment ELSE f.segment END AS segment, 'stored' AS fetched
FROM customer LEFT JOIN found f ON f.id = c_custkey""",
    ),
    "keyword_upsert": Query(
        keyword_upsert,
        """WITH u AS (SELECT s_nationkey + 5 AS id, arg_max(s_name, s_suppkey) AS words FROM supplier GROUP BY 1)
SELECT coalesce(id, n_nationkey) AS cluster_id, coalesce(words, n_name) AS top_keywords,
       CASE WHEN id IS NULL THEN DATE '2024-01-01' ELSE DATE '2025-06-30' END AS updated_at
FROM nation FULL JOIN u ON id = n_nationkey""",
    ),
    "orphans": Query(
        orphans,
        "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
    ),
    "cascade_delete": Query(
        cascade_delete,
        """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'F')""",
    ),
    "cascade_rename": Query(
        cascade_rename,
        """SELECT CASE WHEN o_orderstatus = 'P' THEN l_orderkey + 1000000000 ELSE l_orderkey END AS l_orderkey,
       l_linenumber, l_quantity FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey""",
    ),
    "incremental_skip": Query(
        incremental_skip,
        "SELECT doc_id, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    ),
    "first_seen": Query(
        first_seen,
        """SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
    ),
}
