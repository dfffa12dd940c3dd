"""Counts and summaries of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import profile, ranking
from tabloom.plans import Query
from tabloom.session import load, scratch_dir
from tabloom.sources import files

_TABLES = ("customer", "orders", "lineitem", "part", "documents")


def value_counts(spark, folder):
    rows = load(spark, folder, "part")
    counts = profile.value_counts(rows, ["p_brand", "p_type", "p_size", "no_such_column"])
    return counts.select("column", "value", "n", F.col("rank").cast("bigint").alias("rank"))


def line_value_counts(spark, folder):
    rows = load(spark, folder, "lineitem")
    counts = profile.value_counts(rows, ["l_partkey", "l_suppkey", "l_quantity", "l_returnflag"], 3)
    return counts.select("column", "value", "n", F.col("rank").cast("bigint").alias("rank"))


def table_shape(spark, folder):
    rows = load(spark, folder, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return profile.table_shape(rows.select("o_orderkey", "o_orderpriority", "status"))


def _summary(spark, folder):
    """Whole tables as collected CSV files, one source that was not collected and one that failed."""
    paths, sources = {}, {}
    for table in _TABLES:
        paths[f"{table}_rows.csv"] = path = scratch_dir(spark, f"{table}-rows")
        rows = load(spark, folder, table)
        rows.write.option("header", True).option("escape", '"').csv(path)
        sources[f"{table}_rows.csv"] = files.read_csv(spark, path, rows.schema)
    sources |= {"web_posts.csv": None, "broken_feed.csv": ValueError("unreadable")}
    return profile.collection_summary(sources, paths)


def collection_summary(spark, folder):
    """The summary; file sizes only as present or not, as they depend on the writer (a unit test has the sizes)."""
    return _summary(spark, folder).withColumn("sized", F.col("size_kb") > 0).drop("size_kb")


def collection_totals(spark, folder):
    return profile.collection_totals(_summary(spark, folder))


def successful_sources(spark, folder):
    return _summary(spark, folder).where(F.col("status").contains("Success")).select("source")


def document_scan(spark, folder):
    """Folder scan: files by extension, without reading them. Texts are written as one ``.pdf`` folder per language, others beside it.

    Encoded texts have one line each, so the bytes of a language's files follow from the texts.
    """
    path = scratch_dir(spark, "scans")
    rows = load(spark, folder, "documents").select("lang", F.base64(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("body"))
    plain = rows.withColumn("body", F.regexp_replace("body", r"\s", ""))
    plain.write.partitionBy("lang").option("extension", "pdf").option("emptyValue", "").csv(path)
    plain.groupBy("lang").count().write.partitionBy("lang").mode("append").csv(path)  # files the scan has to pass over
    found = files.document_files(spark, path).withColumn("lang", F.nullif(F.regexp_extract("path", "lang=([^/]*)/", 1), F.lit("__HIVE_DEFAULT_PARTITION__")))
    return found.groupBy("lang").agg(
        F.sum("length").alias("bytes"), F.bool_and(F.lower("filename").endswith(".pdf")).alias("documents_only")
    )


def top_orders(spark, folder):
    rows = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ranking.top_rows(rows, [F.desc("o_totalprice"), F.asc("o_orderkey")], 5)


def first_rows(spark, folder):
    return ranking.top_rows(load(spark, folder, "part").select("p_partkey", "p_name"), [F.asc("p_partkey")], 5)


def top_per_customer(spark, folder):
    rows = load(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return ranking.top_per_group(rows, ["o_custkey"], order, 3).withColumn("rank", F.col("rank").cast("bigint"))


def field_fill(spark, folder):
    rows = load(spark, folder, "customer").select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("well_status"),
        F.expr("CASE WHEN c_nationkey < 5 THEN '' ELSE c_name END").alias("well_type"),
        F.expr("CASE WHEN c_acctbal > 0 THEN c_acctbal END").alias("oil_produced"),
    )
    found = profile.filled_count(["well_status", "well_type", "oil_produced"])
    return rows.select("c_custkey", found.alias("found"))


def mappable_summary(spark, folder):
    rows = load(spark, folder, "supplier").select(
        F.expr("CASE WHEN s_nationkey < 5 THEN NULL WHEN s_nationkey < 8 THEN 0 ELSE 45 + s_nationkey / 10.0D END").alias("latitude"),
        F.expr("CASE WHEN s_nationkey < 6 THEN 0 WHEN s_nationkey < 9 THEN NULL ELSE -100 - s_nationkey / 10.0D END").alias("longitude"),
    )
    return profile.map_summary(rows)


def _log(spark, folder):
    """One log line per order line, every other kind of line marked as noise."""
    line = """concat(CASE l_linestatus WHEN 'O' THEN 'CSV,' ELSE 'GPU execution time,' END, CASE l_returnflag WHEN 'A' THEN 'CPU'
      WHEN 'N' THEN 'GPU_TILED' ELSE 'GPU_NAIVE' END, ',', l_linenumber * 512, ',', CAST(l_quantity AS INT), ',', CAST(l_extendedprice AS DECIMAL(12,2)))"""
    return files.benchmark_log(load(spark, folder, "lineitem").select(F.expr(line).alias("value")))


def bench_log(spark, folder):
    return _log(spark, folder).groupBy("implementation", "size").agg(
        F.count("*").alias("lines"), F.sum("repeats").alias("repeats"), F.max("time").alias("slowest")
    )


def bench_speedup(spark, folder):
    rows = profile.speedups(profile.mean_times(_log(spark, folder), ["CPU"]), "CPU")
    return rows.select("implementation", "size", "runs", F.round("millis", 4).alias("millis"), F.round("speedup", 6).alias("speedup"))


_COUNTED = """
pairs AS ({pairs}), counted AS (SELECT "column", value, count(*) AS n FROM pairs GROUP BY 1, 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM counted) WHERE rank <= {n}"""


def _pairs(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM {table}" for c in columns)


_SUMMARY_SQL = "summary AS (" + " UNION ALL ".join(
    f"""SELECT '{t.title()} Rows' AS source, '{t}_rows.csv' AS filename, count(*) AS records,
  (SELECT count(*) FROM (DESCRIBE {t}))::INTEGER AS columns, 'Success' AS status, true AS sized FROM {t}"""
    for t in _TABLES
) + """ UNION ALL SELECT 'Web Posts', 'web_posts.csv', 0, 0, 'Not collected', false
UNION ALL SELECT 'Broken Feed', 'broken_feed.csv', 0, 0, 'Error', false)"""
_LOG_SQL = """log AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'CPU' WHEN 'N' THEN 'GPU_TILED' ELSE 'GPU_NAIVE' END AS implementation,
         l_linenumber * 512 AS size, CAST(l_quantity AS INTEGER) AS repeats, l_extendedprice AS time
  FROM lineitem WHERE l_linestatus = 'O')"""

QUERIES = {
    "value_counts": Query(
        value_counts, "WITH " + _COUNTED.format(pairs=_pairs("part", ["p_brand", "p_type", "p_size"]), n=10)
    ),
    "line_value_counts": Query(
        line_value_counts,
        "WITH " + _COUNTED.format(pairs=_pairs("lineitem", ["l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]), n=3),
    ),
    "table_shape": Query(
        table_shape,
        """SELECT (SELECT count(*) FROM orders) AS records, 3 AS columns, unnest(['o_orderkey', 'o_orderpriority', 'status']) AS "column",
  unnest([count(o_orderkey), count(o_orderpriority), count(nullif(o_orderstatus, 'P'))]) AS filled FROM orders""",
    ),
    "collection_summary": Query(collection_summary, f"WITH {_SUMMARY_SQL} SELECT * FROM summary"),
    "collection_totals": Query(
        collection_totals,
        f"""WITH {_SUMMARY_SQL} SELECT count(*) AS attempted, count(*) FILTER (status = 'Success') AS successful,
  CAST(sum(records) AS BIGINT) AS total_records FROM summary""",
    ),
    "successful_sources": Query(
        successful_sources, f"WITH {_SUMMARY_SQL} SELECT source FROM summary WHERE status = 'Success'"
    ),
    "document_scan": Query(
        document_scan,
        """SELECT lang, CAST(sum(length(base64(encode(coalesce(text, '')))) + 1) AS BIGINT) AS bytes, true AS documents_only
FROM documents GROUP BY 1""",
    ),
    "top_orders": Query(
        top_orders, "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5"
    ),
    "first_rows": Query(first_rows, "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 5"),
    "top_per_customer": Query(
        top_per_customer,
        """SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3""",
    ),
    "field_fill": Query(
        field_fill,
        """SELECT c_custkey, (c_mktsegment <> 'BUILDING')::INTEGER + (c_nationkey >= 5)::INTEGER + (c_acctbal > 0)::INTEGER AS found
FROM customer""",
    ),
    "mappable_summary": Query(
        mappable_summary,
        """WITH t AS (SELECT coalesce(CASE WHEN s_nationkey < 8 THEN 0 ELSE 45 + s_nationkey / 10::DOUBLE END, 0) AS lat,
  coalesce(CASE WHEN s_nationkey < 9 THEN 0 ELSE -100 - s_nationkey / 10::DOUBLE END, 0) AS lon FROM supplier)
SELECT (SELECT count(*) FROM t) AS total, count(*) AS plotted, min(lat) AS south, max(lat) AS north, min(lon) AS west, max(lon) AS east
FROM t WHERE NOT (lat = 0 AND lon = 0)""",
    ),
    "bench_log": Query(
        bench_log,
        f"""WITH {_LOG_SQL} SELECT implementation, size, count(*) AS lines, CAST(sum(repeats) AS BIGINT) AS repeats,
  max(time) AS slowest FROM log GROUP BY 1, 2""",
    ),
    "bench_speedup": Query(
        bench_speedup,
        f"""WITH {_LOG_SQL}, times AS (
  SELECT implementation, size, count(*) AS runs, avg(CASE implementation WHEN 'CPU' THEN time * 1000 ELSE time END) AS millis
  FROM log GROUP BY 1, 2)
SELECT t.implementation, size, t.runs, round(t.millis, 4) AS millis, round(b.millis / t.millis, 6) AS speedup
FROM times t JOIN times b USING (size) WHERE b.implementation = 'CPU'""",
    ),
}
