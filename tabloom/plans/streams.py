"""Streams over the event table, run to the end of the files present."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.functions import text as tx
from tabloom.operators import vectors
from tabloom.plans import Query
from tabloom.plans.texts import DOC_KEYS
from tabloom.session import dealt, load, scratch_dir
from tabloom.streaming import recluster, refresh


def _events(spark, folder, source: str | None = None, files_per_batch: int | None = None):
    schema = load(spark, folder, "events").schema
    if source:
        return refresh.stream_files(spark, source, schema, files_per_batch=files_per_batch)
    return refresh.stream_files(spark, folder, schema, "events.parquet")


def _prepared(batch):
    return batch.select("user_id", "event_id", "event_type", F.coalesce("value", F.lit(0.0)).alias("value"))


def stream_refresh(spark, folder):
    """Latest event per user, from one pass over the file."""
    table, checkpoint = scratch_dir(spark, "users"), scratch_dir(spark, "users-progress")
    refresh.run_refresh(
        lambda: refresh.start_refresh(_events(spark, folder), table, checkpoint, "user_id", "event_id", _prepared)
    )
    return refresh.latest_rows(spark, table, "user_id")


def stream_refresh_batches(spark, folder):
    """The same from many files, three per micro-batch, then compacted."""
    landing, table = scratch_dir(spark, "landing"), scratch_dir(spark, "users")
    checkpoint = scratch_dir(spark, "users-progress")
    ordered = load(spark, folder, "events").repartitionByRange(8, "event_id").sortWithinPartitions("event_id")
    ordered.write.parquet(landing)
    # Files of one batch may arrive in any order, so the event id decides across batches too.
    refresh.run_refresh(
        lambda: refresh.start_refresh(
            _events(spark, folder, landing, 3), table, checkpoint, "user_id", "event_id", _prepared
        )
    )
    refresh.compact(spark, table, "user_id", seq="event_id")
    return refresh.latest_rows(spark, table, "user_id")


def refresh_cycles(spark, folder):
    """Four cycles: files land, are taken in and stored; one cycle fails between, and every second one compacts."""
    landing, table, checkpoint = (scratch_dir(spark, p) for p in ("landing", "users", "users-progress"))
    events = load(spark, folder, "events")

    def cycle(number: int) -> None:
        events.where(F.pmod("event_id", F.lit(4)) == number).write.mode("append").parquet(landing)
        if number == 2:
            raise RuntimeError("taken in by the next cycle")
        refresh.run_refresh(
            lambda: refresh.start_refresh(_events(spark, folder, landing), table, checkpoint, "user_id", "event_id", _prepared)
        )
        if number % 2:
            refresh.compact(spark, table, "user_id", seq="event_id")

    refresh.run_cycles(cycle, times=4, report=lambda _: None)
    return refresh.latest_rows(spark, table, "user_id", seq="event_id")


def recluster_cycles(spark, folder):
    """Four cycles over documents that land a quarter at a time: prepared, stored, clustered, keywords written; one fails between.

    What holds of any clustering is checked: each row lies with its nearest centroid, and
    the keywords written are the most frequent of their cluster.
    """
    landing, table, checkpoint, results = (scratch_dir(spark, p) for p in ("landing", "posts", "posts-progress", "clusters"))
    docs = load(spark, folder, "documents").select("doc_id", "text")
    kept = recluster.Reclustering(spark, table, results, "doc_id", "clean_text", "keywords", restarts=3)

    def prepared(batch):
        clean = batch.withColumn("clean_text", tx.clean_text(F.col("text"))).drop("text")
        return clean.withColumn("keywords", F.concat_ws(",", tx.top_keywords(F.col("clean_text"))))

    def cycle(number: int) -> None:
        dealt(docs.where(F.pmod("doc_id", F.lit(4)) == number)).write.mode("append").parquet(landing)
        if number == 2:
            raise RuntimeError("taken in by the next cycle")
        kept.cycle(lambda: refresh.start_refresh(
            refresh.stream_files(spark, landing, docs.schema), table, checkpoint, "doc_id", "doc_id", prepared, afterwards=kept.absorb
        ))

    refresh.run_cycles(cycle, times=4, report=lambda _: None)
    rows, words, model, centroids = kept.results()
    cells = model.vectorise(rows, "clean_text").select("doc_id", "cluster_id", F.inline(vectors.sparse_entries(F.col("vector"))))
    table = [(c, i, float(m)) for c, row in enumerate(centroids) for i, m in enumerate(row) if m]
    held = F.broadcast(spark.createDataFrame(table, "c int, i int, m double"))  # clusters x features
    products = cells.join(held, "i").groupBy("doc_id", "c").agg(F.sum(F.col("weight") * F.col("m")).alias("p"))
    lengths = F.broadcast(spark.createDataFrame([(c, float(row @ row)) for c, row in enumerate(centroids)], "c int, square double"))
    every = rows.select("doc_id", "cluster_id", F.explode(F.sequence(F.lit(0), F.lit(len(centroids) - 1))).alias("c"))
    gap = F.col("square") - 2 * F.coalesce("p", F.lit(0.0))
    gaps = every.join(lengths, "c").join(products, ["doc_id", "c"], "left").withColumn("gap", gap)
    nearest = gaps.groupBy("doc_id").agg(
        (F.max(F.when(F.col("c") == F.col("cluster_id"), F.col("gap"))) <= F.min("gap") + 1e-9).alias("nearest")
    )
    counts = rows.select("cluster_id", F.explode(F.split("keywords", ",")).alias("keyword")).where("keyword <> ''")
    counts = counts.groupBy("cluster_id", "keyword").agg(F.count("*").alias("m"))
    right = words.join(counts, ["cluster_id", "keyword"], "left").agg(F.bool_and(F.col("n") == F.coalesce("m", F.lit(0))).alias("r"))
    return rows.join(nearest, "doc_id").crossJoin(F.broadcast(right)).select("doc_id", "keywords", "nearest", F.col("r").alias("keywords_right"))


def stream_dedup(spark, folder):
    """First-seen pairs of user and event type."""
    table, checkpoint = scratch_dir(spark, "pairs"), scratch_dir(spark, "pairs-progress")
    refresh.run_refresh(
        lambda: refresh.start_first_seen(
            _events(spark, folder).select("user_id", "event_type"), table, checkpoint, ["user_id", "event_type"]
        )
    )
    return spark.read.parquet(table)


def stream_dedup_watermark(spark, folder):
    """First-seen users over several batches, whose events come back late and in no order of time."""
    landing, table, checkpoint = (scratch_dir(spark, p) for p in ("landing", "seen", "seen-progress"))
    load(spark, folder, "events").repartitionByRange(8, F.xxhash64("event_id")).write.parquet(landing)
    stream = _events(spark, folder, landing, 3).select("user_id")
    refresh.run_refresh(lambda: refresh.start_first_stored(stream, table, checkpoint, ["user_id"]))
    return spark.read.parquet(table).select("user_id")


_LATEST = """SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
  arg_max(coalesce(value, 0), event_id) AS value FROM events GROUP BY 1"""

QUERIES = {
    "stream_refresh": Query(stream_refresh, _LATEST),
    "stream_refresh_batches": Query(stream_refresh_batches, _LATEST),
    "refresh_cycles": Query(refresh_cycles, _LATEST),
    "recluster_cycles": Query(
        recluster_cycles,
        f"""WITH {DOC_KEYS} SELECT doc_id, coalesce(keywords, '') AS keywords, true AS nearest, true AS keywords_right
FROM documents LEFT JOIN keys USING (doc_id)""",
    ),
    "stream_dedup": Query(stream_dedup, "SELECT DISTINCT user_id, event_type FROM events"),
    "stream_dedup_watermark": Query(stream_dedup_watermark, "SELECT DISTINCT user_id FROM events"),
}
