"""Periodic refresh as Structured Streaming.

A refresh appends what a micro-batch changed and leaves the rest of the table
alone, so its cost follows the batch and not the table. Each batch
writes its own ``batch_id=`` folder; a batch that is replayed after a
failure overwrites that folder with the same rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabloom.operators.merge import last_per_key

# Folders that stored keys are dealt to, and keys of a batch up to which their hashes are named to the scan.
BUCKETS, LISTED = 64, 400


def stream_files(
    spark: SparkSession, folder: str, schema, pattern: str = "*", files_per_batch: int | None = None,
    kind: str = "parquet",
) -> DataFrame:
    """New files of a folder as a stream; the checkpoint remembers those done."""
    reader = spark.readStream.schema(schema).format(kind).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def start_refresh(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    key: str,
    seq: str | list[str],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    interval_seconds: float | None = None,
    afterwards: Callable[[SparkSession, int], None] | None = None,
) -> StreamingQuery:
    """Keep the latest row per key of a stream.

    ``prepare`` works on each batch before it is stored (cleaning, say),
    ``afterwards`` on the stored table (clustering, say).

    With ``interval_seconds`` (at least 10) the query runs for ever,
    without it every file present is taken and the query ends.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        last_per_key(rows, key, seq).write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")
        if afterwards:
            afterwards(batch.sparkSession, batch_id)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if interval_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{max(10.0, interval_seconds)} seconds").start()


def run_refresh(start: Callable[[], StreamingQuery], attempts: int = 3, report=print) -> None:
    """Run a refresh to its end, reporting a failure and resuming at the checkpoint."""
    for attempt in range(1, attempts + 1):
        try:
            start().awaitTermination()
            return
        except Exception as problem:
            report(f"refresh attempt {attempt} failed: {problem}")
            if attempt == attempts:
                raise


def latest_rows(spark: SparkSession, table: str, key: str, seq: str = "batch_id") -> DataFrame:
    """Current state of a refreshed table: one row per key.

    The newest batch wins, or the highest ``seq`` where batches may arrive out of order.
    """
    return last_per_key(spark.read.parquet(table), key, seq).drop("batch_id")


def compact(spark: SparkSession, table: str, key: str, seq: str = "batch_id") -> None:
    """Replace the batch folders of a table by one with its current state; a refresh goes on with the same table.

    The state is written beside the table's folders and joins them below all others, so it never outranks a batch.
    Then the old folders go from the oldest on: whatever is left when this breaks off still gives the
    same state, and the next compaction finishes the work.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(table)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = (s.getPath().getName() for s in files.listStatus(root))
    ids = sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))
    lowest = min(ids[0], 0) - 1
    written = f"{table}/_compact{lowest}"
    latest_rows(spark, table, key, seq).write.mode("overwrite").parquet(written)
    if not files.rename(hadoop.Path(written), hadoop.Path(f"{table}/batch_id={lowest}")):
        raise OSError(f"cannot place the compacted batch in {table}")
    for i in ids:
        files.delete(hadoop.Path(f"{table}/batch_id={i}"), True)


def run_cycles(cycle: Callable[[int], None], times: int | None = None, interval_seconds: float = 0.0, report=print) -> int:
    """Run a refresh cycle (take in, prepare, store, recluster) again and again; returns how many worked.

    A failed cycle is reported and the next one starts on time; what it left undone lies before the
    stream's checkpoint and is taken in then. Without ``times`` it runs for ever.
    """
    worked = number = 0
    while times is None or number < times:
        due = time.monotonic() + interval_seconds
        try:
            cycle(number)
            worked += 1
        except Exception as problem:
            report(f"refresh cycle {number} failed: {problem}")
        number += 1
        if number != times:
            time.sleep(max(0.0, due - time.monotonic()))
    return worked


def start_first_seen(stream: DataFrame, table: str, checkpoint: str, keys: list[str]) -> StreamingQuery:
    """Write each key the first time it appears, however late. State grows with the number of keys."""
    return (
        stream.dropDuplicates(keys).writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_keys(fresh: DataFrame, table: str, keys: list[str], batch_id: int, listed: int = LISTED) -> DataFrame | None:
    """The keys of earlier batches in the buckets of ``fresh``; None where these are empty.

    Only the folders of these buckets are listed and read. A batch of up to ``listed`` keys names their hashes, so that
    row groups without them are passed over by their range or their Bloom filter.
    """
    spark = fresh.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(table).getFileSystem(spark._jsc.hadoopConfiguration())
    # at most as many as there are buckets
    folders = [f"{table}/bucket={r[0]}" for r in fresh.select("bucket").distinct().collect()]
    folders = [f for f in folders if files.exists(hadoop.Path(f))]
    if not folders:
        return None
    known = spark.read.option("basePath", table).parquet(*folders).where(F.col("batch_id") < batch_id)
    hashes = [r[0] for r in fresh.select("key_hash").limit(listed + 1).collect()]
    if len(hashes) <= listed:
        # the session of a running stream is its own
        spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(listed))
        known = known.where(F.col("key_hash").isin(hashes))
    return known.select(*keys)


def start_first_stored(stream: DataFrame, table: str, checkpoint: str, keys: list[str], buckets: int = BUCKETS) -> StreamingQuery:
    """The same without stream state: each batch is compared with the keys the table has.

    Keys lie in ``buckets`` folders by their hash, sorted by it and with a Bloom filter, so that a batch reads what its own keys
    may be in, however large the table is. A batch writes folders of its own inside the buckets, and a replayed one does not count as known,
    so it writes the same rows again. Null is a key like any other. The table has ``key_hash``, ``bucket`` and ``batch_id`` besides.
    """

    def keep_new(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.dropDuplicates(keys).withColumn("key_hash", F.xxhash64(*keys))
        fresh = fresh.withColumn("bucket", F.pmod("key_hash", F.lit(buckets)).cast("int")).persist()
        try:
            known, new = stored_keys(fresh, table, keys, batch_id), fresh
            if known is not None:
                known = known.select(*[F.col(k).alias(f"_known{i}") for i, k in enumerate(keys)])
                same = [F.col(k).eqNullSafe(F.col(f"_known{i}")) for i, k in enumerate(keys)]
                new = fresh.join(known, same, "left_anti")
            (
                new.withColumn("batch_id", F.lit(batch_id)).repartition("bucket").sortWithinPartitions("bucket", "key_hash")
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .option("parquet.bloom.filter.enabled#key_hash", "true")
                .partitionBy("bucket", "batch_id").parquet(table)
            )
        finally:
            fresh.unpersist()

    writer = stream.writeStream.foreachBatch(keep_new).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
