import os
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tabloom.streaming import refresh

SCHEMA = "id bigint, seq bigint, v string"


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def state(spark, table):
    return sorted(map(tuple, refresh.latest_rows(spark, table, "id").collect()))


def test_batches_keep_the_latest_and_resume_at_the_checkpoint(spark, tmp_path):
    folder, table, mark = (str(tmp_path / n) for n in ("in", "table", "mark"))
    land(spark, folder, [(1, 1, "a"), (1, 2, "b"), (2, 1, "c")])

    def start():
        return refresh.start_refresh(refresh.stream_files(spark, folder, SCHEMA), table, mark, "id", "seq")

    refresh.run_refresh(start)
    assert state(spark, table) == [(1, 2, "b"), (2, 1, "c")]
    land(spark, folder, [(2, 5, "d"), (3, 1, "e")])
    refresh.run_refresh(start)
    assert state(spark, table) == [(1, 2, "b"), (2, 5, "d"), (3, 1, "e")]
    # Only the new file was read the second time.
    assert spark.read.parquet(table).where("batch_id = 1").count() == 2
    refresh.compact(spark, table, "id")
    assert state(spark, table) == [(1, 2, "b"), (2, 5, "d"), (3, 1, "e")]
    assert [r["batch_id"] for r in spark.read.parquet(table).select("batch_id").distinct().collect()] == [-1]
    land(spark, folder, [(3, 9, "f")])
    refresh.run_refresh(start)
    refresh.compact(spark, table, "id")
    assert state(spark, table) == [(1, 2, "b"), (2, 5, "d"), (3, 9, "f")]


def test_cycles_go_on_after_a_failure():
    seen, reports = [], []

    def cycle(number):
        seen.append(number)
        if number == 1:
            raise ValueError("once")

    assert refresh.run_cycles(cycle, times=4, report=reports.append) == 3
    assert seen == [0, 1, 2, 3] and reports == ["refresh cycle 1 failed: once"]


def test_failed_batch_is_reported_and_run_again(spark, tmp_path):
    folder, table, mark = (str(tmp_path / n) for n in ("in", "table", "mark"))
    land(spark, folder, [(1, 1, "a")])
    tries, reports = [], []

    def prepare(batch):
        tries.append(1)
        if len(tries) == 1:
            raise RuntimeError("no luck")
        return batch.withColumn("v", F.upper("v"))

    def start():
        return refresh.start_refresh(refresh.stream_files(spark, folder, SCHEMA), table, mark, "id", "seq", prepare)

    refresh.run_refresh(start, report=reports.append)
    assert state(spark, table) == [(1, 1, "A")] and len(reports) == 1 and "no luck" in reports[0]
    land(spark, folder, [(2, 2, "b")])
    tries.clear()
    with pytest.raises(Exception, match="no luck"):
        refresh.run_refresh(start, attempts=1, report=reports.append)


def test_first_seen_across_files(spark, tmp_path):
    folder, table, mark = (str(tmp_path / n) for n in ("in", "table", "mark"))
    land(spark, folder, [(1, 1, "a"), (1, 2, "b")])

    def start():
        stream = refresh.stream_files(spark, folder, SCHEMA, files_per_batch=1).select("id")
        return refresh.start_first_seen(stream, table, mark, ["id"])

    refresh.run_refresh(start)
    land(spark, folder, [(1, 3, "c"), (2, 1, "d")])
    refresh.run_refresh(start)
    assert sorted(r["id"] for r in spark.read.parquet(table).collect()) == [1, 2]


def test_first_stored_takes_late_keys_once(spark, tmp_path):
    folder, table, mark = (str(tmp_path / n) for n in ("in", "table", "mark"))
    for rows in ([(1, 100, "a"), (2, 2000, "b")], [(3, 200, "c"), (4, 2100, "d"), (1, 2100, "e")], [(3, 1, "f")]):
        land(spark, folder, rows)
        refresh.run_refresh(lambda: refresh.start_first_stored(
            refresh.stream_files(spark, folder, SCHEMA).select("id"), table, mark, ["id"]))
    assert sorted(r["id"] for r in spark.read.parquet(table).collect()) == [1, 2, 3, 4]


def sizes(frame):
    return sum(os.path.getsize(urlparse(f).path) for f in frame.inputFiles())


def test_bytes_of_stored_keys_follow_the_batch(spark, tmp_path):
    folder, table, mark = (str(tmp_path / n) for n in ("in", "table", "mark"))

    def run():
        refresh.run_refresh(lambda: refresh.start_first_stored(
            refresh.stream_files(spark, folder, SCHEMA).select("id"), table, mark, ["id"], buckets=32))

    spark.range(20_000).selectExpr("id", "1L as seq", "'a' as v").coalesce(2).write.parquet(folder)
    run()
    whole = sizes(spark.read.parquet(table))

    def keyed(ids):
        fresh = spark.createDataFrame([(i,) for i in ids], "id long").withColumn("key_hash", F.xxhash64("id"))
        return fresh.withColumn("bucket", F.pmod("key_hash", F.lit(32)).cast("int"))

    few = refresh.stored_keys(keyed([5, 70_000]), table, ["id"], 9)
    assert 0 < sizes(few) < whole / 10
    assert sorted(r["id"] for r in few.collect()) == [5]
    plan = few._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "key_hash" in plan.split("PushedFilters")[1]
    many = refresh.stored_keys(keyed(range(19_000, 21_000)), table, ["id"], 9)
    assert sizes(many) == whole and many.count() == 20_000
    assert refresh.stored_keys(keyed([5]), table, ["id"], 0).count() == 0

    land(spark, folder, [(5, 1, "a"), (70_000, 1, "b"), (None, 1, "c")])
    run()
    land(spark, folder, [(None, 2, "c"), (70_000, 2, "d"), (70_001, 2, "e")])
    run()
    ids = [r["id"] for r in spark.read.parquet(table).collect()]
    assert sorted(ids, key=lambda x: (x is None, x)) == [*range(20_000), 70_000, 70_001, None]
