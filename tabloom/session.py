"""Session set-up, table loading and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tabloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are planned for.

    On a cluster leave ``master`` unset and size ``spark.sql.shuffle.partitions``
    to the data (AQE coalesces what is too fine).
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Stream state may outgrow the heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # Small tables are read by every core; large scans are split by size alone.
        "spark.sql.files.openCostInBytes": str(1 << 20),
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{table}.parquet")


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of a few large files dealt to all cores; a table with as many partitions as cores stays as it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def spread(rows: DataFrame) -> DataFrame:
    """Short rows that much work follows, dealt evenly: a compact file may be one split or one row group, so one task."""
    spark = rows.sparkSession
    return rows.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def dealt_by(rows: DataFrame, *keys: str, part: int = 1 << 18) -> DataFrame:
    """Rows that are about to be grouped by keys that seldom repeat, dealt by these into parts of about ``part`` rows.

    Without it each task of the scan would first hold the groups of its whole split, and merge next to none.
    """
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // part))
    return rows.repartition(parts, *keys)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written tables and stream checkpoints.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Only a
    local session without that setting falls back to a temporary folder;
    a cluster session without it is refused, as executors could not share it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tabloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
