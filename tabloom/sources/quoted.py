"""CSV with quoted line breaks, read in splits.

Whether a line break ends a record depends on the quotes before it. Each split of a file counts its quotes, a running
sum over the splits of the file tells whether a split begins inside quotes, and each split is then cut into records
by itself. Only the records that cross a split are put together again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabloom.session import scratch_dir

_RECORD = "block bigint, number bigint, begun boolean, goes_on boolean, head boolean, text string"
# Splits whose beginnings are shipped to every task; beyond that the lines are sorted by split.
MOST_SPLITS = 1 << 18


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each split, whose lines come in order; a record may have begun before the split or go on after it."""
    now = odd = head = None
    number, waiting = 0, []

    def rows(texts: pa.Array, goes_on: bool) -> pa.RecordBatch:
        at = np.arange(number, number + len(texts))
        begun = (at == 0) & begun_before
        columns = [np.full(len(at), now), at, begun, np.full(len(at), goes_on), (at == 0) & head & ~begun]
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), texts], ["block", "number", "begun", "goes_on", "head", "text"])

    def joined(bounds: np.ndarray, lines: pa.Array) -> pa.Array:
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), lines.slice(0, int(bounds[-1]))), "\n")

    for batch in batches:
        block, quotes = batch.column("block").to_numpy(), batch.column("quotes").to_numpy()
        edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for first, end in zip(edges, edges[1:]):
            if first == end:
                continue
            if block[first] != now:
                if waiting:
                    lines = pa.concat_arrays(waiting)
                    yield rows(joined(np.array([0, len(lines)]), lines), True)
                now, number, waiting = int(block[first]), 0, []
                odd, head = batch.column("open")[first].as_py(), batch.column("start")[first].as_py() == 0
                begun_before = odd == 1
            inside = (odd + np.cumsum(quotes[first:end])) % 2
            odd = int(inside[-1])
            waiting.append(batch.column("value").slice(first, end - first))
            ends = np.flatnonzero(inside == 0)
            if len(ends):
                lines = pa.concat_arrays(waiting)
                bounds = np.append(0, ends + 1 + len(lines) - (end - first))
                yield rows(joined(bounds, lines), False)
                number += len(ends)
                waiting = [lines.slice(int(bounds[-1]))] if bounds[-1] < len(lines) else []
    if waiting:
        lines = pa.concat_arrays(waiting)
        yield rows(joined(np.array([0, len(lines)]), lines), True)


def read_quoted_csv(spark: SparkSession, path: str, schema: StructType | str, most_splits: int = MOST_SPLITS) -> DataFrame:
    """Headered CSV whose fields may hold quoted line breaks, in as many tasks as its bytes ask for.

    For files in the common form: quotes only around whole fields, and doubled inside them; others need
    :func:`tabloom.sources.files.read_csv` with ``multi_line``, one task per file. A field may be longer than a split. Blank lines are
    skipped, the first record of each file is its header. The quotes are counted when this is called; the rows are
    read twice, the second time only for records that cross splits.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    lines = lines.withColumn("quotes", (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).cast("long"))
    lines = lines.withColumn("block", F.xxhash64("file", "start"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    counted = lines.groupBy("file", "start", "block").agg(F.sum("quotes").alias("quotes"))
    opened = counted.withColumn("open", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).drop("quotes")
    folder = scratch_dir(spark, "csv-splits")
    opened.write.parquet(folder)
    splits = spark.read.schema("file string, start long, block long, open long").parquet(folder)
    few = splits.count() <= most_splits
    known = splits.select("block", "open")
    # The state at a split's beginning is the file's; splits that were dealt anew since have none and end the job.
    found = F.coalesce("open", F.raise_error(F.lit("the splits of the files have changed")).cast("long")).alias("open")
    columns = ["block", "start", "quotes", found, "value"]
    if few:
        ordered = lines.join(F.broadcast(known), "block", "left").select(*columns)
    else:
        placed = lines.withColumn("line", F.monotonically_increasing_id()).join(known, "block", "left")
        ordered = placed.repartition("block").sortWithinPartitions("block", "line").select(*columns)
    records = ordered.mapInArrow(_records, _RECORD)
    whole = records.where("not begun and not goes_on and not head").select("text")
    pieces = records.where("begun or goes_on").join(splits.select("block", "file", "start"), "block")
    so_far = Window.partitionBy("file").orderBy("start", "number")
    pieces = pieces.withColumn("record", F.sum((~F.col("begun")).cast("int")).over(so_far))
    together = pieces.groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("start", "number", "text"))).alias("p"), F.bool_or("head").alias("head")
    )
    together = together.where("not head").select(F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"))
    text = F.regexp_replace("text", r"\r\z", "")
    ddl = schema if isinstance(schema, str) else schema.toDDL()
    rows = whole.unionByName(together).select(text.alias("text")).where("text <> ''")
    return rows.select(F.from_csv("text", ddl, {"escape": '"', "multiLine": "true"}).alias("c")).select("c.*")
