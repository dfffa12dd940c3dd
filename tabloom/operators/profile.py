"""Counts that describe tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.values import file_title
from tabloom.operators.ranking import top_per_group


def value_counts(rows: DataFrame, columns: list[str], n: int = 10) -> DataFrame:
    """Most frequent values of the columns that exist: ``column, value, n, rank``.

    One pass over the table: columns are unfolded to (column, value) pairs,
    which combine on the map side before they are shuffled.
    """
    present = [c for c in columns if c in rows.columns]
    pairs = rows.select(
        F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in present)))
    ).where(F.col("value").isNotNull())
    counted = pairs.groupBy("column", "value").agg(F.count("*").alias("n"))
    return top_per_group(counted, ["column"], [F.desc("n"), F.asc("value")], n)


def table_shape(rows: DataFrame) -> DataFrame:
    """Row count, column count and filled cells per column, in one scan."""
    filled = [F.count(c).alias(c) for c in rows.columns]
    wide = rows.agg(F.count("*").alias("records"), *filled)
    cells = F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("filled")) for c in rows.columns)))
    return wide.select("records", F.lit(len(rows.columns)).alias("columns"), cells)


def collection_summary(sources: dict[str, DataFrame | None | Exception], paths: dict[str, str] | None = None) -> DataFrame:
    """One row per source file: title, records, columns, size in KB and a status.

    ``None`` stands for a source that was not collected, an exception for one
    that failed. Counts come from the tables, without reading their columns,
    sizes from the files under ``paths``; a source without a path has size 0.
    """
    paths = paths or {}

    def describe(filename: str, rows: DataFrame | None | Exception) -> DataFrame:
        if isinstance(rows, DataFrame):
            counted, width, status = rows.agg(F.count("*").alias("records")), len(rows.columns), "Success"
        else:
            spark = SparkSession.getActiveSession()
            counted, width = spark.range(1).select(F.lit(0).cast("bigint").alias("records")), 0
            status = "Not collected" if rows is None else "Error"
        sized = counted.select("records", F.lit(0).cast("bigint").alias("length"))
        if filename in paths:
            files = counted.sparkSession.read.format("binaryFile").option("pathGlobFilter", "part-*").load(paths[filename])
            sized = sized.unionByName(files.select(F.lit(0).cast("bigint").alias("records"), "length"))
        sized = sized.agg(F.sum("records").alias("records"), F.round(F.sum("length") / 1024, 2).alias("size_kb"))
        return sized.select(
            file_title(F.lit(filename)).alias("source"),
            F.lit(filename).alias("filename"),
            "records",
            F.lit(width).alias("columns"),
            "size_kb",
            F.lit(status).alias("status"),
        )

    return reduce(DataFrame.unionByName, (describe(name, rows) for name, rows in sources.items()))


def collection_totals(summary: DataFrame) -> DataFrame:
    """Sources tried, sources that worked and records in total."""
    worked = F.col("status").contains("Success")
    return summary.agg(
        F.count("*").alias("attempted"),
        F.count_if(worked).alias("successful"),
        F.sum(F.when(worked, F.col("records")).otherwise(0)).alias("total_records"),
    )


def source_sizes(spark: SparkSession, paths: list[str], pattern: str = "*") -> DataFrame:
    """Size of the files under each path in KB; file contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(paths)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("filename"), "length").groupBy("filename").agg(
        F.round(F.sum("length") / 1024, 2).alias("size_kb")
    )


def filled_count(columns: list[str]) -> Column:
    """Number of columns with a value, as an expression."""
    return reduce(
        lambda a, b: a + b,
        (F.coalesce((F.col(c).cast("string") != "").cast("int"), F.lit(0)) for c in columns),
    )


def map_summary(rows: DataFrame, latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    """Total rows, rows with coordinates, and the box around those."""
    lat, lon = F.coalesce(latitude, F.lit(0)), F.coalesce(longitude, F.lit(0))
    placed = ~((lat == 0) & (lon == 0))
    return rows.agg(
        F.count("*").alias("total"),
        F.count_if(placed).alias("plotted"),
        *(
            f(F.when(placed, c)).alias(name)
            for f, c, name in (
                (F.min, lat, "south"), (F.max, lat, "north"), (F.min, lon, "west"), (F.max, lon, "east"),
            )
        ),
    )


def extraction_counts(extracted: DataFrame) -> DataFrame:
    """Documents with and without an id, treatment records and text length of the former.

    Works on the columns of ``fields.extract_documents``.
    """
    has_id = F.col("file_number").isNotNull()
    return extracted.agg(
        F.count_if(has_id).alias("succeeded"),
        F.count_if(~has_id).alias("failed"),
        F.count_if(has_id & F.col("formation").isNotNull()).alias("treatment_records"),
        F.sum(F.when(has_id, F.col("text_length")).otherwise(0)).alias("text_length"),
    )


def mean_times(log: DataFrame, seconds: list[str]) -> DataFrame:
    """Mean milliseconds per implementation and size.

    Implementations in ``seconds`` report seconds, all others milliseconds.
    """
    millis = F.when(F.col("implementation").isin(seconds), F.col("time") * 1000).otherwise(F.col("time"))
    return log.groupBy("implementation", "size").agg(F.avg(millis).alias("millis"), F.count("*").alias("runs"))


def speedups(times: DataFrame, baseline: str) -> DataFrame:
    """Times of every implementation relative to a baseline of the same size."""
    base = times.where(F.col("implementation") == baseline).select("size", F.col("millis").alias("base_millis"))
    return times.join(base, "size").withColumn("speedup", F.try_divide("base_millis", "millis"))
