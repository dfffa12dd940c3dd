"""File and stored-table scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = True
) -> DataFrame | None:
    """Headered CSV, ``None`` where the path is missing.

    Quoted line breaks need ``multi_line``, which reads a file in one task; sources without them say so and
    large files are split. Without a schema the types are inferred, which costs an extra pass.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    try:
        return reader.csv(path)
    except AnalysisException:
        return None


def document_files(spark: SparkSession, folder: str) -> DataFrame:
    """Name, path and size of the PDF files of a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("filename"), "path", "length")


def joined_pages(pages: DataFrame, doc: str, page: str, text: str) -> DataFrame:
    """The whole text of each document: its page texts joined by line breaks in page order, with the length.

    Page numbers are unique within a document. A document is one value, so its pages meet in one task.
    """
    filled = pages.where(F.col(text) != "")
    grouped = filled.groupBy(doc).agg(F.sort_array(F.collect_list(F.struct(page, text))).alias("_pages"))
    whole = F.array_join(F.transform("_pages", lambda p: p[text]), "\n")
    return grouped.select(doc, whole.alias("text")).withColumn("text_length", F.length("text"))


def engaged_posts(posts: DataFrame) -> DataFrame:
    """Stored posts with a comment page and any engagement, newest first."""
    return posts.where(
        F.col("permalink").isNotNull()
        & F.col("permalink").contains("/comments/")
        & ((F.col("score") > 0) | (F.col("num_comments") > 0))
    ).orderBy(F.desc("created_utc"))


def needs_enrichment(rows: DataFrame, status: str) -> DataFrame:
    """Rows whose status was never filled."""
    return rows.where(F.col(status).isNull() | (F.col(status) == "N/A"))


def benchmark_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """``implementation, size, repeats, time`` of the log lines that start with CSV."""
    parts = F.split(value, ",")
    return lines.where(F.col(value).startswith("CSV")).select(
        F.get(parts, F.lit(1)).alias("implementation"),
        F.get(parts, F.lit(2)).try_cast("int").alias("size"),
        F.get(parts, F.lit(3)).try_cast("int").alias("repeats"),
        F.get(parts, F.lit(4)).try_cast("double").alias("time"),
    )
