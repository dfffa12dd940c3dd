"""Compact tables that much work follows are dealt to every core, whatever their files and row groups."""

import pytest
from pyspark.sql import functions as F

from tabloom.plans import fields, ingest, matrices
from tabloom.session import dealt_by


@pytest.fixture(scope="module")
def customers(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("customers")
    rows = spark.range(400).select(
        F.col("id").alias("c_custkey"), F.concat(F.lit("Name "), "id").alias("c_name"), (F.col("id") % 25).cast("int").alias("c_nationkey"),
        F.lit(1.0).alias("c_acctbal"), F.lit("MACHINERY").alias("c_mktsegment"),
    )
    rows.coalesce(1).write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def shares(rows):
    return sorted(r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_well_pages_of_one_file_are_read_by_every_core(spark, customers):
    found = shares(ingest.kv_page_fields(spark, customers))
    assert len(found) >= spark.sparkContext.defaultParallelism and found[-1] <= 2 * found[0]


@pytest.mark.parametrize("query", [ingest.forum_posts, ingest.forum_listing])
def test_forum_pages_of_one_file_are_parsed_by_every_core(spark, customers, query):
    found = shares(query(spark, customers))
    assert len(found) >= spark.sparkContext.defaultParallelism and found[-1] <= 2 * found[0]


@pytest.mark.parametrize("query", [fields.well_extract, fields.cleaned_wells])
def test_documents_of_one_file_are_searched_by_every_core(spark, customers, query):
    found = shares(query(spark, customers))
    assert len(found) >= spark.sparkContext.defaultParallelism and found[-1] <= 2 * found[0]


def test_parts_follow_the_number_of_rows(spark):
    rows = spark.range(4000).selectExpr("id AS a", "id % 7 AS b").coalesce(1)
    found = shares(dealt_by(rows, "a", "b", part=100))
    assert len(found) == 40 and found[-1] < 200
    assert len(shares(dealt_by(rows, "a"))) == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("side", [matrices._left, matrices._right])
def test_cells_are_not_grouped_in_the_tasks_of_the_scan(spark, tmp_path, side):
    lines = spark.range(50).selectExpr("id % 5 AS l_suppkey", "id % 3 AS l_partkey", "1.0D AS l_quantity", "timestamp'1995-01-02' AS l_shipdate")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    plan = side(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.rindex("HashAggregate") < plan.index("Exchange")
