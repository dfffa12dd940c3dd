"""Matrices and grids built from the order tables; all sums are exact integers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import linalg
from tabloom.plans import Query
from tabloom.session import dealt_by, load

KERNEL = [[-1.0, -2.0, -1.0], [0.0, 1.0, 0.0], [1.0, 2.0, 3.0]]
WIDE_KERNEL = [[float(i * 5 + j - 12) for j in range(5)] for i in range(5)]


def _left(spark, folder):
    """Supplier x part: quantity supplied."""
    lines = dealt_by(load(spark, folder, "lineitem"), "l_suppkey", "l_partkey")
    return lines.groupBy(F.col("l_suppkey").alias("row"), F.col("l_partkey").alias("col")).agg(F.sum("l_quantity").alias("v"))


def _right(spark, folder):
    """Part x month of shipping: number of lines."""
    month = F.expr("CAST((year(l_shipdate) - 1990) * 12 + month(l_shipdate) AS BIGINT)")
    lines = load(spark, folder, "lineitem").select(F.col("l_partkey").alias("row"), month.alias("col"))
    return dealt_by(lines, "row", "col").groupBy("row", "col").agg(F.count("*").cast("double").alias("v"))


def coo_matmul(spark, folder):
    return linalg.multiply(_left(spark, folder), _right(spark, folder))


def block_matmul(spark, folder):
    # one cell per order line: a supplier and part come many times and add up
    lines = load(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("row"), F.col("l_partkey").alias("col"), F.col("l_quantity").alias("v")
    )
    return linalg.block_multiply(lines, _right(spark, folder), size=128)


def _side(spark, folder) -> int:
    """Side of the smallest square that holds one pixel per order."""
    last = load(spark, folder, "orders").agg(F.max("o_orderkey")).head()[0]
    return int(last**0.5) + 1


def _image(spark, folder, side: int):
    """Order totals as grey values, row by row."""
    return load(spark, folder, "orders").select(
        F.floor(F.col("o_orderkey") / side).alias("y"), F.pmod("o_orderkey", F.lit(side)).alias("x"),
        F.pmod(F.col("o_totalprice").cast("bigint"), F.lit(256)).cast("double").alias("v"),
    )


def stencil(spark, folder):
    side = _side(spark, folder)
    return linalg.filter_grid(_image(spark, folder, side), KERNEL, side, tile=64)


def wide_stencil(spark, folder):
    side = _side(spark, folder)
    return linalg.filter_grid(_image(spark, folder, side), WIDE_KERNEL, side)


_PRODUCT = """
WITH a AS (SELECT l_suppkey AS row, l_partkey AS k, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
b AS (SELECT l_partkey AS k, CAST((year(l_shipdate) - 1990) * 12 + month(l_shipdate) AS BIGINT) AS col, count(*)::DOUBLE AS v
      FROM lineitem GROUP BY 1, 2)
SELECT a.row, b.col, sum(a.v * b.v) AS v FROM a JOIN b USING (k) GROUP BY 1, 2"""


def _stencil_sql(kernel: list[list[float]]) -> str:
    half = len(kernel) // 2
    taps = ", ".join(
        f"({i - half}, {j - half}, {w}::DOUBLE)" for i, line in enumerate(kernel) for j, w in enumerate(line)
    )
    return f"""
WITH size AS (SELECT CAST(floor(sqrt(max(o_orderkey))) AS BIGINT) + 1 AS m FROM orders),
image AS (SELECT o_orderkey // m AS y, o_orderkey % m AS x, (trunc(o_totalprice)::BIGINT % 256)::DOUBLE AS v FROM orders, size),
kernel(dy, dx, w) AS (VALUES {taps}),
sums AS (SELECT i.y - dy AS y, i.x - dx AS x, sum(i.v * w) AS v FROM image i, kernel GROUP BY 1, 2),
grid AS (SELECT a.i AS y, b.i AS x FROM size, generate_series(0, m - 1) AS a(i), generate_series(0, m - 1) AS b(i))
SELECT g.y, g.x, coalesce(s.v, 0) AS v FROM grid g LEFT JOIN sums s USING (y, x)"""


QUERIES = {
    "coo_matmul": Query(coo_matmul, _PRODUCT),
    "block_matmul": Query(block_matmul, _PRODUCT),
    "stencil": Query(stencil, _stencil_sql(KERNEL)),
    "wide_stencil": Query(wide_stencil, _stencil_sql(WIDE_KERNEL)),
}
