"""First-N, precedence unions and fallbacks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.merge import first_per_key


def top_per_group(rows: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of each group, numbered from 1.

    Spark plans a group limit below the exchange: each task hands on
    at most ``n`` rows per group, whatever the group's size.
    """
    over = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(over)).where(F.col(rank) <= n)


def top_rows(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows overall, none for ``n <= 0``."""
    return rows.orderBy(*order).limit(max(n, 0))


def stacked(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts; columns a part lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def precedence_union(
    parts: list[DataFrame], key: str, position: list[str], target_count: int | None = None
) -> DataFrame:
    """Union in which the earliest sighting of a key wins.

    ``parts`` are ordered by precedence, ``position`` orders rows in a part.
    With ``target_count`` the first that many distinct keys stay.
    """
    order = ["_part", *position]
    tagged = stacked([p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)])
    unique = first_per_key(tagged, key, order)
    if target_count is not None:
        unique = top_rows(unique, [F.col(c) for c in order], target_count)
    return unique.drop("_part")


def first_source(rows: DataFrame, target: str, priority: str) -> DataFrame:
    """Per target, only the rows of the best source that returned any."""
    best = rows.groupBy(target).agg(F.min(priority).alias("_best"))
    return (
        rows.join(best.withColumnRenamed("_best", priority), [target, priority], "left_semi")
    )
