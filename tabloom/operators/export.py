"""Nested documents and file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.text import or_default


def with_defaults(rows: DataFrame, words: list[str], numbers: list[str]) -> DataFrame:
    """``N/A`` for missing words, ``0`` for missing numbers kept as text."""
    return rows.withColumns(
        {
            **{c: or_default(F.col(c).cast("string"), "N/A") for c in words},
            **{c: or_default(F.col(c).cast("string"), "0") for c in numbers},
        }
    )


def nested_documents(
    parents: DataFrame,
    children: DataFrame,
    key: str,
    order: list[str],
    columns: list[str],
    name: str,
    part: str | None = None,
) -> DataFrame:
    """Parents with an array of their children, ``[]`` where there are none: one document per parent.

    A document is one value, so a parent's children meet in one task. Where that is too much, ``part``
    names a column of the children (a year, say): there is then one document per parent and part.
    """
    keys = [key, part] if part else [key]
    item = F.struct(*(F.col(c).alias(f"_o{i}") for i, c in enumerate(order)), F.struct(*columns).alias("item"))
    grouped = children.groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(item)), lambda x: x["item"]).alias(name)
    )
    empty = F.array().cast(grouped.schema[name].dataType)
    return parents.join(grouped, key, "left").withColumn(name, F.coalesce(name, empty))


def write_csv(rows: DataFrame, path: str) -> None:
    """Headered CSV part files."""
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    """One JSON document per line; NULLs are kept, dates are ISO text."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def json_text(rows: DataFrame, name: str = "document") -> DataFrame:
    """One JSON text per row."""
    return rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias(name))
