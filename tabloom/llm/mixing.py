"""Mixing sources to target weights by pivotal dependent rounding.

A source whose target is ``f`` times its size takes every document ``floor(f)`` times and once more with probability
``f - floor(f)``. The probabilities are rounded in pairs: a pair moves mass from one document to the other, weighted
by their sizes, until one of the two is 0 or 1, so that the expected size of the pair does not change. Blocks of
documents round their own pairs and hand on at most one fractional document each; a reduction tree combines those
until one is left per source, which a coin decides. A source's taken words therefore differ from its target by less
than one document, however the documents are spread. Coins are hashes of row keys: reruns agree.

Cases: a null text has size 0, and a document without words is never taken more than ``floor(f)`` times;
null is a source of its own, after all others; rows that are equal in id, source and text share whole copies and one
fraction; a source without words has target 0; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.grams import BLOCK_ROWS, GOLD, U, mix, row_key, running, stored, text_key

MOST = 3.0
LEAF, FAN = 1_000, 256
NEAR = 1e-9


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = MOST) -> DataFrame:
    """Target of each source from (source, source_size): the whole size shared by weight, no source above ``most`` times its own.

    What a stopped source leaves is shared by weight among the others until none is above; that fixed point is
    ``least(most * size, level * weight)`` for the one level at which the targets add up. Weights
    repeat over the sources by code point, null last. One row per source: a small table.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    rank = (F.row_number().over(by_name) - 1) % len(weights)
    rows = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank + 1).cast("int")))
    rows = rows.withColumn("room", F.lit(most) * F.col("source_size")).withColumn("stop", F.col("room") / F.col("weight"))
    order = Window.orderBy("stop", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rows = rows.withColumn("total", F.sum("source_size").over(everything).cast("double"))
    rows = rows.withColumn("level", (F.col("total") - F.coalesce(F.sum("room").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    # the level rises while it stops the next source and falls after that: the one wanted is its peak
    rows = rows.withColumn("level", F.max(F.when(F.col("level") <= F.col("stop"), F.col("level"))).over(everything))
    target = F.least(F.col("room"), F.coalesce(F.col("level") * F.col("weight"), F.col("room")))
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def _pivot(keys: np.ndarray, sizes: np.ndarray, shares: np.ndarray, level: int) -> tuple[np.ndarray, int]:
    """Round the shares in order, each against the fraction left over so far; returns them and the place of the fraction left (-1: none)."""
    shares = shares.copy()
    coins = mix(keys.view(np.uint64) ^ U((GOLD * (level + 1)) % (1 << 64))) >> U(11)
    coins = coins.astype(np.float64) / float(1 << 53)
    left = -1
    for i in range(len(shares)):
        if not NEAR < shares[i] < 1 - NEAR:
            shares[i] = round(shares[i])
            continue
        if left < 0:
            left = i
            continue
        p, q, a, b = shares[left], shares[i], sizes[left], sizes[i]
        up = min((1 - p) * a, q * b)  # mass that can move from i to the one left over
        down = min(p * a, (1 - q) * b)
        if coins[i] * (up + down) < down:
            p, q = p + up / a, q - up / b
        else:
            p, q = p - down / a, q + down / b
        open_p, open_q = NEAR < p < 1 - NEAR, NEAR < q < 1 - NEAR
        shares[left] = p if open_p else round(p)
        shares[i] = q if open_q else round(q)
        left = left if open_p else i if open_q else -1
    return shares, left


def _round_block(rows: pd.DataFrame, level: int) -> pd.DataFrame:
    rows = rows.sort_values(["rkey", "size"], kind="stable")
    shares, left = _pivot(rows["rkey"].to_numpy(), rows["weight"].to_numpy(np.float64), rows["share"].to_numpy(), level)
    rows = rows.assign(share=shares, done=True)
    if left >= 0:
        rows.iloc[left, rows.columns.get_loc("done")] = False
    return rows


def _rounder(level: int):
    return lambda rows: _round_block(rows, level)


def rounded(items: DataFrame) -> DataFrame:
    """(group, rkey, weight, share, ...) with every share 0 or 1: groups' sums of weight times share stay, but for one item each.

    Blocks of about ``LEAF`` items, then a tree that combines ``FAN`` residuals at a time; the number of
    levels follows from the largest group.
    """
    biggest = items.groupBy("group").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    blocks = max(1, -(-biggest // LEAF))
    level, done = 0, None
    now = items.withColumn("block", F.pmod(F.xxhash64("rkey"), F.lit(blocks)).cast("long"))
    kinds = {f.name: f.dataType.simpleString() for f in now.schema.fields} | {"done": "boolean"}
    schema = ", ".join(f"`{n}` {t}" for n, t in kinds.items())
    while True:
        step = now.groupBy("group", "block").applyInPandas(_rounder(level), schema)
        step = stored(step, f"round-{level}")
        part = step.filter("done").drop("done")
        done = part if done is None else done.unionByName(part)
        rest = step.filter("not done").drop("done")
        if blocks == 1:
            coin = (F.xxhash64("rkey", F.lit("last")).bitwiseAND(F.lit((1 << 53) - 1))).cast("double") / float(1 << 53)
            return done.unionByName(rest.withColumn("share", F.when(coin < F.col("share"), 1.0).otherwise(0.0))).drop("block")
        blocks, level = -(-blocks // FAN), level + 1
        now = rest.withColumn("block", (F.col("block") / F.lit(FAN)).cast("long"))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = MOST) -> DataFrame:
    """Copies of each row: rkey, doc_id, source, text_key, size, times (rows that get these copies), first, rows, source_size, target, copies.

    An item is what rows equal in id, source and text (by a 128-bit key) have in common. Equal rows together get whole copies and the
    fraction left over is rounded once, so a row repeated often misses its share by less than one row; an item of ``rows`` rows has up to two
    lines here, for its rows from number ``first`` on.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.col(text_col).cast("string").alias("text"),
    )
    rows = rows.select("doc_id", "source", text_key(F.col("text")).alias("text_key"), word_count(F.col("text")).alias("size"))
    items = rows.groupBy("doc_id", "source", "text_key").agg(F.first("size").alias("size"), F.count("*").alias("times"))
    items = stored(items.withColumn("rkey", row_key("doc_id", "source", "text_key")), "items")
    sums = items.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"))
    goal = stored(targets(sums, weights, most), "targets")
    # one row per source: Spark broadcasts it by its measured size or else joins by source, where it splits hot sources
    named = items.withColumnRenamed("source", "_source").join(goal, F.col("_source").eqNullSafe(F.col("source"))).drop("_source")
    factor = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(F.col("times") * factor + NEAR)
    named = named.withColumn("whole", whole.cast("long")).withColumn("share", F.greatest(F.col("times") * factor - whole, F.lit(0.0)))
    named = named.withColumn("weight", F.col("size").cast("double"))
    named = named.withColumn("group", F.xxhash64(F.col("source"), F.col("source").isNull()))
    open_ = (F.col("size") > 0) & (F.col("share") > NEAR)
    out = rounded(named.filter(open_)).unionByName(named.filter(~open_).withColumn("share", F.lit(0.0)))
    total, rows = F.col("whole") + F.round("share").cast("long"), F.col("times")
    more, each = total % rows, F.call_function("div", total, rows)
    lines = F.array(*[F.struct(first.alias("first"), n.alias("times"), c.alias("copies"))
                      for first, n, c in ((F.lit(0).cast("long"), more, each + 1), (more, rows - more, each))])
    lines = F.filter(lines, lambda x: x["times"] > 0)
    out = out.select("rkey", "doc_id", "source", "text_key", "size", F.col("times").alias("rows"), "source_size", "target", F.explode(lines).alias("line"))
    return out.select("rkey", "doc_id", "source", "text_key", "size", "line.times", "line.first", "rows", "source_size", "target", "line.copies")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it, with the columns of ``docs``."""
    plan = plan_mix(docs, id_col, text_col, source_col, **how).filter("copies > 0")
    names = {"__id": F.col(id_col).cast("long"), "__source": F.col(source_col).cast("string"), "__key": text_key(F.col(text_col).cast("string"))}
    keyed = docs.select(*[F.col(f"`{c}`") for c in docs.columns], *[x.alias(n) for n, x in names.items()])
    lines = plan.select(F.col("doc_id").alias("__i"), F.col("source").alias("__s"), F.col("text_key").alias("__t"), F.col("copies").alias("__copies"),
                        F.col("first").alias("__first"), F.col("times").alias("__times"), F.col("rows").alias("__rows"))
    same = F.col("__id").eqNullSafe(F.col("__i")) & F.col("__source").eqNullSafe(F.col("__s")) & F.col("__key").eqNullSafe(F.col("__t"))
    chosen = keyed.join(lines.filter("__rows = 1"), same)
    largest = plan.agg(F.max("rows")).first()[0] or 1
    if largest > 1:  # equal rows are numbered, by block, so that no task holds all of them
        repeated = stored(keyed.join(lines.filter("__rows > 1").select("__i", "__s", "__t").distinct(), same, "left_semi")
                          .withColumn("__uid", F.monotonically_increasing_id()), "repeated-rows")
        numbers = repeated.select("__id", "__source", "__key", F.col("__uid").alias("key"), F.pmod(F.xxhash64("__uid"), F.lit(-(-largest // BLOCK_ROWS))).alias("block"))
        numbers = running(numbers, ["__id", "__source", "__key"], F.lit(1), "__nth").select(F.col("key").alias("__uid"), "__nth")
        here = (F.col("__nth") >= F.col("__first")) & (F.col("__nth") < F.col("__first") + F.col("__times"))
        repeated = repeated.join(numbers, "__uid").join(lines.filter("__rows > 1"), same & here)
        chosen = chosen.unionByName(repeated.select(chosen.columns))
    copies = chosen.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return copies.select(*[F.col(f"`{c}`") for c in docs.columns])
