"""Resharding by minimum-cost flow.

Old shard sizes and new capacities make a transportation problem: a byte that stays in its shard costs nothing, a byte
that moves costs one (or what the caller's costs say). Moves at one price go through a hub, so the network has as many nodes and arcs as there
are shards; it is solved on the driver by successive shortest distances with a blocking flow at each. A shard's documents stand in a fixed order of blocks; the flow cuts that order into
runs of bytes, and a document goes where the run goes that holds its middle byte. A second solution, from the
layout reached to the same capacities, moves the smallest documents of the shards that got too much, so that whole
documents cost no balance; a document larger than an equal share has a shard to itself. Running sums are taken per block and per shard, never over a whole shard at once.

Cases: a null text has no bytes; repeated rows are documents of their own; a null old shard is the shard
``hash(null)``; an empty table gives no rows; shards without capacity get nothing.
"""

from __future__ import annotations

import heapq
import os
from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabloom.llm.grams import running, stored, text_key

BLOCK_ROWS = 100_000
LISTED = 1_000  # a key with more equal rows has its places joined one by one instead of as a list


class Network:
    """Arcs with room and price between numbered nodes; an arc's partner runs back."""

    def __init__(self, nodes: int):
        self.to, self.room, self.price, self.out = [], [], [], [[] for _ in range(nodes)]

    def arc(self, u: int, v: int, room: int, price: int = 0) -> int:
        for a, b, r, p in ((u, v, room, price), (v, u, 0, -price)):
            self.out[a].append(len(self.to))
            self.to.append(b)
            self.room.append(r)
            self.price.append(p)
        return len(self.to) - 2

    def flow(self, arc: int) -> int:
        return self.room[arc ^ 1]

    def send(self, source: int, sink: int, amount: int) -> int:
        """Cheapest flow of ``amount``; returns what found no way."""
        to, room, price, out = self.to, self.room, self.price, self.out
        height = [0] * len(out)
        while amount:
            far = [float("inf")] * len(out)
            far[source], queue = 0, [(0, source)]
            while queue:
                d, u = heapq.heappop(queue)
                if d > far[u]:
                    continue
                for e in out[u]:
                    if room[e] and (step := d + price[e] + height[u] - height[to[e]]) < far[to[e]]:
                        far[to[e]] = step
                        heapq.heappush(queue, (step, to[e]))
            if far[sink] == float("inf"):
                break
            height = [h + min(d, far[sink]) for h, d in zip(height, far)]
            while amount and (sent := self._blocking(source, sink, amount, height)):
                amount -= sent
        return amount

    def _blocking(self, source: int, sink: int, amount: int, height: list[int]) -> int:
        """A blocking flow over the arcs that cost nothing at these heights, by levels."""
        to, room, price, out = self.to, self.room, self.price, self.out
        level, queue = {source: 0}, deque([source])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                if room[e] and to[e] not in level and price[e] + height[u] == height[to[e]]:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if sink not in level:
            return 0
        at, path, sent, u = [0] * len(out), [], 0, source
        while sent < amount:
            if u == sink:
                step = min(amount - sent, *(room[e] for e in path))
                for e in path:
                    room[e] -= step
                    room[e ^ 1] += step
                sent += step
                full = next((k for k, e in enumerate(path) if not room[e]), 0)
                u = to[path[full] ^ 1]
                del path[full:]
                continue
            while at[u] < len(out[u]):
                e = out[u][at[u]]
                if room[e] and level.get(to[e]) == level[u] + 1 and price[e] + height[u] == height[to[e]]:
                    break
                at[u] += 1
            else:
                if u == source:
                    break
                u = to[path.pop() ^ 1]
                at[u] += 1
                continue
            path.append(e)
            u = to[e]
        return sent


def min_cost_flow(supply: list[int], capacity: list[int], cost=None) -> dict[tuple[int, int], int]:
    """Cheapest transfers {(old, new): bytes} that place all supply within the capacities.

    By default a byte costs 0 in the shard of the same number and 1 in any other: then there is an arc per shard to itself and one
    each to and from a hub. ``cost(old, new)`` sets a price per byte and pair, with an arc for each.
    """
    if sum(capacity) < sum(supply):
        raise ValueError("the new shards cannot hold the old ones")
    m, n = len(supply), len(capacity)
    hub, source, sink = m + n, m + n + 1, m + n + 2
    net = Network(m + n + 3)
    for i, s in enumerate(supply):
        net.arc(source, i, s)
    for j, c in enumerate(capacity):
        net.arc(m + j, sink, c)
    total = sum(supply)
    if cost:
        pairs = {(i, j): net.arc(i, m + j, s, cost(i, j)) for i, s in enumerate(supply) for j in range(n)}
        net.send(source, sink, total)
        return {k: net.flow(e) for k, e in pairs.items() if net.flow(e)}
    stay = {i: net.arc(i, m + i, supply[i]) for i in range(min(m, n))}
    leave = [net.arc(i, hub, s, 1) for i, s in enumerate(supply)]
    enter = [net.arc(hub, m + j, c) for j, c in enumerate(capacity)]
    net.send(source, sink, total)
    moved = {(i, i): net.flow(e) for i, e in stay.items() if net.flow(e)}
    wanted = deque([j, net.flow(e)] for j, e in enumerate(enter) if net.flow(e))
    for i, e in enumerate(leave):
        left = net.flow(e)
        while left:
            j, room = wanted[0]
            step = min(left, room)
            moved[i, j] = moved.get((i, j), 0) + step
            left -= step
            wanted[0][1] -= step
            if not wanted[0][1]:
                wanted.popleft()
    return moved


def runs_of(flow: dict[tuple[int, int], int]) -> list[tuple[int, int, int, int]]:
    """(old, new, first byte, end byte): moved runs first, what stays last."""
    out, at = [], {}
    for (i, j), size in sorted(flow.items(), key=lambda x: (x[0][0], x[0][0] == x[0][1], x[0][1])):
        out.append((i, j, at.get(i, 0), at.get(i, 0) + size))
        at[i] = at.get(i, 0) + size
    return out


def _offsets(rows: DataFrame, shard: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows before each row in its shard, by block and then by ``order``."""
    sums = rows.groupBy(shard, "block").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(shard).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(shard, "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return rows.join(sums, [shard, "block"]).withColumn(name, F.col("_base") + F.col("_in")).drop("_base", "_in")


def _moved(rows: DataFrame, old: int, capacity: list[int], order: list[Column], cost, mark: Column) -> DataFrame:
    """Rows (from, block, size, ...) with ``to``: the shard of the run that ``mark``, a byte of the document, is before the end of."""
    sizes = {r["from"]: r["n"] for r in rows.groupBy("from").agg(F.sum("size").alias("n")).collect()}  # a row per shard
    flow = min_cost_flow([int(sizes.get(i, 0)) for i in range(old)], capacity, cost)
    cuts: dict[int, tuple[list, list]] = {}
    for i, j, _, end in runs_of(flow):
        ends, shards = cuts.setdefault(i, ([], []))
        ends.append(end)
        shards.append(j)
    # one run per shard and one more per new shard at most: as small as the list of shards
    runs = rows.sparkSession.createDataFrame([(i, *c) for i, c in cuts.items()], "`_old` int, `_ends` array<long>, `_shards` array<int>")
    rows = _offsets(rows, "from", order, F.col("size"), "at").join(F.broadcast(runs), F.col("from") == F.col("_old"), "left")
    run = F.least(F.size(F.filter("_ends", lambda end: end < mark)) + 1, F.size("_ends"))
    spare = next((j for j, c in enumerate(capacity) if c), 0)  # for documents without a byte
    return rows.withColumn("to", F.coalesce(F.element_at("_shards", run), F.lit(spare))).drop("at", "_old", "_ends", "_shards")


def _alone(rows: DataFrame, total: int, shards: int) -> list:
    """Documents larger than an equal share of what is left: each gets a shard of its own. At most one per shard is looked at."""
    largest = rows.select("rkey", "copy", "size").orderBy(F.desc("size"), "rkey", "copy").limit(shards).collect()
    out = []
    for r in largest:
        if r["size"] * (shards - len(out)) <= total or len(out) == shards - 1:
            break
        out.append(r)
        total -= r["size"]
    return out


def even_capacities(total: int, shards: int) -> list[int]:
    """Capacities that add up to ``total``, at most one byte apart."""
    return [total // shards + (j < total % shards) for j in range(shards)]


def _copies(rows: DataFrame) -> DataFrame:
    """The rows with ``copy``, from 1 over the rows of a key: equal rows are counted first, so a key costs a row per task and old shard."""
    counts = rows.groupBy(*rows.columns).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("rkey").orderBy("from").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    counts = counts.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(BLOCK_ROWS).cast("long"))))
    if rows.groupBy("rkey").count().filter(F.col("count") > BLOCK_ROWS).head(1):
        counts = counts.repartition("rkey", "_block")
    last = F.least(F.col("_block") + BLOCK_ROWS, F.col("_n"))
    return counts.select(*rows.columns, F.explode(F.sequence(F.col("_first") + F.col("_block") + 1, F.col("_first") + last)).alias("copy"))


def reshard(rows: DataFrame, old_shards: int, shards: int, capacity: list[int] | None = None, cost=None, passes: int = 3) -> DataFrame:
    """New shard and slot of documents (rkey, size, from, ...): adds ``shard`` and ``slot``; ``from`` is 0 to old_shards - 1.

    ``capacity`` defaults to equal shares. Further passes go from the layout reached to the
    same capacities with the smallest documents first: they only even out what whole documents left uneven.
    """
    rows = stored(_copies(rows), "old-layout")
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    alone = [] if capacity else _alone(rows, int(total), shards)
    if not capacity:
        rest = int(total) - sum(r["size"] for r in alone)
        capacity = [0] * len(alone) + even_capacities(rest, shards - len(alone))
    parts = max(16, -(-int(count) // BLOCK_ROWS))
    spread = F.pmod(F.xxhash64("rkey", "copy"), F.lit(parts)).cast("long")
    rows = rows.withColumn("block", spread)
    own = None
    if alone:
        places = [(r["rkey"], r["copy"], j) for j, r in enumerate(alone)]
        places = F.broadcast(rows.sparkSession.createDataFrame(places, "rkey string, copy long, to int"))
        own = rows.join(places, ["rkey", "copy"]).select(*rows.columns, "to")
        rows = rows.join(places, ["rkey", "copy"], "left_anti").select(*rows.columns)
    middle, end = F.col("at") + F.col("size") / 2, F.col("at") + F.col("size")
    layout = stored(_moved(rows, old_shards, capacity, [F.col("rkey"), F.col("copy")], cost, middle), "placed")
    for turn in range(passes - 1):
        step = F.floor(F.log2(F.col("size").cast("double") + 1) * 4).cast("long")
        again = layout.withColumn("origin", F.col("from")).withColumn("from", F.col("to")).drop("to")
        again = again.withColumn("block", step * parts + F.pmod(F.col("block"), F.lit(parts)))
        # only whole documents that fit into what a shard has too much leave it
        moved = _moved(again, shards, capacity, [F.col("size"), F.col("rkey"), F.col("copy")], None, end)
        layout = stored(moved.withColumn("from", F.col("origin")).drop("origin"), f"evened-{turn}")
    layout = layout if own is None else layout.unionByName(own)
    out = layout.withColumnRenamed("to", "shard").withColumn("block", spread)
    out = _offsets(out, "shard", [F.col("rkey"), F.col("copy")], F.lit(1), "slot")
    return out.withColumn("slot", F.col("slot").cast("long")).drop("block")


def item_key(doc_id: Column, text: Column, source: Column) -> Column:
    """A 128-bit key of id, text and old shard's value; equal rows share it, nulls count as values."""
    none = F.lit("-")
    return F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("n")), F.coalesce(text_key(text), none), F.coalesce(F.concat(F.lit("+"), source), none)))


def sized(docs: DataFrame, old_shards: int, id_col: str = "doc_id", text_col: str = "text", shard_col: str = "source", overhead: int = 16,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, rkey, size, text_crc32, from) and the columns of ``keep``: the old layout keeps each value of ``shard_col`` in one of ``old_shards`` shards."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(shard_col).cast("string").alias("source"), *keep)
    text = F.coalesce(F.col("text"), F.lit(""))
    return rows.select(
        "doc_id", item_key(F.col("doc_id"), F.col("text"), F.col("source")).alias("rkey"), (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.pmod(F.xxhash64("source", F.col("source").isNull()), F.lit(old_shards)).cast("int").alias("from"), *keep,
    )


def _names(docs: DataFrame) -> dict[str, str]:
    """The columns ``placed`` adds; a name the documents have is taken with an underscore before it."""
    names = {}
    for name in ("size", "shard", "slot"):
        names[name] = name
        while names[name] in docs.columns:
            names[name] = "_" + names[name]
    return names


def placed(docs: DataFrame, plan: DataFrame, only: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
           shard_col: str = "source") -> DataFrame:
    """The documents with size, shard and slot of their plan; ``only`` keeps the shards it lists.

    Texts meet their places by key in one join. Equal rows take the places of their key in the order of the other
    columns; a key with more than ``LISTED`` rows has them numbered by block.
    """
    names, kept = _names(docs), [F.col(f"`{c}`") for c in docs.columns]
    key = item_key(F.col(id_col).cast("long"), F.col(text_col).cast("string"), F.col(shard_col).cast("string"))
    rows = docs.select(*kept, key.alias("__rkey"))
    wanted = F.lit(True)
    if only is not None:  # a row per shard at most
        plan = plan.join(F.broadcast(only.select("shard", F.lit(True).alias("__only"))), "shard", "left")
        wanted = F.coalesce("__only", F.lit(False))
    places = plan.select(F.col("rkey").alias("__key"), F.col("copy").alias("__copy"), wanted.alias("__wanted"), *[F.col(a) for a in names])
    counts = places.groupBy("__key").agg(F.count("*").alias("__n"), F.max("__wanted").alias("__any")).filter("__any")
    most = counts.agg(F.max("__n")).first()[0] or 1
    chosen = [F.col(f"__place.{a}").alias(b) for a, b in names.items()]
    if most == 1:
        lone = places.filter("__wanted").select("__key", F.struct(*names).alias("__place"))
        return rows.join(lone, F.col("__rkey") == F.col("__key")).select(*kept, *chosen)
    place = F.struct("__copy", "__wanted", *names)
    # keys with many rows keep no list, those without a wanted place do not come
    lists = places.join(counts.filter(F.col("__n") > LISTED).select("__key"), "__key", "left_anti") if most > LISTED else places
    lists = lists.groupBy("__key").agg(F.sort_array(F.collect_list(place)).alias("__places"), F.max("__wanted").alias("__any")).filter("__any")
    simple = [f"`{f.name}`" for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    nth = F.row_number().over(Window.partitionBy("__rkey").orderBy("__order"))
    out = rows.withColumn("__order", F.xxhash64(*simple)).join(lists, F.col("__rkey") == F.col("__key"))
    out = out.withColumn("__place", F.element_at("__places", nth)).filter("__place.__wanted").select(*kept, *chosen)
    if most <= LISTED:
        return out
    many = counts.filter(F.col("__n") > LISTED).select("__key")
    heavy = stored(rows.join(many, F.col("__rkey") == F.col("__key"), "left_semi").withColumn("__uid", F.monotonically_increasing_id()), "equal-rows")
    numbers = heavy.select("__rkey", F.col("__uid").alias("key"), F.pmod(F.xxhash64("__uid"), F.lit(-(-most // BLOCK_ROWS))).alias("block"))
    numbers = running(numbers, ["__rkey"], F.lit(1), "__nth").select(F.col("key").alias("__id"), F.col("__nth"))
    heavy = heavy.join(numbers, F.col("__uid") == F.col("__id"))
    lines = places.filter("__wanted").select("__key", "__copy", F.struct(*names).alias("__place"))
    heavy = heavy.join(lines, (F.col("__rkey") == F.col("__key")) & (F.col("__nth") + 1 == F.col("__copy")))
    return out.unionByName(heavy.select(*kept, *chosen))


def rewrite(spark: SparkSession, docs: DataFrame, plan: DataFrame, folder: str) -> DataFrame:
    """Write the files of the affected shards: those that gain or lose a document; returns (shard, affected, rows).

    A shard that keeps exactly its documents is left as it is, one that loses all of them loses its files.
    """
    lost = plan.filter("`from` <> shard").select(F.explode(F.array("from", "shard")).alias("shard")).distinct()
    state = plan.groupBy("shard").agg(F.count("*").alias("rows")).join(lost.withColumn("affected", F.lit(True)), "shard", "full")
    state = stored(state.select("shard", F.coalesce("affected", F.lit(False)).alias("affected"), F.coalesce("rows", F.lit(0)).alias("rows")), "shards")
    rows = placed(docs, plan, state.filter("affected"))
    path, name = os.path.join(folder, "shards"), _names(docs)["shard"]
    # only the folders of shards that get rows are replaced
    rows.write.partitionBy(name).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    for row in state.filter("rows = 0").collect():  # at most a row per shard
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}={row['shard']}")
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return state


def resharded(spark: SparkSession, docs: DataFrame, plan: DataFrame, folder: str) -> DataFrame:
    """The documents with size, shard and slot: those of affected shards as rewritten under ``folder``, the others as they are."""
    plan = stored(plan, "plan")
    state = rewrite(spark, docs, plan, folder)
    same = placed(docs, plan, state.filter("not affected"))
    if not state.filter("affected and rows > 0").head(1):
        return same
    files = spark.read.schema(same.schema).parquet(os.path.join(folder, "shards"))
    files = files.join(F.broadcast(state.filter("affected").select(F.col("shard").alias("__new"))), F.col(_names(docs)["shard"]) == F.col("__new")).drop("__new")
    files = files.select(same.columns)
    return files.unionByName(same) if state.filter("not affected").head(1) else files
