"""Hard-negative mining with a packed R-tree.

Vectors become integers and are packed by sort-tile-recursive: quantiles of the two coordinates that vary most deal the rows
into at most ``TILES`` tiles, a tile is cut into parts by id hash where it is large, and inside a part rows are sorted and tiled,
coordinate after coordinate, into leaves. Tiles, inner nodes and leaves have minimum bounding boxes; a box and an anchor give an
interval of inner products. A part is searched for many anchors at once, best first: a queue holds its boxes by their highest
possible score, and an anchor leaves a box out if the interval misses all its score windows or lies strictly
below the worst of the best rows it has. A first round searches each anchor's own part; what it finds bounds the second round
over all other parts that the tiles' boxes leave. The same search finds positives (same label, no window) and negatives
(other labels, one window per positive).

What grows with the data is stored or shuffled: a task holds one part and at most about ``GROUP_ANCHORS`` anchors; tile boxes and cuts are bounded by ``TILES``.

Cases: rows without id, label or vector, and vectors with a null or non-finite component, take no part; vectors of fewer components count as
if zeros followed, empty ones too; equal anchors are searched once, repeated rows are found each; a row with the anchor's id is no positive; empty tables give no
rows; components beyond the range of a long are held at its ends, scores at 2**62; other columns are not looked at.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.grams import stored

TILES, PART_ROWS, LEAF_ROWS, FANOUT, GROUP_ANCHORS = 1024, 16_384, 256, 8, 4096
OPEN = 1 << 62
EXACT = 1 << 53

_ROWS = "part int, tile int, ids binary, labels binary, vectors binary, low binary, high binary"
_FOUND = "anchor long, w int, other long, score long"


def str_order(vectors: np.ndarray, leaf: int) -> np.ndarray:
    """Row order that lays the leaves of a sort-tile-recursive packing end to end; the coordinates that vary most come first."""
    n, dims = vectors.shape
    if n <= leaf or not dims:
        return np.arange(n)
    spread = np.argsort(-(vectors.max(axis=0).astype(float) - vectors.min(axis=0)), kind="stable")

    def tile(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        leaves = -(-len(rows) // leaf)
        if leaves == 1 or depth == dims:
            return [rows]
        left = max(1, min(dims - depth, int(np.ceil(np.log2(leaves)))))
        slabs = int(np.ceil(leaves ** (1 / left)))
        rows = rows[np.argsort(vectors[rows, spread[depth]], kind="stable")]
        size = -(-leaves // slabs) * leaf
        return [x for i in range(0, len(rows), size) for x in tile(rows[i : i + size], depth + 1)]

    return np.concatenate(tile(np.arange(n), 0))


def _boxes(vectors: np.ndarray, step: int, low=None) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper corners of every ``step`` consecutive rows (or boxes, if ``low`` corners are given as well)."""
    at = np.arange(0, len(vectors), step)
    return np.minimum.reduceat(vectors if low is None else low, at), np.maximum.reduceat(vectors, at)


def intervals(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with any point of each box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _best(anchor, window, other, score, n: int) -> np.ndarray:
    """Positions of the ``n`` first rows of each (anchor, window): highest score, then smallest id."""
    order = np.lexsort((other, -score, window, anchor))
    group = np.flatnonzero(np.r_[True, (np.diff(anchor[order]) != 0) | (np.diff(window[order]) != 0)]) if len(order) else np.zeros(0, int)
    place = np.arange(len(order)) - np.repeat(group, np.diff(np.r_[group, len(order)]))
    return order[place < n]


class PartTree:
    """The packed rows of a part with the boxes of its leaves and inner nodes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf: int = LEAF_ROWS, fanout: int = FANOUT):
        self.ids, self.labels, self.vectors, self.leaf, self.fanout = ids, labels, vectors, leaf, fanout
        self.leaves = _boxes(vectors, leaf)
        self.inner = _boxes(self.leaves[1], fanout, self.leaves[0])

    def search(self, ids, labels, anchors, low, high, floors, n: int, same: bool):
        """(anchor position, window, id, score) of the ``n`` best rows per anchor and window of the part, those strictly below ``floors`` left out.

        ``low``, ``high`` and ``floors`` are (anchor x window).
        """
        leaf_least, leaf_most = intervals(anchors, *self.leaves)
        inner_least, inner_most = intervals(anchors, *self.inner)
        floors = np.maximum(low, floors)
        found = [np.zeros(0, np.int64) for _ in range(4)]

        def open_(least: np.ndarray, most: np.ndarray) -> np.ndarray:
            return np.flatnonzero(((most[:, None] >= floors) & (least[:, None] <= high)).any(axis=1))

        queue = [(-float(inner_most[:, j].max()), 0, j) for j in range(len(self.inner[0]))]
        heapq.heapify(queue)
        while queue:
            _, is_leaf, j = heapq.heappop(queue)
            if not is_leaf:
                if len(open_(inner_least[:, j], inner_most[:, j])):
                    for k in range(j * self.fanout, min(len(self.leaves[0]), (j + 1) * self.fanout)):
                        heapq.heappush(queue, (-float(leaf_most[:, k].max()), 1, k))
                continue
            a = open_(leaf_least[:, j], leaf_most[:, j])
            if not len(a):
                continue
            rows = slice(j * self.leaf, (j + 1) * self.leaf)
            scores = anchors[a] @ self.vectors[rows].T
            fits = (labels[a][:, None] == self.labels[rows][None, :]) == same
            if same:
                fits &= ids[a][:, None] != self.ids[rows][None, :]
            new = []
            for w in range(low.shape[1]):
                x, y = np.nonzero(fits & (scores >= floors[a, w][:, None]) & (scores <= high[a, w][:, None]))
                if len(x):
                    new.append((a[x], np.full(len(x), w), self.ids[rows][y], np.clip(scores[x, y], -OPEN, OPEN).astype(np.int64)))
            if not new:
                continue
            found = [np.concatenate([f, *[p[i] for p in new]]) for i, f in enumerate(found)]
            kept = _best(*found, n)
            found = [f[kept] for f in found]
            # the n-th best of an anchor's window is from now on the least that counts
            first = np.flatnonzero(np.r_[True, (np.diff(found[0]) != 0) | (np.diff(found[1]) != 0)])
            full = first[np.diff(np.r_[first, len(kept)]) == n]
            floors[found[0][full], found[1][full]] = found[3][full + n - 1]
        return found


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Arrays of up to ``width`` numbers as rows, zeros behind."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    out[np.repeat(np.arange(len(lists)), sizes), np.arange(sizes.sum()) - np.repeat(starts, sizes)] = lists.flatten().to_numpy()
    return out


def _number(vectors: np.ndarray, anchors: np.ndarray) -> type:
    """Doubles multiply fastest and are exact for small numbers; longs are for larger ones, whole numbers of any size beyond."""
    top = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)))
    most = 2 * top(vectors) * top(anchors) * max(1, vectors.shape[1])
    return np.float64 if most < EXACT else np.int64 if most < OPEN else object


def _packed(rows: pa.Table, width: int) -> pa.Table:
    """One row with a part's rows in packed order."""
    vectors = _matrix(rows["q"], width)
    order = str_order(vectors, LEAF_ROWS)
    v = np.ascontiguousarray(vectors[order])
    row = {
        "part": rows["part"][0].as_py(), "tile": rows["tile"][0].as_py(),
        "ids": rows["vec_id"].to_numpy()[order].astype(np.int64).tobytes(), "labels": rows["label"].to_numpy()[order].astype(np.int64).tobytes(),
        "vectors": v.tobytes(), "low": v.min(axis=0).tobytes(), "high": v.max(axis=0).tobytes(),
    }
    kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 5
    return pa.Table.from_pylist([row], schema=pa.schema(list(zip(row, kinds, strict=True))))


def _tile_box(rows: pa.Table) -> pa.Table:
    low = np.stack([np.frombuffer(x, np.int64) for x in rows["low"].to_pylist()]).min(axis=0)
    high = np.stack([np.frombuffer(x, np.int64) for x in rows["high"].to_pylist()]).max(axis=0)
    return pa.table({"tile": pa.array([rows["tile"][0].as_py()], pa.int32()), "low": pa.array([low.tobytes()]), "high": pa.array([high.tobytes()])})


def _visited(asked: pa.Table, part: pa.Table, width: int, n: int, same: bool) -> pa.Table:
    """The best rows of a part for the anchors that visit it."""
    out = [np.zeros(0, np.int64)] * 4
    if asked.num_rows and part.num_rows:
        p = {c: part[c][0].as_py() for c in ("ids", "labels", "vectors")}
        vectors = np.frombuffer(p["vectors"], np.int64).reshape(-1, width) if width else np.zeros((len(p["ids"]) // 8, 0), np.int64)
        anchors = _matrix(asked["q"], width)
        kind = _number(vectors, anchors)
        tree = PartTree(np.frombuffer(p["ids"], np.int64), np.frombuffer(p["labels"], np.int64), vectors.astype(kind))
        low, high, floors = (np.array(asked[c].to_pylist(), dtype=kind) for c in ("low", "high", "floor"))
        out = tree.search(asked["vec_id"].to_numpy(), asked["label"].to_numpy(), anchors.astype(kind), low, high, floors, n, same)
        out[0] = asked["anchor"].to_numpy()[out[0]]
    return pa.table([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["anchor", "w", "other", "score"])


class Forest:
    """All rows, packed: ``rows`` (one per vector), ``parts`` (one per part), the tiles' boxes and their parts."""

    def __init__(self, rows: DataFrame, width: int, part_rows: int = PART_ROWS):
        spark, self.width = rows.sparkSession, width
        total = rows.count()
        tiles = min(TILES, max(1, -(-total // part_rows)))
        rows = self._tiled(rows, tiles)
        counts = rows.groupBy("tile").count().collect()  # at most TILES rows
        self.parts_of, at = {}, 0
        for r in sorted(counts):
            k = -(-r["count"] // part_rows)
            self.parts_of[r["tile"]] = (at, k)
            at += k
        first = spark.createDataFrame([(t, a, k) for t, (a, k) in self.parts_of.items()] or [(0, 0, 1)], "tile int, at int, k int")
        rows = rows.join(F.broadcast(first), "tile").withColumn("part", (F.col("at") + F.pmod(F.xxhash64("vec_id"), F.col("k"))).cast("int"))
        self.rows = stored(rows.drop("at", "k"), "vectors")
        packed = self.rows.groupBy("part").applyInArrow(lambda t: _packed(t, width), _ROWS)
        self.parts = stored(packed, "parts")
        boxes = self.parts.select("tile", "low", "high").groupBy("tile").applyInArrow(_tile_box, "tile int, low binary, high binary").collect()
        self.boxes = {r["tile"]: (np.frombuffer(r["low"], np.int64), np.frombuffer(r["high"], np.int64)) for r in boxes}

    def _tiled(self, rows: DataFrame, tiles: int) -> DataFrame:
        """Adds ``tile``: slabs by quantiles of one coordinate, cut by quantiles of another."""
        if tiles == 1 or not self.width:
            return rows.withColumn("tile", F.lit(0))
        at = lambda i: F.coalesce(F.get("q", F.lit(i)), F.lit(0))
        spread = rows.agg(*[F.var_pop(at(i)).alias(f"v{i}") for i in range(self.width)]).first()
        first, second = [int(i) for i in np.argsort([-(x or 0) for x in spread], kind="stable")[:2]] if self.width > 1 else (0, 0)
        slabs = int(np.ceil(tiles**0.5))
        each = -(-tiles // slabs)
        shares = lambda k: [i / k for i in range(1, k)]
        past = lambda cuts, c: F.size(F.filter(cuts, lambda x: x <= c))
        cuts = rows.agg(F.percentile_approx(at(first), shares(slabs), 1000).alias("c")).first()["c"]
        rows = rows.withColumn("slab", past(F.array(*[F.lit(c) for c in cuts]), at(first)))
        if each == 1:
            return rows.withColumnRenamed("slab", "tile")
        inner = F.broadcast(rows.groupBy("slab").agg(F.percentile_approx(at(second), shares(each), 1000).alias("cuts")))  # a row per slab
        return rows.join(inner, "slab").withColumn("tile", F.col("slab") * each + past(F.col("cuts"), at(second))).drop("slab", "cuts")

    def _others(self, home: Column, q: Column, low: Column, high: Column, floor: Column) -> Column:
        """Parts other than the own that the tiles' boxes do not rule out."""
        names, width = sorted(self.boxes), self.width
        least = np.stack([self.boxes[t][0] for t in names]) if names else np.zeros((0, width), np.int64)
        most = np.stack([self.boxes[t][1] for t in names]) if names else np.zeros((0, width), np.int64)
        parts = [np.arange(a, a + k) for a, k in (self.parts_of[t] for t in names)]

        @F.arrow_udf("array<int>")
        def others(homes: pa.Array, qs: pa.Array, lows: pa.Array, highs: pa.Array, floors: pa.Array) -> pa.Array:
            anchors = _matrix(qs, width)
            kind = _number(np.concatenate([least, most]), anchors)
            down, up = intervals(anchors.astype(kind), least.astype(kind), most.astype(kind))
            out = []
            for i, (home, lo, hi, fl) in enumerate(zip(homes.to_pylist(), lows.to_pylist(), highs.to_pylist(), floors.to_pylist(), strict=True)):
                fits = np.zeros(len(names), bool)
                for a, b, c in zip(lo, hi, fl, strict=True):
                    fits |= (up[i] >= max(a, c)) & (down[i] <= b)
                out.append([int(p) for t in np.flatnonzero(fits) for p in parts[t] if p != home])
            return pa.array(out, pa.list_(pa.int32()))

        return others(home, q, low, high, floor)

    def _visit(self, asked: DataFrame, n: int, same: bool) -> DataFrame:
        """(anchor, w, other, score): the best rows of the parts that anchors (``part``) visit."""
        groups = max(1, -(-asked.select("anchor").distinct().count() // GROUP_ANCHORS))
        width = self.width
        asked = asked.withColumn("g", F.pmod(F.xxhash64("anchor"), F.lit(groups)).cast("int"))
        parts = self.parts.select("part", "ids", "labels", "vectors", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))
        return asked.groupBy("part", "g").cogroup(parts.groupBy("part", "g")).applyInArrow(lambda a, b: _visited(a, b, width, n, same), _FOUND)

    def best(self, asked: DataFrame, n: int, same: bool) -> DataFrame:
        """(anchor, w, other, score, rank): the ``n`` best rows of each anchor's windows, over all parts.

        ``asked``: anchor, vec_id, label, q, part (its own), low, high (arrays, one element per window).
        """
        asked = stored(asked.withColumn("floor", F.col("low")), "asked")
        near = stored(self._visit(asked, n, same), "near")
        worst = near.groupBy("anchor", "w").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= n)
        worst = worst.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("w", "least"))).alias("least"))
        known = asked.join(worst, "anchor", "left").withColumn(
            "floor", F.transform("low", lambda x, i: F.coalesce(F.try_element_at("least", i), x))
        ).drop("least")
        others = self._others(F.col("part"), F.col("q"), F.col("low"), F.col("high"), F.col("floor"))
        far = stored(known.withColumn("part", F.explode(others)), "far")
        found = near.unionByName(self._visit(far, n, same))
        rank = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "other")
        return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= n)


def whole_vectors(rows: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, q): rows that take part, their components as ``floor(scale * x)``."""
    x = F.col(vector_col).cast("array<double>")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & sound)
    return rows.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.transform(x, lambda v: F.floor(v * scale)).alias("q")
    )


def _percent(score: Column, share: int, rounded) -> Column:
    """A share of a score, in decimals as longs might not hold the product."""
    return rounded(score.cast("decimal(20,0)") * F.lit(share).cast("decimal(5,0)") / F.lit(100).cast("decimal(3,0)")).cast("long")


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
                   part_rows: int = PART_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for rows (vec_id, label, q).

    For each anchor its first ``positives`` rows of the same label and, for each of those, the first ``negatives`` rows of
    other labels whose score is between ``least`` and ``most`` percent of the positive's.
    """
    rows = stored(rows, "whole-vectors")
    width = rows.agg(F.max(F.size("q"))).first()[0] or 0
    forest = Forest(rows, width, part_rows)
    anchors = forest.rows.where(is_anchor).dropDuplicates(["vec_id", "label", "q"])
    anchors = stored(anchors.select(F.xxhash64("vec_id", "label", "q").alias("anchor"), "vec_id", "label", "q", "part"), "anchors")
    ends = [F.array(F.lit(x).cast("long")).alias(name) for x, name in ((-OPEN, "low"), (OPEN, "high"))]
    same = stored(forest.best(anchors.select("*", *ends), positives, same=True), "positives")
    # 100 * negative >= least * positive and 100 * negative <= most * positive
    low, high = _percent(F.col("score"), least, F.ceil), _percent(F.col("score"), most, F.floor)
    windows = same.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", low.alias("low"), high.alias("high")))).alias("s"))
    windows = windows.select("anchor", *[
        F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda i: F.coalesce(F.get("s", i - 1)[c], F.lit(end).cast("long"))).alias(c)
        for c, end in (("low", OPEN), ("high", -OPEN))  # an empty window where there are fewer positives
    ])
    found = forest.best(anchors.join(windows, "anchor"), negatives, same=False)
    pairs = same.select("anchor", (F.col("rank") - 1).alias("w"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    out = found.select("anchor", "w", "rank", F.col("other").alias("negative_id"), F.col("score").alias("negative_score")).join(pairs, ["anchor", "w"])
    return out.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


SQL = """WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS s
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT a, b AS positive_id, s AS p FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT p.a AS anchor_id, positive_id, row_number() OVER (PARTITION BY p.a, positive_id ORDER BY s DESC, b)::INTEGER AS rank,
  b AS negative_id, p AS positive_score, s AS negative_score
FROM p JOIN s ON p.a = s.a AND NOT same AND 50 * p <= 100 * s AND 100 * s <= 95 * p
QUALIFY rank <= 3"""
