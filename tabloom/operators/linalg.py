"""Matrices and grids as tables.

Matrices are ``row, col, v`` with one row per cell (missing cells are 0), grids
are ``y, x, v``. Cells must be unique, which bounds a block or tile by
its area whatever the distribution of the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.session import scratch_dir

_BLOCK = "bi bigint, bj bigint, places binary, data binary"
_PACKED = "bk bigint, deal bigint, block bigint, outer binary, places binary, data binary"
_CELL = "row bigint, col bigint, v double"
# Products of single cells formed at a time, and cells of sparse sums a task holds.
_FORMED, _SUMMED = 1 << 20, 1 << 21
# A dense product is taken where the single products exceed this share of its multiplications; blocks filled less never reach it.
_DENSE_SHARE = 1 / 16
# Groups that the blocks of an inner block are dealt into before they are packed, and cells a task is given and holds.
_DEALT, _TAKEN = 16, 1 << 21


def multiply(a: DataFrame, b: DataFrame) -> DataFrame:
    """Matrix product of sparse cells: sides meet by inner index, products are summed per cell.

    A task takes the right cells of its inner indices and then the left cells in the order of their rows, so the sums of
    a row are done with the row: a task holds its right cells, a bounded number of products and the sums of one row,
    however many cells the result has, and sends a cell once at most unless one row has more than ``_SUMMED``.
    Indices are whole numbers, values doubles. Nulls count as in SQL: an outer one is a group, an inner one
    meets nothing, a sum of nulls is null. For dense matrices use :func:`block_multiply`, which forms no single products.
    """
    cells = _tagged(b, False, "row", "col").unionByName(_tagged(a, True, "col", "row"))
    inner = F.when(F.col("left"), F.col("other")).otherwise(F.col("place"))
    sums = cells.repartition(inner).sortWithinPartitions("left", "place").mapInArrow(_row_sums, _CELL)
    # Dealt before they are added up: combined on the map side, each task would hold all cells of the result. Columns of a
    # row go together, which packs well, but not all columns of a long row.
    strip = F.shiftright("col", 10).alias("strip")
    total = sums.select("*", strip).repartition("row", "strip").groupBy("row", "strip", "col").agg(F.sum("v").alias("v"))
    return total.select(F.col("row").cast(a.schema["row"].dataType), F.col("col").cast(b.schema["col"].dataType), "v")


def _tagged(cells: DataFrame, left: bool, inner: str, outer: str) -> DataFrame:
    """Cells of a side; ``place`` is the index they are sorted by, the outer one on the left and the inner one on the right."""
    place, other = (outer, inner) if left else (inner, outer)
    return cells.where(F.col(inner).isNotNull()).select(
        F.lit(left).alias("left"), F.col(place).cast("bigint").alias("place"), F.col(other).cast("bigint").alias("other"),
        F.col("v").cast("double").alias("v"),
    )


def _filled(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values, 0 for null, and which are not null."""
    return column.fill_null(0).to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)


class _Right:
    """Right cells in the order of their inner index; columns are numbered."""

    def __init__(self, batches: list[pa.RecordBatch]):
        def whole(name: str) -> pa.Array:
            return pa.concat_arrays([b.column(name) for b in batches])

        places = whole("place").to_numpy()
        first = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
        self.inner, self.edges = places[first], np.append(first, len(places))
        numbered = whole("other").dictionary_encode(null_encoding="encode")
        self.columns, self.column = numbered.dictionary, numbered.indices.to_numpy()
        self.weight, self.known = _filled(whole("v"))


def _per_cell(places: np.ndarray, values: np.ndarray, known: np.ndarray, area: int) -> list[np.ndarray]:
    """Cells below ``area`` that have products, the sums of these and how many are not null."""
    if area > 4 * len(places):
        at, sums = _summed(places, values)
        return [at, sums, _summed(places, known)[1]]
    at = np.flatnonzero(np.bincount(places, minlength=area))
    return [at, np.bincount(places, values, area)[at], np.bincount(places, known, area)[at].astype(np.int64)]


def _row_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per row and column of right cells in the order of their inner index and, after these, left cells in that of their rows.

    At most ``_FORMED`` products (or one left cell's) are formed at a time. The sums of the last row wait for its next cells.
    """
    rights: list[pa.RecordBatch] = []
    right: _Right | None = None
    row, waiting = None, None

    def cells(rows: pa.Array, sums: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [rows, right.columns.take(pa.array(sums[0])), pa.array(sums[1], mask=sums[2] == 0)], ["row", "col", "v"]
        )

    def open_row() -> pa.RecordBatch:
        return cells(pa.array([row] * len(waiting[0]), pa.int64()), waiting)

    for batch in batches:
        first = len(batch) - batch.column("left").true_count
        if first:
            rights.append(batch.slice(0, first))
        batch = batch.slice(first)
        if not rights or not len(batch):
            continue
        if right is None:
            right = _Right(rights)
            del rights[1:]
        inner = batch.column("other").to_numpy()
        at = np.minimum(np.searchsorted(right.inner, inner), len(right.inner) - 1)
        met = np.flatnonzero(right.inner[at] == inner)
        low, many = right.edges[at[met]], np.diff(right.edges)[at[met]]
        (values, known), rows = _filled(batch.column("v")), batch.column("place")
        place, filled = _filled(rows)
        ends, wide, first = np.cumsum(many), len(right.columns), 0
        while first < len(met):
            end = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + _FORMED, "right")))
            some, n = met[first:end], many[first:end]
            starts = np.flatnonzero(
                np.append(True, (place[some[1:]] != place[some[:-1]]) | (filled[some[1:]] != filled[some[:-1]]))
            )
            run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(some))))
            which = np.repeat(low[first:end] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both = np.repeat(known[some], n) & right.known[which]
            parts = [
                np.repeat(run * wide, n) + right.column[which],
                np.where(both, np.repeat(values[some], n) * right.weight[which], 0.0), both.astype(np.int64),
            ]
            if waiting:
                if row == rows[int(some[0])].as_py():
                    parts = [np.concatenate(p) for p in zip(waiting, parts)]
                else:
                    yield open_row()
            sums = _per_cell(*parts, len(starts) * wide)
            last = int(np.searchsorted(sums[0], (len(starts) - 1) * wide))
            if last:
                done = [s[:last] for s in sums]
                at_row = pa.array(some[starts[done[0] // wide]])
                yield cells(rows.take(at_row), [done[0] % wide, *done[1:]])
            row = rows[int(some[-1])].as_py()
            waiting = [sums[0][last:] - (len(starts) - 1) * wide, sums[1][last:], sums[2][last:]]
            if len(waiting[0]) > _SUMMED:
                yield open_row()
                waiting = None
            first = end
    if waiting:
        yield open_row()


def _coded(places: np.ndarray, values: np.ndarray, size: int) -> tuple[bytes | None, bytes]:
    """A block's cells (places in order), or the whole block where that is shorter."""
    if 12 * len(places) < 8 * size * size:
        return places.astype(np.int32).tobytes(), values.tobytes()
    block = np.zeros(size * size)
    block[places] = values
    return None, block.tobytes()


def _cells(places: pa.Scalar, data: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a stored block."""
    values = np.frombuffer(data.as_buffer())
    if places.is_valid:
        return np.frombuffer(places.as_buffer(), dtype=np.int32), values
    at = np.flatnonzero(values)
    return at, values[at]


def _block(places: pa.Scalar, data: pa.Scalar, size: int) -> np.ndarray:
    values = np.frombuffer(data.as_buffer())
    if not places.is_valid:
        return values.reshape(size, size)
    block = np.zeros(size * size)
    block[np.frombuffer(places.as_buffer(), dtype=np.int32)] = values
    return block.reshape(size, size)


def _summed(places: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One value per place, in order."""
    if not len(places):
        return places, values
    order = np.argsort(places, kind="stable")
    places, values = places[order], values[order]
    first = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
    return places[first], np.add.reduceat(values, first)


def _by_block(rows: DataFrame) -> DataFrame:
    """Rows of a block side by side, so that a task streams over many blocks."""
    return rows.repartition("bi", "bj").sortWithinPartitions("bi", "bj")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    """Block and its first and end row, for rows in the order of their blocks."""
    bi, bj = batch.column("bi").to_numpy(), batch.column("bj").to_numpy()
    if len(bi):
        cuts = np.flatnonzero((bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1])) + 1
        edges = [0, *cuts.tolist(), len(bi)]
        for first, end in zip(edges, edges[1:]):
            yield (int(bi[first]), int(bj[first])), first, end


def _block_rows(blocks: list[tuple[tuple[int, int], bytes | None, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([b[0][0] for b in blocks], pa.int64()), pa.array([b[0][1] for b in blocks], pa.int64()),
            pa.array([b[1] for b in blocks], pa.binary()), pa.array([b[2] for b in blocks], pa.binary()),
        ],
        ["bi", "bj", "places", "data"],
    )


def _packed_rows(bk: np.ndarray, block: np.ndarray, places: np.ndarray, values: np.ndarray, size: int, inner_first: bool) -> pa.RecordBatch:
    """Cells in the order of their inner block, dealt group and block: well filled blocks one by one, the others of a group in one row."""
    first = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (bk[1:] != bk[:-1])))
    ends = np.append(first[1:], len(block))
    alone = (ends - first) * 1.0 >= _DENSE_SHARE * size * size
    rows: list[tuple] = [
        (int(bk[f]), int(block[f]), int(block[f]), None, *_coded(places[f:e], values[f:e], size))
        for f, e in zip(first[alone].tolist(), ends[alone].tolist())
    ]
    left = np.repeat(~alone, ends - first)
    bk, block, places, values = bk[left], block[left], places[left], values[left]
    if len(bk):
        inner, outer = (places // size, places % size) if inner_first else (places % size, places // size)
        outer, inner, deal = outer + block * size, inner.astype(np.int32), block % _DEALT
        cuts = np.flatnonzero((bk[1:] != bk[:-1]) | (deal[1:] != deal[:-1])) + 1
        for f, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bk)]):
            rows.append((int(bk[f]), int(block[f]), None, outer[f:e].tobytes(), inner[f:e].tobytes(), values[f:e].tobytes()))
    types = [pa.int64()] * 3 + [pa.binary()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["bk", "deal", "block", "outer", "places", "data"])


def _pack(cells: DataFrame, size: int, inner: str) -> DataFrame:
    """``size`` x ``size`` blocks, as long as their cells need; cells that come more than once are summed.

    Nearly empty blocks share a row: ``outer`` has the index of each cell along the other side than ``inner``, ``places`` its place in
    the inner block. A block's cells are summed whenever they exceed its area, so memory is bounded by that however often cells repeat.
    """
    area, outer = size * size, "col" if inner == "row" else "row"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        count, most = 0, max(1 << 19, 2 * area)

        def summed() -> list[np.ndarray]:
            bk, block, places, values = (np.concatenate(c) for c in zip(*held))
            first = np.append(True, (block[1:] != block[:-1]) | (bk[1:] != bk[:-1]))
            at, values = _summed((np.cumsum(first) - 1) * area + places, values)
            start = np.flatnonzero(first)[at // area]
            return [bk[start], block[start], at % area, values]

        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in ("bk", "block", "place", "v")])
            count += len(batch)
            if count > most:
                whole = summed()
                # the last block may go on
                last = int(np.flatnonzero((whole[1] != whole[1][-1]) | (whole[0] != whole[0][-1])).max(initial=-1)) + 1
                if last:
                    yield _packed_rows(*(c[:last] for c in whole), size, inner == "row")
                held = [[c[last:] for c in whole]]
                count = len(held[0][0])
        if count:
            yield _packed_rows(*summed(), size, inner == "row")

    whole = cells.where("row is not null and col is not null and v is not null").select(
        F.floor(F.col(inner) / size).alias("bk"),
        F.floor(F.col(outer) / size).alias("block"),
        (F.pmod("row", F.lit(size)) * size + F.pmod("col", F.lit(size))).cast("long").alias("place"),
        F.col("v").cast("double").alias("v"),
    )
    deal = F.pmod("block", F.lit(_DEALT))
    return whole.repartition("bk", deal).sortWithinPartitions("bk", deal, "block").mapInArrow(pack, _PACKED)


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and values of all blocks end to end, and each cell's block."""
    many = np.array([len(p[0]) for p in parts])
    places = np.concatenate([p[0] for p in parts]).astype(np.int64)
    return places, np.concatenate([p[1] for p in parts]), np.repeat(np.arange(len(parts)), many)


def _row_by_row(
    lefts: list[tuple[np.ndarray, np.ndarray]], rights: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, size: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Products of many pairs of sparse blocks at once: each left cell meets its row of the right block.

    Yields sums per place, where a place is ``target * size^2`` plus the place in the block; the work is that of the
    single products and at most ``_FORMED`` of them (or one left cell's row) are formed at a time.
    """
    lp, lv, pair = _joined(lefts)
    rp, rv, right_pair = _joined(rights)
    row = right_pair * size + rp // size
    inner = pair * size + lp % size
    low, high = np.searchsorted(row, inner, "left"), np.searchsorted(row, inner, "right")
    met = np.flatnonzero(high > low)
    low, many = low[met], (high - low)[met]
    base = target[pair[met]] * (size * size) + lp[met] // size * size
    column, weight, ends = rp % size, lv[met], np.cumsum(many)
    first = 0
    while first < len(met):
        end = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + _FORMED, "right")))
        n = many[first:end]
        which = np.repeat(low[first:end] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        yield _summed(np.repeat(base[first:end], n) + column[which], np.repeat(weight[first:end], n) * rv[which])
        first = end


def _parts(cells: DataFrame, outer: str, inner: str, size: int, group: int, name: str) -> DataFrame:
    """How many parts a side's blocks of each inner block make; a block counts with its cells, at most its area."""
    area = size * size
    whole = cells.where("row is not null and col is not null and v is not null").select(
        F.floor(F.col(inner) / size).alias("bk"), F.floor(F.col(outer) / size).alias("_b")
    )
    all_cells = whole.groupBy("bk").agg(F.count("*").alias("_n"))
    # Blocks only matter where there are more cells than one part takes: at most one inner block for every ``group * area`` cells.
    many = F.broadcast(all_cells.where(F.col("_n") > group * area).select("bk"))
    blocks = whole.join(many, "bk").groupBy("bk", "_b").count()
    parts = blocks.groupBy("bk").agg(F.ceil(F.sum(F.least("count", F.lit(area))) / (group * area)).alias(name))
    return all_cells.join(parts, "bk", "left").select("bk", F.coalesce(name, F.lit(1).cast("bigint")).alias(name), F.col("_n").alias(f"{name}_n"))


class _RightSide:
    """Packed right rows of a task by key; sets of them become cells where left cells need these."""

    def __init__(self, size: int):
        self.size, self.rows, self.order = size, {}, {}

    def add(self, key: tuple[int, int, int], block: int | None, row: tuple) -> None:
        self.rows.setdefault(key, []).append((block, row))

    def alone(self, key: tuple[int, int, int]) -> list[tuple[int, int, tuple]]:
        """Single blocks of a key as (cells, block, row), the emptiest first."""
        if key not in self.order:
            area = self.size * self.size
            blocks = [(len(r[1].as_buffer()) // 4 if r[1].is_valid else area, b, r) for b, r in self.rows.get(key, ()) if b is not None]
            self.order[key] = sorted(blocks, key=lambda x: x[0])
        return self.order[key]

    def cells(self, key: tuple[int, int, int], single: int) -> list[np.ndarray]:
        """Inner place, column and value of what shares rows and of the ``single`` emptiest single blocks."""
        parts = []
        for block, row in self.rows[key]:
            if block is None:
                parts.append([np.frombuffer(row[1].as_buffer(), np.int32), np.frombuffer(row[0].as_buffer(), np.int64), np.frombuffer(row[2].as_buffer())])
        for _, block, row in self.alone(key)[:single]:
            places, values = _cells(row[1], row[2])
            parts.append([places // self.size, places % self.size + block * self.size, values])
        return [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def _swept(left: list[np.ndarray], right: list[np.ndarray], size: int) -> Iterator[pa.RecordBatch]:
    """Partial blocks of the sums of left cells (row, inner index, value, in any order) with right ones (inner index, column, value).

    At most ``_FORMED`` products (or one left cell's) are formed at a time, cut between block rows where that is possible. Both lists
    are emptied, as a task may hold no second copy of its cells.
    """
    rows, inner, values = left
    left[:] = []
    by_inner = np.argsort(right[0], kind="stable")
    weight = right[2][by_inner]
    columns, column = np.unique(right[1][by_inner], return_inverse=True)
    right[0] = right[0][by_inner]
    low = np.searchsorted(right[0], inner, "left").astype(np.int32)
    many = np.searchsorted(right[0], inner, "right").astype(np.int32) - low
    column, right[:] = column.astype(np.int32), []
    del inner
    order = np.argsort(rows, kind="stable")
    order = order[many[order] > 0].astype(np.int32)
    rows, values, low, many = rows[order], values[order], low[order], many[order]
    ends, wide, first = np.cumsum(many, dtype=np.int64), len(columns), 0
    while first < len(rows):
        end = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + _FORMED, "right")))
        if end < len(rows) and rows[end] // size == rows[end - 1] // size:
            edge = int(np.searchsorted(rows, rows[end] // size * size))
            end = edge if edge > first else end
        n = many[first:end]
        which = np.repeat(low[first:end] - (np.cumsum(n, dtype=np.int64) - n), n) + np.arange(n.sum(dtype=np.int64))
        starts = np.append(True, rows[first + 1 : end] != rows[first : end - 1])
        run = np.repeat(np.cumsum(starts) - 1, n)
        products = np.repeat(values[first:end], n) * weight[which]
        at, own = run * wide + column[which], rows[first:end][starts]
        if len(own) * wide <= 4 * len(at):
            sums = np.bincount(at, products, len(own) * wide)
            at = np.flatnonzero(sums)
            sums = sums[at]
        else:
            at, sums = _summed(at, products)
        yield from _as_blocks(own[at // wide], columns[at % wide], sums, size)
        first = end


def _as_blocks(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    """Cells in the order of rows and columns as blocks."""
    if not len(rows):
        return
    bi, bj = rows // size, columns // size
    order = np.lexsort((bj, bi)) if len(np.unique(bj)) > 1 else np.arange(len(rows))
    bi, bj = bi[order], bj[order]
    places, values = (rows % size * size + columns % size)[order], values[order]
    cuts = np.flatnonzero((bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1])) + 1
    edges = [0, *cuts.tolist(), len(bi)]
    out = [((int(bi[f]), int(bj[f])), *_coded(places[f:e], values[f:e], size)) for f, e in zip(edges, edges[1:])]
    for i in range(0, len(out), 1024):
        yield _block_rows(out[i : i + 1024])


def block_multiply(a: DataFrame, b: DataFrame, size: int = 256, group: int = 4, held: int = 64) -> DataFrame:
    """Matrix product by blocks; returns the non-zero cells.

    Blocks meet per (row part, column part, inner block), where a part holds blocks with the cells of about
    ``group`` full ones: a block is copied once for each part of the other side, so what is shuffled follows the
    number of cells, however many nearly empty blocks they lie in; these share rows. A task takes its right blocks and then its left ones, so
    each goes to Python once. Nearly empty blocks are multiplied row by row, all left cells of a task in one sweep in the order of
    their rows, with work in proportion to the products of cells; a pair whose fill makes these the larger work is
    multiplied as dense blocks. A task is dealt about ``_TAKEN`` cells of a side, holds the right ones, up to ``_TAKEN`` left ones and
    ``held`` dense result blocks, and the final sum streams over partial blocks. Rows with a null are left out.
    """
    area, spark = size * size, a.sparkSession
    counts = _parts(a, "row", "col", size, group, "_i").join(_parts(b, "col", "row", size, group, "_j"), "bk")
    counts.write.parquet(folder := scratch_dir(spark, "parts"))
    met = spark.read.schema(counts.schema).parquet(folder)
    # what both sides come to with their copies: partial sums grow with the tasks, so these are as large as memory allows
    copies = met.agg(*(F.coalesce(F.sum(F.col(n) * F.col(c)), F.lit(0)) for n, c in (("_i_n", "_j"), ("_j_n", "_i")))).first()
    cores = spark.sparkContext.defaultParallelism
    tasks = -(-max(cores, -(-max(copies) // _TAKEN)) // cores) * cores
    met = met.select("bk", "_i", "_j")

    def places(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1))

    def side(rows: DataFrame, left: bool) -> DataFrame:
        own, other = ("gi", "gj") if left else ("gj", "gi")
        deal = F.pmod(F.xxhash64("deal"), "_i" if left else "_j").alias(own)
        copied = rows.join(met, "bk").select("bk", deal, places("_j" if left else "_i").alias(other), "block", "outer", "places", "data")
        return copied.select(F.lit(left).alias("left"), "gi", "gj", "bk", "block", "outer", "places", "data")

    both = side(_pack(b, size, "row"), False).unionByName(side(_pack(a, size, "col"), True))

    def dense_rows(sums: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
        return _block_rows([(spot, *_coded(np.flatnonzero(s), s.ravel()[np.flatnonzero(s)], size)) for spot, s in sums.items()])

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = _RightSide(size)
        sums: dict[tuple[int, int], np.ndarray] = {}
        sets: dict[tuple, int] = {}
        cells: list[list[np.ndarray]] = []
        waiting: list[list[np.ndarray]] = []
        count = 0

        def sweep() -> Iterator[pa.RecordBatch]:
            left, own = ([np.concatenate(c) for c in zip(*x)] for x in (waiting, cells))
            sets.clear(), cells.clear(), waiting.clear()
            return _swept(left, own, size)

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("gi", "gj", "bk"))))
            blocks, lefts = batch.column("block").to_pylist(), batch.column("left").to_pylist()
            for i, (key, block, left) in enumerate(zip(keys, blocks, lefts)):
                row = tuple(batch.column(c)[i] for c in ("outer", "places", "data"))
                if not left:
                    right.add(key, block, row)
                    continue
                if key not in right.rows:
                    continue
                alone = right.alone(key)
                single = len(alone)
                if block is None:
                    outer, inner = np.frombuffer(row[0].as_buffer(), np.int64), np.frombuffer(row[1].as_buffer(), np.int32)
                    values = np.frombuffer(row[2].as_buffer())
                else:
                    filled = len(row[1].as_buffer()) // 4 if row[1].is_valid else area
                    single = sum(filled * n / size < _DENSE_SHARE * size * area for n, _, _ in alone)
                    whole = _block(row[1], row[2], size) if single < len(alone) else None
                    for _, other, r in alone[single:]:
                        part, spot = whole @ _block(r[1], r[2], size), (block, other)
                        if spot in sums:
                            sums[spot] += part
                        else:
                            if len(sums) >= held:
                                yield dense_rows(sums)
                                sums = {}
                            sums[spot] = part
                    if not single and len(alone) == len(right.rows[key]):
                        continue
                    at, values = _cells(row[1], row[2])
                    outer, inner = at // size + block * size, at % size
                if (key, single) not in sets:
                    sets[key, single] = len(sets)
                    found = right.cells(key, single)
                    cells.append([found[0] + sets[key, single] * size, *found[1:]])
                    count += len(found[0])
                waiting.append([outer, inner + np.int64(sets[key, single] * size), values])
                count += len(outer)
                if count > 3 * _TAKEN:
                    yield from sweep()
                    count = 0
        if waiting:
            yield from sweep()
        if sums:
            yield dense_rows(sums)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, block, waiting = None, [], None, 0

        def cells() -> pa.RecordBatch:
            if block is not None:
                places, values = np.flatnonzero(block), block.ravel()[np.flatnonzero(block)]
            else:
                places, values = _summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                places, values = places[values != 0], values[values != 0]
            return pa.RecordBatch.from_arrays(
                [pa.array(places // size + now[0] * size, pa.int64()), pa.array(places % size + now[1] * size, pa.int64()), pa.array(values)],
                ["row", "col", "v"],
            )

        out: list[pa.RecordBatch] = []
        for batch in batches:
            places, data = batch.column("places"), batch.column("data")
            for spot, first, end in _runs(batch):
                if spot != now:
                    if now is not None:
                        out.append(cells())
                    now, parts, block, waiting = spot, [], None, 0
                for i in range(first, end):
                    if block is None and (not places[i].is_valid or waiting > area):
                        block = np.zeros((size, size))
                        for p, v in parts:
                            block.ravel()[p] += v
                    if block is None:
                        parts.append(_cells(places[i], data[i]))
                        waiting += len(parts[-1][0])
                    elif places[i].is_valid:
                        p, v = _cells(places[i], data[i])
                        block.ravel()[p] += v
                    else:
                        block += _block(places[i], data[i], size)
            if sum(len(o) for o in out) > 1 << 16:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                out = []
        if now is not None:
            out.append(cells())
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    dealt = both.repartition(tasks, "gi", "gj", "bk").sortWithinPartitions("left", "gi", "gj", "bk")
    return _by_block(dealt.mapInArrow(product, _BLOCK)).mapInArrow(total, _CELL)


def filter_grid(grid: DataFrame, kernel: list[list[float]], side: int, tile: int = 256) -> DataFrame:
    """Weighted sum of each cell's neighbourhood on a ``side`` x ``side`` grid.

    The kernel is not flipped, cells outside count as 0 and every
    cell of the grid is returned. Each cell travels to its own tile and, near an
    edge, to the tiles next door, so the shuffle is about the size of the
    grid, not of grid times kernel.
    """
    n = len(kernel)
    if n % 2 == 0 or any(len(line) != n for line in kernel):
        raise ValueError("the kernel must be square with an odd side")
    half, taps = n // 2, np.array(kernel, dtype=float)
    last = (side - 1) // tile

    def tiles(axis: str):
        first = F.greatest(F.floor((F.col(axis) - half) / tile), F.lit(0))
        final = F.least(F.floor((F.col(axis) + half) / tile), F.lit(last))
        return F.explode(F.sequence(first.cast("bigint"), final.cast("bigint")))

    cells = grid.select("y", "x", F.col("v").cast("double").alias("v"))
    spread = cells.withColumn("ty", tiles("y")).withColumn("tx", tiles("x"))
    # One marker per tile, so that tiles without any cell appear as zeros.
    markers = grid.sparkSession.range((last + 1) ** 2).select(
        F.lit(None).cast("int").alias("y"), F.lit(None).cast("int").alias("x"),
        F.lit(None).cast("double").alias("v"),
        F.floor(F.col("id") / (last + 1)).alias("ty"), F.pmod("id", F.lit(last + 1)).alias("tx"),
    )

    def apply(key: tuple, part: pa.Table) -> pa.Table:
        y0, x0 = key[0].as_py() * tile, key[1].as_py() * tile
        high, wide = min(tile, side - y0), min(tile, side - x0)
        part = part.drop_null()
        patch = np.zeros((high + 2 * half, wide + 2 * half))
        ys, xs = (part.column(c).to_numpy() for c in ("y", "x"))
        patch[ys - y0 + half, xs - x0 + half] = part.column("v").to_numpy()
        out = np.zeros((high, wide))
        for i in range(n):
            for j in range(n):
                out += taps[i, j] * patch[i : i + high, j : j + wide]
        y, x = np.mgrid[y0 : y0 + high, x0 : x0 + wide]
        return pa.table(
            {"y": pa.array(y.ravel(), pa.int64()), "x": pa.array(x.ravel(), pa.int64()), "v": out.ravel()}
        )

    keyed = spread.select("ty", "tx", "y", "x", "v").unionByName(markers)
    return keyed.groupBy("ty", "tx").applyInArrow(apply, "y bigint, x bigint, v double")
