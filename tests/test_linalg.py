import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabloom.operators import linalg


def cells(spark, m):
    rows = [(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))]
    return spark.createDataFrame(rows, "row bigint, col bigint, v double")


def dense(df, shape):
    out = np.zeros(shape)
    for r in df.collect():
        out[r["row"], r["col"]] += r["v"]
    return out


@pytest.mark.parametrize("n, k, m", [(20, 33, 17), (5, 70, 3), (1, 1, 1)])
def test_products_equal_numpy(spark, n, k, m):
    rng = np.random.default_rng(n)
    a = rng.integers(0, 5, (n, k)) * (rng.random((n, k)) < 0.6) + np.eye(n, k)
    b = rng.integers(0, 5, (k, m)) + np.eye(k, m)
    left, right = cells(spark, a), cells(spark, b)
    assert np.allclose(dense(linalg.multiply(left, right), (n, m)), a @ b)
    got = linalg.block_multiply(left, right, size=8, group=2, held=2)
    assert np.allclose(dense(got, (n, m)), a @ b)
    assert got.count() == np.count_nonzero(a @ b)


def test_empty_matrix(spark):
    a = cells(spark, np.eye(3))
    assert linalg.block_multiply(a.limit(0), a).count() == 0


@pytest.mark.parametrize("side, tile, kernel", [(13, 4, 3), (13, 5, 5), (6, 100, 7), (9, 3, 1)])
def test_filter_equals_a_loop(spark, side, tile, kernel):
    rng = np.random.default_rng(side)
    image = rng.integers(0, 256, (side, side)) * (rng.random((side, side)) < 0.4)
    taps = rng.normal(size=(kernel, kernel))
    grid = cells(spark, image).toDF("y", "x", "v")
    rows = linalg.filter_grid(grid, taps.tolist(), side, tile).collect()
    half = kernel // 2
    padded = np.pad(image, half)
    expected = np.array(
        [[(padded[y : y + kernel, x : x + kernel] * taps).sum() for x in range(side)] for y in range(side)]
    )
    assert len(rows) == side * side
    out = np.zeros((side, side))
    for r in rows:
        out[r["y"], r["x"]] = r["v"]
    assert np.allclose(out, expected)


def test_empty_tiles_are_zeros_and_int_columns_work(spark):
    grid = spark.createDataFrame([(0, 0, 5)], "y int, x int, v int")
    rows = linalg.filter_grid(grid, [[1.0]], 10, 4)
    assert rows.count() == 100 and rows.agg(F.sum("v")).head()[0] == 5.0


@pytest.mark.parametrize("kernel", [[[1.0, 2.0], [3.0, 4.0]], [[1.0, 2.0, 3.0]]])
def test_even_or_uneven_kernels_are_refused(spark, kernel):
    with pytest.raises(ValueError):
        linalg.filter_grid(cells(spark, np.eye(3)).toDF("y", "x", "v"), kernel, 3)


def test_repeated_cells_add_up(spark):
    left = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0), (90, 3, 1.0)], "row long, col long, v double")
    right = spark.createDataFrame([(0, 70, 1.0), (3, 0, 4.0), (500, 1, 9.0)], "row long, col long, v double")
    got = {(r["row"], r["col"]): r["v"] for r in linalg.block_multiply(left, right, size=8, group=2).collect()}
    assert got == {(0, 70): 3.0, (90, 0): 4.0}
    assert got == {(r["row"], r["col"]): r["v"] for r in linalg.multiply(left, right).collect()}


@pytest.mark.parametrize("fill", [(0.002, 0.002), (0.002, 0.5), (0.7, 0.9)])
def test_blocks_of_any_fill_equal_numpy(spark, fill, monkeypatch):
    monkeypatch.setattr(linalg, "_FORMED", 50)
    monkeypatch.setattr(linalg, "_SUMMED", 100)
    rng = np.random.default_rng(7)
    a = rng.integers(1, 9, (150, 130)) * (rng.random((150, 130)) < fill[0])
    b = rng.integers(1, 9, (130, 170)) * (rng.random((130, 170)) < fill[1])
    b[:, :20] = rng.integers(-4, 5, (130, 20))
    got = linalg.block_multiply(cells(spark, a), cells(spark, b), size=32, group=2, held=2)
    assert np.array_equal(dense(got, (150, 170)), a @ b)
    assert got.count() == np.count_nonzero(a @ b)


def test_work_follows_the_products_of_cells():
    """A row of the right block is met only by left cells of its inner index, whatever the size of the blocks."""
    size, many = 4096, 5000
    left = [(np.array([3 * size + i % size]), np.array([2.0])) for i in range(many)]
    right = [(np.array([i % size * size + 7]), np.array([3.0])) for i in range(many)]
    sums = list(linalg._row_by_row(left, right, np.zeros(many, dtype=np.int64), size))
    assert [(p.tolist(), v.tolist()) for p, v in sums] == [([3 * size + 7], [6.0 * many])]


def test_cells_with_nulls_are_left_out(spark):
    left = spark.createDataFrame([(0, 0, 1.0), (0, None, 2.0), (None, 0, 2.0), (1, 0, None)], "row long, col long, v double")
    right = spark.createDataFrame([(0, 5, 2.0), (None, 5, 1.0)], "row long, col long, v double")
    assert [tuple(r) for r in linalg.block_multiply(left, right, size=8).collect()] == [(0, 5, 2.0)]


def test_nearly_empty_blocks_of_an_inner_block_make_one_part(spark):
    sparse = spark.range(400).selectExpr("id * 8 AS row", "0L AS col", "1.0D AS v")
    full = spark.range(8 * 8 * 8).selectExpr("id div 8 AS row", "8 + id % 8 AS col", "1.0D AS v")
    repeated = spark.range(1000).selectExpr("0L AS row", "16L AS col", "1.0D AS v")
    cells = sparse.unionByName(full).unionByName(repeated)
    found = {r["bk"]: r["n"] for r in linalg._parts(cells, "row", "col", 8, 4, "n").collect()}
    assert found == {0: 2, 1: 2, 2: 1}


def test_sparse_products_have_no_map_side_combine(spark):
    """Sums are dealt before Spark adds them up, so no task holds the cells of the whole result."""
    cell = spark.range(10).selectExpr("id AS row", "id AS col", "1.0D AS v")
    plan = linalg.multiply(cell, cell)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.index("partial_sum") < plan.index("Exchange") < plan.index("MapInArrow")


def test_sums_of_a_row_are_passed_on_with_the_row():
    """What a task holds does not grow with the cells of the result."""
    wide, per_row = 100, 3

    def batch(left, place, other):
        return pa.RecordBatch.from_arrays(
            [pa.array([left] * len(place)), pa.array(place), pa.array(other), pa.array(np.ones(len(place)))],
            ["left", "place", "other", "v"],
        )

    def batches(rows):
        yield batch(False, np.repeat(np.arange(per_row), wide), np.tile(np.arange(wide), per_row))
        for first in range(0, rows, 100):
            yield batch(True, np.repeat(np.arange(first, first + 100), per_row), np.tile(np.arange(per_row), 100))

    most = []
    for rows in (1000, 10000):
        tracemalloc.start()
        found = sum(int(b.num_rows) for b in linalg._row_sums(batches(rows)) if set(b.column("v").to_pylist()) == {3.0})
        most.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert found == rows * wide
    assert most[1] < 1.2 * most[0]


def _reference(left, right):
    found = {}
    for row, k, v in left:
        for inner, col, w in right:
            if k is not None and k == inner:
                found.setdefault((row, col), []).append(None if v is None or w is None else v * w)
    return {k: sum(x for x in v if x is not None) if any(x is not None for x in v) else None for k, v in found.items()}


@pytest.mark.parametrize("formed, summed", [(1 << 20, 1 << 21), (3, 1 << 21), (50, 2), (1, 1)])
def test_sparse_products_count_nulls_as_sql_does(spark, formed, summed, monkeypatch):
    monkeypatch.setattr(linalg, "_FORMED", formed)
    monkeypatch.setattr(linalg, "_SUMMED", summed)
    rng = np.random.default_rng(3)

    def some(n, outer, first):
        def index(high):
            x = int(rng.integers(-2, high))
            return None if x == high - 1 else x

        rows = [(index(outer), index(6), None if rng.random() < 0.3 else float(rng.integers(-3, 9))) for _ in range(n)]
        return rows if first else [(k, o, v) for o, k, v in rows]

    left, right = some(90, 6, True), some(40, 12, False)
    left += [(50, 2, None), (0, 3, 0.0)]
    schema = "row int, col bigint, v double"
    made = [spark.createDataFrame(x, schema) for x in (left, right)]
    got = linalg.multiply(*made)
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "bigint", "double"]
    assert {(r["row"], r["col"]): r["v"] for r in got.collect()} == _reference(left, right)
    # the tasks of a local session are other processes: the bounds are set here
    flags = [(False, k, o, v) for k, o, v in right if k is not None] + [(True, o, k, v) for o, k, v in left if k is not None]
    flags.sort(key=lambda r: (r[0], r[1] is not None, r[1] or 0))
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in flags[at : at + 7]], t) for i, t in enumerate((pa.bool_(), pa.int64(), pa.int64(), pa.float64()))],
            ["left", "place", "other", "v"],
        )
        for at in range(0, len(flags), 7)
    ]
    sums = {}
    for b in linalg._row_sums(iter(batches)):
        for r in b.to_pylist():
            old = sums.get((r["row"], r["col"]))
            sums[r["row"], r["col"]] = old if r["v"] is None else (old or 0.0) + r["v"]
    assert sums == _reference(left, right)


def test_empty_sides_have_no_sparse_product(spark):
    cell = spark.createDataFrame([(1, 2, 3.0)], "row bigint, col bigint, v double")
    for left, right in ((cell.limit(0), cell), (cell, cell.limit(0)), (cell, cell)):
        assert linalg.multiply(left, right).count() == 0


def test_nearly_empty_blocks_share_rows(spark):
    """A cell alone in its block costs a cell, not a row; cells that repeat still add up and full blocks stay blocks."""
    alone = spark.range(2000).selectExpr("id * 8 AS row", "id % 2 AS col", "1.0D AS v")
    full = spark.range(64).selectExpr("id div 8 AS row", "8 + id % 8 AS col", "2.0D AS v")
    rows = linalg._pack(alone.unionByName(alone).unionByName(full), 8, "col").collect()
    single = [r for r in rows if r["block"] is not None]
    assert [(r["bk"], r["block"], r["places"]) for r in single] == [(1, 0, None)]
    assert set(np.frombuffer(single[0]["data"])) == {2.0}
    shared = [r for r in rows if r["block"] is None]
    assert len(shared) == linalg._DEALT
    found = {int(o): (int(p), float(v)) for r in shared for o, p, v in zip(
        np.frombuffer(r["outer"], np.int64), np.frombuffer(r["places"], np.int32), np.frombuffer(r["data"]), strict=True
    )}
    assert found == {i * 8: (i % 2, 2.0) for i in range(2000)}


@pytest.mark.parametrize("formed", [1 << 20, 200, 1])
def test_a_sweep_sums_the_rows_of_all_pairs_of_a_task(formed, monkeypatch):
    """Left cells of many inner blocks give one block for each block of the result, unless their products exceed the bound."""
    monkeypatch.setattr(linalg, "_FORMED", formed)
    rng = np.random.default_rng(5)
    size, left, right = 16, rng.integers(0, 9, (64, 300)) * (rng.random((64, 300)) < 0.05), rng.integers(-2, 3, (300, 20))
    (rows, inner), (places, columns) = np.nonzero(left), np.nonzero(right)
    mixed = rng.permutation(len(rows))
    blocks = list(linalg._swept(
        [rows[mixed], inner[mixed], left[rows, inner][mixed].astype(float)], [places, columns, right[places, columns].astype(float)], size
    ))
    out = np.zeros((64, 32))
    spots = [r for b in blocks for r in b.to_pylist()]
    for r in spots:
        block = np.zeros(size * size)
        values = np.frombuffer(r["data"])
        if r["places"] is None:
            block[:] = values
        else:
            block[np.frombuffer(r["places"], np.int32)] = values
        out[r["bi"] * size : (r["bi"] + 1) * size, r["bj"] * size : (r["bj"] + 1) * size] += block.reshape(size, size)
    assert np.array_equal(out[:, :20], left @ right)
    if formed == 1 << 20:
        assert len(spots) == 4 * 2


@pytest.mark.parametrize("taken", [1 << 8, 1 << 21])
def test_blocks_of_all_fills_side_by_side_equal_numpy(spark, taken, monkeypatch):
    """Single and shared blocks of an inner block on both sides, columns far apart, negative indices."""
    monkeypatch.setattr(linalg, "_TAKEN", taken)
    rng = np.random.default_rng(11)
    fills = np.repeat(np.repeat([[0.02, 0.2, 0.9], [0.4, 0.01, 0.1], [0.03, 0.03, 1.0]], 16, axis=0), 16, axis=1)
    a = rng.integers(1, 9, (48, 48)) * (rng.random((48, 48)) < fills)
    b = rng.integers(-3, 9, (48, 48)) * (rng.random((48, 48)) < fills[:, ::-1])
    left = cells(spark, a).withColumn("row", F.col("row") * 1000 - 7)
    right = cells(spark, b).withColumn("col", F.col("col") - 20)
    for sides in ((cells(spark, a), right), (left, right)):
        got = linalg.block_multiply(*sides, size=16, group=1, held=2).collect()
        found = np.zeros((48, 48))
        for r in got:
            found[r["row"] if sides[0] is not left else (r["row"] + 7) // 1000, r["col"] + 20] += r["v"]
        assert np.array_equal(found, a @ b) and len(got) == np.count_nonzero(a @ b)
