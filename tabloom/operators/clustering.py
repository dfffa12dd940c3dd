"""K-means with all restarts in one pass over the rows.

Rows are packed once into blocks (sparse or dense) that stay on the executors. Every pass is one job: a block is multiplied with the
centroids of all restarts that still move, a task hands on one partial sum per restart, and the sums meet in a tree, so a
group never holds more than ``FAN_IN`` of them. Seeds come from k-means||: in each round every restart draws 2k rows
with weights by their squared distance to the candidates so far (an exponential race, so one pass draws exactly that many),
and the candidates, weighted by the rows next to them, are reduced to k on the driver.

The driver holds restarts x k centroids and the candidates; both are parameters, not data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tabloom.session import dealt

FAN_IN = 64
SEED_ROUNDS = 3
# Cells of a product held at a time: few enough to stay in a core's cache.
_CELLS = 1 << 17
# Rows and stored values of a block.
_BLOCK_ROWS, _BLOCK_VALUES = 2048, 1 << 17
# Bytes of blocks on their way to Python at a time.
_BATCH_BYTES = 1 << 21
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"

_PACKED = "n int, starts binary, indices binary, data binary"


class Block:
    """Rows of a sparse or (without indices) dense matrix."""

    def __init__(self, n: int, starts: np.ndarray, indices: np.ndarray | None, data: np.ndarray, size: int):
        self.n, self.starts, self.indices, self.size = n, starts, indices, size
        self.data = data if indices is not None else data.reshape(n, size)
        filled = np.flatnonzero(np.diff(starts)) if indices is not None else None
        self.filled = filled
        if indices is None:
            self.square = np.einsum("ij,ij->i", self.data, self.data)
        else:
            self.square = self._sum(data * data)

    def _sum(self, values: np.ndarray) -> np.ndarray:
        """Sum of the values of each row."""
        out = np.zeros((self.n, *values.shape[1:]))
        if len(values):
            out[self.filled] = np.add.reduceat(values, self.starts[self.filled], axis=0)
        return out

    def times(self, columns: np.ndarray) -> np.ndarray:
        """The product with a (size x m) matrix."""
        if self.indices is None:
            return self.data @ columns
        out = np.zeros((self.n, columns.shape[1]))
        step = max(1, _CELLS // max(1, columns.shape[1]))
        first = 0
        while first < self.n:  # runs of rows whose values fit into a chunk
            last = max(first + 1, int(np.searchsorted(self.starts, self.starts[first] + step, "right")) - 1)
            a, b = self.starts[first], self.starts[last]
            if a < b:
                rows = self.filled[(self.filled >= first) & (self.filled < last)]
                out[rows] = np.add.reduceat(columns[self.indices[a:b]] * self.data[a:b, None], self.starts[rows] - a, axis=0)
            first = last
        return out

    def sums(self, labels: np.ndarray, k: int) -> np.ndarray:
        """(k x size): the sum of the rows of each label."""
        if self.indices is None:
            return (np.arange(k)[:, None] == labels[None, :]).astype(float) @ self.data
        at = np.repeat(labels, np.diff(self.starts)) * self.size + self.indices
        return np.bincount(at, self.data, k * self.size).reshape(k, self.size)

    def row(self, row: int) -> tuple[bytes | None, bytes]:
        """A row as it is stored."""
        if self.indices is None:
            return None, self.data[row].tobytes()
        at = slice(self.starts[row], self.starts[row + 1])
        return self.indices[at].tobytes(), self.data[at].tobytes()


def _dense(indices: bytes | None, data: bytes, size: int) -> np.ndarray:
    """A stored row with its zeros."""
    values = np.frombuffer(data, np.float64)
    if indices is None:
        return values
    out = np.zeros(size)
    out[np.frombuffer(indices, np.int32)] = values
    return out


@contextmanager
def _few_blocks(spark: SparkSession) -> Iterator[None]:
    """Passes read a few blocks per Arrow batch: a batch of the usual bytes, held on both sides of each task, may be a whole partition."""
    before = spark.conf.get(_BATCH_KEY, None)
    spark.conf.set(_BATCH_KEY, str(_BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_KEY)
        else:
            spark.conf.set(_BATCH_KEY, before)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as packed rows: one row per block."""
    for batch in batches:
        fields = batch.column(0)
        part = dict(zip((f.name for f in fields.type), fields.flatten(), strict=True))
        sparse = batch.num_rows > 0 and part["type"][0].as_py() == 0
        sizes = np.diff(part["values"].offsets.to_numpy())
        first, total = 0, np.r_[0, np.cumsum(sizes)]
        while first < batch.num_rows:
            last = min(batch.num_rows, first + _BLOCK_ROWS, max(first + 1, int(np.searchsorted(total, total[first] + _BLOCK_VALUES, "right")) - 1))
            values = part["values"].slice(first, last - first).flatten().to_numpy().astype(np.float64)
            indices = part["indices"].slice(first, last - first).flatten().to_numpy().astype(np.int32).tobytes() if sparse else None
            starts = (total[first : last + 1] - total[first]).astype(np.int64)
            yield pa.RecordBatch.from_pylist(
                [{"n": last - first, "starts": starts.tobytes(), "indices": indices, "data": values.tobytes()}],
                schema=pa.schema([("n", pa.int32()), ("starts", pa.binary()), ("indices", pa.binary()), ("data", pa.binary())]),
            )
            first = last


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Block]:
    for batch in batches:
        starts, indices, data = (batch.column(c) for c in ("starts", "indices", "data"))
        for i, n in enumerate(batch.column("n").to_pylist()):
            held = np.frombuffer(indices[i].as_buffer(), np.int32) if indices[i].is_valid else None
            yield Block(n, np.frombuffer(starts[i].as_buffer(), np.int64), held, np.frombuffer(data[i].as_buffer(), np.float64), size)


class Centres:
    """Centres (restarts x k x size) as every block of a task needs them; worked out where they are first used."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @cached_property
    def columns(self) -> np.ndarray:
        return np.ascontiguousarray(self.table.reshape(-1, self.table.shape[2]).T)

    @cached_property
    def square(self) -> np.ndarray:
        flat = self.table.reshape(-1, self.table.shape[2])
        return np.einsum("ij,ij->i", flat, flat)


def _gaps(block: Block, centres: Centres) -> np.ndarray:
    """Squared distances (n x restarts x k)."""
    gaps = block.square[:, None] - 2 * block.times(centres.columns) + centres.square
    return np.maximum(gaps, 0).reshape(block.n, *centres.table.shape[:2])


def _added(rows: pa.Table) -> pa.Table:
    """The sum of partial sums of one restart."""
    sums = sum(np.frombuffer(x, np.float64) for x in rows["sums"].to_pylist())
    return pa.table({"r": rows["r"][:1], "g": pa.array([0], pa.int32()), "sums": pa.array([sums.tobytes()], pa.binary())})


class Rows:
    """Packed rows on the executors, and the passes over them."""

    def __init__(self, vectors: DataFrame, vector: str):
        # every pass over a few large files would leave cores idle
        self.blocks = dealt(vectors.select(F.col(vector)).mapInArrow(_pack, _PACKED)).persist(StorageLevel.MEMORY_AND_DISK)
        self.count = self.blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        self.size = 0
        if self.count:
            first = vectors.select(vector).head()[0]
            self.size = first.size
        self.tasks = self.blocks.rdd.getNumPartitions()

    def release(self) -> None:
        self.blocks.unpersist()

    def totals(self, partial, restarts: int) -> np.ndarray:
        """Sums over all blocks: ``partial(block)`` gives one array per restart, added up by task, in a tree, by restart."""
        size, groups = self.size, max(1, -(-self.tasks // FAN_IN))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            held = None
            for block in _blocks(batches, size):
                got = partial(block)
                if held is None:
                    held = got
                else:
                    for a, b in zip(held, got, strict=True):
                        a += b
            if held is not None:
                g = TaskContext.get().partitionId() % groups
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(held)), pa.int32()), pa.array([g] * len(held), pa.int32()), pa.array([x.tobytes() for x in held], pa.binary())],
                    names=["r", "g", "sums"],
                )

        schema = "r int, g int, sums binary"
        sums = self.blocks.mapInArrow(run, schema).groupBy("r", "g").applyInArrow(_added, schema)
        if groups > 1:
            sums = sums.groupBy("r").applyInArrow(_added, schema)
        with _few_blocks(sums.sparkSession):
            found = {row["r"]: np.frombuffer(row["sums"], np.float64) for row in sums.collect()}  # a row per restart
        return np.stack([found[r] for r in range(restarts)])

    def drawn(self, centres: list[np.ndarray], n: int, seed: int) -> list[np.ndarray]:
        """For each restart ``n`` rows, with weights by the squared distance to its centres (equal ones, if it has none)."""
        size = self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
            best: list[list[tuple[float, bytes | None, bytes]]] = [[] for _ in centres]
            held = [Centres(own[None]) for own in centres]
            for block in _blocks(batches, size):
                for r, own in enumerate(centres):
                    weight = _gaps(block, held[r])[:, 0].min(axis=1) if len(own) else np.ones(block.n)
                    # rounding leaves a trace of distance between equal rows
                    weight[weight <= 1e-12 * (block.square + 1)] = 0
                    race = np.divide(rng.exponential(size=block.n), weight, out=np.full(block.n, np.inf), where=weight > 0)
                    for i in np.argsort(race)[:n]:
                        if race[i] < np.inf:
                            best[r].append((float(race[i]), *block.row(i)))
                    best[r] = sorted(best[r], key=lambda c: c[0])[:n]
            rows = [(r, *c) for r, own in enumerate(best) for c in own]
            names, types = ["r", "key", "indices", "data"], (pa.int32(), pa.float64(), pa.binary(), pa.binary())
            columns = zip(*rows, strict=True) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        rows = self.blocks.mapInArrow(run, "r int, key double, indices binary, data binary")
        place = F.row_number().over(Window.partitionBy("r").orderBy("key"))
        found: list[list[np.ndarray]] = [[] for _ in centres]
        with _few_blocks(rows.sparkSession):
            drawn = rows.withColumn("place", place).where(F.col("place") <= n).orderBy("r", "key").collect()  # n rows per restart
        for row in drawn:
            found[row["r"]].append(_dense(row["indices"], row["data"], size))
        return [np.array(f).reshape(-1, size) for f in found]

    def weights(self, centres: np.ndarray) -> np.ndarray:
        """(restarts x m): rows next to each centre; centres at NaN have none."""
        r, m, _ = centres.shape
        usable = ~np.isnan(centres).any(axis=2)
        held = Centres(np.where(usable[:, :, None], centres, 0))

        def partial(block: Block) -> list[np.ndarray]:
            gaps = np.where(usable[None], _gaps(block, held), np.inf)
            return [np.bincount(gaps[:, i].argmin(axis=1), minlength=m).astype(float) for i in range(r)]

        return self.totals(partial, r)

    def step(self, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums (restarts x k x size), counts (restarts x k) and costs of assigning every row to the nearest centre of each restart."""
        r, k, size = centres.shape
        held = Centres(centres)

        def partial(block: Block) -> list[np.ndarray]:
            gaps = _gaps(block, held)
            out = []
            for i in range(r):
                labels = gaps[:, i].argmin(axis=1)
                cost = gaps[np.arange(block.n), i, labels].sum()
                out.append(np.concatenate([block.sums(labels, k).ravel(), np.bincount(labels, minlength=k), [cost]]))
            return out

        flat = self.totals(partial, r)
        return flat[:, : k * size].reshape(r, k, size), flat[:, k * size : -1], flat[:, -1]


def _reduced(points: np.ndarray, weights: np.ndarray, k: int, rng) -> np.ndarray:
    """``k`` seeds from weighted candidates: k-means++ and a few weighted iterations."""
    points, weights = points[weights > 0], weights[weights > 0]
    chosen = [int(rng.choice(len(points), p=weights / weights.sum()))]
    gap = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k:
        mass = weights * gap
        pick = int(rng.choice(len(points), p=mass / mass.sum())) if mass.sum() > 0 else len(chosen) % len(points)
        chosen.append(pick)
        gap = np.minimum(gap, ((points - points[pick]) ** 2).sum(axis=1))
    seeds = points[chosen].copy()
    for _ in range(10):
        labels = ((points[:, None] - seeds[None]) ** 2).sum(axis=2).argmin(axis=1)
        for j in range(k):
            mine = labels == j
            if mine.any():
                seeds[j] = np.average(points[mine], axis=0, weights=weights[mine])
    return seeds


def seeds(rows: Rows, k: int, restarts: int, seed: int) -> np.ndarray:
    """(restarts x k x size) seeds by k-means||."""
    rng = np.random.default_rng(seed)
    centres = rows.drawn([np.zeros((0, rows.size))] * restarts, 1, seed)
    for turn in range(SEED_ROUNDS):
        more = rows.drawn(centres, 2 * k, seed + 1000 * (turn + 1))
        centres = [np.concatenate([a, b]) for a, b in zip(centres, more, strict=True)]
    most = max(len(c) for c in centres)
    table = np.full((restarts, most, rows.size), np.nan)
    for r, c in enumerate(centres):
        table[r, : len(c)] = c
    weights = rows.weights(table)
    return np.stack([_reduced(c, weights[r, : len(c)], k, rng) for r, c in enumerate(centres)])


def fit(vectors: DataFrame, vector: str, k: int, restarts: int = 10, seed: int = 42, rounds: int = 300, tolerance: float = 1e-4) -> np.ndarray:
    """Centroids (k x size) of the cheapest of ``restarts`` fits; ``k`` is a function of the number of rows or a number.

    A restart rests when none of its centroids moves by more than ``tolerance``; the others go on without it.
    """
    rows = Rows(vectors, vector)
    try:
        if not rows.count:
            raise ValueError("no rows to cluster")
        k = k(rows.count) if callable(k) else k
        centres = seeds(rows, k, restarts, seed)
        cost = np.full(restarts, math.inf)
        moving = np.arange(restarts)
        for _ in range(rounds):
            sums, counts, costs = rows.step(centres[moving])
            fresh = np.divide(sums, counts[:, :, None], out=centres[moving].copy(), where=counts[:, :, None] > 0)
            shift = np.sqrt(((fresh - centres[moving]) ** 2).sum(axis=2)).max(axis=1)
            cost[moving] = costs
            centres[moving] = fresh
            moving = moving[shift > tolerance]
            if not len(moving):
                break
        return centres[int(cost.argmin())]
    finally:
        rows.release()
