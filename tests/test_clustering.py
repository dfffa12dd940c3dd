"""K-means of all restarts at once, against NumPy."""

import os
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabloom.operators import clustering


def points(n=300, seed=1):
    rng = np.random.default_rng(seed)
    middle = np.array([[0, 0, 0, 5], [9, 0, 1, 0], [0, 8, 0, 0], [7, 7, 7, 7]], float)
    return np.concatenate([m + rng.normal(0, 0.4, (n // 4, 4)) for m in middle]) * (rng.random((n, 4)) < 0.95)


def table(spark, x, sparse):
    make = (lambda r: Vectors.sparse(len(r), [(i, float(v)) for i, v in enumerate(r) if v])) if sparse else (lambda r: Vectors.dense(r))
    return spark.createDataFrame([(i, make(r)) for i, r in enumerate(x)], ["id", "vector"]).repartition(3)


def cost(x, centres):
    return ((x[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum()


@pytest.mark.parametrize("sparse", [True, False])
def test_fit_is_a_fixed_point_and_as_good_as_the_true_groups(spark, sparse):
    x = points()
    got = clustering.fit(table(spark, x, sparse), "vector", 4, restarts=5)
    labels = ((x[:, None] - got[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert np.allclose([x[labels == j].mean(axis=0) for j in range(4)], got, atol=1e-3)
    assert cost(x, got) <= cost(x, np.array([c.mean(axis=0) for c in np.split(x, 4)])) * 1.001


def test_passes_add_up_over_blocks_and_restarts(spark, monkeypatch):
    x = points(n=240, seed=3)
    monkeypatch.setattr(clustering, "FAN_IN", 2)  # a tree of two levels
    for sparse in (True, False):
        rows = clustering.Rows(table(spark, x, sparse), "vector")
        try:
            centres = np.stack([x[:3], x[100:103]])
            sums, counts, costs = rows.step(centres)
            for r in range(2):
                labels = ((x[:, None] - centres[r][None]) ** 2).sum(axis=2).argmin(axis=1)
                assert counts[r].tolist() == np.bincount(labels, minlength=3).tolist()
                assert np.allclose(sums[r], [x[labels == j].sum(axis=0) for j in range(3)])
                assert np.isclose(costs[r], cost(x, centres[r]))
            drawn = rows.drawn([np.zeros((0, 4)), x[:1]], 7, 5)
            assert [len(d) for d in drawn] == [7, 7]
            assert all(any(np.allclose(p, q) for q in x) for d in drawn for p in d)
        finally:
            rows.release()


def test_equal_rows_zero_rows_and_nothing(spark):
    same = np.tile([1.0, 2.0, 0.0], (40, 1))
    assert np.allclose(clustering.fit(table(spark, same, False), "vector", 3, restarts=2), same[:3])
    zero = np.zeros((10, 3))
    assert np.allclose(clustering.fit(table(spark, zero, True), "vector", 2, restarts=2), 0)
    with pytest.raises(ValueError):
        clustering.fit(table(spark, same, False).limit(0), "vector", 3)


def test_centres_are_laid_out_once_for_all_blocks():
    rng = np.random.default_rng(3)
    dense = rng.random((50, 20)) * (rng.random((50, 20)) < 0.3)
    filled = [np.flatnonzero(row) for row in dense]
    starts = np.r_[0, np.cumsum([len(f) for f in filled])]
    block = clustering.Block(50, starts, np.concatenate(filled).astype(np.int32), dense[dense != 0], 20)
    table = rng.random((4, 3, 20))
    held = clustering.Centres(table)
    gaps = clustering._gaps(block, held)
    assert np.allclose(gaps, ((dense[:, None, None] - table[None]) ** 2).sum(axis=3))
    laid = held.columns
    clustering._gaps(block, held)
    assert held.columns is laid


def test_passes_hand_a_few_blocks_at_a_time_to_python(spark, tmp_path):
    """A pass does not hold a whole partition (here 16 MB) as one Arrow batch, and the session's limit stays as it was."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    long = spark.range(120).select(array_to_vector(F.expr("array_repeat(1.0D * id, 1 << 16)")).alias("vector"))

    before = spark.conf.get(key)
    rows = clustering.Rows(long, "vector")
    blocks = rows.blocks

    def watched(run, schema):
        def seen(batches):
            for batch in batches:
                with open(f"{tmp_path}/{os.getpid()}", "a") as f:
                    print(batch.num_rows, batch.nbytes, file=f)
                yield batch

        return blocks.mapInArrow(lambda batches: run(seen(batches)), schema)

    try:
        rows.blocks = SimpleNamespace(mapInArrow=watched)
        assert rows.totals(lambda block: [np.array([float(block.n)])], 1).tolist() == [[120.0]]
        drawn = rows.drawn([np.zeros((0, rows.size))], 5, 1)[0]
        assert drawn.shape == (5, 1 << 16) and (drawn == drawn[:, :1]).all()
        held = [x.split() for f in tmp_path.iterdir() for x in f.read_text().splitlines()]
        assert sum(int(n) for n, _ in held) == 2 * 60 and max(int(size) for _, size in held) < 4 << 20
        assert spark.conf.get(key) == before
    finally:
        blocks.unpersist()
