"""Reclustering cycles: results after every cycle, summaries that add up, a new fit when the rows drift."""

import numpy as np

from tabloom.operators import vectors
from tabloom.streaming import recluster, refresh

SCHEMA = "id bigint, body string, words string"
TOPICS = {"sea": "ship wave harbour sail anchor tide", "wood": "tree bark moss leaf root forest", "city": "tram street tower market bridge lamp"}


def rows(topic, first, n):
    rng = np.random.default_rng(first)
    return [(first + i, " ".join(rng.permutation(TOPICS[topic].split())[:5]), TOPICS[topic].split()[0]) for i in range(n)]


def test_cycles_follow_the_table(spark, tmp_path):
    landing, table, mark, folder = (str(tmp_path / n) for n in ("in", "table", "mark", "clusters"))
    kept = recluster.Reclustering(spark, table, folder, "id", "body", "words", k=2, restarts=2)

    def cycle(*batches, fail=False):
        spark.createDataFrame([r for b in batches for r in b], SCHEMA).coalesce(1).write.mode("append").parquet(landing)

        def absorb(session, batch_id):
            if fail:
                raise RuntimeError("no luck")
            kept.absorb(session, batch_id)

        return kept.cycle(lambda: refresh.start_refresh(
            refresh.stream_files(spark, landing, SCHEMA), table, mark, "id", "id", afterwards=absorb))

    def groups():
        assigned, words, model, centroids = kept.results()
        got = {r["id"]: r["cluster_id"] for r in assigned.collect()}
        summary = {r["cluster_id"]: r for r in kept.summaries(kept._fit_of(kept._versions()[-1])).collect()}
        x = {r["id"]: r["vector"].toArray() for r in model.vectorise(assigned.select("id", "body"), "body").collect()}
        for j, s in summary.items():  # what the summaries say of the whole table is what its rows say
            mine = [x[i] for i, c in got.items() if c == j]
            assert s["n"] == len(mine) and np.allclose(s["sums"], np.sum(mine, axis=0))
            assert np.isclose(s["cost"], sum(1 - 2 * centroids[j] @ v + centroids[j] @ centroids[j] for v in mine))
        assert sum(s["n"] for s in summary.values()) == len(got)
        return got, {(r["cluster_id"], r["keyword"]): r["n"] for r in words.collect()}

    assert cycle(rows("sea", 0, 30), rows("wood", 100, 30))  # the first cycle fits
    got, words = groups()
    assert len({got[i] for i in range(30)}) == 1 and got[0] != got[100]
    assert words == {(got[0], "ship"): 30, (got[100], "tree"): 30}
    assert not cycle(rows("sea", 200, 10))  # more of the same: rows are assigned, nothing is fitted
    got, words = groups()
    assert got[200] == got[0] and words[(got[0], "ship")] == 40
    before = kept._versions()
    try:
        cycle(rows("wood", 300, 5), fail=True)
        raise AssertionError("the cycle had to fail")
    except AssertionError:
        raise
    except Exception:  # noqa: BLE001
        assert kept._versions() == before  # the last results stay
    kept.k = 3
    assert cycle(rows("city", 400, 60))  # another topic: the cost drifts, and the clusters are fitted anew
    got, _ = groups()
    assert len(got) == 135 and len({got[0], got[100], got[400]}) == 3


def test_no_rows_in_a_batch(spark, tmp_path):
    kept = recluster.Reclustering(spark, str(tmp_path / "t"), str(tmp_path / "c"), "id", "body", "words", k=2, restarts=1)
    spark.createDataFrame(rows("sea", 0, 9) + rows("wood", 20, 9), SCHEMA).write.parquet(str(tmp_path / "t" / "batch_id=0"))
    assert kept.settle()
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "t" / "batch_id=1"))
    kept.absorb(spark, 1)
    assert not kept.settle()
    assert vectors.effective_k(18, 2) == 2
