"""Clusters of a refreshed text table, kept by mergeable summaries.

After every micro-batch its rows alone are assigned with the stored model, and their summary (count, sum, sum of squared distances
per cluster) is written to the batch's folder; summaries of batches add up, so the state of the whole table is known without
reading it. When the mean cost of what came in exceeds that of the last fit by more than ``drift``, the next cycle fits anew over the whole table.
Model, summaries and results are tables in the shared folder: a cycle that fails leaves the last results, and the next one goes on from there.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators import clustering, vectors
from tabloom.streaming import refresh

_MODEL = "i int, term string, weight double, centroids array<double>"
_SUMMARY = "cluster_id int, n bigint, sums array<double>, cost double"


class Reclustering:
    """``table`` is a refreshed table with ``key``, ``text`` and ``keywords`` columns; ``folder`` holds the model and the results."""

    def __init__(self, spark: SparkSession, table: str, folder: str, key: str, text: str, keywords: str, k: int = 6, max_features: int = 5000,
                 restarts: int = 10, drift: float = 1.1, seq: str = "batch_id"):
        self.spark, self.table, self.folder, self.key, self.text, self.keywords = spark, table, folder, key, text, keywords
        self.k, self.max_features, self.restarts, self.drift, self.seq = k, max_features, restarts, drift, seq

    def _versions(self) -> list[int]:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(f"{self.folder}/results")
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(root)] if files.exists(root) else []
        # results are written last: a version with keywords is whole
        return sorted(int(n) for n in names if files.exists(hadoop.Path(f"{self.folder}/results/{n}/keywords/_SUCCESS")))

    def _path(self, *parts) -> str:
        return "/".join([self.folder, *map(str, parts)])

    def model(self, fit: int) -> tuple[vectors.TermWeights, np.ndarray]:
        """Vocabulary and centroids of a fit; as many rows as features."""
        rows = self.spark.read.schema(_MODEL).parquet(self._path("models", fit)).orderBy("i").collect()
        return vectors.TermWeights([r["term"] for r in rows], [r["weight"] for r in rows]), np.array([r["centroids"] for r in rows]).T

    def _summary(self, rows: DataFrame, fit: int) -> list[tuple]:
        """A row per cluster with members."""
        model, centroids = self.model(fit)
        packed = clustering.Rows(model.vectorise(rows.select(self.text), self.text).select("vector"), "vector")
        try:
            if not packed.count:
                return []
            sums, counts, _ = packed.step(centroids[None])
            # sum |x - c|^2 = n - 2 c . sum x + n |c|^2: rows have length one, also where the vocabulary knows none of their terms
            return [
                (j, int(n), s.tolist(), float(n * (1 + c @ c) - 2 * c @ s)) for j, (n, s, c) in enumerate(zip(counts[0], sums[0], centroids, strict=True)) if n
            ]
        finally:
            packed.release()

    def summaries(self, fit: int) -> DataFrame:
        """Summaries of a fit's rows and of the batches since, added up by cluster."""
        rows = self.spark.read.schema(_SUMMARY).option("recursiveFileLookup", True).parquet(self._path("summaries", fit))
        cells = rows.select("cluster_id", F.posexplode("sums").alias("i", "s")).groupBy("cluster_id", "i").agg(F.sum("s").alias("s"))
        sums = cells.groupBy("cluster_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "s"))), lambda x: x["s"]).alias("sums"))
        return rows.groupBy("cluster_id").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost")).join(sums, "cluster_id")

    def absorb(self, spark: SparkSession, batch_id: int) -> None:
        """After a micro-batch is stored: its summary under the last fit. A replayed batch overwrites its own."""
        done = self._versions()
        if done:
            fit = self._fit_of(done[-1])
            rows = spark.read.parquet(f"{self.table}/batch_id={batch_id}")
            made = spark.createDataFrame(self._summary(rows, fit), _SUMMARY)  # a row per cluster
            made.write.mode("overwrite").parquet(self._path("summaries", fit, f"batch-{batch_id}"))

    def _fit_of(self, version: int) -> int:
        return self.spark.read.parquet(self._path("results", version, "about")).head()["fit"]

    def drifted(self, fit: int) -> bool:
        """Whether the rows since the fit lie farther from the centroids than those of the fit."""
        at_fit = self.spark.read.schema(_SUMMARY).parquet(self._path("summaries", fit, "fit")).agg(F.sum("cost"), F.sum("n")).head()
        now = self.summaries(fit).agg(F.sum("cost"), F.sum("n")).head()
        return now[0] / now[1] > self.drift * at_fit[0] / at_fit[1]

    def settle(self) -> bool:
        """Results over the current table; returns whether the clusters were fitted anew."""
        rows = refresh.latest_rows(self.spark, self.table, self.key, self.seq)
        done = self._versions()
        fit = self._fit_of(done[-1]) if done else -1
        version = done[-1] + 1 if done else 0
        fresh = not done or self.drifted(fit)
        if fresh:
            fit = version
            model = vectors.fit_terms(rows, self.text, self.max_features)
            centroids = vectors.fit_centroids(model.vectorise(rows, self.text), "vector", self.k, self.restarts)
            table = [(i, t, w, centroids[:, i].tolist()) for i, (t, w) in enumerate(zip(model.terms, model.weights, strict=True))]
            self.spark.createDataFrame(table, _MODEL).write.mode("overwrite").parquet(self._path("models", fit))
            self.spark.createDataFrame(self._summary(rows, fit), _SUMMARY).write.mode("overwrite").parquet(self._path("summaries", fit, "fit"))
        model, centroids = self.model(fit)
        path = self._path("results", version)
        vectors.assign_texts(rows, self.text, model, centroids).write.mode("overwrite").parquet(f"{path}/rows")
        assigned = self.spark.read.parquet(f"{path}/rows")
        words = vectors.cluster_keywords(assigned, "cluster_id", self.keywords, [F.col(self.key)])
        self.spark.createDataFrame([(fit,)], "fit int").write.mode("overwrite").parquet(f"{path}/about")
        words.write.mode("overwrite").parquet(f"{path}/keywords")
        return fresh

    def results(self) -> tuple[DataFrame, DataFrame, vectors.TermWeights, np.ndarray]:
        """Rows with their clusters, keywords per cluster, and the model of the last cycle that worked."""
        last = self._versions()[-1]
        read = self.spark.read.parquet
        return (read(self._path("results", last, "rows")), read(self._path("results", last, "keywords")), *self.model(self._fit_of(last)))

    def cycle(self, start: Callable[[], object]) -> bool:
        """Take in what is there with ``start`` (a refresh whose ``afterwards`` is :meth:`absorb`), then settle."""
        refresh.run_refresh(start)
        return self.settle()
