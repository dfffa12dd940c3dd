"""Text vectors, clustering and similarity.

Vectorising is narrow: each row looks its own terms up in a vocabulary of at
most ``max_features`` entries. Only the vocabulary, the centroids and the 2-D
projection ever reach the driver; their sizes are parameters (number of
features, number of clusters), not data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.text import let, term_counts
from tabloom.operators import clustering, impact, projection
from tabloom.operators.ranking import top_per_group

_NEAREST = "cluster_id int, distance double"
# Member rows made dense at a time.
_CHUNK = 256


def word_terms(text: Column) -> Column:
    """Words of two or more letters, then pairs of neighbouring words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))

    def with_pairs(w: Column) -> Column:
        last = F.greatest(F.size(w) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(w, 1, last), F.slice(w, 2, last), lambda a, b: F.concat_ws(" ", a, b))
        return F.concat(w, pairs)

    return let(words, with_pairs)


@dataclass(frozen=True)
class TermWeights:
    """A fitted vocabulary: terms with their inverse document weight."""

    terms: list[str]
    weights: list[float]

    def vectorise(self, docs: DataFrame, text: str, output: str = "vector") -> DataFrame:
        """Adds unit-length sparse vectors; no shuffle, no second fit."""
        return self._weighted(docs.withColumn("_terms", word_terms(F.col(text))), output)

    def vectorise_bags(self, docs: DataFrame, bag: str = "bag", output: str = "vector") -> DataFrame:
        """The same from term counts (:func:`term_bags`): no text is split into words again."""
        known = F.transform(bag, lambda b: F.array_repeat(b["token"], b["n"]))
        return self._weighted(docs.withColumn("_terms", F.flatten(known)), output)

    def _weighted(self, docs: DataFrame, output: str) -> DataFrame:
        counter = CountVectorizerModel.from_vocabulary(self.terms, inputCol="_terms", outputCol="_counts")
        scaler = ElementwiseProduct(
            scalingVec=Vectors.dense(self.weights), inputCol="_counts", outputCol="_weighted"
        )
        unit = Normalizer(p=2.0, inputCol="_weighted", outputCol=output)
        return unit.transform(scaler.transform(counter.transform(docs))).drop("_terms", "_counts", "_weighted")


def term_statistics(docs: DataFrame, text: str) -> DataFrame:
    """``token, total, docs`` of the collection.

    Repeats within a document are folded inside the row, and the rest
    combines on the map side, so a frequent term costs one row per task.
    """
    counts = docs.select(F.inline(term_counts(word_terms(F.col(text)))))
    return counts.groupBy("token").agg(F.sum("n").alias("total"), F.count("*").alias("docs"))


def fit_terms(docs: DataFrame, text: str, max_features: int = 5000, min_docs: int = 2) -> TermWeights:
    """Vocabulary of the most frequent terms in at least ``min_docs`` documents.

    If no term is that common, every term qualifies. Ties go
    to the alphabetically smaller term. Weight: ``ln((1 + n) / (1 + docs)) + 1``.
    """
    n_docs = docs.count()
    common = F.col("docs") >= min_docs
    # One pass over the texts: terms that qualify come first, the others only matter if none does.
    order = [F.desc(common), F.desc("total"), F.asc("token")]
    rows = term_statistics(docs, text).orderBy(*order).limit(max_features).collect()
    return _model(rows, n_docs, min_docs)


def _model(rows: list, n_docs: int, min_docs: int) -> TermWeights:
    rows = [r for r in rows if r["docs"] >= min_docs] or rows
    if not rows:
        raise ValueError("no terms in the documents")
    weights = [math.log((1 + n_docs) / (1 + r["docs"])) + 1 for r in rows]
    return TermWeights([r["token"] for r in rows], weights)


def term_bags(docs: DataFrame, text: str, output: str = "bag") -> DataFrame:
    """Adds ``array<struct<token, n>>`` of each text, to be stored and used for the fit and the vectors."""
    return docs.withColumn(output, term_counts(word_terms(F.col(text))))


def _part_counts(batches: Iterator[pa.RecordBatch], top: int, held: int) -> Iterator[pa.RecordBatch]:
    """Terms of a part of the documents with their counts, the ``top`` most frequent ones marked.

    A task whose terms exceed ``held`` goes on with another part, so its memory is bounded.
    """
    part, waiting, rows = TaskContext.get().partitionId() << 20, [], 0

    def summed() -> pa.Table:
        both = pa.concat_tables(waiting).group_by("token").aggregate([("total", "sum"), ("docs", "sum")])
        return pa.table({"token": both["token"], "total": both["total_sum"], "docs": both["docs_sum"]})

    def out(table: pa.Table) -> list[pa.RecordBatch]:
        marked = np.zeros(len(table), dtype=bool)
        marked[np.argsort(-table["total"].to_numpy(), kind="stable")[:top]] = True
        table = table.append_column("top", pa.array(marked)).append_column("part", pa.array(np.full(len(table), part)))
        return table.combine_chunks().to_batches(max_chunksize=1 << 16)

    for batch in batches:
        ones = pa.array(np.ones(len(batch), dtype=np.int64))
        waiting.append(pa.table({"token": batch.column("token"), "total": batch.column("n").cast(pa.int64()), "docs": ones}))
        rows += len(batch)
        if rows > 2 * held:
            waiting = [summed()]
            rows = len(waiting[0])
            if rows > held:
                yield from out(waiting[0])
                part, waiting, rows = part + 1, [], 0
    if rows:
        yield from out(summed())


def fit_bags(
    docs: DataFrame, folder: str, bag: str = "bag", max_features: int = 5000, min_docs: int = 2, held: int = 1 << 20
) -> TermWeights:
    """As :func:`fit_terms`, from term counts and without shuffling the whole vocabulary.

    Each part of the documents counts its terms, written to ``folder``. The most frequent terms of the parts give a bound that
    the total of every chosen term reaches, so such a term has at least the bound divided by the number of parts in some part.
    The sums of what reaches that raise the bound; only terms that can still reach it are counted in all parts.
    """
    # A row per term: a batch of whole documents grows with their length.
    docs.select(F.inline(bag)).select("token", "n").mapInArrow(
        lambda batches: _part_counts(batches, max_features, held), "token string, total long, docs long, top boolean, part long"
    ).write.parquet(folder)
    local = docs.sparkSession.read.schema("token string, total long, docs long, top boolean, part long").parquet(folder)
    parts = local.select("part").distinct().count()

    def bound(rows: DataFrame) -> int:
        """Total that ``max_features`` common terms reach at least; 0 if there are fewer."""
        best = rows.where(F.col("docs") >= min_docs).orderBy(F.desc("total")).limit(max_features)
        n, low = best.agg(F.count("*"), F.min("total")).first()
        return low if n == max_features else 0

    sums = [F.sum("total").alias("total"), F.sum("docs").alias("docs")]
    first = bound(local.where("top").groupBy("token").agg(*sums))
    rows = local
    if first:
        seen = local.where(F.col("total") * parts >= first).groupBy("token").agg(*sums, F.count("*").alias("in_parts"))
        # a part that is not among them has less than the first bound's share
        most = F.col("total") * parts + (parts - F.col("in_parts")) * first
        rows = local.join(seen.where(most >= bound(seen) * parts).select("token"), "token", "left_semi")
    order = [F.desc(F.col("docs") >= min_docs), F.desc("total"), F.asc("token")]
    chosen = rows.groupBy("token").agg(*sums).orderBy(*order).limit(max_features).collect()
    return _model(chosen, docs.count(), min_docs)


def _flat(vectors: pa.StructArray) -> tuple[pa.ListArray, pa.ListArray]:
    """Index and value lists of an Arrow column of sparse vectors."""
    fields = dict(zip((f.name for f in vectors.type), vectors.flatten()))
    return fields["indices"], fields["values"]


def sparse_parts(vector: Column) -> Column:
    """``struct<indices, values>`` of a sparse vector column, without making it dense."""

    @F.arrow_udf("indices array<int>, values array<double>")
    def parts(vectors: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(_flat(vectors), ["indices", "values"])

    return parts(vector)


def sparse_entries(vector: Column) -> Column:
    """``array<struct<i, weight>>`` of a sparse vector column."""

    @F.arrow_udf("array<struct<i: int, weight: double>>")
    def entries(vectors: pa.Array) -> pa.Array:
        indices, values = _flat(vectors)
        pairs = pa.StructArray.from_arrays([indices.flatten(), values.flatten()], ["i", "weight"])
        starts = indices.offsets.to_numpy()
        return pa.ListArray.from_arrays(pa.array(starts - starts[0], pa.int32()), pairs)

    return entries(vector)


def weighted_terms(vectors: DataFrame, model: TermWeights, id_column: str, vector: str = "vector") -> DataFrame:
    """Vectors in long form: one row per document and term."""
    spark = vectors.sparkSession
    names = spark.createDataFrame(list(enumerate(model.terms)), "i int, term string")
    entries = vectors.select(id_column, F.inline(sparse_entries(F.col(vector))))
    # The vocabulary has at most ``max_features`` rows.
    return entries.join(F.broadcast(names), "i").select(id_column, "term", "weight")


def effective_k(n_rows: int, k: int) -> int:
    """Number of clusters that ``n_rows`` rows can carry."""
    return k if n_rows >= k else min(n_rows, max(2, n_rows // 2))


def mean_vector(vectors: DataFrame, vector: str) -> np.ndarray:
    """Mean of a vector column."""
    return vectors.select(Summarizer.mean(F.col(vector))).head()[0].toArray()


def fit_centroids(
    vectors: DataFrame, vector: str = "vector", k: int = 6, restarts: int = 10, seed: int = 42
) -> np.ndarray:
    """Centroids of the best of several K-means runs, one row each (see :mod:`tabloom.operators.clustering`)."""
    return clustering.fit(vectors, vector, lambda n: effective_k(n, k), restarts, seed)


def group_centroids(rows: DataFrame, group: str, array: str, groups: int) -> np.ndarray:
    """Mean array of each group 0 … ``groups``-1; empty groups are NaN.

    ``group`` must lie in that range, which bounds what the driver receives.
    """
    means = rows.where(F.col(group).between(0, groups - 1)).groupBy(group).agg(
        Summarizer.mean(array_to_vector(F.col(array).cast("array<double>"))).alias("m")
    )
    found = {r[0]: r["m"].toArray() for r in means.collect()}
    if not found:
        raise ValueError("no rows to average")
    blank = np.full(len(next(iter(found.values()))), np.nan)
    return np.array([found.get(i, blank) for i in range(groups)])


def nearest_dense(centroids: np.ndarray):
    """Function of an array column: nearest centroid and distance to it.

    One matrix product per Arrow batch; NaN centroids are never chosen.
    """
    usable = np.flatnonzero(~np.isnan(centroids).any(axis=1))
    c = centroids[usable]
    half_square = 0.5 * (c * c).sum(axis=1)

    @F.pandas_udf(_NEAREST)
    def assign(arrays: pd.Series) -> pd.DataFrame:
        if arrays.empty:
            return pd.DataFrame({"cluster_id": [], "distance": []})
        x = np.stack(arrays.to_numpy()).astype(np.float64)
        best = np.argmin(half_square - x @ c.T, axis=1)
        distance = np.sqrt(((x - c[best]) ** 2).sum(axis=1))
        return pd.DataFrame({"cluster_id": usable[best].astype(np.int32), "distance": distance})

    # Spark may not copy it below a join, where it would run a second time
    return assign.asNondeterministic()


def nearest_sparse(centroids: np.ndarray):
    """As :func:`nearest_dense`, for sparse vector columns.

    Only the entries present are multiplied, however many features there are.
    """
    by_term = np.ascontiguousarray(centroids.T)
    square = (centroids * centroids).sum(axis=1)

    @F.arrow_udf(_NEAREST)
    def assign(vectors: pa.Array) -> pa.Array:
        indices, values = _flat(vectors)
        n = len(vectors)
        row = np.repeat(np.arange(n), np.diff(indices.offsets.to_numpy()))
        index, value = indices.flatten().to_numpy(), values.flatten().to_numpy()
        own = np.bincount(row, value * value, n)
        gaps = np.empty((n, len(square)))
        for j in range(len(square)):
            gaps[:, j] = own - 2 * np.bincount(row, by_term[index, j] * value, n) + square[j]
        best = gaps.argmin(axis=1)
        distance = np.sqrt(np.maximum(gaps[np.arange(n), best], 0))
        return pa.StructArray.from_arrays(
            [pa.array(best.astype(np.int32)), pa.array(distance)], ["cluster_id", "distance"]
        )

    # Spark may not copy it below a join, where it would run a second time
    return assign.asNondeterministic()


def cluster_texts(
    docs: DataFrame, text: str, k: int = 6, max_features: int = 5000, restarts: int = 10, seed: int = 42
) -> tuple[DataFrame, TermWeights, np.ndarray]:
    """Rows with ``cluster_id`` and ``centroid_distance``, the vocabulary and the centroids."""
    model = fit_terms(docs, text, max_features)
    vectors = model.vectorise(docs, text)
    centroids = fit_centroids(vectors, "vector", k, restarts, seed)
    return assign_texts(docs, text, model, centroids), model, centroids


def assign_texts(docs: DataFrame, text: str, model: TermWeights, centroids: np.ndarray) -> DataFrame:
    """Adds ``cluster_id`` and ``centroid_distance`` with a fitted model."""
    hit = model.vectorise(docs, text, "_vector").withColumn("_hit", nearest_sparse(centroids)(F.col("_vector")))
    return hit.withColumns(
        {"cluster_id": F.col("_hit.cluster_id"), "centroid_distance": F.col("_hit.distance")}
    ).drop("_hit", "_vector")


def cluster_keywords(rows: DataFrame, cluster: str, keywords: str, order: list[Column], n: int = 10) -> DataFrame:
    """Most frequent keywords per cluster; the one seen first in ``order`` wins a tie.

    Counts combine on the map side by (cluster, keyword), so one cluster may
    hold most rows. ``keywords`` is an array or comma-separated text.
    """
    words = F.col(keywords)
    if dict(rows.dtypes)[keywords] == "string":
        words = F.split(words, ",")
    # The outer form keeps Spark from testing (and so computing) the array a second time.
    seen = rows.select(cluster, F.struct(*order).alias("_row"), F.posexplode_outer(words).alias("_pos", "keyword"))
    seen = seen.withColumn("keyword", F.btrim("keyword")).where(F.col("keyword") != "")
    counted = seen.groupBy(cluster, "keyword").agg(
        F.count("*").alias("n"), F.min(F.struct("_row", "_pos")).alias("_first")
    )
    return top_per_group(counted, [cluster], [F.desc("n"), F.asc("_first")], n).drop("_first")


def near_centroid(rows: DataFrame, order: list[Column], n: int = 5) -> DataFrame:
    """The ``n`` rows of each cluster closest to its centroid."""
    return top_per_group(rows, ["cluster_id"], [F.asc("centroid_distance"), *order], n)


def _unit(vectors: pd.Series) -> np.ndarray:
    """Rows of unit length; zero rows stay zero."""
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def _best_matches(q_ids: np.ndarray, scores: np.ndarray, m_ids: np.ndarray, n: int) -> pd.DataFrame:
    """Per query (row of scores) the ``n`` best members; the smaller id wins a tie."""
    by_id = np.argsort(m_ids, kind="stable")
    m_ids, scores = m_ids[by_id], scores[:, by_id]
    order = np.argsort(-scores.round(12), axis=1, kind="stable")[:, :n]
    return pd.DataFrame(
        {
            "query_id": np.repeat(q_ids, order.shape[1]),
            "member_id": m_ids[order].ravel(),
            "similarity": np.take_along_axis(scores, order, axis=1).ravel(),
        }
    )


def _best_of(found: list[pd.DataFrame], n: int) -> pd.DataFrame:
    """The ``n`` best rows per query of several partial results."""
    rows = pd.concat(found, ignore_index=True)
    rows["_s"] = -rows["similarity"].round(12)
    return rows.sort_values(["query_id", "_s", "member_id"]).groupby("query_id").head(n).drop(columns="_s")


_MATCH = "query_id bigint, member_id bigint, similarity double"


def most_similar(
    queries: DataFrame,
    members: DataFrame,
    n: int = 5,
    size: int | None = None,
    block_rows: int = 2000,
) -> DataFrame:
    """Per query the ``n`` members of its cluster with the highest cosine.

    Both sides have ``id, cluster_id, vector``: an array of double, or
    ``struct<indices, values>`` when ``size`` is given. Both sides of a cluster are dealt into
    blocks of about ``block_rows``, and each pair of blocks is one matrix product (dense) or one impact-ordered
    index (sparse, see :mod:`tabloom.operators.impact`) that hands on ``n`` rows per query: no list of all pairs exists, and the result is exact. Members are
    read twice, so a caller stores what is dear to compute.
    """
    partial = _blocked(queries, members, n, size, block_rows, block_rows)
    order = [F.desc(F.round("similarity", 12)), F.asc("member_id")]
    return top_per_group(partial, ["query_id"], order, n)


def _blocked(
    queries: DataFrame, members: DataFrame, n: int, size: int | None, q_rows: int, m_rows: int
) -> DataFrame:
    def sizes(rows: DataFrame, per_block: int, name: str) -> DataFrame:
        return rows.groupBy("cluster_id").agg(F.ceil(F.count("*") / per_block).alias(name))

    # A row per cluster: without the hint a join may deal the rows by cluster, a whole one to a task.
    grid = F.broadcast(sizes(queries, q_rows, "q_blocks").join(sizes(members, m_rows, "m_blocks"), "cluster_id"))
    spot = F.xxhash64("id")
    q = queries.join(grid, "cluster_id").select(
        "id", "cluster_id", "vector",
        F.pmod(spot, "q_blocks").alias("q_block"),
        F.explode(F.sequence(F.lit(0), F.col("m_blocks") - 1)).alias("m_block"),
    )
    m = members.join(grid, "cluster_id").select(
        "id", "cluster_id", "vector",
        F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("q_block"),
        F.pmod(spot, "m_blocks").alias("m_block"),
    )

    keys = ["cluster_id", "q_block", "m_block"]
    if size is not None:
        return impact.block_matches(q, m, keys, n, size)

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "member_id": [], "similarity": []})
        q_ids, q_unit = left["id"].to_numpy(), _unit(left["vector"])
        best: list[pd.DataFrame] = []
        for start in range(0, len(right), _CHUNK):
            part = right.iloc[start : start + _CHUNK]
            found = _best_matches(q_ids, q_unit @ _unit(part["vector"]).T, part["id"].to_numpy(), n)
            best = [_best_of([*best, found], n)]
        return best[0]

    return q.groupBy(*keys).cogroup(m.groupBy(*keys)).applyInPandas(meet, _MATCH)


def most_similar_texts(
    queries: DataFrame, members: DataFrame, query_id: str, member_id: str, text: str, model: TermWeights, n: int = 5,
    **limits: int,
) -> DataFrame:
    """:func:`most_similar` for texts with a fitted vocabulary and a ``cluster_id``."""

    def side(rows: DataFrame, row_id: str) -> DataFrame:
        unit = model.vectorise(rows.select(row_id, "cluster_id", text), text)
        return unit.select(
            F.col(row_id).cast("bigint").alias("id"), "cluster_id", sparse_parts(F.col("vector")).alias("vector")
        )

    return most_similar(side(queries, query_id), side(members, member_id), n, len(model.terms), **limits)


def project_2d(rows: DataFrame, vector: str = "vector") -> DataFrame:
    """Adds ``pc1, pc2``: centred principal components, largest loading positive (see :mod:`tabloom.operators.projection`)."""
    mean, loadings = projection.components(rows, vector)
    point = rows.withColumn("_pc", projection.projected(mean, loadings, F.col(vector)))
    return point.withColumns({"pc1": F.col("_pc")[0], "pc2": F.col("_pc")[1]}).drop("_pc")
