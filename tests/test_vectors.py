import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabloom.functions import text as tx
from tabloom.operators import vectors


def docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")


def test_weights_by_hand(spark):
    d = docs(spark, ["Big cat a big", "cat sat", "dog", None])
    model = vectors.fit_terms(d, "text")
    # Only "cat" and "big" ... "big" occurs in one document, so "cat" alone has two.
    assert model.terms == ["cat"]
    assert math.isclose(model.weights[0], math.log(5 / 3) + 1)
    all_terms = vectors.fit_terms(d, "text", min_docs=1)
    assert all_terms.terms == ["big", "cat", "big cat", "cat big", "cat sat", "dog", "sat"]
    rows = vectors.weighted_terms(all_terms.vectorise(d, "text"), all_terms, "id").collect()
    first = {r["term"]: r["weight"] for r in rows if r["id"] == 0}
    rare, cat = math.log(5 / 2) + 1, math.log(5 / 3) + 1
    length = math.sqrt((2 * rare) ** 2 + cat**2 + 2 * rare**2)
    assert first == pytest.approx({"big": 2 * rare / length, "cat": cat / length, "big cat": rare / length, "cat big": rare / length})
    assert not [r for r in rows if r["id"] == 3]


def test_rare_terms_are_used_when_nothing_is_common(spark):
    assert vectors.fit_terms(docs(spark, ["one two", "three"]), "text").terms == ["one", "one two", "three", "two"]
    with pytest.raises(ValueError):
        vectors.fit_terms(docs(spark, ["", "a"]), "text")


def test_vocabulary_is_cut_by_total_then_name(spark):
    d = docs(spark, ["bb aa bb", "bb aa cc", "cc"])
    assert vectors.fit_terms(d, "text", max_features=2, min_docs=1).terms == ["bb", "aa"]


@pytest.mark.parametrize("n, k, result", [(10, 6, 6), (5, 6, 2), (3, 6, 2), (1, 6, 1), (9, 20, 4)])
def test_effective_k(n, k, result):
    assert vectors.effective_k(n, k) == result


def test_more_clusters_than_distinct_rows(spark):
    texts = ["gym jams"] * 6 + ["leg day"] * 6
    rows, _, centroids = vectors.cluster_texts(docs(spark, texts), "text", k=5, restarts=2)
    found = rows.collect()
    assert len(found) == 12 and all(r["centroid_distance"] < 1e-6 for r in found)
    assert len({(r["text"], r["cluster_id"]) for r in found}) == 2


def test_single_row_is_its_own_cluster(spark):
    rows, _, centroids = vectors.cluster_texts(docs(spark, ["leg day"]), "text")
    assert centroids.shape[0] == 1 and rows.head()["centroid_distance"] < 1e-9


def test_every_row_is_nearest_to_its_centroid(spark):
    rng = np.random.default_rng(0)
    words = ["squat", "bench", "row", "run", "swim", "rest", "eat", "sleep"]
    texts = [" ".join(rng.choice(words, 6)) for _ in range(60)]
    rows, model, centroids = vectors.cluster_texts(docs(spark, texts), "text", k=4, restarts=2)
    vector = {r["id"]: r["vector"].toArray() for r in model.vectorise(docs(spark, texts), "text").collect()}
    for r in rows.collect():
        gaps = np.linalg.norm(centroids - vector[r["id"]], axis=1)
        assert r["cluster_id"] == gaps.argmin() and math.isclose(r["centroid_distance"], gaps.min(), abs_tol=1e-9)


def test_cleaned_and_spread_texts_can_be_clustered_directly(spark):
    d = docs(spark, ["<p>leg &amp; day</p>", "leg day", "arm day"] * 3).repartition(3)
    cleaned = d.select("id", tx.clean_text(F.col("text")).alias("c"))
    rows, _, _ = vectors.cluster_texts(cleaned, "c", k=2, restarts=1)
    assert rows.select("id", "cluster_id", "centroid_distance").count() == 9
    assert len(rows.select("cluster_id").collect()) == 9


def test_cluster_keywords_rank_by_count_then_first_row(spark):
    rows = spark.createDataFrame(
        [(1, 0, "b, a"), (2, 0, "a,c,"), (3, 0, ""), (4, 1, None), (5, 1, "z")], "id int, g int, k string"
    )
    got = vectors.cluster_keywords(rows, "g", "k", [F.col("id")], 2).orderBy("g", "rank").collect()
    assert [(r["g"], r["keyword"], r["n"]) for r in got] == [(0, "a", 2), (0, "b", 1), (1, "z", 1)]


def sides(spark):
    rng = np.random.default_rng(1)
    members = [(i, 0 if i < 150 else i % 3, rng.normal(size=5).tolist()) for i in range(200)]
    members.append((200, 0, [0.0] * 5))
    queries = [(i, i % 4, rng.normal(size=5).tolist()) for i in range(9)]
    schema = "id bigint, cluster_id int, vector array<double>"
    return queries, members, spark.createDataFrame(queries, schema), spark.createDataFrame(members, schema)


@pytest.mark.parametrize("limits", [{}, {"block_rows": 7}])
def test_most_similar_is_exact(spark, limits):
    queries, members, q, m = sides(spark)
    got = vectors.most_similar(q, m, 4, **limits).orderBy("query_id", "rank").collect()
    expected = []
    for qid, cluster, qv in queries:
        scores = []
        for mid, other, mv in members:
            if other == cluster:
                size = np.linalg.norm(qv) * np.linalg.norm(mv)
                scores.append((-(np.dot(qv, mv) / size if size else 0.0), mid))
        expected += [(qid, mid, -s) for s, mid in sorted(scores)[:4]]
    assert [(r["query_id"], r["member_id"]) for r in got] == [(a, b) for a, b, _ in expected]
    assert [r["similarity"] for r in got] == pytest.approx([s for _, _, s in expected])


@pytest.mark.parametrize("limits", [{}, {"block_rows": 2}])
def test_text_similarity_matches_dense_cosine(spark, limits):
    texts = ["leg day squat", "leg day", "arm day", "squat squat leg", "run far", "run leg"]
    d = docs(spark, texts).withColumn("cluster_id", F.lit(0))
    model = vectors.fit_terms(d, "text", min_docs=1)
    q = docs(spark, ["leg squat", "run"]).select((F.col("id") + 100).alias("qid"), "text", F.lit(0).alias("cluster_id"))
    got = vectors.most_similar_texts(q, d, "qid", "id", "text", model, 3, **limits).collect()
    dense = {r["id"]: r["vector"].toArray() for r in model.vectorise(d, "text").collect()}
    asked = {r["qid"]: r["vector"].toArray() for r in model.vectorise(q, "text").collect()}
    for r in got:
        assert math.isclose(r["similarity"], asked[r["query_id"]] @ dense[r["member_id"]], abs_tol=1e-9)
    best = max(dense, key=lambda i: (round(asked[100] @ dense[i], 12), -i))
    assert next(r["member_id"] for r in got if r["query_id"] == 100 and r["rank"] == 1) == best


def test_projection_equals_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 4)) * [5, 3, 1, 0.1] + [1, 2, 3, 4]
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id int, a array<double>")
    got = vectors.project_2d(rows.withColumn("v", array_to_vector("a")), "v").orderBy("id").collect()
    centred = x - x.mean(axis=0)
    loadings = np.linalg.svd(centred, full_matrices=False)[2][:2].T
    loadings *= np.sign(loadings[np.abs(loadings).argmax(axis=0), range(2)])
    assert np.allclose([(r["pc1"], r["pc2"]) for r in got], centred @ loadings)
    with pytest.raises(ValueError):
        vectors.project_2d(rows.limit(1).withColumn("v", array_to_vector("a")), "v")


def test_impact_index_agrees_with_the_dense_product():
    from tabloom.operators.impact import ImpactIndex

    rng = np.random.default_rng(7)
    size, n = 60, 300
    x = rng.random((n, size)) * (rng.random((n, size)) < 0.08) * rng.random(size) ** 3
    x[5], x[6], x[7] = 0, x[8], x[8]  # an empty row and copies
    length = np.linalg.norm(x, axis=1, keepdims=True)
    x = np.divide(x, length, out=np.zeros_like(x), where=length > 0)
    ids = rng.permutation(n)
    row, term = np.nonzero(x)
    index = ImpactIndex(ids, np.searchsorted(row, np.arange(n + 1)), term, x[row, term], size)
    for q in [x[i] for i in range(0, 60)] + [np.zeros(size), np.eye(size)[3], np.eye(size)[59]]:
        terms = np.flatnonzero(q)
        at, scores = index.best(terms, q[terms], 7)
        wanted = sorted(zip(-(x @ q).round(12), ids, strict=True))[:7]
        assert [int(i) for i in ids[at]] == [int(i) for _, i in wanted]
        assert np.allclose(scores, [-s for s, _ in wanted])
    at, _ = index.best(np.array([0]), np.array([1.0]), 1000)
    assert len(at) == n


def test_projection_of_sparse_rows_with_many_features(spark):
    from pyspark.ml.linalg import Vectors

    from tabloom.operators import projection

    rng = np.random.default_rng(3)
    size, n = 600, 200
    x = (rng.random((n, size)) < 0.02) * rng.random((n, size))
    x[:, :5] += np.outer(rng.normal(size=n), [3, 2, 1, 0, 0])
    x[:, 5:8] += np.outer(rng.normal(size=n), [1, -2, 1])
    rows = [(i, Vectors.sparse(size, [(j, float(v)) for j, v in enumerate(r) if v])) for i, r in enumerate(x)]
    table = spark.createDataFrame(rows, ["id", "v"])
    mean, loadings = projection.components(table, "v", width=12)  # narrower than the features: several passes
    centred = x - x.mean(axis=0)
    _, _, right = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(mean, x.mean(axis=0))
    assert np.allclose(np.abs((loadings * right[:2].T).sum(axis=0)), 1, atol=1e-7)
    got = {r["id"]: r["pc"] for r in table.select("id", projection.projected(mean, loadings, F.col("v")).alias("pc")).collect()}
    assert np.allclose([got[i] for i in range(n)], centred @ loadings)


@pytest.mark.parametrize("features, min_docs, held", [(5, 2, 1 << 20), (40, 2, 30), (40, 1, 30), (10_000, 2, 50), (5, 500, 50)])
def test_terms_by_threshold_rounds_are_the_plain_ones(spark, tmp_path, features, min_docs, held):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.4, 40) % 300) for _ in range(120)]
    # a term that is frequent in one part only, and one whose total is spread thin
    texts = [*texts, "only here " * 60, *(t + " thin" for t in texts[:30]), "", None]
    d = docs(spark, texts).repartition(7)
    bags = vectors.term_bags(d, "text").drop("text")
    got = vectors.fit_bags(bags, str(tmp_path / "terms"), max_features=features, min_docs=min_docs, held=held)
    assert got == vectors.fit_terms(d, "text", features, min_docs)
    one, two = (
        {r["id"]: r["vector"] for r in x.select("id", "vector").collect()} for x in (got.vectorise_bags(bags), got.vectorise(d, "text"))
    )
    assert one == two


def test_no_terms_in_bags(spark, tmp_path):
    with pytest.raises(ValueError):
        vectors.fit_bags(vectors.term_bags(docs(spark, ["", "a"]), "text"), str(tmp_path / "terms"))


def test_blocks_are_dealt_without_shuffling_by_cluster(spark):
    def rows(n):
        return spark.range(n).select("id", (F.col("id") % 2).cast("int").alias("cluster_id"), F.array(F.lit(1.0), F.col("id").cast("double")).alias("vector"))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = vectors.most_similar(rows(3), rows(200), n=2, block_rows=20)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("BroadcastHashJoin [cluster_id") >= 2


def test_terms_are_counted_from_short_batches(spark):
    rows = spark.range(0, 120, 1, 1).selectExpr("element_at(array('a', 'b', 'c'), int(id % 3) + 1) AS token", "int(id % 3) + 1 AS n")
    counted = rows.mapInArrow(lambda b: vectors._part_counts(b, 2, 10), "token string, total long, docs long, top boolean, part long")
    found = sorted((r["token"], r["total"], r["docs"], r["top"]) for r in counted.collect())
    assert found == [("a", 40, 40, False), ("b", 80, 40, True), ("c", 120, 40, True)]
