"""Text vectors, clusters and nearest neighbours.

Centroids of the embedding queries are the means of label groups (label modulo
16, so at most 16 of them whatever the labels are).
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabloom.functions import text as tx
from tabloom.functions import values
from tabloom.operators import merge, ranking, vectors
from tabloom.operators.posts import cluster_stored_posts, preprocess_posts, stored_defaults
from tabloom.plans import Query
from tabloom.session import dealt, load, scratch_dir

GROUPS = 16
_TEXT_FEATURES = 5000
_LANGUAGES = ("de", "en", "es", "fr")


def _embeddings(spark, folder):
    return load(spark, folder, "embeddings").select(
        "vec_id", F.pmod("label", F.lit(GROUPS)).alias("label"), F.col("embedding").cast("array<double>").alias("vector")
    )


def _centroids(rows) -> np.ndarray:
    return vectors.group_centroids(rows, "label", "vector", GROUPS)


def _assigned(rows, centroids: np.ndarray):
    hit = vectors.nearest_dense(centroids)(F.col("vector"))
    return rows.withColumn("_hit", hit).withColumns(
        {"cluster_id": F.col("_hit.cluster_id"), "centroid_distance": F.col("_hit.distance")}
    ).drop("_hit")


def group_means(spark, folder):
    """Mean of each coordinate in each label group."""
    cells = _embeddings(spark, folder).select(F.col("label").cast("int").alias("label"), F.posexplode("vector").alias("i", "v"))
    return cells.groupBy("label", "i").agg(F.round(F.avg("v"), 6).alias("mean"))


def nearest_centroid(spark, folder):
    rows = _embeddings(spark, folder)
    return _assigned(rows, _centroids(rows)).select(
        "vec_id", "cluster_id", F.round("centroid_distance", 5).alias("centroid_distance")
    )


def cluster_members(spark, folder):
    """Members and mean distance per cluster."""
    rows = _embeddings(spark, folder)
    return _assigned(rows, _centroids(rows)).groupBy("cluster_id").agg(
        F.count("*").alias("members"), F.round(F.avg("centroid_distance"), 5).alias("mean_distance")
    )


def near_centroid(spark, folder):
    rows = _embeddings(spark, folder)
    assigned = _assigned(rows, _centroids(rows)).withColumn("centroid_distance", F.round("centroid_distance", 9))
    return vectors.near_centroid(assigned, [F.asc("vec_id")], 5).select(
        "cluster_id", "vec_id", F.round("centroid_distance", 5).alias("centroid_distance"),
        F.col("rank").cast("bigint").alias("rank"),
    )


def cluster_view(spark, folder):
    """Twenty members closest to the centroid of each cluster, with a cut title."""
    rows = _embeddings(spark, folder)
    assigned = _assigned(rows, _centroids(rows)).withColumn("centroid_distance", F.round("centroid_distance", 9))
    top = vectors.near_centroid(assigned, [F.asc("vec_id")], 20)
    title = F.repeat(F.concat(F.lit("Vector "), F.col("vec_id").cast("string"), F.lit(" ")), 6)
    return top.select("cluster_id", "vec_id", values.shortened(title, 60).alias("title"))


def cluster_writeback(spark, folder):
    """Labels and distances stored on the rows; other columns stay as they are."""
    rows = _embeddings(spark, folder)
    stored = load(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), "source",
        F.lit(None).cast("int").alias("cluster_id"), F.lit(None).cast("double").alias("centroid_distance"),
    )
    found = _assigned(rows, _centroids(rows)).select(
        F.col("vec_id").alias("id"), "cluster_id", F.round("centroid_distance", 5).alias("centroid_distance")
    )
    return merge.update_join(stored, found, "id", ["cluster_id", "centroid_distance"])


def _query_sides(spark, folder):
    """Each group mean as a query; members carry their nearest centroid."""
    rows = _embeddings(spark, folder)
    centroids = _centroids(rows)
    found = [(g, g, c.tolist()) for g, c in enumerate(centroids) if not np.isnan(c).any()]
    queries = spark.createDataFrame(found, "id bigint, cluster_id int, vector array<double>")
    members = _assigned(rows, centroids).select(F.col("vec_id").alias("id"), "cluster_id", "vector")
    return queries, _stored(spark, members, "assigned")


def _ranked(rows):
    return rows.select(
        "query_id", "member_id", F.round("similarity", 5).alias("similarity"), F.col("rank").cast("bigint").alias("rank")
    )


def cosine_topk(spark, folder):
    return _ranked(vectors.most_similar(*_query_sides(spark, folder), n=5))


def cosine_topk_blocks(spark, folder):
    """The same with the method for many queries: blocks on both sides."""
    queries, members = _query_sides(spark, folder)
    return _ranked(vectors.most_similar(queries, members, n=5, block_rows=20))


def tfidf_terms(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "text")
    bags = _stored(spark, vectors.term_bags(docs, "text").drop("text"), "bags")
    model = vectors.fit_bags(bags, scratch_dir(spark, "terms"), max_features=_TEXT_FEATURES)
    long = vectors.weighted_terms(model.vectorise_bags(bags), model, "doc_id")
    return long.withColumn("weight", F.round("weight", 6))


def term_statistics(spark, folder):
    docs = load(spark, folder, "documents")
    return vectors.term_statistics(docs, "text").where(F.col("docs") >= 2)


def kmeans_sizes(spark, folder):
    """K-means on embeddings: members, mean distance and share of nearest assignments."""
    rows = _embeddings(spark, folder).withColumn("features", array_to_vector("vector"))
    centroids = vectors.fit_centroids(rows, "features", k=10, restarts=10)
    return _assigned(rows, centroids).groupBy("cluster_id").agg(
        F.count("*").alias("members"), F.round(F.avg("centroid_distance"), 5).alias("mean_distance")
    )


def kmeans_invariants(spark, folder):
    """What must hold for any fit: every row sits with its nearest centroid, centroids are their members' means,
    and the cost is not above that of the label means."""
    rows = _embeddings(spark, folder).withColumn("features", array_to_vector("vector"))
    centroids = vectors.fit_centroids(rows, "features", k=GROUPS, restarts=10)
    kept = _stored(spark, _assigned(rows.drop("features"), centroids), "assigned")
    cells = kept.select("vec_id", "cluster_id", F.posexplode("vector").alias("i", "v"))
    table = spark.createDataFrame(
        [(c, i, float(m)) for c, row in enumerate(centroids) for i, m in enumerate(row)], "centroid int, i int, m double"
    )
    gaps = cells.join(F.broadcast(table), "i").groupBy("vec_id", "cluster_id", "centroid").agg(F.sum((F.col("v") - F.col("m")) ** 2).alias("gap"))
    own = gaps.groupBy("vec_id").agg(
        F.min("gap").alias("least"), F.max(F.when(F.col("cluster_id") == F.col("centroid"), F.col("gap"))).alias("mine")
    )
    means = cells.groupBy("cluster_id", "i").agg(F.avg("v").alias("mean"))
    moved = means.join(F.broadcast(table), (F.col("cluster_id") == F.col("centroid")) & (means["i"] == table["i"]))
    labelled = _assigned(_embeddings(spark, folder), _centroids(_embeddings(spark, folder)))
    parts = [
        own.select(F.lit("rows").alias("what"), F.lit(1).alias("n")),
        own.where(F.col("mine") > F.col("least") + 1e-9).select(F.lit("misassigned").alias("what"), F.lit(1).alias("n")),
        moved.where(F.abs(F.col("mean") - F.col("m")) > 1e-2).select(F.lit("moved").alias("what"), F.lit(1).alias("n")),
    ]
    counts = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy().agg(
        *(F.count_if(F.col("what") == w).alias(w) for w in ("rows", "misassigned", "moved"))
    )
    cost = kept.agg(F.sum(F.col("centroid_distance") ** 2)).head()[0] or 0.0
    other = labelled.agg(F.sum(F.col("centroid_distance") ** 2)).head()[0] or 0.0
    return counts.withColumn("dearer", F.lit(bool(cost > other * 1.001)))


def _stored(spark, rows, purpose: str):
    """Cleaned texts as a stored table, so that many passes read them instead of cleaning again."""
    path = scratch_dir(spark, purpose)
    rows.write.parquet(path)
    return spark.read.parquet(path)


def _clustered_texts(spark, folder):
    docs = dealt(load(spark, folder, "documents")).select("doc_id", tx.clean_text(F.col("text")).alias("clean_text"))
    posts = _stored(spark, docs, "posts")
    return vectors.cluster_texts(posts, "clean_text", k=6, max_features=_TEXT_FEATURES, restarts=10)


def text_clusters(spark, folder):
    rows, _, _ = _clustered_texts(spark, folder)
    return rows.select("doc_id", "cluster_id", F.round("centroid_distance", 6).alias("centroid_distance"))


def text_cluster_keywords(spark, folder):
    rows, _, _ = _clustered_texts(spark, folder)
    words = rows.withColumn("keywords", tx.top_keywords(F.col("clean_text")))
    return vectors.cluster_keywords(words, "cluster_id", "keywords", [F.col("doc_id")])


def text_queries(spark, folder):
    """Benchmark texts as queries: nearest cluster, then the closest documents in it."""
    rows, model, centroids = _clustered_texts(spark, folder)
    items = load(spark, folder, "benchmark").select("item_id", tx.clean_text(F.col("text")).alias("clean_text"))
    queries = _stored(spark, items, "questions")
    asked = vectors.assign_texts(queries, "clean_text", model, centroids)
    return vectors.most_similar_texts(asked, _stored(spark, rows, "assigned"), "item_id", "doc_id", "clean_text", model, n=5)


def _language(lang):
    """Documents grouped by language: 1 to 4, 0 for any other."""
    return F.coalesce(F.array_position(F.array(*map(F.lit, _LANGUAGES)), lang), F.lit(0)).cast("int")


def text_matches(spark, folder):
    """Benchmark texts as queries with given groups: the language whose mean vector is nearest, then the closest documents in it."""
    docs = _stored(spark, dealt(load(spark, folder, "documents")).select("doc_id", "text", _language(F.col("lang")).alias("cluster_id")), "grouped")
    model = vectors.fit_terms(docs, "text", _TEXT_FEATURES)
    unit = model.vectorise(docs, "text").select("cluster_id", F.inline(vectors.sparse_entries(F.col("vector"))))
    sums = unit.groupBy("cluster_id", "i").agg(F.sum("weight").alias("s")).collect()  # groups x features
    sizes = dict(docs.groupBy("cluster_id").count().collect())
    centroids = np.full((len(_LANGUAGES) + 1, len(model.terms)), np.nan)
    for group in sizes:
        centroids[group] = 0
    for group, i, s in sums:
        centroids[group, i] = s / sizes[group]
    held = sorted(sizes)
    items = load(spark, folder, "benchmark").select("item_id", "text")
    asked = vectors.assign_texts(items, "text", model, centroids[held])
    asked = asked.withColumn("cluster_id", F.element_at(F.array(*map(F.lit, held)), F.col("cluster_id") + 1))
    found = vectors.most_similar_texts(_stored(spark, asked, "asked"), docs, "item_id", "doc_id", "text", model, n=5)
    return found.select("query_id", "member_id", F.round("similarity", 8).alias("similarity"), F.col("rank").cast("bigint").alias("rank"))


def _stored_posts(spark, folder):
    """Order lines as posts: the part is the title, the month of shipping the body."""
    lines = load(spark, folder, "lineitem").join(
        load(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type"), "l_partkey"
    )
    posts = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("post_id"),
        F.concat_ws(" ", "p_name", F.initcap("p_type")).alias("title"),
        F.concat(F.lit("<p>ships "), F.date_format("l_shipdate", "MMMM"), F.lit("</p>")).alias("body"),
        F.concat(F.lit("supplier"), F.col("l_suppkey").cast("string")).alias("author"),
        F.unix_date(F.to_date("l_shipdate")).cast("bigint").alias("created_utc"),
        F.col("l_quantity").alias("score"),
        F.col("l_orderkey").alias("seq"),
    )
    fresh = stored_defaults(preprocess_posts(posts, "title", "body", "author"), ["score"]).drop("author", "body")
    empty = fresh.drop("seq").limit(0)
    return _stored(spark, merge.replace_upsert(empty, fresh, "post_id", "seq"), "posts")


def post_clusters(spark, folder):
    """From raw rows to stored, clustered posts: the five posts nearest to each centroid."""
    clustered, _ = cluster_stored_posts(_stored_posts(spark, folder), k=6, restarts=10)
    rows = clustered.withColumn("centroid_distance", F.round("centroid_distance", 9))
    near = vectors.near_centroid(rows, [F.desc("created_utc"), F.asc("post_id")], 5)
    return near.select(
        "cluster_id", "rank", "post_id", "title", "clean_text", "keywords", "topic_hint", "author_masked", "score"
    )


def pca_projection(spark, folder):
    rows = _embeddings(spark, folder).withColumn("features", array_to_vector("vector"))
    return vectors.project_2d(rows.select("vec_id", "features"), "features").select(
        "vec_id", F.round("pc1", 6).alias("pc1"), F.round("pc2", 6).alias("pc2")
    )


_EMBEDDED = f"""
e AS (SELECT vec_id, label % {GROUPS} AS label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
c AS (SELECT label AS cluster_id, i, avg(v) AS m FROM e GROUP BY 1, 2)"""
_ASSIGNED = _EMBEDDED + """,
gaps AS (SELECT vec_id, cluster_id, sqrt(sum((v - m) * (v - m))) AS d FROM e JOIN c USING (i) GROUP BY 1, 2),
hit AS (SELECT vec_id, arg_min(cluster_id, d) AS cluster_id, min(d) AS d FROM gaps GROUP BY 1)"""
_COSINE = f"""WITH {_ASSIGNED},
scores AS (SELECT c.cluster_id AS query_id, e.vec_id AS member_id, sum(v * m) / sqrt(sum(v * v)) / sqrt(sum(m * m)) AS s
  FROM hit JOIN c USING (cluster_id) JOIN e ON e.vec_id = hit.vec_id AND e.i = c.i GROUP BY 1, 2)
SELECT query_id::BIGINT AS query_id, member_id, round(s, 5) AS similarity, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 12) DESC, member_id) AS rank FROM scores) WHERE rank <= 5"""
_TERMS = r"""
words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\pL\pN_]+')) AS w,
          generate_subscripts(regexp_extract_all(lower(text), '[\pL\pN_]+'), 1) AS p FROM documents),
kept AS (SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS p FROM words WHERE length(w) > 1),
terms AS (SELECT doc_id, w AS token FROM kept
          UNION ALL SELECT a.doc_id, a.w || ' ' || b.w FROM kept a JOIN kept b ON a.doc_id = b.doc_id AND b.p = a.p + 1),
tf AS (SELECT doc_id, token, count(*) AS n FROM terms GROUP BY 1, 2),
stats AS (SELECT token, CAST(sum(n) AS BIGINT) AS total, count(*) AS docs FROM tf GROUP BY 1)"""

_MATCHES = f"""WITH {_TERMS},
vocabulary AS (SELECT token, ln((1 + (SELECT count(*) FROM documents)) / (1 + docs)::DOUBLE) + 1 AS idf FROM stats
  WHERE docs >= 2 ORDER BY total DESC, token LIMIT {_TEXT_FEATURES}),
grp AS (SELECT doc_id, coalesce(list_position({list(_LANGUAGES)}, lang), 0)::INTEGER AS c FROM documents),
raw AS (SELECT doc_id, token, n * idf AS x FROM tf JOIN vocabulary USING (token)),
d AS (SELECT doc_id, token, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS x FROM raw),
qwords AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[\\pL\\pN_]+')) AS w,
           generate_subscripts(regexp_extract_all(lower(text), '[\\pL\\pN_]+'), 1) AS p FROM benchmark),
qkept AS (SELECT item_id, w, row_number() OVER (PARTITION BY item_id ORDER BY p) AS p FROM qwords WHERE length(w) > 1),
qterms AS (SELECT item_id, w AS token FROM qkept
           UNION ALL SELECT a.item_id, a.w || ' ' || b.w FROM qkept a JOIN qkept b ON a.item_id = b.item_id AND b.p = a.p + 1),
qraw AS (SELECT item_id, token, count(*) * any_value(idf) AS x FROM qterms JOIN vocabulary USING (token) GROUP BY 1, 2),
q AS (SELECT item_id, token, x / sqrt(sum(x * x) OVER (PARTITION BY item_id)) AS x FROM qraw),
size AS (SELECT c, count(*) AS k FROM grp GROUP BY 1),
mean AS (SELECT c, token, sum(x) / any_value(k) AS m FROM d JOIN grp USING (doc_id) JOIN size USING (c) GROUP BY 1, 2),
norm AS (SELECT size.c, coalesce(sum(m * m), 0) AS s FROM size LEFT JOIN mean USING (c) GROUP BY 1),
gap AS (SELECT item_id, norm.c, any_value(norm.s) - 2 * coalesce(sum(q.x * m), 0) AS g FROM (SELECT item_id FROM benchmark) CROSS JOIN norm
  LEFT JOIN q USING (item_id) LEFT JOIN mean ON mean.c = norm.c AND mean.token = q.token GROUP BY 1, 2),
hit AS (SELECT item_id, arg_min(c, g) AS c FROM gap GROUP BY 1),
dot AS (SELECT q.item_id, d.doc_id, sum(q.x * d.x) AS s FROM q JOIN hit USING (item_id) JOIN d USING (token) JOIN grp ON grp.doc_id = d.doc_id AND grp.c = hit.c GROUP BY 1, 2),
scores AS (SELECT item_id, grp.doc_id, coalesce(s, 0) AS s FROM hit JOIN grp USING (c) LEFT JOIN dot USING (item_id, doc_id))
SELECT item_id AS query_id, doc_id AS member_id, round(s, 8) AS similarity, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(s, 12) DESC, doc_id) AS rank FROM scores) WHERE rank <= 5"""


def _leading(name: str, start: str, squarings: int = 14) -> str:
    """CTEs that end in ``{name}`` (i, x): the leading eigenvector of the matrix ``start`` (i, j, v), by repeated squaring."""
    steps = [f"{name}_0 AS MATERIALIZED (SELECT i, j, v / (SELECT sum(v) FROM {start} WHERE i = j) AS v FROM {start})"]
    for k in range(squarings):
        steps.append(f"""{name}_s{k + 1} AS MATERIALIZED (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM {name}_{k} a JOIN {name}_{k} b ON a.j = b.i GROUP BY 1, 2),
{name}_{k + 1} AS MATERIALIZED (SELECT i, j, v / (SELECT sum(v) FROM {name}_s{k + 1} WHERE i = j) AS v FROM {name}_s{k + 1})""")
    last = f"{name}_{squarings}"
    steps.append(f"""{name}_c AS MATERIALIZED (SELECT i, v FROM {last} WHERE j = (SELECT arg_max(i, v) FROM {last} WHERE i = j)),
{name} AS MATERIALIZED (SELECT i, v / (SELECT sqrt(sum(v * v)) FROM {name}_c) * (SELECT sign(arg_max(v, abs(v))) FROM {name}_c) AS x FROM {name}_c)""")
    return ",\n".join(steps)


_PROJECTION = f"""WITH e AS MATERIALIZED (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT i, avg(v) AS m FROM e GROUP BY 1), z AS MATERIALIZED (SELECT vec_id, i, v - m AS v FROM e JOIN m USING (i)),
c AS MATERIALIZED (SELECT a.i, b.i AS j, avg(a.v * b.v) AS v FROM z a JOIN z b USING (vec_id) GROUP BY 1, 2),
{_leading("p", "c")},
l AS (SELECT sum(a.x * c.v * b.x) AS l FROM p a JOIN c ON a.i = c.i JOIN p b ON b.i = c.j),
r AS MATERIALIZED (SELECT c.i, c.j, c.v - l * a.x * b.x AS v FROM c JOIN p a ON a.i = c.i JOIN p b ON b.i = c.j, l),
{_leading("q", "r")}
SELECT vec_id, round(sum(z.v * p.x), 6) AS pc1, round(sum(z.v * q.x), 6) AS pc2 FROM z JOIN p USING (i) JOIN q USING (i) GROUP BY 1"""

QUERIES = {
    "text_matches": Query(text_matches, _MATCHES),
    "group_means": Query(
        group_means, f"WITH {_EMBEDDED} SELECT cluster_id AS label, i::INTEGER AS i, round(m, 6) AS mean FROM c"
    ),
    "nearest_centroid": Query(
        nearest_centroid, f"WITH {_ASSIGNED} SELECT vec_id, cluster_id, round(d, 5) AS centroid_distance FROM hit"
    ),
    "cluster_members": Query(
        cluster_members,
        f"WITH {_ASSIGNED} SELECT cluster_id, count(*) AS members, round(avg(d), 5) AS mean_distance FROM hit GROUP BY 1",
    ),
    "near_centroid": Query(
        near_centroid,
        f"""WITH {_ASSIGNED} SELECT cluster_id, vec_id, round(d, 5) AS centroid_distance, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY round(d, 9), vec_id) AS rank FROM hit) WHERE rank <= 5""",
    ),
    "cluster_view": Query(
        cluster_view,
        f"""WITH {_ASSIGNED} SELECT cluster_id, vec_id, CASE WHEN length(t) > 60 THEN substr(t, 1, 60) || '...' ELSE t END AS title
FROM (SELECT *, repeat('Vector ' || vec_id || ' ', 6) AS t,
             row_number() OVER (PARTITION BY cluster_id ORDER BY round(d, 9), vec_id) AS rank FROM hit) WHERE rank <= 20""",
    ),
    "cluster_writeback": Query(
        cluster_writeback,
        f"""WITH {_ASSIGNED} SELECT doc_id AS id, source, cluster_id, round(d, 5) AS centroid_distance
FROM documents LEFT JOIN hit ON vec_id = doc_id""",
    ),
    "cosine_topk": Query(cosine_topk, _COSINE),
    "cosine_topk_blocks": Query(cosine_topk_blocks, _COSINE),
    "tfidf_terms": Query(
        tfidf_terms,
        f"""WITH {_TERMS},
vocabulary AS (SELECT token, ln((1 + (SELECT count(*) FROM documents)) / (1 + docs)::DOUBLE) + 1 AS idf FROM stats
  WHERE docs >= 2 ORDER BY total DESC, token LIMIT {_TEXT_FEATURES}),
weighted AS (SELECT doc_id, token, n * idf AS x FROM tf JOIN vocabulary USING (token))
SELECT doc_id, token AS term, round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 6) AS weight FROM weighted""",
    ),
    "term_statistics": Query(term_statistics, f"WITH {_TERMS} SELECT token, total, docs FROM stats WHERE docs >= 2"),
    "kmeans_sizes": Query(kmeans_sizes),
    "kmeans_invariants": Query(
        kmeans_invariants,
        "SELECT count(*) AS rows, 0::BIGINT AS misassigned, 0::BIGINT AS moved, false AS dearer FROM embeddings",
    ),
    "text_clusters": Query(text_clusters),
    "text_cluster_keywords": Query(text_cluster_keywords),
    "text_queries": Query(text_queries),
    "post_clusters": Query(post_clusters),
    "pca_projection": Query(pca_projection, _PROJECTION),
}
