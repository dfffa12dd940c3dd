"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import (
    classifier, decontaminate, hard_negatives, html_text, line_dedup, mixing, near_dup, packing, quality_rules, ranked_search, resharding, secret_scan,
    token_counts,
)
from tabloom.session import load, scratch_dir

OLD_SHARDS, NEW_SHARDS = 32, 40


def held_out(doc_id):
    """The fold that labels are not learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train_labels(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "labels").filter(~held_out(F.col("doc_id")))


def leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


def resharded(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    plan = resharding.reshard(resharding.sized(docs, OLD_SHARDS), OLD_SHARDS, NEW_SHARDS)
    files = resharding.resharded(spark, docs, plan, scratch_dir(spark, "resharded"))
    out = resharding.sized(files, OLD_SHARDS, keep=("shard", "slot"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), F.col("from").alias("old_shard"))


def mixed(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.plan_mix(load(spark, folder, "documents"))
    each = plan.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return each.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def scored(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    out = classifier.score(docs, classifier.fit(docs, train_labels(spark, folder)))
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))


def grouped(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dup.near_duplicates(load(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(load(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def site_lines(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.drop_site_lines(load(spark, folder, "documents"))


def banded(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.compression_rules(load(spark, folder, "documents"))


def page_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_text(load(spark, folder, "pages"))


def secrets(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return secret_scan.scan_secrets(load(spark, folder, "documents"), vocabulary=public_tokenizers.path("word_bpe_49k.json"))


def negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = hard_negatives.whole_vectors(load(spark, folder, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def ranked(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.rank_documents(load(spark, folder, "benchmark"), load(spark, folder, "documents"))


def packed(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(load(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {
    "op1_cgk_decontamination": leaks,
    "op2_min_cost_flow_reshard": resharded,
    "op3_pivotal_mix": mixed,
    "op4_transducer_tokens": tokens,
    "op5_site_line_dedup": site_lines,
    "op6_compression_bands": banded,
    "op7_host_suffix_html": page_text,
    "op8_zstd_novelty_secrets": secrets,
    "op9_nb_svm_quality": scored,
    "op10_superminhash_dedup": grouped,
    "op11_str_hard_negatives": negatives,
    "op12_term_pipeline_search": ranked,
    "op13_nnls_packing": packed,
}
SQL = {"op5_site_line_dedup": line_dedup.SQL, "op11_str_hard_negatives": hard_negatives.SQL, "op12_term_pipeline_search": ranked_search.SQL}
