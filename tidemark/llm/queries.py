"""The operators over whole tables, as queries of ``(spark, sf_dir)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, clustering, langid, licenses, lines, packing, pieces, quality, rules, simhash, spelling, substrings, vectors


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _in_fold(folds: int, fold: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == fold


def _words_digest(text: str):
    return F.sha2(F.array_join(rules.words_of(F.coalesce(F.col(text), F.lit(""))), " "), 256)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeated_passages(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "n_words", F.col("n_words_removed").alias("n_removed"), _words_digest("text").alias("kept_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _in_fold(3, 1)
    docs = documents(spark, sf_dir)
    model = langid.train_languages(docs.where(~held_out))
    return langid.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.apply_rules(documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _in_fold(5, 0)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality.train_quality(docs.where(~held_out), labels.where(~held_out))
    scored = quality.score_quality(docs.withColumn("held_out", held_out), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(documents(spark, sf_dir), tokenizer_path())
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_length", "step_group"
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(documents(spark, sf_dir), tokenizer_path(), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir)).select("doc_id", "license", "dice", "n_passages")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.remove_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return cut.select("doc_id", "n_lines", F.col("n_lines_removed").alias("n_removed"), digest.alias("kept_sha256"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(documents(spark, sf_dir))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component_id").cast("long").alias("component_id"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters = clustering.cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return clusters.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode_pieces(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"), decoded=True)
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    return coded.select("doc_id", "n_tokens", digest.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup,
        op2_substring_dedup,
        op3_language_id,
        op4_quality_rules,
        op5_quality_classifier,
        op6_packing,
        op7_bpe,
        op8_license_scan,
        op9_line_dedup,
        op10_simhash,
        op11_centroid_clustering,
        op12_sentencepiece,
        op13_spelling_variants,
    )
}
