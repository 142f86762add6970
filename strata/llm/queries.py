"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    balancing,
    byte_bpe,
    byte_cnn,
    credentials,
    decontamination,
    divergence,
    hard_negatives,
    html_text,
    minhash,
    source_audit,
    substrings,
    token_files,
    toxicity,
)
from strata.llm.frames import table
from strata.llm.labelled import remainder

Query = Callable[[SparkSession, str], DataFrame]


def op1_minhash_odd_sketch(spark: SparkSession, d: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, d, "documents"))


def op2_text_tag_ratio(spark: SparkSession, d: str) -> DataFrame:
    found = html_text.extract(table(spark, d, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op3_distribution_divergence(spark: SparkSession, d: str) -> DataFrame:
    judged = divergence.judge(table(spark, d, "documents"))
    return judged.select("doc_id", *divergence.RESULT)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a vocabulary file, from the package that ships it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_wavelet_tokens(spark: SparkSession, d: str) -> DataFrame:
    how = token_files.Settings(vocabulary())
    return token_files.read_documents(
        token_files.write_shards(table(spark, d, "documents"), how)
    )


def op5_credential_linking(spark: SparkSession, d: str) -> DataFrame:
    found = credentials.scan(table(spark, d, "documents"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
    )


def _classified(scores: DataFrame, held_out: Column, limit: float) -> DataFrame:
    return scores.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= limit).cast("int").alias("predicted"),
    )


def op6_cgk_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontamination.matches(
        table(spark, d, "documents"), table(spark, d, "benchmark")
    )


def op7_byte_cnn_quality(spark: SparkSession, d: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 4) == 2
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return _classified(byte_cnn.score(docs, labels, ~held_out), held_out, 0.7)


def op8_difference_cover_dedup(spark: SparkSession, d: str) -> DataFrame:
    found = substrings.repeated_strings(table(spark, d, "documents"))
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]
    )
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.col("kept").alias("kept_sha256"),
    )


def op9_nb_ngram_toxicity(spark: SparkSession, d: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 5) == 0
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return _classified(toxicity.score(docs, labels, ~held_out), held_out, 0.5)


def op10_entropy_balancing(spark: SparkSession, d: str) -> DataFrame:
    mixed = balancing.mix_sizes(table(spark, d, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_source_stripes(spark: SparkSession, d: str) -> DataFrame:
    return source_audit.divergences(table(spark, d, "documents"))


def op12_inverted_multi_index(spark: SparkSession, d: str) -> DataFrame:
    id, label = F.col("vec_id"), F.col("label")
    moved = F.when(id % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = table(spark, d, "embeddings")
    return hard_negatives.mine(vectors, id % 50 == 0, label=moved)


def op13_distinct_word_bpe(spark: SparkSession, d: str) -> DataFrame:
    how = byte_bpe.Settings(vocabulary("byte_bpe_50k.tiktoken"))
    decoded = byte_bpe.decode(byte_bpe.encode(table(spark, d, "documents"), how), how)
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_minhash_odd_sketch,
        op2_text_tag_ratio,
        op3_distribution_divergence,
        op4_wavelet_tokens,
        op5_credential_linking,
        op6_cgk_decontamination,
        op7_byte_cnn_quality,
        op8_difference_cover_dedup,
        op9_nb_ngram_toxicity,
        op10_entropy_balancing,
        op11_source_stripes,
        op12_inverted_multi_index,
        op13_distinct_word_bpe,
    )
}
