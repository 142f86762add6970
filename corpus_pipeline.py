"""From raw documents to token files: rules, near-duplicates, leaks, mix, tokens.

Every stage takes the session, the documents its predecessor kept and the table folder,
and returns the documents it keeps with their columns; the last returns where each
document stands in the token files. ``run`` writes every result to the shared folder and
reads it back, so that a stage never recomputes the ones before it.

Defined results: an empty table gives an empty result; NULL and empty texts fail the base
rules and go first; of rows of equal id and text one stays; rows without id are documents
of their own; NULL sources are a source; ties are broken by hashes of id and text, so that
reruns agree. Further columns, whatever their names, pass through to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import balancing, decontamination, divergence, minhash, token_files
from strata.llm.frames import table
from strata.llm.queries import vocabulary
from strata.sources.tables import delete_folder, new_folder, owned_stages

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the divergence from their language."""
    return divergence.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.drop_duplicates(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return balancing.mix_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32."""
    how = token_files.Settings(vocabulary())
    return token_files.read_documents(token_files.write_shards(docs, how))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("source_mix", source_mix),
    ("token_output", token_output),
]

#: SQL can express neither the sketches nor the tokens; tests run it beside brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder.

    What a stage writes for itself is deleted when its result is written, and its result
    when the next stage's is.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        with owned_stages(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_folder(spark, before)
        before = path
    return docs
