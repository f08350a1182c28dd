"""Corpus pipeline: quality, near-duplicates, benchmark leaks, source mix, token ids. Part of skein.llm."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import decontaminate, mixing, quality, simhash, tokens
from skein.llm.common import drop_written, fresh_path, written, written_so_far


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier doesn't reject (score of 0.7 or more stays).

    Null and empty texts score alike; rows with null or repeated ids are each judged by their text; a
    table without rows stays empty. This holds for every stage: all columns come through, whatever
    their names.
    """
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality.score_column(model, F.col("text")) >= 0.7)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the one with the smallest doc_id; nulls and repeats as in keep_one()."""
    return simhash.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item within its error budget; null texts hold none and stay."""
    return docs.where(~decontaminate.is_leaked(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), F.col("text")))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order that mixes sources to their target weights; null sources are one source, repeated ids stay together."""
    return mixing.in_mixed_order(docs)


def _file_order(docs: DataFrame) -> list[Column] | None:
    """The order in which a written stage holds its rows; None for anything but a plain file scan."""
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1)
    order = [F.length(part), part, F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    try:
        docs.select(*order).schema  # noqa: B018
    except AnalysisException:
        return None
    return order


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents in mixed order, and what they hold: doc_id, start, n_tokens, ids_crc32."""
    path = fresh_path(spark, "token-files")
    tokens.write_tokens(docs, path, str(public_tokenizers.path("byte_bpe_50k.json")), order=_file_order(docs))
    return tokens.read_digests(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("mixing sources to target weights", mix_stage),
    ("token-ID / binary output", token_stage),
]

#: No stage but the deduplication could be said in SQL; tests hold the whole against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written as Parquet and read again for the next.

    What a stage wrote for itself goes once its rows are written, and those once the next stage has
    read them; the last stage's files stay, since its rows are read from them.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = written_so_far()
    for at, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES):
            docs = written(docs, f"stage{at}")
            drop_written(spark, [p for p in written_so_far()[:-1] if p not in before])
    return docs
