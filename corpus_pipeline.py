"""A training corpus from raw documents: rules, line dedup, near-duplicates, decontamination, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalyard.llm import decontaminate, line_dedup, minhash, packing, quality
from signalyard.llm.common import load
from signalyard.llm.queries import vocabulary
from signalyard.session import durable


def _with_all_columns(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``stage`` keeps, with the columns of ``docs``; while it runs, no name but doc_id and text is in its way."""
    plain = [c if c in ("doc_id", "text", "n_chars") else f"_column_{k}" for k, c in enumerate(docs.columns)]
    done = stage(docs.toDF(*plain))
    return done.select(*[F.col(p).alias(c) for p, c in zip(plain, docs.columns, strict=True)])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep, with all columns as they are.

    Null, empty and short texts (fewer than 50 words) go, by the base rule. Very long texts are measured whole; equal rows are judged
    alike, so both stay or go; an empty table gives an empty one.
    """
    return _with_all_columns(docs, lambda d: quality.repetition(d).filter("kept"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with lines that many share only in the largest doc_id that holds them.

    A column n_chars follows the text, all others stay as they are. A null text becomes an empty one; null ids are one document,
    smaller than all others; rows that share an id are one document, so equal rows keep the same lines.
    """

    def stage(plain: DataFrame) -> DataFrame:
        done = line_dedup.dedup_lines(plain)
        return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in plain.columns else done

    return _with_all_columns(docs, stage)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each class of near-duplicates, with all its columns.

    Of equal rows one stays; texts without words (null or empty) are in no class and stay; a null id comes last in its class.
    """
    return _with_all_columns(docs, minhash.keep_one)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a benchmark item; texts and columns stay as they are.

    A document without words is clean, and so is every one where ``benchmark`` is empty; equal rows are judged alike.
    """
    items = load(spark, sf_dir, "benchmark")
    return _with_all_columns(docs, lambda d: decontaminate.match_benchmark(d, items).filter("NOT contaminated"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens; other columns are not carried.

    A null or empty text is its end id alone; a document longer than a sequence is cut; equal rows are packed one by one.
    """
    pieces = packing.pack(docs, vocabulary("word_bpe_49k.json"), size=2048, end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack_sequences),
]

# Near-duplicate classes and token ids are beyond SQL; tests/llm/test_operators.py has brute-force versions of all stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again.

    Columns besides doc_id and text may have any name and are carried to the last stage; an empty table gives no pieces.
    """
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = durable(docs)
    return docs
