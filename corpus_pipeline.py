"""A training corpus from raw documents: filter, deduplicate, decontaminate, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. Each is written as Parquet and reread
as the next one's docs. An empty table passes all stages as an empty one, and
extra columns are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidweave.llm.common import staged, table
from bidweave.llm.decontaminate import without_leaks
from bidweave.llm.line_dedup import dedup_lines
from bidweave.llm.sentencepiece_codec import encode_documents
from bidweave.llm.simhash import near_duplicates
from bidweave.llm.toxicity import train, with_toxicity

#: Models, simulations and texts of words too few for SQL: the tests hold run() against plain code.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents scored 0.5 or more by a model of the labels."""
    raw = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(raw, table(spark, sf_dir, "labels"))
    scored = with_toxicity(docs, model, "__toxicity")
    return scored.where(F.col("__toxicity") < 0.5).drop("__toxicity")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops repeated lines. A document that had text and keeps none of it goes;
    ``n_chars`` follows the text."""
    found = dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    emptied = changed & (F.btrim(F.col("kept_text"), F.lit(" \t\n\x0b\x0c\r")) == "")
    kept = found.where(~emptied)
    values = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        size = F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
        values["n_chars"] = F.when(changed, size).otherwise(F.col("n_chars"))
    return kept.withColumns(values).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near copies.

    Of rows that repeat a doc_id one stays; rows without doc_id are in no group
    and stay.
    """
    found = near_duplicates(docs.where(F.col("doc_id").isNotNull()), words=3, bits=3)
    first = found.where(F.col("doc_id") == F.col("component_id"))
    names = staged(first.select(F.col("doc_id").alias("__keep")).distinct(), "kept-documents")
    kept = docs.join(names, F.col("doc_id") == F.col("__keep"), "left_semi")
    return kept.dropDuplicates(["doc_id"]).unionByName(docs.where(F.col("doc_id").isNull()))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_crc32, round_trip) of the documents that are left."""
    coded = encode_documents(
        docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model")
    )
    return coded.select("doc_id", "n_tokens", "ids", "ids_crc32", "round_trip")


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, from ``documents`` on."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return docs
