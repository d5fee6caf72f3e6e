"""The operators as queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidweave.llm.common import table
from bidweave.llm.decontaminate import contaminated
from bidweave.llm.fill_in_middle import fill_in_middle
from bidweave.llm.hard_negatives import hard_negatives, scaled
from bidweave.llm.line_dedup import dedup_lines
from bidweave.llm.nearest import nearest
from bidweave.llm.packing import pack_documents
from bidweave.llm.sentencepiece_codec import encode_documents
from bidweave.llm.sharding import shard_documents
from bidweave.llm.simhash import hexadecimal, near_duplicates
from bidweave.llm.token_counts import count_tokens
from bidweave.llm.token_files import read_token_files, write_token_files
from bidweave.llm.toxicity import held_out, train, with_toxicity
from bidweave.llm.url_filter import judge, labelled_by_rules, parse_rules
from bidweave.llm.url_filter import train as train_urls
from bidweave.session import new_shared_path

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 24


PIECES = "piece_bpe_32k.model"


BYTES = "byte_bpe_50k.json"
END_ID = 2
PACK_END_ID = 1
URL_RULES = [
    "allow org/",
    "block example.org/es/",
    "block example.org/en/1",
    "allow com/fr/",
    "block com/de/",
]


def q_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


def q_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    write_token_files(docs, path, public_tokenizers.path(BYTES), END_ID)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def q_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls, rules = table(spark, sf_dir, "pages").select("page_id", "url"), parse_rules(URL_RULES)
    return judge(urls, rules, train_urls(labelled_by_rules(urls, rules)))


def q_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def q_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_documents(docs, public_tokenizers.path(PIECES))
    return coded.select("doc_id", "n_tokens", "ids", "ids_crc32", "round_trip")


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return with_toxicity(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def q_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def q_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), SHARDS).withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    )


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def q_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scaled(table(spark, sf_dir, "embeddings"), 256)
    # Some labels are wrong, as in any mined set.
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", turned), F.col("vec_id") % 100 == 0)


def q_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(table(spark, sf_dir, "documents"), texts=False)
    return found.drop("pieces")


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = pack_documents(docs, public_tokenizers.path(BYTES), PACK_END_ID)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def build() -> dict[str, Query]:
    return {
        "op1_nearest_neighbours": q_nearest,
        "op4_token_files": q_token_files,
        "op9_url_filter": q_url_filter,
        "op2_token_counts": q_token_counts,
        "op7_sentencepiece": q_sentencepiece,
        "op3_decontamination": q_decontaminate,
        "op5_toxicity": q_toxicity,
        "op6_line_dedup": q_line_dedup,
        "op8_sharding": q_sharding,
        "op10_simhash_near_dedup": q_simhash,
        "op11_hard_negatives": q_hard_negatives,
        "op12_fill_in_middle": q_fill_in_middle,
        "op13_packing": q_packing,
    }
