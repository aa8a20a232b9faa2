"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedmill.llm import hard_negatives, mixing, personal_data, web_archive
from feedmill.llm.alignment import align_documents
from feedmill.llm.bpe import encode_decode
from feedmill.llm.jaccard_join import jaccard_classes
from feedmill.llm.language_id import predict_language, train_network
from feedmill.llm.licences import scan_licences, train_model
from feedmill.llm.nearest import nearest_neighbours
from feedmill.llm.quality import apply_rules
from feedmill.llm.suffix_dedup import remove_repeats
from feedmill.llm.tables import table
from feedmill.llm.token_files import read_token_files, write_token_files
from feedmill.session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_token_files")
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of all documents as addressable codes and read them back."""
    path = new_folder(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path(), end_id=2)
    return read_token_files(spark, path)


@query("op3_bpe")
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode all documents."""
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op4_personal_data")
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Find personal data in all documents."""
    return personal_data.digest(personal_data.detect(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge all documents; those labelled good are the trusted ones."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return apply_rules(table(spark, sf_dir, "documents"), trusted)


@query("op9_mix_sources", mixing.SQL)
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents by source."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op6_web_archive", web_archive.SQL)
def op6_web_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Package all pages and read the packages back."""
    path = new_folder(spark, "packages")
    web_archive.write_packages(table(spark, sf_dir, "pages"), path)
    return web_archive.read_packages(spark, path)


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that language training never sees."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from three folds, predict the language of all documents."""
    docs = table(spark, sf_dir, "documents")
    network = train_network(docs.where(~held_out()), "text", "lang", key=F.col("doc_id"))
    return predict_language(docs.select("doc_id", "text", held_out().alias("held_out")), network).drop("text")


@query("op10_nearest_neighbours")
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@query("op8_jaccard_join")
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join all documents by their four-word shingles."""
    return jaccard_classes(table(spark, sf_dir, "documents")).drop("component")


@query("op2_licences")
def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan all documents for licences."""
    docs = table(spark, sf_dir, "documents")
    found = scan_licences(docs, train_model(docs))
    return found.select(
        "doc_id", F.array_join("families", ",").alias("families"), F.size("findings").cast("long").alias("n_findings"),
        F.array_join(F.transform("findings", lambda x: F.concat_ws(":", x["family"], x["start"].cast("string"), x["end"].cast("string"))), ",").alias("findings"))


@query("op12_hard_negatives", hard_negatives.SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mine hard negatives of every hundredth vector; every seventh row has the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Align the byte-level and the piece vocabulary on all documents."""
    return align_documents(table(spark, sf_dir, "documents"), tokenizer_path(), public_tokenizers.path("piece_bpe_32k.model"))


@query("op11_suffix_dedup")
def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove every repeated string of 400 bytes from all documents."""
    return remove_repeats(table(spark, sf_dir, "documents"))
