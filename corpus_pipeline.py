"""A corpus pipeline of five operators: language, near copies, personal data, mix, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a
table; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from feedmill.llm.bpe import encode_decode
from feedmill.llm.jaccard_join import jaccard_classes
from feedmill.llm.language_id import UNKNOWN, predict_language, train_network
from feedmill.llm.mixing import mix
from feedmill.llm.personal_data import mask
from feedmill.llm.tables import table
from feedmill.session import cut

# A text stays if its language has at least this probability; an even split over a few
# languages, as symbols or digits give, is below it.
LEAST_SCORE = 0.3
NEAR_WORDS = 5
NEAR_HUNDREDTHS = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is recognised; a null lang gets the predicted one.

    Null texts and texts without letters are rejected. Without labelled texts nothing can
    be learnt and everything is rejected.
    """
    network = train_network(docs, "text", "lang", key=F.col("doc_id"))
    found = predict_language(docs, network).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def _with_key(docs: DataFrame, *columns: str) -> DataFrame:
    """The given columns and two hashes of the whole row; equal rows have equal ones."""
    whole = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(*columns, F.xxhash64(*whole).alias("_row_1"), F.xxhash64(F.lit(1), *whole).alias("_row_2"))


def _repeat(docs: DataFrame, times: DataFrame) -> DataFrame:
    """Every distinct row of ``docs`` as often as ``times`` (by the hashes) says.

    Texts move once, to meet their narrow row of ``times``.
    """
    keys = ["_row_1", "_row_2"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    whole = [F.col(f"whole.`{c}`") for c in docs.columns]
    met = rows.select("whole", F.xxhash64(*whole).alias("_row_1"), F.xxhash64(F.lit(1), *whole).alias("_row_2")).join(times, keys)
    one = met.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))).where("_place = 1")
    return one.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select("whole.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: the one with the smallest id.

    Rows that repeat are one document. A row without an id stays only if its group has no
    row with one; rows without words are in no group and stay, once each.
    """
    classes = jaccard_classes(_with_key(docs, "doc_id", "text"), words=NEAR_WORDS, threshold=NEAR_HUNDREDTHS, carry=("_row_1", "_row_2"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "_row_1", "_row_2")).alias("first")
    groups = classes.where("component IS NOT NULL").groupBy("component").agg(first).select("first._row_1", "first._row_2")
    alone = classes.where("component IS NULL").select("_row_1", "_row_2").distinct()
    return _repeat(docs, groups.unionByName(alone).withColumn("times", F.lit(1)))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; no document goes."""
    return mask(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take every document as often as the mix does: once an epoch, and once more where the
    fraction takes it; documents the mix does not take go."""
    taken = mix(_with_key(docs, "doc_id", "text", "source"), whole=True, carry=("_row_1", "_row_2"))
    times = F.sum(F.col("epochs") + (F.col("part") > 0).cast("long")).cast("int").alias("times")
    return _repeat(docs, taken.groupBy("_row_1", "_row_2").agg(times).where("times > 0"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every text: digests as in the operator's query, and the ids."""
    return encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix", mixed),
    ("tokens", tokens),
]

# Hashing, learning and merging can't be said in SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
