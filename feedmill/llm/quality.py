"""Quality rules: plain counts, and a likelihood ratio between trusted and raw text.

Words and word pairs are hashed to buckets. Two multinomials over the buckets are counted:
one over all trusted texts, one over the whole corpus. A text's score is the mean, over its
n-grams, of the logarithm of trusted over raw probability; a text that scores below the
threshold is dropped. Everything is built of DataFrame functions.

The trusted multinomial is mixed with a little of the raw one, in its own proportions: an
n-gram that no trusted text has then costs the same at every size of the corpus, and one
bucket is not smoothed more than another because it is rare.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedmill.llm.tables import WORD, text_of
from feedmill.session import cut

# Buckets. A task hands on at most one count a bucket, so their number bounds the shuffle.
BUCKETS = 1 << 21
# Buckets whose ratios travel together, as one array.
PACKED = 1 << 10
# Share of the raw multinomial in the trusted one.
MIXED = 0.02
# Mean thousandths of a natural logarithm below which a text is dropped.
THRESHOLD = -350
FEWEST_WORDS = 50
MOST_REPEATED = 50
SYMBOL = "[#*$%&|<>]"
# Trusted ids meet the texts through a broadcast only while they take less than this.
BROADCAST_BYTES = 32 << 20


def _words(text: str) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _joined(firsts: Column, seconds: Column) -> Column:
    """A hash of each of ``firsts`` that has one of ``seconds`` at its place, and that one."""
    both = F.zip_with(firsts, seconds, lambda a, b: F.xxhash64(a, b))
    return F.slice(both, F.lit(1), F.size(seconds))


def _from(hashes: Column, place: int) -> Column:
    """The hashes from a place, counted from one."""
    return F.slice(hashes, F.lit(place), F.greatest(F.size(hashes) - (place - 1), F.lit(0)))


def _pairs(hashes: Column) -> Column:
    """A hash of each two consecutive words, from the hashes of the words."""
    return _joined(hashes, _from(hashes, 2))


def _bucket(gram: Column, buckets: int) -> Column:
    """The bucket of a word or word pair, from its hash."""
    return F.pmod(gram, F.lit(buckets)).cast("int")


def _hashed(texts: DataFrame, *columns: str) -> DataFrame:
    """The columns, the words and their hashes."""
    words = texts.select(*columns, _words("text").alias("words"))
    return words.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))


def with_trusted(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``texts`` with a column trusted, 1 where ``ids`` (doc_id) has their id, else 0.

    While the ids are few they are broadcast and no text moves; else texts meet them by shuffle.
    """
    known = ids.where("doc_id IS NOT NULL").distinct().withColumn("trusted", F.lit(1))
    small = known.count() * 16 <= BROADCAST_BYTES
    met = texts.join(F.broadcast(known) if small else known.hint("merge"), "doc_id", "left")
    return met.withColumn("trusted", F.coalesce("trusted", F.lit(0)))


def bucket_counts(texts: DataFrame, buckets: int) -> DataFrame:
    """bucket, raw, good: n-grams of all texts and of the trusted ones, counted in one pass
    over ``texts`` (text, trusted)."""
    hashes = _hashed(texts, "text", "trusted")
    # Unfolded as they are: what is done to a row is compiled, what is done inside an array is not.
    grams = hashes.select("trusted", F.explode(F.concat("hashes", _pairs(F.col("hashes")))).alias("gram")).select(
        "trusted", _bucket(F.col("gram"), buckets).alias("bucket"))
    return grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("good"))


def likelihood_ratios(counts: DataFrame, mixed: float) -> DataFrame:
    """bucket, ratio: thousandths of ln(trusted / raw), whole numbers; without trusted texts
    no n-gram is better than another."""
    counts = cut(counts, "counts")
    sums = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first()
    raw, good = float(sums[0]), float(sums[1])
    ratio = F.log((F.col("good") / F.col("raw") * raw + mixed * good) / ((1 + mixed) * good)) if good else F.lit(0.0)
    return counts.select("bucket", F.round(ratio * 1000).cast("int").alias("ratio"))


def packed_ratios(ratios: DataFrame, buckets: int) -> DataFrame:
    """pack, ratios: those of ``PACKED`` consecutive buckets as one array, 0 where there is none."""
    every = ratios.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    placed = every.join(ratios, "bucket", "left").select(
        F.shiftright("bucket", PACKED.bit_length() - 1).alias("pack"), F.struct("bucket", F.coalesce("ratio", F.lit(0)).alias("ratio")).alias("x"))
    return placed.groupBy("pack").agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["ratio"]).alias("ratios"))


def _repeats(triples: Column) -> Column:
    """The triples with their places, sorted, where any triple occurs twice; else null."""
    placed = F.sort_array(F.transform(triples, lambda t, k: F.struct(t.alias("t"), k.alias("k"))))
    return F.when(F.size(F.array_distinct(triples)) < F.size(triples), placed)


def apply_rules(
    docs: DataFrame, trusted_ids: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    buckets: int = BUCKETS, mixed: float = MIXED, threshold: int = THRESHOLD,
) -> DataFrame:
    """Counts and verdict of every document; ``trusted_ids`` has one column, ids of trusted ones.

    One row a document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, score (mean thousandths of ln(trusted / raw); null without words).
    A null or empty text has no words and fails; repeated rows and rows with a null id are
    judged alike; null trusted ids are ignored; other columns are ignored. Without trusted
    texts no text is better than another and only the base rules decide.

    Two passes over the texts: one counts the n-grams, one judges. What leaves a task is at
    most one count a bucket, then one row a document. ``buckets`` is rounded up to a whole
    number of packs; their ratios take four bytes each and are broadcast.
    """
    buckets = -(-buckets // PACKED) * PACKED
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    ids = trusted_ids.select(F.col(trusted_ids.columns[0]).alias("doc_id"))
    ratios = likelihood_ratios(bucket_counts(with_trusted(texts, ids), buckets), mixed)
    packs = F.broadcast(packed_ratios(ratios, buckets))

    words = _hashed(texts.withColumn("row", F.monotonically_increasing_id()), "row", "doc_id", "text")
    words = words.select("*", _pairs(F.col("hashes")).alias("pairs"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    cuts = words.select(
        "row", "doc_id", F.size("words").cast("long").alias("n_words"), F.length(F.concat_ws("", "words")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        lines.alias("lines"), _joined(F.col("pairs"), _from(F.col("hashes"), 3)).alias("triples"), F.concat("hashes", "pairs").alias("grams"))
    marked = cuts.select(
        "row", "doc_id", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeats(F.col("triples")).alias("placed"), "grams")
    twice = F.filter("placed", lambda x, k: F.coalesce(
        (F.get("placed", k - 1)["t"] == x["t"]) | (F.get("placed", k + 1)["t"] == x["t"]),
        F.get("placed", k - 1)["t"] == x["t"], F.get("placed", k + 1)["t"] == x["t"], F.lit(False)))
    # A repeated window covers three words, less those that the repeated one before covers.
    covered = F.aggregate(
        F.sort_array(F.transform(twice, lambda x: x["k"])),
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("sum")),
        lambda got, k: F.struct(k.alias("last"), (got["sum"] + F.least(F.lit(3), k - got["last"])).alias("sum")),
        lambda got: got["sum"])
    counted = marked.select(
        "row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), "grams")
    keys = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    grams = counted.select("row", *keys, F.explode_outer("grams").alias("gram")).select(
        "row", *keys, _bucket(F.col("gram"), buckets).alias("bucket"))
    met = grams.join(packs, F.shiftright("bucket", PACKED.bit_length() - 1) == F.col("pack"), "left")
    # All n-grams of a text are in one task: what leaves it is one row a document.
    ratio = F.get("ratios", F.col("bucket").bitwiseAND(PACKED - 1))
    summed = met.groupBy("row", *keys).agg(F.sum(ratio).alias("ratio"), F.count("bucket").alias("grams"))
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return summed.select(
        *keys, failed.alias("base_failed"), (~failed & (F.col("ratio") >= threshold * F.col("grams"))).alias("kept"),
        (F.col("ratio") / F.col("grams")).alias("score"))
