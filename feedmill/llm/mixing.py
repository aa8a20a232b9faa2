"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target number of words. A target above its source's size is met by
complete epochs first; the fraction that is left is drawn without replacement, with
probabilities weighted by document quality: each document gets the key ``-ln(u) / w`` from
a uniform number ``u`` made of its id, and the smallest keys of a source are taken until
their words reach the fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedmill.llm.tables import running_total, text_of, word_count
from feedmill.session import cut

# Weights of the sources in the order of their names, repeating.
WEIGHTS = (3, 1, 2)
# Words of the mix, as a share of all words.
TOTAL_SHARE = 1.5
# A source is read this often at most.
MOST_EPOCHS = 2
SYMBOLS = "#*$%&|<>"


def quality_weight(text: Column, size: Column) -> Column:
    """Between 0 and 1: falls with the number of symbols a word."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.lit(1.0) / (F.lit(1.0) + symbols / F.greatest(size, F.lit(1)))


def uniform(name: Column, seed: str) -> Column:
    """A number above 0 and below 1 that depends on the name alone: 52 bits of its MD5."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed), name)), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: tuple[int, ...], total_share: float, most_epochs: int) -> DataFrame:
    """Target of every source; ``sizes`` has source and source_size.

    Sources share the total by weight. One that would get more than ``most_epochs`` times
    its size stops there and the rest is shared again. In the end all others get the same
    words a weight, the level; sorted by limit / weight, exactly the first sources are
    stopped, and running sums tell how many.
    """
    ranked = running_total(
        sizes.withColumn("one", F.lit(1)), [], [F.col("source").asc_nulls_last()], {"place": "one"})
    kind = (F.col("place") - 1) % len(weights)
    weight = F.lit(weights[-1])
    for k, w in enumerate(weights[:-1]):
        weight = F.when(kind == k, w).otherwise(weight)
    known = ranked.select(
        "source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * most_epochs).alias("limit"))
    stopped = cut(running_total(
        known.withColumn("limit_a_weight", F.col("limit") / F.col("weight")), [],
        [F.col("limit_a_weight"), F.col("source").asc_nulls_last()], {"limits": "limit", "weights": "weight"}), "levels")
    sums = stopped.agg(F.sum("source_size"), F.sum("weight")).first()
    words, all_weights = float(sums[0] or 0) * total_share, float(sums[1] or 0)
    # What all would take if this source were the last one stopped.
    taken = (F.col("limits") - F.col("limit")) + F.col("limit_a_weight") * (all_weights - F.col("weights") + F.col("weight"))
    last = stopped.where(taken <= words).agg(F.max("limits"), F.max("weights")).first()
    left, sharing = words - float(last[0] or 0), all_weights - float(last[1] or 0)
    level = left / sharing if sharing > 0 else float("inf")
    return stopped.select("source", "source_size", F.least(F.col("limit").cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def mix(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, total_share: float = TOTAL_SHARE, most_epochs: int = MOST_EPOCHS,
    seed: str = "mix:", whole: bool = False, carry: tuple[str, ...] = (),
) -> DataFrame:
    """Words that the mix takes of every document.

    One row a row of ``docs``: doc_id, size (words), source_size, target, taken, epochs
    (complete copies), part (words of the fraction). The document at the edge of a fraction is
    cut there; with ``whole`` it is taken whole if that comes nearer. ``carry`` names
    further columns to keep.

    A null or empty text has size 0 and takes nothing of a fraction; a null source is a
    source of its own, the last; rows with a null id all have one key and go by size, as
    rows that repeat do. Without words all targets are 0. Sizes and keys are narrow rows:
    texts are never moved.
    """
    text = text_of(text_col)
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), text.alias("_text"), word_count(text).alias("size"),
        *[F.col(c).alias(f"_carry_{c}") for c in carry])
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    keyed = sized.withColumn("key", -F.log(uniform(name, seed)) / quality_weight(F.col("_text"), F.col("size"))).drop("_text")
    # Narrow rows, stored: the texts are read once.
    keyed = cut(keyed, "keyed")
    sources = cut(keyed.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    aims = targets(sources, weights, total_share, most_epochs)
    running = running_total(
        keyed, ["source"], [F.col("key"), F.col("doc_id").asc_nulls_first(), F.col("size")], {"upto": "size"})
    aims = aims.select(F.col("source").alias("_source"), "source_size", "target")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    before = F.col("upto") - F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - before))
    if whole:
        part = F.when(2 * part >= F.col("size"), F.col("size")).otherwise(0)
    return (
        running.join(aims, running["source"].eqNullSafe(aims["_source"]))
        .withColumn("epochs", epochs.cast("long"))
        .withColumn("rest", rest)
        .withColumn("part", part.cast("long"))
        .select("doc_id", "size", "source_size", "target",
                (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"), "epochs", "part",
                *[F.col(f"_carry_{c}").alias(c) for c in carry])
    )


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), keyed AS (
  SELECT doc_id, source, size,
         -ln((CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0)
           / (1.0 / (1.0 + CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS DOUBLE) / greatest(size, 1))) AS key
  FROM sized
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY source
), ranked AS (
  SELECT source, source_size, 2 * source_size AS lim,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM sources
), running AS (
  SELECT *, sum(lim) OVER o AS lims, sum(w) OVER o AS ws, sum(w) OVER () AS all_w, 1.5 * CAST(sum(source_size) OVER () AS DOUBLE) AS words
  FROM ranked
  WINDOW o AS (ORDER BY CAST(lim AS DOUBLE) / w, source ASC NULLS LAST ROWS UNBOUNDED PRECEDING)
), stopped AS (
  SELECT coalesce(max(lims), 0) AS lims, coalesce(max(ws), 0) AS ws
  FROM running WHERE CAST(lims - lim AS DOUBLE) + CAST(lim AS DOUBLE) / w * CAST(all_w - ws + w AS DOUBLE) <= words
), aims AS (
  SELECT source, source_size,
         CASE WHEN all_w > s.ws THEN least(CAST(lim AS DOUBLE), (words - CAST(s.lims AS DOUBLE)) / CAST(all_w - s.ws AS DOUBLE) * w)
              ELSE CAST(lim AS DOUBLE) END AS target
  FROM running, stopped s
), taking AS (
  SELECT k.doc_id, k.size, a.source_size, a.target,
         CAST(CASE WHEN a.source_size > 0 THEN floor(a.target / a.source_size) ELSE 0 END AS BIGINT) AS epochs,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS FIRST, k.size ROWS UNBOUNDED PRECEDING) - k.size AS before
  FROM keyed k JOIN aims a ON k.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, size, source_size, target, epochs, part, epochs * size + part AS taken
FROM (
  SELECT *, CAST(greatest(0, least(size, CAST(round(target - epochs * source_size) AS BIGINT) - before)) AS BIGINT) AS part FROM taking
)
"""
