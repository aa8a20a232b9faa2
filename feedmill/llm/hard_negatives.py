"""Hard negatives by Four-Russians scoring.

Vectors are whole numbers. A candidate is cut into bit planes (two's complement) and each
plane into bytes, one byte for eight dimensions. For each group of eight dimensions an
anchor has a table of its 256 subset sums. So the sum over one plane of a candidate is one
table lookup a byte, and the planes are added up by shifts: every score is exact and no
product is ever formed.

Every anchor is scored against every row. The rows are cut into blocks and the anchors into
chunks; a task holds one chunk and a few blocks and returns the few best rows of each
anchor, which are then merged. Rows of the anchor's own label are scored first; its
positives bound the scores that its negatives may have, and then all other rows are scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from feedmill.llm.tables import task_count
from feedmill.session import cut

# Vectors of a block, blocks that a task takes from one key, anchors of a chunk, and
# anchors and vectors that are scored in one table of numbers.
BLOCK = 4096
TASK_BLOCKS = 8
CHUNK = 4096
TILE = 256
ROWS = 1024
# Whole components stay below this, else the query raises.
LARGEST = 1 << 40


# --- planes and scores -------------------------------------------------------------

def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """Bytes (planes, groups of eight dimensions, vectors) of whole vectors (vectors, dimensions).

    The last plane is the sign's. There are as many planes as the largest number asks for.
    """
    count, size = vectors.shape
    most = int(np.maximum(vectors, ~vectors).max(initial=0))
    planes = most.bit_length() + 1
    groups = -(-size // 8)
    padded = np.zeros((count, groups * 8), dtype=np.int64)
    padded[:, :size] = vectors
    out = np.empty((planes, groups, count), dtype=np.uint8)
    for b in range(planes):
        out[b] = np.packbits((padded >> b & 1).astype(np.uint8), axis=1, bitorder="little").T
    return out


def subset_sums(anchors: np.ndarray, groups: int, kind: type) -> np.ndarray:
    """Tables (groups, 256, anchors): for each byte the sum of the components at its set bits.

    Dimensions that the anchors lack count as zero, those beyond the groups are not asked for.
    """
    count, size = anchors.shape
    wide = np.zeros((count, groups * 8), dtype=kind)
    wide[:, : min(size, groups * 8)] = anchors[:, : groups * 8]
    tables = np.zeros((groups, 256, count), dtype=kind)
    for g in range(groups):
        for j in range(8):
            tables[g, 1 << j:2 << j] = tables[g, : 1 << j] + wide[:, 8 * g + j]
    return tables


def number_type(anchors: np.ndarray, planes: int) -> type:
    """The narrower type that no partial sum of the scores overflows."""
    bound = int(np.abs(anchors).sum(axis=1).max(initial=0)) << planes
    if bound >> 62:
        raise OverflowError("scores of these vectors need more than 64 bits")
    return np.int32 if bound >> 30 == 0 else np.int64


def scores(tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Inner products (vectors, anchors), by lookups and shifts alone."""
    planes, groups, count = codes.shape
    total = np.zeros((count, tables.shape[2]), dtype=tables.dtype)
    got = np.empty_like(total)
    for b in reversed(range(planes)):
        np.left_shift(total, 1, out=total)
        for g in range(groups):
            np.take(tables[g], codes[b, g], axis=0, out=got)
            if b == planes - 1:
                total -= got
            else:
                total += got
    return total


class Best:
    """The ``k`` best rows seen so far of each of ``slots``: higher scores first, then
    smaller ids, null ids last."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot = np.empty(0, dtype=np.int64)
        self.score = np.empty(0, dtype=np.int64)
        self.id = np.empty(0, dtype=np.int64)
        self.known = np.empty(0, dtype=bool)
        # A row below this can't be among the best.
        self.least = np.full(slots, np.iinfo(np.int64).min)

    def add(self, slots: np.ndarray, found: np.ndarray, allowed: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        """Take in ``found`` (rows, slots), where ``allowed``."""
        taken = allowed & (found >= self.least[slots])
        if np.count_nonzero(taken) > 4 * self.k * len(slots):
            # Too many to sort: the k-th best of these rows is a bound too.
            held = np.where(taken, found, np.iinfo(found.dtype).min)
            bound = np.partition(held, len(held) - self.k, axis=0)[len(held) - self.k] if len(held) > self.k else held.min(axis=0)
            taken &= found >= bound
        row, column = np.nonzero(taken)
        slot = np.concatenate([self.slot, slots[column]])
        score = np.concatenate([self.score, found[row, column].astype(np.int64)])
        number, sure = np.concatenate([self.id, ids[row]]), np.concatenate([self.known, known[row]])
        order = np.lexsort((number, ~sure, -score, slot))
        slot, score, number, sure = slot[order], score[order], number[order], sure[order]
        starts = np.nonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))[0] if len(slot) else np.empty(0, np.int64)
        place = np.arange(len(slot)) - np.repeat(starts, np.diff(np.append(starts, len(slot))))
        keep = place < self.k
        full = slot[place == self.k - 1]
        self.least[full] = score[place == self.k - 1]
        self.slot, self.score, self.id, self.known = slot[keep], score[keep], number[keep], sure[keep]


# --- blocks ------------------------------------------------------------------------

def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of numbers as a table, short ones filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


BLOCK_SCHEMA = "n int, planes int, rows binary, labels binary, ids binary, known binary, codes binary"


def blocks(rows: DataFrame) -> DataFrame:
    """The rows (row, id, label, vector) in packed blocks, sorted by label inside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                labels = part.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
                order = np.argsort(labels, kind="stable")
                codes = bit_planes(_matrix(part.column(3))[order])
                known = part.column(1).is_valid().to_numpy(zero_copy_only=False)
                ids = part.column(1).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                row = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                packed = [x[order].tobytes() for x in (row, labels, ids, known)] + [codes.tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(order)], pa.int32()), pa.array([len(codes)], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)],
                    names=["n", "planes", "rows", "labels", "ids", "known", "codes"])

    return rows.select("row", "id", "label", "vector").mapInArrow(run, BLOCK_SCHEMA)


def _score_blocks(held: pa.Table, anchors: np.ndarray, pick) -> None:
    """Give ``pick`` the scores of every tile: (first anchor, scores, block's columns, rows)."""
    names = held.column_names
    for k in range(held.num_rows):
        block = {name: held.column(name)[k].as_py() for name in names if name in ("n", "planes", "rows", "labels", "ids", "known", "codes")}
        n, planes = block["n"], block["planes"]
        codes = np.frombuffer(block["codes"], np.uint8)
        codes = codes.reshape(planes, -1 if len(codes) else 0, n)
        columns = {c: np.frombuffer(block[c], np.int64) for c in ("rows", "labels", "ids")} | {"known": np.frombuffer(block["known"], bool)}
        kind = number_type(anchors, planes)
        for first in range(0, len(anchors), TILE):
            tables = subset_sums(anchors[first:first + TILE], codes.shape[1], kind)
            pick(first, min(first + TILE, len(anchors)), tables, codes, columns)


def _positives(wanted: int):
    """Task: the best rows of the anchors' own labels."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("label").to_numpy(), kind="stable")
        right = right.take(pa.array(order))
        vectors, labels, rows = _matrix(right.column("vector")), right.column("label").to_numpy(), right.column("row").to_numpy()
        best = Best(right.num_rows, wanted)

        def pick(first: int, last: int, tables: np.ndarray, codes: np.ndarray, block: dict) -> None:
            own = labels[first:last]
            for label in np.unique(own):
                low, high = np.searchsorted(own, [label, label + 1])
                start, stop = np.searchsorted(block["labels"], [label, label + 1])
                slots = np.arange(first + low, first + high)
                for k in range(start, stop, ROWS):
                    part = slice(k, min(k + ROWS, stop))
                    found = scores(np.ascontiguousarray(tables[:, :, low:high]), np.ascontiguousarray(codes[:, :, part]))
                    best.add(slots, found, block["rows"][part, None] != rows[slots], block["ids"][part], block["known"][part])

        _score_blocks(left, vectors, pick)
        return pa.table({
            "row": pa.array(rows[best.slot], pa.int64()), "positive_id": pa.array(best.id, pa.int64(), mask=~best.known),
            "positive_score": pa.array(best.score, pa.int64())})

    return run


def _negatives(wanted: int, low_share: int, high_share: int):
    """Task: the best rows of other labels within the bounds that each positive sets."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("label").to_numpy(), kind="stable")
        right = right.take(pa.array(order))
        vectors, labels, rows = _matrix(right.column("vector")), right.column("label").to_numpy(), right.column("row").to_numpy()
        given = right.column("scores").to_pylist()
        places = max((len(x) for x in given), default=0)
        least = np.full((len(given), places), np.iinfo(np.int64).max)
        most = np.full((len(given), places), np.iinfo(np.int64).min)
        for k, own in enumerate(given):
            least[k, : len(own)] = [-(-low_share * s // 100) for s in own]
            most[k, : len(own)] = [high_share * s // 100 for s in own]
        best = Best(len(given) * places, wanted)

        def pick(first: int, last: int, tables: np.ndarray, codes: np.ndarray, block: dict) -> None:
            own = labels[first:last]
            for k in range(0, len(block["labels"]), ROWS):
                part = slice(k, k + ROWS)
                found = scores(tables, np.ascontiguousarray(codes[:, :, part]))
                other = block["labels"][part, None] != own
                for p in range(places):
                    allowed = other & (found >= least[first:last, p]) & (found <= most[first:last, p])
                    best.add(np.arange(first, last) * places + p, found, allowed, block["ids"][part], block["known"][part])

        _score_blocks(left, vectors, pick)
        anchor, place = np.divmod(best.slot, max(1, places))
        return pa.table({
            "row": pa.array(rows[anchor], pa.int64()), "place": pa.array(place, pa.int32()),
            "negative_id": pa.array(best.id, pa.int64(), mask=~best.known), "negative_score": pa.array(best.score, pa.int64())})

    return run


def hard_negatives(
    df: DataFrame, anchors: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
    scale: int = 256, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, chunk: int = CHUNK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on the column id. ``label`` is the column label unless given.
    Components become floor(scale * x). For each anchor, its ``positives`` best other rows of
    the same label; for each of these, the ``negatives`` best rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score.

    Rows with a null label, a null vector or a null or non-finite component take no part.
    A row with a null id is no anchor unless the condition says so; it may be found, after
    equally good rows with ids. Repeated rows are rows of their own: each is another row to
    its copies, and a repeated anchor answers once a row. Shorter vectors are filled with
    zeros. Equal scores go by the smaller id. Empty tables give no rows. Other columns are
    ignored. Components of 2**40 and more, or scores beyond 64 bits, raise an error.
    """
    spark = df.sparkSession
    whole = F.transform(vector_col, lambda x: F.when(F.abs(x.cast("double")) * scale < LARGEST, F.floor(x.cast("double") * scale)).otherwise(
        F.raise_error(F.lit("a component is too large"))).cast("long"))
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = df.select(
        F.col(id_col).cast("long").alias("id"), (F.col("label") if label is None else label).cast("long").alias("label"),
        F.when(finite, whole).alias("vector")).where("label IS NOT NULL AND vector IS NOT NULL")
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    packed = cut(blocks(rows), "blocks")
    asked = rows.where(anchors).select("row", "id", "label", "vector")
    n_blocks, n_anchors = packed.count(), asked.count()
    chunks = max(1, -(-n_anchors // chunk))
    shares = max(1, -(-n_blocks // TASK_BLOCKS), min(n_blocks, task_count(spark)))

    # Each block meets each chunk once: a share of the blocks is copied to every chunk.
    left = packed.withColumn("share", F.pmod(F.xxhash64("rows"), F.lit(shares))).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    left = left.groupBy("share", "chunk")

    def meet(questions: DataFrame, task, schema: str) -> DataFrame:
        right = questions.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))
        right = right.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int")).groupBy("share", "chunk")
        return left.cogroup(right).applyInArrow(task, schema)

    found = meet(asked.select("row", "label", "vector"), _positives(positives), "row long, positive_id long, positive_score long")
    first = Window.partitionBy("row").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"))
    found = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    found = cut(found.withColumn("place", F.col("place") - 1), "positives")
    bounds = found.groupBy("row").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "positive_score"))), lambda x: x["positive_score"]).alias("scores"))
    hard = meet(asked.select("row", "label", "vector").join(bounds, "row"), _negatives(negatives, low, high),
                "row long, place int, negative_id long, negative_score long")
    best = Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    hard = hard.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    named = found.join(asked.select("row", F.col("id").alias("anchor_id")), "row")
    return hard.join(named, ["row", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.q, c.q)::BIGINT AS score
  FROM v a JOIN v c ON a.r <> c.r WHERE a.vec_id % 100 = 0
), p AS (
  SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same QUALIFY place <= 5
)
SELECT p.anchor_id, p.positive_id, (row_number() OVER (PARTITION BY p.r, p.place ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.r = p.r AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
