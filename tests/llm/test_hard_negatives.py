"""Hard negatives (op12) against plain loops and SQL."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import differences, open_tables
from feedmill.llm import hard_negatives as hn
from feedmill.llm.queries import QUERIES, SQL

from llm_rows import FOLDER

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("kind, top", [(np.int32, 200), (np.int64, 1 << 25)])
def test_lookups_give_inner_products(kind, top):
    rng = np.random.default_rng(top)
    for size in (0, 1, 8, 13):
        vectors, anchors = rng.integers(-top, top, (50, size)), rng.integers(-top, top, (7, size))
        codes = hn.bit_planes(vectors)
        assert hn.number_type(anchors, len(codes)) is (kind if size else np.int32)
        got = hn.scores(hn.subset_sums(anchors, codes.shape[1], kind), codes)
        assert (got == vectors @ anchors.T).all()
    with pytest.raises(OverflowError):
        hn.number_type(np.array([[1 << 40] * 8]), 41)


def test_best_keeps_ties_by_id():
    best = hn.Best(2, 3)
    rng = np.random.default_rng(1)
    found, ids = rng.integers(0, 4, (200, 2)), rng.permutation(200)
    known = ids % 5 > 0
    for k in range(0, 200, 50):
        best.add(np.arange(2), found[k:k + 50], np.ones((50, 2), bool), ids[k:k + 50], known[k:k + 50])
    for slot in range(2):
        want = sorted(zip(-found[:, slot], ~known, ids, strict=True))[:3]
        at = best.slot == slot
        assert [(-s, not k, i) for s, i, k in zip(best.score[at], best.id[at], best.known[at])] == [(s, bool(k), i) for s, k, i in want]


def expected(rows):
    """Rows (id, label, vector) by plain loops; every row is its own."""
    last = 1 << 70
    rows = [(i, label, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]) for i, label, v in rows
            if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (anchor, label, vector) in enumerate(rows):
        if anchor is None or anchor % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v)), last if i is None else i, i, other) for c, (i, other, v) in enumerate(rows) if c != a]
        scored.sort(key=lambda x: x[:2])
        for p, _, positive, _ in [s for s in scored if s[3] == label][:5]:
            hard = [s for s in scored if s[3] != label and -80 * p <= -100 * s[0] <= -100 * p][:5]
            out += [(anchor, positive, k + 1, n[2], -p, -n[0]) for k, n in enumerate(hard)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", [4096, 3])
def test_hard_negatives_of_odd_rows(spark, chunk):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 11)) * 0.3
    rows = [(int(k * 5), int(k % 3), (base[k % 6] + rng.normal(size=11) * 0.1).astype(np.float32).tolist()) for k in range(200)]
    rows += [(100, 1, rows[20][2]), (100, 1, rows[20][2]), (7, 2, rows[20][2]), (None, 0, rows[20][2]), (None, 1, rows[40][2]), (0, None, rows[0][2]),
             (1, 1, None), (2, 1, [None] * 11), (3, 1, [float("nan")] * 11), (200, 1, [float("inf")] * 11), (300, 1, []), (4, 2, [0.5]), (400, 0, [1.0] * 20)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(5)
    for name in ("row", "id", "chunk", "share", "place", "scores"):
        df = df.withColumn(name, F.lit("x"))
    found = hn.hard_negatives(df, F.col("id") % 100 == 0, chunk=chunk)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)
    assert hn.hard_negatives(df.limit(0), F.col("id") % 100 == 0).collect() == []
    with pytest.raises(Exception, match="too large"):
        hn.hard_negatives(spark.createDataFrame([(0, 1, [1e30])], "vec_id long, label int, embedding array<float>"), F.lit(True)).collect()


def test_op12_query(spark):
    folder = FOLDER.replace("sf0.001", "sf0.01")
    assert differences(QUERIES["op12_hard_negatives"](spark, folder), open_tables(folder), SQL["op12_hard_negatives"]) == ""
