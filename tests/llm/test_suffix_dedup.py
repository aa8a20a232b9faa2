"""Removal of repeated strings (op11) against a count of all windows."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedmill.llm import suffix_dedup as sd
from feedmill.llm.queries import QUERIES

from llm_rows import FOLDER, ROWS, prose


def expected(rows, length):
    raw = [(r[0], (r[1] or "").encode()) for r in rows]
    count = collections.Counter(t[s:s + length] for _, t in raw for s in range(len(t) - length + 1))
    out = []
    for doc, text in raw:
        gone = np.zeros(len(text), dtype=bool)
        for s in range(len(text) - length + 1):
            if count[text[s:s + length]] > 1:
                gone[s:s + length] = True
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum()) if len(text) else 0
        out.append((doc, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("limit", [5, 40, 64])
def test_suffixes_are_sorted(limit):
    rnd = random.Random(limit)
    pieces = [bytes(rnd.choice(b"ab") for _ in range(30)) for _ in range(6)]
    data = b"".join(rnd.choice(pieces) for _ in range(60)) + b"\xff" * (limit + 8)
    starts = np.array(rnd.sample(range(1800), 700))
    order, common = sd.sort_suffixes(data, starts, limit, shallow=16)
    suffixes = [data[s:s + limit] for s in starts[order]]
    assert suffixes == sorted(suffixes)
    for a, b, same in zip(suffixes, suffixes[1:], common[1:]):
        agree = next((k for k in range(limit) if a[k] != b[k]), limit)
        assert same == agree if agree >= min(16, limit // 8 * 8) else same == 0


def test_equal_windows_have_equal_anchors():
    rnd = random.Random(5)
    shared = bytes(rnd.randrange(256) for _ in range(900))
    texts = [bytes(rnd.randrange(256) for _ in range(rnd.randrange(700))) + shared + b"x" * k for k in range(5)]
    texts += [b"", b"short", b"a" * 1500, b"ab" * 900]
    seen = {}
    for text, (keys, _, places) in zip(texts, sd.bundles(texts, 400), strict=True):
        low, size, at = sd.unpack_place(places)
        assert size.sum() == max(0, len(text) - 399)
        for key, a, n, p in zip(keys, low.tolist(), size.tolist(), at.tolist()):
            for s in range(a, a + n):
                assert seen.setdefault(text[s:s + 400], (key, a + p - s)) == (key, a + p - s)
    # A long text is hashed slice by slice, with the same bundles.
    long = prose(3, 90_000).encode()
    whole, moved = sd.bundles([long], 400)[0], sd.bundles([b"y" * 77_777, long], 400)[1]
    assert all((a == b).all() for a, b in zip(whole, moved, strict=True))


@pytest.mark.parametrize("most", [4096, 2, 0])
def test_repeats_of_odd_texts(spark, most):
    """``most`` forces bundles down to narrower ones and to single windows."""
    rnd = random.Random(most)
    passage, line = prose(1, 40), prose(2, 12)
    texts = [prose(k + 10, rnd.randrange(40)) + passage[rnd.randrange(30):] + prose(k + 50, rnd.randrange(40)) for k in range(12)]
    texts += [prose(100 + k, 9) + line + prose(200 + k, 9) for k in range(8)] + [passage[:-k] + "é" * k for k in range(1, 6)]
    texts += ["ab" * 200, "x" * 300, passage, passage, "", prose(7, 30) + prose(7, 30), "日本" * 40]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, None), (None, passage), (3, "another " + passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for length in (60, 33):
        assert found(sd.remove_repeats(df, length=length, most=most)) == expected(rows, length)


def test_repeats_of_odd_rows(odd, nothing):
    assert found(sd.remove_repeats(odd)) == expected(ROWS, 400)
    assert found(sd.remove_repeats(nothing)) == []
    kept = {r.doc_id: bytes(r.kept).decode() for r in sd.remove_repeats(odd, with_kept=True).where("doc_id in (6, 7, 8, 3)").collect()}
    assert kept[3] == "" and kept[8] == "one two" and kept[7] == ""
    with pytest.raises(ValueError, match="length"):
        sd.remove_repeats(odd, length=2)


@pytest.fixture
def no_broadcast(spark):
    """Joins shuffle, as those of large tables do, unless the code marks one for broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_equal_texts_spread_over_tasks(spark, small_splits, no_broadcast):
    """Three quarters of the rows are one text; no task of the result holds them all."""
    rows = [(k, prose(1, 90) if k % 4 else prose(k + 10, 90)) for k in range(400)]
    df = sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 400 and max(sizes) < 150
    assert found(df) == expected(rows, 400)


def test_contents_of_an_anchor_spread_over_tasks(spark, small_splits, no_broadcast, monkeypatch):
    """Every text holds one passage between words of its own: many contents of few anchors."""
    passage, sizes = prose(1, 90), []
    rows = [(k, prose(k + 10, 20) + passage + prose(k + 1000, 20)) for k in range(300)]
    contents = sd._contents

    def seen(sources, asked, length):
        sizes.append([r["count"] for r in asked.groupBy(F.spark_partition_id()).count().collect()])
        return contents(sources, asked, length)

    monkeypatch.setattr(sd, "_contents", seen)
    assert found(sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows, 400)
    assert len(sizes) == 1 and sum(sizes[0]) > 300 and max(sizes[0]) < sum(sizes[0]) / 4


def test_op11_query(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert found(QUERIES["op11_suffix_dedup"](spark, FOLDER)) == expected(rows, 400)
