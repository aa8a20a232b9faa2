"""Positions and envelopes over many files and many blocks."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from checks import plan_nodes, text_scans
from feedmill import session
from feedmill.plans.fixtures import ORDER_HEADER, ORDER_TRAILER
from feedmill.sinks.fixed import write_feeds, write_fixed
from feedmill.sources.fixed import absolute_offset, last_per_feed, read_fixed
from feedmill.sources.lines import count_blocks, read_lines, split_envelope, with_positions
from feedmill.fields import Layout


def _write(path, lines, end="\n"):
    path.write_bytes((end.join(lines) + end).encode())


def _name(df):
    return df.withColumn("feed", F.element_at(F.split("feed", "/"), -1))


def test_positions_over_files_and_blocks(spark, small_splits, tmp_path):
    sizes = {"a.dat": 1, "b.dat": 700, "c.dat": 2500}
    for name, n in sizes.items():
        _write(tmp_path / name, [f"{name}:{i:06d}" for i in range(n)])
    lines = read_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 8
    rows = _name(with_positions(lines)).collect()
    assert len(rows) == sum(sizes.values())
    for r in rows:
        assert r.value == f"{r.feed}:{r.line_no:06d}"
        assert r.feed_lines == sizes[r.feed]


def test_positions_when_blocks_are_too_many_to_broadcast(spark, small_splits, tmp_path, monkeypatch):
    monkeypatch.setattr("feedmill.session.BROADCAST_LIMIT", 0)
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        for name in "ab":
            _write(tmp_path / name, [f"{name}:{i:06d}" for i in range(1500)])
        placed = with_positions(read_lines(spark, str(tmp_path)))
        assert "Broadcast" not in placed._jdf.queryExecution().toString()
        rows = _name(placed).collect()
    finally:
        spark.conf.set(key, before)
    assert len(rows) == 3000
    assert all(r.value == f"{r.feed}:{r.line_no:06d}" for r in rows)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_envelope_per_file(spark, small_splits, tmp_path, end):
    for name, n in (("a", 300), ("b", 5)):
        body = [f"{i:05d}" + ("" if i % 3 else "x" * 20) for i in range(n)]
        body.insert(2, "   ")
        _write(tmp_path / name, ["H1", "H2", *body, "T"], end)
    data, header, trailer = split_envelope(read_lines(spark, str(tmp_path)), 2, 1)
    counts = {r.feed: r["count"] for r in _name(data).groupBy("feed").count().collect()}
    assert counts == {"a": 300, "b": 5}
    assert data.filter("value rlike '[HT\r]' or trim(value) = ''").count() == 0
    assert sorted(r.value for r in header.collect()) == ["H1", "H1", "H2", "H2"]
    assert {(r.feed, r.line_no, r.value) for r in _name(trailer).collect()} == {
        ("a", 303, "T"), ("b", 8, "T")}


def test_short_feeds_and_no_envelope(spark, tmp_path):
    _write(tmp_path / "one", ["ONLY"])
    lines = read_lines(spark, str(tmp_path))
    data, header, trailer = split_envelope(lines, 1, 1)
    assert data.count() == 0
    assert [r.value for r in header.collect()] == [r.value for r in trailer.collect()] == ["ONLY"]
    data, header, trailer = split_envelope(lines)
    assert (data.count(), header.count(), trailer.count()) == (1, 0, 0)


def test_directory_feeds_follow_part_numbers(spark, tmp_path):
    names = ["part-00002-x-c000.txt", "part-99999-x-c000.txt", "part-100000-x-c000.txt"]
    for i, name in enumerate(names):
        _write(tmp_path / name, [f"{i}{k}" for k in range(3)])
    rows = with_positions(read_lines(spark, str(tmp_path)), "directory").orderBy("line_no").collect()
    assert [r.value for r in rows] == ["00", "01", "02", "10", "11", "12", "20", "21", "22"]


def test_compressed_feed(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(gzip.compress(b"H\n1\n2\nT\n"))
    data = split_envelope(read_lines(spark, str(tmp_path)), 1, 1).data
    assert sorted(r.value for r in data.collect()) == ["1", "2"]


@pytest.mark.parametrize("later", ["1024", "4096", "900"])
def test_changed_splits_are_an_error_never_a_wrong_number(spark, small_splits, tmp_path, later):
    _write(tmp_path / "a", [f"{i:06d}" for i in range(3000)])
    lines = read_lines(spark, str(tmp_path))
    blocks = count_blocks(lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", later)
    with pytest.raises(Exception, match="splits changed"):
        with_positions(lines, blocks=blocks).filter("line_no >= 0").agg(F.sum("line_no")).collect()


def test_changed_splits_are_an_error_to_whoever_reads_the_feed_only(spark, small_splits, tmp_path):
    """Lines without a block are not lost to a condition on the feed."""
    _write(tmp_path / "a", [f"{i:06d}" for i in range(3000)])
    lines = read_lines(spark, str(tmp_path))
    blocks = count_blocks(lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    with pytest.raises(Exception, match="splits changed"):
        with_positions(lines, blocks=blocks).filter("feed is not null").groupBy("feed").count().collect()


def test_several_blocks_of_a_task_under_an_inner_join(spark, small_splits, tmp_path):
    """A line is checked against its own block, not against the others of its task."""
    for k in range(12):
        _write(tmp_path / f"f{k}", [f"HDR{k:04d}", *[f"{i:07d}" for i in range(20)], "TRL0022"])
    fields = [{"name": "N", "type": "long", "length": 7}]
    feed = read_fixed(spark, str(tmp_path), fields, 1, 1, [{"name": "K", "start": 4, "length": 4}], [{"name": "CNT", "start": 4, "length": 4}])
    assert read_lines(spark, str(tmp_path)).rdd.getNumPartitions() < 12
    counted = feed.data.groupBy("feed").agg(F.count(F.lit(1)).alias("records"))
    rows = counted.join(feed.header, "feed").join(feed.trailer, "feed").select("K", "CNT", "records").collect()
    assert sorted(r[:] for r in rows) == [(f"{k:04d}", "0022", 20) for k in range(12)]


def test_header_fields_of_short_and_repeated_lines(spark, tmp_path):
    _write(tmp_path / "f", ["HDR20260301", "HDR2026", "body", "TRL0000000004"])
    feed = read_fixed(spark, str(tmp_path), [{"name": "A", "length": 4}], 2, 1,
                      [{"name": "FILE-DATE", "start": 4, "length": 8}],
                      [{"name": "CNT", "start": 4, "length": 10}])
    assert [(r.line_no, r.FILE_DATE) for r in feed.header.orderBy("line_no").collect()] == [
        (0, "20260301"), (1, "")]
    assert last_per_feed(feed.header).first().FILE_DATE == ""
    assert feed.trailer.first().CNT == "0000000004"
    assert [r.A for r in feed.data.collect()] == ["body"]


def test_offset_only_when_starts_lie_past_the_record(spark, tmp_path):
    _write(tmp_path / "f", ["ABCD", "EFGH"])
    data = split_envelope(read_lines(spark, str(tmp_path))).data
    assert absolute_offset(data, Layout.of([{"name": "A", "start": 121, "length": 2}])) == 120
    assert absolute_offset(data, Layout.of([{"name": "A", "start": 3, "length": 2}])) == 0
    assert absolute_offset(data, Layout.of([{"name": "A", "start": 121, "length": 2}], 120)) == 120
    assert absolute_offset(data, Layout.of([{"name": "A", "start": 7, "length": 2}], 120)) == 0
    fields = [{"name": "A", "start": 121, "length": 2}, {"name": "B", "start": 123, "length": 2}]
    feed = read_fixed(spark, str(tmp_path), fields)
    assert sorted((r.A, r.B) for r in feed.data.collect()) == [("AB", "CD"), ("EF", "GH")]


def test_single_feed_keeps_order_of_sections(spark, small_splits, tmp_path):
    df = spark.range(0, 5000, 1, 7).selectExpr("id as ORDER_KEY", "date'2026-03-01' as FILE_DAY")
    path = str(tmp_path / "out")
    write_fixed(df, Layout.of([{"name": "ORDER-KEY", "type": "long", "length": 10}], 20), path,
                2, 1, ORDER_HEADER, ORDER_TRAILER)
    rows = with_positions(read_lines(spark, path), "directory").orderBy("line_no").collect()
    assert len(rows) == 5003
    assert [r.value[:11] for r in rows[:2]] == ["HDR20260301"] * 2
    assert rows[-1].value == "TRL0000005002".ljust(20)
    assert [int(r.value) for r in rows[2:-1]] == list(range(5000))


@pytest.mark.parametrize("key", ["string", "int"])
def test_many_feeds_one_of_them_hot(spark, small_splits, tmp_path, key):
    hot = "case when id % 3 = 0 then id % 50 else 7 end"
    df = spark.range(0, 9000, 1, 8).selectExpr(
        f"cast({hot} as {key}) as k", "id as ORDER_KEY", "date'2026-03-01' as FILE_DAY")
    path = str(tmp_path / "out")
    layout = Layout.of([{"name": "ORDER-KEY", "type": "long", "length": 10}], 20)
    write_feeds(df, "k", layout, path, ORDER_HEADER, ORDER_TRAILER, order_by=["ORDER_KEY"])
    assert len(list((tmp_path / "out" / "k=7").glob("part-*"))) > 2
    rows = with_positions(read_lines(spark, path), "directory").orderBy("feed", "line_no").collect()
    feeds = {}
    for r in rows:
        feeds.setdefault(r.feed.rsplit("=")[-1], []).append(r.value)
    expected = {}
    for r in df.orderBy("ORDER_KEY").collect():
        expected.setdefault(str(r.k), []).append(r.ORDER_KEY)
    assert set(feeds) == set(expected)
    for k, lines in feeds.items():
        assert lines[0] == "HDR20260301".ljust(20)
        assert lines[-1] == f"TRL{len(expected[k]) + 2:010d}".ljust(20)
        assert [int(v) for v in lines[1:-1]] == expected[k]


def test_clean_up_deletes_what_was_stored(spark, monkeypatch):
    monkeypatch.setattr(session, "_handed_out", {})
    kept = session.cut(spark.range(3))
    path = session._handed_out[spark.sparkContext.applicationId][0]
    assert kept.count() == 3 and os.path.isdir(path)
    assert session.clean_up(spark) == 1 and not os.path.exists(path)
    assert session.clean_up(spark) == 0


def test_ends_come_with_the_count(spark, small_splits, tmp_path):
    """Two scans of the text serve data, header and trailer; lines join on one long."""
    for name, n in (("a", 900), ("b", 1)):
        _write(tmp_path / name, [f"{name}:{i:06d}" for i in range(n)])
    nodes = plan_nodes(spark)
    data, header, trailer = split_envelope(read_lines(spark, str(tmp_path)), 3, 2)
    assert {(r.feed, r.line_no) for r in _name(header).collect()} == {("a", 0), ("a", 1), ("a", 2), ("b", 0)}
    assert {(r.value, r.line_no) for r in trailer.collect()} == {("a:000898", 898), ("a:000899", 899), ("b:000000", 0)}
    assert data.count() == 895
    assert text_scans(nodes()) == 2
    assert not any("SortAggregate" in name for name in nodes())
    plan = data._jdf.queryExecution().executedPlan().toString()
    assert "shiftright(scan_id" in plan and "[file_path" not in plan.split("HashJoin")[1].split("BuildRight")[0]
    counted = count_blocks(read_lines(spark, str(tmp_path)), "auto", 3, 2)
    assert counted.agg(F.max(F.size("firsts")), F.max(F.size("lasts"))).first()[:] == (3, 2)
