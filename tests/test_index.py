"""Frames with an index: the same events, fewer bytes read."""

import re

import pytest

from rowtide.operators import filters
from rowtide.plans import changes
from rowtide.sources import index
from suite.base import broken, frames
from tests import wire


def scans(df):
    """Columns and pushed filters of each file scan, filters alone where the columns have one name."""
    session = df.sparkSession
    session.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        session.conf.unset("spark.sql.maxMetadataStringLength")
    found = re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[(.*?)\], ReadSchema", plan)
    return [({c.split("#")[0] for c in columns.split(",")}, pushed) for columns, pushed in found]


@pytest.fixture(scope="module")
def taken_in(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("indexed") / "frames")
    index.write_frames(frames(spark, "/root/testdata/sf0.001").repartition(3), path, row_group_bytes=1 << 16)
    return index.read_indexed(spark, path)


def test_control_pass_reads_no_payload(taken_in):
    (columns, pushed), = scans(changes.control_records(taken_in))
    assert "payload" not in columns and "ix_control" in columns
    assert "ix_described" in pushed and "ix_fatal" in pushed


def test_row_pass_skips_by_relation_and_position(spark, taken_in):
    control = changes.read_control(taken_in)
    decoded = changes.decode_changes(taken_in, control=control, tables=["customer"], start=17_000_000)
    rows = [pushed for columns, pushed in scans(decoded) if "payload" in columns]
    assert rows and all("ix_rel" in p and "ix_position" in p for p in rows)


@pytest.mark.parametrize("options", [{}, {"tables": ["customer"]}, {"start": "0/1036640"}, {"tables": ["unknown"]}, {"images": False}])
def test_events_are_those_of_plain_frames(spark, taken_in, options):
    plain = changes.decode_changes(frames(spark, "/root/testdata/sf0.001"), **options)
    indexed = changes.decode_changes(taken_in, **options)
    columns = [c for c in plain.columns if c not in ("old", "new")]
    rows = lambda df: sorted(map(str, df.selectExpr(*columns, "to_json(old) AS old", "to_json(new) AS new").collect()))
    assert rows(plain) == rows(indexed)


def test_what_is_left_out(spark):
    described = wire.xlog(wire.relation(1, b"s", b"t", [b"a"]), 10), wire.xlog(wire.relation(2, b"s", b"u", [b"a"]), 11)
    rows = [wire.xlog(wire.insert(r, b"1"), p) for r in (1, 2, 3) for p in (20, 30)]
    bad = [wire.xlog(b"I\0\0", 5), wire.xlog(b"B" + bytes(20), 6), wire.alive(7), wire.xlog(b"T\0\0\0\x01\0\0\0\0\x01", 8)]
    given = wire.frames(spark, {"s": [*described, *rows, *bad, b"", rows[0]], "o": [None or b"x"]})
    for taken in (given, index.index_frames(given)):
        got = changes.decode_changes(taken, tables=["s.u"], start="0/19").collect()
        kept = sorted((r["session_id"], r["frame_no"]) for r in got)
        assert kept == [("o", 1), *(("s", n) for n in (1, 2, 6, 9, 10, 11, 12, 13))]


def test_broken_frames_keep_their_errors(spark, small):
    plain = changes.decode_changes(broken(spark, small))
    indexed = changes.decode_changes(index.index_frames(broken(spark, small)))
    rows = lambda df: sorted(map(str, df.select("session_id", "frame_no", "op", "error_class", "error").collect()))
    assert rows(plain) == rows(indexed)
    forwarded = filters.forwardable(indexed, filters.should_forward())
    assert forwarded.filter("error_class IS NOT NULL").isEmpty()
