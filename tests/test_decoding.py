import json

import pytest
from pyspark.sql import functions as F

from rowtide.functions import lsn
from rowtide.operators import filters, outbox
from rowtide.plans import changes
from tests import wire

CRATE = b"\x00\x00\x2f\x1a"
PACKED = b"\x00\x03t\x00\x00\x00\x03805t\x00\x00\x00\x05glasst\x00\x00\x00\x03dry"
MOVED = b"\x00\x03t\x00\x00\x00\x03805t\x00\x00\x00\x04clayt\x00\x00\x00\x03wet"
GOLDEN = {
    "R": b"R" + CRATE + b"depot\x00crate\x00f\x00\x03"
    b"\x01code\x00\x00\x00\x00\x17\xff\xff\xff\xff"
    b"\x00label\x00\x00\x00\x04\x13\x00\x00\x00\x44"
    b"\x00note\x00\x00\x00\x00\x19\xff\xff\xff\xff",
    "B": b"B\x00\x00\x00\x05\x00\xc0\xff\xee" + (812345678000000).to_bytes(8) + (90210).to_bytes(4),
    "C": b"C\x00\x00\x00\x00\x05\x00\xc0\xff\xf2\x00\x00\x00\x05\x00\xc1\x00\x1a" + (812345678000000).to_bytes(8),
    "I": b"I" + CRATE + b"N" + PACKED,
    "U none": b"U" + CRATE + b"N" + MOVED,
    "U full": b"U" + CRATE + b"O" + PACKED + b"N" + MOVED,
    "D": b"D" + CRATE + b"K\x00\x03t\x00\x00\x00\x03805uu",
    "I binary": b"I" + CRATE + b"N\x00\x03t\x00\x00\x00\x03806nb\x00\x00\x00\x03\x0f\xf1\xce",
    "T": b"T\x00\x00\x00\x01\x00" + CRATE,
    "T unknown": b"T\x00\x00\x00\x01\x03\x00\x00\x00\x4d",
    "I unknown": b"I\x00\x00\x00\x4dN\x00\x02t\x00\x00\x00\x016t\x00\x00\x00\x019",
    "O": b"O" + bytes(8) + b"far\x00",
    "bad tag": b"Z",
    "I short": b"I" + CRATE + b"N" + PACKED[:-2],
}
FIRST = {"code": "805", "label": "glass", "note": "dry"}
SECOND = {"code": "805", "label": "clay", "note": "wet"}
ROW = {"rel_id": 12058, "schema": "depot", "table": "crate"}
EXPECTED = {
    "B": {"op": "begin", "lsn": "5/C0FFEE", "commit_time": 812345678000000, "xid": 90210},
    "C": {"op": "commit", "lsn": "5/C0FFF2", "end_lsn": "5/C1001A", "commit_time": 812345678000000},
    "I": {"op": "insert", **ROW, "new": FIRST},
    "U none": {"op": "update", **ROW, "old": None, "new": SECOND},
    "U full": {"op": "update", **ROW, "old": FIRST, "new": SECOND},
    "D": {"op": "delete", **ROW, "old": {"code": "805", "label": "__pgx_unchanged", "note": "__pgx_unchanged"}},
    "I binary": {"op": "insert", **ROW, "new": {"code": "806", "label": None, "note": "\\x0ff1ce"}},
    "T": {"op": "truncate", "rel_ids": [12058], "tables": ["depot.crate"], "cascade": False, "restart_seqs": False},
    "T unknown": {"op": "truncate", "rel_ids": [77], "tables": ["<rel:77>"], "cascade": True, "restart_seqs": True},
    "I unknown": {"op": "insert", "rel_id": 77, "schema": "unknown_77", "table": "unknown", "new": {"?": "9"}},
}


@pytest.fixture(scope="module")
def golden(spark):
    payloads = [wire.xlog(message, 1000 + n) for n, message in enumerate(GOLDEN.values())]
    events = changes.decode_changes(wire.frames(spark, {"s": payloads}))
    return events.cache()


def test_golden_json(golden):
    condition = filters.should_forward(emit_boundaries=True)
    rows = outbox.prepare(filters.forwardable(golden, condition)).collect()
    names = list(GOLDEN)
    got = {names[row["frame_no"] - 1]: json.loads(row["body"]) for row in rows}
    assert got == EXPECTED
    keys = {names[row["frame_no"] - 1]: list(json.loads(row["body"])) for row in rows}
    assert all(keys[name] == list(EXPECTED[name]) for name in EXPECTED)


def test_golden_relation(golden):
    row = golden.filter("op = 'relation'").first()
    assert (row["rel_id"], row["schema"], row["table"]) == (12058, "depot", "crate")
    assert [tuple(c) for c in row["columns"]] == [
        ("code", True, 23, -1),
        ("label", False, 1043, 68),
        ("note", False, 25, -1),
    ]


def test_golden_errors(golden):
    rows = {list(GOLDEN)[r["frame_no"] - 1]: r for r in golden.filter("op IN ('error', 'skipped')").collect()}
    assert set(rows) == {"O", "bad tag", "I short"}
    assert rows["O"]["op"] == "skipped" and rows["O"]["error_class"] is None
    assert rows["bad tag"]["error_class"] == "record" and rows["I short"]["error_class"] == "record"
    assert rows["I short"]["new"] is None


def decode(spark, sessions, **options):
    rows = changes.decode_changes(wire.frames(spark, sessions), **options).collect()
    return {(r["session_id"], r["frame_no"]): r for r in rows}


def values(image):
    return {k: (v["state"], v["value"]) for k, v in image.items()}


def test_relation_by_session_and_time(spark):
    narrow = wire.xlog(wire.relation(7, b"a", b"t", [b"x"]))
    wide = wire.xlog(wire.relation(7, b"b", b"u", [b"y", b"z"]))
    row = wire.xlog(wire.insert(7, b"1", b"2"))
    sessions = {"one": [row, narrow, row, wide, row], "two": [row, wide, row]}
    for options in ({}, {"broadcast_limit": 0, "range_width": 2}):
        got = decode(spark, sessions, **options)
        assert got["one", 1]["schema"] == "unknown_7"
        assert values(got["one", 3]["new"]) == {"x": ("t", "1"), "?": ("t", "2")}
        assert values(got["one", 5]["new"]) == {"y": ("t", "1"), "z": ("t", "2")}
        assert got["one", 5]["table"] == "u" and got["one", 3]["table"] == "t"
        assert got["two", 1]["table"] == "unknown" and got["two", 3]["schema"] == "b"
        assert len(got) == 8


def test_repeated_descriptions_across_ranges(spark):
    from rowtide.operators.relations import validity

    df = spark.range(0, 50).selectExpr("'s' AS session_id", "1L AS rel_id", "id * 3 AS frame_no")
    plain = {tuple(r) for r in validity(df, ["session_id", "rel_id"], rows=50).collect()}
    ranged = {tuple(r) for r in validity(df, ["session_id", "rel_id"], rows=50, width=16).collect()}
    assert plain == ranged and len(plain) == 50


def test_ranges_get_few_copies_of_descriptions(spark, monkeypatch):
    from rowtide.operators import relations as rel

    monkeypatch.setattr(rel, "RANGES_PER_BLOCK", 8)
    width, far = 1 << 20, 1 << 40  # frame numbers are log positions
    starts = [0, 5, width * 3, far, far + 7, far * 3]
    begun = spark.createDataFrame([("s", 1, f * k + 1) for k in (1, 1000) for f in starts] + [("s", 2, 9)], "session_id string, rel_id long, frame_no long")
    described = rel.validity(begun.distinct(), ["session_id", "rel_id"], rows=99).withColumnRenamed("frame_no", "valid_from")
    frame_nos = sorted({f * k + d for k in (1, 1000) for f in starts for d in (0, 1, 2, width, 40 * width)})
    rows = spark.createDataFrame([("s", r, f) for r in (1, 2, 3) for f in frame_nos], "session_id string, rel_id long, frame_no long")
    keys = ["session_id", "rel_id"]
    touched = rows.select(*keys, rel._range_of(F.col("frame_no"), width).alias("_range")).distinct()
    copies = rel.by_range(touched, described, keys, width)
    assert copies.count() <= touched.count() + described.count()
    assert copies.groupBy(*keys, "_range", "valid_from").count().filter("count > 1").isEmpty()
    named = described.withColumn("name", F.col("valid_from").cast("string"))
    for how in ("left", "left_anti"):
        plain = rel.interval_join(rows, named, keys, how, size_bytes=0)
        ranged = rel.interval_join(rows, named, keys, how, size_bytes=1, limit=0, width=width)
        assert plain.columns == ranged.columns
        assert sorted(map(str, plain.collect())) == sorted(map(str, ranged.collect()))


def test_column_states_stay_apart(spark):
    described = wire.xlog(wire.relation(1, b"s", b"t", [b"a", b"b", b"c", b"d", b"e"]))
    row = wire.xlog(wire.insert(1, b"NULL", b"__pgx_unchanged", None, ..., b"A\xffB"))
    got = decode(spark, {"s": [described, row]})["s", 2]
    assert values(got["new"]) == {
        "a": ("t", "NULL"),
        "b": ("t", "__pgx_unchanged"),
        "c": ("n", None),
        "d": ("u", None),
        "e": ("t", "A�B"),
    }


def test_odd_messages(spark):
    described = wire.xlog(wire.relation(1, b"s", b"\xff", [b"\xfe", b"n"]))
    update = b"U\0\0\0\x01"
    payloads = [
        described,
        wire.xlog(wire.insert(1)),  # no columns
        wire.xlog(update + b"X" + wire.image(b"1")),  # unknown update flag
        wire.xlog(wire.insert(1, b"1") + b"rest"),  # bytes after the image
        wire.xlog(update + b"K" + wire.image(b"1")),  # second image missing
        wire.xlog(b""),  # empty message
        wire.xlog(b"I\0\0"),  # header cut short
        wire.xlog(b"I\0\0\0\x01N\0\x01q"),  # unknown cell kind
        wire.xlog(b"T\0\0\0\x05\0\0\0"),  # list cut short
        wire.xlog(b"T\0\0\0\0\x02"),  # empty list
        wire.xlog(b"R\0\0\0\x01abc"),  # name without end
        wire.xlog(wire.insert(1, b"1", b"2")),
        wire.xlog(b"I\0\0\0\x01N\0\x01t\xff\xff\xff\xff"),  # huge length
    ]
    got = decode(spark, {"s": payloads})
    by_number = {n: r for (_, n), r in got.items()}
    assert by_number[2]["new"] == {} and by_number[2]["op"] == "insert"
    assert {n for n, r in by_number.items() if r["error_class"] == "record"} == {3, 5, 6, 7, 8, 9, 11, 13}
    assert values(by_number[4]["new"]) == {"": ("t", "1")}
    assert by_number[10]["rel_ids"] == [] and by_number[10]["tables"] == [] and by_number[10]["restart_seqs"]
    # A description that cannot be read leaves the one before it in force.
    assert values(by_number[12]["new"]) == {"": ("t", "1"), "n": ("t", "2")}
    assert by_number[12]["table"] == ""


def test_wide_image(spark):
    names = [f"c{i}".encode() for i in range(150)]
    cells = [str(i).encode() for i in range(150)]
    payloads = [
        wire.xlog(wire.relation(1, b"s", b"t", names)),
        wire.xlog(wire.insert(1, *cells)),
        wire.xlog(wire.insert(1, *cells)[:-1]),
    ]
    got = decode(spark, {"s": payloads})
    assert {k: v["value"] for k, v in got["s", 2]["new"].items()} == {f"c{i}": str(i) for i in range(150)}
    assert got["s", 3]["error_class"] == "record"


@pytest.mark.parametrize(
    "bad", [b"", b"x123", b"w" + bytes(23), b"k" + bytes(16), wire.xlog(b"B\0\0"), wire.xlog(b"C" + bytes(24))]
)
def test_fatal_frame_ends_its_session(spark, bad):
    good = wire.xlog(wire.insert(1, b"1"))
    for options in ({}, {"broadcast_limit": 0, "range_width": 2}):
        got = decode(spark, {"s": [good, bad, good, wire.xlog(wire.relation(1, b"s", b"t", []))], "o": [good, good]}, **options)
        assert set(got) == {("s", 1), ("s", 2), ("o", 1), ("o", 2)}
        assert got["s", 2]["error_class"] == "fatal"


def test_envelope(spark):
    got = decode(spark, {"s": [wire.alive(2**64 - 1, 0), wire.xlog(b"O", 7)]})
    assert int(got["s", 1]["wal_end"]) == 2**64 - 1 and got["s", 1]["reply_requested"] is False
    assert got["s", 1]["op"] == "keepalive"
    assert got["s", 2]["server_time"].isoformat() == "2024-01-27T02:40:00"


def test_log_positions(spark):
    texts = ["FFFFFFFF/FFFFFFFF", "0/0", "16/b374d848", "abc", "1/xyz", "+1/+A", "1/2/3", "/1", None, "00000000001/1"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    parsed = [r[0] if r[0] is None else int(r[0]) for r in df.select(lsn.parse_lsn(F.col("t"), strict=False)).collect()]
    assert parsed == [2**64 - 1, 0, 0x16B374D848, None, None, 2**32 + 10, None, None, None, 2**32 + 1]
    good = df.filter("t IN ('FFFFFFFF/FFFFFFFF', '0/0', '16/b374d848')")
    shown = [r[0] for r in good.select(lsn.lsn_text(lsn.parse_lsn(F.col("t")))).collect()]
    assert shown == ["FFFFFFFF/FFFFFFFF", "0/0", "16/B374D848"]
    with pytest.raises(Exception, match="invalid log position"):
        df.filter("t = 'abc'").select(lsn.parse_lsn(F.col("t"))).collect()
    assert lsn.parse_position("16/b374d848") == 0x16B374D848
    with pytest.raises(ValueError):
        lsn.parse_position("abc")


def test_filters_move_below_decoding(spark, small):
    from suite.base import frames as stored

    events = changes.decode_changes(stored(spark, small))
    plan = events.filter("`table` = 'orders' AND op = 'insert'")._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    where = next(i for i, line in enumerate(lines) if "Filter" in line and "orders" in line)
    reads = [i for i, line in enumerate(lines) if "_read(payload" in line]
    assert reads and max(reads) < where
    # Images are read once, not once per use.
    assert len(reads) == 1


def brute_image(data, at, end):
    """Cells of the image at a place and where it ends, read one by one; None if malformed."""
    if at + 2 > end:
        return None
    count, at, cells = int.from_bytes(data[at : at + 2]), at + 2, []
    for _ in range(count):
        kind = data[at : at + 1] if at < end else b""
        if kind in (b"n", b"u"):
            cells.append((kind.decode(), None))
            at += 1
        elif kind in (b"t", b"b") and at + 5 <= end:
            size = int.from_bytes(data[at + 1 : at + 5])
            if at + 5 + size > end:
                return None
            value = data[at + 5 : at + 5 + size]
            cells.append(("t", "\\x" + value.hex() if kind == b"b" else value.decode("utf-8", "replace")))
            at += 5 + size
        else:
            return None
    return cells, at


def brute_message(payload, images):
    if not images:
        return False, None, None
    first = brute_image(payload, 31, len(payload))
    second = brute_image(payload, first[1] + 1, len(payload)) if first and images > 1 else None
    if first is None or (images > 1 and second is None):
        return True, None, None
    return False, first[0], second[0] if second else None


def random_image(rng):
    cells = []
    for _ in range(rng.choice([0, 1, 3, 9, 40])):
        kind = rng.choice(b"ttttbnuq" if rng.random() < 0.05 else b"ttttbnu")
        text = rng.choice(["", "plain", "é中𝕏", "x" * 300]).encode()
        if rng.random() < 0.1:
            text = rng.randbytes(rng.randrange(12))
        size = len(text) if rng.random() > 0.01 else rng.choice([0, 2**32 - 1, 1 << 20])
        cells.append(bytes([kind]) + (size.to_bytes(4) + text if kind in b"tb" else b""))
    return (len(cells) if rng.random() > 0.02 else 65535).to_bytes(2) + b"".join(cells)


def test_image_batches_cell_by_cell():
    import random

    import pyarrow as pa

    from rowtide.operators import images

    rng = random.Random(11)
    payloads, counts = [], []
    for _ in range(3000):
        n = rng.randrange(3)
        body = b"N".join(random_image(rng) for _ in range(max(n, 1)))
        payload = bytes(31) + body
        if rng.random() < 0.15:
            payload = payload[: rng.randrange(len(payload) + 1)]
        payloads.append(payload if rng.random() > 0.01 else None)
        counts.append(n if rng.random() > 0.05 else None)
    want = [brute_message(p or b"", n or 0) for p, n in zip(payloads, counts)]
    assert any(w[0] for w in want) and any(w[2] for w in want)
    cell = lambda image: None if image is None else [(c["state"], c["value"]) for c in image]
    for kind in (pa.binary(), pa.large_binary()):
        whole = pa.array([b"skipped", *payloads], kind)
        for part, expected in ((slice(0, 3000), want), (slice(700, 900), want[700:900]), (slice(5, 5), [])):
            given = whole.slice(part.start + 1, part.stop - part.start)
            images_of = pa.array(counts[part], pa.int32())
            got = [(r["malformed"], cell(r["first"]), cell(r["second"])) for r in images._read(given, images_of).to_pylist()]
            assert got == expected
            assert images._malformed(given, images_of).to_pylist() == [w[0] for w in expected]


def test_invalid_text_is_replaced_as_in_sql(spark):
    import random

    rng = random.Random(4)
    pieces = [b"a", "é".encode(), "中".encode(), "𝕏".encode(), b"\xff", b"\xc3", b"\xe4\xb8", b"\xf0\x9d", b"\xed\xa0\x80", b"\xc0\x80", b"\xf5"]
    texts = [b"".join(rng.choice(pieces) for _ in range(rng.randrange(9))) for _ in range(2000)]
    df = spark.createDataFrame([(bytearray(t),) for t in texts], "t binary")
    replaced = [r[0] for r in df.selectExpr("make_valid_utf8(cast(t AS string))").collect()]
    assert replaced == [t.decode("utf-8", "replace") for t in texts]


def test_check_without_images_agrees(spark, small):
    from suite.base import frames as stored

    events = changes.decode_changes(stored(spark, small))
    checked = changes.decode_changes(stored(spark, small), images=False)
    keys = ["session_id", "frame_no", "op", "error_class", "error"]
    assert sorted(map(str, events.select(keys).collect())) == sorted(map(str, checked.select(keys).collect()))
