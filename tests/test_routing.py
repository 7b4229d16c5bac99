import json

import pytest
from pyspark.sql import functions as F

from rowtide.operators import contract, filters, outbox, routing
from rowtide.plans import changes
from rowtide.sources.notify import subscribe
from tests import wire

SAMPLE = """{ "data": { "crate": 1805, "seals": ["k", "m"], "kg": 12.5 }, "meta": { "event_type": "sealed",
  "schema_version": "3", "routing": { "rabbitmq_headers": { "x-shelf": "B7", "x-shift": "night" },
  "rabbitmq_routing_key": "crate.sealed", "rabbitmq_exchange": "depot" } } }"""
VALID = {
    "sample": SAMPLE,
    "null data": '{"meta":{"routing":{}},"data":null}',
    "null event type": '{"meta":{"routing":{},"event_type":null},"data":1}',
    "unknown fields": '{"x":1,"meta":{"y":[],"routing":{"z":{}}},"data":[1]}',
    "null text": '{"meta":{"routing":{"kafka_topic":null}},"data":"t"}',
    "repeated data key": '{"meta":{"routing":{}},"data":{"a":1,"a":2}}',
    "blanks": ' \n{"meta":{"routing":{}},"data":1}\t ',
}
INVALID = {
    "no data": '{"meta":{"routing":{}}}',
    "no meta": '{"data":1}',
    "no routing": '{"meta":{},"data":1}',
    "null routing": '{"meta":{"routing":null},"data":1}',
    "routing list": '{"meta":{"routing":[]},"data":1}',
    "null version": '{"meta":{"routing":{},"schema_version":null},"data":1}',
    "number version": '{"meta":{"routing":{},"schema_version":1},"data":1}',
    "number event type": '{"meta":{"routing":{},"event_type":1},"data":1}',
    "null headers": '{"meta":{"routing":{"shell_env":null}},"data":1}',
    "number header": '{"meta":{"routing":{"kafka_headers":{"h":1}}},"data":1}',
    "null header": '{"meta":{"routing":{"kafka_headers":{"h":null}}},"data":1}',
    "number topic": '{"meta":{"routing":{"kafka_topic":1}},"data":1}',
    "trailing text": '{"meta":{"routing":{}},"data":1} x',
    "trailing bracket": '{"meta":{"routing":{}},"data":1}]',
    "two values": '{"meta":{"routing":{}},"data":1},{"a":1}',
    "not json": "plain",
    "empty": "",
    "list": "[1]",
}


def notify(spark, payloads, channel="orders"):
    rows = [(n, channel, 5, p) for n, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "frame_no BIGINT, channel STRING, pid INT, payload STRING")


def test_contract_check(spark):
    cases = {**VALID, **INVALID}
    rows = contract.parse_contracts(notify(spark, cases.values())).orderBy("frame_no").collect()
    got = {name: row["is_contract"] for name, row in zip(cases, rows)}
    assert got == {name: name in VALID for name in cases}
    by_name = dict(zip(cases, rows))
    assert by_name["null data"]["contract"]["data"] == "null"
    assert json.loads(by_name["repeated data key"]["contract"]["data"]) == {"a": 2}
    assert by_name["null event type"]["contract"]["event_type"] is None
    assert by_name["null event type"]["contract"]["schema_version"] == "1"


def one(df):
    return df.collect()[0]


def test_rabbitmq_contract(spark):
    row = one(routing.to_rabbitmq(notify(spark, [SAMPLE]), "contract", "ex", "key"))
    assert (row["destination"], row["routing_key"]) == ("depot", "crate.sealed")
    assert row["headers"] == {
        "x-shelf": "B7",
        "x-shift": "night",
        "x-event-type": "sealed",
        "x-pg-channel": "orders",
        "x-schema-version": "3",
    }
    assert json.loads(row["body"]) == {"crate": 1805, "seals": ["k", "m"], "kg": 12.5}


def test_simple_mode_never_opens(spark):
    row = one(routing.to_rabbitmq(notify(spark, [SAMPLE]), "simple", "ex", "key"))
    assert (row["destination"], row["routing_key"], row["headers"]) == ("ex", "key", {})
    assert json.loads(row["body"]) == {"channel": "orders", "payload": SAMPLE, "pid": 5}


def test_kafka_headers_may_repeat(spark):
    payload = '{"meta":{"routing":{"kafka_headers":{"x-event-type":"own"}},"event_type":"e"},"data":1}'
    row = one(routing.to_kafka(notify(spark, [payload]), "contract"))
    assert [(h["key"], bytes(h["value"]).decode()) for h in row["headers"]] == [("x-event-type", "own"), ("x-event-type", "e")]
    assert row["msg_key"] is None and row["destination"] == "pgx-notify"


def test_webhook_headers(spark):
    payload = '{"meta":{"routing":{"webhook_url":"http://own","webhook_headers":{"authorization":"mine","bad name":"x"}}},"data":1}'
    defaults = {"Authorization": "base", "X-A": "1"}
    opened = one(routing.to_webhook(notify(spark, [payload]), "http://d", "contract", defaults))
    assert opened["destination"] == "http://own" and opened["headers"] == {"authorization": "mine", "x-a": "1"}
    plain = one(routing.to_webhook(notify(spark, ["x"]), "http://d", "contract", defaults))
    assert plain["headers"] == {"authorization": "base", "x-a": "1"} and plain["destination"] == "http://d"
    assert one(routing.to_webhook(notify(spark, [payload]), "http://d", "simple", defaults))["headers"] == {}


def test_shell_env_order(spark):
    payload = '{"meta":{"routing":{"shell_env":{"PGX_CHANNEL":"own","PGX_PAYLOAD":"own"}}},"data":{"a":1}}'
    env = one(routing.to_shell(notify(spark, [payload]), "run", "contract", {"PGX_PID": "base", "A": "1"}))["env"]
    assert env == {"A": "1", "PGX_CHANNEL": "own", "PGX_PID": "5", "PGX_SCHEMA_VERSION": "1", "PGX_PAYLOAD": '{"a":1}'}
    raw = one(routing.to_shell(notify(spark, ["raw"]), "run", "contract"))["env"]
    assert raw == {"PGX_CHANNEL": "orders", "PGX_PID": "5", "PGX_PAYLOAD": "raw"}


def test_subscription(spark):
    df = notify(spark, ["a"], "Orders").unionByName(notify(spark, ["b"], "orders"))
    assert [r["payload"] for r in subscribe(df, ["orders"]).collect()] == ["b"]
    with pytest.raises(ValueError):
        subscribe(df, [])


def test_payload_parsed_once(spark):
    plan = routing.to_rabbitmq(notify(spark, [SAMPLE]), "contract").filter("headers['x-shelf'] = 'B7'")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.lower().count("parsejson") <= 2 and text.count("xxhash64(payload") <= 3


def test_kafka_key_is_bare_table(spark):
    frames = wire.frames(spark, {"s": [wire.xlog(wire.relation(1, b"sch", b"tab", [b"a"])), wire.xlog(wire.insert(1, b"1")), wire.xlog(b"T\0\0\0\x01\0\0\0\0\x01")]})
    events = filters.forwardable(changes.decode_changes(frames), filters.should_forward())
    keys = {r["frame_no"]: r["msg_key"] for r in outbox.to_kafka(events).collect()}
    assert keys == {2: "tab", 3: "pgx-wal"}
    qualified = {r["frame_no"]: r["msg_key"] for r in outbox.to_kafka(events, key_mode="qualified").collect()}
    assert qualified == {2: "sch.tab", 3: "pgx-wal"}
    assert outbox.kafka_rows(outbox.to_kafka(events)).columns == ["topic", "key", "value"]
    assert "headers" in outbox.kafka_rows(routing.to_kafka(notify(spark, ["x"]))).columns


def test_publications(spark):
    messages = [
        wire.relation(1, b"a", b"t", [b"x"]),
        wire.insert(1, b"1"),
        wire.insert(2, b"1"),
        wire.relation(3, b"a", b"u", [b"x"]),
        b"T\0\0\0\x03\0\0\0\0\x03\0\0\0\x01\0\0\0\x02",  # a.u, a.t and an unknown one
        b"T\0\0\0\x01\0\0\0\0\x03",  # a.u alone
        b"T\0\0",
    ]
    events = changes.decode_changes(wire.frames(spark, {"s": [wire.xlog(m) for m in messages]}))
    schema = "publication STRING, schema STRING, table STRING, all_tables BOOLEAN"
    members = spark.createDataFrame([("p", "a", "t", False), ("q", None, None, True)], schema)
    kept = {r["frame_no"]: r for r in filters.in_publications(events, members, ["p"]).collect()}
    assert set(kept) == {1, 2, 5, 7}
    assert (kept[5]["rel_ids"], kept[5]["tables"], kept[7]["op"]) == ([1], ["a.t"], "error")
    assert filters.in_publications(events, members, ["p", "q"]).filter("op = 'insert'").count() == 2


def test_unknown_arguments():
    with pytest.raises(ValueError):
        filters.op_matches(["merge"])
    with pytest.raises(ValueError):
        routing.open_mode(None, "other")


def test_pretty_json(spark):
    frames = wire.frames(spark, {"s": [wire.xlog(wire.insert(2, b"1"))]})
    body = one(outbox.to_stdout(changes.decode_changes(frames), pretty=True))["body"]
    assert "\n" in body and json.loads(body)["new"] == {"?": "1"}
    assert F.col is not None
