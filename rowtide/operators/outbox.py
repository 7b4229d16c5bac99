"""Change events addressed to one destination.

Every sink gives the same columns, so one table or topic writer serves all.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide import constants as c
from rowtide.operators import events as ev

OUTBOX_COLUMNS = [
    "sink",
    "destination",
    "routing_key",
    "msg_key",
    "headers",
    "body",
    "env",
    "session_id",
    "frame_no",
    "position",
]
_TEXT_MAP = "map<string,string>"

# Characters allowed in the name and the value of a web header.
_HEADER_NAME = r"^[A-Za-z0-9!#$%&'*+\-.^_`|~]+\z"
_HEADER_VALUE = r"^[\t\x20-\x7E]*\z"


def text_map(values: Mapping[str, str] | None) -> Column:
    pairs = [F.lit(x) for kv in (values or {}).items() for x in kv]
    return F.create_map(*pairs).cast(_TEXT_MAP) if pairs else empty_map()


def empty_map() -> Column:
    return F.create_map().cast(_TEXT_MAP)


def overlay(*maps: Column) -> Column:
    """Entries of all maps; the last map to name a key wins."""
    return F.map_concat(*maps)


def web_headers(headers: Column) -> Column:
    """Lower-cased names; pairs a web client would refuse are dropped."""
    usable = F.map_filter(headers, lambda k, v: k.rlike(_HEADER_NAME) & v.rlike(_HEADER_VALUE))
    return F.transform_keys(usable, lambda k, _v: F.lower(k))


def kafka_headers(headers: Column) -> Column:
    """Header list in the shape the Kafka writer takes."""
    return F.transform(
        F.map_entries(headers),
        lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")),
    )


def _message_headers() -> Column:
    wanted = [c.ATTR_OP, c.ATTR_SCHEMA, c.ATTR_TABLE, c.ATTR_LSN]
    chosen = F.map_filter(F.col("attributes"), lambda k, _v: k.isin(*wanted))
    return F.transform_keys(chosen, lambda k, _v: F.translate(F.lower(k), "_", "-"))


def _outbox(prepared: DataFrame, sink: str, destination: str | None, **columns: Column) -> DataFrame:
    empty = {"routing_key": "string", "msg_key": "string", "headers": _TEXT_MAP, "env": _TEXT_MAP}
    made = {
        "sink": F.lit(sink),
        "destination": F.lit(destination).cast("string"),
        **{name: F.lit(None).cast(kind) for name, kind in empty.items()},
        **columns,
    }
    return prepared.select(*[made[name].alias(name) if name in made else name for name in OUTBOX_COLUMNS])


def prepare(events: DataFrame, pretty: bool = False) -> DataFrame:
    """Add ``body`` and ``attributes``; only events with a body stay."""
    printable = ev.with_texts(events.filter(F.col("op").isin(*ev.EVENT_FIELDS)))
    return printable.select(
        "session_id",
        "frame_no",
        "position",
        "op",
        "schema",
        "table",
        ev.event_json(pretty).alias("body"),
        ev.attributes().alias("attributes"),
    )


def to_stdout(events: DataFrame, pretty: bool = False) -> DataFrame:
    return _outbox(prepare(events, pretty), "stdout", None)


def to_shell(events: DataFrame, command: str, base_env: Mapping[str, str] | None = None) -> DataFrame:
    """Environment of a command: base < event attributes < payload."""
    payload = F.create_map(F.lit(c.ATTR_PAYLOAD), F.col("body"))
    env = overlay(text_map(base_env), F.col("attributes"), payload)
    return _outbox(prepare(events), "shell", command, env=env)


def to_webhook(events: DataFrame, url: str, headers: Mapping[str, str] | None = None) -> DataFrame:
    content_type = text_map({c.HEADER_CONTENT_TYPE: c.JSON_CONTENT_TYPE})
    return _outbox(
        prepare(events), "webhook", url, headers=overlay(content_type, web_headers(text_map(headers)))
    )


def to_rabbitmq(
    events: DataFrame,
    exchange: str = c.DEFAULT_EXCHANGE,
    routing_key: str = c.DEFAULT_CHANGE_ROUTING_KEY,
) -> DataFrame:
    return _outbox(
        prepare(events), "rabbitmq", exchange, routing_key=F.lit(routing_key), headers=_message_headers()
    )


def to_kafka(events: DataFrame, topic: str = c.DEFAULT_CHANGE_TOPIC, key_mode: str = "table") -> DataFrame:
    """Keyed by the bare table name, or ``schema.table`` with ``key_mode='qualified'``."""
    if key_mode not in ("table", "qualified"):
        raise ValueError(f"unknown key mode {key_mode!r}")
    is_row = F.col("op").isin(*c.DML)
    name = F.col("table") if key_mode == "table" else F.concat_ws(".", "schema", "table")
    key = F.coalesce(F.when(is_row, name), F.lit(c.DEFAULT_CHANGE_KEY))
    return _outbox(prepare(events), "kafka", topic, msg_key=key)


SINKS = {
    "stdout": to_stdout,
    "shell": to_shell,
    "webhook": to_webhook,
    "rabbitmq": to_rabbitmq,
    "kafka": to_kafka,
}


def kafka_rows(outbox: DataFrame) -> DataFrame:
    """Rows as Spark's Kafka writer takes them."""
    headers = outbox.schema["headers"].dataType
    columns = ["destination AS topic", "msg_key AS key", "body AS value"]
    if headers.typeName() == "array":
        columns.append("headers")
    return outbox.selectExpr(*columns)


def write_lines(outbox: DataFrame, path: str) -> None:
    """One event per line; replaces what a run before has written."""
    outbox.select(F.col("body").alias("value")).write.mode("overwrite").text(path)
