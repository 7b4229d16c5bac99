"""Notifications addressed to one destination, in simple or contract mode.

Simple mode never looks into the payload. Contract mode lets a valid contract
choose the destination and falls back to simple behaviour for anything else.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide import constants as c
from rowtide.operators.contract import parse_contracts
from rowtide.operators.outbox import empty_map, overlay, text_map, web_headers

NOTIFY_OUTBOX_COLUMNS = ["sink", "destination", "routing_key", "msg_key", "headers", "body", "env", "frame_no", "channel"]
MODES = ("simple", "contract")
_TEXT_MAP = "map<string,string>"


def envelope() -> Column:
    """The message wrapped with its channel and sender; the payload stays one JSON string."""
    return F.to_json(F.struct("channel", "payload", "pid"))


def _is_contract() -> Column:
    return F.col("contract").isNotNull()


def _from_contract(value: Column, otherwise: Column) -> Column:
    return F.when(_is_contract(), value).otherwise(otherwise)


def _body() -> Column:
    return _from_contract(F.col("contract.data"), envelope())


def open_mode(notify: DataFrame, mode: str) -> DataFrame:
    """Parse payloads in contract mode only."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "contract":
        return parse_contracts(notify)
    return notify


def _outbox(opened: DataFrame, sink: str, **columns: Column) -> DataFrame:
    empty = {
        "destination": "string",
        "routing_key": "string",
        "msg_key": "string",
        "headers": _TEXT_MAP,
        "body": "string",
        "env": _TEXT_MAP,
    }
    made = {"sink": F.lit(sink), **{k: F.lit(None).cast(t) for k, t in empty.items()}, **columns}
    return opened.select(*[made[name].alias(name) if name in made else name for name in NOTIFY_OUTBOX_COLUMNS])


def _present(name: str, value: Column) -> Column:
    """One-entry map, empty when the value is NULL."""
    return F.when(value.isNotNull(), F.create_map(F.lit(name), value)).otherwise(empty_map())


def to_rabbitmq(
    notify: DataFrame,
    mode: str = "simple",
    exchange: str = c.DEFAULT_EXCHANGE,
    routing_key: str = c.DEFAULT_NOTIFY_ROUTING_KEY,
) -> DataFrame:
    opened = open_mode(notify, mode)
    if mode == "simple":
        return _outbox(
            opened,
            "rabbitmq",
            destination=F.lit(exchange),
            routing_key=F.lit(routing_key),
            headers=empty_map(),
            body=envelope(),
        )
    headers = overlay(
        F.col("contract.rabbitmq_headers"),
        _present(c.HEADER_EVENT_TYPE, F.col("contract.event_type")),
        F.create_map(F.lit(c.HEADER_CHANNEL), F.col("channel")),
        F.create_map(F.lit(c.HEADER_SCHEMA_VERSION), F.col("contract.schema_version")),
    )
    return _outbox(
        opened,
        "rabbitmq",
        destination=F.coalesce("contract.rabbitmq_exchange", F.lit(exchange)),
        routing_key=F.coalesce("contract.rabbitmq_routing_key", F.lit(routing_key)),
        headers=_from_contract(headers, empty_map()),
        body=_body(),
    )


def _header_list(entries: Column) -> Column:
    return entries.cast("array<struct<key:string,value:binary>>")


def to_kafka(notify: DataFrame, mode: str = "simple", topic: str = c.DEFAULT_NOTIFY_TOPIC) -> DataFrame:
    """Headers are a list: the event type is appended even when it repeats a name."""
    opened = open_mode(notify, mode)
    none = _header_list(F.array())
    if mode == "simple":
        return _outbox(opened, "kafka", destination=F.lit(topic), headers=none, body=envelope())
    event_type = F.col("contract.event_type")
    appended = F.when(
        event_type.isNotNull(),
        F.array(F.struct(F.lit(c.HEADER_EVENT_TYPE).alias("key"), event_type.alias("value"))),
    ).otherwise(F.array().cast("array<struct<key:string,value:string>>"))
    headers = F.concat(F.map_entries("contract.kafka_headers"), appended)
    return _outbox(
        opened,
        "kafka",
        destination=F.coalesce("contract.kafka_topic", F.lit(topic)),
        msg_key=F.col("contract.kafka_key"),
        headers=_from_contract(_header_list(headers), none),
        body=_body(),
    )


def to_webhook(
    notify: DataFrame, url: str, mode: str = "simple", headers: Mapping[str, str] | None = None
) -> DataFrame:
    """Default headers apply in contract mode only."""
    opened = open_mode(notify, mode)
    if mode == "simple":
        return _outbox(opened, "webhook", destination=F.lit(url), headers=empty_map(), body=envelope())
    defaults = text_map(headers)
    merged = overlay(defaults, F.coalesce(F.col("contract.webhook_headers"), empty_map()))
    return _outbox(
        opened,
        "webhook",
        destination=F.coalesce("contract.webhook_url", F.lit(url)),
        headers=web_headers(merged),
        body=_body(),
    )


def to_shell(
    notify: DataFrame, command: str, mode: str = "simple", base_env: Mapping[str, str] | None = None
) -> DataFrame:
    """Environment of a command; later entries win.

    base, then channel and sender, then for a contract its event type, its
    schema version and its own variables, and last the payload: the data of a
    contract, or the raw payload.
    """
    opened = open_mode(notify, mode)
    sender = F.create_map(
        F.lit(c.ATTR_CHANNEL), F.col("channel"), F.lit(c.ATTR_PID), F.col("pid").cast("string")
    )
    first = [text_map(base_env), sender]
    if mode == "simple":
        payload = F.create_map(F.lit(c.ATTR_PAYLOAD), F.col("payload"))
        return _outbox(opened, "shell", destination=F.lit(command), env=overlay(*first, payload))
    payload = F.create_map(
        F.lit(c.ATTR_PAYLOAD), _from_contract(F.col("contract.data"), F.col("payload"))
    )
    own = overlay(
        _present(c.ATTR_EVENT_TYPE, F.col("contract.event_type")),
        _present(c.ATTR_SCHEMA_VERSION, F.col("contract.schema_version")),
        F.coalesce(F.col("contract.shell_env"), empty_map()),
    )
    return _outbox(opened, "shell", destination=F.lit(command), env=overlay(*first, own, payload))


ROUTES = {"rabbitmq": to_rabbitmq, "kafka": to_kafka, "webhook": to_webhook, "shell": to_shell}
