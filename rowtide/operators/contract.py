"""The routing contract a notification payload may carry.

The check is strict and typed: a payload that misses a required part or has a
value of another JSON type is not a contract at all. The payload is parsed
once; every field is then read from the parsed value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from rowtide.constants import DEFAULT_SCHEMA_VERSION
from rowtide.functions.plan import settle

TEXT_FIELDS = [
    "rabbitmq_exchange",
    "rabbitmq_routing_key",
    "kafka_topic",
    "kafka_key",
    "webhook_url",
]
MAP_FIELDS = ["rabbitmq_headers", "kafka_headers", "webhook_headers", "shell_env"]

# The parser stops at the end of the first JSON value. Parsing the payload as
# the first item of a list that ends with the payload's own hash shows whether
# anything follows it.
_WRAPPED = """try_parse_json(concat('[', payload, ',"', xxhash64(payload), '"]'))"""
_IS_WHOLE = "try_variant_get(_parsed, '$[1]', 'string') = cast(xxhash64(payload) AS string)"
_MISSING = "cast(NULL AS variant)"


def _field(value: str, name: str) -> str:
    return f"try_variant_get({value}, '$.{name}', 'variant')"


def _is_text(value: str) -> str:
    return f"coalesce(schema_of_variant({value}) = 'STRING', false)"


def _text_or_nothing(value: str) -> str:
    """Absent, null or text."""
    return f"({value} IS NULL OR is_variant_null({value}) OR {_is_text(value)})"


def _text(value: str) -> str:
    return f"if({_is_text(value)}, try_variant_get({value}, '$', 'string'), NULL)"


def parse_contracts(notify: DataFrame) -> DataFrame:
    """Add ``is_contract`` and the struct ``contract`` (NULL unless valid).

    ``contract`` holds ``schema_version``, ``event_type``, ``data`` (JSON
    text), the optional routing texts and the four header maps.
    """
    kept = notify.columns
    parsed = settle(notify.selectExpr("*", f"{_WRAPPED} AS _parsed"), "_parsed")
    parts = parsed.selectExpr(
        *kept,
        f"if({_IS_WHOLE}, try_variant_get(_parsed, '$[0].meta', 'variant'), {_MISSING}) AS _meta",
        f"if({_IS_WHOLE}, try_variant_get(_parsed, '$[0].data', 'variant'), {_MISSING}) AS _data",
    )
    opened = parts.selectExpr(
        *kept,
        "_data",
        "try_variant_get(_meta, '$.routing', 'map<string,variant>') AS _routing",
        f"{_field('_meta', 'schema_version')} AS _version",
        f"{_field('_meta', 'event_type')} AS _event_type",
    )
    fields = opened.selectExpr(
        *kept,
        "_data",
        "_version",
        "_event_type",
        "_routing IS NOT NULL AS _has_routing",
        *[f"_routing['{name}'] AS _{name}" for name in TEXT_FIELDS],
        *[f"_routing['{name}'] AS _raw_{name}" for name in MAP_FIELDS],
    )
    mapped = fields.selectExpr(
        "*", *[f"try_variant_get(_raw_{name}, '$', 'map<string,variant>') AS _{name}" for name in MAP_FIELDS]
    )
    map_checks = [
        f"""(_raw_{name} IS NULL OR (_{name} IS NOT NULL AND
             forall(map_values(_{name}), v -> coalesce(schema_of_variant(v) = 'STRING', false))))"""
        for name in MAP_FIELDS
    ]
    checks = [
        "_has_routing",
        "_data IS NOT NULL",
        f"(_version IS NULL OR {_is_text('_version')})",
        _text_or_nothing("_event_type"),
        *[_text_or_nothing(f"_{name}") for name in TEXT_FIELDS],
        *map_checks,
    ]
    checked = mapped.selectExpr("*", f"coalesce({' AND '.join(checks)}, false) AS is_contract")
    checked = settle(checked, "is_contract")

    def texts(name: str) -> str:
        entries = f"transform_values(_{name}, (k, v) -> try_variant_get(v, '$', 'string'))"
        return f"coalesce({entries}, cast(map() AS map<string,string>))"

    items = [
        f"'schema_version', coalesce({_text('_version')}, '{DEFAULT_SCHEMA_VERSION}')",
        f"'event_type', {_text('_event_type')}",
        "'data', to_json(_data)",
        *[f"'{name}', {_text('_' + name)}" for name in TEXT_FIELDS],
        *[f"'{name}', {texts(name)}" for name in MAP_FIELDS],
    ]
    opened = checked.selectExpr(
        *kept, "is_contract", f"if(is_contract, named_struct({', '.join(items)}), NULL) AS contract"
    )
    return settle(opened, "contract")
