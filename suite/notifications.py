"""Contract checks and routes of notifications."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures import messages
from rowtide.operators import contract, routing
from rowtide.streaming.deliver import deliver_notifications
from suite.base import notify, query

_N = f"""(SELECT *, frame_no % 6 AS c, 'user' AS u,
  concat('{{"channel":"', channel, '","payload":', to_json(payload), ',"pid":', pid, '}}') AS envelope,
  frame_no % 6 IN (0, 1) AS valid FROM ({messages.NOTIFY_SQL}) m) n
  JOIN (SELECT event_id, props, user_id, event_type FROM events) e ON n.frame_no = e.event_id"""
_BODY = "CASE WHEN valid THEN props ELSE envelope END"
# The data of a contract is compared as a JSON value: blanks do not count.
_NO_BLANKS = "replace({}, ' ', '')"


def _sql(columns: str) -> str:
    return f"SELECT frame_no, {columns} FROM {_N}"


def _body(sql: bool = False):
    if sql:
        return f"CASE WHEN valid THEN {_NO_BLANKS.format('props')} ELSE envelope END AS body"
    return F.col("body")


@query("N1_simple_envelope", _sql("envelope AS body, 'pgx' AS destination, 'pgx.notify' AS routing_key"))
def simple_envelope(spark, sf_dir):
    return routing.to_rabbitmq(notify(spark, sf_dir)).select("frame_no", "body", "destination", "routing_key")


@query("N2_contract_validation", _sql("valid AS is_contract"))
def contract_validation(spark, sf_dir):
    return contract.parse_contracts(notify(spark, sf_dir)).select("frame_no", "is_contract")


@query(
    "N3_contract_defaults",
    _sql("""CASE c WHEN 0 THEN '2' ELSE '1' END AS schema_version, CASE c WHEN 0 THEN concat(channel, '.created') END
         AS event_type, CAST(CASE c WHEN 0 THEN 1 ELSE 0 END AS INTEGER) AS n_env""") + " WHERE valid",
)
def contract_defaults(spark, sf_dir):
    valid = contract.parse_contracts(notify(spark, sf_dir)).filter("is_contract")
    return valid.select(
        "frame_no", "contract.schema_version", "contract.event_type", F.size("contract.shell_env").alias("n_env")
    )


@query("N4_data_body", _sql(f"{_NO_BLANKS.format('props')} AS data") + " WHERE valid")
def data_body(spark, sf_dir):
    return contract.parse_contracts(notify(spark, sf_dir)).filter("is_contract").select("frame_no", "contract.data")


@query(
    "N5_mode",
    f"""SELECT mode, count(*) AS n, sum(CASE WHEN body = envelope THEN 0 ELSE 1 END) AS opened FROM
        (SELECT 'simple' AS mode, envelope, envelope AS body FROM {_N} UNION ALL
         SELECT 'contract' AS mode, envelope, {_BODY} AS body FROM {_N}) x GROUP BY mode""",
)
def mode(spark, sf_dir):
    source = notify(spark, sf_dir)
    simple = routing.to_kafka(source, "simple").select("body", F.lit("simple").alias("mode"))
    opened = routing.to_kafka(source, "contract").select("body", F.lit("contract").alias("mode"))
    is_envelope = F.col("body").startswith('{"channel"')
    return (
        simple.unionByName(opened)
        .groupBy("mode")
        .agg(F.count("*").alias("n"), F.count_if(~is_envelope).alias("opened"))
    )


@query(
    "N6_rabbitmq_route",
    _sql(f"""CASE c WHEN 0 THEN concat('x_', channel) ELSE 'pgx' END AS destination, 'pgx.notify' AS routing_key,
         {_body(True)}"""),
)
def rabbitmq_route(spark, sf_dir):
    rows = routing.to_rabbitmq(notify(spark, sf_dir), "contract")
    return rows.select("frame_no", "destination", "routing_key", "body")


@query(
    "N7_rabbitmq_headers",
    _sql("""CASE c WHEN 0 THEN '1' END AS h_priority, CASE c WHEN 0 THEN concat(channel, '.created') END AS h_event_type,
         CASE WHEN valid THEN channel END AS h_channel, CASE c WHEN 0 THEN '2' WHEN 1 THEN '1' END AS h_version"""),
)
def rabbitmq_headers(spark, sf_dir):
    h = F.col("headers")
    return routing.to_rabbitmq(notify(spark, sf_dir), "contract").select(
        "frame_no",
        h["x-priority"].alias("h_priority"),
        h["x-event-type"].alias("h_event_type"),
        h["x-pg-channel"].alias("h_channel"),
        h["x-schema-version"].alias("h_version"),
    )


@query(
    "N8_kafka_route",
    _sql(f"""CASE c WHEN 0 THEN concat('t_', channel) ELSE 'pgx-notify' END AS topic,
         CASE c WHEN 0 THEN concat('u', user_id) END AS msg_key, {_body(True)}"""),
)
def kafka_route(spark, sf_dir):
    rows = routing.to_kafka(notify(spark, sf_dir), "contract")
    return rows.select("frame_no", F.col("destination").alias("topic"), "msg_key", "body")


@query(
    "N9_kafka_headers",
    _sql("CASE c WHEN 0 THEN concat('h=a,x-event-type=', channel, '.created') ELSE '' END AS headers"),
)
def kafka_headers(spark, sf_dir):
    text = F.expr("array_join(transform(headers, h -> concat(h.key, '=', cast(h.value AS string))), ',')")
    return routing.to_kafka(notify(spark, sf_dir), "contract").select("frame_no", text.alias("headers"))


@query("N10_webhook_route", _sql(f"'http://default' AS destination, {_body(True)}"))
def webhook_route(spark, sf_dir):
    return routing.to_webhook(notify(spark, sf_dir), "http://default", "contract").select(
        "frame_no", "destination", "body"
    )


@query(
    "N11_webhook_headers",
    _sql("CASE c WHEN 0 THEN 't' ELSE 'default' END AS h_auth, 'x' AS h_extra, CAST(0 AS INTEGER) AS n_simple"),
)
def webhook_headers(spark, sf_dir):
    defaults = {"Authorization": "default", "X-Extra": "x"}
    source = notify(spark, sf_dir)
    simple = routing.to_webhook(source, "http://d", "simple", defaults).select(
        "frame_no", F.size("headers").alias("n_simple")
    )
    h = F.col("headers")
    return (
        routing.to_webhook(source, "http://d", "contract", defaults)
        .select("frame_no", h["authorization"].alias("h_auth"), h["x-extra"].alias("h_extra"))
        .join(simple, "frame_no")
    )


@query(
    "N12_command_env",
    _sql(f"""'b' AS e_base, channel AS e_channel, CAST(pid AS VARCHAR) AS e_pid,
         CASE c WHEN 0 THEN concat(channel, '.created') END AS e_type, CASE c WHEN 0 THEN '2' WHEN 1 THEN '1' END AS e_version,
         CASE c WHEN 0 THEN CAST(frame_no AS VARCHAR) END AS e_own,
         CASE WHEN valid THEN {_NO_BLANKS.format('props')} ELSE payload END AS e_payload"""),
)
def command_env(spark, sf_dir):
    e = F.col("env")
    return routing.to_shell(notify(spark, sf_dir), "run", "contract", {"BASE": "b"}).select(
        "frame_no",
        e["BASE"].alias("e_base"),
        e["PGX_CHANNEL"].alias("e_channel"),
        e["PGX_PID"].alias("e_pid"),
        e["PGX_EVENT_TYPE"].alias("e_type"),
        e["PGX_SCHEMA_VERSION"].alias("e_version"),
        e["EVENT_ID"].alias("e_own"),
        e["PGX_PAYLOAD"].alias("e_payload"),
    )


@query(
    "N13_fallback",
    _sql("""'pgx' AS exchange, 'pgx-notify' AS topic, envelope AS body, CAST(0 AS INTEGER) AS n_headers,
         payload AS e_payload""") + " WHERE NOT valid",
)
def fallback(spark, sf_dir):
    source = notify(spark, sf_dir)
    amqp = routing.to_rabbitmq(source, "contract").filter(~F.expr("headers['x-pg-channel'] IS NOT NULL"))
    kafka = routing.to_kafka(source, "contract").select("frame_no", F.col("destination").alias("topic"))
    shell = routing.to_shell(source, "run", "contract").select("frame_no", F.expr("env['PGX_PAYLOAD']").alias("e_payload"))
    picked = amqp.select(
        "frame_no", F.col("destination").alias("exchange"), "body", F.size("headers").alias("n_headers")
    )
    return picked.join(kafka, "frame_no").join(shell, "frame_no")


@query(
    "N14_delivery_hook",
    f"""SELECT channel AS session_id, frame_no, 'kafka' AS sink, channel <> 'error' AS ok,
        CASE channel WHEN 'error' THEN 'refused' END AS error FROM ({messages.NOTIFY_SQL}) m""",
)
def delivery_hook(spark, sf_dir):
    def deliver(message):
        if message["channel"] == "error":
            raise ValueError("refused")

    rows = routing.to_kafka(notify(spark, sf_dir)).withColumn("session_id", F.col("channel"))
    return deliver_notifications(rows, deliver)
