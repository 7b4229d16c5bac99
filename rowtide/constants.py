"""Fixed values.

Consumers of the produced messages depend on these texts and numbers, so they
are spelled out here once and never derived.
"""

# Names of the per-event attributes.
ATTR_OP = "PGX_OP"
ATTR_LSN = "PGX_LSN"
ATTR_SCHEMA = "PGX_SCHEMA"
ATTR_TABLE = "PGX_TABLE"
ATTR_NEW = "PGX_NEW"
ATTR_OLD = "PGX_OLD"
ATTR_TABLES = "PGX_TABLES"
ATTR_XID = "PGX_XID"
ATTR_PAYLOAD = "PGX_PAYLOAD"
ATTR_CHANNEL = "PGX_CHANNEL"
ATTR_PID = "PGX_PID"
ATTR_EVENT_TYPE = "PGX_EVENT_TYPE"
ATTR_SCHEMA_VERSION = "PGX_SCHEMA_VERSION"

# Fixed value: JSON text of a column the server did not send.
UNCHANGED_TEXT = "__pgx_unchanged"

# Default destinations.
DEFAULT_EXCHANGE = "pgx"
DEFAULT_CHANGE_ROUTING_KEY = "pgx.wal"
DEFAULT_NOTIFY_ROUTING_KEY = "pgx.notify"
DEFAULT_CHANGE_TOPIC = "pgx-wal"
DEFAULT_NOTIFY_TOPIC = "pgx-notify"
DEFAULT_CHANGE_KEY = "pgx-wal"
DEFAULT_CONSUMER = "pgx_slot"

# Message headers added by the router.
HEADER_EVENT_TYPE = "x-event-type"
HEADER_CHANNEL = "x-pg-channel"
HEADER_SCHEMA_VERSION = "x-schema-version"
HEADER_CONTENT_TYPE = "content-type"
JSON_CONTENT_TYPE = "application/json"

# Fixed value: schema version of a contract that names none.
DEFAULT_SCHEMA_VERSION = "1"

# Fixed value: microseconds between 1970-01-01 and 2000-01-01.
SERVER_EPOCH_MICROS = 946_684_800_000_000

# Name of a relation that was never described.
UNKNOWN_SCHEMA_PREFIX = "unknown_"
UNKNOWN_TABLE = "unknown"
UNKNOWN_COLUMN = "?"

# Result sets.
NULL_TEXT = "NULL"
DISPLAY_LIMIT = 500
SHEET_DATA_ROWS = 1_048_575
SHEET_NAME_BYTES = 31
SHEET_DEFAULT_NAME = "Sheet"
WIDTH_MIN, WIDTH_MAX, WIDTH_PAD = 6, 60, 2

# Fixed value: output plugin recorded for a named consumer.
PLUGIN = "pgoutput"

DML = ("insert", "update", "delete")
OPERATIONS = ("insert", "update", "delete", "truncate")
