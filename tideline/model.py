"""Names and types shared by all operators.

A *change frame* has the columns ``before``, ``after`` (struct, string map or
JSON text; null when absent), ``source`` (struct with at least ``db``,
``table``, ``ts_ms``), ``op``, ``ts_ms`` and ``transaction``.
"""

from __future__ import annotations

# Fixed values of the change-record format.
OP_SNAPSHOT = "r"
OP_INSERT = "c"
OP_UPDATE = "u"
OP_DELETE = "d"

INSERT = "+I"
UPDATE_BEFORE = "-U"
UPDATE_AFTER = "+U"
DELETE = "-D"

# Logical type names of temporal fields.
DATE = "io.debezium.time.Date"
TIME_MS = "io.debezium.time.Time"
TIME_US = "io.debezium.time.MicroTime"
TIME_NS = "io.debezium.time.NanoTime"
TIMESTAMP_MS = "io.debezium.time.Timestamp"
TIMESTAMP_US = "io.debezium.time.MicroTimestamp"
TIMESTAMP_NS = "io.debezium.time.NanoTimestamp"
ZONED = "io.debezium.time.ZonedTimestamp"

# Fixed value: zoned timestamps are shown at this offset.
ZONED_OFFSET = "+08:00"

REGISTRY_SCHEMA = "db_table_name STRING, kafka_partition STRING, kafka_topic STRING"
