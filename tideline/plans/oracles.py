"""DuckDB SQL for the registered queries; only the pass-through statements are shared with them."""

from __future__ import annotations

from tideline.plans.registered import KEY_MAP, MIDDLE, PASS_THROUGH, SNAPSHOT_POS, TAIL
from tideline.plans.fixtures import SNAPSHOT_TS

# one row per change; b_ columns are the before image, a_ the after image
CDC = """
ev AS (
  SELECT event_id AS pos, user_id, event_id, event_type, value, epoch_us(ts) AS ts, epoch_us(ts) // 1000 AS ts_ms, props,
         'events_' || CAST(user_id % 5 AS VARCHAR) AS tbl,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op
  FROM events),
cdc AS (
  SELECT *, CASE WHEN op = 'u' THEN event_id - 1 WHEN op = 'd' THEN event_id END AS b_event_id,
         CASE WHEN op = 'u' THEN 'signup' WHEN op = 'd' THEN event_type END AS b_event_type
  FROM ev)
"""

USERS = f"""
users AS (
  SELECT c_custkey AS user_id, CAST(-1 AS BIGINT) AS event_id, c_mktsegment AS event_type, c_acctbal AS value,
         CAST({SNAPSHOT_TS}000 AS BIGINT) AS ts, c_name AS props
  FROM customer)
"""

# all fields of both images of a change
IMAGES = """CASE WHEN op <> 'c' THEN user_id END AS b_user_id, b_event_id, b_event_type, CASE WHEN op <> 'c' THEN value END AS b_value,
       CASE WHEN op <> 'c' THEN ts END AS b_ts, CASE WHEN op <> 'c' THEN props END AS b_props,
       CASE WHEN op <> 'd' THEN user_id END AS a_user_id, CASE WHEN op <> 'd' THEN event_id END AS a_event_id, CASE WHEN op <> 'd' THEN event_type END AS a_event_type,
       CASE WHEN op <> 'd' THEN value END AS a_value, CASE WHEN op <> 'd' THEN ts END AS a_ts, CASE WHEN op <> 'd' THEN props END AS a_props"""

LATEST = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, pos DESC) AS rn FROM cdc)
"""

LATEST_ROWS = "SELECT user_id, event_id, event_type, value, ts, props FROM ranked WHERE rn = 1 AND op <> 'd'"

MERGED = f"""
WITH {CDC}, {USERS}, {LATEST}
{LATEST_ROWS}
UNION ALL
SELECT * FROM users WHERE user_id NOT IN (SELECT user_id FROM cdc)
"""


def _hash(text: str) -> str:
    folded = (
        f"list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split({text}, ''), "
        "lambda c: CAST(unicode(c) AS BIGINT))), lambda a, c: (a * 31 + c) % 4294967296)"
    )
    return f"(CASE WHEN {folded} >= 2147483648 THEN {folded} - 4294967296 ELSE {folded} END)"


def _key() -> str:
    cases = []
    for name, column in KEY_MAP.items():
        tbl = name.split(".")[1]
        if column == "event_id":
            cases.append(f"WHEN tbl = '{tbl}' THEN CAST(event_id AS VARCHAR)")
        elif column == "user_id":
            cases.append(f"WHEN tbl = '{tbl}' THEN CAST(user_id AS VARCHAR)")
    return f"CASE {' '.join(cases)} ELSE '' END"


def _image_json(prefix_id: str, prefix_type: str, value: str, ts: str) -> str:
    return (
        f"'{{\"user_id\":' || user_id || ',\"event_id\":' || {prefix_id} || ',\"event_type\":\"' || {prefix_type}"
        f" || '\",\"value\":' || {value} || ',\"ts\":' || {ts} || ',\"props\":' || CAST(to_json(props) AS VARCHAR) || '}}'"
    )


_TEXT_TS = "'\"' || strftime(make_timestamp(ts), '%Y-%m-%d %H:%M:%S') || '.' || {frac} || '\"'"


def _trimmed(text: str) -> str:
    """Fraction digits without trailing zeros, at least one digit."""
    return f"CASE WHEN rtrim({text}, '0') = '' THEN '0' ELSE rtrim({text}, '0') END"


_MS3 = "lpad(CAST(ts_ms % 1000 AS VARCHAR), 3, '0')"
_ROUTED_TS = _TEXT_TS.format(frac=_trimmed(_MS3))


def _envelope(value: str, ts: str) -> str:
    return f"""
  '{{"before":' || CASE WHEN op = 'c' THEN '{{}}' ELSE {_image_json('b_event_id', 'b_event_type', value, ts)} END
  || ',"after":' || CASE WHEN op = 'd' THEN '{{}}' ELSE {_image_json('event_id', 'event_type', value, ts)} END
  || ',"source":{{"db":"shop","table":"' || tbl || '","ts_ms":' || ts_ms || ',"pos":' || pos || '}}'
  || ',"op":"' || op || '","ts_ms":' || ts_ms || ',"transaction":""}}'"""


_NULLED = "CASE WHEN event_id % 7 = 0 THEN '\"\"' ELSE CAST(value AS VARCHAR) END"

KINDS = f"""
WITH {CDC}
SELECT '+I' AS row_kind, pos, user_id, event_id, event_type, value, ts, props FROM cdc WHERE op = 'c'
UNION ALL SELECT '+U', pos, user_id, event_id, event_type, value, ts, props FROM cdc WHERE op = 'u'
UNION ALL SELECT CASE op WHEN 'u' THEN '-U' ELSE '-D' END, pos, user_id, b_event_id, b_event_type, value, ts, props
          FROM cdc WHERE op IN ('u', 'd')
"""

TOPIC = "(SELECT 'changes' AS topic, CAST(user_id % 6 AS INTEGER) AS partition, event_id AS off, ts, props FROM events) t"


def _offsets(t: str) -> str:
    return f"""
SELECT 'changes' AS topic, CAST(p AS INTEGER) AS partition, off AS "offset"
FROM (SELECT unnest(range(8)) AS p) ps
LEFT JOIN (SELECT partition, min(off) FILTER (WHERE ts >= TIMESTAMP '{t}') AS off FROM {TOPIC} GROUP BY partition) f
  ON p = f.partition"""


def _replay(t: str, keep_unmatched: bool) -> str:
    unmatched = "TRUE" if keep_unmatched else "FALSE"
    return f"""
SELECT topic, t.partition, off AS "offset", ts AS timestamp, props AS value
FROM {TOPIC} JOIN (SELECT partition AS p, min(off) FILTER (WHERE ts >= TIMESTAMP '{t}') AS seek
                   FROM {TOPIC} GROUP BY partition) f ON t.partition = f.p
WHERE CASE WHEN seek IS NULL THEN {unmatched} ELSE off >= seek END"""


def _allocate_ctes(registry: str, names: str, n: int) -> str:
    # slots (load + j, p) in order, matched to new tables by row number
    return f"""
reg AS ({registry}),
names AS ({names}),
fresh AS (
  SELECT name, row_number() OVER (ORDER BY ord) AS r FROM names
  WHERE name NOT IN (SELECT db_table_name FROM reg WHERE kafka_topic = 'changes')),
loads AS (
  SELECT p, (SELECT count(*) FROM reg WHERE kafka_topic = 'changes' AND CAST(kafka_partition AS BIGINT) = p) AS l
  FROM (SELECT unnest(range({n})) AS p) ps),
slots AS (
  SELECT p, row_number() OVER (ORDER BY level, p) AS r
  FROM (SELECT p, l + j AS level
        FROM loads, (SELECT unnest(range((SELECT count(*) FROM fresh))) AS j) js) s)"""


NAMES = """
SELECT 'crm.customer_' || c_custkey AS name, c_custkey AS ord FROM customer
UNION ALL SELECT 'erp.supplier_' || s_suppkey, s_suppkey + 1000000000000 FROM supplier"""


def _allocate(registry: str, n: int) -> str:
    return f"""
WITH {_allocate_ctes(registry, NAMES, n)}
SELECT db_table_name, kafka_partition, kafka_topic FROM reg
UNION ALL
SELECT name, CAST(p AS VARCHAR), 'changes' FROM fresh JOIN slots USING (r)"""


REGISTRY = """
SELECT 'erp.supplier_' || s_suppkey AS db_table_name,
       CASE WHEN s_suppkey % 10 = 0 THEN '2' WHEN s_suppkey % 3 = 0 THEN '1' ELSE '0' END AS kafka_partition,
       CASE WHEN s_suppkey % 4 = 3 THEN 'audit' ELSE 'changes' END AS kafka_topic
FROM supplier"""

WIDE = """
SELECT 'shop.order_' || o_orderkey AS db_table_name, CAST(CAST(floor(sqrt(CAST(o_orderkey AS DOUBLE) * 100.0)) AS BIGINT) % 5000 AS VARCHAR) AS kafka_partition,
       'changes' AS kafka_topic
FROM orders"""

EMPTY = "SELECT '' AS db_table_name, '' AS kafka_partition, '' AS kafka_topic WHERE FALSE"

SCRIPT_RESULT = """
SELECT l_returnflag AS flag, 'a;b' AS note, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1
UNION ALL SELECT o_orderstatus, '--x', count(*), CAST(0 AS DOUBLE) FROM orders GROUP BY 1"""

_US = "epoch_us(ts)"
# cut to milliseconds; epoch_ms() would round
_MS = "(epoch_us(ts) // 1000)"


def _time(us: str) -> str:
    """LocalTime text of a microsecond of the day, cut to milliseconds."""
    hh = f"lpad(CAST({us} // 3600000000 AS VARCHAR), 2, '0')"
    mm = f"lpad(CAST({us} // 60000000 % 60 AS VARCHAR), 2, '0')"
    ss = f"lpad(CAST({us} // 1000000 % 60 AS VARCHAR), 2, '0')"
    fff = f"lpad(CAST({us} // 1000 % 1000 AS VARCHAR), 3, '0')"
    return f"""{hh} || ':' || {mm} || CASE WHEN {us} // 1000 % 60000 = 0 THEN ''
      WHEN {us} // 1000 % 1000 = 0 THEN ':' || {ss} ELSE ':' || {ss} || '.' || {fff} END"""


_SECONDS = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
_F3 = f"lpad(CAST({_MS} % 1000 AS VARCHAR), 3, '0')"
_F6 = f"lpad(CAST({_US} % 1000000 AS VARCHAR), 6, '0')"
_FULL_MS = f"{_SECONDS} || '.' || {_trimmed(_F3)}"
_OPTIONAL_MS = f"{_SECONDS} || CASE WHEN {_MS} % 1000 = 0 THEN '' ELSE '.' || rtrim({_F3}, '0') END"

_ORDER_JSON = """
  '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus
  || '","o_totalprice":' || o_totalprice || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
  || '","o_orderpriority":"' || o_orderpriority || '"}'"""

ORACLES: dict[str, str] = {
    "s1_snapshot": f"""
SELECT 'r' AS op, 'shop' AS db, 'orders' AS tbl, CAST({SNAPSHOT_TS} AS BIGINT) AS ts_ms, TRUE AS no_before,
       o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
    "s1_snapshot_envelopes": f"""
SELECT o_orderkey, '{{"before":{{}},"after":' || {_ORDER_JSON} || ',"source":{{"db":"shop","table":"orders","ts_ms":{SNAPSHOT_TS},"pos":{SNAPSHOT_POS}}},"op":"r","ts_ms":'
  || '{SNAPSHOT_TS},"transaction":""}}' AS value
FROM orders""",
    "s2_initial": f"""
WITH {CDC}, {USERS}
SELECT op, tbl, pos, ts_ms, user_id, {IMAGES} FROM cdc WHERE pos > {SNAPSHOT_POS}
UNION ALL
SELECT 'r', 'users', CAST({SNAPSHOT_POS} AS BIGINT), CAST({SNAPSHOT_TS} AS BIGINT), user_id,
       NULL, NULL, NULL, NULL, NULL, NULL, user_id, event_id, event_type, value, ts, props FROM users""",
    "s2_latest": f"WITH {CDC} SELECT op, tbl, pos, ts_ms, user_id, {IMAGES} FROM cdc WHERE pos > {SNAPSHOT_POS}",
    "s3_select_tables": f"WITH {CDC} SELECT tbl, op, pos FROM cdc WHERE tbl IN ('events_1', 'events_3')",
    "s3_select_patterns": f"""
WITH {CDC} SELECT tbl, op, count(*) AS n FROM cdc WHERE tbl IN ('events_0', 'events_1', 'events_2') GROUP BY tbl, op""",
    "s7_offsets_for_times": _offsets(MIDDLE),
    "s7_offsets_tail": _offsets(TAIL),
    "s8_replay_from": _replay(MIDDLE, False),
    "s8_replay_earliest": _replay(TAIL, True),
    "t1_normalize": f"WITH {CDC} SELECT pos, {_envelope(_NULLED, _ROUTED_TS)} AS value FROM cdc",
    "t1_normalize_mixed": """
SELECT event_id AS pos, '{"before":{},"after":{"at":"'
  || CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END
  || '","id":' || event_id || ',"note":"' || CASE WHEN event_id % 7 = 0 THEN '' ELSE event_type END
  || '"},"source":{"db":"shop","table":"' || CASE WHEN event_id % 2 = 0 THEN 'days' ELSE 'moments' END
  || '"},"op":"c","ts_ms":1,"transaction":""}' AS value FROM events""",
    "t2_render_temporal": f"""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS as_date, {_time(f'({_US} % 86400000000)')} AS time_ms,
       {_time(f'({_US} % 86400000000)')} AS time_us, strftime(ts, '%H:%M') AS time_whole_minute,
       {_time(f'({_US} % 86400000000)')} AS time_ns, {_OPTIONAL_MS} AS ts_ms_text,
       substring({_FULL_MS}, 1, length({_FULL_MS}) - 2) AS ts_ms_compat, {_SECONDS} AS ts_whole_second,
       {_FULL_MS} AS ts_us_text, {_SECONDS} || '.0' AS ts_ns_whole,
       strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S')
         || CASE WHEN {_US} % 1000000 = 0 THEN '' ELSE '.' || rtrim({_F6}, '0') END AS zoned_text
FROM events""",
    "t2_order_dates": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day_text,
       strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' AS ts_text FROM orders""",
    "t3_unwrap_payload": f"""
WITH {CDC} SELECT pos, op, ts_ms, '' AS tx, tbl, 'shop' AS db, ts_ms AS source_ts_ms, pos AS source_pos, {IMAGES}, TRUE AS bare FROM cdc""",
    "t4_flatten": f"""
WITH {CDC} SELECT op, 'shop' AS db, tbl, ts_ms, user_id, event_id, event_type,
       CASE WHEN event_id % 7 <> 0 THEN value END AS value, ts, props FROM cdc""",
    "t4_flatten_decimals": """
SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN '9876543210' || lpad(CAST(event_id AS VARCHAR), 10, '0') || '.'
  || lpad(CAST(user_id AS VARCHAR), 12, '0') || '123456' END AS amount FROM events""",
    "t4_flatten_types": f"""
SELECT event_id, hex(encode(props)) AS raw, CASE WHEN event_id % 6 <> 0 THEN epoch_us(ts) END AS moment,
       {_OPTIONAL_MS} AS local, strftime(ts, '%Y-%m-%d') AS day,
       user_id || ',' || event_id AS ids, CAST(user_id::HUGEINT * 10000000000000000000::HUGEINT + event_id AS VARCHAR) AS big FROM events""",
    "t5_effective_key": f"WITH {CDC} SELECT pos, op, {_key()} AS key_value FROM cdc",
    "t6_row_kinds": KINDS,
    "t7_primary_key_map": """
SELECT p_brand AS db_table, 'col_' || max(p_partkey) AS pk_column FROM part WHERE p_size % 5 = 0 GROUP BY p_brand""",
    "t8_fan_out": f"""
WITH {CDC} SELECT 'shop' AS db, tbl, count(*) AS n, min(pos) AS first_pos, max(pos) AS last_pos FROM cdc GROUP BY tbl""",
    "t8_fan_out_stream": f"""
WITH {CDC} SELECT 'shop' AS db, tbl, count(*) AS n, min(pos) AS first_pos, max(pos) AS last_pos FROM cdc GROUP BY tbl""",
    "p1_hash_partition": f"""
WITH {CDC}, keyed AS (SELECT pos, tbl, {_key()} AS key_value FROM cdc)
SELECT pos, key_value, CAST(abs({_hash("tbl || 'shop' || key_value")} % 7) AS INTEGER) AS partition FROM keyed""",
    "p1_hash_temporal_key": f"""
WITH {CDC}, keyed AS (SELECT pos, tbl, CASE WHEN tbl IN ('events_0', 'events_1', 'events_2') THEN replace({_ROUTED_TS}, '"', '')
  ELSE event_type END AS key_value FROM cdc)
SELECT pos, key_value, CAST(abs({_hash("tbl || 'shop' || key_value")} % 97) AS INTEGER) AS partition FROM keyed""",
    "p2_registry_partition": f"""
WITH {CDC}, firsts AS (SELECT tbl, row_number() OVER (ORDER BY min(pos)) - 1 AS r FROM cdc GROUP BY tbl)
SELECT pos, tbl, CAST(r % 3 AS INTEGER) AS partition FROM cdc JOIN firsts USING (tbl)""",
    "p3_partition_load": f"""
SELECT CAST(p AS INTEGER) AS partition, count(kafka_partition) AS tables FROM (SELECT unnest(range(12)) AS p) ps
LEFT JOIN ({REGISTRY}) reg ON CAST(kafka_partition AS BIGINT) = p AND kafka_topic = 'changes' GROUP BY p""",
    "p4_allocate": _allocate(REGISTRY, 12),
    "p4_allocate_empty": _allocate(EMPTY, 6),
    "p4_allocate_wide": _allocate(WIDE, 5000),
    "p5_registry_for": f"""
SELECT db_table_name, CAST(kafka_partition AS INTEGER) AS partition FROM ({REGISTRY}) reg WHERE kafka_topic = 'audit'""",
    "k1_topic_frame": f"""
WITH {CDC}, keyed AS (SELECT *, {_key()} AS key_value FROM cdc)
SELECT {_envelope('CAST(value AS VARCHAR)', _ROUTED_TS)} AS value,
       CAST(abs({_hash("tbl || 'shop' || key_value")} % 6) AS INTEGER) AS partition FROM keyed""",
    "k1_ordered_frame": f"""
WITH {CDC}, keyed AS (SELECT *, {_key()} AS key_value FROM cdc),
routed AS (SELECT pos, {_envelope('CAST(value AS VARCHAR)', _ROUTED_TS)} AS value,
       CAST(abs({_hash("tbl || 'shop' || key_value")} % 6) AS INTEGER) AS partition FROM keyed)
SELECT value, partition, row_number() OVER (PARTITION BY partition ORDER BY pos) - 1 AS sequence FROM routed""",
    "k1_registry_topic_frame": f"""
WITH {CDC}, {_allocate_ctes(REGISTRY, "SELECT tbl AS name, min(pos) AS ord FROM cdc GROUP BY tbl", 12)}
SELECT {_envelope('CAST(value AS VARCHAR)', _ROUTED_TS)} AS value, CAST(p AS INTEGER) AS partition
FROM cdc JOIN fresh ON tbl = name JOIN slots USING (r)""",
    "k2_encode_rows": f"""
WITH {CDC}
SELECT {_image_json('event_id', 'event_type', "CASE WHEN event_id % 7 = 0 THEN 'null' ELSE CAST(value AS VARCHAR) END",
                    'ts')} AS line FROM cdc WHERE op <> 'd'""",
    "k2_encode_orders": f"SELECT {_ORDER_JSON} AS line FROM orders",
    "k3_delete_keys": f"WITH {CDC} SELECT DISTINCT user_id FROM cdc WHERE op <> 'c'",
    "k3_delete_event_keys": f"WITH {CDC} SELECT DISTINCT b_event_id AS event_id FROM cdc WHERE op <> 'c'",
    "k3_remove_rows": f"""
WITH {CDC}, {USERS} SELECT * FROM users WHERE user_id NOT IN (SELECT user_id FROM cdc WHERE op <> 'c')""",
    "k4_latest_rows": f"WITH {CDC}, {LATEST} {LATEST_ROWS}",
    "k4_apply_to_base": MERGED,
    "k4_moving_keys": f"""
WITH {CDC}, nexts AS (SELECT *, lead(op) OVER (ORDER BY pos) AS next_op FROM cdc)
SELECT user_id, event_id, event_type, value, ts, props FROM nexts WHERE op <> 'd' AND coalesce(next_op, '') <> 'u'""",
    "k4_apply_stream": MERGED,
    "k4_apply_buckets": MERGED,
    "k5_debug_lines": f"""
SELECT pos, row_kind || '[' || user_id || ', ' || event_id || ', ' || event_type || ', ' || CAST(value AS VARCHAR) || ', ' || ts
  || ', ' || props || ']' AS line
FROM ({KINDS}) k""",
    "k5_ordered_lines": f"""
SELECT row_number() OVER (ORDER BY pos, row_kind = '+U') - 1 AS position, row_kind || '[' || user_id || ', ' || event_id || ', ' || event_type
  || ', ' || CAST(value AS VARCHAR) || ', ' || ts || ', ' || props || ']' AS line
FROM ({KINDS}) k""",
    "q1_script_batch": SCRIPT_RESULT,
    "q1_script_shared": """
SELECT o_orderstatus AS what, count(*) AS n FROM orders GROUP BY 1
UNION ALL SELECT o_orderpriority, count(*) FROM orders GROUP BY 1
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(floor(o_totalprice) AS BIGINT) FROM orders WHERE o_totalprice > 100000""",
    "q1_script_stream": """
SELECT event_id, event_type || '/' || user_id AS what, TRUE AS kept FROM events WHERE event_type <> 'error'
UNION ALL SELECT event_id, '-' || event_type, NULL FROM events WHERE event_type = 'error'
UNION ALL SELECT DISTINCT NULL, event_type, NULL FROM events""",
    "q2_script_immediate": SCRIPT_RESULT,
    "q3_mirror": f"""
WITH {CDC}, {USERS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, pos DESC) AS rn
           FROM cdc WHERE pos > {SNAPSHOT_POS})
{LATEST_ROWS}
UNION ALL SELECT * FROM users WHERE user_id NOT IN (SELECT user_id FROM ranked)""",
    "q3_mirror_stream": f"WITH {CDC}, {LATEST} {LATEST_ROWS}",
    "q3_mirror_tables": f"""
WITH {CDC}, {LATEST}
SELECT CASE user_id % 3 WHEN 0 THEN 'events' WHEN 1 THEN 'clicks' ELSE 'amounts' END AS tbl, user_id,
       CASE user_id % 3 WHEN 0 THEN event_id || '|' || event_type || '|' || ts || '|' || props WHEN 1 THEN event_type
       ELSE CAST(event_id::HUGEINT * 1000000000000000::HUGEINT + user_id AS VARCHAR) || '.000000|' || ts || '|' || user_id || ',' || event_id END AS detail
FROM ranked WHERE rn = 1 AND op <> 'd'""",
} | PASS_THROUGH
ORACLES["s2_initial_stream"] = ORACLES["q3_mirror"]
