"""DuckDB SQL equivalents of the registered queries (same column names).

The stand-in shaping of ``standins.py`` is restated inline in each statement.
"""

from __future__ import annotations


def fmt_duration(d: str) -> str:
    """DuckDB text of the duration formatter (inlined; a macro would need DDL)."""
    return (f"CASE WHEN ({d}) > INTERVAL 1 MINUTE "
            f"THEN CAST(datepart('minute', {d}) AS VARCHAR) || 'm' || CAST(datepart('second', {d}) AS VARCHAR) || 's' "
            f"ELSE CAST(datepart('second', {d}) AS VARCHAR) || 's' END")


FLIGHT_ID = "CAST(CAST(ts AS DATE) AS VARCHAR) || '-' || CAST(user_id AS VARCHAR)"

VEHICLE_STATUS = f"""
    SELECT {FLIGHT_ID} AS mcap_id, CAST(ts AS DATE) AS log_date, ts AS log_time, 0 AS multi_id,
           CAST(CASE WHEN event_type = 'purchase' THEN 2 ELSE 1 END AS BIGINT) AS arming_state,
           CAST(floor(value) % 7 AS BIGINT) AS nav_state, event_type = 'signup' AS failsafe,
           event_id AS ordinal
    FROM events WHERE event_type IN ('click', 'purchase', 'signup')"""

LOGGED_MESSAGES = f"""
    SELECT {FLIGHT_ID} AS mcap_id, CAST(ts AS DATE) AS log_date, ts AS log_time,
           CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, props AS message
    FROM events WHERE event_type IN ('error', 'view')"""

BATTERY_STATUS = """
    SELECT l_returnflag || '-' || l_linestatus AS mcap_id, CAST(l_linenumber AS INTEGER) AS multi_id,
           CAST(round(l_tax * 100) AS BIGINT) AS cell_count, l_extendedprice / 1000 AS voltage_v,
           l_quantity AS current_a, l_discount AS remaining, l_tax * 1000 AS temperature
    FROM lineitem"""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["error_counts"] = f"""
WITH lm AS ({LOGGED_MESSAGES})
SELECT mcap_id, count(CASE WHEN level = 'ERROR' THEN 1 END) AS error_count FROM lm GROUP BY 1"""

ORACLE_SQL["flights_overview"] = f"""
WITH vs AS ({VEHICLE_STATUS}), lm AS ({LOGGED_MESSAGES}),
ec AS (SELECT mcap_id, count(CASE WHEN level = 'ERROR' THEN 1 END) AS error_count FROM lm GROUP BY 1),
fts AS (
    SELECT mcap_id, min(log_date) AS flight_date, min(log_time) AS start_time,
           max(log_time) - min(log_time) AS d,
           max(log_time) FILTER (WHERE arming_state = 2) - min(log_time) FILTER (WHERE arming_state = 2) AS ad
    FROM vs GROUP BY mcap_id)
SELECT mcap_id, flight_date, start_time, {fmt_duration('d')} AS duration, {fmt_duration('ad')} AS armed_duration,
       COALESCE(ec.error_count, 0) AS error_count
FROM fts LEFT JOIN ec USING (mcap_id)"""

ORACLE_SQL["battery_ranges"] = f"""
WITH b AS ({BATTERY_STATUS})
SELECT mcap_id, multi_id, cell_count,
       min(voltage_v) AS min_voltage, max(voltage_v) AS max_voltage,
       min(current_a) AS min_current, max(current_a) AS max_current,
       min(remaining) AS min_remaining, max(remaining) AS max_remaining,
       min(temperature) AS min_temperature, max(temperature) AS max_temperature
FROM b GROUP BY 1, 2, 3"""

ORACLE_SQL["max_altitude"] = f"""
WITH p AS (SELECT {FLIGHT_ID} AS mcap_id, ts AS log_time, -value AS z FROM events)
SELECT mcap_id, round(max(-z), 1) AS max_alt_m, min(log_time) AS started,
       {fmt_duration('max(log_time) - min(log_time)')} AS duration
FROM p GROUP BY mcap_id"""

LOG_CATALOG = """
    SELECT 'L-' || CAST(o_orderkey AS VARCHAR) AS log_id, CAST(o_orderdate AS DATE) AS log_date,
           o_orderpriority AS mav_type, o_orderstatus AS rating,
           CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE 'veh-' || CAST(o_custkey AS VARCHAR) END AS vehicle_uuid,
           'vehicle-' || CAST(o_custkey AS VARCHAR) AS vehicle_name,
           'airframe-' || substr(o_orderpriority, 1, 1) AS airframe_name,
           CASE WHEN o_totalprice > 200000 THEN 'quad' ELSE 'fixed_wing' END AS airframe_type,
           CASE WHEN o_orderstatus = 'P' THEN NULL WHEN starts_with(o_orderpriority, '1') THEN 'CI' ELSE 'webui' END AS source,
           'v' || CAST(year(o_orderdate) AS VARCHAR) AS ver_sw, o_orderkey AS ordinal
    FROM orders"""
CATALOG_COLS = ("log_id, log_date, mav_type, rating, vehicle_uuid, vehicle_name, airframe_name, airframe_type, "
                "source, ver_sw, ordinal")

ORACLE_SQL["latest_per_vehicle"] = f"""
WITH c AS ({LOG_CATALOG})
SELECT {CATALOG_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY vehicle_uuid ORDER BY log_date DESC, ordinal) AS rn
    FROM c WHERE vehicle_uuid IS NOT NULL) WHERE rn = 1"""

_SELECT_CHAIN = f"""
WITH c AS ({LOG_CATALOG}),
f1 AS (SELECT * FROM c WHERE lower(mav_type) IN ('1-urgent', '2-high', '3-medium') AND lower(rating) IN ('f', 'o')
       AND airframe_type = 'quad'),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_uuid ORDER BY log_date DESC, ordinal) AS rn
                     FROM f1 WHERE vehicle_uuid IS NOT NULL) WHERE rn = 1),
f2 AS (SELECT * FROM w WHERE source = 'webui')
SELECT {CATALOG_COLS} FROM f2 ORDER BY log_date DESC, ordinal"""

ORACLE_SQL["catalog_select"] = _SELECT_CHAIN + " LIMIT 25"
ORACLE_SQL["catalog_matches"] = _SELECT_CHAIN


def sql_file_stem(path: str) -> str:
    return f"regexp_replace(regexp_extract({path}, '[^/]*$'), '\\.[^.]*$', '')"


def sql_log_id_from_stem(stem: str) -> str:
    return (f"CASE WHEN regexp_matches({stem}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}-.') "
            f"THEN regexp_extract({stem}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}-(.+)', 1) ELSE {stem} END")


_HELD = f"""
held_files AS (SELECT '/data/raw/' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '-L-' || CAST(o_orderkey AS VARCHAR)
                      || '.ulg' AS path FROM orders WHERE o_orderstatus = 'F'),
held AS (SELECT DISTINCT {sql_log_id_from_stem(sql_file_stem('path'))} AS log_id FROM held_files)"""

_NEW_SEL = f"""
WITH c AS ({LOG_CATALOG}),
sel AS (SELECT * FROM c WHERE lower(mav_type) IN ('1-urgent', '2-high') ORDER BY log_date DESC, ordinal LIMIT 500),
{_HELD}"""

ORACLE_SQL["catalog_new_only"] = _NEW_SEL + f"""
SELECT {CATALOG_COLS} FROM sel WHERE NOT EXISTS (SELECT 1 FROM held WHERE held.log_id = sel.log_id)"""

ORACLE_SQL["catalog_outcomes"] = _NEW_SEL + """
SELECT CASE WHEN h.log_id IS NOT NULL THEN 'skipped' ELSE 'selected' END AS outcome, count(*) AS n
FROM sel LEFT JOIN held h ON h.log_id = sel.log_id GROUP BY 1"""

ORACLE_SQL["skip_existing"] = """
WITH src AS (SELECT 'raw/' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '-L-' || CAST(o_orderkey AS VARCHAR)
                    || '.ulg' AS key FROM orders),
done AS (SELECT 'raw/' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '-L-' || CAST(o_orderkey AS VARCHAR)
                || '.mcap' AS dest_key FROM orders WHERE o_orderpriority = '1-URGENT'),
p AS (SELECT key, substr(key, 1, length(key) - 4) || '.mcap' AS dest_key FROM src)
SELECT key, dest_key FROM p WHERE dest_key NOT IN (SELECT dest_key FROM done)"""


def sql_topic_base(t: str) -> str:
    m = sql_multi_id_or_null(t)
    return f"CASE WHEN {m} IS NOT NULL THEN regexp_extract({t}, '^(.*)_(\\+?[0-9]+)$', 1) ELSE {t} END"


def sql_multi_id_or_null(t: str) -> str:
    v = f"TRY_CAST(regexp_extract({t}, '^(.*)_(\\+?[0-9]+)$', 2) AS INTEGER)"
    return f"(CASE WHEN regexp_matches({t}, '^(.*)_(\\+?[0-9]+)$') AND {v} BETWEEN 0 AND 255 THEN {v} END)"


def sql_multi_id(t: str) -> str:
    return f"COALESCE({sql_multi_id_or_null(t)}, 0)"


TOPIC_NAMES = """
    SELECT event_id AS ordinal,
           CASE WHEN event_type IN ('click', 'purchase') THEN event_type || '_' || CAST(user_id AS VARCHAR)
                WHEN event_type = 'error' THEN 'sensor_' || event_type || '_' || CAST(event_id AS VARCHAR)
                WHEN event_type = 'view' THEN event_type || '_messages'
                ELSE '_' || CAST(user_id AS VARCHAR) END AS topic
    FROM events"""

ORACLE_SQL["topic_split"] = f"""
WITH t AS ({TOPIC_NAMES})
SELECT ordinal, topic, {sql_topic_base('topic')} AS base_topic, {sql_multi_id('topic')} AS multi_id FROM t"""

ORACLE_SQL["topic_compose"] = f"""
WITH t AS (SELECT event_id AS ordinal, event_type || '_' || CAST(CAST(user_id AS INTEGER) AS VARCHAR) AS topic FROM events)
SELECT ordinal, topic, {sql_topic_base('topic')} AS base_topic, {sql_multi_id('topic')} AS multi_id FROM t"""

_PATHS = """
    SELECT o_orderkey AS ordinal,
           'store://logs/' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '-L-' || CAST(o_orderkey AS VARCHAR)
           || CASE WHEN o_orderstatus = 'O' THEN '.mcap.mcap' ELSE '.mcap' END AS path
    FROM orders"""
_MCAP_ID = "regexp_replace(regexp_extract(path, '[^/]*$'), '(\\.mcap)+$', '')"

ORACLE_SQL["names_from_paths"] = f"""
WITH p AS ({_PATHS})
SELECT ordinal, {_MCAP_ID} AS mcap_id, {sql_log_id_from_stem(_MCAP_ID)} AS log_id,
       CAST(strptime(substr(regexp_extract(path, '[^/]*$'), 1, 10), '%Y-%m-%d') AS DATE) AS log_date,
       CAST(CAST(strptime(substr(regexp_extract(path, '[^/]*$'), 1, 10), '%Y-%m-%d') AS DATE) - DATE '1970-01-01' AS INTEGER) AS log_day
FROM p"""

ORACLE_SQL["log_id_from_name"] = f"""
WITH s AS (SELECT o_orderkey AS ordinal,
                  CASE WHEN o_orderstatus = 'P' THEN 'L-' || CAST(o_orderkey AS VARCHAR)
                       ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '-L-' || CAST(o_orderkey AS VARCHAR) END AS stem
           FROM orders)
SELECT ordinal, stem, {sql_log_id_from_stem('stem')} AS log_id FROM s"""

ORACLE_SQL["standard_columns"] = f"""
WITH m AS (
    SELECT {FLIGHT_ID} AS mcap_id, CAST(ts AS DATE) AS log_date, event_type || '_0' AS topic,
           date_diff('microsecond', CAST(CAST(ts AS DATE) AS TIMESTAMP), ts) * 1000 + 999 AS ns,
           event_id AS ordinal, value
    FROM events)
SELECT CAST(log_date AS TIMESTAMP) + to_microseconds(ns // 1000) AS log_time,
       CAST(log_date AS TIMESTAMP) + to_microseconds(ns // 1000) AS publish_time,
       CAST(0 AS BIGINT) AS sequence, mcap_id, {sql_multi_id('topic')} AS multi_id,
       ns // 1000 AS offset_us, log_date, 'log_date' AS time_source,
       {sql_topic_base('topic')} AS base_topic, ordinal, value
FROM m"""

ORACLE_SQL["sec_nsec"] = """
WITH s AS (SELECT event_id AS ordinal, date_diff('microsecond', TIMESTAMP '2024-01-15 00:00:00', ts) AS ts_us FROM events)
SELECT ordinal, ts_us, (ts_us - ((ts_us % 1000000 + 1000000) % 1000000)) // 1000000 AS sec,
       ((ts_us % 1000000 + 1000000) % 1000000) * 1000 AS nsec, ts_us * 1000 AS ts_ns
FROM s"""

_LEVEL_CASE = """CASE source_level WHEN 'EMERGENCY' THEN 'FATAL' WHEN 'ALERT' THEN 'FATAL' WHEN 'CRITICAL' THEN 'FATAL'
    WHEN 'ERROR' THEN 'ERROR' WHEN 'WARNING' THEN 'WARNING' WHEN 'NOTICE' THEN 'INFO' WHEN 'INFO' THEN 'INFO'
    WHEN 'DEBUG' THEN 'DEBUG' ELSE 'UNKNOWN' END"""
_RANK_CASE = """CASE level WHEN 'UNKNOWN' THEN 0 WHEN 'DEBUG' THEN 1 WHEN 'INFO' THEN 2 WHEN 'WARNING' THEN 3
    WHEN 'ERROR' THEN 4 WHEN 'FATAL' THEN 5 ELSE 0 END"""

ORACLE_SQL["level_remap"] = f"""
WITH s AS (SELECT event_id AS ordinal,
                  (['EMERGENCY','ALERT','CRITICAL','ERROR','WARNING','NOTICE','INFO','DEBUG','WEIRD'])[event_id % 9 + 1]
                  AS source_level FROM events),
l AS (SELECT ordinal, source_level, {_LEVEL_CASE} AS level FROM s)
SELECT ordinal, source_level, level, {_RANK_CASE} AS level_rank, ({_RANK_CASE}) >= 1 AS shown FROM l"""

ORACLE_SQL["enum_label"] = f"""
WITH vs AS ({VEHICLE_STATUS})
SELECT ordinal, nav_state,
       CASE nav_state WHEN 0 THEN 'MANUAL' WHEN 1 THEN 'ALTCTL' WHEN 2 THEN 'POSCTL' WHEN 3 THEN 'AUTO_MISSION'
                      WHEN 4 THEN 'AUTO_LOITER' WHEN 5 THEN 'AUTO_RTL'
                      ELSE 'UNKNOWN_' || CAST(nav_state AS VARCHAR) END AS nav_state_label
FROM vs"""

ORACLE_SQL["format_duration_cases"] = f"""
SELECT event_id AS ordinal, {fmt_duration("ts - CAST(CAST(ts AS DATE) AS TIMESTAMP)")} AS duration FROM events"""

_CONV_LOGS = """
    SELECT 'conv-' || CAST(conv_id AS VARCHAR) AS mcap_id, CAST(floor(turn / 2) * 1000000 AS BIGINT) AS ts_us,
           turn AS ordinal, CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 ELSE 2 END AS tag, text AS message,
           CASE role WHEN 'system' THEN 'NOTICE' WHEN 'user' THEN 'INFO' ELSE 'WARNING' END AS source_level
    FROM conversations"""

ORACLE_SQL["log_messages"] = f"""
WITH l AS ({_CONV_LOGS}),
f AS (SELECT mcap_id, tag, min(ordinal) AS tag_first FROM l GROUP BY 1, 2)
SELECT mcap_id, ts_us, ordinal, message, {_LEVEL_CASE} AS level, CAST(tag AS VARCHAR) AS name, '' AS file,
       CAST(0 AS BIGINT) AS line, ts_us // 1000000 AS ts_sec, (ts_us % 1000000) * 1000 AS ts_nsec,
       row_number() OVER (PARTITION BY mcap_id ORDER BY ts_us, tag_first, ordinal) AS seq
FROM l JOIN f USING (mcap_id, tag)"""

ORACLE_SQL["parameter_split"] = """
WITH p AS (
    SELECT p_brand AS mcap_id, p_partkey AS timestamp, 'P_SIZE' AS name, CAST(p_size AS VARCHAR) AS value FROM part
    UNION ALL
    SELECT p_brand, p_partkey, 'P_PRICE', CAST(p_retailprice AS VARCHAR) FROM part)
SELECT mcap_id, timestamp, name,
       CASE WHEN regexp_matches(value, '^[+-]?[0-9]+$') THEN CAST(value AS BIGINT) END AS int_value,
       CASE WHEN NOT regexp_matches(value, '^[+-]?[0-9]+$') THEN CAST(value AS DOUBLE) END AS float_value
FROM p"""

ORACLE_SQL["payload_decode"] = """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"""

ORACLE_SQL["metadata_map"] = """
WITH kv AS (
    SELECT p_partkey AS mcap_id, 'name' AS key, p_name AS value FROM part
    UNION ALL SELECT p_partkey, 'brand', p_brand FROM part
    UNION ALL SELECT p_partkey, 'size', CAST(p_size AS VARCHAR) FROM part
    UNION ALL SELECT p_partkey, 'retailprice', CAST(p_retailprice AS VARCHAR) FROM part
    UNION ALL SELECT p_partkey, 'ver_sw', p_type FROM part WHERE p_size > 25)
SELECT mcap_id, COALESCE(max(CASE WHEN key = 'ver_sw' THEN value END) OVER (PARTITION BY mcap_id), 'unknown') AS ver_sw,
       key, value
FROM kv"""

ORACLE_SQL["samples_to_rows"] = """
WITH z AS (SELECT label, vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
SELECT 'embedding_' || CAST(label AS VARCHAR) AS topic, vec_id * 1000 + i AS timestamp,
       v AS "control[0]", -v AS "control[1]"
FROM z"""

_SOURCE_TYPES_ALL = ("['int8_t','int16_t','int32_t','int64_t','uint8_t','uint16_t','uint32_t','uint64_t','float',"
                     "'double','bool','char']")

FIELD_ROWS = f"""
    SELECT mcap_id, topic, ordinal, field, type FROM (
        SELECT 'log-' || CAST(l_orderkey // 40 AS VARCHAR) AS mcap_id, 'order_' || CAST(l_orderkey % 40 AS VARCHAR) AS topic, l_linenumber, CAST(l_linenumber - 1 AS VARCHAR) AS ln,
               l_returnflag AS rf, l_linestatus AS ls, l_partkey, l_suppkey FROM lineitem) b,
    LATERAL (
        SELECT CAST((l_linenumber - 1) * 10 + 0 AS BIGINT) AS ordinal, 'esc[' || ln || '].rpm' AS field,
               {_SOURCE_TYPES_ALL}[l_partkey % 12 + 1] AS type
        UNION ALL
        SELECT (l_linenumber - 1) * 10 + 1, CASE WHEN rf = 'R' THEN 'name[' || ln || ']' ELSE 'control[' || ln || ']' END,
               CASE WHEN rf = 'R' THEN 'char' ELSE 'float' END
        UNION ALL
        SELECT (l_linenumber - 1) * 10 + 2,
               CASE WHEN ls = 'O' THEN 'esc[' || ln || '].label[' || CAST(l_suppkey % 3 AS VARCHAR) || ']'
                    WHEN rf = 'A' THEN 'esc[' || ln || '].current[0]'
                    WHEN rf = 'N' THEN 'esc[' || ln || ']._padding0[1]'
                    ELSE 'outer[' || ln || '].inner.x' END,
               CASE WHEN ls = 'O' THEN 'char' WHEN rf = 'A' THEN 'float' WHEN rf = 'N' THEN 'uint8_t' ELSE 'int16_t' END
        UNION ALL
        SELECT (l_linenumber - 1) * 10 + 3, CASE WHEN l_linenumber = 1 THEN 'timestamp' ELSE 'gps.fix[' || ln || ']' END,
               CASE WHEN l_linenumber = 1 THEN 'uint64_t' ELSE 'int8_t' END
    ) f"""

ORACLE_SQL["topic_fields"] = f"""
WITH f AS ({FIELD_ROWS})
SELECT mcap_id, topic, string_agg(field || ':' || type, ',' ORDER BY ordinal, field, type) AS fields FROM f GROUP BY mcap_id, topic"""

ORACLE_SQL["schema_registry"] = """
WITH c AS (SELECT 'log-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS mcap_id, event_type || '_' || CAST(user_id AS VARCHAR) AS topic,
                  event_type AS type_name, event_id AS ordinal FROM events)
SELECT mcap_id, type_name, arg_min(topic, ordinal) AS first_topic, min(ordinal) AS first_ordinal,
       count(DISTINCT topic) AS n_instances
FROM c GROUP BY mcap_id, type_name"""

_SR = "'^(.+?)\\[([0-9]+)\\]\\.(.+)$'"
_AR = "'^(.*)\\[([0-9]+)\\]$'"
CLASSIFIED = f"""
    SELECT mcap_id, topic, ordinal, field, type, is_struct, is_flat,
           CASE WHEN is_struct THEN s_base WHEN is_flat THEN f_base ELSE field END AS base,
           CASE WHEN is_struct THEN CASE WHEN leaf_is_array THEN leaf_base ELSE s_leaf END END AS leaf,
           CASE WHEN is_struct AND leaf_is_array THEN 'text_array' WHEN is_struct THEN 'array'
                WHEN is_flat AND type = 'char' THEN 'text' WHEN is_flat THEN 'array' ELSE 'scalar' END AS row_kind,
           CASE WHEN is_struct THEN s_idx + 1 WHEN is_flat AND type <> 'char' THEN f_idx + 1 END AS outer_cand,
           CASE WHEN is_struct AND leaf_is_array THEN leaf_idx + 1 WHEN is_flat AND type = 'char' THEN f_idx + 1 END
               AS inner_cand,
           CASE WHEN is_struct AND contains(s_leaf, '.') THEN 'nested_deeper'
                WHEN is_struct AND leaf_is_array AND type <> 'char' THEN 'numeric_array_in_struct' END AS drop_reason,
           CASE WHEN is_struct AND contains(s_leaf, '.') THEN true
                WHEN is_struct AND leaf_is_array AND type <> 'char' THEN NOT contains(s_leaf, 'padding') END AS warn
    FROM (
        SELECT *, regexp_matches(s_leaf, {_AR}) AS leaf_is_array,
               regexp_extract(s_leaf, {_AR}, 1) AS leaf_base,
               TRY_CAST(regexp_extract(s_leaf, {_AR}, 2) AS INTEGER) AS leaf_idx
        FROM (
            SELECT *, regexp_matches(field, {_SR}) AS is_struct,
                   regexp_extract(field, {_SR}, 1) AS s_base,
                   TRY_CAST(regexp_extract(field, {_SR}, 2) AS INTEGER) AS s_idx,
                   regexp_extract(field, {_SR}, 3) AS s_leaf,
                   NOT regexp_matches(field, {_SR}) AND regexp_matches(field, {_AR}) AS is_flat,
                   regexp_extract(field, {_AR}, 1) AS f_base,
                   TRY_CAST(regexp_extract(field, {_AR}, 2) AS INTEGER) AS f_idx
            FROM fr))"""

_WIRE = """CASE t WHEN 'int8_t' THEN 'int32' WHEN 'int16_t' THEN 'int32' WHEN 'int32_t' THEN 'int32'
    WHEN 'int64_t' THEN 'int64' WHEN 'uint8_t' THEN 'uint32' WHEN 'uint16_t' THEN 'uint32' WHEN 'uint32_t' THEN 'uint32'
    WHEN 'uint64_t' THEN 'uint64' WHEN 'float' THEN 'float' WHEN 'double' THEN 'double' WHEN 'bool' THEN 'bool'
    WHEN 'char' THEN 'string' END"""
_TABLE = """CASE w WHEN 'int32' THEN 'bigint' WHEN 'int64' THEN 'bigint' WHEN 'uint32' THEN 'bigint'
    WHEN 'uint64' THEN 'bigint' WHEN 'float' THEN 'double' WHEN 'double' THEN 'double' WHEN 'bool' THEN 'boolean'
    WHEN 'string' THEN 'string' END"""

ORACLE_SQL["field_classify"] = f"""
WITH fr AS ({FIELD_ROWS}), c AS ({CLASSIFIED}),
g AS (
    SELECT mcap_id, topic, base, leaf, min(ordinal) AS position,
           first(row_kind ORDER BY ordinal, list_position({_SOURCE_TYPES_ALL}, type),
                 list_position(['scalar', 'array', 'text', 'text_array'], row_kind)) AS kind,
           first(type ORDER BY ordinal, list_position({_SOURCE_TYPES_ALL}, type),
                 list_position(['scalar', 'array', 'text', 'text_array'], row_kind)) AS source_type,
           COALESCE(max(outer_cand), 1) AS outer_len, COALESCE(max(inner_cand), 1) AS inner_len
    FROM c WHERE drop_reason IS NULL GROUP BY mcap_id, topic, base, leaf),
w AS (SELECT *, CASE WHEN kind IN ('text', 'text_array') THEN 'string' ELSE {_WIRE.replace('CASE t', 'CASE source_type')} END
              AS wire_type FROM g)
SELECT mcap_id, topic, position, replace(CASE WHEN leaf IS NULL THEN base ELSE base || '__' || leaf END, '.', '_') AS column_name,
       base, leaf, kind, source_type, wire_type,
       CASE WHEN kind IN ('array', 'text_array') THEN 'array<' || {_TABLE.replace('CASE w', 'CASE wire_type')} || '>'
            ELSE {_TABLE.replace('CASE w', 'CASE wire_type')} END AS table_type,
       outer_len, inner_len
FROM w"""

ORACLE_SQL["field_drops"] = f"""
WITH fr AS ({FIELD_ROWS}), c AS ({CLASSIFIED})
SELECT mcap_id, topic, ordinal, field, type, drop_reason, warn FROM c WHERE drop_reason IS NOT NULL"""

ORACLE_SQL["pack_arrays"] = """
WITH z AS (SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS flag,
                  [l_quantity, l_extendedprice, l_discount, l_tax] AS m FROM lineitem)
SELECT l_orderkey, l_linenumber, flag, CAST(generate_subscripts(m, 1) - 1 AS INTEGER) AS pos, unnest(m) AS m FROM z"""

ORACLE_SQL["struct_array_transpose"] = """
WITH z AS (SELECT l_orderkey, l_linenumber, [l_quantity, CAST(l_linenumber AS DOUBLE)] AS esc__rpm,
                  [l_tax, l_discount] AS esc__temp, [l_partkey, l_suppkey] AS motors__id,
                  [l_suppkey, l_partkey] AS motors__sid FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(generate_subscripts(esc__rpm, 1) - 1 AS INTEGER) AS pos,
       unnest(esc__rpm) AS esc__rpm, unnest(esc__temp) AS esc__temp, unnest(motors__id) AS motors__id,
       unnest(motors__sid) AS motors__sid
FROM z"""

ORACLE_SQL["char_text"] = "SELECT conv_id, turn, text FROM conversations"

ORACLE_SQL["char_text_array"] = """
SELECT conv_id, turn, CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_lines, text FROM conversations"""

POSITION_SAMPLES = """
    SELECT 'flight-' || CAST(label AS VARCHAR) AS mcap_id, CASE WHEN vec_id % 5 = 4 THEN 1 ELSE 0 END AS multi_id,
           (vec_id * 1000 + i) * 7919 % 100003 * 1000 AS timestamp, vec_id * 1000 + i AS ordinal,
           CASE WHEN vec_id % 7 = 0 THEN 'NaN'::DOUBLE ELSE CAST(embedding[3 * i + 1] AS DOUBLE) END AS x,
           CAST(embedding[3 * i + 2] AS DOUBLE) AS y, CAST(embedding[3 * i + 3] AS DOUBLE) AS z
    FROM (SELECT *, unnest(range((len(embedding) + 2) // 3)) AS i FROM embeddings)"""
_VALID = "multi_id = 0 AND x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL AND NOT isnan(x) AND NOT isnan(y) AND NOT isnan(z)"

ORACLE_SQL["trajectory_points"] = f"""
WITH s AS ({POSITION_SAMPLES})
SELECT mcap_id, row_number() OVER (PARTITION BY mcap_id ORDER BY ordinal) AS point_idx, timestamp,
       y AS x, x AS y, -z AS z
FROM s WHERE {_VALID}"""

ORACLE_SQL["trajectory_first_ts"] = f"""
WITH s AS ({POSITION_SAMPLES})
SELECT mcap_id, arg_min(timestamp, ordinal) AS first_ts, count(*) AS n_points,
       'trajectory' AS entity_id, 'local_origin' AS frame_id, 'LINE_STRIP' AS line_type, 2.0::DOUBLE AS thickness,
       true AS scale_invariant, 1.0::DOUBLE AS color_r, 0.55::DOUBLE AS color_g, 0.0::DOUBLE AS color_b,
       1.0::DOUBLE AS color_a, 0 AS lifetime_sec, 0 AS lifetime_nsec, 0.0::DOUBLE AS pose_x, 0.0::DOUBLE AS pose_y,
       0.0::DOUBLE AS pose_z, 0.0::DOUBLE AS orient_x, 0.0::DOUBLE AS orient_y, 0.0::DOUBLE AS orient_z,
       1.0::DOUBLE AS orient_w
FROM s WHERE {_VALID} GROUP BY mcap_id"""

ORACLE_SQL["merge_streams"] = """
WITH u AS (
    SELECT 'f' || CAST(user_id AS VARCHAR) AS mcap_id, event_type || '_0' AS topic,
           date_diff('microsecond', TIMESTAMP '1970-01-01 00:00:00', ts) AS ts_us, 0 AS stream,
           CAST(0 AS BIGINT) AS sub_ord, event_id AS row_ord, props AS payload FROM events
    UNION ALL
    SELECT 'f' || CAST(page_id % 500 AS VARCHAR), 'log', page_id * 1000, 1, 0, page_id, url FROM pages
    UNION ALL
    SELECT 'f' || CAST(conv_id AS VARCHAR), 'logged_messages', turn * 1000000, 2, 0, turn, text FROM conversations
    UNION ALL
    SELECT 'f' || CAST(o_custkey AS VARCHAR), 'parameter_changes',
           date_diff('microsecond', TIMESTAMP '1970-01-01 00:00:00', o_orderdate), 3, 0, o_orderkey, o_orderpriority
    FROM orders
    UNION ALL
    SELECT 'f' || CAST(label AS VARCHAR), 'trajectory', min(vec_id * 1000), 4, 0, 0, CAST(count(*) AS VARCHAR)
    FROM embeddings GROUP BY label)
SELECT mcap_id, row_number() OVER (PARTITION BY mcap_id ORDER BY ts_us, stream, sub_ord, row_ord) AS seq,
       ts_us, topic, stream, sub_ord, row_ord, payload, ts_us * 1000 AS log_time_ns, ts_us * 1000 AS publish_time_ns
FROM u"""

_EARLY = "ts < TIMESTAMP '2024-01-16 00:00:00'"
_LATE = "ts >= TIMESTAMP '2024-01-16 00:00:00'"

ORACLE_SQL["union_missing"] = f"""
SELECT {FLIGHT_ID} AS mcap_id, ts AS log_time, event_id AS ordinal, value, CAST(NULL AS BIGINT) AS k
FROM events WHERE {_EARLY}
UNION ALL
SELECT {FLIGHT_ID}, ts, event_id, value, CAST(json_extract_string(props, '$.k') AS BIGINT) FROM events WHERE {_LATE}"""

ORACLE_SQL["type_conflict_sibling"] = f"""
SELECT {FLIGHT_ID} AS mcap_id, ts AS log_time, event_id AS ordinal,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value,
       CAST(NULL AS VARCHAR) AS k__as_str, CAST(NULL AS BIGINT) AS extra
FROM events WHERE {_EARLY}
UNION ALL
SELECT {FLIGHT_ID}, ts, event_id, NULL, CAST(CAST(value AS FLOAT) AS DOUBLE), json_extract_string(props, '$.k'),
       CAST(user_id AS BIGINT)
FROM events WHERE {_LATE}"""

ORACLE_SQL["supported_fields"] = "SELECT event_id, value, event_type AS tag, 3 AS n_columns FROM events"

ORACLE_SQL["descriptor_check"] = f"""
WITH c AS (SELECT {FLIGHT_ID} AS mcap_id, event_type || '_' || CAST(user_id AS VARCHAR) AS topic,
                  event_type AS schema_name FROM events)
SELECT mcap_id, {sql_topic_base('topic')} AS base_topic, count(*) AS n_messages,
       count(DISTINCT schema_name) AS n_descriptors, min(schema_name) AS schema_name,
       count(DISTINCT schema_name) = 1 AS ok
FROM c GROUP BY 1, 2"""

ORACLE_SQL["topic_counts"] = """
SELECT event_type || '_' || CAST(user_id AS VARCHAR) AS topic, count(*) AS n_messages FROM events GROUP BY 1"""

ORACLE_SQL["partitioned_append"] = ORACLE_SQL["standard_columns"]

ORACLE_SQL["catalog_json"] = f"WITH c AS ({LOG_CATALOG}) SELECT {CATALOG_COLS} FROM c"

ORACLE_SQL["state_transitions"] = f"""
WITH vs AS ({VEHICLE_STATUS}),
r AS (
    SELECT mcap_id, multi_id, log_time, ordinal, 'nav_state' AS state, CAST(nav_state AS VARCHAR) AS value,
           CASE nav_state WHEN 0 THEN 'MANUAL' WHEN 1 THEN 'ALTCTL' WHEN 2 THEN 'POSCTL' WHEN 3 THEN 'AUTO_MISSION'
                WHEN 4 THEN 'AUTO_LOITER' WHEN 5 THEN 'AUTO_RTL' ELSE 'UNKNOWN_' || CAST(nav_state AS VARCHAR) END AS label
    FROM vs
    UNION ALL
    SELECT mcap_id, multi_id, log_time, ordinal, 'arming_state', CAST(arming_state AS VARCHAR),
           CASE arming_state WHEN 1 THEN 'Disarmed' WHEN 2 THEN 'Armed' ELSE 'UNKNOWN_' || CAST(arming_state AS VARCHAR) END
    FROM vs
    UNION ALL
    SELECT mcap_id, multi_id, log_time, ordinal, 'failsafe', lower(CAST(failsafe AS VARCHAR)),
           CASE WHEN failsafe THEN 'True' ELSE 'False' END
    FROM vs),
p AS (SELECT *, row_number() OVER w AS sample_seq, lag(value) OVER w AS prev_value FROM r
      WINDOW w AS (PARTITION BY mcap_id, multi_id, state ORDER BY log_time, ordinal)),
c AS (SELECT * FROM p WHERE sample_seq = 1 OR value IS DISTINCT FROM prev_value),
s AS (SELECT *, row_number() OVER w2 AS segment, lead(log_time) OVER w2 AS end_time FROM c
      WINDOW w2 AS (PARTITION BY mcap_id, multi_id, state ORDER BY log_time, ordinal)),
t0 AS (SELECT mcap_id, multi_id, min(log_time) AS t0 FROM vs GROUP BY 1, 2)
SELECT mcap_id, multi_id, state, segment, value, label, log_time AS start_time, end_time,
       date_diff('microsecond', t0, log_time) AS rel_start_us
FROM s JOIN t0 USING (mcap_id, multi_id)"""

POSITION_FULL = """
    SELECT 'flight-' || CAST(label AS VARCHAR) AS mcap_id, CASE WHEN vec_id % 5 = 4 THEN 1 ELSE 0 END AS multi_id,
           TIMESTAMP '2024-01-01 00:00:00' + to_seconds(vec_id * 1000 + i) AS log_time,
           CAST(embedding[6 * i + 1] AS DOUBLE) AS x, CAST(embedding[6 * i + 2] AS DOUBLE) AS y,
           CAST(embedding[6 * i + 3] AS DOUBLE) AS z, CAST(embedding[6 * i + 4] AS DOUBLE) AS vx,
           CAST(embedding[6 * i + 5] AS DOUBLE) AS vy, CAST(embedding[6 * i + 6] AS DOUBLE) AS vz
    FROM (SELECT *, unnest(range((len(embedding) + 5) // 6)) AS i FROM embeddings)"""

ORACLE_SQL["series_xy"] = f"WITH p AS ({POSITION_FULL}) SELECT mcap_id, log_time, x, y FROM p WHERE multi_id = 0"

ORACLE_SQL["series_height"] = f"WITH p AS ({POSITION_FULL}) SELECT mcap_id, log_time, -z AS height FROM p WHERE multi_id = 0"

ORACLE_SQL["series_xy_height"] = f"""
WITH p AS ({POSITION_FULL}) SELECT mcap_id, log_time, x, y, -z AS height FROM p WHERE multi_id = 0"""

ORACLE_SQL["series_velocity"] = f"""
WITH p AS ({POSITION_FULL}) SELECT mcap_id, log_time, -vz AS z, y, vx AS x FROM p WHERE multi_id = 0"""

ORACLE_SQL["series_battery"] = """
SELECT 'order-' || CAST(l_orderkey AS VARCHAR) AS mcap_id, l_shipdate AS log_time, l_extendedprice / 1000 AS voltage_v,
       l_discount AS remaining, l_quantity AS current_a,
       CAST(round(l_tax * 100) AS BIGINT) * CAST(3.3 AS DOUBLE) AS low_voltage_v
FROM lineitem WHERE l_linenumber - 1 = 0"""

RUN_LOG = """
    SELECT l_returnflag AS batch, CASE WHEN l_linestatus = 'O' THEN 'skipped' ELSE 'converted' END AS outcome,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS in_bytes, CAST(round(l_quantity * 1000) AS BIGINT) AS out_bytes,
           l_tax AS read_seconds, l_discount AS transform_seconds, l_tax AS write_seconds
    FROM lineitem"""


def _rate(mb: str, sec: str) -> str:
    return f"CASE WHEN {sec} > 0 THEN {mb} / {sec} ELSE 0.0 END"


ORACLE_SQL["run_stats"] = f"""
WITH r AS ({RUN_LOG}),
g AS (SELECT batch, count(*) AS n_files, CAST(sum(in_bytes) AS BIGINT) AS in_bytes,
             CAST(sum(out_bytes) AS BIGINT) AS out_bytes, sum(read_seconds) AS rs, sum(transform_seconds) AS ts,
             sum(write_seconds) AS ws FROM r GROUP BY batch)
SELECT batch, n_files, in_bytes, out_bytes,
       round({_rate('in_bytes / 1048576.0', 'ts')}, 6) AS transform_mb_s,
       round({_rate('in_bytes / 1048576.0', 'rs')}, 6) AS read_mb_s,
       round({_rate('out_bytes / 1048576.0', 'ws')}, 6) AS write_mb_s,
       round(CASE WHEN in_bytes <> 0 THEN out_bytes / in_bytes END, 6) AS ratio,
       round(rs + ts + ws, 6) AS wall_seconds
FROM g"""

ORACLE_SQL["convert_stats"] = f"""
WITH r AS ({RUN_LOG}),
g AS (SELECT batch, count(*) FILTER (WHERE outcome = 'skipped') AS n_skipped,
             count(*) FILTER (WHERE outcome <> 'skipped') AS n_converted,
             CAST(sum(CASE WHEN outcome <> 'skipped' THEN in_bytes END) AS BIGINT) AS in_bytes,
             CAST(sum(CASE WHEN outcome <> 'skipped' THEN out_bytes END) AS BIGINT) AS out_bytes,
             sum(CASE WHEN outcome <> 'skipped' THEN transform_seconds END) AS ts
      FROM r GROUP BY batch)
SELECT batch, n_skipped, n_converted, in_bytes, out_bytes,
       round({_rate('in_bytes / 1048576.0', 'ts')}, 6) AS transform_mb_s,
       round(CASE WHEN in_bytes <> 0 THEN out_bytes / in_bytes END, 6) AS ratio
FROM g"""

ORACLE_SQL["run_outcomes"] = f"WITH r AS ({RUN_LOG}) SELECT outcome, count(*) AS n FROM r GROUP BY outcome"

ORACLE_SQL["flights_sample"] = f"SELECT * FROM ({ORACLE_SQL['flights_overview']}) ORDER BY start_time, mcap_id LIMIT 5"

# The ingest job re-anchors the envelope times to the original timestamps, so the curated
# view over the written lake equals the flight overview computed from the source rows.
ORACLE_SQL["lake_flights"] = ORACLE_SQL["flights_overview"]

ORACLE_SQL["stream_lake_flights"] = ORACLE_SQL["flights_overview"]


ORACLE_SQL["ingest_replay"] = ORACLE_SQL["flights_overview"]

ORACLE_SQL["ingest_split_flight"] = ORACLE_SQL["flights_overview"]

ORACLE_SQL["ingest_two_firmwares"] = f"""
WITH v AS ({VEHICLE_STATUS}), s AS (SELECT *, log_date >= DATE '2024-01-16' AS new FROM v)
SELECT mcap_id, log_time, arming_state, CASE WHEN NOT new THEN nav_state END AS nav_state,
       CASE WHEN new THEN CAST(nav_state AS DOUBLE) + 0.5 END AS nav_state__as_f64,
       CASE WHEN new THEN failsafe END AS failsafe FROM s"""

ORACLE_SQL["file_manifest"] = f"""
SELECT base_topic, log_date, CAST(count(*) AS BIGINT) AS n_rows FROM ({ORACLE_SQL['standard_columns']}) GROUP BY 1, 2"""

ORACLE_SQL["lake_reset"] = f"""
SELECT base_topic, mcap_id, count(*) AS n_rows, count(DISTINCT log_date) AS n_days
FROM ({ORACLE_SQL['standard_columns']}) WHERE base_topic = 'click' GROUP BY 1, 2"""

ORACLE_SQL["topic_table_sql"] = f"""
SELECT log_date, count(*) AS n_rows, min(ordinal) AS first_ordinal
FROM ({ORACLE_SQL['standard_columns']}) WHERE base_topic = 'click' GROUP BY 1"""

ORACLE_SQL["catalog_json_array"] = f"WITH c AS ({LOG_CATALOG}) SELECT log_id, log_date, mav_type, source FROM c"

ORACLE_SQL["catalog_by_log_id"] = f"""
WITH c AS ({LOG_CATALOG})
SELECT {CATALOG_COLS} FROM c WHERE replace(log_id, '-', '') IN ('L1', 'L2', 'L33', 'L45', 'L1000') ORDER BY log_date DESC, ordinal"""

ORACLE_SQL["catalog_by_uuid"] = f"""
WITH c AS ({LOG_CATALOG})
SELECT {CATALOG_COLS} FROM c WHERE vehicle_uuid IN ('veh-1', 'veh-7', 'VEH-8', 'veh-11') ORDER BY log_date DESC, ordinal"""

ORACLE_SQL["catalog_by_names"] = f"""
WITH c AS ({LOG_CATALOG})
SELECT 'vehicle_name' AS by, log_id FROM c WHERE vehicle_name = 'vehicle-7'
UNION ALL SELECT 'airframe_name', log_id FROM c WHERE airframe_name = 'airframe-1'
UNION ALL SELECT 'git_hash', log_id FROM c WHERE ver_sw = 'v1996'"""

ORACLE_SQL["held_log_count"] = """
WITH h AS (SELECT count(*) AS n_files FROM orders WHERE o_orderstatus = 'F')
SELECT n_files, gate, closed FROM h, (VALUES ('third', true), ('all', true), ('more', false), ('off', false), ('overwrite', false)) g(gate, closed)"""

ORACLE_SQL["metadata_named"] = """
WITH kv AS (
    SELECT p_brand AS mcap_id, 'info' AS name, 'type' AS key, p_type AS value, p_partkey AS ordinal FROM part
    UNION ALL SELECT p_brand, 'initial_parameters', 'SIZE_' || CAST(p_size AS VARCHAR), p_name, p_partkey FROM part
    UNION ALL SELECT p_brand, 'default_parameters', 'PRICE', CAST(p_retailprice AS VARCHAR), p_partkey FROM part WHERE p_size > 25)
SELECT mcap_id, name, key, arg_max(value, ordinal) AS value FROM kv GROUP BY 1, 2, 3"""

_VIEWS = {"vehicle_status": (VEHICLE_STATUS, 8), "logged_messages": (LOGGED_MESSAGES, 5), "battery_status": (BATTERY_STATUS, 7),
          "error_counts": (ORACLE_SQL["error_counts"], 2), "flights": (ORACLE_SQL["flights_overview"], 6),
          "battery": (ORACLE_SQL["battery_ranges"], 11)}
_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
           "conversations").split()
ORACLE_SQL["catalog_tables"] = " UNION ALL ".join(
    [f"SELECT '{t}' AS name, 'TEMPORARY' AS table_type, true AS is_temporary, "
     f"(SELECT CAST(count(*) AS INTEGER) FROM (DESCRIBE {t})) AS n_columns, (SELECT count(*) FROM {t}) AS n_rows" for t in _TABLES]
    + [f"SELECT '{k}', 'TEMPORARY', true, {n}, (SELECT count(*) FROM ({sql}))" for k, (sql, n) in _VIEWS.items()])

ORACLE_SQL["pack_topic"] = """
SELECT l_orderkey, l_linenumber, l_partkey AS time, l_returnflag || l_linestatus || '/' || l_linestatus AS tags,
       l_quantity AS volt_0, l_tax AS volt_1, l_quantity AS mix_last, l_returnflag || l_returnflag AS unit, 7 AS n_columns
FROM lineitem"""

# ---------------------------------------------------------------- ingest identity, origin, conversion

ORACLE_SQL["ingest_new_checkpoint"] = ORACLE_SQL["flights_overview"]
ORACLE_SQL["flights_folded"] = ORACLE_SQL["flights_overview"]
ORACLE_SQL["battery_folded"] = ORACLE_SQL["battery_ranges"]
ORACLE_SQL["max_altitude_folded"] = ORACLE_SQL["max_altitude"]

ORACLE_SQL["ingest_ten_descriptors"] = f"""
WITH v AS ({VEHICLE_STATUS}), s AS (SELECT *, CAST(right(mcap_id, 1) AS INTEGER) AS k FROM v)
SELECT mcap_id, log_time, arming_state, CASE WHEN k < 5 THEN nav_state END AS nav_state,
       CASE WHEN k >= 5 THEN CAST(nav_state AS DOUBLE) + 0.5 END AS nav_state__as_f64, nav_state * 10 + k AS own, 1 AS n_own FROM s"""

ORACLE_SQL["ingest_run_stats"] = """
SELECT CASE WHEN event_type IN ('click', 'purchase', 'signup') THEN 'vehicle_status' ELSE 'logged_messages' END AS base_topic,
       count(DISTINCT CAST(ts AS DATE) >= DATE '2024-01-16') AS n_batches, count(*) AS rows_written, (SELECT count(*) FROM events) AS rows_in,
       true AS bytes_agree, true AS files_agree, true AS input_agrees, true AS timed
FROM events GROUP BY 1"""

ORACLE_SQL["file_order"] = """
WITH e AS (SELECT event_id AS event, CAST(ts AS DATE) + to_hours(hour(ts)) AS publish_time FROM events)
SELECT event, publish_time, lag(event) OVER (PARTITION BY publish_time ORDER BY event DESC) AS event_before FROM e"""

ORACLE_SQL["u64_wrap"] = """
WITH o AS (SELECT o_orderkey, 9223372036854775806::HUGEINT + o_orderkey % 4 AS c, 18446744073709551613::HUGEINT + o_orderkey % 3 AS m FROM orders)
SELECT o_orderkey, CAST(CASE WHEN c >= 9223372036854775808 THEN c - 18446744073709551616 ELSE c END AS BIGINT) AS counter, CAST(0 AS BIGINT) AS mark_0,
       CAST(m - 18446744073709551616 AS BIGINT) AS mark_1, o_orderkey AS plain FROM o"""

ORACLE_SQL["trajectory_polyline"] = f"""
WITH p AS ({ORACLE_SQL['trajectory_points']}), s AS (SELECT *, (point_idx - 1) // 50 AS segment FROM p)
SELECT mcap_id, segment, first_value(timestamp) OVER w AS first_ts, count(*) OVER (PARTITION BY mcap_id, segment) AS n_points, point_idx, x, y, z
FROM s WINDOW w AS (PARTITION BY mcap_id, segment ORDER BY point_idx)"""


def _json(*parts: tuple[str, str]) -> str:
    """Text of a JSON object: keys with the SQL of their values' texts."""
    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in parts) + " || '}'"


def _text(sql: str) -> str:
    return f"CAST({sql} AS VARCHAR)"


def _quoted(sql: str) -> str:
    return f"CAST(to_json({sql}) AS VARCHAR)"


def _float(sql: str) -> str:
    return _text(f"CAST(CAST({sql} AS FLOAT) AS DOUBLE)")


_LOG_JSON = _json(("ts_sec", _text("ts_us // 1000000")), ("ts_nsec", _text("(ts_us % 1000000) * 1000")), ("level", _quoted("level")),
                  ("message", _quoted("message")), ("name", _quoted("name")), ("file", "'\"\"'"), ("line", "'0'"))
_TS_MOTOR = "l_orderkey * 10 + l_linenumber"
_MOTOR_JSON = _json(("timestamp", _text(_TS_MOTOR)), ("motor__tag", "'[\"' || l_returnflag || l_linestatus || '\",\"' || l_linestatus || '\"]'"),
                    ("motor__volt", f"'[' || {_float('l_quantity')} || ',' || {_float('l_tax')} || ']'"),
                    ("mix", f"'[' || {_float('l_discount')} || ',' || {_float('l_quantity')} || ']'"), ("unit", "'\"' || l_returnflag || l_returnflag || '\"'"))
_STATUS = (("timestamp", _text("event_id * 7")), ("nav_state", _text("CAST(floor(value) % 7 AS BIGINT)")), ("load", _float("floor(value) / 4")))
_COUNTER = ("counter", _text("CASE WHEN event_id % 3 = 0 THEN 9223372036854775807 ELSE CAST(-9223372036854775808 + (event_id % 3 - 1) AS BIGINT) END"))

ORACLE_SQL["convert_flight"] = f"""
WITH tagged AS (
    SELECT 'flight-' || CAST(conv_id % 10 AS VARCHAR) AS mcap_id, CAST(floor(turn / 2) * 1000000 AS BIGINT) AS ts_us, conv_id * 1000 + turn AS ordinal,
           CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 ELSE 2 END AS tag, text AS message,
           CASE role WHEN 'system' THEN 'INFO' WHEN 'user' THEN 'INFO' ELSE 'WARNING' END AS level FROM conversations),
firsts AS (SELECT mcap_id, tag, min(ordinal) AS tag_first FROM tagged GROUP BY 1, 2),
params AS (
    SELECT p_partkey, 'P_SIZE' AS name, CAST(p_size AS VARCHAR) AS value, 0 AS k FROM part
    UNION ALL SELECT p_partkey, 'P_PRICE', CAST(p_retailprice AS VARCHAR), 1 FROM part),
positions AS (SELECT mcap_id, multi_id, timestamp, ordinal, CASE WHEN isnan(x) THEN x ELSE floor(x * 256) END AS x, floor(y * 256) AS y, floor(z * 256) AS z
              FROM ({POSITION_SAMPLES})),
points AS (SELECT mcap_id, row_number() OVER (PARTITION BY mcap_id ORDER BY ordinal) AS i, timestamp, y AS x, x AS y, -z AS z FROM positions WHERE {_VALID}),
u AS (
    SELECT 'flight-' || CAST(l_orderkey % 10 AS VARCHAR) AS mcap_id, 'motor_' || CAST(CAST(floor(l_orderkey / 10 % 2) AS INTEGER) AS VARCHAR) AS topic,
           {_TS_MOTOR} AS ts_us, 0 AS stream, 1 AS sub_ord,
           l_orderkey * 10 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_discount) - 1 AS row_ord, {_MOTOR_JSON} AS payload FROM lineitem
    UNION ALL
    SELECT 'flight-' || CAST(user_id % 10 AS VARCHAR), 'status_0', event_id * 7, 0, 0, event_id,
           CASE WHEN user_id % 2 = 1 THEN {_json(*_STATUS, _COUNTER)} ELSE {_json(*_STATUS)} END FROM events
    UNION ALL
    SELECT 'flight-' || CAST(page_id % 10 AS VARCHAR), 'log', ts_us, 1, 0, page_id, {_LOG_JSON}
    FROM (SELECT page_id, page_id * 1000 AS ts_us, CASE WHEN page_id % 3 = 0 THEN 'ERROR' ELSE 'INFO' END AS level, url AS message, '' AS name FROM pages)
    UNION ALL
    SELECT mcap_id, 'log', ts_us, 2, 0, row_number() OVER (PARTITION BY mcap_id ORDER BY ts_us, tag_first, ordinal), {_LOG_JSON}
    FROM (SELECT *, CAST(tag AS VARCHAR) AS name FROM tagged JOIN firsts USING (mcap_id, tag))
    UNION ALL
    SELECT 'flight-' || CAST(p_partkey % 10 AS VARCHAR), 'parameter_changes', p_partkey, 3, 0, p_partkey * 2 + k,
           '{{"timestamp":' || CAST(p_partkey AS VARCHAR) || ',"name":"' || name || '",' ||
           CASE WHEN regexp_matches(value, '^[+-]?[0-9]+$') THEN '"int_value":' || value ELSE '"float_value":' || value END || '}}' FROM params
    UNION ALL
    SELECT mcap_id, 'trajectory', min(first), 4, 0, (i - 1) // 50,
           '{{"points":[' || string_agg('{{"x":' || CAST(x AS VARCHAR) || ',"y":' || CAST(y AS VARCHAR) || ',"z":' || CAST(z AS VARCHAR) || '}}', ',' ORDER BY i) || ']}}'
    FROM (SELECT *, first_value(timestamp) OVER (PARTITION BY mcap_id ORDER BY i) AS first FROM points) GROUP BY mcap_id, (i - 1) // 50)
SELECT mcap_id, row_number() OVER (PARTITION BY mcap_id ORDER BY ts_us, stream, sub_ord, row_ord) AS seq, ts_us, topic, stream, payload FROM u"""

_STANDARD_TYPES = [("log_time", "timestamp_ntz"), ("publish_time", "timestamp_ntz"), ("sequence", "bigint"), ("mcap_id", "string"), ("multi_id", "int"),
                   ("offset_us", "bigint"), ("time_source", "string")]
_DESCRIBED = {
    "vehicle_status": [*_STANDARD_TYPES, ("arming_state", "bigint"), ("nav_state", "bigint"), ("failsafe", "boolean"), ("log_date", "date")],
    "logged_messages": [*_STANDARD_TYPES, ("level", "string"), ("message", "string"), ("log_date", "date")],
    "error_counts": [("mcap_id", "string"), ("error_count", "bigint")],
    "flights": [("mcap_id", "string"), ("flight_date", "date"), ("start_time", "timestamp_ntz"), ("duration", "string"), ("armed_duration", "string"),
                ("error_count", "bigint")],
}
ORACLE_SQL["catalog_describe"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{t}', '{c}', '{k}')" for t, cols in _DESCRIBED.items() for c, k in cols) + ") d(name, col_name, data_type)"

ORACLE_SQL["lake_metadata"] = ORACLE_SQL["metadata_named"]
