"""The registered queries in SQL, over the tables themselves."""

from __future__ import annotations

_FEED = """
WITH feed AS (
  SELECT c_custkey AS line_no, 'm' || CAST(c_custkey % 3 AS VARCHAR) AS id,
    CASE c_custkey % 3 WHEN 0 THEN 'client1.csv' WHEN 1 THEN 'telephone2.csv' ELSE 'address1.csv' END AS source_file,
    CASE WHEN c_custkey % 10 = 7 THEN c_name || ',1,extra'
         WHEN c_custkey % 10 = 8 THEN c_name
         WHEN c_custkey % 3 = 0 AND c_custkey % 10 = 9 THEN c_name || ',x' || CAST(c_nationkey AS VARCHAR)
         WHEN c_custkey % 3 = 0 THEN c_name || ',' || CAST(c_nationkey AS VARCHAR)
         WHEN c_custkey % 3 = 1 THEN c_name || ',' || CAST(c_custkey AS VARCHAR)
         ELSE c_name || ',' || c_mktsegment END AS line
  FROM customer),
parsed AS (SELECT *, string_split(line, ',') AS f FROM feed),
checked AS (
  SELECT *, CASE
    WHEN len(f) <> 2 THEN 'error_line_index'
    WHEN id = 'm0' AND NOT regexp_full_match(trim(f[2]), '[+-]?[0-9]+') THEN 'error_cast'
    WHEN id = 'm0' AND NOT (3 < TRY_CAST(f[2] AS BIGINT) AND TRY_CAST(f[2] AS BIGINT) < 20)
      THEN 'not in queried partition'
    ELSE '' END AS stacktrace FROM parsed),
ends AS (
  SELECT '2024-01-01 00:00:00' AS "timestamp",
    CASE WHEN count(*) FILTER (WHERE stacktrace <> '') <> 0 THEN 'WARNING' ELSE 'SUCCESS' END AS event,
    count(*) FILTER (WHERE stacktrace = '') AS number_inserted_rows,
    count(*) FILTER (WHERE stacktrace <> '') AS number_rejected_rows,
    id AS message_id
  FROM checked GROUP BY id),
starts AS (
  SELECT DISTINCT '2024-01-01 00:00:00' AS "timestamp", 'START' AS event, CAST(0 AS BIGINT) AS number_inserted_rows,
    CAST(0 AS BIGINT) AS number_rejected_rows, id AS message_id FROM feed),
rejects AS (
  SELECT '2024-01-01 00:00:00' AS "timestamp", stacktrace, source_file,
    '[''' || array_to_string(f, ''', ''') || ''']' AS raw_data,
    CASE id WHEN 'm0' THEN 'age' WHEN 'm1' THEN 'telephone' ELSE 'address' END AS destination
  FROM checked WHERE stacktrace <> '')
"""

_LINES = """
WITH lines AS (
  SELECT l_returnflag AS message_id, l_orderkey, l_linenumber,
    CASE WHEN l_orderkey % 10 = 7 THEN 'error_line_index'
         WHEN l_orderkey % 10 = 8 THEN 'error_cast'
         WHEN NOT (1 < l_linenumber AND l_linenumber < 5.5) THEN 'not in queried partition'
         ELSE '' END AS stacktrace
  FROM lineitem)
"""

_LINES_MONITORING = (
    _LINES
    + """SELECT '2024-01-01 00:00:00' AS "timestamp", 'START' AS event,
      CAST(0 AS BIGINT) AS number_inserted_rows, CAST(0 AS BIGINT) AS number_rejected_rows
    FROM lines GROUP BY message_id
    UNION ALL SELECT '2024-01-01 00:00:00',
      CASE WHEN count(*) FILTER (WHERE stacktrace <> '') <> 0 THEN 'WARNING' ELSE 'SUCCESS' END,
      count(*) FILTER (WHERE stacktrace = ''), count(*) FILTER (WHERE stacktrace <> '')
    FROM lines GROUP BY message_id"""
)

_MONITORING = (
    _FEED
    + """SELECT "timestamp", event, number_inserted_rows, number_rejected_rows FROM starts
    UNION ALL SELECT "timestamp", event, number_inserted_rows, number_rejected_rows FROM ends"""
)

_ROUTED = """
  SELECT event_type AS target, count(*) AS n,
    CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k
  FROM events GROUP BY event_type"""

_ROADS = """
  SELECT CASE event_type WHEN 'click' THEN 'output1' WHEN 'view' THEN 'output2' ELSE 'output3' END AS target,
    count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k
  FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY event_type"""

_TUMBLING_1S = "SELECT date_trunc('second', ts) AS window_start, count(*) AS n FROM events GROUP BY 1"

_HEADER_FREE = _FEED + "SELECT source_file, line FROM feed"

_EXACT = """SELECT line_no, CASE WHEN id = 'm0' THEN 'tabledata2.csv' ELSE source_file END AS source_file, f FROM parsed"""

_EXACT_ROWS = """
SELECT 'colors' AS table_name, c_name AS name, CAST(c_nationkey AS BIGINT) AS age, CAST(c_custkey AS VARCHAR) AS color,
  CAST(NULL AS DOUBLE) AS height FROM customer
UNION ALL SELECT 'heights', c_name, CAST(c_nationkey AS BIGINT), NULL, CAST(c_custkey AS DOUBLE) FROM customer"""

ORACLES = {
    "load_monitoring": _FEED + "SELECT * FROM ends",
    "load_start_events": """
  SELECT CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS "timestamp",
    'START' AS event, CAST(0 AS BIGINT) AS number_inserted_rows, CAST(0 AS BIGINT) AS number_rejected_rows,
    CAST(event_id AS VARCHAR) AS message_id FROM events""",
    "load_valid_client": _FEED
    + """SELECT f[1] AS "NAME", CAST(f[2] AS BIGINT) AS "AGE" FROM checked WHERE id = 'm0' AND stacktrace = ''""",
    "load_valid_telephone": _FEED
    + "SELECT f[1] AS name, f[2] AS number FROM checked WHERE id = 'm1' AND stacktrace = ''",
    "load_valid_address": _FEED
    + "SELECT f[1] AS name, f[2] AS address FROM checked WHERE id = 'm2' AND stacktrace = ''",
    "load_rejects": _FEED + """SELECT "timestamp", stacktrace, source_file, raw_data FROM rejects""",
    "reject_reasons": _FEED
    + """SELECT id AS message_id, stacktrace, count(*) AS n FROM checked
    WHERE stacktrace <> '' GROUP BY id, stacktrace""",
    "line_arity": _FEED + "SELECT id, CAST(len(f) AS BIGINT) AS fields, count(*) AS n FROM parsed GROUP BY id, len(f)",
    "cast_failures": _FEED
    + """SELECT line_no, f[2] AS text,
      CASE WHEN regexp_full_match(trim(f[2]), '[+-]?[0-9]+') THEN TRY_CAST(f[2] AS BIGINT) END AS number,
      NOT regexp_full_match(trim(f[2]), '[+-]?[0-9]+') AS failed
    FROM parsed WHERE len(f) >= 2""",
    "range_predicate": "SELECT n_nationkey, n_name FROM nation WHERE 3 < n_nationkey AND n_nationkey < 20",
    "lineitem_load_monitoring": _LINES
    + """SELECT '2024-01-01 00:00:00' AS "timestamp",
      CASE WHEN count(*) FILTER (WHERE stacktrace <> '') <> 0 THEN 'WARNING' ELSE 'SUCCESS' END AS event,
      count(*) FILTER (WHERE stacktrace = '') AS number_inserted_rows,
      count(*) FILTER (WHERE stacktrace <> '') AS number_rejected_rows, message_id
    FROM lines GROUP BY message_id""",
    "lineitem_reject_reasons": _LINES
    + "SELECT message_id, stacktrace, count(*) AS n FROM lines GROUP BY message_id, stacktrace",
    "bad_file_threshold": """
WITH files AS (
  SELECT c_custkey // 80 AS no,
    CASE (c_custkey // 80) % 3 WHEN 0 THEN 'client' WHEN 1 THEN 'telephone' ELSE 'address' END AS layout,
    CASE WHEN c_custkey % 10 >= 7 + (c_custkey // 80) % 2 THEN 'error_line_index' ELSE '' END AS stacktrace
  FROM customer),
bad AS (SELECT no, count(*) FILTER (WHERE stacktrace <> '') AS n_bad FROM files GROUP BY no)
SELECT layout || CAST(no AS VARCHAR) || '.csv' AS source_file,
  CASE WHEN stacktrace = '' AND n_bad > CASE layout WHEN 'address' THEN 0 ELSE 18 END
       THEN 'too_many_invalid_rows_in_file' ELSE stacktrace END AS stacktrace,
  count(*) AS n
FROM files JOIN bad USING (no) GROUP BY 1, 2""",
    "cogroup_counts": _FEED
    + """, v AS (SELECT id, count(*) AS n FROM checked WHERE stacktrace = '' GROUP BY id),
    r AS (SELECT id, count(*) AS n FROM checked WHERE stacktrace <> '' GROUP BY id)
    SELECT coalesce(v.id, r.id) AS message_id, coalesce(v.n, 0) AS number_inserted_rows,
      coalesce(r.n, 0) AS number_rejected_rows
    FROM v FULL OUTER JOIN r ON v.id = r.id""",
    "message_broadcast_join": _FEED
    + """, messages(message_id, source_file, destination) AS (VALUES ('m0', 'client1.csv', 'age'),
      ('m1', 'telephone2.csv', 'telephone'), ('m2', 'address1.csv', 'address'), ('m3', 'client1.csv', 'address'))
    SELECT source_file, line_no, line, message_id, destination FROM feed JOIN messages USING (source_file)""",
    "list_beside": """SELECT n_nationkey,
      (SELECT string_agg(r_name, '|' ORDER BY r_regionkey) FROM region) AS region_names FROM nation""",
    "unknown_columns": """SELECT c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
      CAST(NULL AS VARCHAR) AS c_phone, c_acctbal FROM customer""",
    "positional_untyped": _FEED
    + f""", named AS ({_EXACT})
    SELECT line_no, source_file, f[1] AS name, f[2] AS age, f[3] AS height FROM named
    WHERE source_file <> 'tabledata2.csv'""",
    "positional_untyped_exact": _FEED
    + f""", named AS ({_EXACT})
    SELECT line_no, source_file, f[1] AS name, f[2] AS age, f[3] AS color FROM named
    WHERE source_file = 'tabledata2.csv'""",
    "json_payload_parse": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      json_extract_string(props, '$.k') AS k_text FROM events""",
    "message_validation": """
WITH m AS (SELECT event_id, '{"fileURL": "s3://in/client' || CAST(event_id AS VARCHAR) || '.csv", "destination": "age"' AS head
           FROM events),
v AS (SELECT event_id, CASE event_id % 6
    WHEN 0 THEN head || '}'
    WHEN 1 THEN head || ', "extra": 1}'
    WHEN 2 THEN '{"fileURL": "s3://in/client' || CAST(event_id AS VARCHAR) || '.csv"}'
    WHEN 3 THEN '{"fileURL": ' || CAST(event_id AS VARCHAR) || ', "destination": "age"}'
    WHEN 4 THEN head
    ELSE head || ', "partition_depth": [1, ' || CAST(event_id AS VARCHAR) || '], "partition_key": "AGE"}' END AS value
  FROM m),
j AS (SELECT event_id, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS doc FROM v)
SELECT CAST(event_id AS VARCHAR) AS message_id,
  CASE WHEN doc IS NOT NULL AND json_type(doc, '$.fileURL') = 'VARCHAR' AND json_type(doc, '$.destination') = 'VARCHAR'
    AND list_has_all(['fileURL', 'destination', 'partition_depth', 'partition_key'], json_keys(doc))
  THEN '' ELSE 'invalid_message_format' END AS reason
FROM j""",
    "file_struct_lookup": """
WITH names AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'client' WHEN 1 THEN 'telephone' WHEN 2 THEN 'address'
    WHEN 3 THEN 'Client' WHEN 4 THEN 'my_client' ELSE 'addresses_' END || CAST(c_custkey AS VARCHAR) || '.csv' AS source_file
  FROM customer)
SELECT c_custkey, source_file, CASE WHEN starts_with(source_file, 'client') THEN 'client'
  WHEN starts_with(source_file, 'telephone') THEN 'telephone'
  WHEN starts_with(source_file, 'address') THEN 'address' END AS layout FROM names""",
    "base64_event": """
WITH m AS (SELECT event_id, event_type, '{"fileURL": "gs://in/' || CAST(event_id AS VARCHAR) || '.csv", "destination": "'
    || event_type || '"}' AS message FROM events)
SELECT CAST(event_id AS VARCHAR) AS message_id, decode(from_base64(to_base64(encode(message)))) AS message,
  'in' AS bucket, 'in/' || CAST(event_id AS VARCHAR) || '.csv' AS path, event_type AS destination FROM m""",
    "url_parts": """SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS bucket,
      regexp_extract(url, '^https?://[^/]+/(.*)$', 1) AS object FROM pages""",
    "size_router": """SELECT doc_id, n_chars AS length,
      CASE WHEN n_chars < 1000 THEN 'stream' ELSE 'batch' END AS route FROM documents""",
    "dynamic_route_counts": _ROUTED,
    "three_roads": _ROADS,
    "tumbling_1s": _TUMBLING_1S,
    "tumbling_60s": """SELECT date_trunc('minute', ts) AS window_start, event_type, count(*) AS n
      FROM events GROUP BY 1, 2""",
    "header_skip": _HEADER_FREE,
    "path_collection_lines": _FEED + "SELECT line FROM feed",
    "feed_file_sizes": _FEED
    + "SELECT source_file, CAST(sum(strlen(line) + 1) AS BIGINT) AS length FROM feed GROUP BY source_file",
    "batch_load_monitoring": _MONITORING,
    "batch_load_rows": _FEED
    + """SELECT f[1] AS "NAME", CAST(f[2] AS BIGINT) AS "AGE" FROM checked WHERE id = 'm0' AND stacktrace = ''""",
    "batch_load_rejects": _FEED + "SELECT * FROM rejects",
    "load_table_counts": _FEED
    + """, names(id, destination) AS (VALUES ('m0', 'age'), ('m1', 'telephone'), ('m2', 'address'))
    SELECT destination AS table_name, count(*) FILTER (WHERE stacktrace = '') AS n
      FROM names JOIN checked USING (id) GROUP BY destination
    UNION ALL SELECT destination || '_rejects', count(*) FILTER (WHERE stacktrace <> '')
      FROM names JOIN checked USING (id) GROUP BY destination
    UNION ALL SELECT 'monitoring', count(DISTINCT id) * 2 FROM checked""",
    "lineitem_file_load": _LINES_MONITORING,
    "batch_load_limited": _FEED
    + """, bad AS (SELECT id, count(*) FILTER (WHERE stacktrace <> '') AS n_bad, count(*) AS n_all FROM checked GROUP BY id)
    SELECT "timestamp", event, number_inserted_rows, number_rejected_rows FROM starts
    UNION ALL SELECT '2024-01-01 00:00:00', CASE WHEN n_bad = 0 THEN 'SUCCESS' ELSE 'WARNING' END,
      CASE WHEN n_bad > CASE id WHEN 'm2' THEN 0 ELSE 18 END THEN 0 ELSE n_all - n_bad END,
      CASE WHEN n_bad > CASE id WHEN 'm2' THEN 0 ELSE 18 END THEN n_all ELSE n_bad END FROM bad""",
    "stream_load_monitoring": _MONITORING,
    "dynamic_route_tables": _ROUTED,
    "three_road_tables": _ROADS,
    "stream_tumbling_1s": _TUMBLING_1S,
    "append_create_if_needed": """SELECT c_custkey, c_name, c_acctbal FROM customer
      UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer""",
    "append_create_never": "SELECT c_name, c_custkey, CAST(NULL AS VARCHAR) AS note FROM customer",
    "inferred_schema_load": """
WITH typed AS (SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer)
SELECT * FROM typed UNION ALL SELECT * FROM typed""",
    "schema_checked_append": """SELECT o_orderkey, o_orderstatus FROM orders
      UNION ALL SELECT o_orderkey, o_orderstatus FROM orders""",
    "exact_name_load": _EXACT_ROWS,
    "inferred_many_files": """
WITH people AS (SELECT n_nationkey, c_custkey, c_name FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey)
SELECT CAST(NULL AS VARCHAR) AS message_id, CAST(NULL AS VARCHAR) AS reason, c_custkey AS custkey, c_name AS name,
  c_custkey + CAST(0.5 AS DOUBLE) AS score
FROM people WHERE c_custkey IS NOT NULL AND n_nationkey NOT BETWEEN 7 AND 10
UNION ALL SELECT DISTINCT printf('m%02d', n_nationkey),
  CASE WHEN n_nationkey = 9 THEN 'empty_file' WHEN n_nationkey = 10 OR c_custkey IS NULL THEN 'file_not_found'
       WHEN n_nationkey = 8 THEN 'no_declared_kind: score'
       ELSE 'schema_mismatch: score: STRING in the file, FLOAT in the table' END,
  CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE)
FROM people WHERE n_nationkey BETWEEN 7 AND 10 OR c_custkey IS NULL""",
    "stream_exact_name_load": _EXACT_ROWS
    + """
UNION ALL SELECT 'dead_letters', '3', NULL, 'file_not_found', NULL
UNION ALL SELECT 'dead_letters', '4', NULL, 'invalid_message_format', NULL""",
    "stream_cogroup_counts": """
WITH k AS (SELECT date_trunc('second', ts) AS window_start, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT window_start, event_type, count(*) FILTER (WHERE k % 3 <> 0) AS number_inserted_rows,
  count(*) FILTER (WHERE k % 3 = 0) AS number_rejected_rows
FROM k GROUP BY 1, 2""",
    "stream_late_rows": """
WITH w AS (SELECT date_trunc('minute', ts) AS window_start, event_id % 2 = 1
    AND date_trunc('minute', ts) + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events WHERE event_id % 2 = 0) - INTERVAL 10 DAY AS late
  FROM events)
SELECT window_start, count(*) FILTER (WHERE NOT late) AS n, count(*) FILTER (WHERE late) AS n_late FROM w GROUP BY 1""",
    "compressed_load": _MONITORING,
    "glob_load": """
WITH lines AS (SELECT l_orderkey % 10 IN (7, 8) AS bad FROM lineitem)
SELECT '2024-01-01 00:00:00' AS "timestamp", 'START' AS event, CAST(0 AS BIGINT) AS number_inserted_rows, CAST(0 AS BIGINT) AS number_rejected_rows
UNION ALL SELECT '2024-01-01 00:00:00', CASE WHEN count(*) FILTER (WHERE bad) > 0 THEN 'WARNING' ELSE 'SUCCESS' END,
  count(*) FILTER (WHERE NOT bad), count(*) FILTER (WHERE bad) FROM lines""",
    "load_dead_letters": """
SELECT CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS "timestamp",
  CASE event_id % 5 WHEN 0 THEN 'file_not_found' WHEN 1 THEN 'no_structure' WHEN 2 THEN 'unknown_destination'
    WHEN 3 THEN 'unknown_partition_key' ELSE 'invalid_message_format' END AS reason,
  CAST(event_id AS VARCHAR) AS message_id FROM events""",
    "dispatch_by_size": _FEED
    + """, sizes AS (SELECT id, sum(strlen(line) + 1) AS size FROM feed GROUP BY id)
    SELECT event, number_inserted_rows, number_rejected_rows FROM ends JOIN sizes ON id = message_id
      WHERE size >= (SELECT size FROM sizes WHERE id = 'm1')
    UNION ALL SELECT 'to the stream: ' || id, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM sizes
      WHERE size < (SELECT size FROM sizes WHERE id = 'm1')""",
    "publish_file": _ROUTED,
}
