"""The registered queries as SQL over the same tables."""

from __future__ import annotations

from hubloom.functions.text import WHITE_SPACE
from hubloom.operators.validation import REASONS

PARTS = """parts AS (
  SELECT p_partkey, p_name, p_brand, p_type, p_size, p_brand || '/' || p_type AS dtype,
         CAST((p_size - 1) // 10 AS VARCHAR) AS band, 'fn-' || band || '-' || p_type AS fn2,
         'area-' || band || '-' || p_brand AS area
  FROM part)"""

ELEMENTS = f"""{PARTS}, elements AS (
  SELECT l_orderkey AS deployment_id, l_linenumber, l_partkey, l_suppkey, l_returnflag,
         l_linestatus, l_suppkey AS hub_id,
         l_returnflag = 'A' AS is_task, l_returnflag = 'N' AS is_event,
         CASE WHEN l_tax <= 0 THEN '' WHEN l_quantity > 45 THEN fn2 ELSE p_brand END AS function_id,
         CASE WHEN l_discount > 0 THEN p_type ELSE '' END AS device_class_id,
         CASE WHEN l_linestatus <> 'O' THEN '' WHEN l_quantity > 45 THEN area ELSE band
         END AS aspect_id
  FROM lineitem JOIN parts ON l_partkey = p_partkey)"""

FLEET = """fleet AS (
  SELECT DISTINCT l_suppkey AS hub_id, p_partkey AS device_id, p_name AS device_name, dtype
  FROM lineitem JOIN parts ON l_partkey // 2 = p_partkey // 2 AND l_suppkey % 2 = p_partkey % 2
  WHERE l_linestatus = 'F'),
svc AS (SELECT DISTINCT dtype, p_brand, p_type, band, fn2, area FROM parts)"""

LOCAL_FLEET = """local_fleet AS (
  SELECT DISTINCT l_suppkey AS hub_id, p_partkey AS device_id, p_name AS device_name, dtype
  FROM lineitem JOIN parts ON l_partkey // 2 = p_partkey // 2 WHERE l_linestatus = 'F')"""


def _matched(criteria: str) -> str:
    return f"""{FLEET}, cand AS (
  SELECT c.hub_id, c.function_id, c.device_class_id, c.aspect_id, f.device_id, f.device_name,
         'service-' || s.band AS service_id, s.p_brand || ' ' || s.band AS service_name
  FROM ({criteria}) c
  JOIN fleet f ON f.hub_id = c.hub_id
  JOIN svc s ON s.dtype = f.dtype
  WHERE (c.function_id = '' OR c.function_id IN (s.p_brand, s.fn2))
    AND (c.device_class_id = '' OR c.device_class_id = s.p_type)
    AND (c.aspect_id = '' OR c.aspect_id IN (s.band, s.area))),
opts AS (
  SELECT hub_id, function_id, device_class_id, aspect_id,
         count(DISTINCT device_id) AS n_options, min(device_id) AS default_device_id
  FROM cand GROUP BY ALL),
firsts AS (
  SELECT hub_id, function_id, device_class_id, aspect_id, device_id, service_id
  FROM (SELECT *, row_number() OVER (
          PARTITION BY hub_id, function_id, device_class_id, aspect_id
          ORDER BY device_id, service_id) AS rn FROM cand)
  WHERE rn = 1)"""


CANDIDATES = f"WITH {ELEMENTS}, " + _matched(
    "SELECT DISTINCT hub_id, function_id, device_class_id, aspect_id "
    "FROM elements WHERE is_task")

CRITERIA = "hub_id, function_id, device_class_id, aspect_id"

DOCS = """docs AS (
  SELECT o_orderkey AS request_id, o_custkey, o_orderstatus AS st, o_orderpriority AS pr,
         o_totalprice > 250000 AS swapped,
         o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED' AS missing,
         o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM' AS bare,
         o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' AS cut,
         CASE o_orderstatus WHEN 'P' THEN 'message' WHEN 'O' THEN 'import' END AS by_status,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'message' WHEN '2-HIGH' THEN 'import'
         END AS by_priority
  FROM orders),
checked AS (
  SELECT *, CASE WHEN missing THEN 'none' WHEN pr = '5-LOW' THEN 'version'
                 WHEN bare THEN NULL WHEN swapped THEN coalesce(by_priority, by_status)
                 ELSE coalesce(by_status, by_priority) END AS reason
  FROM docs)"""

# Bare bodies: one without a deployment is an empty one, with a version.
CREATED = f"""{DOCS}, ruled AS (
  SELECT *, CASE WHEN NOT missing AND NOT bare
                   AND (pr = '2-HIGH' OR st = 'F' AND pr = '3-MEDIUM') THEN 'imports'
                 WHEN missing THEN NULL ELSE reason END AS rule
  FROM checked),
created AS (
  SELECT request_id, o_custkey, cut, missing, bare, pr,
         CASE WHEN request_id = o_custkey THEN NULL ELSE true END AS optional_service,
         CASE WHEN cut OR request_id = o_custkey THEN 400
              WHEN NOT missing AND NOT bare AND coalesce(c_acctbal, -1) < 0 THEN 403
              WHEN rule IS NOT NULL THEN 500 ELSE 200 END AS status,
         rule AS reason
  FROM ruled LEFT JOIN customer ON c_custkey = o_custkey),
deployed AS (
  SELECT *, md5('run-1:' || request_id) AS h,
         substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-'
           || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS new_id
  FROM created WHERE status = 200)"""

METADATA = """meta AS (
  SELECT user_id AS network_id, event_id % 20 AS deployment_id, event_id AS engine_id,
         ts, event_type, props FROM events)"""

FANNED = f"""{METADATA}, fanned AS (
  SELECT c_custkey AS action_id, m.network_id, m.deployment_id, m.engine_id,
         c_mktsegment AS segment, event_type, props
  FROM customer JOIN meta m ON m.network_id = c_custkey // 10 AND m.deployment_id = c_nationkey)"""

OUTCOMES = """outcomes AS (
  SELECT user_id AS network_id, CAST(ts AS DATE) AS day, event_id AS seq,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
         CASE WHEN event_type = 'error' THEN props ELSE 'true' END AS body
  FROM events)"""

LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

MODELS = f"""{PARTS}, models AS (
  SELECT p_partkey AS model_id, *, NOT (p_type = 'PROMO' AND p_size > 40)
           AND NOT (p_type IN ('LARGE', 'ECONOMY') AND p_size <= 5)
           AND NOT (p_type = 'STANDARD' AND p_size >= 48) AS readable
  FROM parts),
requests AS (
  SELECT {LINE_ID} AS request_id, l_suppkey AS hub_id,
         CASE WHEN l_tax = 0 THEN -1 - l_partkey ELSE l_partkey END AS model_id
  FROM lineitem WHERE l_linestatus = 'O')"""

MODEL_TASKS = """mtasks AS (
  SELECT model_id, 0 AS position, 'Task_' || model_id || '_0' AS bpmn_id, p_name AS name,
         'field-job' AS topic, '' AS containers, p_brand AS function_id, p_type AS device_class_id,
         CAST(NULL AS VARCHAR) AS aspect_id, band AS characteristic_id,
         CAST(p_size AS BIGINT) AS retries, CAST(p_size AS VARCHAR) AS inputs
  FROM models WHERE readable
  UNION ALL
  SELECT model_id, 1, 'Task_' || model_id || '_1', 'inner', 'field-job',
         array_to_string(list_transform(range(p_size % 10), lambda k: 'Sub_' || k), '/'), p_brand, NULL,
         band, 'c', CAST(0 AS BIGINT), CAST(p_size AS VARCHAR)
  FROM models WHERE readable AND p_type = 'SMALL')"""


def _prepared(models: str) -> str:
    return f"""{models}, {MODEL_TASKS}, rows AS (
  SELECT r.hub_id, r.model_id, t.bpmn_id, s.s_suppkey IS NOT NULL AS known,
         CASE WHEN m.model_id IS NULL THEN 404
              WHEN NOT m.readable OR s.s_suppkey IS NULL THEN 500 ELSE 200 END AS status,
         coalesce(t.function_id, '') AS function_id,
         coalesce(t.device_class_id, '') AS device_class_id,
         coalesce(t.aspect_id, '') AS aspect_id
  FROM (SELECT DISTINCT hub_id, model_id FROM requests) r
  LEFT JOIN models m ON m.model_id = r.model_id
  LEFT JOIN mtasks t ON t.model_id = r.model_id
  LEFT JOIN supplier s ON s.s_suppkey = r.hub_id AND s.s_acctbal >= 0),
{_matched("SELECT DISTINCT hub_id, function_id, device_class_id, aspect_id FROM rows "
          "WHERE status = 200 AND bpmn_id IS NOT NULL")},
prepared AS (
  SELECT r.hub_id, r.model_id, r.status, r.bpmn_id,
         r.status = 200 AND r.bpmn_id IS NOT NULL AS is_task,
         o.n_options, f.device_id AS default_device_id, f.service_id AS default_service_id
  FROM rows r LEFT JOIN opts o USING ({CRITERIA}) LEFT JOIN firsts f USING ({CRITERIA})),
headers AS (
  SELECT hub_id, model_id, status, count(*) FILTER (WHERE is_task) AS n_tasks,
         count(*) FILTER (WHERE is_task AND n_options > 0) AS n_with_options
  FROM prepared GROUP BY ALL)"""


PREPARED = _prepared(MODELS)

POSTED = _prepared(MODELS[:MODELS.index("requests AS (")] + f"""posts AS (
  SELECT {LINE_ID} AS request_id, l_suppkey AS hub_id, model_id,
         p_type = 'LARGE' AND p_size = 50 AS cut
  FROM lineitem JOIN models ON model_id = l_partkey WHERE l_tax = 0),
requests AS (SELECT * FROM posts WHERE NOT cut)""")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _path(text: str) -> str:
    escaped = f"url_encode({text})"
    for old, new in (("%24", "$"), ("%26", "&"), ("%2B", "+"), ("%3A", ":"),
                     ("%3D", "="), ("%40", "@")):
        escaped = f"replace({escaped}, '{old}', '{new}')"
    return escaped


def _part(text: str) -> str:
    return f"replace(url_encode({text}), '%20', '+')"


MESSAGE = "CASE reason " + " ".join(
    f"WHEN '{code}' THEN {_quoted(text)}" for code, text in REASONS.items()) + " END"

LATEST = """SELECT user_id AS network_id, event_type AS engine_id, event_id AS seq,
  ts AS sync_date, props AS deployment_model
FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""

REPORTED = """CAST(user_id AS VARCHAR) AS network_id, event_type = 'view' AS is_placeholder,
       event_type = 'signup' AS marked_for_delete, CAST(ts AS TIMESTAMP) AS sync_date"""

HUBS = """
SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, md5(s_name) AS hash,
       coalesce(local_ids, '') AS device_local_ids
FROM supplier LEFT JOIN (
  SELECT l_suppkey, array_to_string(
           list(DISTINCT l_partkey // 2 ORDER BY l_partkey // 2), ',') AS local_ids
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_suppkey) ON l_suppkey = s_suppkey
WHERE s_acctbal >= 0"""

ORACLE_SQL: dict[str, str] = {
    "executable_deployments": f"""{CANDIDATES}
SELECT o_orderkey AS deployment_id, count(*) FILTER (WHERE is_task) AS n_tasks,
       count(*) FILTER (WHERE is_task AND n_options > 0) AS n_with_options,
       count(*) FILTER (WHERE is_task)
         = count(*) FILTER (WHERE is_task AND n_options > 0) AS executable
FROM orders LEFT JOIN elements ON deployment_id = o_orderkey LEFT JOIN opts USING ({CRITERIA})
GROUP BY o_orderkey""",

    "load_hubs": """
SELECT * FROM (""" + HUBS + """)""",

    "load_devices": f"""WITH {PARTS}
SELECT CAST(p_partkey AS VARCHAR) AS id, 'local ' || p_partkey AS local_id, p_name AS name,
       dtype AS device_type_id
FROM parts""",

    "load_device_types": f"""WITH {PARTS}
SELECT DISTINCT dtype AS id, p_type AS device_class_id, 'service-' || band AS service_id,
       p_brand || ',' || fn2 AS function_ids, band || ',' || area AS aspect_ids
FROM parts""",

    "load_services": f"""WITH {PARTS}
SELECT DISTINCT dtype || '/service-' || band AS id, p_brand || ' ' || band AS name,
       p_brand || ',' || fn2 AS function_ids, band || ',' || area AS aspect_ids,
       CAST(NULL AS VARCHAR) AS rdf_type
FROM parts""",

    "load_process_models": """
SELECT CAST(p_partkey AS VARCHAR) AS _id, p_name AS name, CAST(p_size AS BIGINT) AS date,
       p_brand AS owner, '<svg>' || p_name || '</svg>' AS svgXML, p_size > 25 AS publish
FROM part""",

    "load_permissions": """
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id,
       CASE WHEN l_linenumber % 5 = 0 THEN 'locations' ELSE 'devices' END AS kind,
       CAST(l_partkey AS VARCHAR) AS id, CASE l_linestatus WHEN 'F' THEN 'x' ELSE 'r' END AS right,
       l_tax > 0 AS allowed
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'""",

    "load_deployments": f"""WITH {DOCS}
SELECT CAST(request_id AS VARCHAR) AS id,
       CAST(CASE pr WHEN '5-LOW' THEN 2 ELSE 3 END AS INTEGER) AS version,
       'deployment ' || request_id AS name,
       CAST(CASE WHEN bare THEN 0 ELSE 3 END AS INTEGER) AS n_elements,
       CASE WHEN NOT bare THEN CAST(o_custkey AS VARCHAR) END AS device_id, '<raw/>' AS xml_raw
FROM docs WHERE NOT missing""",

    "load_sync_metadata": f"""
SELECT CAST(event_id AS VARCHAR) AS camunda_deployment_id,
       'deployment ' || event_id % 20 AS deployment_id, {REPORTED} FROM events""",

    "load_process_instances": f"""
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS businessKey, value > 10 AS ended, {REPORTED}
FROM events""",

    "load_historic_process_instances": f"""
SELECT CAST(event_id AS VARCHAR) AS id, value AS durationInMillis, event_type AS state, {REPORTED}
FROM events""",

    "load_topic_messages": """
SELECT event_type AS topic, props AS payload, CAST(ts AS TIMESTAMP) AS ts FROM events""",

    "decoded_bodies": """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events WHERE event_type <> 'error'""",

    "rejected_bodies": """
SELECT event_id, rtrim(props, '}') AS body, 400 AS status
FROM events WHERE event_type = 'error'""",

    "written_commands": f"""WITH {FANNED}, acts AS (SELECT unnest(['remove', 'start']) AS action),
d AS (WITH {CREATED} SELECT * FROM deployed)
SELECT CAST(action_id AS VARCHAR) AS action_id, CAST(network_id AS VARCHAR) AS network_id,
       CAST(deployment_id AS VARCHAR) AS deployment_id, CAST(engine_id AS VARCHAR) AS engine_id,
       CAST(engine_id AS VARCHAR) AS seq,
       action || '/' || network_id || '/' || engine_id AS command_key,
       CAST(NULL AS VARCHAR) AS source, 'run-1' AS run_id, action
FROM fanned, acts
UNION ALL
SELECT CAST(request_id AS VARCHAR), CAST(o_custkey AS VARCHAR), new_id, NULL, NULL, NULL,
       'source-' || o_custkey, 'run-1', 'deploy' FROM d""",

    "validated_records": f"""WITH {DOCS}
SELECT request_id, coalesce(reason, 'ok') AS result, {MESSAGE} AS message FROM checked""",

    "validated_element_rows": """
WITH lines AS (
  SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 'message'
           WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'import' END AS reason,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
           l_suppkey, l_returnflag, l_linestatus) AS rn
  FROM lineitem),
firsts AS (
  SELECT l_orderkey, arg_min(reason, rn) FILTER (WHERE reason IS NOT NULL) AS reason
  FROM lines GROUP BY l_orderkey)
SELECT o_orderkey AS deployment_id,
       CASE WHEN l_orderkey IS NULL THEN 'none' WHEN o_orderpriority = '5-LOW' THEN 'version'
            ELSE coalesce(reason, 'ok') END AS result
FROM orders LEFT JOIN firsts ON l_orderkey = o_orderkey""",

    "flattened_elements": f"""WITH {DOCS}, rows AS (
  SELECT request_id, 0 AS position, 'Task_' || request_id AS bpmn_id, true AS is_task,
         false AS is_message, CAST(NULL AS VARCHAR) AS import_id
  FROM docs WHERE NOT missing AND NOT bare
  UNION ALL
  SELECT request_id, CASE WHEN swapped THEN 2 ELSE 1 END, 'Status_' || request_id, false,
         st = 'P', CASE WHEN st = 'O' THEN '' END
  FROM docs WHERE NOT missing AND NOT bare
  UNION ALL
  SELECT request_id, CASE WHEN swapped THEN 1 ELSE 2 END, 'Priority_' || request_id, false,
         pr = '1-URGENT', CASE WHEN pr = '2-HIGH' THEN 'import-1' END
  FROM docs WHERE NOT missing AND NOT bare
  UNION ALL
  SELECT request_id, NULL, NULL, false, false, NULL FROM docs WHERE missing OR bare)
SELECT * FROM rows""",

    "import_checks": f"""WITH {DOCS}, ids AS (
  SELECT request_id, NOT missing AND NOT bare
           AND (pr = '2-HIGH' OR st = 'F' AND pr = '3-MEDIUM') AS any_id
  FROM docs)
SELECT request_id, NOT any_id AS imports_allowed,
       CASE WHEN any_id THEN {_quoted(REASONS["imports"])} END AS imports_reason
FROM ids""",

    "finalized_deployments": f"""WITH {DOCS}
SELECT request_id, '<raw/>' AS xml_raw, '<svg>deployment ' || request_id || '</svg>' AS svg,
       false AS restart, true AS notify
FROM docs WHERE NOT missing""",

    "classified_outcomes": f"""WITH {OUTCOMES}
SELECT network_id, seq, status, status >= 300 AS failed,
       CASE WHEN status >= 300 THEN body END AS message
FROM outcomes""",

    "model_tasks": f"WITH {MODELS}, {MODEL_TASKS} SELECT * FROM mtasks",

    "unreadable_models": f"""WITH {MODELS}
SELECT model_id, 500 AS status FROM models WHERE NOT readable""",

    "resolved_models": f"""WITH {MODELS}
SELECT request_id, hub_id, r.model_id, CASE WHEN m.model_id IS NULL THEN 404 ELSE 200 END AS status,
       CASE WHEN m.model_id IS NOT NULL THEN '<svg>' || p_name || '</svg>' END AS svg_xml
FROM requests r LEFT JOIN models m ON m.model_id = r.model_id""",

    "attached_local_devices": """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_suppkey AS VARCHAR) AS hub_id,
       CASE WHEN id IS NULL THEN 500 ELSE 200 END AS status, device_local_ids AS local_devices
FROM lineitem LEFT JOIN (""" + HUBS + """) ON id = CAST(l_suppkey AS VARCHAR)""",

    "devices_of_hubs": f"""WITH {PARTS}
SELECT DISTINCT l_suppkey AS hub_id, p_partkey AS device_id, p_name AS device_name,
       dtype AS device_type_id
FROM lineitem JOIN parts ON l_partkey // 2 = p_partkey // 2""",

    "devices_of_hub_records": f"""WITH {PARTS}, {LOCAL_FLEET}
SELECT CAST(hub_id AS VARCHAR) AS hub_id, device_id, device_name, dtype AS device_type_id
FROM local_fleet JOIN supplier ON s_suppkey = hub_id WHERE s_acctbal >= 0""",

    "selection_request_rows": f"""WITH {ELEMENTS}
SELECT deployment_id, 'Task_' || l_linenumber || '_' || l_partkey AS id, hub_id, function_id,
       device_class_id, aspect_id, NOT is_event AS include_groups, false AS include_imports,
       true AS include_devices, false AS include_id_modified_devices
FROM elements""",

    "matched_candidates": f"""{CANDIDATES} SELECT * FROM cand""",

    "assembled_selectables": f"""{CANDIDATES}
SELECT {CRITERIA}, device_id, device_name,
       string_agg(service_id, ',' ORDER BY service_id) AS service_ids
FROM cand GROUP BY ALL""",

    "elements_with_options": f"""{CANDIDATES}
SELECT deployment_id, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
       n_options, f.device_id AS default_device_id, f.service_id AS default_service_id
FROM elements LEFT JOIN opts USING ({CRITERIA}) LEFT JOIN firsts f USING ({CRITERIA})
WHERE is_task""",

    "default_options": f"""{CANDIDATES} SELECT * FROM firsts""",

    "access_answers": """
WITH refs AS (
  SELECT DISTINCT o_custkey AS user_id, l_partkey AS id
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
granted AS (
  SELECT DISTINCT o_custkey AS user_id, l_partkey AS id
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE o_orderstatus = 'F' AND l_linestatus = 'F' AND l_linenumber % 5 <> 0 AND l_tax > 0)
SELECT r.user_id, 'devices' AS kind, r.id, g.id IS NOT NULL AS allowed
FROM refs r LEFT JOIN granted g ON g.user_id = r.user_id AND g.id = r.id""",

    "refused_deployments": """
SELECT DISTINCT l_orderkey AS request_id
FROM lineitem l JOIN orders o ON o_orderkey = l_orderkey
WHERE NOT EXISTS (
  SELECT 1 FROM lineitem l2 JOIN orders o2 ON o2.o_orderkey = l2.l_orderkey
  WHERE o2.o_orderstatus = 'F' AND l2.l_linestatus = 'F'
    AND l2.l_linenumber % 5 <> 0 AND l2.l_tax > 0
    AND o2.o_custkey = o.o_custkey AND l2.l_partkey = l.l_partkey)""",

    "fanned_out_commands": f"""WITH {FANNED}
SELECT action_id, network_id, deployment_id, engine_id FROM fanned""",

    "idle_actions": f"""WITH {METADATA}
SELECT c_custkey AS action_id, 200 AS status FROM customer
WHERE NOT EXISTS (SELECT 1 FROM meta
                  WHERE network_id = c_custkey // 10 AND deployment_id = c_nationkey)""",

    "attempted_commands": f"""WITH {OUTCOMES}
SELECT network_id, day, seq, status,
       coalesce(max(CASE WHEN status >= 300 THEN 1 ELSE 0 END) OVER (
         PARTITION BY network_id, day ORDER BY seq
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS attempted
FROM outcomes""",

    "command_results": f"""WITH {OUTCOMES}
SELECT network_id, day, count(*) AS n_commands,
       coalesce(arg_min(status, seq) FILTER (WHERE status >= 300), 200) AS status,
       arg_min(body, seq) FILTER (WHERE status >= 300) AS message
FROM outcomes GROUP BY network_id, day""",

    "reconciled_deployments": f"""WITH {METADATA}, wanted AS (
  SELECT DISTINCT network_id, deployment_id FROM meta WHERE ts < TIMESTAMP '2024-01-16'),
synced AS (
  SELECT network_id, deployment_id, arg_max(event_type, ts) AS kind
  FROM meta WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY ALL)
SELECT coalesce(w.network_id, s.network_id) AS network_id,
       coalesce(w.deployment_id, s.deployment_id) AS deployment_id,
       CASE WHEN s.network_id IS NULL THEN 'missing' WHEN s.kind = 'signup' THEN 'deleting'
            WHEN s.kind = 'view' THEN 'placeholder' WHEN w.network_id IS NOT NULL THEN 'in_sync'
            ELSE 'unexpected' END AS state
FROM wanted w FULL OUTER JOIN synced s
  ON s.network_id = w.network_id AND s.deployment_id = w.deployment_id""",

    "commands_in_time": """
WITH sent AS (
  SELECT event_id, user_id AS network_id, event_id % 2 AS deployment_id, ts AS sent_at
  FROM events WHERE event_type = 'click'),
answered AS (
  SELECT s.event_id, s.network_id, s.deployment_id, sent_at, min(e.ts) AS synced_at
  FROM sent s LEFT JOIN events e ON e.user_id = s.network_id
    AND e.event_id % 2 = s.deployment_id AND e.ts >= s.sent_at
    AND e.event_type NOT IN ('click', 'view', 'signup')
  GROUP BY ALL)
SELECT network_id, deployment_id, sent_at, synced_at,
       CASE WHEN synced_at <= sent_at + INTERVAL 36 HOUR THEN 'in_sync'
            WHEN synced_at IS NOT NULL
              OR TIMESTAMP '2024-01-31' > sent_at + INTERVAL 36 HOUR THEN 'late'
            ELSE 'waiting' END AS state
FROM answered""",

    "latency_over_days": """
SELECT user_id AS hub_id, count(*) AS n_requests, true AS p50_ms_fits, true AS p95_ms_fits
FROM events GROUP BY user_id""",

    "network_states": """
WITH meta AS (
  SELECT user_id AS network_id, count(*) AS n_deployments,
         count(*) FILTER (WHERE event_type = 'view') AS n_placeholders,
         count(*) FILTER (WHERE event_type = 'signup') AS n_deleting,
         count(*) FILTER (WHERE event_type NOT IN ('view', 'signup')) AS n_live,
         max(ts) AS newest_sync
  FROM events GROUP BY user_id),
running AS (
  SELECT CASE WHEN event_id % 2 = 1 THEN -1 - user_id ELSE user_id END AS network_id,
         count(*) AS n_instances, count(*) FILTER (WHERE value <= 10) AS n_running
  FROM events GROUP BY 1)
SELECT network_id, coalesce(n_deployments, 0) AS n_deployments,
       coalesce(n_placeholders, 0) AS n_placeholders, coalesce(n_deleting, 0) AS n_deleting,
       coalesce(n_live, 0) AS n_live, newest_sync, coalesce(n_instances, 0) AS n_instances,
       coalesce(n_running, 0) AS n_running
FROM meta FULL OUTER JOIN running USING (network_id)""",

    "newest_sync_rows": LATEST,

    "process_parameters": """
SELECT user_id AS network_id, event_id AS engine_id, p.name, p.type,
       CASE WHEN p.name = 'k' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS value_long,
       CAST(NULL AS DOUBLE) AS value_double, CAST(NULL AS BOOLEAN) AS value_boolean,
       CASE WHEN p.name = 'kind' THEN event_type END AS value_string
FROM events, (VALUES ('k', 'Long'), ('kind', 'String'), ('bad', 'Double')) p(name, type)""",

    "requests_per_path": f"""
WITH log AS (
  SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS path, page_id,
         trim(html, {_quoted(WHITE_SPACE)}) AS body
  FROM pages)
SELECT path, page_id // 1000 AS chunk, 0 AS part, CAST(count(*) AS INTEGER) AS n_bodies,
       md5(string_agg(body, chr(10) ORDER BY page_id)) AS bodies_md5
FROM log GROUP BY path, page_id // 1000""",

    "prepare_latency": """
WITH ranked AS (
  SELECT user_id AS hub_id, CAST(floor(value) AS BIGINT) AS ms,
         row_number() OVER (PARTITION BY user_id ORDER BY floor(value)) AS rn,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM events)
SELECT hub_id, count(*) AS n_requests, avg(ms) AS avg_ms,
       min(ms) FILTER (WHERE rn * 100 >= n * 50) AS p50_ms,
       min(ms) FILTER (WHERE rn * 100 >= n * 95) AS p95_ms, max(ms) AS max_ms
FROM ranked GROUP BY hub_id""",

    "strict_flags": """
SELECT event_id,
       CASE event_type WHEN 'view' THEN true WHEN 'click' THEN true WHEN 'error' THEN false
       END AS flag,
       CASE event_type WHEN 'signup' THEN 400 ELSE 200 END AS status
FROM events""",

    "query_parameters": """
WITH queries AS (
  SELECT page_id, split_part(split_part(url, '#', 1), '?', 2) AS q FROM pages),
pairs AS (
  SELECT page_id, unnest(string_split(q, '&')) AS pair,
         unnest(range(len(string_split(q, '&')))) AS pos
  FROM queries WHERE q <> ''),
named AS (
  SELECT page_id, pos, url_decode(replace(split_part(pair, '=', 1), '+', ' ')) AS name,
         url_decode(replace(split_part(pair, '=', 2), '+', ' ')) AS value
  FROM pairs WHERE pair <> ''),
firsts AS (
  SELECT page_id, name, arg_min(value, pos) AS value FROM named GROUP BY page_id, name)
SELECT page_id, name, value,
       CASE WHEN json_valid(value) AND json_type(CAST(value AS JSON)) IN ('UBIGINT', 'BIGINT')
            THEN 'BIGINT' ELSE 'STRING' END AS kind
FROM firsts""",

    "canonical_queries": f"""
WITH queries AS (
  SELECT page_id, split_part(split_part(url, '#', 1), '?', 2) AS q FROM pages),
pairs AS (
  SELECT page_id, unnest(string_split(q, '&')) AS pair,
         unnest(range(len(string_split(q, '&')))) AS pos
  FROM queries WHERE q <> ''),
named AS (
  SELECT page_id, pos, url_decode(replace(split_part(pair, '=', 1), '+', ' ')) AS name,
         url_decode(replace(split_part(pair, '=', 2), '+', ' ')) AS value
  FROM pairs WHERE pair <> ''),
joined AS (
  SELECT page_id, string_agg({_part("name")} || '=' || {_part("value")}, '&'
                             ORDER BY name, pos) AS query
  FROM named GROUP BY page_id)
SELECT page_id, coalesce(query, '') AS query FROM pages LEFT JOIN joined USING (page_id)""",

    "command_keys": f"""
SELECT event_id,
       'start/' || {_path("'urn:hub:' || user_id")} || '/'
       || {_path("event_type || '/ ' || event_id")}
       || '?' || {_part("'a b'")} || '='
       || {_part("'~*+/' || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR)")}
       || '&at=' || {_part("props")} || '&at=' || {_part("event_type")} AS command_key
FROM events""",

    "posted_preparations": f"""WITH {POSTED}
SELECT r.hub_id, r.request_id, status, n_tasks, n_with_options,
       CASE WHEN status = 200 THEN n_tasks = n_with_options END AS executable
FROM requests r JOIN headers h ON h.hub_id = r.hub_id AND h.model_id = r.model_id
UNION ALL
SELECT hub_id, request_id, 400, 0, 0, NULL FROM posts WHERE cut""",

    "prepared_elements": f"""WITH {PREPARED} SELECT * FROM prepared""",

    "prepared_requests": f"""WITH {PREPARED}
SELECT r.request_id, r.hub_id, r.model_id, status, n_tasks, n_with_options,
       CASE WHEN status = 200 THEN n_tasks = n_with_options END AS executable
FROM requests r JOIN headers h ON h.hub_id = r.hub_id AND h.model_id = r.model_id""",

    "prepared_for_users": f"""WITH {MODELS.replace("FROM lineitem WHERE l_linestatus = 'O')",
    "FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linestatus = 'O')").replace(
    "l_suppkey AS hub_id,", "l_suppkey AS hub_id, o_custkey AS user_id,")}, {MODEL_TASKS},
{FLEET}, {LOCAL_FLEET}, granted AS (
  SELECT DISTINCT o_custkey AS user_id, l_partkey AS device_id
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE o_orderstatus = 'F' AND l_linestatus = 'F' AND l_linenumber % 5 <> 0 AND l_tax > 0),
rows AS (
  SELECT r.hub_id, r.user_id, r.model_id, t.bpmn_id,
         CASE WHEN m.model_id IS NULL THEN 404
              WHEN NOT m.readable OR s.s_suppkey IS NULL THEN 500 ELSE 200 END AS status,
         coalesce(t.function_id, '') AS f, coalesce(t.device_class_id, '') AS c,
         coalesce(t.aspect_id, '') AS a
  FROM (SELECT DISTINCT hub_id, user_id, model_id FROM requests) r
  LEFT JOIN models m ON m.model_id = r.model_id
  LEFT JOIN mtasks t ON t.model_id = r.model_id
  LEFT JOIN supplier s ON s.s_suppkey = r.hub_id AND s.s_acctbal >= 0),
offered AS (
  SELECT DISTINCT r.hub_id, r.user_id, r.model_id, r.bpmn_id
  FROM rows r JOIN granted g ON g.user_id = r.user_id
  JOIN local_fleet d ON d.hub_id = r.hub_id AND d.device_id = g.device_id
  JOIN svc s ON s.dtype = d.dtype
  WHERE status = 200 AND bpmn_id IS NOT NULL AND (f = '' OR f IN (s.p_brand, s.fn2))
    AND (c = '' OR c = s.p_type) AND (a = '' OR a IN (s.band, s.area))),
headers AS (
  SELECT r.hub_id, r.user_id, r.model_id, status,
         count(*) FILTER (WHERE status = 200 AND r.bpmn_id IS NOT NULL) AS n_tasks,
         count(o.bpmn_id) AS n_with_options
  FROM rows r LEFT JOIN offered o ON o.hub_id = r.hub_id AND o.user_id = r.user_id
    AND o.model_id = r.model_id AND o.bpmn_id = r.bpmn_id AND status = 200
  GROUP BY ALL)
SELECT r.request_id, r.hub_id, r.user_id, r.model_id, status, n_tasks, n_with_options,
       CASE WHEN status = 200 THEN n_tasks = n_with_options END AS executable
FROM requests r JOIN headers h ON h.hub_id = r.hub_id AND h.user_id = r.user_id
  AND h.model_id = r.model_id""",

    "prepared_deployments": f"""WITH {PREPARED}
SELECT r.request_id, r.hub_id, r.model_id, 3 AS version, 'process' AS name,
       n_tasks = n_with_options AS executable, elements,
       CAST(n_tasks AS INTEGER) AS n_options_keys,
       '<svg>' || p_name || '</svg>' AS svg, false AS restart, true AS notify
FROM requests r JOIN headers h ON h.hub_id = r.hub_id AND h.model_id = r.model_id
JOIN models m ON m.model_id = h.model_id
JOIN (SELECT model_id, string_agg(concat_ws('/', bpmn_id, function_id, device_class_id,
                                            aspect_id), ',' ORDER BY position) AS elements
      FROM mtasks GROUP BY model_id) t ON t.model_id = h.model_id
WHERE status = 200""",

    "created_deployments": f"""WITH {CREATED}
SELECT request_id, optional_service, status,
       CASE status WHEN 400 THEN 'request' WHEN 403 THEN 'access' ELSE reason END AS reason,
       CAST(CASE WHEN cut OR missing THEN NULL WHEN bare THEN 0 ELSE 3 END AS INTEGER)
         AS n_elements
FROM created""",

    "deploy_command_rows": f"""WITH {CREATED}
SELECT CAST(request_id AS VARCHAR) AS action_id, CAST(o_custkey AS VARCHAR) AS network_id,
       new_id AS deployment_id, 'source-' || o_custkey AS source, new_id AS sent_id,
       CASE WHEN NOT missing THEN 'deployment ' || request_id END AS name,
       CASE WHEN NOT bare AND NOT missing THEN 'Task_' || request_id END AS first_element
FROM deployed""",

    "removed_deployments": f"""WITH {FANNED}
SELECT action_id, count(*) AS n_commands,
       CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 0 THEN 500 ELSE 200
       END AS status,
       arg_min(props, engine_id) FILTER (WHERE event_type = 'error') AS message
FROM fanned GROUP BY action_id
UNION ALL
SELECT c_custkey, 0, 200, NULL FROM customer
WHERE c_custkey NOT IN (SELECT action_id FROM fanned)""",

    "started_deployments": f"""WITH {FANNED}
SELECT action_id, engine_id, 'start/' || network_id || '/' || engine_id
         || '?segment=' || segment AS command_key
FROM fanned""",

    "routed_commands_stream": f"""WITH {DOCS}
SELECT request_id, o_custkey AS network_id,
       CASE WHEN cut THEN 'unreadable' ELSE coalesce(reason, 'ok') END AS result,
       CASE WHEN NOT cut AND reason IS NULL THEN 'accepted' ELSE 'rejected' END AS route
FROM checked""",

    "redelivered_commands_stream": f"""WITH {DOCS}
SELECT request_id, o_custkey AS network_id, 'deploy' AS action
FROM checked WHERE NOT cut AND reason IS NULL""",

    "action_results_stream": f"""WITH {OUTCOMES}
SELECT network_id, day, CAST(count(*) AS BIGINT) AS n_commands,
       min(seq) FILTER (WHERE status >= 300) AS failed_seq,
       arg_min(status, seq) FILTER (WHERE status >= 300) AS status,
       arg_min(body, seq) FILTER (WHERE status >= 300) AS message
FROM outcomes GROUP BY network_id, day""",

    "attempted_commands_stream": f"""WITH {OUTCOMES}
SELECT network_id, day, seq, status,
       coalesce(max(CASE WHEN status >= 300 THEN 1 ELSE 0 END) OVER (
         PARTITION BY network_id, day ORDER BY seq
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS attempted
FROM outcomes""",

    "latest_sync_stream": LATEST,

    "live_deployments_stream": """
SELECT user_id AS network_id, event_id % 20 AS engine_id, event_id AS seq,
       event_type = 'view' AS is_placeholder, ts AS sync_date
FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, event_id % 20 ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type <> 'signup'""",

    "topic_activity_stream": """
SELECT event_type AS topic, date_trunc('hour', ts) AS window_start,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS n_messages
FROM events
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR
      <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
GROUP BY ALL""",
}
