"""The catalogue's queries as plain SQL over the same tables, for checking results."""

from __future__ import annotations

LINE_ORDER = (
    "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus"
)
PHONE = r"(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}"
ID_CARD_18 = (
    r"[1-9]\d{5}(18|19|([23]\d))\d{2}((0[1-9])|(10|11|12))"
    r"(([0-2][1-9])|10|20|30|31)\d{3}[0-9Xx]"
)
EMAIL = r"[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(.[a-zA-Z0-9_-]+)+"

# --- shared table expressions -------------------------------------------------------------

LINES = """
lines AS (
  SELECT *, l_orderkey AS order_id, l_partkey AS cargo_type,
         l_shipdate + to_minutes(l_orderkey % 1440) AS ts
  FROM lineitem)"""
FIRSTS = f"""
firsts AS (
  SELECT * FROM lines
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ts, {LINE_ORDER}) = 1)"""
SENDERS = """
senders AS (
  SELECT o.*, c.c_name, c.c_mktsegment, 'c' || n.n_nationkey AS district_id,
         'c' || n.n_nationkey AS city_id, 'p' || n.n_regionkey AS province_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders o LEFT JOIN customer c ON o_custkey = c_custkey
  LEFT JOIN nation n ON c_nationkey = n_nationkey)"""
ORG = """
org AS (
  SELECT s_suppkey AS id, s_name AS org_name, 'c' || s_nationkey AS region_id,
         CASE WHEN s_suppkey % 10 <> 0 THEN s_suppkey - s_suppkey % 10 END AS org_parent_id
  FROM supplier),
district_org AS (
  SELECT region_id, arg_min(id, id) AS org_id, arg_min(org_name, id) AS org_name
  FROM org GROUP BY region_id)"""
REGION = """
places AS (
  SELECT 'c' || n_nationkey AS id, n_name AS name, 'p' || n_regionkey AS parent_id FROM nation
  UNION ALL SELECT 'p' || r_regionkey, r_name, NULL FROM region)"""
ORG_CITY = """
org_place AS (
  SELECT o.id AS org_id, o.org_name, j.region_id AS city_id, c.name AS city_name,
         c.parent_id AS province_id, p.name AS province_name
  FROM org o LEFT JOIN org j ON j.id = coalesce(o.org_parent_id, o.id)
  LEFT JOIN places c ON c.id = j.region_id LEFT JOIN places p ON p.id = c.parent_id)"""
# Status paths of the order change log, one row per step.
STEPS = """
steps AS (
  SELECT s.*, step, path[step] AS status, path[step - 1] AS old_status,
         TIMESTAMP '2024-01-01' + to_seconds((o_orderkey * 1733) % 2592000)
           + to_hours(CAST((step - 1) * 6 AS INTEGER)) AS moment
  FROM (SELECT *, CASE o_orderstatus
          WHEN 'F' THEN ['60010','60020','60030','60040','60050','60060','60070','60080','60999']
          WHEN 'O' THEN ['60010','60020','60030','60040','60050','60060']
          WHEN 'P' THEN ['60010','60020','60999','60010','60020'] END AS path
        FROM senders) s, unnest(range(1, len(path) + 1)) t(step)),
named AS (
  SELECT *, CASE WHEN step = 1 THEN 'order'
       WHEN old_status = '60010' AND status = '60020' THEN 'pay_suc'
       WHEN old_status = '60020' AND status = '60030' THEN 'receive'
       WHEN old_status = '60040' AND status = '60050' THEN 'dispatch'
       WHEN old_status = '60050' AND status = '60060' THEN 'bound_finish'
       WHEN old_status = '60060' AND status = '60070' THEN 'deliver_suc'
       WHEN old_status = '60070' AND status = '60080' THEN 'sign'
       WHEN old_status <> status AND status = '60999' THEN 'cancel' END AS event
  FROM steps),
closed AS (
  SELECT *, max(CASE WHEN event IN ('sign','cancel') THEN moment END) OVER (
    PARTITION BY o_orderkey ORDER BY moment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gone
  FROM named WHERE event IS NOT NULL),
cargo AS (
  SELECT *, TIMESTAMP '2024-01-01' + to_seconds((l_orderkey * 1733) % 2592000)
         + to_seconds(l_linenumber * 2 - 6) AS arrived
  FROM lineitem),
event_lines AS (
  SELECT c.*, o.*, CASE WHEN event = 'order' THEN arrived ELSE moment END AS ts
  FROM closed o JOIN cargo c ON l_orderkey = o_orderkey
  WHERE (arrived <= moment AND (gone IS NULL OR arrived > gone))
     OR (event = 'order' AND arrived > moment AND arrived <= moment + INTERVAL 5 SECONDS))"""
EVENT_LINES = f"{SENDERS},{STEPS}"
BOUND = """
bound AS (
  SELECT 'inbound' AS event, l_suppkey AS org_id, l_partkey AS emp_id,
         l_shipdate + to_minutes(l_orderkey % 1440) AS local_time FROM lineitem
  UNION ALL SELECT 'sort', l_suppkey, l_partkey,
         l_shipdate + to_minutes(l_orderkey % 1440) + to_hours(l_linenumber) FROM lineitem
  UNION ALL SELECT 'outbound', l_suppkey, l_partkey,
         l_shipdate + to_minutes(l_orderkey % 1440) + to_minutes(l_linenumber * 90)
  FROM lineitem WHERE l_returnflag IN ('R', 'A'))"""
TRIPS = """
trips AS (
  SELECT *, l_shipdate + to_minutes(l_orderkey % 1440) AS local_end,
         CAST(l_quantity AS BIGINT) * 3600000 AS duration,
         'org ' || l_suppkey || ' ' || l_returnflag AS trip_org
  FROM lineitem WHERE l_returnflag <> 'N')"""
USER_STEPS = """
user_rows AS (
  SELECT *, CASE event_type
           WHEN 'signup' THEN CASE WHEN event_id % 2 = 1 THEN '60010' ELSE '60050' END
           WHEN 'view' THEN CASE WHEN event_id % 2 = 1 THEN '60020' ELSE '60060' END
           WHEN 'click' THEN CASE WHEN event_id % 2 = 1 THEN '60030' ELSE '60070' END
           WHEN 'purchase' THEN CASE WHEN event_id % 2 = 1 THEN '60040' ELSE '60080' END
           ELSE '60999' END AS status,
         CASE WHEN event_type = 'purchase' THEN value END AS x
  FROM events),
user_steps AS (
  SELECT *, lag(status) OVER w AS old_status, lag(x) OVER w AS old_x,
         row_number() OVER w AS step
  FROM user_rows WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""


def day(ts: str) -> str:
    return f"strftime({ts} + INTERVAL 8 HOURS, '%Y-%m-%d')"


def second(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def masked(name: str) -> str:
    return f"left({name}, 1) || repeat('*', length({name}) - 1)"


# Text of the envelopes made from customers.
PHONE_NUM = (
    "CASE WHEN c_custkey % 11 = 0 THEN left(CAST(13000000000 + (c_custkey * 7919391) % 7000000000 "
    "AS VARCHAR), 10) ELSE CAST(13000000000 + (c_custkey * 7919391) % 7000000000 AS VARCHAR) END"
)
MAIL = (
    "lower(c_mktsegment) || CASE WHEN c_custkey % 5 = 0 THEN '#' ELSE '@' END || 'mail.' || c_custkey"
)
CARD = (
    "'1101011990' || lpad(CAST(c_custkey % 14 AS VARCHAR), 2, '0') || "
    "lpad(CAST(c_custkey % 33 AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0')"
    " || CASE WHEN c_custkey % 3 = 0 THEN 'X' ELSE '5' END"
)


def valid(text: str, pattern: str) -> str:
    return f"CASE WHEN regexp_full_match({text}, '{pattern}') THEN md5({text}) END"


def per_org(event: str, count: str, once: bool = True) -> str:
    """Orders of one event per organisation and day, with city and province names."""
    pick = (
        f"QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY ts, {LINE_ORDER}) = 1"
        if once
        else ""
    )
    return f"""
WITH {EVENT_LINES},{ORG},{REGION},
picked AS (SELECT * FROM event_lines WHERE event = '{event}' {pick}),
totals AS (
  SELECT {day('ts')} AS cur_date, d.org_id, d.org_name, count(*) AS {count},
         arg_min(p.city_id, (ts, p.city_id, p.province_id)) AS city_id,
         arg_min(p.province_id, (ts, p.city_id, p.province_id)) AS province_id
  FROM picked p LEFT JOIN district_org d ON d.region_id = p.district_id GROUP BY 1, 2, 3)
SELECT cur_date, org_id, org_name, city_id, c.name AS city_name, province_id,
       v.name AS province_name, {count}
FROM totals LEFT JOIN places c ON c.id = city_id LEFT JOIN places v ON v.id = province_id"""


def per_day(event: str, count: str) -> str:
    return f"""
WITH {EVENT_LINES},
picked AS (SELECT o_orderkey, min(ts) AS ts FROM event_lines WHERE event = '{event}' GROUP BY 1)
SELECT {day('ts')} AS cur_date, count(*) AS {count} FROM picked GROUP BY 1"""


ORDER_ROWS = """
order_rows AS (
  SELECT o_orderkey AS id, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         epoch_ms(o_orderdate) AS ts, substr('cudr', CAST(o_orderkey % 4 AS INTEGER) + 1, 1) AS op
  FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 4 <> 2)"""
DETAIL_TOPICS = (
    "CASE event WHEN 'order' THEN 'tms_dwd_trade_order_detail' "
    "WHEN 'pay_suc' THEN 'tms_dwd_trade_pay_suc_detail' "
    "WHEN 'cancel' THEN 'tms_dwd_trade_cancel_detail' "
    "WHEN 'receive' THEN 'tms_dwd_trans_receive_detail' "
    "WHEN 'dispatch' THEN 'tms_dwd_trans_dispatch_detail' "
    "WHEN 'bound_finish' THEN 'tms_dwd_trans_bound_finish_detail' "
    "WHEN 'deliver_suc' THEN 'tms_dwd_trans_deliver_detail' "
    "WHEN 'sign' THEN 'tms_dwd_trans_sign_detail' END"
)

ORACLE: dict[str, str] = {
    "order_detail_join": f"""
WITH {LINES},{SENDERS}
SELECT order_id, l_linenumber AS line, cargo_type, o_orderstatus AS status,
       o_orderpriority AS collect_type, o_custkey AS user_id, district_id AS sender_district_id,
       province_id AS sender_province_id, {masked('c_name')} AS sender_name,
       c_mktsegment AS payment_type, CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS weight,
       CAST(amount AS DOUBLE) AS amount, {second('ts + INTERVAL 8 HOURS')} AS order_time
FROM lines JOIN senders ON order_id = o_orderkey""",
    "first_line_per_order": f"""
WITH {LINES},{FIRSTS}
SELECT order_id, l_linenumber AS line, cargo_type, {second('ts + INTERVAL 8 HOURS')} AS order_time
FROM firsts""",
    "first_line_flag": f"""
WITH {LINES}
SELECT order_id, l_linenumber AS line, cargo_type, CAST(CASE WHEN row_number() OVER (
  PARTITION BY order_id ORDER BY ts, {LINE_ORDER}) = 1 THEN 1 ELSE 0 END AS BIGINT) AS counted
FROM lines""",
    "order_events": f"""
WITH {EVENT_LINES}
SELECT o_orderkey AS order_id, event, count(*) AS line_count,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS weight,
       min({second('ts + INTERVAL 8 HOURS')}) AS first_time,
       max({second('ts + INTERVAL 8 HOURS')}) AS last_time,
       CAST(min(amount) AS DOUBLE) AS amount, min({masked('o_orderpriority')}) AS sender_name,
       min({second('o_orderdate')}) AS estimate_arrive_time
FROM event_lines GROUP BY 1, 2""",
    "bound_event_days": f"""
WITH {BOUND}
SELECT event, org_id, strftime(local_time, '%Y-%m-%d') AS cur_date, count(*) AS event_count,
       min({second('local_time')}) AS first_time, CAST(sum(emp_id) AS BIGINT) AS emp_sum
FROM bound GROUP BY 1, 2, 3""",
    "transport_finish": f"""
WITH {TRIPS}
SELECT l_linenumber AS line, l_suppkey AS start_org_id, trip_org AS start_org_name,
       l_returnflag AS driver1_name, l_partkey AS truck_id,
       md5(CAST(l_partkey AS VARCHAR)) AS truck_no,
       {second('local_end - to_milliseconds(duration)')} AS actual_start_time,
       {second('local_end')} AS actual_end_time, duration AS transport_time,
       CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS actual_distance
FROM trips""",
    "status_transitions": f"""
WITH {USER_STEPS},
named AS (
  SELECT event_id, user_id, CASE WHEN step = 1 THEN 'order'
       WHEN old_status = '60010' AND status = '60020' THEN 'pay_suc'
       WHEN old_status = '60020' AND status = '60030' THEN 'receive'
       WHEN old_status = '60040' AND status = '60050' THEN 'dispatch'
       WHEN old_status = '60050' AND status = '60060' THEN 'bound_finish'
       WHEN old_status = '60060' AND status = '60070' THEN 'deliver_suc'
       WHEN old_status = '60070' AND status = '60080' THEN 'sign'
       WHEN old_status <> status AND status = '60999' THEN 'cancel' END AS event
  FROM user_steps)
SELECT * FROM named WHERE event IS NOT NULL""",
    "null_to_value_edges": f"""
WITH {USER_STEPS}
SELECT event_id, user_id, x AS value FROM user_steps
WHERE step > 1 AND old_x IS NULL AND x IS NOT NULL""",
    "org_order_day": f"""
WITH {LINES},{FIRSTS},{SENDERS},{ORG},{REGION},
totals AS (
  SELECT {day('ts')} AS cur_date, d.org_id, d.org_name, arg_min(s.city_id, (ts, s.city_id)) AS city_id,
         CAST(sum(amount) AS DOUBLE) AS order_amount_base, count(*) AS order_count_base
  FROM firsts JOIN senders s ON order_id = o_orderkey
  LEFT JOIN district_org d ON d.region_id = s.district_id GROUP BY 1, 2, 3)
SELECT t.*, p.name AS city_name FROM totals t LEFT JOIN places p ON p.id = city_id""",
    "cargo_type_order_day": f"""
WITH {LINES},{FIRSTS},
totals AS (
  SELECT {day('ts')} AS cur_date, cargo_type,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_amount_base,
         count(*) AS order_count_base
  FROM firsts JOIN orders ON order_id = o_orderkey GROUP BY 1, 2)
SELECT t.*, p_name AS cargo_type_name FROM totals t LEFT JOIN part ON p_partkey = cargo_type""",
    "dispatch_day": per_day("dispatch", "dispatch_order_count_base"),
    "bound_finish_day": per_day("bound_finish", "bound_finish_order_count_base"),
    "org_deliver_day": per_org("deliver_suc", "deliver_suc_count_base"),
    "org_receive_day": per_org("receive", "receive_order_count_base"),
    "org_receive_line_day": per_org("receive", "receive_order_count_base", once=False),
    "sort_day": f"""
WITH {BOUND},{ORG},{REGION},{ORG_CITY},
totals AS (
  SELECT strftime(local_time, '%Y-%m-%d') AS cur_date, org_id, count(*) AS sort_count_base
  FROM bound WHERE event = 'sort' GROUP BY 1, 2)
SELECT t.*, org_name, city_id, city_name, province_id, province_name
FROM totals t LEFT JOIN org_place USING (org_id)""",
    "truck_model_finish_day": f"""
WITH {TRIPS},{ORG},{REGION},{ORG_CITY},
models AS (SELECT p_brand AS id, min(p_type) AS model_name FROM part GROUP BY 1),
totals AS (
  SELECT strftime(local_end, '%Y-%m-%d') AS cur_date, l_suppkey AS org_id,
         p_brand AS truck_model_id, arg_min(trip_org, (local_end, trip_org)) AS org_name,
         count(*) AS trans_finish_count_base,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS trans_finish_distance_base,
         CAST(sum(duration) AS BIGINT) AS trans_finish_dur_time_base
  FROM trips LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3)
SELECT t.*, model_name AS truck_model_name, city_id, city_name
FROM totals t LEFT JOIN models m ON m.id = truck_model_id
LEFT JOIN (SELECT org_id, city_id, city_name FROM org_place) USING (org_id)""",
    "metric_latest_version": f"""
SELECT user_id, {day('ts')} AS cur_date, max(event_id) AS batch_id,
       arg_max(value, event_id) AS total
FROM events GROUP BY 1, 2""",
    "cdc_filter_rename": f"""
WITH {ORDER_ROWS}
SELECT op, 'order_info' AS "table", ts, id, status, CAST(amount AS DOUBLE) AS amount
FROM order_rows""",
    "cdc_malformed": """
SELECT left('{"op":"' || substr('cudr', CAST(o_orderkey % 4 AS INTEGER) + 1, 1) || '","ts_ms":'
            || epoch_ms(o_orderdate) || ',"source":{"table":"order_info"', 40) AS value,
       count(*) AS line_count
FROM orders WHERE o_orderkey % 97 = 0 GROUP BY 1""",
    "cdc_route": f"""
WITH {ORDER_ROWS}
SELECT 'order_info' AS "table", op, count(*) AS change_count, CAST(sum(id) AS BIGINT) AS id_sum
FROM order_rows GROUP BY op
UNION ALL
SELECT 'base_organ', 'c', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier""",
    "ods_rows": f"""
WITH {ORDER_ROWS},
all_rows AS (SELECT 'order_info' AS "table", op, id, ts FROM order_rows
  UNION ALL SELECT 'user_info', 'r', c_custkey, c_custkey FROM customer)
SELECT "table", op, count(*) AS change_count, CAST(sum(id) AS BIGINT) AS id_sum,
       CAST(sum(id) AS BIGINT) AS key_sum, min(ts) AS min_ts
FROM all_rows GROUP BY 1, 2""",
    "dwd_fanout": f"""
WITH {BOUND}
SELECT 'tms_dwd_bound_' || event AS topic, count(*) AS row_count,
       CASE WHEN event = 'sort' THEN CAST(sum(org_id) AS BIGINT) END AS org_sum,
       CASE WHEN event = 'sort' THEN max({second('local_time')}) END AS last_time
FROM bound GROUP BY event""",
    "order_fanout": f"""
WITH {EVENT_LINES}
SELECT {DETAIL_TOPICS} AS topic, count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS order_sum,
       min(epoch_ms(ts)) AS min_ts, max({second('ts + INTERVAL 8 HOURS')}) AS last_time
FROM event_lines GROUP BY event""",
    "mask_names": f"""
SELECT c_custkey, {masked('c_name')} AS name, {masked('c_mktsegment')} AS segment FROM customer""",
    "md5_hash": "SELECT c_custkey, md5(c_name) AS hash FROM customer",
    "valid_hash_or_null": f"""
SELECT c_custkey, {valid(PHONE_NUM, PHONE)} AS phone, {valid(CARD, ID_CARD_18)} AS id_card,
       {valid(MAIL, EMAIL)} AS email FROM customer""",
    "mask_policy": f"""
SELECT CAST(c_custkey AS VARCHAR) AS id, md5(c_mktsegment) AS passwd, md5(c_name) AS real_name,
       {valid(PHONE_NUM, PHONE)} AS phone_num, {valid(MAIL, EMAIL)} AS email
FROM customer""",
    "dim_prune_route": """
SELECT 'dim_base_organ' AS sink_table, CAST(s_suppkey AS VARCHAR) AS id, s_name AS org_name,
       'id,org_name' AS columns FROM supplier""",
    "dim_latest_upsert": """
SELECT CAST(user_id AS VARCHAR) AS id, arg_max(event_type, ts) AS event_type,
       CAST(arg_max(event_id, ts) AS VARCHAR) AS event_id FROM events GROUP BY user_id""",
    "lookup_pk": """
SELECT o_orderkey, o_custkey, c_name AS user_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "lookup_nonpk_one": f"""
WITH {ORG}
SELECT c_custkey, 'c' || c_nationkey AS district_id, org_id, org_name
FROM customer LEFT JOIN district_org ON region_id = 'c' || c_nationkey""",
    "lookup_composite": """
WITH one AS (SELECT p_size, p_brand, min(p_partkey) AS part_id, arg_min(p_name, p_partkey) AS part_name
             FROM part GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS size,
       'Brand#' || (l_suppkey % 40) AS brand, part_id, part_name
FROM lineitem LEFT JOIN one
  ON p_size = CAST(l_quantity AS INTEGER) AND p_brand = 'Brand#' || (l_suppkey % 40)""",
    "parent_fallback": f"""
WITH {ORG}
SELECT o.id AS org_id, o.org_name AS found_org_name, j.region_id AS city_id
FROM org o LEFT JOIN org j ON j.id = coalesce(o.org_parent_id, o.id)""",
    "region_chain": f"""
WITH {REGION}
SELECT c_custkey, 'c' || c_nationkey AS city_id, c.name AS city_name, c.parent_id AS province_id,
       p.name AS province_name
FROM customer LEFT JOIN places c ON c.id = 'c' || c_nationkey LEFT JOIN places p ON p.id = c.parent_id""",
    "time_roundtrip": f"""
WITH t AS (SELECT event_id, ts, date_trunc('second', ts) AS s, epoch_us(ts) // 1000 AS ms FROM events)
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, epoch_ms(s) AS ts,
       {second('s + INTERVAL 8 HOURS')} AS local_time, {day('s')} AS local_day,
       strftime(s + INTERVAL 8 HOURS, '%Y%m%d') AS partition_day, ms - 28800000 AS clock_ts,
       {second('ts')} AS clock_time, epoch_ms(s) - (ms - 28800000) AS difference,
       epoch_ms(date_trunc('day', s + INTERVAL 8 HOURS)) - 28800000 AS day_start
FROM t""",
}

BORN = "TIMESTAMP '2024-01-01' + to_seconds((l_orderkey * 1733) % 2592000)"


def live_per_org(count: str) -> str:
    """Placed orders per organisation and day, with city and province names."""
    return f"""
WITH {SENDERS},{ORG},{REGION},
placed AS (SELECT DISTINCT l_orderkey, {BORN} AS ts FROM lineitem),
totals AS (
  SELECT {day('ts')} AS cur_date, d.org_id, d.org_name, count(*) AS {count},
         arg_min(s.city_id, (ts, s.city_id, s.province_id)) AS city_id,
         arg_min(s.province_id, (ts, s.city_id, s.province_id)) AS province_id
  FROM placed JOIN senders s ON l_orderkey = o_orderkey
  LEFT JOIN district_org d ON d.region_id = s.district_id GROUP BY 1, 2, 3)
SELECT t.*, c.name AS city_name, p.name AS province_name
FROM totals t LEFT JOIN places c ON c.id = t.city_id LEFT JOIN places p ON p.id = t.province_id"""


ORACLE |= {
    "stream_day_count": ORACLE["sort_day"],
    "stream_early_results": ORACLE["sort_day"],
    "stream_late_drop": f"""
WITH {ORG},{REGION},{ORG_CITY},
seen AS (SELECT max(ts) AS newest FROM events WHERE event_id % 2 = 1),
kept AS (
  SELECT user_id AS org_id, ts FROM events, seen
  WHERE event_id % 2 = 1
     OR date_trunc('day', ts + INTERVAL 8 HOURS) + INTERVAL 16 HOURS > newest - INTERVAL 5 SECONDS),
totals AS (
  SELECT {day('ts')} AS cur_date, org_id, count(*) AS sort_count_base FROM kept GROUP BY 1, 2)
SELECT t.*, org_name, city_id, city_name, province_id, province_name
FROM totals t LEFT JOIN org_place USING (org_id)""",
    "stream_dedup_day": f"""
SELECT {day(BORN)} AS cur_date, count(DISTINCT l_orderkey) AS dispatch_order_count_base
FROM lineitem GROUP BY 1""",
    "stream_org_order_day": f"""
WITH {SENDERS},{ORG},{REGION},
placed AS (SELECT DISTINCT l_orderkey, {BORN} AS ts FROM lineitem),
totals AS (
  SELECT {day('ts')} AS cur_date, d.org_id, d.org_name, arg_min(s.city_id, (ts, s.city_id)) AS city_id,
         CAST(sum(amount) AS DOUBLE) AS order_amount_base, count(*) AS order_count_base
  FROM placed JOIN senders s ON l_orderkey = o_orderkey
  LEFT JOIN district_org d ON d.region_id = s.district_id GROUP BY 1, 2, 3)
SELECT t.*, p.name AS city_name FROM totals t LEFT JOIN places p ON p.id = city_id""",
    "stream_order_cargo": f"SELECT * FROM ({ORACLE['order_events']}) WHERE event = 'order'",
    "stream_order_events": ORACLE["order_events"],
    "dim_tie_upsert": """
SELECT CAST(l_orderkey AS VARCHAR) AS id, CAST(arg_max(l_partkey, place) AS VARCHAR) AS part,
       CAST(arg_max(l_linenumber, place) AS VARCHAR) AS line
FROM (SELECT *, (l_partkey * 7919) % 100003 * 10 + l_linenumber AS place FROM lineitem) GROUP BY l_orderkey""",
    "stream_lookup_change": """
SELECT l_orderkey, l_linenumber, l_partkey AS truck_id,
       CASE WHEN l_orderkey % 2 = 0 THEN CASE WHEN p_partkey % 2 = 1 THEN p_brand END
            WHEN p_partkey % 2 = 1 AND p_partkey % 3 = 0 THEN 'moved' ELSE p_brand END AS truck_model_id
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "stream_org_receive_day": live_per_org("receive_order_count_base"),
    "stream_org_deliver_day": live_per_org("deliver_suc_count_base"),
    "stream_truck_model_day": ORACLE["truck_model_finish_day"],
    "stream_cargo_type_day": f"""
WITH placed AS (SELECT DISTINCT l_orderkey, {BORN} AS ts FROM lineitem),
totals AS (
  SELECT {day('ts')} AS cur_date, l_orderkey % 7 AS type, CAST(count(*) AS DOUBLE) AS order_amount_base,
         count(*) AS order_count_base FROM placed GROUP BY 1, 2)
SELECT cur_date, CAST(type AS VARCHAR) AS cargo_type, p_name AS cargo_type_name, order_amount_base, order_count_base
FROM totals LEFT JOIN part ON p_partkey = type""",
}
