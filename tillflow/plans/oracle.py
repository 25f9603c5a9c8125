"""The catalog queries as SQL over the same tables, written independently of Spark."""

from tillflow import fixed_values as fv
from tillflow.plans.parameters import (
    AS_OF, COMPARE_DAY, INTERVAL_DAYS, SLIDE_DAYS, STATE_BEFORE, TOP, TOP_END, TOP_START,
    VISIT_DAY, WINDOW_DAYS, WORD_ONE, WORD_TEXT, WORD_TWO,
)

_LINE_ID = (
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT), date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)))"
)
_FREIGHT = "CASE WHEN o_orderpriority = '1-URGENT' THEN 10.0 ELSE 0.0 END"
_CREATED = "strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S')"

_PARTS = {
    "o": f"""
        o AS (SELECT o_orderkey AS id, o_orderstatus AS order_status, o_custkey AS user_id,
                     o_totalprice AS final_total_amount, 0.0::DOUBLE AS benefit_reduce_amount,
                     o_totalprice - CAST({_FREIGHT} AS DOUBLE) AS original_total_amount,
                     CAST({_FREIGHT} AS DOUBLE) AS feight_fee, {_CREATED} AS create_time,
                     left({_CREATED}, 10) AS dt, o_orderdate
              FROM orders)""",
    "l": f"""
        l AS (SELECT {_LINE_ID} AS id, l_orderkey AS order_id, l_partkey AS sku_id,
                     l_extendedprice AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
                     CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) * CAST(l_quantity AS BIGINT) AS amount,
                     l_shipdate
              FROM lineitem)""",
    "split": """
        totals AS (SELECT order_id, CAST(sum(amount) AS BIGINT) AS whole FROM l GROUP BY order_id),
        shares AS (SELECT l.*, o.dt, o.create_time, whole,
                          CAST(floor(o.final_total_amount * 100 + 0.5) AS BIGINT) AS paid,
                          CAST((2 * CAST(amount AS HUGEINT)
                                * CAST(floor(o.final_total_amount * 100 + 0.5) AS BIGINT) + whole)
                               // nullif(2 * CAST(whole AS HUGEINT), 0) AS BIGINT) AS share,
                          row_number() OVER (PARTITION BY l.order_id ORDER BY l.id DESC) AS from_end
                   FROM l JOIN o ON l.order_id = o.id JOIN totals ON totals.order_id = l.order_id),
        split AS (SELECT *, CASE WHEN from_end > 1 THEN share
                       ELSE paid - coalesce(sum(CASE WHEN from_end > 1 THEN share END)
                                            OVER (PARTITION BY order_id), 0) END AS cents
                  FROM shares)""",
    "v": """
        v AS (SELECT strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr,
                     CAST(user_id AS VARCHAR) AS mid, json_extract_string(props, '$.k') AS ar,
                     event_type AS ch, epoch_us(ts) // 1000 AS ts FROM events)""",
    "first": """
        first AS (SELECT * FROM v QUALIFY row_number() OVER (
                    PARTITION BY dt, mid ORDER BY ts, ar, ch) = 1)""",
    "users": f"""
        users AS (SELECT *, CASE WHEN age < 20 THEN '{fv.AGE_UP_TO_20}'
                                 WHEN age > 30 THEN '{fv.AGE_OVER_30}'
                                 ELSE '{fv.AGE_21_TO_30}' END AS age_group,
                         CASE WHEN gender = 'M' THEN '{fv.GENDER_MALE}'
                              ELSE '{fv.GENDER_FEMALE}' END AS gender_name
                  FROM (SELECT CAST(c_custkey AS VARCHAR) AS id, c_custkey, c_mktsegment AS user_level,
                               DATE '1975-01-01' + CAST((c_custkey * 37) % 16000 AS INTEGER) AS born,
                               CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender,
                               date_diff('day', DATE '1975-01-01' + CAST((c_custkey * 37) % 16000 AS INTEGER),
                                         DATE '{AS_OF}') // 365 AS age
                        FROM customer))""",
    "skus": """
        skus AS (SELECT CAST(p_partkey AS VARCHAR) AS id, CAST(p_partkey % 64 AS VARCHAR) AS spu_id,
                        p_name AS sku_name, split_part(p_brand, '#', 2) AS tm_id,
                        CAST(p_size AS VARCHAR) AS category3_id, p_partkey,
                        'size ' || p_size AS category3_name, p_brand AS tm_name,
                        min(p_name) OVER (PARTITION BY p_partkey % 64) AS spu_name
                 FROM part)""",
    "flags": """
        flags AS (SELECT id, user_id, CASE WHEN row_number() OVER (
                      PARTITION BY user_id ORDER BY create_time, id) = 1 THEN '1' ELSE '0' END AS if_first_order
                  FROM o)""",
    "hours": """
        hours AS (SELECT dt, hr, count(*) AS dau FROM first GROUP BY dt, hr)""",
    "amounts": """
        amounts AS (SELECT dt, hour(CAST(create_time AS TIMESTAMP)) AS hr,
                           CAST(sum(cents) AS DOUBLE) / 100.0 AS order_amount
                    FROM split GROUP BY ALL)""",
    "brands": """
        brands AS (SELECT split.*, CAST(split_part(p_brand, '#', 2) AS BIGINT) AS tm_id, p_brand AS tm_name
                   FROM split LEFT JOIN part ON p_partkey = sku_id)""",
}


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(_PARTS[p].strip() for p in parts) + " "


_NEAR = (
    f"epoch(l_shipdate) - epoch(o_orderdate) BETWEEN -{INTERVAL_DAYS} * 86400 AND {INTERVAL_DAYS} * 86400"
)
# Times of the sale query are the order's create time, with its time of day.
_SALE_NEAR = (
    "epoch(l_shipdate) - epoch(CAST(o.create_time AS TIMESTAMP)) "
    f"BETWEEN -{INTERVAL_DAYS} * 86400 AND {INTERVAL_DAYS} * 86400"
)
_CHANGE = "['insert', 'update', 'delete', 'bootstrap-insert', 'insert'][CAST({key} % 5 + 1 AS INTEGER)]"
_WINDOWS = """
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(w + INTERVAL {length} MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, {keys}
           CAST(sum(CAST(floor(value * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100.0 AS amount
    FROM (SELECT *, {key_value} unnest({starts}) AS w FROM events)
    GROUP BY ALL"""


def _word(word: str) -> str:
    return rf"regexp_matches(lower(text), '(^|[^\p{{L}}\p{{N}}]){word}($|[^\p{{L}}\p{{N}}])')"


def _total(label: tuple[str, str], value: str) -> str:
    return f"SELECT '{label[0]}' AS id, '{label[1]}' AS name, CAST({value} AS DOUBLE) AS value"


SQL: dict[str, str] = {
    "log_route": """
        SELECT CASE WHEN event_type = 'signup' THEN 'APP_START' ELSE 'APP_EVENT' END AS topic,
               CAST(user_id AS VARCHAR) AS mid, epoch_us(ts) // 1000 AS ts
        FROM events""",
    "cdc_maxwell_route": f"""
        SELECT 'ODS_ORDER_INFO' AS topic, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS note
        FROM orders WHERE {_CHANGE.format(key='o_orderkey')} = 'insert'
        UNION ALL
        SELECT 'ODS_ORDER_DETAIL', CAST(l_orderkey AS VARCHAR), {_LINE_ID}
        FROM lineitem WHERE {_CHANGE.format(key='l_linenumber')} <> 'delete'
        UNION ALL
        SELECT 'ODS_USER_INFO', CAST(c_custkey AS VARCHAR), c_mktsegment
        FROM customer WHERE {_CHANGE.format(key='c_custkey')} <> 'delete' AND c_acctbal >= 0""",
    "cdc_canal_route": f"""
        SELECT 'ODS_ORDER_STATUS_LOG' AS topic, CAST(o_orderkey AS VARCHAR) AS id,
               CAST(unnest(range(1, o_orderkey % 4 + 1)) AS VARCHAR) AS note
        FROM orders
        UNION ALL
        SELECT 'ODS_ORDER_DETAIL', CAST(l_orderkey AS VARCHAR), {_LINE_ID} FROM lineitem""",
    "cdc_typed_parse": _with("o") + """
        SELECT id, user_id, order_status, final_total_amount, feight_fee, create_time FROM o""",
    "malformed_messages": """
        SELECT md5(value) AS digest, length(value) AS n_chars
        FROM (SELECT text AS value FROM documents UNION ALL SELECT props FROM events)
        WHERE NOT json_valid(value)""",
    "message_rejects": """
        WITH form AS (
            SELECT unnest([props, '[' || props || ']', json_extract_string(props, '$.k'),
                           props || ',' || props, props || ' end', 'null']) AS value FROM events),
        message AS (SELECT text AS value FROM documents UNION ALL SELECT value FROM form)
        SELECT md5(value) AS digest, length(value) AS n_chars FROM message
        WHERE CASE WHEN json_valid(value) THEN json_type(value) <> 'OBJECT' ELSE true END""",
    "dim_changelog_stream": """
        SELECT CAST(l_partkey AS VARCHAR) AS id,
               arg_max(l_orderkey || '-' || l_linenumber,
                       CAST(epoch(CAST(l_shipdate AS TIMESTAMP)) AS HUGEINT) * 1000000000000 + l_orderkey * 10 + l_linenumber) AS sku_name
        FROM lineitem GROUP BY 1""",
    "dau_first_visit": _with("v", "first") + f"""
        SELECT mid, mid AS uid, ar, ch, '1.0' AS vc, dt, hr, '{fv.VISIT_MINUTE}' AS mi, ts FROM first""",
    "dau_total": "SELECT strftime(ts, '%Y-%m-%d') AS dt, count(DISTINCT user_id) AS dau FROM events GROUP BY 1",
    "dau_hour": _with("v", "first", "hours") + "SELECT * FROM hours",
    "dau_hour_map": _with("v", "first", "hours") + """
        SELECT dt, string_agg(hr || '=' || dau, ',' ORDER BY hr) AS by_hour FROM hours GROUP BY dt""",
    "dau_hour_compare": _with("v", "first", "hours") + f"""
        SELECT hr, CAST(max(dau) FILTER (WHERE dt = '{VISIT_DAY}') AS DOUBLE) AS today,
               CAST(max(dau) FILTER (WHERE dt <> '{VISIT_DAY}') AS DOUBLE) AS yesterday
        FROM hours
        WHERE CAST(dt AS DATE) IN (DATE '{VISIT_DAY}', DATE '{VISIT_DAY}' - 1) GROUP BY hr""",
    "dau_busiest_hours": _with("v", "first", "hours") + f"""
        SELECT * FROM hours WHERE dt = '{VISIT_DAY}' ORDER BY dau DESC, hr LIMIT 24""",
    "new_devices": """
        SELECT dt, count(*) AS new_devices
        FROM (SELECT user_id, strftime(min(ts), '%Y-%m-%d') AS dt FROM events GROUP BY user_id)
        GROUP BY dt""",
    "dim_user": _with("users") + """
        SELECT id, user_level, strftime(born, '%Y-%m-%d') AS birthday, gender, age_group, gender_name
        FROM users""",
    "dim_sku": _with("skus") + "SELECT * EXCLUDE (p_partkey) FROM skus",
    "dim_latest": """
        SELECT user_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "dim_batch_lookup": _with("users") + """
        SELECT id, user_level, strftime(born, '%Y-%m-%d') AS birthday, gender FROM users
        WHERE c_custkey IN (SELECT o_custkey FROM orders)""",
    "order_dates": _with("o") + """
        SELECT id, create_time, dt AS create_date, substr(create_time, 12, 2) AS create_hour FROM o""",
    "order_first_flag": _with("o", "flags") + "SELECT * FROM flags",
    "order_first_flag_state": _with("o", "flags") + f"""
        SELECT id, user_id, if_first_order FROM flags
        WHERE id IN (SELECT id FROM o WHERE dt >= '{STATE_BEFORE}')""",
    "new_customer_state": """
        SELECT CAST(o_custkey AS VARCHAR) AS user_id, '1' AS if_consumed FROM orders GROUP BY o_custkey""",
    "order_enriched": _with("o", "users") + """
        SELECT o.id, user_id, CAST(c.c_nationkey AS BIGINT) AS province_id, n_name AS province_name,
               CAST(n_regionkey AS VARCHAR) AS province_area_code,
               'CN-' || n_nationkey AS province_iso_code, 'CN-' || n_name AS province_iso_3166_2,
               age_group AS user_age_group, gender_name AS user_gender
        FROM o LEFT JOIN customer c ON c.c_custkey = user_id
        LEFT JOIN nation ON n_nationkey = c.c_nationkey
        LEFT JOIN users ON users.c_custkey = user_id""",
    "detail_enriched": _with("l", "skus") + """
        SELECT l.id, order_id, sku_id, CAST(spu_id AS BIGINT) AS spu_id, CAST(tm_id AS BIGINT) AS tm_id,
               CAST(category3_id AS BIGINT) AS category3_id, spu_name, tm_name, category3_name
        FROM l LEFT JOIN skus ON p_partkey = sku_id""",
    "order_wide": _with("o", "l", "users", "skus", "flags") + """
        SELECT l.id AS order_detail_id, order_id, order_status, create_time, o.user_id, sku_id,
               order_price AS sku_price, sku_num, 'sku ' || sku_id AS sku_name, benefit_reduce_amount, original_total_amount,
               feight_fee, final_total_amount, 0.0::DOUBLE AS final_detail_amount, if_first_order,
               n_name AS province_name, CAST(n_regionkey AS VARCHAR) AS province_area_code,
               age_group AS user_age_group, gender_name AS user_gender, dt,
               CAST(spu_id AS BIGINT) AS spu_id, CAST(tm_id AS BIGINT) AS tm_id,
               CAST(category3_id AS BIGINT) AS category3_id, spu_name, tm_name, category3_name
        FROM l JOIN o ON l.order_id = o.id JOIN flags ON flags.id = o.id
        LEFT JOIN customer c ON c.c_custkey = o.user_id
        LEFT JOIN nation ON n_nationkey = c.c_nationkey
        LEFT JOIN users ON users.c_custkey = o.user_id
        LEFT JOIN skus ON p_partkey = sku_id""",
    "order_wide_interval": f"""
        SELECT o_orderkey AS order_id, {_LINE_ID} AS order_detail_id
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND {_NEAR}""",
    "order_wide_left": f"""
        SELECT o_orderkey AS order_id, {_LINE_ID} AS order_detail_id
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND {_NEAR}""",
    "order_wide_sliding": f"""
        WITH o AS (SELECT *, unnest(range(
                     CAST(CAST(epoch(o_orderdate) AS BIGINT) // 86400 // {SLIDE_DAYS} - {WINDOW_DAYS // SLIDE_DAYS - 1} AS BIGINT),
                     CAST(CAST(epoch(o_orderdate) AS BIGINT) // 86400 // {SLIDE_DAYS} + 1 AS BIGINT))) AS w FROM orders),
             l AS (SELECT *, unnest(range(
                     CAST(CAST(epoch(l_shipdate) AS BIGINT) // 86400 // {SLIDE_DAYS} - {WINDOW_DAYS // SLIDE_DAYS - 1} AS BIGINT),
                     CAST(CAST(epoch(l_shipdate) AS BIGINT) // 86400 // {SLIDE_DAYS} + 1 AS BIGINT))) AS w FROM lineitem)
        SELECT DISTINCT o_orderkey AS order_id, {_LINE_ID} AS order_detail_id
        FROM o JOIN l ON l_orderkey = o_orderkey AND o.w = l.w""",
    "sale_full_outer": _with("o", "l") + f"""
        SELECT l.id AS order_detail_id, CAST(o.id AS VARCHAR) AS order_id, order_status, create_time,
               CAST(user_id AS VARCHAR) AS user_id, CAST(sku_id AS VARCHAR) AS sku_id,
               CAST(NULL AS VARCHAR) AS user_gender, CAST(0 AS INTEGER) AS user_age, CAST(NULL AS VARCHAR) AS user_level,
               order_price AS sku_price, 'sku ' || sku_id AS sku_name, dt
        FROM l FULL JOIN o ON l.order_id = o.id AND {_SALE_NEAR}""",
    "order_split_amount": _with("o", "l", "split") + """
        SELECT order_id, id AS order_detail_id, CAST(cents AS DOUBLE) / 100.0 AS final_detail_amount
        FROM split""",
    "order_running_sums": _with("o", "l", "split") + """
        SELECT order_id, id AS order_detail_id,
               CAST(coalesce(sum(amount) OVER before, 0) AS DOUBLE) / 100.0 AS origin_before,
               CAST(coalesce(sum(cents) OVER before, 0) AS DOUBLE) / 100.0 AS split_before
        FROM split
        WINDOW before AS (PARTITION BY order_id ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "trademark_amount": _with("o", "l", "split", "brands") + """
        SELECT tm_id, tm_name, CAST(sum(cents) AS DOUBLE) / 100.0 AS amount FROM brands GROUP BY ALL""",
    "trademark_window": _WINDOWS.format(
        length=60, keys="tm_id,", key_value="CAST(json_extract_string(props, '$.k') AS BIGINT) AS tm_id,",
        starts="[date_trunc('hour', ts)]",
    ),
    "amount_sliding": _WINDOWS.format(
        length=10, keys="", key_value="",
        starts="[time_bucket(INTERVAL 5 MINUTE, ts), time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE]",
    ),
    "trademark_topn": _with("o", "l", "split", "brands") + f"""
        SELECT CAST(tm_id AS VARCHAR) AS trademark_id, tm_name AS trademark_name,
               CAST(sum(cents) AS DOUBLE) / 100.0 AS order_amount
        FROM brands
        WHERE CAST(dt AS TIMESTAMP) > TIMESTAMP '{TOP_START}' AND CAST(dt AS TIMESTAMP) < TIMESTAMP '{TOP_END}'
        GROUP BY ALL ORDER BY order_amount DESC, trademark_id, trademark_name LIMIT {TOP}""",
    "order_amount_day": _with("o", "l", "split") + """
        SELECT dt, CAST(sum(cents) AS DOUBLE) / 100.0 AS order_amount FROM split GROUP BY dt""",
    "order_amount_hour": _with("o", "l", "split", "amounts") + "SELECT * FROM amounts",
    "order_amount_hour_compare": _with("o", "l", "split", "amounts") + f"""
        SELECT CAST(hr AS VARCHAR) AS hr, max(order_amount) FILTER (WHERE dt = '{COMPARE_DAY}') AS today,
               max(order_amount) FILTER (WHERE dt <> '{COMPARE_DAY}') AS yesterday
        FROM amounts
        WHERE CAST(dt AS DATE) IN (DATE '{COMPARE_DAY}', DATE '{COMPARE_DAY}' - 1) GROUP BY hr""",
    "realtime_total": f"""
        {_total(fv.TOTAL_DAU, "count(DISTINCT user_id)")} FROM events
        WHERE CAST(ts AS DATE) = DATE '{VISIT_DAY}'
        UNION ALL
        {_total(fv.TOTAL_NEW_DEVICES, "count(*)")}
        FROM (SELECT user_id FROM events GROUP BY user_id HAVING CAST(min(ts) AS DATE) = DATE '{VISIT_DAY}')
        UNION ALL
        {_total(fv.TOTAL_ORDER_AMOUNT, "CAST(sum(CAST(floor(value * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100.0")}
        FROM events WHERE CAST(ts AS DATE) = DATE '{VISIT_DAY}'""",
    "doc_search": f"""
        SELECT doc_id, lang FROM documents
        WHERE list_contains(string_split(lower(text), ' '), '{WORD_ONE}')
          AND list_contains(string_split(lower(text), ' '), '{WORD_TWO}') AND {_word(WORD_TEXT)}""",
}

# Columns of the wide record that come from dimensions.
_UNSET = {
    "VARCHAR": (
        "if_first_order province_name province_area_code user_age_group user_gender spu_name tm_name category3_name"
    ).split(),
    "BIGINT": "spu_id tm_id category3_id".split(),
}

# --- streaming twins --------------------------------------------------------------

SQL |= {
    "log_route_stream": SQL["log_route"],
    "dau_first_visit_stream": SQL["dau_first_visit"],
    "order_first_flag_stream": SQL["order_first_flag_state"],
    "order_first_flag_batch_stream": SQL["order_first_flag_state"],
    "order_wide_stream": _with("o", "l") + f"""
        SELECT l.id AS order_detail_id, order_id, order_status, create_time, o.user_id, sku_id,
               order_price AS sku_price, sku_num, 'sku ' || sku_id AS sku_name, benefit_reduce_amount, original_total_amount,
               feight_fee, final_total_amount, 0.0::DOUBLE AS final_detail_amount, dt,
               {", ".join(f"CAST(NULL AS {kind}) AS {name}" for kind, names in _UNSET.items() for name in names)}
        FROM l JOIN o ON l.order_id = o.id AND {_SALE_NEAR}""",
    "sale_interval_stream": _with("o", "l") + f"""
        SELECT CAST(order_id AS VARCHAR) AS order_id, l.id AS order_detail_id,
               CAST(user_id AS VARCHAR) AS user_id, order_price AS sku_price, dt
        FROM l JOIN o ON l.order_id = o.id AND {_SALE_NEAR}""",
    "order_split_amount_stream": SQL["order_split_amount"],
    "order_split_amount_batch_stream": SQL["order_split_amount"],
    "trademark_window_stream": SQL["trademark_window"],
    "sale_full_outer_stream": SQL["sale_full_outer"],
    "trademark_stat_stream": f"""
        SELECT CAST(tm_id AS VARCHAR) AS trademark_id, tm_name AS trademark_name, amount
        FROM ({SQL["trademark_amount"]})""",
    "topic_positions_stream": """
        SELECT event_id, user_id FROM events
        WHERE ts >= (SELECT min(ts) + (max(ts) - min(ts)) / 3 FROM events)""",
}
