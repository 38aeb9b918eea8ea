"""The workloads in plain SQL, for checking results in another engine."""

_LATEST = """
    SELECT l_partkey AS tick_id, l_partkey AS asset, l_extendedprice / l_quantity AS current_price
    FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_partkey
        ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice / l_quantity DESC) = 1
"""

_RULES = """
    SELECT l_orderkey AS chat_id, l_partkey AS crypto_type, l_extendedprice / l_quantity AS purchase_price,
           l_tax * 100 AS desired_profit_percentage, l_discount * 100 AS desired_loss_percentage,
           l_shipdate AS created_at,
           CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS is_alerted
    FROM lineitem
"""

# Pending rules of _RULES that fire against _LATEST.
_FIRED = f"""
    SELECT * FROM (
        SELECT r.*, t.tick_id, t.current_price,
               purchase_price * (1 + desired_profit_percentage / 100) AS profit_target,
               purchase_price * (1 - desired_loss_percentage / 100) AS loss_limit
        FROM ({_RULES}) r JOIN ({_LATEST}) t ON r.crypto_type = t.asset
        WHERE r.is_alerted = false)
    WHERE current_price >= profit_target OR current_price <= loss_limit
"""

_CHATS = """
    SELECT o_orderkey AS chat_id, o_orderdate,
        CASE o_orderpriority
            WHEN '1-URGENT' THEN 'crypto_type=' || o_orderstatus || ', purchase_price=' || o_totalprice::VARCHAR
                || ', desired_profit_percentage=10, desired_loss_percentage=5'
            WHEN '2-HIGH' THEN 'crypto_type=' || o_orderstatus || ',,purchase_price=' || o_totalprice::VARCHAR
            WHEN '3-MEDIUM' THEN ' Crypto_Type = first ,' || chr(9) || 'purchase_price= ' || o_totalprice::VARCHAR
                || ' ,CRYPTO_TYPE=' || o_orderstatus || ',other=x' || chr(10)
            WHEN '4-NOT SPECIFIED' THEN '/start ' || o_totalprice::VARCHAR
            ELSE 'chat_id=7,crypto_type=,purchase_price=' || o_totalprice::VARCHAR
                || ',created_at=never,=5,desired_loss_percentage=abc'
        END AS text
    FROM orders
"""

# Fields split and stripped one by one; the last pair of a name wins.
_KV = f"""
    SELECT chat_id AS sender, text, o_orderdate, pairs,
           len(list_filter(pairs, lambda p: len(p) <> 2)) = 0 AS well_formed
    FROM (
        SELECT *, list_transform(string_split(text, ','),
                      lambda f: string_split(trim(f, ' ' || chr(9) || chr(10) || chr(13)), '=')) AS pairs
        FROM ({_CHATS}) WHERE NOT starts_with(text, '/'))
"""


def _kv_value(name: str) -> str:
    return f"""list_last(list_transform(
        list_filter(pairs, lambda p: lower(trim(p[1], ' ' || chr(9) || chr(10) || chr(13))) = '{name}'),
        lambda p: trim(p[2], ' ' || chr(9) || chr(10) || chr(13))))"""


_KV_RULES = f"""
    SELECT coalesce({_kv_value("chat_id")}, sender::VARCHAR) AS chat_id,
           {_kv_value("crypto_type")} AS crypto_type,
           {_kv_value("purchase_price")} AS purchase_price,
           {_kv_value("desired_profit_percentage")} AS desired_profit_percentage,
           {_kv_value("desired_loss_percentage")} AS desired_loss_percentage,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS created_at
    FROM ({_KV}) WHERE well_formed
"""

_WIRE_RULES = """
    SELECT CASE WHEN o_orderstatus = 'P' THEN o_orderkey::VARCHAR || '.0' ELSE o_orderkey::VARCHAR END AS chat_id,
           o_orderstatus AS crypto_type,
           CASE o_orderpriority WHEN '1-URGENT' THEN '30,000' ELSE o_totalprice::VARCHAR END AS purchase_price,
           CASE o_orderpriority WHEN '2-HIGH' THEN ' 12 ' WHEN '3-MEDIUM' THEN '1e3' ELSE o_orderpriority END
               AS desired_profit_percentage,
           CASE o_orderpriority WHEN '5-LOW' THEN '' ELSE '5' END AS desired_loss_percentage,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'junk'
               WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
               WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.250000')
               WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
                   || CASE o_orderstatus WHEN 'F' THEN '+02' WHEN 'O' THEN 'z' ELSE ' UTC' END
               ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS created_at,
           o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate
    FROM orders
"""

_TYPED_RULES = f"""
    SELECT o_orderkey AS chat_id, crypto_type,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS purchase_price,
           CASE o_orderpriority WHEN '2-HIGH' THEN 12.0::DOUBLE WHEN '3-MEDIUM' THEN 1000.0::DOUBLE END
               AS desired_profit_percentage,
           CASE WHEN o_orderpriority <> '5-LOW' THEN 5.0::DOUBLE END AS desired_loss_percentage,
           CASE o_orderpriority WHEN '1-URGENT' THEN NULL
               WHEN '4-NOT SPECIFIED' THEN epoch_us(o_orderdate) - CASE o_orderstatus WHEN 'F' THEN 7200000000 ELSE 0 END
               WHEN '3-MEDIUM' THEN epoch_us(o_orderdate) + 250000 ELSE epoch_us(o_orderdate) END AS created_at,
           false AS is_alerted
    FROM ({_WIRE_RULES}) WHERE o_orderstatus <> 'P'
"""


def _json_text(*names: str) -> str:
    """JSON object of text columns, NULL fields kept."""
    pairs = ", ".join(f"'{n}', {n}" for n in names)
    return f"json_object({pairs})::VARCHAR"


_WIRE_NAMES = (
    "chat_id",
    "crypto_type",
    "purchase_price",
    "desired_profit_percentage",
    "desired_loss_percentage",
    "created_at",
)

_REJECTED_RULES = f"""
    SELECT {_json_text(*_WIRE_NAMES)} AS value, 'chat_id is not a whole number' AS reason
    FROM ({_WIRE_RULES}) WHERE o_orderstatus = 'P'
"""

_EVENT_TICKS = """
    SELECT user_id::VARCHAR AS id, event_type AS symbol, 'asset ' || user_id::VARCHAR AS name,
           value AS current_price, event_id AS market_cap, user_id AS total_volume,
           CASE WHEN ts >= TIMESTAMP '2024-01-21' THEN 2 WHEN ts >= TIMESTAMP '2024-01-11' THEN 1 ELSE 0 END::BIGINT
               AS batch_id
    FROM events
"""

_FLAGGED_EVENTS = """
    SELECT e.*, EXISTS (
        SELECT 1 FROM events f
        WHERE f.value > 300 AND f.user_id = e.user_id AND f.event_type = e.event_type) AS is_alerted
    FROM events e
"""

_MONEY_LINES = """
    SELECT r.*, t.tick_id, t.current_price,
           r.purchase_price * (1 + r.desired_profit_percentage / 100) AS profit_target,
           r.purchase_price * (1 - r.desired_loss_percentage / 100) AS loss_limit
    FROM (SELECT l_orderkey AS chat_id, l_partkey AS crypto_type, l_extendedprice AS purchase_price,
                 l_quantity AS desired_profit_percentage, l_quantity AS desired_loss_percentage,
                 l_shipdate AS created_at
          FROM lineitem WHERE l_returnflag <> 'R') r
    JOIN (SELECT l_partkey AS tick_id, l_extendedprice AS current_price FROM lineitem
          QUALIFY row_number() OVER (
              PARTITION BY l_partkey
              ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) = 1) t
    ON r.crypto_type = t.tick_id
"""

ORACLES: dict[str, str] = {
    "threshold_alerts": f"""
        SELECT * FROM (
            SELECT chat_id, crypto_type, purchase_price, desired_profit_percentage, desired_loss_percentage,
                   tick_id, current_price,
                   purchase_price * (1 + desired_profit_percentage / 100) AS profit_target,
                   purchase_price * (1 - desired_loss_percentage / 100) AS loss_limit,
                   CASE WHEN current_price >= purchase_price * (1 + desired_profit_percentage / 100) THEN 'profit'
                        WHEN current_price <= purchase_price * (1 - desired_loss_percentage / 100) THEN 'loss'
                   END AS side
            FROM (SELECT l_orderkey AS chat_id, l_partkey AS crypto_type,
                         l_extendedprice / l_quantity AS purchase_price,
                         l_tax * 100 AS desired_profit_percentage, l_discount * 100 AS desired_loss_percentage
                  FROM lineitem WHERE l_returnflag <> 'R') r
            JOIN ({_LATEST}) t ON r.crypto_type = t.asset)
        WHERE side IS NOT NULL""",
    "threshold_rejects": f"""
        SELECT l_orderkey AS chat_id, l_partkey AS crypto_type, l_extendedprice / l_quantity AS purchase_price,
               CASE WHEN l_discount <> 0 THEN l_discount * 100 END AS desired_loss_percentage,
               t.tick_id, t.current_price
        FROM lineitem JOIN ({_LATEST}) t ON l_partkey = t.asset
        WHERE l_returnflag <> 'R' AND (l_tax = 0 OR l_discount = 0)""",
    "latest_by_type": """
        SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "latest_by_user_type": """
        SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "latest_by_part": _LATEST,
    "pending_rules": "SELECT *, false AS is_alerted FROM orders WHERE o_orderstatus = 'O'",
    "render_messages": f"""
        SELECT md5(concat_ws(chr(31), '=' || chat_id, '=' || crypto_type, '=' || purchase_price::VARCHAR,
                             '=' || desired_profit_percentage::VARCHAR, '=' || desired_loss_percentage::VARCHAR,
                             '=' || strftime(created_at, '%Y-%m-%d %H:%M:%S'), '=' || tick_id, '=' || side)) AS notification_id,
               chat_id,
               -- fixed values: the wording of a notification
               CASE side WHEN 'profit' THEN
                   '📈 ' || crypto_type || ' hit your profit target!' || chr(10)
                   || 'Current price: $' || printf('%.2f', current_price) || chr(10)
                   || '(target: $' || printf('%.2f', profit_target) || ' = ' || purchase_price::VARCHAR
                   || ' * (1 + ' || desired_profit_percentage::VARCHAR || '/100))'
               ELSE
                   '📉 ' || crypto_type || ' dropped below your stop-loss!' || chr(10)
                   || 'Current price: $' || printf('%.2f', current_price) || chr(10)
                   || '(limit: $' || printf('%.2f', loss_limit) || ' = ' || purchase_price::VARCHAR
                   || ' * (1 - ' || desired_loss_percentage::VARCHAR || '/100))'
               END AS text
        FROM (SELECT *, CASE WHEN current_price >= profit_target THEN 'profit'
                             WHEN current_price <= loss_limit THEN 'loss' END AS side
              FROM ({_MONEY_LINES}))
        WHERE side IS NOT NULL AND chat_id <> 0""",
    # one receipt for each notification sent: those that failed at first carry the second attempt
    "deliver_once": f"""
        SELECT md5(concat_ws(chr(31), '=' || chat_id, '=' || crypto_type, '=' || purchase_price::VARCHAR,
                             '=' || desired_profit_percentage::VARCHAR, '=' || desired_loss_percentage::VARCHAR,
                             '=' || strftime(created_at, '%Y-%m-%d %H:%M:%S'), '=' || tick_id, '=' || side)) AS notification_id,
               chat_id, NULL::VARCHAR AS error, 0::BIGINT AS turn, (chat_id % 2)::INTEGER AS attempt
        FROM (SELECT *, CASE WHEN current_price >= profit_target THEN 'profit'
                             WHEN current_price <= loss_limit THEN 'loss' END AS side
              FROM ({_MONEY_LINES}))
        WHERE side IS NOT NULL AND chat_id <> 0""",
    "notify_stream": f"""
        SELECT md5(concat_ws(chr(31), '=' || chat_id, '=' || crypto_type, '=' || purchase_price::VARCHAR,
                             '=' || desired_profit_percentage::VARCHAR, '=' || desired_loss_percentage::VARCHAR,
                             '=' || strftime(created_at, '%Y-%m-%d %H:%M:%S'), '=' || tick_id, '=' || side)) AS notification_id,
               chat_id, NULL::VARCHAR AS error, (chat_id % 2)::BIGINT AS batch
        FROM (SELECT *, CASE WHEN current_price >= profit_target THEN 'profit'
                             WHEN current_price <= loss_limit THEN 'loss' END AS side
              FROM ({_MONEY_LINES}))
        WHERE side IS NOT NULL AND chat_id <> 0""",
    "decode_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "decode_rejects": "SELECT text AS value, 'no declared field could be read' AS reason FROM documents",
    "decode_ticks": f"SELECT * EXCLUDE (batch_id) FROM ({_EVENT_TICKS})",
    "decode_field_rejects": """
        SELECT o_orderkey, field, wanted, found FROM orders JOIN (VALUES
            ('1-URGENT', 'current_price', 'double', 'STRING'), ('1-URGENT', 'total_volume', 'bigint', 'ARRAY'),
            ('2-HIGH', 'market_cap', 'bigint', 'DECIMAL')) w(priority, field, wanted, found) ON o_orderpriority = priority""",
    "type_rules": _TYPED_RULES,
    "type_rejects": _REJECTED_RULES,
    "kv_rules": _KV_RULES,
    "kv_rejects": f"""
        SELECT sender AS chat_id, text,
               '❌ Invalid format. Please use:' || chr(10)
               || 'crypto_type=..., purchase_price=..., profit=..., loss=...' AS reason
        FROM ({_KV}) WHERE NOT well_formed""",
    "chat_replies": f"""
        SELECT md5(concat_ws(chr(31), '=' || chat_id, '=' || said)) AS notification_id, chat_id, text FROM (
            SELECT sender AS chat_id, text AS said,
                   '❌ Invalid format. Please use:' || chr(10)
                   || 'crypto_type=..., purchase_price=..., profit=..., loss=...' AS text
            FROM ({_KV}) WHERE NOT well_formed
            UNION ALL
            SELECT TRY_CAST(chat_id AS BIGINT), {_json_text(*_WIRE_NAMES)} AS said, said FROM ({_KV_RULES}))
        WHERE chat_id <> 0""",
    "encode_events": """
        SELECT event_id::VARCHAR AS key,
               json_object('event_id', event_id, 'user_id', user_id, 'event_type', event_type)::VARCHAR AS value
        FROM events""",
    "explode_payload": "SELECT event_id AS market_cap, value AS current_price FROM events",
    "rule_intake": f"SELECT {_json_text(*_WIRE_NAMES)} AS value FROM ({_KV_RULES})",
    "tick_intake": """
        SELECT json_object('id', user_id::VARCHAR, 'symbol', event_type, 'name', 'asset ' || user_id::VARCHAR,
                           'current_price', value, 'market_cap', event_id, 'total_volume', user_id)::VARCHAR AS value
        FROM events""",
    "flag_update": _FLAGGED_EVENTS,
    "purge_flagged": f"SELECT * FROM ({_FLAGGED_EVENTS}) WHERE NOT is_alerted",
    "ttl_keep": "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00'",
    "day_slice": "SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
    "archive_day": "SELECT *, CAST(ts AS DATE) AS date FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
    "archive_by_day": "SELECT *, CAST(ts AS DATE) AS date FROM events",
    "archive_snapshot": "SELECT *, DATE '2024-01-31' AS date FROM orders",
    "cycle_rules": f"""
        SELECT r.* REPLACE (CASE WHEN EXISTS (
                   SELECT 1 FROM ({_FIRED}) f
                   WHERE f.chat_id = r.chat_id AND f.crypto_type = r.crypto_type
                     AND f.purchase_price = r.purchase_price) THEN true ELSE r.is_alerted END AS is_alerted)
        FROM ({_RULES}) r""",
    "cycle_turns": f"""
        SELECT DISTINCT chat_id, crypto_type, purchase_price, 0::BIGINT AS batch_id FROM ({_FIRED})""",
    "alert_once": f"""
        SELECT DISTINCT chat_id, crypto_type, purchase_price, 0::BIGINT AS batch_id FROM ({_FIRED}) WHERE chat_id % 7 <> 0""",
    "rules_table": f"""
        WITH fired AS (SELECT DISTINCT chat_id, crypto_type, purchase_price FROM ({_FIRED}))
        SELECT r.* REPLACE (CASE WHEN r.chat_id % 2 = 1 AND f.chat_id IS NOT NULL THEN true ELSE r.is_alerted END AS is_alerted)
        FROM ({_RULES}) r LEFT JOIN fired f
          ON f.chat_id = r.chat_id AND f.crypto_type = r.crypto_type AND f.purchase_price = r.purchase_price
        WHERE r.chat_id % 2 = 1 OR (r.is_alerted IS DISTINCT FROM true AND f.chat_id IS NULL)""",
    "clean_rules": f"""
        SELECT * REPLACE (crypto_type::VARCHAR AS crypto_type, epoch_us(created_at) AS created_at)
        FROM ({_RULES}) WHERE is_alerted IS DISTINCT FROM true""",
    "jobs_at_once": f"""
        WITH fired AS (SELECT DISTINCT chat_id, crypto_type, purchase_price FROM ({_FIRED}))
        SELECT 'fired' AS name, chat_id, crypto_type::VARCHAR AS crypto_type, purchase_price FROM fired
        UNION ALL
        SELECT 'left', r.chat_id, r.crypto_type::VARCHAR, r.purchase_price FROM ({_RULES}) r
        WHERE r.is_alerted IS DISTINCT FROM true AND NOT EXISTS (
            SELECT 1 FROM fired f WHERE f.chat_id = r.chat_id AND f.crypto_type = r.crypto_type AND f.purchase_price = r.purchase_price)""",
    "indexed_alerts": f"""
        SELECT chat_id, crypto_type::VARCHAR AS crypto_type, purchase_price, desired_profit_percentage, desired_loss_percentage,
               tick_id::VARCHAR AS tick_id, current_price, profit_target, loss_limit,
               CASE WHEN current_price >= profit_target THEN 'profit' ELSE 'loss' END AS side
        FROM ({_FIRED})""",
    "changed_turns": f"""
        WITH latest AS (
            SELECT turn, l_partkey AS asset, l_extendedprice / l_quantity AS price
            FROM lineitem, (VALUES (0), (1), (2)) t(turn) WHERE l_orderkey % 5 <= turn
            QUALIFY row_number() OVER (
                PARTITION BY turn, l_partkey
                ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice / l_quantity DESC) = 1)
        SELECT chat_id, crypto_type::VARCHAR AS crypto_type, purchase_price, min(turn)::BIGINT AS batch_id
        FROM ({_RULES}) JOIN latest ON asset = crypto_type AND turn >= chat_id % 3
        WHERE is_alerted = false
          AND (price >= purchase_price * (1 + desired_profit_percentage / 100) OR price <= purchase_price * (1 - desired_loss_percentage / 100))
        GROUP BY ALL""",
    "archive_tables": f"""
        SELECT 'rules' AS name, chat_id, purchase_price, DATE '2024-01-15' AS date
        FROM ({_RULES}) WHERE strftime(created_at, '%m-%d') = '06-15'
        UNION ALL SELECT 'ticks', event_id, value, DATE '2024-01-15' FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""",
    "today_defaults": """
        SELECT 'slice' AS name, event_id FROM events WHERE event_id % 3 = 0
        UNION ALL SELECT 'expiry', event_id FROM events WHERE event_id % 3 <> 1""",
    "landed_payloads": "SELECT event_id AS market_cap, (SELECT count(*) FROM events)::BIGINT AS records FROM events",
    "compact_rules": f"""
        SELECT r.* FROM ({_RULES}) r
        WHERE r.is_alerted IS DISTINCT FROM true AND NOT EXISTS (
            SELECT 1 FROM ({_FIRED}) f
            WHERE f.chat_id = r.chat_id AND f.crypto_type = r.crypto_type
              AND f.purchase_price = r.purchase_price)""",
    "stream_history": _EVENT_TICKS,
    "stream_restart": f"""
        SELECT * FROM ({_EVENT_TICKS}) WHERE batch_id < 2
        UNION ALL SELECT * REPLACE (0::BIGINT AS batch_id) FROM ({_EVENT_TICKS})""",
    "stream_replays": f"SELECT * EXCLUDE (batch_id) FROM ({_EVENT_TICKS})",
    "stream_pages": """
        WITH total AS (SELECT count(*) AS n FROM events),
        steps AS (SELECT step, CAST(floor(n * share) AS BIGINT) AS cut FROM total, (VALUES (0, 0.3::DOUBLE), (1, 0.71::DOUBLE), (2, 1.0::DOUBLE)) s(step, share)),
        whole AS (
            SELECT step, event_id // 1000 AS page FROM events, steps
            GROUP BY step, page HAVING count(*) = count(CASE WHEN event_id < cut THEN 1 END))
        SELECT step, page, event_id AS market_cap, value AS current_price
        FROM (SELECT step, max(page) AS page FROM whole GROUP BY step) JOIN events ON event_id // 1000 = page""",
    "expire_beside_stream": f"""
        SELECT t.* EXCLUDE (batch_id), epoch_us(ts) AS last_updated
        FROM ({_EVENT_TICKS}) t JOIN events ON event_id = market_cap WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC) = 1""",
    "arrival_stamp": f"SELECT market_cap, batch_id, true AS inside, 1::BIGINT AS stamps FROM ({_EVENT_TICKS})",
    "stream_snapshot": f"SELECT * EXCLUDE (batch_id) FROM ({_EVENT_TICKS}) WHERE batch_id = 2",
    "stream_upsert": f"""
        SELECT * EXCLUDE (batch_id) FROM ({_EVENT_TICKS})
        QUALIFY row_number() OVER (
            PARTITION BY id
            ORDER BY batch_id DESC, symbol DESC, name DESC, current_price DESC, market_cap DESC) = 1""",
    "stream_rules": f"""
        SELECT t.*, 0::BIGINT AS batch_id, sink FROM ({_TYPED_RULES}) t, (VALUES ('table'), ('history')) s(sink)""",
    "stream_rejects": f"""
        SELECT *, 0::BIGINT AS batch_id FROM ({_REJECTED_RULES})
        UNION ALL
        SELECT translate(text, chr(13) || chr(10), '  '), 'no declared field could be read', 1::BIGINT
        FROM conversations""",
    "stream_metrics": f"""
        WITH noise AS (SELECT count(*)::BIGINT AS n FROM conversations)
        SELECT batch_id, (count(*) + CASE batch_id WHEN 1 THEN n ELSE 0 END)::BIGINT AS messages, (CASE batch_id WHEN 1 THEN n ELSE 0 END)::BIGINT AS rejected
        FROM ({_EVENT_TICKS}), noise GROUP BY batch_id, n""",
    "alert_stream": f"""
        WITH sliced AS (
            SELECT e.*, t.batch_id FROM events e JOIN ({_EVENT_TICKS}) t ON e.event_id = t.market_cap),
        latest AS (
            SELECT * FROM sliced
            QUALIFY row_number() OVER (PARTITION BY user_id, batch_id ORDER BY ts DESC, event_id DESC) = 1)
        SELECT c_custkey AS chat_id, c_custkey AS crypto_type, 250.0::DOUBLE AS purchase_price,
               min(batch_id) AS batch_id
        FROM customer JOIN latest ON c_custkey = user_id
        WHERE value >= 250.0::DOUBLE * (1 + c_nationkey::DOUBLE / 100)
           OR value <= 250.0::DOUBLE * (1 - (c_nationkey * 2)::DOUBLE / 100)
        GROUP BY c_custkey""",
    "stream_static_join": """
        SELECT c_custkey AS chat_id, 'asset ' || c_custkey::VARCHAR AS crypto_type, c_acctbal AS purchase_price,
               10.0::DOUBLE AS desired_profit_percentage, 5.0::DOUBLE AS desired_loss_percentage,
               event_id AS tick_id, value AS current_price
        FROM events JOIN customer ON user_id = c_custkey""",
}
