"""Reference SQL for the registered queries, written for DuckDB.

The statements read the same tables and share no code with the engine.
"""

from __future__ import annotations

NOW = 1_700_000_000


def _epoch(ts: str) -> str:
    return f"CAST(floor(epoch_us({ts}) / 1000000.0) AS BIGINT)"


def _iso(seconds: str, nanos: str) -> str:
    """Shortest ISO date-time of exact seconds and nanoseconds."""
    at = f"make_timestamp(({seconds}) * 1000000)"
    return f"""(strftime({at}, '%Y-%m-%dT%H:%M') || CASE
        WHEN ({seconds}) % 60 = 0 AND ({nanos}) = 0 THEN ''
        ELSE strftime({at}, ':%S') || CASE
            WHEN ({nanos}) = 0 THEN ''
            WHEN ({nanos}) % 1000000 = 0 THEN '.' || lpad(CAST(({nanos}) // 1000000 AS VARCHAR), 3, '0')
            WHEN ({nanos}) % 1000 = 0 THEN '.' || lpad(CAST(({nanos}) // 1000 AS VARCHAR), 6, '0')
            ELSE '.' || lpad(CAST(({nanos}) AS VARCHAR), 9, '0') END END)"""


def _plain(value: str) -> str:
    return f"regexp_replace(CAST(CAST({value} AS DOUBLE) AS VARCHAR), '\\.0$', '')"


_SEEN_AT = _iso(_epoch("ts"), "(epoch_us(ts) % 1000000) * 1000")

USERS = f"""users AS (
    SELECT CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
           {_epoch("ts")} AS ts_sec, event_id AS pos, user_id, event_type AS last_event, value, props,
           {_SEEN_AT} AS seen_at
    FROM events)"""

CONTAINS = f"""contains AS (
    SELECT CASE l_returnflag WHEN 'N' THEN 'c' WHEN 'A' THEN 'u' ELSE 'd' END AS op,
           {_epoch("l_shipdate")} AS ts_sec, l_suppkey AS pos, CAST(l_quantity AS INTEGER) AS rw,
           l_orderkey, l_partkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
           l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
    FROM lineitem)"""

ORDERS = f"""placed AS (
    SELECT 'c' AS op, {_epoch("o_orderdate")} AS ts_sec, o_orderkey AS pos, o_orderkey, o_custkey, o_orderstatus,
           o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
    FROM orders)"""

TAIL = f"""tail AS (
    SELECT CASE o_orderstatus WHEN 'P' THEN 'd' ELSE 'u' END AS op, {_epoch("o_orderdate")} AS ts_sec,
           o_orderkey AS pos, c_custkey, c_name, c_nationkey, o_totalprice AS c_acctbal, c_mktsegment
    FROM orders JOIN customer ON o_custkey = c_custkey)"""

MIXED = f"""{USERS}, {CONTAINS}, {ORDERS}, {TAIL}, mixed AS (
    SELECT 'users' AS tab, op, ts_sec, pos FROM users
    UNION ALL SELECT 'contains', op, ts_sec, pos FROM contains
    UNION ALL SELECT 'orders', op, ts_sec, pos FROM placed
    UNION ALL SELECT 'customer', op, ts_sec, pos FROM tail)"""

_CLASS = "CASE op WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' ELSE 'INSERT' END"

LABELS = """labels_read AS (
    SELECT * FROM (VALUES ('users', 'shop.user', 'vertex'), ('customer', 'shop.customer', 'vertex'),
        ('orders', 'shop.order', 'vertex'), ('orders', 'shop.placed', 'edge'),
        ('contains', 'shop.contains', 'edge'), ('contains', 'shop.contains_any', 'edge')) t(tab, label, kind))"""


def _newest(rows: str, key: str, order: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {rows}) WHERE rn = 1"""


_USER_STATE = f"""{USERS}, user_newest AS ({_newest("users", "user_id", "ts_sec DESC, pos DESC")})"""

_LINE_ORDER = (
    "ts_sec DESC, pos DESC, rw DESC, (op = 'd') DESC, l_linenumber DESC, l_suppkey DESC, l_quantity DESC, "
    "l_extendedprice DESC, l_discount DESC, l_tax DESC, l_linestatus DESC, l_shipdate DESC"
)
_LINE_COLUMNS = """l_orderkey AS _src, l_partkey AS _dst, {rank} AS _rank, l_linenumber AS line,
    l_suppkey AS supplier, l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount,
    l_tax AS tax, l_linestatus AS line_status, l_shipdate AS shipped_on"""
_RANKED = _LINE_COLUMNS.format(rank="CAST(l_linenumber AS BIGINT)")

_CUSTOMER_ROWS = f"""{TAIL}, customer_rows AS (
    SELECT 'r' AS op, 0 AS ts_sec, 0 AS pos, * FROM customer UNION ALL SELECT * FROM tail),
    customer_newest AS ({_newest("customer_rows", "c_custkey", "ts_sec DESC, pos DESC")})"""
_CUSTOMER_COLUMNS = """c_custkey AS _vid, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
    c_mktsegment AS segment"""
_USER_COLUMNS = "user_id AS _vid, last_event, value, props, seen_at"

VERTEX_STATE = f"WITH {_USER_STATE} SELECT {_USER_COLUMNS} FROM user_newest WHERE op <> 'd'"
CUSTOMER_STATE = f"WITH {_CUSTOMER_ROWS} SELECT {_CUSTOMER_COLUMNS} FROM customer_newest WHERE op <> 'd'"
EDGE_STATE_RANK = f"""WITH {CONTAINS}, newest AS (
    {_newest("contains", "l_orderkey, l_partkey, l_linenumber", _LINE_ORDER)})
    SELECT {_RANKED} FROM newest WHERE op <> 'd'"""


def _routed(flag: str, op: str) -> str:
    return f"WITH {CONTAINS} SELECT {_RANKED}, op AS _op FROM contains WHERE op = '{op}'"


_US = "epoch_us(ts)"
_OLD = "(epoch_us(ts) - 2000000000000000)"
_X, _Y, _O = _plain("c_acctbal"), _plain("-c_nationkey"), "'0'"


def _points(*pairs: tuple[str, str]) -> str:
    return " || ', ' || ".join(f"{a} || ' ' || {b}" for a, b in pairs)


_RING = [(_O, _O), (_X, _O), (_X, _Y), (_O, _O)]

_USER_TEXT = """('{"op":"' || op || '","ts_sec":' || ts_sec || ',"db":"shop","table":"users","key":["user_id"],'
    || '"data":{"user_id":' || user_id || ',"last_event":"' || last_event || '","value":' || CAST(value AS VARCHAR)
    || ',"props":"' || replace(props, '"', '\\"') || '","seen_at":"' || seen_at || '"},"parse_time":' || (ts_sec + 1)
    || ',"seq":{"ts_sec":' || ts_sec || ',"file":"","pos":' || pos || ',"row":0}}')"""

ORACLE: dict[str, str] = {
    "vertex_state": VERTEX_STATE,
    "late_change": VERTEX_STATE,
    "stream_vertex_state": VERTEX_STATE,
    "deleted_keys": f"WITH {_USER_STATE} SELECT user_id AS _vid FROM user_newest WHERE op = 'd'",
    "vertex_lookup": f"""WITH {_USER_STATE} SELECT {_USER_COLUMNS} FROM user_newest
        WHERE op <> 'd' AND user_id IN (SELECT s_suppkey FROM supplier)""",
    "bootstrap_state": CUSTOMER_STATE,
    "merged_state": CUSTOMER_STATE,
    "chunked_bootstrap": CUSTOMER_STATE,
    "store_bootstrap": CUSTOMER_STATE,
    "store_lookup": f"""WITH {_CUSTOMER_ROWS} SELECT {_CUSTOMER_COLUMNS} FROM customer_newest
        WHERE op <> 'd' AND c_custkey IN (SELECT s_suppkey FROM supplier)""",
    "edge_state_rank": EDGE_STATE_RANK,
    "stream_resume": EDGE_STATE_RANK,
    "edge_state": f"""WITH {CONTAINS}, newest AS ({_newest("contains", "l_orderkey, l_partkey", _LINE_ORDER)})
        SELECT {_LINE_COLUMNS.format(rank="CAST(0 AS BIGINT)")} FROM newest WHERE op <> 'd'""",
    "scope_feed": f"""WITH {MIXED} SELECT 'shop' AS db, tab AS "table", op, count(*) AS changes,
        min(ts_sec) AS first_sec, max(ts_sec) AS last_sec FROM mixed WHERE tab <> 'customer' GROUP BY tab, op""",
    "multi_source_route": f"""WITH {MIXED}
        SELECT CASE WHEN tab = 'orders' THEN 'sales' ELSE 'crm' END AS source, label, {_CLASS} AS op_class,
               count(*) AS changes
        FROM mixed JOIN (VALUES ('users', 'shop.user'), ('customer', 'shop.customer'), ('orders', 'shop.order'),
            ('orders', 'shop.placed')) t(tab, label) USING (tab) GROUP BY ALL""",
    "envelope_decode": f"""WITH {USERS} SELECT op, ts_sec, 'shop' AS db, 'users' AS "table", 'user_id' AS key,
        {_USER_TEXT} AS envelope, ts_sec + 1 AS parse_time, pos, CAST(0 AS INTEGER) AS "row" FROM users""",
    "envelope_encode": f"""WITH {ORDERS} SELECT
        '{{"op":"c","ts_sec":' || ts_sec || ',"db":"shop","table":"orders","key":["o_orderkey"],"data":'
        || '{{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus
        || '","o_totalprice":' || CAST(o_totalprice AS VARCHAR) || ',"o_orderdate":"' || o_orderdate || '"'
        || CASE o_orderpriority WHEN '5-LOW' THEN '' ELSE ',"o_orderpriority":"' || o_orderpriority || '"' END
        || '}},"parse_time":' || (ts_sec + 1) || ',"seq":{{"ts_sec":' || ts_sec || ',"file":"","pos":' || pos
        || ',"row":0}}}}' AS value FROM placed""",
    "label_csv": """SELECT c_custkey AS _vid, c_nationkey AS nation, c_name AS name, c_acctbal AS balance
        FROM customer""",
    "snapshot_fan_out": """SELECT strftime(o_orderdate, '%Y-%m-%d') AS placed_on, count(*) AS orders,
        max(o_orderkey) AS last_order, count(*) AS edges, max(o_custkey) AS last_customer FROM orders GROUP BY 1""",
    "normalize_changes": f"""SELECT CASE o_orderstatus WHEN 'F' THEN 'c' WHEN 'O' THEN 'u' ELSE 'd' END AS op,
        {_epoch("o_orderdate")} AS ts_sec, 'shop' AS db, 'orders' AS "table",
        '{{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_totalprice":'
            || CAST(CASE o_orderstatus WHEN 'P' THEN o_totalprice / 2 ELSE o_totalprice END AS VARCHAR)
            || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d') || '","o_orderpriority":"'
            || o_orderpriority || '"}}' AS data,
        'o_orderkey' AS key, CAST({NOW} AS BIGINT) AS parse_time, 'bin.000001' AS file, o_orderkey AS pos
        FROM orders""",
    "image_select": """SELECT CASE o_orderstatus WHEN 'F' THEN 'c' WHEN 'O' THEN 'u' ELSE 'd' END AS op, o_orderkey,
        CASE o_orderstatus WHEN 'P' THEN o_totalprice / 2 ELSE o_totalprice END AS price FROM orders""",
    "origin_split": """SELECT event_id, 'shop_' || length(event_type) AS db, event_type AS "table" FROM events""",
    "key_columns": """SELECT 'contains' AS "table", 'l_orderkey,l_partkey,l_linenumber' AS key, count(*) AS changes
        FROM lineitem UNION ALL SELECT 'part', 'p_partkey', count(*) FROM part
        UNION ALL SELECT 'keyless', NULL, count(*) FROM events""",
    "render_ints": """SELECT CAST(p_size AS TINYINT) AS int8, CAST(p_size AS SMALLINT) AS int16, p_size AS int32,
        p_partkey AS int64, CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS float32, p_retailprice AS float64,
        p_size > 25 AS large, CAST(CAST(p_retailprice AS DECIMAL(12, 2)) AS VARCHAR) AS exact, p_name AS name
        FROM part""",
    "render_bytes": """WITH listed AS (SELECT doc_id, '[' || array_to_string(list_transform(
            regexp_extract_all(hex(encode(text)), '..'),
            lambda h: CASE WHEN h >= '80' THEN CAST('0x' || h AS INTEGER) - 256 ELSE CAST('0x' || h AS INTEGER) END
        ), ', ') || ']' AS t FROM documents)
        SELECT doc_id, md5(t) AS digest, CAST(length(t) AS INTEGER) AS chars FROM listed""",
    "render_dates": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS placed_on,
        strftime(CAST(o_orderdate AS DATE) - 20000, '%Y-%m-%d') AS long_ago FROM orders""",
    "render_timestamps": f"""SELECT event_id,
        {_iso(_epoch("ts"), f"({_US} % 1000000 // 1000) * 1000000")} AS millis,
        {_iso(_epoch("ts"), f"({_US} % 1000000) * 1000")} AS micros,
        {_iso(_epoch("ts"), f"({_US} % 1000000) * 1000 + user_id % 1000")} AS nanos,
        {_iso(f"CAST(floor({_OLD} / 1000000.0) AS BIGINT)", f"(({_OLD} % 1000000 + 1000000) % 1000000) * 1000")}
            AS before_1970,
        strftime(ts, '%Y-%m-%dT%H:%M') AS minutes FROM events""",
    "render_zoned": f"""SELECT event_id, {_SEEN_AT} AS utc,
        {_iso(f"({_epoch('ts')} + 28800)", f"({_US} % 1000000) * 1000")} AS shanghai FROM events""",
    "render_time": """SELECT event_id, strftime(ts, '%H:%M:%S') AS of_micros, strftime(ts, '%H:%M:%S') AS of_nanos,
        strftime(ts, '%H:%M:%S') AS of_millis, strftime(ts, '%I:%M:%S') AS half_day FROM events""",
    "geometry_gate": f"""SELECT c_custkey, CASE c_mktsegment
        WHEN 'BUILDING' THEN 'POINT (' || {_points((_X, _Y))} || ')'
        WHEN 'MACHINERY' THEN 'LINESTRING (' || {_points((_X, _Y), (_Y, _X), (_O, _X))} || ')'
        WHEN 'FURNITURE' THEN 'POLYGON ((' || {_points(*_RING)} || '), (' || {_points(*_RING[::-1])} || '))'
        WHEN 'HOUSEHOLD' THEN NULL ELSE 'POINT (' || {_points((_Y, _X))} || ')' END AS shape FROM customer""",
    "geometry_refused": """SELECT c_custkey, 'MultiPoint' AS geometry_kind FROM customer
        WHERE c_mktsegment = 'HOUSEHOLD'""",
    "geometry_kinds": """SELECT CASE c_mktsegment WHEN 'MACHINERY' THEN 'LineString' WHEN 'FURNITURE' THEN 'Polygon'
        WHEN 'HOUSEHOLD' THEN 'MultiPoint' ELSE 'Point' END AS kind, count(*) AS shapes FROM customer GROUP BY 1""",
    "null_absent": """SELECT o_orderkey AS _vid,
        CASE WHEN o_orderpriority IN ('5-LOW', '1-URGENT') THEN NULL ELSE o_orderpriority END AS priority,
        CAST(NULL AS VARCHAR) AS status FROM orders""",
    "route_insert": _routed("N", "c"),
    "route_update": _routed("A", "u"),
    "route_delete": _routed("R", "d"),
    "route_table": f"WITH {USERS} SELECT op, ts_sec, pos, {_USER_TEXT} AS envelope FROM users",
    "fan_out": f"""WITH {MIXED}, {LABELS} SELECT label, kind, {_CLASS} AS op_class, count(*) AS changes,
        max(ts_sec) AS last_sec FROM mixed JOIN labels_read USING (tab) GROUP BY ALL""",
    "key_coverage": """SELECT 'shop.placed' AS label, 'o_custkey' AS missing, count(*) AS changes FROM orders""",
    "unrouted": f"""WITH {TAIL} SELECT 'shop' AS db, 'customer' AS "table", op, ts_sec, pos FROM tail""",
    "rejected_changes": f"""WITH {TAIL} SELECT 'unrouted' AS reason, 'customer' AS "table", count(*) AS changes FROM tail
        UNION ALL SELECT 'bad_op', 'orders', count(*) FROM orders
        UNION ALL SELECT 'bad_json', NULL, count(*) FROM pages""",
    "project_slots": f"""WITH {CONTAINS} SELECT op AS _op, ts_sec, l_orderkey, l_partkey, l_linenumber, l_suppkey,
        l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, l_shipdate FROM contains""",
    "vertex_rows": f"""WITH {ORDERS} SELECT o_orderkey AS _vid, o_orderstatus AS status, o_totalprice AS total,
        o_orderdate AS placed_on, o_orderpriority AS priority, op AS _op FROM placed""",
    "edge_rows": f"""WITH {ORDERS} SELECT o_custkey AS _src, o_orderkey AS _dst, CAST(0 AS BIGINT) AS _rank,
        o_totalprice AS total, o_orderdate AS placed_on, op AS _op FROM placed""",
    "edge_rows_rank": f"WITH {CONTAINS} SELECT {_RANKED}, op AS _op FROM contains",
    "key_moves": """SELECT o_custkey AS _src, o_orderkey AS _dst, CAST(0 AS BIGINT) AS _rank, o_totalprice AS total
        FROM orders""",
    "key_moves_vertex": "SELECT o_orderkey AS _vid, o_totalprice AS total FROM orders",
    "rejected_values": f"""WITH {TAIL} SELECT CASE WHEN op = 'd' THEN 'null_key' ELSE 'bad_value' END AS reason, op,
        count(*) AS changes FROM tail JOIN customer USING (c_custkey) WHERE op <> 'd' OR customer.c_nationkey = 3 GROUP BY op""",
    "normalize_mixed": """SELECT 'shop' AS db, 'orders' AS "table", CASE o_orderstatus WHEN 'F' THEN 'c' WHEN 'O' THEN 'u' ELSE 'd' END AS op,
            'o_orderkey' AS key, count(*) AS changes, CAST(sum(o_custkey) AS BIGINT) AS total,
            min(strftime(o_orderdate, '%Y-%m-%d')) AS least, max(o_orderkey) AS last FROM orders GROUP BY o_orderstatus
        UNION ALL SELECT 'shop', 'customer', 'c', 'c_custkey', count(*), CAST(sum(c_nationkey) AS BIGINT), min(c_name), max(c_custkey) FROM customer""",
    "snapshot_tail_render": """SELECT o_orderkey AS _vid, strftime(o_orderdate, '%Y-%m-%dT%H:%M') || '|' || strftime(o_orderdate, '%Y-%m-%d')
            || '|[' || ascii(o_orderpriority) || ', ' || ascii(o_orderpriority[2:]) || ']|'
            || regexp_replace(regexp_replace(CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR), '0+$', ''), '[.]$', '') AS text
        FROM orders""",
    "edge_fetch": f"""WITH {ORDERS} SELECT o_custkey AS _src, o_orderkey AS _dst, CAST(0 AS BIGINT) AS _rank,
        o_totalprice AS total, o_orderdate AS placed_on FROM placed WHERE o_orderstatus = 'O'""",
    "one_hop": """SELECT o_custkey AS _src, o_orderkey AS _dst, CAST(0 AS BIGINT) AS _rank
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'""",
    "graph_stats": f"""WITH {_USER_STATE}, {TAIL}, {CONTAINS},
        tail_newest AS ({_newest("tail", "c_custkey", "ts_sec DESC, pos DESC")}),
        line_newest AS ({_newest("contains", "l_orderkey, l_partkey, l_linenumber", _LINE_ORDER)}),
        ids AS (SELECT 'shop.user' AS name, user_id AS id FROM user_newest WHERE op <> 'd'
            UNION ALL SELECT 'shop.customer', c_custkey FROM tail_newest WHERE op <> 'd'
            UNION ALL SELECT 'shop.order', o_orderkey FROM orders),
        links AS (SELECT 'shop.placed' AS name FROM orders
            UNION ALL SELECT 'shop.contains' FROM line_newest WHERE op <> 'd')
        SELECT 'shop' AS space, 'Tag' AS type, name, count(*) AS count FROM ids GROUP BY name
        UNION ALL SELECT 'shop', 'Edge', name, count(*) FROM links GROUP BY name
        UNION ALL SELECT 'shop', 'Space', 'vertices', count(DISTINCT id) FROM ids
        UNION ALL SELECT 'shop', 'Space', 'edges', count(*) FROM links""",
    "reconcile": f"""WITH {_CUSTOMER_ROWS}, graph AS (SELECT * FROM customer_newest WHERE op <> 'd'),
        source AS (SELECT * FROM customer WHERE c_acctbal > 0)
        SELECT coalesce(s.c_custkey, g.c_custkey) AS _vid,
            CASE WHEN g.c_custkey IS NULL THEN 'missing' WHEN s.c_custkey IS NULL THEN 'extra' ELSE 'differs' END
                AS status,
            CASE WHEN g.c_custkey IS NULL OR s.c_custkey IS NULL THEN '' ELSE 'balance' END AS columns
        FROM source s FULL OUTER JOIN graph g ON s.c_custkey = g.c_custkey
        WHERE g.c_custkey IS NULL OR s.c_custkey IS NULL OR s.c_acctbal <> g.c_acctbal""",
}

# The store gives what the operators give on the whole feed.
ORACLE |= {"store_edges": ORACLE["edge_state"], "store_fetch": ORACLE["edge_fetch"], "store_one_hop": ORACLE["one_hop"]}
ORACLE |= {"state_view": VERTEX_STATE, "stream_key_coverage": ORACLE["key_coverage"]}
ORACLE["raw_to_reconcile"] = """WITH graph AS (SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O')),
    source AS (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW')
    SELECT coalesce(s.o_orderkey, g.o_orderkey) AS _vid,
        CASE WHEN g.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra' ELSE 'differs' END AS status,
        CASE WHEN g.o_orderkey IS NULL OR s.o_orderkey IS NULL THEN '' ELSE 'total' END AS columns
    FROM source s FULL OUTER JOIN graph g ON s.o_orderkey = g.o_orderkey
    WHERE g.o_orderkey IS NULL OR s.o_orderkey IS NULL OR s.o_orderpriority = '2-HIGH'"""
ORACLE["one_hop_heavy"] = """WITH edges AS (
    SELECT CASE WHEN l_orderkey % 2 = 0 THEN CAST(0 AS BIGINT) ELSE l_orderkey END AS _src, l_partkey AS _dst,
        l_orderkey * 10 + l_linenumber AS _rank FROM lineitem)
    SELECT * FROM edges WHERE _src = 0 OR _src IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')"""
ORACLE["reconcile_ranges"] = ORACLE["reconcile"]
