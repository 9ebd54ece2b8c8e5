"""For each registered query the SQL that defines its result.

The SQL states the definition (a global row number, a plain group by), not the way the jobs get there.
"""

from __future__ import annotations

from collections.abc import Sequence

# Bytes per row: fixed widths by column type, text by its UTF-8 length.
ROW_BYTES = {
    "region": "4 + strlen(r_name)",
    "nation": "8 + strlen(n_name)",
    "customer": "20 + strlen(c_name) + strlen(c_mktsegment)",
    "supplier": "20 + strlen(s_name)",
    "part": "20 + strlen(p_name) + strlen(p_brand) + strlen(p_type)",
    "orders": "32 + strlen(o_orderstatus) + strlen(o_orderpriority)",
    "lineitem": "68 + strlen(l_returnflag) + strlen(l_linestatus)",
    "events": "32 + strlen(event_type) + strlen(props)",
    "documents": "16 + strlen(text) + strlen(lang) + strlen(source)",
    "embeddings": "12 + 4 * len(embedding)",
    "pages": "8 + strlen(url) + strlen(html)",
    "benchmark": "8 + strlen(text)",
    "labels": "16",
    "conversations": "16 + strlen(role) + strlen(text)",
}

_SIZES = " UNION ALL ".join(
    [
        f"SELECT '{t}' AS table_key, count(*) AS table_count, CAST(sum({b}) AS BIGINT) AS table_bytes FROM {t}"
        for t, b in ROW_BYTES.items()
    ]
    + ["SELECT 'orders_empty', 0, NULL"]
)
PROFILE = f"""sizes AS ({_SIZES}),
sized AS (SELECT table_key, table_count, coalesce(CAST(table_bytes AS DOUBLE) / 1048576, 0.1) AS table_size_mb FROM sizes),
profile AS (SELECT table_key, table_count, table_size_mb,
  CASE WHEN table_count > 0 AND table_size_mb / table_count = 0 THEN 0.00000001
       WHEN table_count > 0 THEN table_size_mb / table_count END AS avg_row_size_mb FROM sized),
sizing AS (SELECT table_key, table_count, avg_row_size_mb,
  greatest(1, CAST(round_even(CAST(0.15 AS DOUBLE) / avg_row_size_mb, 0) AS BIGINT)) AS chunk_rows FROM profile)"""


def _order(keys: Sequence[str]) -> str:
    return ", ".join(f"{k} ASC NULLS FIRST" for k in keys)


def paged(table: str, keys: Sequence[str], rows: int | str) -> str:
    """Rows with the number of their page."""
    return f"SELECT *, CAST(floor((row_number() OVER (ORDER BY {_order(keys)}) - 1) / {rows}) AS INTEGER) AS iteration FROM {table}"


def manifest(numbered: str, keys: Sequence[str], shown: Sequence[str], extra: str = "") -> str:
    """First and last row of every page of a numbered relation."""
    picks = "".join(
        f", max(CASE WHEN first_at = 1 THEN {k} END) AS lo_{k}, max(CASE WHEN last_at = 1 THEN {k} END) AS hi_{k}"
        for k in shown
    )
    back = ", ".join(f"{k} DESC NULLS LAST" for k in keys)
    return f"""WITH numbered AS ({numbered}),
placed AS (SELECT *, row_number() OVER (PARTITION BY iteration ORDER BY {_order(keys)}) AS first_at,
  row_number() OVER (PARTITION BY iteration ORDER BY {back}) AS last_at FROM numbered)
SELECT iteration, {extra}count(*) AS n_rows{picks} FROM placed GROUP BY iteration"""


LINEITEM_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
PART_ORDER = ["p_type", "p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"]
ORDERS_ORDER = ["o_orderdate", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]

EVENTS_PAGED = """SELECT *, CAST(dense_rank() OVER (ORDER BY day, page) - 1 AS INTEGER) AS iteration FROM (
  SELECT *, CAST(floor((row_number() OVER (PARTITION BY day ORDER BY event_id) - 1) / 200) AS BIGINT) AS page
  FROM (SELECT *, CAST(ts AS DATE) AS day FROM events))"""


def packed(column: str) -> str:
    """Index packing while every value stays under half a chunk; NULL is chunk 0."""
    return f"""counts AS (SELECT {column} AS v, count(*) AS n FROM orders GROUP BY 1),
filled AS (SELECT *, sum(n) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) - n AS before_it,
  max(n) OVER () AS max_n FROM counts WHERE v IS NOT NULL),
packs AS (SELECT v, n, floor(before_it / (4000 - max_n + 1)) AS pack FROM filled),
numbered AS (SELECT v, n, CAST(dense_rank() OVER (ORDER BY pack) - 1
  + (SELECT count(*) FROM counts WHERE v IS NULL) AS INTEGER) AS iteration FROM packs
  UNION ALL SELECT v, n, 0 FROM counts WHERE v IS NULL)"""


_PACKED_MANIFEST = """SELECT iteration, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_values,
min(v) AS lo_o_custkey, max(v) AS hi_o_custkey FROM numbered GROUP BY iteration"""

HISTORY = """history AS (SELECT CAST(l_orderkey % 2147483647 AS INTEGER) AS log_id, CAST(l_suppkey % 5 AS INTEGER) AS source_id,
  'SELECT * FROM t WHERE k = ' || l_partkey AS query, 'public' AS schema_name, 'sales' AS database_name,
  CASE l_suppkey % 5 WHEN 0 THEN 'mysql' WHEN 1 THEN 'maria' WHEN 2 THEN 'postgres' WHEN 3 THEN 'ibm' ELSE 'mssql' END AS rdbms_type,
  'table_' || (l_orderkey % 50) AS table_name, 'source_' || (l_suppkey % 5) AS source_name, 'blob' AS write_detail,
  l_suppkey || '/' || CAST(l_extendedprice AS DECIMAL(12,2)) AS write_sub_detail, l_partkey AS chunk_size,
  'clustered' AS extraction_approach, l_shipdate AS start_timestamp,
  l_shipdate + to_minutes(CAST(l_quantity AS INTEGER)) AS end_timestamp,
  CASE WHEN l_returnflag = 'R' AND l_suppkey % 4 = 0 THEN 'FAIL' ELSE 'PASS' END AS read_status,
  CAST(NULL AS VARCHAR) AS mask_read_status,
  CASE WHEN l_returnflag = 'R' THEN 'FAIL' ELSE 'PASS' END AS write_status,
  CASE WHEN l_partkey % 2 = 0 THEN NULL WHEN l_linestatus = 'F' AND l_suppkey % 3 = 0 THEN 'FAIL' ELSE 'PASS' END AS mask_write_status,
  l_linenumber AS iteration FROM lineitem)"""


def latest(history: str) -> str:
    return f"""SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY log_id, iteration
  ORDER BY end_timestamp DESC, chunk_size DESC, write_sub_detail DESC) AS nth FROM {history}) WHERE nth = 1"""


MASTER = """master AS (SELECT CAST(o_custkey % 2147483647 AS INTEGER) AS log_id, 'cust_' || o_custkey AS table_key,
  CASE o_orderstatus WHEN 'F' THEN 'Failed' WHEN 'O' THEN 'Success' ELSE 'Partial Success' END AS load_status,
  o_orderdate AS end_timestamp, o_orderkey AS attempt FROM orders),
master_now AS (SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY log_id
  ORDER BY end_timestamp DESC, attempt DESC) AS nth FROM master) WHERE nth = 1)"""

FAILED = f"""{HISTORY}, chunks_now AS ({latest("history")}), {MASTER},
failed AS (SELECT *, mask_write_status IS NOT NULL AS masking_applies, write_status = 'FAIL' AS rerun_raw,
  coalesce(mask_write_status = 'FAIL', false) AS rerun_masked FROM chunks_now
  WHERE (write_status = 'FAIL' OR mask_write_status = 'FAIL')
  AND log_id IN (SELECT log_id FROM master_now WHERE load_status = 'Failed'))"""

# Both sides of every validated table.
SIDES = """customer_landed AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS rn
  FROM customer) WHERE rn < 400 OR rn >= 800),
part_landed AS (SELECT * REPLACE (least(p_retailprice, 950.0) AS p_retailprice) FROM part),
supplier_masked AS (SELECT * FROM supplier WHERE s_nationkey <> 3)"""

PAIRS = {
    "orders": ("orders", "orders"),
    "customer": ("customer", "customer_landed"),
    "part": ("part", "part_landed"),
    "supplier": ("supplier", "supplier"),
    "nation": ("nation", "nation"),
}
MASKED_PAIRS = {
    "orders": ("orders", "orders", ["o_orderkey", "o_totalprice"]),
    "customer": ("customer", "customer_landed", ["c_custkey", "c_nationkey"]),
    "supplier": ("supplier", "supplier_masked", ["s_suppkey", "s_nationkey", "s_acctbal"]),
}
COLUMNS = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
}
DOUBLES = {"o_totalprice", "c_acctbal", "p_retailprice", "s_acctbal"}
TIMES = {"o_orderdate"}
NOT_LANDED = {"n_regionkey"}


def _shown(value: str, column: str) -> str:
    if column in DOUBLES:
        return f"CAST(CAST({value} AS DECIMAL(38,6)) AS VARCHAR)"
    if column in TIMES:
        return f"strftime({value}, '%Y-%m-%d %H:%M:%S.%f')"
    return f"CAST({value} AS VARCHAR)"


def _minmax(table: str, source: str, landed: str, column: str) -> str:
    return f"""SELECT '{table}' AS table_key, '{column}' AS column_name, {_shown('s.lo', column)} AS source_min,
{_shown('s.hi', column)} AS source_max, {_shown('l.lo', column)} AS landed_min, {_shown('l.hi', column)} AS landed_max,
(s.lo IS NOT DISTINCT FROM l.lo AND s.hi IS NOT DISTINCT FROM l.hi) AS matches
FROM (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}) s,
(SELECT min({column}) AS lo, max({column}) AS hi FROM {landed}) l"""


MINMAX = " UNION ALL ".join(
    _minmax(t, s, l, c) for t, (s, l) in PAIRS.items() for c in COLUMNS[t] if c not in NOT_LANDED
)
MASKED_MINMAX = " UNION ALL ".join(_minmax(t, s, l, c) for t, (s, l, cs) in MASKED_PAIRS.items() for c in cs)
COUNTS = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_key, (SELECT count(*) FROM {s}) AS source_rows, (SELECT count(*) FROM {l}) AS landed_rows,
(SELECT count(*) FROM {s}) = (SELECT count(*) FROM {l}) AS matches"""
    for t, (s, l) in PAIRS.items()
)
COLUMN_ROWS = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_key, '{c}' AS column_name, true AS in_source, {c not in NOT_LANDED} AS in_landed,
(SELECT count({c}) FROM {s}) AS source_values,
{f"(SELECT count({c}) FROM {l})" if c not in NOT_LANDED else "CAST(NULL AS BIGINT)"} AS landed_values,
{c not in NOT_LANDED} AS matches"""
    for t, (s, l) in PAIRS.items()
    for c in COLUMNS[t]
)
MASKED_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_key, (SELECT count(*) FROM {s}) = (SELECT count(*) FROM {l}) AS matches"
    for t, (s, l, _) in MASKED_PAIRS.items()
)
STATUS = f"""{SIDES}, counts AS ({COUNTS}), columns AS ({COLUMN_ROWS}), minmax AS ({MINMAX}),
masked_minmax AS ({MASKED_MINMAX}), masked_counts AS ({MASKED_COUNTS}),
masked AS (SELECT c.table_key, c.matches AND m.matches AS masked_ok FROM masked_counts c JOIN
  (SELECT table_key, bool_and(matches) AS matches FROM masked_minmax GROUP BY table_key) m USING (table_key)),
verdict AS (SELECT c.table_key, c.matches AS counts_ok, k.matches AS columns_ok, x.matches AS minmax_ok, m.masked_ok
  FROM counts c JOIN (SELECT table_key, bool_and(matches) AS matches FROM columns GROUP BY table_key) k USING (table_key)
  JOIN (SELECT table_key, bool_and(matches) AS matches FROM minmax GROUP BY table_key) x USING (table_key)
  LEFT JOIN masked m USING (table_key)),
status AS (SELECT *, CASE WHEN NOT counts_ok OR NOT columns_ok THEN 'Failed'
  WHEN NOT minmax_ok OR NOT coalesce(masked_ok, true) THEN 'Partial Success' ELSE 'Success' END AS status FROM verdict)"""


def _decision(table: str, column: str, rows: int) -> str:
    return f"""SELECT '{table}' AS table_key, '{column}' AS column_name, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_values,
max(n) AS max_rows, CASE WHEN sum(n) / count(*) <= {rows} AND max(n) <= {rows} THEN 'yes' ELSE 'no' END AS decision
FROM (SELECT {column}, count(*) AS n FROM {table} GROUP BY 1)"""


CHECKS: dict[str, str] = {
    "source_url": """SELECT table_key, vendor, CASE WHEN vendor = 'mssql'
THEN rtrim(base_url, '/') || ';databaseName=' || database || ';encrypt=true;trustServerCertificate=true'
ELSE base_url || database END AS url
FROM (SELECT 'cust_' || c_custkey AS table_key, CASE c_nationkey % 5 WHEN 0 THEN 'mysql' WHEN 1 THEN 'maria'
  WHEN 2 THEN 'postgres' WHEN 3 THEN 'ibm' ELSE 'mssql' END AS vendor,
  'jdbc:source://host' || c_nationkey || ':1234/' AS base_url, c_mktsegment AS database FROM customer)""",
    "table_profile": f"WITH {PROFILE} SELECT table_key, table_count, table_size_mb, avg_row_size_mb FROM profile",
    "chunk_sizing": f"WITH {PROFILE} SELECT table_key, table_count, avg_row_size_mb, chunk_rows FROM sizing",
    "table_eligibility": f"""WITH {PROFILE} SELECT table_key, table_count,
CASE WHEN table_count < 1 THEN 'skip' ELSE 'extract' END AS action,
CASE WHEN table_count < 1 THEN 'Success' END AS status FROM profile""",
    "pk_columns": """SELECT table_key, column_name,
CAST(row_number() OVER (PARTITION BY table_key ORDER BY ordinal_position, column_name) AS INTEGER) AS key_position
FROM (SELECT 'order_' || l_orderkey AS table_key, 'col_' || (l_partkey % 10) AS column_name,
  min(l_linenumber) AS ordinal_position FROM lineitem GROUP BY 1, 2)""",
    "index_columns": """WITH listed AS (SELECT p_brand AS table_key, p_size AS position,
  regexp_split_to_array('+' || p_type || '-' || replace(p_name, ' ', '+'), '[+-]') AS names FROM part),
parts AS (SELECT table_key, position, unnest(names) AS column_name, generate_subscripts(names, 1) AS place FROM listed),
firsts AS (SELECT table_key, column_name, min(position * 1000 + place) AS first_at FROM parts
  WHERE column_name <> '' GROUP BY 1, 2)
SELECT table_key, column_name,
CAST(row_number() OVER (PARTITION BY table_key ORDER BY first_at, column_name) AS INTEGER) AS index_position FROM firsts""",
    "partition_profile": """SELECT table_key, count(*) AS n_partitions, count(*) >= 2 AS is_partitioned FROM (
SELECT DISTINCT 'events' AS table_key, CAST(CAST(ts AS DATE) AS VARCHAR) AS p FROM events
UNION ALL SELECT DISTINCT 'orders', strftime(o_orderdate, '%Y-%m') FROM orders
UNION ALL SELECT DISTINCT 'customer', c_mktsegment FROM customer
UNION ALL SELECT DISTINCT 'part', 'p0' FROM part) GROUP BY 1""",
    "index_decision": " UNION ALL ".join(
        [_decision("orders", "o_custkey", 4000), _decision("lineitem", "l_suppkey", 500), _decision("part", "p_type", 600)]
    ),
    "strategy_selection": f"""WITH {PROFILE},
keyed AS (SELECT 'orders' AS table_key, CASE WHEN max(n) = 1 THEN 1 ELSE 0 END AS n_key_columns
    FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey)
  UNION ALL SELECT 'conversations', CASE WHEN max(n) = 1 THEN 2 ELSE 0 END
    FROM (SELECT count(*) AS n FROM conversations GROUP BY conv_id, turn)
  UNION ALL SELECT 'lineitem', CASE WHEN max(n) = 1 THEN 2 ELSE 0 END
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)),
indexed AS (SELECT 'lineitem' AS table_key, sum(n) / count(*) AS average, max(n) AS most
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey)
  UNION ALL SELECT 'customer', sum(n) / count(*), max(n) FROM (SELECT count(*) AS n FROM customer GROUP BY c_nationkey)
  UNION ALL SELECT 'part', sum(n) / count(*), max(n) FROM (SELECT count(*) AS n FROM part GROUP BY p_type)
  UNION ALL SELECT 'documents', sum(n) / count(*), max(n) FROM (SELECT count(*) AS n FROM documents GROUP BY lang)),
parted AS (SELECT 'events' AS table_key, count(DISTINCT CAST(ts AS DATE)) AS n FROM events
  UNION ALL SELECT 'labels', count(DISTINCT quality) FROM labels),
vendors(table_key, vendor) AS (VALUES ('orders', 'postgres'), ('conversations', 'mysql'), ('lineitem', 'mssql'),
  ('customer', 'maria'), ('part', 'maria'), ('events', 'mysql'), ('documents', 'ibm'), ('labels', 'ibm')),
decided AS (SELECT v.table_key, v.vendor, s.chunk_rows, coalesce(k.n_key_columns, 0) AS n_key_columns,
  CASE WHEN i.table_key IS NULL THEN 0 ELSE 1 END AS n_index_columns,
  CASE WHEN i.table_key IS NULL THEN NULL WHEN i.average <= s.chunk_rows AND i.most <= s.chunk_rows THEN 'yes' ELSE 'no' END AS decision,
  coalesce(p.n, 0) AS n_partitions
  FROM vendors v JOIN sizing s USING (table_key) LEFT JOIN keyed k USING (table_key)
  LEFT JOIN indexed i USING (table_key) LEFT JOIN parted p USING (table_key))
SELECT *, CASE WHEN n_key_columns = 1 THEN 'clustered' WHEN n_key_columns > 1 THEN 'composite_clustered'
  WHEN n_index_columns > 0 AND decision = 'yes' THEN 'non_clustered'
  WHEN n_index_columns > 0 THEN 'non_clustered_limit_offset'
  WHEN n_partitions >= 2 AND vendor <> 'ibm' THEN 'partition' ELSE 'limit_offset' END AS strategy FROM decided""",
    "chunk_clustered_manifest": manifest(paged("orders", ["o_orderkey"], 4000), ["o_orderkey"], ["o_orderkey"]),
    "chunk_clustered_rows": paged("orders", ["o_orderkey"], 4000),
    "chunk_composite_manifest": manifest(paged("lineitem", LINEITEM_KEY, 13000), LINEITEM_KEY, LINEITEM_KEY),
    "chunk_composite_rows": paged("lineitem", LINEITEM_KEY, 13000),
    "chunk_composite_conversations": manifest(
        paged("conversations", ["conv_id", "turn"], 100), ["conv_id", "turn"], ["conv_id", "turn"]
    ),
    "chunk_index_manifest": f"WITH {packed('o_custkey')} {_PACKED_MANIFEST}",
    "chunk_index_null_manifest": f"WITH {packed('nullif(o_custkey, 0)')} {_PACKED_MANIFEST}",
    "chunk_index_rows": f"""WITH {packed('nullif(o_custkey, 0)')},
o AS (SELECT * REPLACE (nullif(o_custkey, 0) AS o_custkey) FROM orders)
SELECT o.*, numbered.iteration FROM o JOIN numbered ON o.o_custkey IS NOT DISTINCT FROM numbered.v""",
    "chunk_index_paged": paged("part", PART_ORDER, 600),
    "chunk_index_paged_manifest": manifest(paged("part", PART_ORDER, 600), PART_ORDER, ["p_type", "p_partkey"]),
    "chunk_partition_manifest": manifest(EVENTS_PAGED, ["event_id"], ["event_id"], "min(day) AS day, min(page) AS page, "),
    "chunk_partition_rows": f"SELECT * EXCLUDE (page) FROM ({EVENTS_PAGED})",
    "chunk_limit_offset": paged("orders", ORDERS_ORDER, 4000),
    "chunk_limit_offset_manifest": manifest(
        paged("orders", ORDERS_ORDER, 4000), ORDERS_ORDER, ["o_orderdate", "o_orderkey"]
    ),
    "chunk_limit_offset_copies": paged(
        "(SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem)",
        ["l_returnflag", "l_linestatus", "l_linenumber"],
        7000,
    ),
    "chunk_limit_offset_zeros": """SELECT l_linenumber, CAST(z AS VARCHAR) AS z,
CAST(floor((row_number() OVER (ORDER BY l_linenumber, negative) - 1) / 7000) AS INTEGER) AS iteration
FROM (SELECT l_linenumber, l_quantity % 2 = 0 AS negative,
  CASE WHEN l_quantity % 2 = 0 THEN CAST('-0.0' AS DOUBLE) ELSE CAST('0.0' AS DOUBLE) END AS z FROM lineitem)""",
    "mask_columns": """SELECT table_key, count(*) AS n_masked, string_agg(column_name, ',' ORDER BY column_name) AS columns
FROM (SELECT DISTINCT 'cust_' || o_custkey AS table_key,
  'col_' || o_orderstatus || '_' || substr(o_orderpriority, 1, 1) AS column_name FROM orders)
WHERE table_key IN (SELECT 'cust_' || c_custkey FROM customer) GROUP BY table_key""",
    "masked_projection": """SELECT * REPLACE (sha256('haulage|' || c_name) AS c_name,
sha256('haulage|' || CAST(c_acctbal AS VARCHAR)) AS c_acctbal) FROM customer""",
    "masked_minmax": f"WITH {SIDES} {MASKED_MINMAX}",
    "validate_counts": f"WITH {SIDES} {COUNTS}",
    "validate_columns": f"WITH {SIDES} {COLUMN_ROWS}",
    "validate_minmax": f"WITH {SIDES} {MINMAX}",
    "validation_status": f"WITH {STATUS} SELECT * FROM status",
    "publish_plan": f"""WITH {STATUS} SELECT table_key, 'raw.' || table_key AS published_as FROM status WHERE status <> 'Failed'
UNION ALL SELECT table_key, 'masked.' || table_key || '_masked' FROM status
WHERE status <> 'Failed' AND masked_ok IS NOT NULL""",
    "run_summary": f"""WITH {HISTORY}, chunks_now AS ({latest("history")}),
loads AS (SELECT log_id, bool_or(write_status = 'FAIL') AS raw_failed,
  coalesce(bool_or(mask_write_status = 'FAIL'), false) AS masked_failed, bool_and(read_status = 'FAIL') AS unread
  FROM chunks_now GROUP BY log_id)
SELECT CASE WHEN unread THEN 'Unsuccessful Extraction' WHEN raw_failed THEN 'Failed Validation'
ELSE 'Successful Validation' END AS outcome, 'load_' || log_id AS table_key FROM loads""",
    "load_durations": """SELECT log_id, total_seconds, total_seconds // 3600 AS hours, total_seconds % 3600 // 60 AS minutes,
total_seconds % 60 AS seconds,
(total_seconds // 3600) || 'h:' || (total_seconds % 3600 // 60) || 'm:' || (total_seconds % 60) || 's' AS elapsed
FROM (SELECT user_id AS log_id, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS total_seconds FROM events GROUP BY 1)""",
    "chunk_tracker_latest": f"WITH {HISTORY} {latest('history')}",
    "master_tracker_latest": f"WITH {MASTER} SELECT * FROM master_now",
    "recovery_failed_logs": f"WITH {MASTER} SELECT log_id FROM master_now WHERE load_status = 'Failed'",
    "recovery_failed_chunks": f"""WITH {FAILED}
SELECT log_id, iteration, query, write_status, mask_write_status FROM failed""",
    "recovery_plan": f"""WITH {FAILED} SELECT log_id, iteration, table_name, write_status, mask_write_status, masking_applies,
rerun_raw, rerun_masked FROM failed""",
    "recovery_republish": f"""WITH {FAILED} SELECT log_id, max(table_name) AS table_name, bool_or(rerun_raw) AS republish_raw,
bool_or(rerun_masked) AS republish_masked FROM failed GROUP BY log_id""",
    "recovery_close": f"""WITH {FAILED},
reruns AS (SELECT * EXCLUDE (masking_applies, rerun_raw, rerun_masked) REPLACE (
  end_timestamp + INTERVAL 1 HOUR AS end_timestamp, CASE WHEN chunk_size % 7 = 0 THEN 'FAIL' ELSE 'PASS' END AS write_status,
  CASE WHEN masking_applies THEN CASE WHEN chunk_size % 7 = 0 THEN 'FAIL' ELSE 'PASS' END END AS mask_write_status) FROM failed),
everything AS (SELECT * FROM history UNION ALL SELECT * FROM reruns),
after AS ({latest("everything")})
SELECT log_id, count(*) AS n_chunks,
CAST(sum(CASE WHEN write_status = 'FAIL' OR mask_write_status = 'FAIL' THEN 1 ELSE 0 END) AS BIGINT) AS n_failed,
CASE WHEN bool_or(write_status = 'FAIL' OR coalesce(mask_write_status = 'FAIL', false)) THEN 'Failed' ELSE 'Success' END AS load_status,
max(end_timestamp) AS end_timestamp FROM after GROUP BY log_id""",
    "recovery_pending": f"""WITH {HISTORY},
planned AS (SELECT * REPLACE (TIMESTAMP '1970-01-01 00:00:00' AS end_timestamp, 'PENDING' AS write_status,
  CASE WHEN mask_write_status IS NOT NULL THEN 'PENDING' END AS mask_write_status) FROM history),
tried AS (SELECT * FROM planned UNION ALL SELECT * FROM history WHERE chunk_size % 10 <> 0),
now_there AS ({latest("tried")})
SELECT log_id, iteration, query, mask_write_status IS NOT NULL AS masking_applies, true AS rerun_raw,
mask_write_status IS NOT NULL AS rerun_masked FROM now_there WHERE write_status = 'PENDING'""",
    "recovery_rewrite": paged("orders", ["o_orderkey"], "(SELECT ceil(count(*) / 5) FROM orders)"),
}
