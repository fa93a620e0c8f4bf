"""The registered queries once more, as SQL for DuckDB.

Written against the definitions of the reports, not against the Spark code:
merges compare whole histories, price series are filled day by day over a
calendar, shares come from windows over single queries, and budget months from
a recursion.
"""

from __future__ import annotations

from usageledger.sources.logical import statement

ORACLE: dict[str, str] = {}

ROLES = "('role_3', 'role_18', 'report_service')"
STAMP = "'ACC_0' AS account_locator, 'R1' AS region_name, 'ORG' AS organization_name"
TIMED = (
    "CAST(start_time AS DATE) AS start_date, date_diff('hour', start_time, end_time) AS operation_hours, "
    "strftime(start_time, '%H:%M:%S') AS time_of_day"
)
ELAPSED = "date_diff('second', start_time, end_time) AS elapsed_time_in_sec"


def ctes(*names: str) -> str:
    return ", ".join(f"{n} AS ({statement(n)})" for n in names)


def num(expr: str, alias: str | None = None) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {alias or expr}"


def txt(c: str, missing: str = "~") -> str:
    return f"coalesce(CAST({c} AS VARCHAR), '{missing}')"


def ms(c: str) -> str:
    return f"coalesce(strftime({c}, '%Y-%m-%d %H:%M:%S.%g'), '~')"


def dy(c: str) -> str:
    return f"coalesce(strftime({c}, '%Y-%m-%d'), '~')"


def key(*parts: str) -> str:
    return "sha1(" + " || '|' || ".join(parts) + ")"


def account_key(*parts: str) -> str:
    return key("'R1'", "'ACC_0'", *parts)


def resolved(user: str = "analyst", roles: str = ROLES) -> str:
    """Patterns of a caller as the CTE ``patterns``."""
    return f"""access_map AS ({statement('access_map')}),
    own AS (SELECT database AS dp, warehouse AS wp FROM access_map WHERE lower(account) = '{user}' AND role IS NULL),
    byrole AS (SELECT database AS dp, warehouse AS wp FROM access_map WHERE account IS NULL AND lower(role) IN {roles}),
    patterns AS (SELECT DISTINCT dp, wp FROM (
        SELECT * FROM own UNION ALL SELECT * FROM byrole WHERE (SELECT count(*) FROM own) = 0)
      WHERE dp IS NOT NULL AND wp IS NOT NULL)"""


OWN_ROWS = ("usr_2", "('role_3')")


def allowed(condition: str) -> str:
    return f"EXISTS (SELECT 1 FROM patterns p WHERE {condition})"


def db(c: str = "database_name") -> str:
    return f"regexp_full_match({c}, p.dp)"


def wh(c: str = "warehouse_name") -> str:
    return f"regexp_full_match({c}, p.wp)"


def batches(
    inputs: str,
    shape: str,
    sh_key: str,
    time: str,
    cut: str,
    cutoff: str | None,
    source_time: str | None = None,
    first: str = "TRUE",
    mark: str = "max({t})",
    window: str = "TRUE",
    account: bool = True,
) -> str:
    """CTEs up to ``kept``: the history after two insert-only batches and retention."""
    st = source_time or time
    mark = mark.format(t=time)
    guard = " AND account_locator = 'ACC_0'" if account else ""
    gone = f"({time} <= {cutoff}{guard})" if cutoff else "FALSE"
    return f"""WITH {inputs},
    b1 AS (SELECT {sh_key} AS sh_key, * FROM ({shape.format(where=f"{st} < {cut} AND {first} AND {window}")})),
    wm AS (SELECT {mark} AS m FROM b1),
    b2 AS (SELECT {sh_key} AS sh_key, * FROM ({shape.format(where=f"{st} >= (SELECT m FROM wm) AND {window}")})),
    merged AS (SELECT * FROM b1 UNION ALL BY NAME SELECT * FROM b2 WHERE sh_key NOT IN (SELECT sh_key FROM b1)),
    kept AS (SELECT * FROM merged WHERE NOT coalesce({gone}, FALSE))"""


EVENTS_CUT = "TIMESTAMP '2024-01-20 10:30:00'"
ORDERS_CUT = "TIMESTAMP '2001-06-01 00:00:00'"
EVENTS_FIRST = "TIMESTAMP '2023-02-10 00:00:00'"
ORDERS_FIRST = "DATE '2000-12-31'"
EVENTS_YEAR = "TIMESTAMP '2023-02-10 00:00:00'"
ORDERS_YEAR = "DATE '2000-12-31'"


def prices(*series: str, every_account: bool = False) -> str:
    """Daily price series, filled over a calendar: one CTE per (alias, usage type) pair."""
    own = "" if every_account else " AND account_locator = 'ACC_0' AND region = 'R1'"
    out = [
        f"rate_sheet AS ({statement('rate_sheet')})",
        """sheet AS (SELECT * REPLACE (CASE WHEN usage_type LIKE 'overage-%' THEN substr(usage_type, 9) ELSE usage_type END AS usage_type)
           FROM rate_sheet)""",
    ]
    filled = (
        "organization_name contract_number account_name service_level currency effective_rate service_type".split()
    )
    for pair in series:
        alias, label = pair.split(":")
        columns = ", ".join(f"last_value(s.{c} IGNORE NULLS) OVER w AS {c}" for c in filled)
        out.append(f"""{alias} AS (
          SELECT d.account_locator, d.region, d.usage_type, d.rate_date, {columns}
          FROM (SELECT account_locator, region, usage_type, CAST(unnest(generate_series(min(rate_date), DATE '2024-02-10', INTERVAL 1 DAY)) AS DATE) AS rate_date
                FROM sheet WHERE usage_type = '{label}'{own} GROUP BY account_locator, region, usage_type) d
          LEFT JOIN sheet s ON s.account_locator = d.account_locator AND s.region = d.region AND s.usage_type = d.usage_type AND s.rate_date = d.rate_date
          WINDOW w AS (PARTITION BY d.account_locator, d.region, d.usage_type ORDER BY d.rate_date ROWS UNBOUNDED PRECEDING))""")
    return ", ".join(out)


COMPUTE_CLOUD = prices("compute:compute", "cloud:cloud services")

# ---------------------------------------------------------------- building blocks

ORACLE["business_key"] = f"""WITH {ctes('task_runs')}
SELECT run_id, {key(txt('task_name'), txt('schema_name'), txt('graph_version', '-1'), txt('run_id', '-9'), ms('scheduled_time'))} AS sh_key
FROM task_runs"""

ORACLE["high_watermark_scan"] = f"""WITH {ctes('query_history')}
SELECT query_id, start_time FROM query_history
WHERE start_time >= (SELECT max(start_time) FROM query_history WHERE start_time < {EVENTS_CUT})"""

SHEET_COLUMNS = (
    "organization_name, contract_number, account_name, account_locator, region, service_level, usage_type, rate_date, currency, "
    + num("effective_rate")
    + ", service_type"
)
ORACLE["high_watermark_scan_min_default"] = f"""WITH {ctes('rate_sheet')}
SELECT {SHEET_COLUMNS} FROM rate_sheet WHERE rate_date >= (SELECT min(rate_date) FROM rate_sheet)"""

ORACLE["late_lookback_scan"] = f"""WITH {ctes('task_runs')}
SELECT run_id, scheduled_time, state FROM task_runs
WHERE scheduled_time >= (SELECT max(scheduled_time) FROM task_runs WHERE scheduled_time < {ORDERS_CUT}) - INTERVAL 36 HOUR"""

ORACLE["bounded_window_scan"] = f"""WITH {ctes('file_loads')}
SELECT file_name, last_load_time, row_count FROM file_loads
WHERE last_load_time BETWEEN TIMESTAMP '2001-07-15 12:00:00' - INTERVAL 30 DAY AND TIMESTAMP '2001-07-15 12:00:00'"""

MERGE_INPUT = f"""WITH {ctes('task_runs')},
stored AS (SELECT run_id, 'STORED' AS state, scheduled_time FROM task_runs WHERE scheduled_time < {ORDERS_CUT}),
batch AS (SELECT run_id, state, scheduled_time FROM task_runs WHERE scheduled_time >= {ORDERS_CUT} - INTERVAL 30 DAY)"""
RUN_KEY = key(txt("run_id", "-9"))
ORACLE["merge_insert_only"] = f"""{MERGE_INPUT}
SELECT {RUN_KEY} AS sh_key, * FROM (SELECT * FROM stored UNION ALL SELECT * FROM batch WHERE run_id NOT IN (SELECT run_id FROM stored))"""
ORACLE["merge_upsert"] = f"""{MERGE_INPUT}
SELECT {RUN_KEY} AS sh_key, * FROM (
  SELECT run_id, coalesce(b.state, s.state) AS state, coalesce(s.scheduled_time, b.scheduled_time) AS scheduled_time
  FROM stored s FULL JOIN batch b USING (run_id))"""

ORACLE["retention_delete"] = f"""WITH {ctes('org_usage')}
SELECT account_locator, usage_date, count(*) AS rows_kept FROM org_usage
WHERE NOT (usage_date <= DATE '2001-12-31' - INTERVAL 730 DAY AND account_locator = 'ACC_0') GROUP BY ALL"""

ORACLE["config_lookup"] = f"""WITH {ctes('settings')}
SELECT max(var_value) AS var_value, max(account_locator) AS account_locator FROM settings
WHERE var_name = 'DAYS_TO_RETAIN' AND var_usage = 'MACHINERY' AND account_locator = 'ACC_3'"""
ORACLE["config_lookup_region"] = f"""WITH {ctes('settings')}
SELECT * FROM settings WHERE var_name = 'ORGANIZATION' AND var_usage = 'GLOBAL' AND account_locator = 'ACC_3' AND region_name = 'R1'"""
ORACLE["attach_org_context"] = f"""WITH {ctes('role_grants', 'settings')}
SELECT g.*, s.account_locator, s.region_name, s.var_value AS organization_name FROM role_grants g,
(SELECT * FROM settings WHERE var_name = 'ORGANIZATION' AND var_usage = 'GLOBAL' AND account_locator = 'ACC_0' AND region_name = 'R1') s"""

THREE_CREDITS = ", ".join(num(c) for c in ("credits_used", "credits_used_compute", "credits_used_cloud_services"))
ORACLE["metering_history"] = f"""WITH {ctes('metering')}
SELECT start_time, end_time, entity_id, name, service_type, {THREE_CREDITS}, {TIMED} FROM metering
WHERE regexp_full_match(name, 'WH_[2-9]') AND service_type IN ('WAREHOUSE_METERING', 'WAREHOUSE_METERING_READER')
  AND CAST(start_time AS DATE) >= DATE '2024-01-05' AND CAST(end_time AS DATE) <= DATE '2024-01-25'"""

ORACLE["resolve_access_patterns"] = f"""WITH a AS (WITH {resolved()} SELECT * FROM patterns), b AS (WITH {resolved(*OWN_ROWS)} SELECT * FROM patterns)
SELECT dp AS database_pattern, wp AS warehouse_pattern, 'roles' AS caller FROM a
UNION ALL SELECT dp, wp, 'user' FROM b"""

ORACLE["scope_rows_single"] = f"""WITH {resolved()}, {ctes('query_history')}
SELECT query_id, database_name FROM query_history WHERE {allowed(db())}"""
ORACLE["scope_rows_either"] = f"""WITH {resolved()}, {ctes('query_history')}
SELECT query_id, warehouse_name, database_name FROM query_history WHERE {allowed(f"{wh()} OR {db()}")}"""
ORACLE["scope_rows_both"] = f"""WITH {resolved()}, {ctes('query_history')}
SELECT query_id, warehouse_name, database_name FROM query_history WHERE {allowed(f"{wh()} AND {db()}")}"""
ORACLE["scope_rows_two_columns"] = f"""WITH {resolved()}, {ctes('file_loads')}
SELECT file_name, table_catalog_name, pipe_catalog_name FROM file_loads
WHERE {allowed(f"{db('table_catalog_name')} OR {db('pipe_catalog_name')}")}"""

ORACLE["scope_rows_many"] = """WITH wanted AS (SELECT CAST(o_orderkey AS VARCHAR) AS k FROM orders WHERE o_custkey % 6 = 0)
SELECT o_orderkey, 'DB_' || CAST(o_orderkey AS VARCHAR) AS database_name FROM orders
WHERE CAST(o_orderkey AS VARCHAR) IN (SELECT k FROM wanted)
  OR (right(CAST(o_orderkey AS VARCHAR), 1) IN ('0', '1', '2', '3') AND left(CAST(o_orderkey AS VARCHAR), -1) IN (SELECT k FROM wanted))"""
ORACLE["scope_rows_by_pieces"] = """WITH named AS (
  SELECT o_orderkey, o_custkey, 'DEV_BU' || o_custkey % 5 || '_P' || o_orderkey || '_LOAD_WH' AS warehouse_name FROM orders)
SELECT o_orderkey, warehouse_name FROM named WHERE o_custkey % 6 = 0"""
ORACLE["role_gate"] = f"""WITH {prices()} SELECT {SHEET_COLUMNS} FROM sheet"""
ORACLE["role_membership_scope"] = f"""WITH {ctes('role_grants')}
SELECT * FROM role_grants WHERE grantee_name IN ('ROLE_3', 'role_18', 'REPORT_SERVICE')"""
ORACLE["any_pattern_gate"] = f"""WITH {resolved()}, {ctes('connectors')}
SELECT DISTINCT * FROM connectors WHERE (SELECT count(*) FROM patterns) > 0"""

ORACLE["date_range"] = """SELECT o_orderstatus, o_orderpriority, first_day, last_day,
  CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS day
FROM (SELECT o_orderstatus, o_orderpriority, CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day
  FROM orders GROUP BY ALL)"""

ORACLE["rate_timeseries"] = f"""WITH {prices('compute:compute')}
SELECT usage_type, rate_date, contract_number, service_level, currency, {num('effective_rate')}, service_type FROM compute"""
ORACLE["rate_timeseries_all"] = f"""WITH {prices('cloud:cloud services', every_account=True)}
SELECT account_locator, region, usage_type, rate_date, contract_number, service_level, currency, {num('effective_rate')}, service_type FROM cloud"""
ORACLE["convert_credits_to_currency"] = f"""WITH {prices('compute:compute')}, {ctes('warehouse_metering')}
SELECT warehouse_name, start_time, {num('credits_used')}, {num('CASE WHEN effective_rate IS NULL THEN 0 ELSE credits_used * effective_rate END', 'credits_used_effective_rate')}, currency
FROM warehouse_metering LEFT JOIN compute ON CAST(start_time AS DATE) = rate_date"""


def shares(where: str, unit: str, meters: str = "warehouse_metering") -> str:
    """Queries with their meters and their share of the meter's total, as the CTE ``shares``."""
    return f"""{ctes('query_history', meters)},
    shares AS (SELECT q.*, m.warehouse_name AS meter_name, m.start_time AS meter_start, CAST(m.credits_used AS DOUBLE) AS meter_credits,
        CASE WHEN sum({unit}) OVER w = 0 THEN NULL ELSE q.execution_time / sum({unit}) OVER w END AS share
      FROM query_history q JOIN {meters} m
        ON m.warehouse_id = q.warehouse_id AND q.start_time >= m.start_time AND q.start_time < m.end_time
      WHERE {where} WINDOW w AS (PARTITION BY m.warehouse_name, m.start_time, m.end_time))"""


GUARDED = "CASE WHEN q.execution_time = 0 THEN 1 ELSE q.execution_time END"
RECENT = "q.start_time >= TIMESTAMP '2023-10-10 00:00:00'"
ORACLE["attribute_credits"] = f"""WITH {shares('TRUE', GUARDED)}
SELECT query_id, meter_start, share * 100 AS pct_credit_used_by_query, share * meter_credits AS credit_used_by_query FROM shares"""
ORACLE["attribute_credits_swept"] = f"""WITH {shares('TRUE', GUARDED, 'mixed_metering')}
SELECT query_id, meter_start, share * 100 AS pct_credit_used_by_query, share * meter_credits AS credit_used_by_query FROM shares"""

DAILY = """daily AS (SELECT name AS warehouse_name, strftime(start_time, '%Y-%m-%d') AS active_date, coalesce(sum(credits_used), 0) AS credits_used
  FROM named_metering GROUP BY ALL)"""
DAILY_CREDITS = f"WITH {ctes('named_metering')}, {DAILY} SELECT warehouse_name, active_date, {num('credits_used')} FROM daily"
ORACLE["publish_swap"] = DAILY_CREDITS
RESOURCES = f"""WITH {ctes('databases', 'warehouses', 'roles', 'users', 'monitors')}
SELECT 'DATABASE' AS resource_type, name AS resource_name, created_on FROM databases
UNION ALL SELECT 'WAREHOUSE', name, created_on FROM warehouses UNION ALL SELECT 'ROLE', name, created_on FROM roles
UNION ALL SELECT 'USER', name, created_on FROM users UNION ALL SELECT 'RM', name, created_on FROM monitors"""
ORACLE["publish_truncate_insert"] = RESOURCES

ORACLE["snapshot_diff"] = f"""WITH {ctes('access_map_desired', 'access_map_current')},
d AS (SELECT * FROM access_map_desired), c AS (SELECT * FROM access_map_current)
SELECT 'insert' AS change_type, d.account, d.role, d.warehouse, d.database, NULL AS current_warehouse, NULL AS current_database FROM d
WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.account IS NOT DISTINCT FROM d.account AND c.role IS NOT DISTINCT FROM d.role)
UNION ALL
SELECT 'delete', c.account, c.role, NULL, NULL, c.warehouse, c.database FROM c
WHERE NOT EXISTS (SELECT 1 FROM d WHERE c.account IS NOT DISTINCT FROM d.account AND c.role IS NOT DISTINCT FROM d.role)
UNION ALL
SELECT 'update', d.account, d.role, d.warehouse, d.database, c.warehouse, c.database FROM d JOIN c
ON c.account IS NOT DISTINCT FROM d.account AND c.role IS NOT DISTINCT FROM d.role
WHERE d.warehouse IS DISTINCT FROM c.warehouse OR d.database IS DISTINCT FROM c.database"""
ORACLE["duplicate_key_check"] = f"""WITH {ctes('access_map')}
SELECT account, role, count(*) AS rows FROM access_map GROUP BY account, role HAVING count(*) > 1"""

ORACLE["derive_time_columns"] = f"""WITH {ctes('query_history')} SELECT query_id, start_time, end_time, {TIMED} FROM query_history"""
ORACLE["elapsed_seconds"] = f"""WITH {ctes('query_history')} SELECT query_id, start_time, end_time, {ELAPSED} FROM query_history"""
GIB = "1073741824.0"
ORACLE["bytes_to_gib"] = f"""WITH {ctes('account_storage')}, g AS (SELECT usage_date, CAST(storage_bytes AS DOUBLE) / CAST({GIB} AS DOUBLE) AS g FROM account_storage)
SELECT usage_date, {num('g', 'gib')}, {num('round(g, 3)', 'rounded')}, {num('floor(g)', 'floored')}, {num('floor(g * 1000) / 1000', 'floored_3')} FROM g"""


def label(c: str, spend: bool) -> str:
    base = f"CASE WHEN {c} LIKE 'overage-%' THEN substr({c}, 9) ELSE {c} END"
    return f"replace({base}, 'adj for incl cloud services', 'cloud services')" if spend else base


ORACLE["normalize_usage_type"] = f"""WITH {ctes('org_usage', 'rate_sheet')}
SELECT usage_type, {label('usage_type', False)} AS rate_label, {label('usage_type', True)} AS spend_label, count(*) AS rows
FROM (SELECT usage_type FROM org_usage UNION ALL SELECT usage_type FROM rate_sheet) GROUP BY ALL"""
ORACLE["top_recent"] = f"""WITH {ctes('query_history')}
SELECT query_id, start_time FROM query_history ORDER BY start_time DESC, query_id DESC LIMIT 500"""

# ---------------------------------------------------------------- incremental reports

EVENT_BATCHES = dict(time="start_time", cut=EVENTS_CUT, cutoff=EVENTS_YEAR, first=f"start_time >= {EVENTS_FIRST}")
DAY_MARK = "date_trunc('day', max({t}))"
SERVICE_KEY = account_key(txt("database_name"), txt("schema_name"), txt("table_name"), ms("start_time"))
CREDIT = num("credits_used")

ORACLE["rpt_auto_clustering"] = f"""{batches(
    ctes('table_service'), f"SELECT *, {STAMP}, {TIMED} FROM table_service WHERE {{where}}", SERVICE_KEY, **EVENT_BATCHES)},
{resolved()} SELECT DISTINCT * REPLACE ({CREDIT}), {ELAPSED} FROM kept WHERE {allowed(db())}"""

ORACLE["rpt_mv_refresh"] = f"""{batches(
    ctes('table_service'), f"SELECT * EXCLUDE (num_bytes, table_id), {STAMP}, {TIMED} FROM table_service WHERE {{where}}", SERVICE_KEY,
    mark=DAY_MARK, **EVENT_BATCHES)},
{resolved()} SELECT DISTINCT * REPLACE ({CREDIT}), {ELAPSED} FROM kept WHERE {allowed(db())}"""

ORACLE["rpt_replication"] = f"""{batches(
    ctes('database_service'), f"SELECT *, {STAMP}, {TIMED} FROM database_service WHERE {{where}}",
    account_key(txt('database_name'), ms('start_time')), mark=DAY_MARK, **EVENT_BATCHES)},
{resolved()} SELECT DISTINCT * REPLACE ({CREDIT}), {ELAPSED} FROM kept WHERE {allowed(db())}"""


def priced(alias: str) -> str:
    return (
        f"{num(f'CASE WHEN {alias}.effective_rate IS NULL THEN 0 ELSE kept.credits_used * {alias}.effective_rate END', 'credits_used_effective_rate')}"
        f", {alias}.currency"
    )


ORACLE["rpt_search_opt"] = f"""{batches(
    ctes('table_service'), f"SELECT * EXCLUDE (num_bytes), {STAMP}, {TIMED} FROM table_service WHERE {{where}}", SERVICE_KEY, **EVENT_BATCHES)},
{resolved()}, {prices('search:search optimization')}
SELECT DISTINCT kept.* REPLACE ({CREDIT}), {ELAPSED}, {priced('search')}
FROM kept LEFT JOIN search ON kept.start_date = search.rate_date WHERE {allowed(db())}"""

ORACLE["rpt_serverless_task"] = f"""{batches(
    ctes('task_service'), f"SELECT *, {STAMP}, {TIMED} FROM task_service WHERE {{where}}",
    account_key(txt('database_name'), txt('schema_name'), txt('task_name'), ms('start_time')), **EVENT_BATCHES)},
{resolved()}, {prices('serverless:serverless tasks')}
SELECT DISTINCT kept.* REPLACE ({CREDIT}), {ELAPSED}, {priced('serverless')}
FROM kept LEFT JOIN serverless ON kept.start_date = serverless.rate_date WHERE {allowed(db())}"""

LOAD_WINDOW = "last_load_time BETWEEN TIMESTAMP '2001-07-15 12:00:00' - INTERVAL 30 DAY AND TIMESTAMP '2001-07-15 12:00:00'"
LOADS = dict(
    time="last_load_time", cut="TIMESTAMP '2001-07-01 00:00:00'", window=LOAD_WINDOW, first="last_load_time >= DATE '2000-07-15'"
)
ORACLE["rpt_copy_history"] = f"""{batches(
    ctes('file_loads'), f"SELECT *, {STAMP} FROM file_loads WHERE {{where}}",
    account_key(*[txt(c) for c in 'file_name stage_location table_name table_schema_name table_catalog_name pipe_catalog_name pipe_schema_name pipe_name'.split()], ms('last_load_time')),
    cutoff="TIMESTAMP '2000-07-15 00:00:00'", **LOADS)},
{resolved()} SELECT DISTINCT * FROM kept WHERE {allowed(f"{db('table_catalog_name')} OR {db('pipe_catalog_name')}")}"""

ORACLE["rpt_load_history"] = f"""{batches(
    ctes('bulk_loads'), f"SELECT *, {STAMP} FROM bulk_loads WHERE {{where}}",
    account_key(txt('table_name'), txt('schema_name'), txt('catalog_name'), txt('file_name'), ms('last_load_time')), cutoff=None, **LOADS)},
{resolved()} SELECT DISTINCT * FROM kept WHERE {allowed(db('catalog_name'))}"""

STORAGE = dict(
    time="usage_month", source_time="usage_date", cut=ORDERS_CUT, cutoff=ORDERS_YEAR, first=f"usage_date >= {ORDERS_FIRST}"
)


def gib(c: str) -> str:
    return f"CAST({c} AS DOUBLE) / CAST({GIB} AS DOUBLE)"


LIVE, FAILSAFE = f"round({gib('average_database_bytes')}, 3)", f"round({gib('average_failsafe_bytes')}, 3)"
ORACLE["rpt_db_storage"] = f"""{batches(
    ctes('database_storage'),
    f"SELECT {STAMP}, usage_date AS usage_month, database_name, database_id, {num(LIVE, 'avg_database_storage_gb')}, "
    f"{num(FAILSAFE, 'avg_failsafe_storage_gb')}, {num(f'{LIVE} + {FAILSAFE}', 'total_storage_gb')} FROM database_storage WHERE {{where}}",
    account_key(txt('database_name'), dy('usage_month')), **STORAGE)},
{resolved()} SELECT DISTINCT * FROM kept WHERE {allowed(db())}"""
ORACLE["rpt_storage"] = f"""{batches(
    ctes('account_storage'),
    f"SELECT {STAMP}, usage_date AS usage_month, {num(f'floor({gib('storage_bytes + stage_bytes + failsafe_bytes')} * 1000) / 1000', 'total_billable_storage_gb')}, "
    f"floor({gib('storage_bytes')}) AS storage_billable_storage_gb, floor({gib('stage_bytes')}) AS stage_billable_storage_gb, "
    f"floor({gib('failsafe_bytes')}) AS failsafe_billable_storage_gb FROM account_storage WHERE {{where}}",
    account_key(dy('usage_month')), **STORAGE)}
SELECT * FROM kept"""

ORACLE["rpt_pipe_credit"] = f"""{batches(
    ctes('metering', 'pipes'),
    f"SELECT start_time, end_time, entity_id AS pipe_id, name AS pipe_name, service_type, {CREDIT}, {TIMED}, pipe_schema, "
    f"pipe_catalog AS pipe_database, pipe_owner, {STAMP} FROM metering JOIN pipes ON pipe_id = entity_id "
    "WHERE service_type = 'PIPE' AND CAST(start_time AS DATE) >= DATE '2023-02-10' AND CAST(end_time AS DATE) <= DATE '2024-02-10' AND {where}",
    account_key(txt('pipe_name'), ms('start_time')), mark=DAY_MARK, **EVENT_BATCHES)},
{resolved()} SELECT DISTINCT *, {ELAPSED} FROM kept WHERE {allowed(db('pipe_database'))}"""

QUERY_COLUMNS = f"{ELAPSED}, CAST(start_time AS DATE) AS start_date, CAST(floor(execution_time / 1000) AS BIGINT) AS execution_time_in_sec"
ORACLE["rpt_query_history"] = f"""{batches(
    ctes('query_history'), f"SELECT *, {STAMP} FROM query_history WHERE {{where}}", account_key(txt('query_id')),
    **{**EVENT_BATCHES, 'cutoff': "TIMESTAMP '2024-01-11 00:00:00'"})},
{resolved()} SELECT DISTINCT *, {QUERY_COLUMNS} FROM kept WHERE {allowed(f"{wh()} OR {db()}")} ORDER BY start_time DESC, query_id DESC LIMIT 1000000"""
ORACLE["stored_query_history"] = f"""WITH {ctes('query_history')}
SELECT {account_key(txt('query_id'))} AS sh_key, query_id, warehouse_name, start_time, execution_time FROM query_history"""
ORACLE["newest_stored_queries"] = f"""WITH {resolved()}, {ctes('query_history')}
SELECT query_id, warehouse_name, database_name, start_time FROM query_history WHERE {allowed(f"{wh()} OR {db()}")}
ORDER BY start_time DESC, query_id DESC LIMIT 700"""
ORACLE["rpt_reader_query_history"] = f"""{batches(
    ctes('reader_query_history'), f"SELECT *, {STAMP} FROM reader_query_history WHERE {{where}}",
    account_key(txt('query_id'), txt('reader_account_name')), **EVENT_BATCHES)},
{resolved()} SELECT DISTINCT *, {QUERY_COLUMNS} FROM kept WHERE {allowed(f"{wh()} OR {db()}")}"""
ORACLE["rpt_reader_wh_credit"] = f"""{batches(
    ctes('reader_metering'), f"SELECT * REPLACE ({CREDIT}), {STAMP}, {TIMED} FROM reader_metering WHERE {{where}}",
    account_key(txt('warehouse_name'), txt('reader_account_name'), ms('start_time')), **EVENT_BATCHES)},
{resolved()} SELECT DISTINCT *, {ELAPSED} FROM kept WHERE {allowed(wh())}"""

ORACLE["rpt_sessions"] = f"""{batches(
    ctes('sessions', 'logins'),
    f"SELECT session_id, created_on, user_name, client_application_id, event_type, is_success, {STAMP}, CAST(created_on AS DATE) AS created_date "
    "FROM sessions JOIN logins ON login_event_id = event_id WHERE {where}",
    account_key(txt('session_id', '-9'), txt('user_name'), txt('client_application_id'), ms('created_on')),
    **{**EVENT_BATCHES, 'time': 'created_on', 'first': f'created_on >= {EVENTS_FIRST}'})}
SELECT * FROM kept"""

RUNS_KEY = account_key(
    txt("query_id"), txt("task_name"), txt("database_name"), txt("schema_name"), txt("root_task_id"), txt("run_id", "-9"), txt("graph_version", "-1"), ms("scheduled_time")
)
STILL = f"scheduled_time >= {ORDERS_CUT} - INTERVAL 36 HOUR"


def shown_time(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%g') AS {c}_text"


ORACLE["rpt_task_history"] = f"""WITH {ctes('task_runs')},
early AS (SELECT * REPLACE (CASE WHEN {STILL} THEN 'EXECUTING' ELSE state END AS state, CASE WHEN {STILL} THEN NULL ELSE completed_time END AS completed_time)
  FROM task_runs WHERE scheduled_time < {ORDERS_CUT} AND scheduled_time >= {ORDERS_FIRST}),
late AS (SELECT * FROM task_runs WHERE scheduled_time >= (SELECT max(scheduled_time) FROM early) - INTERVAL 36 HOUR),
merged AS (SELECT * FROM early WHERE run_id NOT IN (SELECT run_id FROM late)
  UNION ALL SELECT l.* REPLACE (coalesce(e.query_start_time, l.query_start_time) AS query_start_time) FROM late l LEFT JOIN early e USING (run_id)),
kept AS (SELECT {RUNS_KEY} AS sh_key, *, {STAMP}, {shown_time('scheduled_time')}, {shown_time('query_start_time')}, {shown_time('completed_time')}
  FROM merged WHERE NOT scheduled_time <= {ORDERS_YEAR}),
{resolved()} SELECT DISTINCT *, date_diff('second', query_start_time, completed_time) AS elapsed_time_in_sec FROM kept WHERE {allowed(db())}"""


def three_priced(facts: str, rate: str = "compute.effective_rate", cloud: str = "cloud.effective_rate") -> str:
    both = f"{rate} IS NULL OR {cloud} IS NULL"
    return ", ".join(
        num(f"CASE WHEN {both} THEN 0 ELSE {facts}.{c} * {r} END", f"{c}_effective_rate")
        for c, r in (("credits_used", rate), ("credits_used_cloud_services", cloud), ("credits_used_compute", rate))
    )


THREE_REPLACED = f"* REPLACE ({THREE_CREDITS})"
ORACLE["rpt_warehouse_credit"] = f"""{batches(
    ctes('metering'),
    f"SELECT start_time, end_time, entity_id AS warehouse_id, name AS warehouse_name, service_type, credits_used, credits_used_compute, "
    f"credits_used_cloud_services, {TIMED}, {STAMP} FROM metering WHERE service_type LIKE 'WAREHOUSE_METERING%' "
    "AND CAST(start_time AS DATE) >= DATE '2023-02-10' AND CAST(end_time AS DATE) <= DATE '2024-02-10' AND {where}",
    account_key(txt('warehouse_id', '-9'), txt('service_type'), ms('start_time')), mark=DAY_MARK, **EVENT_BATCHES)},
{resolved()}, {COMPUTE_CLOUD}
SELECT DISTINCT kept.{THREE_REPLACED}, {ELAPSED}, {three_priced('kept')}, CASE WHEN cloud.rate_date IS NULL THEN NULL ELSE compute.currency END AS currency
FROM kept LEFT JOIN compute ON kept.start_date = compute.rate_date LEFT JOIN cloud ON kept.start_date = cloud.rate_date WHERE {allowed(wh())}"""

SPEND_GROUP = "organization_name, contract_number, account_name, account_locator, region, service_level, usage_date"
ORACLE["rpt_org_currency"] = f"""{batches(
    ctes('org_usage'),
    f"SELECT {SPEND_GROUP}, {label('usage_type', True)} AS usage_type, currency, {num('sum(usage)', 'usage')}, {num('sum(usage_in_currency)', 'usage_in_currency')} "
    f"FROM org_usage o WHERE {{where}} GROUP BY {SPEND_GROUP}, {label('o.usage_type', True)}, currency",
    key(txt('organization_name'), txt('contract_number', '-9'), *[txt(c) for c in 'account_name account_locator region service_level usage_type currency'.split()], dy('usage_date')),
    time='usage_date', cut=ORDERS_CUT, cutoff="DATE '2001-12-31' - INTERVAL 730 DAY")}
SELECT DISTINCT * FROM kept"""
ORACLE["rpt_org_rate_sheet"] = f"""{batches(
    prices(), f"SELECT {SHEET_COLUMNS} FROM sheet WHERE {{where}}",
    key(txt('organization_name'), txt('contract_number', '-9'), *[txt(c) for c in 'account_name account_locator region service_level usage_type'.split()], dy('rate_date')),
    time='rate_date', cut="DATE '2023-10-05'", cutoff="DATE '2024-02-10' - INTERVAL 730 DAY")}
SELECT DISTINCT * FROM kept"""
ON_ACCOUNT = "{0}.rate_date = CAST(kept.start_time AS DATE) AND {0}.account_locator = kept.account_locator AND {0}.region = kept.region"
ORACLE["rpt_org_metering"] = f"""{batches(
    ctes('org_metering'), "SELECT * FROM org_metering WHERE {where}",
    key(txt('organization_name'), txt('account_name'), txt('account_locator'), txt('region'), txt('warehouse_id', '-9'), ms('start_time')),
    time='start_time', cut=EVENTS_CUT, cutoff=EVENTS_YEAR)},
{prices('compute:compute', 'cloud:cloud services', every_account=True)}
SELECT DISTINCT kept.{THREE_REPLACED}, CAST(start_time AS DATE) AS start_date, {three_priced('kept')}, CASE WHEN cloud.rate_date IS NULL THEN NULL ELSE compute.currency END AS currency
FROM kept LEFT JOIN compute ON {ON_ACCOUNT.format('compute')} LEFT JOIN cloud ON {ON_ACCOUNT.format('cloud')}"""

# ---------------------------------------------------------------- full reports and models

ORACLE["rpt_query_credit"] = f"""WITH {shares(f'q.warehouse_size IS NOT NULL AND {RECENT}', 'q.execution_time')}, {resolved()}
SELECT DISTINCT {STAMP}, warehouse_name, database_name, query_id, CAST(start_time AS DATE) AS start_date,
  share * 100 AS pct_credit_used_by_query, share * meter_credits AS credit_used_by_query
FROM shares WHERE {allowed(f"{wh()} OR {db()}")}"""

ORACLE["rpt_db_schema_credit"] = f"""WITH {shares(f'q.database_name IS NOT NULL AND q.schema_name IS NOT NULL AND {RECENT}', GUARDED)}, {resolved()}
SELECT meter_name AS warehouse_name, database_name, schema_name, CAST(start_time AS DATE) AS usage_date, {num('sum(share * meter_credits)', 'credit_used')}
FROM shares WHERE {allowed(f"{wh('meter_name')} AND {db()}")} GROUP BY ALL"""

MONITORED = f"""watched AS (SELECT DISTINCT rm.name AS resource_monitor_name, w.name AS warehouse_name FROM monitors rm JOIN warehouses w
  ON rm.name = w.resource_monitor WHERE rm.level = 'WAREHOUSE' AND {allowed(wh('w.name'))})"""
MONTHS = {f"{y}{m:02d}": f"{y}-{m:02d}-01" for y, m in [(2024, 2), (2024, 1), *((2023, k) for k in range(12, 2, -1))]}


def month_column(month: str, first: str, kind: str) -> str:
    test = f"date_trunc('month', meter_start) = DATE '{first}'"
    if kind == "credits":
        return f'{num(f"sum(CASE WHEN {test} THEN share * meter_credits ELSE 0 END)", f"{chr(34)}{month}_credits{chr(34)}")}'
    return f'CAST(sum(CASE WHEN {test} THEN 1 ELSE 0 END) AS BIGINT) AS "{month}_query"'


MONTH_COLUMNS = ", ".join(
    month_column(m, f, kind) for kind in ("credits", "query") for m, f in MONTHS.items()
)
PIVOT = f"""WITH {shares("m.start_time >= DATE '2023-03-01'", GUARDED)}, {ctes('monitors', 'warehouses')}, {resolved()}, {MONITORED},
pivoted AS (SELECT meter_name AS name, user_name, resource_monitor_name, {MONTH_COLUMNS}
  FROM shares LEFT JOIN watched ON watched.warehouse_name = meter_name WHERE {allowed(wh('meter_name'))} GROUP BY 1, 2, 3)"""
ORACLE["rpt_month_credits_pivot"] = f"{PIVOT} SELECT * FROM pivoted"
ORACLE["rpt_month_credits_unpivot"] = f"{PIVOT} " + " UNION ALL ".join(
    f"SELECT name, user_name, resource_monitor_name, '{m}_credits' AS attribute, \"{m}_credits\" AS value FROM pivoted" for m in MONTHS
)

ORACLE["rpt_grants_to_roles"] = f"""WITH {ctes('role_grants')}
SELECT *, {STAMP} FROM role_grants WHERE grantee_name IN ('ROLE_3', 'role_18', 'REPORT_SERVICE')"""
ORACLE["rpt_grants_to_users"] = statement("user_grants")
SIZES = ("active_bytes", "time_travel_bytes", "failsafe_bytes", "retained_for_clone_bytes")
ORACLE["rpt_table_storage"] = f"""WITH {ctes('table_storage')}, {resolved()}
SELECT DISTINCT * EXCLUDE ({', '.join(SIZES)}), {STAMP}, {', '.join(num(gib(c), f'{c}_gb') for c in SIZES)},
  {num(' + '.join(gib(c) for c in SIZES), 'total_storage_gb')} FROM table_storage WHERE {allowed(db())}"""
ORACLE["rpt_object_dependencies"] = f"WITH {ctes('object_dependencies')} SELECT *, {STAMP} FROM object_dependencies"
ORACLE["rpt_active_resources"] = RESOURCES
ORACLE["rpt_resource_monitor"] = f"""WITH {ctes('monitors', 'warehouses')}, {resolved()}
SELECT DISTINCT rm.name AS resource_monitor_name, w.name AS warehouse_name, credit_quota, used_credits, remaining_credits, frequency,
  rm.start_time AS rm_start_time, rm.end_time AS rm_end_time, notify_at AS rm_notify_at, suspend_at AS rm_suspend_at,
  suspend_immediately_at AS rm_suspend_immediately_at, rm.created_on AS rm_created_on, rm.owner AS rm_owner, rm.comment AS rm_comment,
  w.type AS warehouse_type, w.size AS warehouse_size, min_cluster_count AS warehouse_min_cluster_count,
  max_cluster_count AS warehouse_max_cluster_count, w.created_on AS warehouse_created_on, w.updated_on AS warehouse_updated_on,
  w.comment AS warehouse_comment, scaling_policy AS warehouse_scaling_policy
FROM monitors rm JOIN warehouses w ON rm.name = w.resource_monitor WHERE rm.level = 'WAREHOUSE' AND {allowed(wh('w.name'))}"""
ORACLE["rpt_monthly_credit_summary"] = f"""WITH {ctes('metering')}
SELECT CAST(date_trunc('month', start_time) AS DATE) AS usage_month, {', '.join(num(f'sum({c})', c) for c in ('credits_used', 'credits_used_compute', 'credits_used_cloud_services'))}
FROM metering GROUP BY 1"""

ORACLE["dim_date"] = """SELECT d AS date, year(d) AS year, quarter(d) AS quarter, month(d) AS month_num, left(monthname(d), 3) AS month_name,
  weekofyear(d) AS week_num, day(d) AS day_num, left(dayname(d), 3) AS day_name, dayofweek(d) AS day_of_week, dayofyear(d) AS day_of_year,
  coalesce(n, 0) AS orders
FROM (SELECT CAST(unnest(generate_series(DATE '2001-12-31' - INTERVAL 729 DAY, DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS od, count(*) AS n FROM orders GROUP BY 1) ON od = d"""


def parsed(suffix: str, type_column: str, utility: bool) -> str:
    kind = f"""CASE WHEN split_part(name, '_', 1) = 'ES' THEN 'ES' WHEN name LIKE '%\\_POC\\_{suffix}' ESCAPE '\\' THEN 'POC'
      WHEN name LIKE '%\\_LAB\\_{suffix}' ESCAPE '\\' THEN 'LAB' {"WHEN len(parts) = 2 THEN 'UTIL'" if utility else ""}
      WHEN regexp_matches(name, '^(DEV|TEST|STAGE|PROD)_') THEN 'DP' ELSE 'UNKNOWN' END"""
    system = "WHEN name = 'SYSTEM' THEN 'META' ELSE NULL END"
    proof = "replace(left(name, len(name) - 7), '_', ' ')"
    product = "CASE WHEN len(parts) >= 5 THEN parts[3] ELSE parts[2] END" if utility else "CASE WHEN len(parts) > 3 THEN parts[3] ELSE parts[2] END"
    purpose = (
        f""", CASE k WHEN 'ES' THEN parts[3] WHEN 'POC' THEN {proof} WHEN 'LAB' THEN parts[2] WHEN 'DP' THEN parts[len(parts) - 1]
          WHEN 'UTIL' THEN parts[len(parts) - 1] ELSE CASE {system} END AS purpose"""
        if utility
        else ""
    )
    return f"""SELECT name, owner, comment, k AS {type_column},
      CASE k WHEN 'ES' THEN 'ES' WHEN 'POC' THEN 'POC' WHEN 'LAB' THEN 'LAB' WHEN 'DP' THEN parts[1] ELSE CASE {system} END AS env,
      CASE k WHEN 'ES' THEN parts[2] WHEN 'POC' THEN NULL WHEN 'LAB' THEN parts[1] WHEN 'DP' THEN parts[2] ELSE CASE {system} END AS bu,
      CASE k WHEN 'ES' THEN parts[3] WHEN 'POC' THEN {proof} WHEN 'LAB' THEN parts[2] WHEN 'DP' THEN {product} ELSE CASE {system} END AS db_name
      {purpose}
    FROM (SELECT *, {kind} AS k FROM (SELECT *, string_split(name, '_') AS parts FROM listing))"""


ORACLE["parse_database_names"] = f"WITH listing AS ({statement('database_listing')}) {parsed('DB', 'db_type', False)}"
ORACLE["parse_warehouse_names"] = f"WITH listing AS ({statement('warehouse_listing')}) {parsed('WH', 'wh_type', True)}"
ORACLE["warehouse_daily_credits"] = DAILY_CREDITS
ORACLE["warehouse_daily_credits_merge"] = DAILY_CREDITS


def overridden(fields: str) -> str:
    return ", ".join(f"CASE WHEN o.{f} IS NOT NULL THEN o.{f} ELSE c.{f} END AS {f}" for f in fields.split())


ORACLE["override_coalesce_database"] = f"""WITH listing AS ({statement('database_listing')}), c AS ({parsed('DB', 'db_type', False)}),
o AS ({statement('database_overrides')}), {resolved(*OWN_ROWS)}
SELECT DISTINCT c.name AS database_name, {overridden('owner comment db_type env bu db_name')} FROM c LEFT JOIN o ON c.name = o.name WHERE {allowed(db('c.name'))}"""
ORACLE["override_coalesce_warehouse"] = f"""WITH listing AS ({statement('warehouse_listing')}), c AS ({parsed('WH', 'wh_type', True)}),
o AS ({statement('warehouse_overrides')}), {resolved(*OWN_ROWS)}
SELECT DISTINCT c.name AS warehouse_name, {overridden('owner comment wh_type env bu db_name purpose')} FROM c LEFT JOIN o ON c.name = o.name WHERE {allowed(wh('c.name'))}"""
ORACLE["raw_tags"] = f"""WITH {ctes('raw_warehouse_tags', 'raw_database_tags')}
SELECT name, tag, 'WAREHOUSE' AS kind FROM raw_warehouse_tags UNION ALL SELECT name, tag, 'DATABASE' FROM raw_database_tags"""

BUDGET = f"""WITH RECURSIVE {ctes('purchases', 'tracker')},
dates AS (
  SELECT pur_id, ws_id, purchased_date AS active_date, renewal_date FROM purchases
  UNION ALL
  SELECT pur_id, ws_id, CAST(active_date + INTERVAL 1 MONTH AS DATE), renewal_date FROM dates WHERE active_date < renewal_date - INTERVAL 1 MONTH),
budget AS (SELECT d.ws_id, active_date, d.pur_id,
    CAST(floor(purchased_credits / nullif(date_diff('month', purchased_date, CAST(p.renewal_date + INTERVAL 1 DAY AS DATE)), 0)) AS BIGINT) AS monthly_credit_budget
  FROM dates d JOIN purchases p ON p.pur_id = d.pur_id AND p.ws_id = d.ws_id JOIN tracker t ON t.ws_id = d.ws_id)"""
ORACLE["workspace_monthly_budget"] = f"{BUDGET} SELECT * FROM budget"
ORACLE["bu_warehouse_spend"] = f"""{BUDGET}, {ctes('named_metering')}, {DAILY},
listing AS (SELECT DISTINCT name, 'OWN' AS owner, CAST(NULL AS VARCHAR) AS comment FROM named_metering), w AS ({parsed('WH', 'wh_type', True)}),
spent AS (SELECT warehouse_name, sum(credits_used) AS total_credits_used, CAST(date_trunc('month', CAST(active_date AS DATE)) AS DATE) AS active_month FROM daily GROUP BY 1, 3)
SELECT s.warehouse_name, w.bu, env, purpose, db_name, {num('total_credits_used')}, {num('purchased_rate')}, workspace, b.ws_id, b.pur_id, b.active_date AS budget_month, monthly_credit_budget
FROM w JOIN spent s ON s.warehouse_name = w.name
LEFT JOIN (SELECT budget.*, purchased_rate, workspace, bu FROM budget JOIN purchases USING (ws_id, pur_id) JOIN tracker USING (ws_id)) b
  ON b.bu = w.bu AND b.active_date = s.active_month"""
ORACLE["bu_warehouse_spend_overridden"] = f"""{BUDGET}, {ctes('named_metering')}, {DAILY},
listing AS (SELECT DISTINCT name, 'OWN' AS owner, CAST(NULL AS VARCHAR) AS comment FROM named_metering), parsed_names AS ({parsed('WH', 'wh_type', True)}),
w AS (SELECT * REPLACE (CASE WHEN contains(name, '_P3_') THEN 'BU1' ELSE bu END AS bu) FROM parsed_names),
spent AS (SELECT warehouse_name, sum(credits_used) AS total_credits_used, CAST(date_trunc('month', CAST(active_date AS DATE)) AS DATE) AS active_month FROM daily GROUP BY 1, 3)
SELECT s.warehouse_name, w.bu, env, purpose, db_name, {num('total_credits_used')}, {num('purchased_rate')}, workspace, b.ws_id, b.pur_id, b.active_date AS budget_month, monthly_credit_budget
FROM w JOIN spent s ON s.warehouse_name = w.name
LEFT JOIN (SELECT budget.*, purchased_rate, workspace, bu FROM budget JOIN purchases USING (ws_id, pur_id) JOIN tracker USING (ws_id)) b
  ON b.bu = w.bu AND b.active_date = s.active_month"""
ORACLE["workspace_details"] = f"""WITH {ctes('purchases', 'tracker')}
SELECT ws_id, workspace, workspace_desc, workspace_type, bu, purchased_credits, {num('purchased_rate')}, {num('purchased_amount')}, purchased_date, renewal_date
FROM tracker JOIN purchases USING (ws_id)"""
ORACLE["workspace_types_seed"] = f"""WITH {ctes('workspace_types')}
SELECT workspace_type, workspace_type_desc FROM workspace_types WHERE workspace_type NOT IN ('LRN', 'POC', 'ES', 'DP')
UNION ALL VALUES ('LRN', 'Learner Workspace'), ('POC', 'Proff Of Concept Workspace'), ('ES', 'Explore Workspace'), ('DP', 'Data Product Workspace')"""

TAGS = "BUSINESS_UNIT COST_CENTRE BUSINESS_DIVISION PRODUCT_TYPE PRODUCT_NAME PURPOSE ENVIRONMENT".split()
TAG_FIELDS = " ".join(t.lower() for t in TAGS)
TAGGED = f"""{ctes('tag_references', 'object_listing')},
tagged AS (SELECT object_name, domain AS object_type, {', '.join(f"max(tag_value) FILTER (WHERE tag_name = '{t}') AS {t.lower()}" for t in TAGS)}, TRUE AS is_resolved
  FROM tag_references WHERE object_deleted IS NULL AND domain IN ('DATABASE', 'WAREHOUSE') GROUP BY object_name, domain),
untagged AS (SELECT object_name, object_type, {', '.join(f'CAST(NULL AS VARCHAR) AS {t.lower()}' for t in TAGS)}, FALSE AS is_resolved FROM (
  SELECT object_name, object_type FROM object_listing WHERE object_type = 'WAREHOUSE' OR origin = '' EXCEPT SELECT object_name, object_type FROM tagged))"""
ORACLE["tag_pivot"] = f"WITH {TAGGED} SELECT * FROM tagged"
ORACLE["tag_pivot_existing"] = f"""WITH {ctes('tag_references')}
SELECT object_name, domain AS object_type, {', '.join(f"max(tag_value) FILTER (WHERE tag_name = '{t}') AS {t.lower()}" for t in TAGS)}, TRUE AS is_resolved
FROM tag_references WHERE object_deleted IS NULL AND domain IN ('DATABASE', 'WAREHOUSE') AND tag_name <> 'ENVIRONMENT' GROUP BY object_name, domain"""
ORACLE["tag_unresolved"] = f"WITH {TAGGED} SELECT * FROM untagged"
for _kind, _test in (("DATABASE", db("c.object_name")), ("WAREHOUSE", wh("c.object_name"))):
    ORACLE[f"tag_override_{_kind.lower()}"] = f"""WITH {TAGGED}, {resolved(*OWN_ROWS)}, o AS ({statement('tag_overrides')}),
    c AS (SELECT * FROM tagged UNION ALL SELECT * FROM untagged)
    SELECT DISTINCT c.object_name AS {_kind.lower()}_name, {overridden(TAG_FIELDS)} FROM c LEFT JOIN o ON c.object_name = o.object_name
    WHERE c.object_type = '{_kind}' AND {allowed(_test)}"""

DERIVED = f"""{ctes('role_grants', 'role_tags')},
derived AS (SELECT CAST(NULL AS VARCHAR) AS account, grantee_name AS role,
    '(' || string_agg(name, ')|(' ORDER BY name) FILTER (WHERE granted_on = 'WAREHOUSE') || ')' AS warehouse,
    '(' || string_agg(name, ')|(' ORDER BY name) FILTER (WHERE granted_on = 'DATABASE') || ')' AS database
  FROM (SELECT DISTINCT grantee_name, granted_on, name FROM role_grants WHERE granted_on IN ('DATABASE', 'WAREHOUSE'))
  WHERE grantee_name IN (SELECT upper(id) FROM role_tags WHERE type = 'ROLE' AND json_extract_string(tags, '$.workspace_name') IS NOT NULL
    AND upper(id) NOT IN ('SECURITYADMIN', 'ACCOUNTADMIN', 'SYSADMIN', 'USERADMIN', 'ORGADMIN'))
  GROUP BY grantee_name)"""
ORACLE["grants_to_patterns"] = f"WITH {DERIVED} SELECT * FROM derived"
ORACLE["access_map_refresh"] = f"""WITH {DERIVED}, {ctes('access_map_current')}
SELECT * FROM access_map_current UNION ALL SELECT * FROM derived d WHERE NOT EXISTS (SELECT 1 FROM access_map_current c
  WHERE c.account IS NOT DISTINCT FROM d.account AND c.role IS NOT DISTINCT FROM d.role
    AND c.warehouse IS NOT DISTINCT FROM d.warehouse AND c.database IS NOT DISTINCT FROM d.database)"""
ORACLE["access_map_reconcile"] = statement("access_map_desired")

ORACLE["access_map_from_file"] = f"""WITH {DERIVED}, {ctes('access_map_desired')}
SELECT * FROM access_map_desired UNION ALL SELECT * FROM derived d WHERE NOT EXISTS (SELECT 1 FROM access_map_desired c
  WHERE c.account IS NOT DISTINCT FROM d.account AND c.role IS NOT DISTINCT FROM d.role
    AND c.warehouse IS NOT DISTINCT FROM d.warehouse AND c.database IS NOT DISTINCT FROM d.database)"""

ORACLE["connector_type_current"] = statement("connectors")
ORACLE["connector_type_history"] = f"""WITH {ctes('connectors')}, images AS (
  SELECT * FROM connectors UNION ALL SELECT * REPLACE ('changed' AS availability) FROM connectors WHERE broken)
SELECT DISTINCT * FROM images WHERE synced > TIMESTAMP '2023-02-10 00:00:00'"""
FEED = f"""{ctes('connectors')},
v1 AS (SELECT * FROM connectors),
v2 AS (SELECT * REPLACE (CASE WHEN CAST(id AS INT) % 5 = 0 THEN 'changed' ELSE availability END AS availability) FROM connectors WHERE CAST(id AS INT) % 7 <> 0),
added AS (SELECT * REPLACE ('new_' || id AS id, TIMESTAMP '2024-02-10 08:00:00' AS synced) FROM connectors WHERE CAST(id AS INT) % 7 = 0),
feed AS (
  SELECT 1 AS version, 'insert' AS change_type, * FROM v1
  UNION ALL SELECT 2, 'delete', * FROM v1 WHERE id NOT IN (SELECT id FROM v2)
  UNION ALL SELECT 2, 'update_before', v1.* FROM v1 JOIN v2 USING (id) WHERE v1.availability <> v2.availability
  UNION ALL SELECT 2, 'update_after', v2.* FROM v1 JOIN v2 USING (id) WHERE v1.availability <> v2.availability
  UNION ALL SELECT 3, 'insert', * FROM added)"""
ORACLE["change_feed"] = f"WITH {FEED} SELECT version, change_type, id, availability FROM feed"
ORACLE["connector_type_history_of_versions"] = f"""WITH {FEED}
SELECT id, count(*) AS images, count(DISTINCT availability) AS availabilities FROM feed WHERE synced > TIMESTAMP '2023-02-10 00:00:00' GROUP BY id"""
LOGS = {
    "account": ("id", "name"),
    "account_membership": ("user_id", "account_role"),
    "audit": ("id", "action"),
    "connector": ("connector_id", "connector_name"),
    "destination": ("id", "name"),
    "destination_membership": ("user_id", "CAST(activated AS VARCHAR)"),
    "incremental_mar": ("connector_id", "CAST(measured_month AS VARCHAR) || ' ' || incremental_rows"),
    "log": ("id", "message_data"),
    "resource_membership": ("id", "resource"),
    "role": ("id", "name"),
    "role_permission": ("permission_id", "permission"),
    "user": ("id", "login"),
}
ORACLE["connector_log_views"] = f"WITH {ctes(*[f'log_{n}' for n in LOGS])} " + " UNION ALL ".join(
    f"SELECT '{n}' AS log, CAST({k} AS VARCHAR) AS key, {detail} AS detail FROM log_{n}" for n, (k, detail) in LOGS.items()
)

# ---------------------------------------------------------------- by their SQL names

ORACLE["sql_metering_history"] = ORACLE["metering_history"]
ORACLE["sql_settings"] = f"""WITH {ctes('settings')}
SELECT a.account_locator,
  (SELECT max(var_value) FROM settings s WHERE var_name = 'DAYS_TO_RETAIN' AND var_usage = 'MACHINERY' AND s.account_locator = a.account_locator) AS highest,
  o.var_value AS organization
FROM (SELECT DISTINCT account_locator FROM settings) a
LEFT JOIN settings o ON o.var_name = 'ORGANIZATION' AND o.var_usage = 'GLOBAL' AND o.region_name = 'R1' AND o.account_locator = a.account_locator"""
ORACLE["sql_access_patterns"] = f"""WITH {resolved()}, {ctes('query_history')}
SELECT database_name, count(*) AS queries FROM query_history WHERE {allowed(db())} GROUP BY database_name"""
ORACLE["sql_date_range"] = """SELECT o_orderstatus, CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS day
FROM orders GROUP BY o_orderstatus"""
ORACLE["sql_rate_timeseries"] = ORACLE["rate_timeseries"]
ORACLE["sql_rate_timeseries_all"] = ORACLE["rate_timeseries_all"]

ORACLE["live_query_history"] = f"""WITH {resolved()}, {ctes('query_history')},
own_left AS (SELECT * FROM own WHERE NOT coalesce(regexp_matches(dp, '[13579]'), FALSE)),
left_over AS (SELECT DISTINCT dp, wp FROM (
    SELECT * FROM own_left UNION ALL SELECT * FROM byrole WHERE (SELECT count(*) FROM own_left) = 0 AND NOT coalesce(regexp_matches(dp, '[13579]'), FALSE))
  WHERE dp IS NOT NULL AND wp IS NOT NULL)
SELECT query_id, warehouse_name, database_name, CAST(start_time AS DATE) AS start_date, CAST(floor(execution_time / 1000) AS BIGINT) AS execution_time_in_sec
FROM query_history WHERE EXISTS (SELECT 1 FROM left_over p WHERE {wh()} OR {db()})"""

ORACLE["live_warehouse_credit"] = f"""WITH {resolved()}, {COMPUTE_CLOUD}, {ctes('metering')},
seen AS (SELECT name AS warehouse_name, CAST(start_time AS DATE) AS start_date, credits_used FROM metering
  WHERE service_type = 'WAREHOUSE_METERING' AND {allowed(wh('name'))})
SELECT warehouse_name, CASE WHEN cloud.rate_date IS NULL THEN NULL ELSE compute.currency END AS currency, {num('sum(credits_used)', 'credits_used')},
  {num('sum(CASE WHEN cloud.rate_date IS NULL OR compute.rate_date IS NULL THEN 0 ELSE credits_used * compute.effective_rate END)', 'amount')}
FROM seen LEFT JOIN compute ON start_date = compute.rate_date LEFT JOIN cloud ON start_date = cloud.rate_date GROUP BY 1, 2"""

ORACLE["workspace_monthly_budget_recursive"] = ORACLE["workspace_monthly_budget"]
ORACLE["access_map_first_refresh"] = f"WITH {DERIVED} SELECT * FROM derived"
ORACLE["access_map_bad_rows"] = """WITH rows AS (SELECT c_custkey % 10 AS k, 'USR_' || c_custkey AS account, 'WH_' || c_custkey AS warehouse, 'DB_' || c_custkey AS database FROM customer)
SELECT 'good' AS kind, account, CAST(NULL AS VARCHAR) AS role, warehouse, database, CAST(NULL AS VARCHAR) AS bad_row FROM rows WHERE k NOT IN (3, 5, 7)
UNION ALL SELECT 'bad', NULL, NULL, NULL, NULL, CASE k WHEN 3 THEN account || ',' WHEN 5 THEN account || ',,' || warehouse || ',' || database || ',more'
  ELSE '"' || account || ',,' || warehouse || ',' || database END FROM rows WHERE k IN (3, 5, 7)"""

# ---------------------------------------------------------------- streams

ORACLE["stream_incremental_append"] = f"""WITH {ctes('query_history')}
SELECT query_id, warehouse_name, start_time, execution_time FROM query_history"""
ORACLE["stream_dedup_late"] = "SELECT event_id, ts, user_id, event_type FROM events"
