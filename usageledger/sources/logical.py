"""Logical inputs (metering, query history, grants, ...) made from the test tables.

Each input is one SELECT over the given Parquet tables that Spark and DuckDB both
run unchanged, so the reports and the queries they are checked against start
from the same rows. Base tables are written in braces. All rows of a base table
take part; conditions are on attributes such as segment or status.
"""

from __future__ import annotations

import re
import zlib
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usageledger.sources.tables import table

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _credits(cents: str, unit: str) -> str:
    """Exact decimal credits from a sum of cents."""
    return f"CAST(CAST(sum({cents}) AS DECIMAL(18,0)) * CAST({unit} AS DECIMAL(5,4)) AS DECIMAL(18,9))"


_CENTS = "CAST(round(value * 100) AS BIGINT)"
_HOUR = "date_trunc('hour', ts)"
_QUARTER = "(date_trunc('hour', ts) + CAST(floor(minute(ts) / 15) AS INT) * INTERVAL '15' MINUTE)"


def _name(prefix: str, number: str) -> str:
    return f"'{prefix}' || CAST({number} AS STRING)"


_DB_OF_EVENT = f"CASE WHEN event_id % 17 = 0 THEN NULL ELSE {_name('DB_', 'user_id % 7')} END"

INPUTS: dict[str, str] = {
    # ---- usage of warehouses, pipes and tables, from the event stream
    "metering": f"""
        SELECT user_id % 10 AS entity_id, {_name('WH_', 'user_id % 10')} AS name,
          CASE WHEN user_id % 10 = 9 THEN 'WAREHOUSE_METERING_READER' ELSE 'WAREHOUSE_METERING' END AS service_type,
          {_HOUR} AS start_time, {_HOUR} + INTERVAL '1' HOUR AS end_time,
          {_credits(_CENTS, '0.0003')} AS credits_used, {_credits(_CENTS, '0.0002')} AS credits_used_compute,
          {_credits(_CENTS, '0.0001')} AS credits_used_cloud_services
        FROM {{events}} GROUP BY user_id % 10, {_HOUR}
        UNION ALL
        SELECT 100 + user_id % 6, {_name('PIPE_', 'user_id % 6')}, 'PIPE', {_HOUR}, {_HOUR} + INTERVAL '1' HOUR,
          {_credits(_CENTS, '0.0001')}, {_credits(_CENTS, '0.0001')}, CAST(0 AS DECIMAL(18,9))
        FROM {{events}} WHERE event_type = 'purchase' GROUP BY user_id % 6, {_HOUR}""",
    "warehouse_metering": f"""
        SELECT user_id % 10 AS warehouse_id, {_name('WH_', 'user_id % 10')} AS warehouse_name,
          {_HOUR} AS start_time, {_HOUR} + INTERVAL '1' HOUR AS end_time, {_credits(_CENTS, '0.0003')} AS credits_used
        FROM {{events}} GROUP BY user_id % 10, {_HOUR}""",
    # meters of days, hours and quarters of an hour
    "mixed_metering": f"""
        SELECT user_id % 10 AS warehouse_id, {_name('WH_', 'user_id % 10')} AS warehouse_name, date_trunc('day', ts) AS start_time,
          date_trunc('day', ts) + INTERVAL '1' DAY AS end_time, {_credits(_CENTS, '0.0003')} AS credits_used
        FROM {{events}} WHERE user_id % 10 < 4 GROUP BY user_id % 10, date_trunc('day', ts)
        UNION ALL
        SELECT user_id % 10, {_name('WH_', 'user_id % 10')}, {_HOUR}, {_HOUR} + INTERVAL '1' HOUR, {_credits(_CENTS, '0.0003')}
        FROM {{events}} WHERE user_id % 10 BETWEEN 4 AND 6 GROUP BY user_id % 10, {_HOUR}
        UNION ALL
        SELECT user_id % 10, {_name('WH_', 'user_id % 10')}, {_QUARTER}, {_QUARTER} + INTERVAL '15' MINUTE, {_credits(_CENTS, '0.0003')}
        FROM {{events}} WHERE user_id % 10 > 6 GROUP BY user_id % 10, {_QUARTER}""",
    "named_metering": f"""
        SELECT 'DEV_BU' || CAST(user_id % 5 AS STRING) || '_P' || CAST(user_id % 12 AS STRING) || '_LOAD_WH' AS name,
          {_HOUR} AS start_time, {_HOUR} + INTERVAL '1' HOUR AS end_time, {_credits(_CENTS, '0.0003')} AS credits_used
        FROM {{events}} GROUP BY user_id % 5, user_id % 12, {_HOUR}""",
    "query_history": f"""
        SELECT event_id AS query_id, user_id % 10 AS warehouse_id, {_name('WH_', 'user_id % 10')} AS warehouse_name,
          {_DB_OF_EVENT} AS database_name, {_name('S_', 'event_id % 3')} AS schema_name,
          {_name('U_', 'user_id')} AS user_name, event_type AS query_type,
          CASE WHEN event_type = 'signup' THEN NULL ELSE 'SMALL' END AS warehouse_size,
          ts AS start_time, ts + INTERVAL '1' SECOND * CAST(floor(value) AS INT) AS end_time,
          CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value * 10) AS BIGINT) END AS execution_time,
          {_CENTS} AS bytes_scanned
        FROM {{events}}""",
    "reader_query_history": f"""
        SELECT event_id AS query_id, {_name('RA_', 'user_id % 3')} AS reader_account_name, user_id % 10 AS warehouse_id,
          {_name('WH_', 'user_id % 10')} AS warehouse_name, {_DB_OF_EVENT} AS database_name,
          {_name('U_', 'user_id')} AS user_name, ts AS start_time,
          ts + INTERVAL '1' SECOND * CAST(floor(value) AS INT) AS end_time, {_CENTS} AS execution_time
        FROM {{events}}""",
    "reader_metering": f"""
        SELECT {_name('RA_', 'user_id % 3')} AS reader_account_name, user_id % 10 AS warehouse_id,
          {_name('WH_', 'user_id % 10')} AS warehouse_name, {_HOUR} AS start_time, {_HOUR} + INTERVAL '1' HOUR AS end_time,
          {_credits(_CENTS, '0.0003')} AS credits_used
        FROM {{events}} GROUP BY user_id % 3, user_id % 10, {_HOUR}""",
    "table_service": f"""
        SELECT {_DB_OF_EVENT} AS database_name, {_name('S_', 'event_id % 3')} AS schema_name,
          {_name('T_', 'user_id % 20')} AS table_name, user_id % 20 AS table_id, {_HOUR} AS start_time,
          {_HOUR} + INTERVAL '1' HOUR AS end_time, {_credits(_CENTS, '0.0001')} AS credits_used,
          CAST(sum({_CENTS}) AS BIGINT) AS num_bytes
        FROM {{events}} GROUP BY {_DB_OF_EVENT}, event_id % 3, user_id % 20, {_HOUR}""",
    "task_service": f"""
        SELECT {_DB_OF_EVENT} AS database_name, {_name('S_', 'event_id % 3')} AS schema_name,
          'TASK_' || event_type AS task_name, {_HOUR} AS start_time, {_HOUR} + INTERVAL '1' HOUR AS end_time,
          {_credits(_CENTS, '0.0001')} AS credits_used
        FROM {{events}} GROUP BY {_DB_OF_EVENT}, event_id % 3, event_type, {_HOUR}""",
    "database_service": f"""
        SELECT {_DB_OF_EVENT} AS database_name, {_HOUR} AS start_time, {_HOUR} + INTERVAL '1' HOUR AS end_time,
          {_credits(_CENTS, '0.0001')} AS credits_used
        FROM {{events}} GROUP BY {_DB_OF_EVENT}, {_HOUR}""",
    "org_metering": f"""
        SELECT 'ORG' AS organization_name, {_name('NAME_', 'user_id % 3')} AS account_name,
          {_name('ACC_', 'user_id % 3')} AS account_locator, 'R1' AS region, user_id % 10 AS warehouse_id,
          {_name('WH_', 'user_id % 10')} AS warehouse_name, {_HOUR} AS start_time, {_HOUR} + INTERVAL '1' HOUR AS end_time,
          {_credits(_CENTS, '0.0003')} AS credits_used, {_credits(_CENTS, '0.0002')} AS credits_used_compute,
          {_credits(_CENTS, '0.0001')} AS credits_used_cloud_services
        FROM {{events}} GROUP BY user_id % 3, user_id % 10, {_HOUR}""",
    "pipes": f"""
        SELECT DISTINCT 100 + user_id % 7 AS pipe_id, {_name('S_', 'user_id % 7')} AS pipe_schema,
          {_name('DB_', 'user_id % 7')} AS pipe_catalog, {_name('OWNER_', 'user_id % 7')} AS pipe_owner
        FROM {{events}}""",
    "sessions": f"""
        SELECT event_id AS session_id, {_name('U_', 'user_id')} AS user_name,
          CASE WHEN event_id % 11 = 0 THEN NULL ELSE {_name('APP_', 'user_id % 4')} END AS client_application_id,
          ts AS created_on, event_id + 5 AS login_event_id
        FROM {{events}}""",
    "logins": """
        SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN 'NO' ELSE 'YES' END AS is_success
        FROM {events}""",
    # ---- task runs, prices and spending, from orders
    "task_runs": f"""
        SELECT o_orderkey AS query_id, {_name('T_', 'o_custkey % 20')} AS task_name, {_name('DB_', 'o_custkey % 7')} AS database_name,
          CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE {_name('S_', 'o_custkey % 3')} END AS schema_name,
          CASE WHEN o_orderstatus = 'F' THEN 'SUCCEEDED' WHEN o_orderstatus = 'O' THEN 'EXECUTING' ELSE 'FAILED' END AS state,
          CASE WHEN o_orderstatus = 'P' THEN 'E1' END AS error_code,
          CASE WHEN o_orderstatus = 'P' THEN 'failed' END AS error_message,
          o_orderdate AS scheduled_time, o_orderdate + INTERVAL '1' MINUTE AS query_start_time,
          CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate + INTERVAL '1' HOUR END AS completed_time,
          {_name('ROOT_', 'o_custkey % 20')} AS root_task_id,
          CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE CAST(1 AS BIGINT) END AS graph_version,
          o_orderkey AS run_id, CAST(NULL AS STRING) AS return_value
        FROM {{orders}}""",
    "rate_sheet": """
        SELECT 'ORG' AS organization_name, CAST(n AS BIGINT) + 1 AS contract_number, 'NAME_' || CAST(n AS STRING) AS account_name,
          'ACC_' || CAST(n AS STRING) AS account_locator, 'R1' AS region, CASE WHEN third = 20 THEN NULL ELSE 'ENTERPRISE' END AS service_level,
          CASE WHEN priority = '1-URGENT' THEN 'compute' WHEN priority = '2-HIGH' THEN 'overage-cloud services'
            WHEN priority = '3-MEDIUM' THEN 'search optimization' WHEN priority = '4-NOT SPECIFIED' THEN 'overage-serverless tasks'
            ELSE 'overage-adj for incl cloud services' END AS usage_type,
          CAST(CAST(month_start AS DATE) + INTERVAL '8218' DAY + INTERVAL '1' DAY * third AS DATE) AS rate_date, 'USD' AS currency,
          CAST(CAST(200 + n * 10 + extract(month FROM month_start) AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS effective_rate,
          CASE WHEN priority = '1-URGENT' THEN 'COMPUTE' ELSE 'OTHER' END AS service_type
        FROM (SELECT DISTINCT o_custkey % 3 AS n, o_orderpriority AS priority, date_trunc('month', o_orderdate) AS month_start,
            CASE WHEN extract(day FROM o_orderdate) < 11 THEN 0 WHEN extract(day FROM o_orderdate) < 21 THEN 10 ELSE 20 END AS third
          FROM {orders}) published""",
    "org_usage": f"""
        SELECT 'ORG' AS organization_name, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(7 AS BIGINT) END AS contract_number,
          {_name('NAME_', 'o_custkey % 3')} AS account_name, {_name('ACC_', 'o_custkey % 3')} AS account_locator, 'R1' AS region,
          'ENTERPRISE' AS service_level, CAST(o_orderdate AS DATE) AS usage_date,
          CASE WHEN o_orderpriority = '1-URGENT' THEN 'compute' WHEN o_orderpriority = '2-HIGH' THEN 'overage-compute'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'cloud services'
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'adj for incl cloud services' ELSE 'overage-storage' END AS usage_type,
          CASE WHEN o_orderstatus = 'P' THEN 'EUR' ELSE 'USD' END AS currency,
          CAST(round(o_totalprice * 100) AS DECIMAL(18,0)) AS usage,
          CAST(CAST(round(o_totalprice * 100) AS DECIMAL(16,0)) * CAST(0.03 AS DECIMAL(3,2)) AS DECIMAL(18,6)) AS usage_in_currency
        FROM {{orders}}""",
    # ---- file loads and storage, from line items
    "file_loads": f"""
        SELECT 'f_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) AS file_name,
          CASE WHEN l_linestatus = 'O' THEN NULL ELSE {_name('STAGE_', 'l_linenumber')} END AS stage_location,
          {_name('T_', 'l_partkey')} AS table_name, {_name('S_', 'l_partkey % 3')} AS table_schema_name,
          {_name('DB_', 'l_suppkey % 7')} AS table_catalog_name,
          CASE WHEN l_returnflag = 'R' THEN {_name('DB_', 'l_partkey % 7')} END AS pipe_catalog_name,
          CASE WHEN l_returnflag = 'R' THEN 'S_0' END AS pipe_schema_name,
          CASE WHEN l_returnflag = 'R' THEN {_name('PIPE_', 'l_partkey % 6')} END AS pipe_name,
          l_shipdate AS last_load_time, CAST(floor(l_quantity) AS BIGINT) AS row_count
        FROM {{lineitem}}""",
    "bulk_loads": f"""
        SELECT {_name('T_', 'l_partkey')} AS table_name, {_name('S_', 'l_partkey % 3')} AS schema_name,
          {_name('DB_', 'l_suppkey % 7')} AS catalog_name,
          'f_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) AS file_name,
          l_shipdate AS last_load_time, CAST(floor(l_quantity) AS BIGINT) AS row_count, 'LOADED' AS status
        FROM {{lineitem}}""",
    "database_storage": f"""
        SELECT CASE WHEN l_suppkey % 8 = 7 THEN NULL ELSE {_name('DB_', 'l_suppkey % 8')} END AS database_name,
          l_suppkey % 8 AS database_id, CAST(l_shipdate AS DATE) AS usage_date,
          CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) * 1000000 AS average_database_bytes,
          CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) * 3000000 AS average_failsafe_bytes
        FROM {{lineitem}} GROUP BY l_suppkey % 8, CAST(l_shipdate AS DATE)""",
    "account_storage": """
        SELECT CAST(l_shipdate AS DATE) AS usage_date,
          CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) * 1000000 AS storage_bytes,
          CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) * 3000000 AS stage_bytes,
          CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) * 5000000 AS failsafe_bytes
        FROM {lineitem} GROUP BY CAST(l_shipdate AS DATE)""",
    "table_storage": f"""
        SELECT {_name('T_', 'l_partkey')} AS table_name, {_name('S_', 'l_partkey % 3')} AS schema,
          {_name('DB_', 'l_partkey % 7')} AS database_name, 'NO' AS is_transient,
          CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) * 1000000 AS active_bytes,
          CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) * 3000000 AS time_travel_bytes,
          CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) * 5000000 AS failsafe_bytes,
          CAST(count(*) AS BIGINT) * 7000000 AS retained_for_clone_bytes,
          min(l_shipdate) AS table_created, max(l_shipdate) AS table_dropped
        FROM {{lineitem}} GROUP BY l_partkey""",
    "object_dependencies": f"""
        SELECT DISTINCT {_name('DB_', 'l_partkey % 7')} AS referenced_database, {_name('T_', 'l_partkey')} AS referenced_object_name,
          l_partkey AS referenced_object_id, 'TABLE' AS referenced_object_domain,
          {_name('DB_', 'l_suppkey % 7')} AS referencing_database, {_name('V_', 'l_suppkey')} AS referencing_object_name,
          l_suppkey AS referencing_object_id, 'VIEW' AS referencing_object_domain, 'BY_NAME' AS dependency_type
        FROM {{lineitem}}""",
    # ---- people, grants and tags, from customers
    "access_map": f"""
        SELECT CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN {_name('Usr_', 'c_nationkey % 5')} END AS account,
          CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD') THEN {_name('Role_', 'c_nationkey')} END AS role,
          CASE WHEN c_acctbal < 0 THEN NULL WHEN c_mktsegment = 'AUTOMOBILE' THEN '.+'
            ELSE 'WH_[' || CAST(c_nationkey % 4 AS STRING) || '-6](_.*)?' END AS warehouse,
          CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '.+'
            ELSE 'DB_(' || CAST(c_nationkey % 7 AS STRING) || '|' || CAST((c_nationkey + 2) % 7 AS STRING) || ')(_.*)?' END AS database
        FROM {{customer}}""",
    "access_map_current": f"""
        SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE {_name('U_', 'c_custkey')} END AS account,
          CASE WHEN c_mktsegment = 'MACHINERY' THEN {_name('ROLE_', 'c_custkey')} END AS role,
          CASE WHEN c_acctbal < 0 THEN NULL ELSE {_name('WH_', 'c_nationkey')} END AS warehouse,
          {_name('DB_', 'c_nationkey % 7')} AS database
        FROM {{customer}} WHERE c_mktsegment <> 'FURNITURE'""",
    "access_map_desired": f"""
        SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE {_name('U_', 'c_custkey')} END AS account,
          CASE WHEN c_mktsegment = 'MACHINERY' THEN {_name('ROLE_', 'c_custkey')} END AS role,
          CASE WHEN c_acctbal < 1000 THEN NULL ELSE {_name('WH_', 'c_nationkey')} END AS warehouse,
          CASE WHEN c_acctbal > 9000 THEN '.+' ELSE {_name('DB_', 'c_nationkey % 7')} END AS database
        FROM {{customer}} WHERE c_mktsegment <> 'HOUSEHOLD'""",
    "settings": f"""
        SELECT DISTINCT {_name('ACC_', 'c_nationkey')} AS account_locator, 'R1' AS region_name, 'DAYS_TO_RETAIN' AS var_name,
          CAST(300 + c_nationkey AS STRING) AS var_value, c_mktsegment AS var_usage, 'days kept' AS var_description
        FROM {{customer}}
        UNION ALL
        SELECT DISTINCT {_name('ACC_', 'c_nationkey')}, 'R1', 'ORGANIZATION', {_name('ORG_', 'c_nationkey')}, 'GLOBAL', 'owner'
        FROM {{customer}}""",
    "tag_references": f"""
        SELECT {_name('DB_', 'c_custkey')} AS object_name, CASE WHEN c_nationkey % 2 = 0 THEN 'DATABASE' ELSE 'WAREHOUSE' END AS domain,
          'BUSINESS_UNIT' AS tag_name, c_mktsegment AS tag_value,
          CASE WHEN c_acctbal > 9500 THEN 'deleted' END AS object_deleted
        FROM {{customer}} WHERE c_acctbal >= 500
        UNION ALL
        SELECT {_name('DB_', 'c_custkey')}, CASE WHEN c_nationkey % 2 = 0 THEN 'DATABASE' ELSE 'WAREHOUSE' END,
          'ENVIRONMENT', CASE WHEN c_nationkey > 12 THEN 'DEV' WHEN c_nationkey > 8 THEN NULL ELSE 'PROD' END,
          CASE WHEN c_acctbal > 9500 THEN 'deleted' END
        FROM {{customer}} WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
        UNION ALL
        SELECT {_name('DB_', 'c_custkey')}, 'TABLE', 'COST_CENTRE', 'C1', NULL FROM {{customer}}""",
    "object_listing": f"""
        SELECT {_name('DB_', 'c_custkey')} AS object_name, CASE WHEN c_nationkey % 2 = 0 THEN 'DATABASE' ELSE 'WAREHOUSE' END AS object_type,
          CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'SHARE' ELSE '' END AS origin
        FROM {{customer}}""",
    "tag_overrides": f"""
        SELECT {_name('DB_', 'c_custkey')} AS object_name, c_mktsegment || '_X' AS business_unit, 'CC' AS cost_centre,
          CAST(NULL AS STRING) AS business_division, CAST(NULL AS STRING) AS product_type, c_name AS product_name,
          CAST(NULL AS STRING) AS purpose, CASE WHEN c_nationkey > 5 THEN 'TEST' END AS environment
        FROM {{customer}} WHERE c_acctbal < 200""",
    "database_listing": f"""
        SELECT CASE c_custkey % 7 WHEN 0 THEN 'ES_BU' || CAST(c_nationkey AS STRING) || '_X' || CAST(c_custkey AS STRING)
            WHEN 1 THEN 'T' || CAST(c_custkey AS STRING) || '_OF_POC_DB'
            WHEN 2 THEN 'BU' || CAST(c_nationkey AS STRING) || '_L' || CAST(c_custkey AS STRING) || '_LAB_DB'
            WHEN 3 THEN 'DEV_BU' || CAST(c_nationkey AS STRING) || '_P' || CAST(c_custkey AS STRING) || '_DB'
            WHEN 4 THEN 'PROD_P' || CAST(c_custkey AS STRING) || '_DB'
            WHEN 5 THEN 'DB_' || CAST(c_custkey AS STRING) ELSE 'SYSTEM' END AS name,
          {_name('OWN_', 'c_nationkey')} AS owner, c_mktsegment AS comment
        FROM {{customer}}""",
    "warehouse_listing": f"""
        SELECT CASE c_custkey % 8 WHEN 0 THEN 'ES_BU' || CAST(c_nationkey AS STRING) || '_X' || CAST(c_custkey AS STRING)
            WHEN 1 THEN 'T' || CAST(c_custkey AS STRING) || '_OF_POC_WH'
            WHEN 2 THEN 'BU' || CAST(c_nationkey AS STRING) || '_L' || CAST(c_custkey AS STRING) || '_LAB_WH'
            WHEN 3 THEN 'TEST_BU' || CAST(c_nationkey AS STRING) || '_P' || CAST(c_custkey AS STRING) || '_LOAD_WH'
            WHEN 4 THEN 'STAGE_BU' || CAST(c_nationkey AS STRING) || '_P' || CAST(c_custkey AS STRING) || '_A_B_WH'
            WHEN 5 THEN 'PROD_BU' || CAST(c_custkey AS STRING) || '_WH'
            WHEN 6 THEN 'WH_' || CAST(c_custkey AS STRING) ELSE 'PLAIN_OTHER_' || CAST(c_custkey AS STRING) END AS name,
          {_name('OWN_', 'c_nationkey')} AS owner, c_mktsegment AS comment
        FROM {{customer}}""",
    "database_overrides": """
        SELECT 'DB_' || CAST(c_custkey AS STRING) AS name, 'BOSS' AS owner, CAST(NULL AS STRING) AS comment, 'MANUAL' AS db_type,
          CASE WHEN c_nationkey > 10 THEN 'PROD' END AS env, c_mktsegment AS bu, CAST(NULL AS STRING) AS db_name
        FROM {customer} WHERE c_acctbal < 2000""",
    "warehouse_overrides": """
        SELECT 'WH_' || CAST(c_custkey AS STRING) AS name, 'BOSS' AS owner, CAST(NULL AS STRING) AS comment, 'MANUAL' AS wh_type,
          CASE WHEN c_nationkey > 10 THEN 'PROD' END AS env, c_mktsegment AS bu, CAST(NULL AS STRING) AS db_name, 'LOAD' AS purpose
        FROM {customer} WHERE c_acctbal < 2000""",
    "role_grants": f"""
        SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'SYSADMIN' ELSE {_name('ROLE_', 'c_nationkey')} END AS grantee_name,
          CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') THEN 'DATABASE'
            WHEN c_mktsegment = 'MACHINERY' THEN 'TABLE' ELSE 'WAREHOUSE' END AS granted_on,
          CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') THEN {_name('DB_', 'c_custkey % 7')} ELSE {_name('WH_', 'c_custkey % 10')} END AS name,
          CASE WHEN c_acctbal > 5000 THEN 'USAGE' ELSE 'OWNERSHIP' END AS privilege
        FROM {{customer}}""",
    "role_tags": """
        SELECT DISTINCT 'role_' || CAST(c_nationkey AS STRING) AS id, 'ROLE' AS type,
          CASE WHEN c_nationkey > 20 THEN '{"owner":"x"}' ELSE '{"workspace_name":"ws' || CAST(c_nationkey AS STRING) || '"}' END AS tags
        FROM {customer}
        UNION ALL
        SELECT DISTINCT 'sysadmin', 'ROLE', '{"workspace_name":"sys"}' FROM {customer}""",
    "user_grants": f"""
        SELECT {_name('U_', 'c_custkey')} AS grantee_name, {_name('ROLE_', 'c_nationkey')} AS role, c_mktsegment AS granted_by
        FROM {{customer}}""",
    "raw_warehouse_tags": f"SELECT {_name('WH_', 'c_custkey % 10')} AS name, c_mktsegment AS tag FROM {{customer}}",
    "raw_database_tags": f"SELECT {_name('DB_', 'c_custkey % 7')} AS name, c_name AS tag FROM {{customer}}",
    "monitors": f"""
        SELECT {_name('RM_', 's_suppkey')} AS name, CAST(1000 + s_nationkey AS STRING) AS credit_quota, '10' AS used_credits,
          '990' AS remaining_credits, 'MONTHLY' AS frequency, CASE WHEN s_acctbal < 0 THEN 'ACCOUNT' ELSE 'WAREHOUSE' END AS level,
          TIMESTAMP '2024-01-01 00:00:00' AS start_time, CAST(NULL AS TIMESTAMP) AS end_time, '75%' AS notify_at,
          '95%' AS suspend_at, '100%' AS suspend_immediately_at, TIMESTAMP '2023-12-01 00:00:00' AS created_on,
          {_name('OWN_', 's_nationkey')} AS owner, s_name AS comment
        FROM {{supplier}}""",
    "warehouses": f"""
        SELECT {_name('WH_', 's_suppkey')} AS name, 'STANDARD' AS type, 'SMALL' AS size, 1 AS min_cluster_count, 2 AS max_cluster_count,
          TIMESTAMP '2023-11-01 00:00:00' AS created_on, TIMESTAMP '2024-01-01 00:00:00' AS updated_on, s_name AS comment,
          CASE WHEN s_nationkey > 20 THEN NULL ELSE {_name('RM_', 's_suppkey % 10')} END AS resource_monitor, 'STANDARD' AS scaling_policy
        FROM {{supplier}}""",
    "purchases": """
        SELECT s_suppkey AS pur_id, CAST(floor(s_suppkey / 2) AS BIGINT) AS ws_id, CAST(1000 + s_suppkey * 7 AS BIGINT) AS purchased_credits,
          CAST(3.25 AS DECIMAL(12,2)) AS purchased_rate, CAST(CAST(1000 + s_suppkey * 7 AS DECIMAL(12,0)) * CAST(3.25 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS purchased_amount,
          CASE WHEN s_nationkey > 16 THEN DATE '2023-07-31' WHEN s_nationkey > 8 THEN DATE '2023-09-01' ELSE DATE '2024-01-15' END AS purchased_date,
          CASE WHEN s_acctbal < 0 THEN DATE '2024-01-20' WHEN s_acctbal < 5000 THEN DATE '2024-06-30' ELSE DATE '2024-12-31' END AS renewal_date
        FROM {supplier}""",
    "tracker": f"""
        SELECT DISTINCT CAST(floor(s_suppkey / 2) AS BIGINT) AS ws_id, 'WS_' || CAST(CAST(floor(s_suppkey / 2) AS BIGINT) AS STRING) AS workspace,
          'workspace' AS workspace_desc, 'DP' AS workspace_type, 'BU' || CAST(CAST(floor(s_suppkey / 2) AS BIGINT) % 5 AS STRING) AS bu
        FROM {{supplier}}""",
    "workspace_types": """
        SELECT DISTINCT upper(substring(p_type, 1, 3)) AS workspace_type, p_type AS workspace_type_desc FROM {part}
        UNION ALL SELECT DISTINCT 'ES', 'outdated' FROM {part}""",
    "connectors": f"""
        SELECT CAST(p_partkey AS STRING) AS id, p_name AS official_connector_name, p_type AS type, p_brand AS availability,
          TIMESTAMP '2022-01-01 00:00:00' + INTERVAL '1' DAY * p_size AS created_at,
          TIMESTAMP '2022-06-01 00:00:00' AS public_beta_at, CASE WHEN p_size > 25 THEN TIMESTAMP '2023-01-01 00:00:00' END AS release_at,
          p_size > 45 AS deleted, p_size < 3 AS broken,
          TIMESTAMP '2022-12-01 00:00:00' + INTERVAL '10' DAY * p_size AS synced
        FROM {{part}}""",
    "users": f"SELECT c_name AS name, TIMESTAMP '2023-01-01 00:00:00' + INTERVAL '1' DAY * c_nationkey AS created_on FROM {{customer}}",
    "databases": f"SELECT {_name('DB_', 'p_partkey')} AS name, TIMESTAMP '2023-01-01 00:00:00' + INTERVAL '1' DAY * p_size AS created_on FROM {{part}}",
    "roles": f"SELECT {_name('ROLE_', 'n_nationkey')} AS name, TIMESTAMP '2023-01-01 00:00:00' AS created_on FROM {{nation}}",
    # ---- the log of the connector service: twelve tables with columns of their own
    "log_account": "SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region_id FROM {nation}",
    "log_account_membership": "SELECT c_nationkey AS account_id, c_custkey AS user_id, c_mktsegment AS account_role FROM {customer}",
    "log_audit": "SELECT event_id AS id, ts AS occurred, event_type AS action, user_id AS actor_id FROM {events} WHERE event_type IN ('purchase', 'signup')",
    "log_connector": f"SELECT s_suppkey AS connector_id, s_name AS connector_name, s_nationkey AS destination_id, s_acctbal < 0 AS paused FROM {{supplier}}",
    "log_destination": "SELECT n_nationkey AS id, n_name AS name, n_regionkey AS account_id FROM {nation}",
    "log_destination_membership": "SELECT c_nationkey AS destination_id, c_custkey AS user_id, c_custkey % 3 = 0 AS activated FROM {customer}",
    "log_incremental_mar": """SELECT l_suppkey AS connector_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS measured_month,
          count(*) AS incremental_rows FROM {lineitem} GROUP BY l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE)""",
    "log_log": "SELECT event_id AS id, ts AS time_stamp, event_type AS event, props AS message_data FROM {events}",
    "log_resource_membership": "SELECT p_partkey AS id, p_brand AS resource, p_size % 7 AS role_id FROM {part}",
    "log_role": "SELECT r_regionkey AS id, r_name AS name FROM {region}",
    "log_role_permission": "SELECT s_nationkey % 5 AS role_id, s_suppkey AS permission_id, s_name AS permission FROM {supplier}",
    "log_user": f"SELECT c_custkey AS id, c_name AS name, {_name('USR_', 'c_custkey')} AS login FROM {{customer}}",
}


def statement(name: str) -> str:
    """The SELECT of an input with base tables named as they are."""
    return re.sub(r"\{(%s)\}" % "|".join(BASE_TABLES), r"\1", INPUTS[name])


@cache
def _view(spark: SparkSession, folder: str, name: str) -> str:
    view = f"usageledger_{name}_{zlib.crc32(folder.encode()):08x}"
    table(spark, folder, name).createOrReplaceTempView(view)
    return view


@cache
def logical(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A logical input over the tables in folder; times are zone-less as in the files."""
    text = INPUTS[name]
    for t in BASE_TABLES:
        if f"{{{t}}}" in text:
            text = text.replace(f"{{{t}}}", _view(spark, folder, t))
    df = spark.sql(text)
    zoned = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in zoned else F.col(c) for c in df.columns])
