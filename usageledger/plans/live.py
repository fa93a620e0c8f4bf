"""Views that are answered when they are read: SQL texts over stored names, with the caller in session variables.

A view registered once shows what its tables, the access map and the caller are at
the time of the query. Nothing about the caller is read when it is registered: the
patterns are a subquery of the view's text that tests the distinct names of a table,
and the rows are semi-joined to the names that pass. Prices are a subquery as well,
the caller's list of changes, in which a row looks its day up.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import SparkSession

from usageledger.context import REPORT_SERVICE_ROLE, ReportContext
from usageledger.operators.access import DATABASE, WAREHOUSE
from usageledger.operators.rates import COMPUTE_AND_CLOUD, LONGEST_BOOK, intervals_sql
from usageledger.plans.publish import DAY, counts_name
from usageledger.plans.views import CLOUD_AND_COMPUTE

Names = Mapping[str, str]
#: Rows of the view of the newest queries.
NEWEST = 1_000_000
SHEET = "org_rate_sheet"
#: The counts that are kept beside a stored query history.
COUNTS = "query_history counts"

SERVICE = f"array_contains(session.report_roles, '{REPORT_SERVICE_ROLE.lower()}')"


def set_caller(spark: SparkSession, ctx: ReportContext) -> None:
    """Who asks from now on in this session: user, roles (in lower case, and as they are named), account, region and day."""
    quoted = lambda t: "'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'"
    listed = lambda texts: f"CAST(array({', '.join(map(quoted, texts))}) AS ARRAY<STRING>)"
    values = {
        "report_user": ("STRING", quoted(ctx.user.lower())),
        "report_roles": ("ARRAY<STRING>", listed(r.lower() for r in ctx.roles)),
        "report_role_names": ("ARRAY<STRING>", listed(ctx.roles)),
        "report_account": ("STRING", quoted(ctx.account)),
        "report_region": ("STRING", quoted(ctx.region)),
        "report_today": ("DATE", f"DATE '{ctx.today}'"),
    }
    for name, (kind, value) in values.items():
        spark.sql(f"DECLARE OR REPLACE VARIABLE {name} {kind} DEFAULT {value}")


def patterns_sql(access_map: str) -> str:
    """The rule of resolve_access_patterns for the caller of the session."""
    return f"""
    WITH own AS (
      SELECT database AS {DATABASE}, warehouse AS {WAREHOUSE}, role IS NULL AS of_user FROM {access_map}
      WHERE (lower(account) = session.report_user AND role IS NULL)
        OR (account IS NULL AND array_contains(session.report_roles, lower(role))))
    SELECT DISTINCT {DATABASE}, {WAREHOUSE} FROM own
    WHERE of_user = (SELECT max(of_user) FROM own) AND {DATABASE} IS NOT NULL AND {WAREHOUSE} IS NOT NULL"""


def _allowed(column: str, pattern: str) -> str:
    return f"regexp_like(n.{column}, concat('\\\\A(?:', p.{pattern}, ')\\\\z'))"


def scoped_sql(table: str, patterns: str, tests: Sequence[tuple[str, str]], every: bool = True, columns: str = "h.*") -> str:
    """Rows of a table for which some pattern row passes the tests (column, pattern column), all of them or any."""
    names = list(dict.fromkeys(c for c, _ in tests))
    condition = (" AND " if every else " OR ").join(_allowed(c, p) for c, p in tests)
    same = " AND ".join(f"h.{c} <=> s.{c}" for c in names)
    allowed = f"SELECT collect_list(struct({DATABASE}, {WAREHOUSE})) FROM {patterns}"  # a caller's patterns, one row
    return f"""
    SELECT {columns} FROM {table} h LEFT SEMI JOIN (
      SELECT {', '.join(names)} FROM (SELECT *, ({allowed}) AS _allowed FROM (SELECT DISTINCT {', '.join(names)} FROM {table})) n
      WHERE exists(_allowed, p -> {condition})) s ON {same}"""


def _elapsed(start: str = "start_time", end: str = "end_time") -> str:
    return f"unix_seconds(CAST({end} AS TIMESTAMP)) - unix_seconds(CAST({start} AS TIMESTAMP)) AS elapsed_time_in_sec"


def _priced(rows: str, sheet: str, wanted: dict[str, str], amounts: dict[str, str], every_account: bool = False) -> str:
    """Rows with their amounts in currency, by the last price change on or before their day, found by halving."""
    visible = SERVICE if every_account else f"{SERVICE} AND account_locator = session.report_account AND region = session.report_region"
    intervals = intervals_sql(wanted, sheet, "session.report_today", visible)
    book = f"sort_array(collect_list(struct(first_day, currency, {', '.join(wanted)})))"
    if every_account:
        books = f"SELECT account_locator, region, {book} AS _book FROM ({intervals}) GROUP BY account_locator, region"
        with_book = f"SELECT h.*, b._book FROM ({rows}) h LEFT JOIN ({books}) b ON h.account_locator = b.account_locator AND h.region = b.region"
    else:
        with_book = f"SELECT *, (SELECT {book} FROM ({intervals})) AS _book FROM ({rows})"
    steps = ", ".join(str(LONGEST_BOOK + 1 >> k) for k in range(1, LONGEST_BOOK.bit_length() + 1))
    reached = "p + s <= coalesce(size(_book), 0) AND get(_book, p + s - 1).first_day <= to_date(start_time)"
    place = f"aggregate(array({steps}), 0, (p, s) -> IF({reached}, p + s, p))"
    price = "CASE WHEN _place > 0 AND to_date(start_time) <= session.report_today THEN get(_book, _place - 1) END"
    money = ", ".join(f"coalesce({credits} * _price.{rate}, 0) AS {credits}_effective_rate" for credits, rate in amounts.items())
    return f"""
    SELECT * EXCEPT (_book, _place, _price), {money}, _price.currency AS currency
    FROM (SELECT *, {price} AS _price FROM (SELECT *, {place} AS _place FROM ({with_book})))"""


View = Callable[[Names, str], str]


def _by(column: str, pattern: str = DATABASE, more: str = "") -> Callable[[str], View]:
    """One column must match; ``more`` are further columns."""
    return lambda table: lambda t, p: f"SELECT *{more} FROM ({scoped_sql(t[table], p, [(column, pattern)])})"


_EITHER = [("warehouse_name", WAREHOUSE), ("database_name", DATABASE)]
_QUERY = f", {_elapsed()}, to_date(start_time) AS start_date, CAST(floor(execution_time / 1000) AS BIGINT) AS execution_time_in_sec"


def _either(table: str, more: str = "") -> View:
    return lambda t, p: f"SELECT *{more} FROM ({scoped_sql(t[table], p, _EITHER, False)})"


def _newest(t: Names, p: str) -> str:
    """The newest of the queries a caller may see; the counts of the history say from which hour on."""
    hours = f"SELECT hour, sum(rows) AS n FROM ({scoped_sql(t[COUNTS], p, _EITHER, False)}) WHERE hour IS NOT NULL GROUP BY hour"
    edge = f"SELECT min(hour) FROM (SELECT hour, sum(n) OVER (ORDER BY hour DESC) - n AS newer FROM ({hours})) WHERE newer < {NEWEST}"
    return f"""
    SELECT *{_QUERY} FROM ({scoped_sql(t['query_history'], p, _EITHER, False)})
    WHERE start_time >= ({edge}) ORDER BY start_time DESC, query_id DESC LIMIT {NEWEST}"""


def _service(table: str, usage_type: str) -> View:
    def text(t: Names, p: str) -> str:
        rows = f"SELECT *, {_elapsed()} FROM ({scoped_sql(t[table], p, [('database_name', DATABASE)])})"
        return _priced(rows, t[SHEET], {"rate": usage_type}, {"credits_used": "rate"})

    return text


def _warehouse_credit(t: Names, p: str) -> str:
    rows = f"SELECT *, {_elapsed()} FROM ({scoped_sql(t['warehouse_credit'], p, [('warehouse_name', WAREHOUSE)])})"
    return _priced(rows, t[SHEET], COMPUTE_AND_CLOUD, CLOUD_AND_COMPUTE)


def _org_metering(t: Names, p: str) -> str:
    rows = f"SELECT *, to_date(start_time) AS start_date FROM {t['org_metering']} WHERE {SERVICE}"
    return _priced(rows, t[SHEET], COMPUTE_AND_CLOUD, CLOUD_AND_COMPUTE, every_account=True)


def _gated(table: str, where: str = "true") -> View:
    return lambda t, p: f"SELECT DISTINCT * FROM {t[table]} WHERE {where} AND EXISTS (SELECT 1 FROM {p})"


def _whole(table: str) -> View:
    return lambda t, p: f"SELECT * FROM {t[table]}"


def _service_only(table: str) -> View:
    return lambda t, p: f"SELECT * FROM {t[table]} WHERE {SERVICE}"


_E = f", {_elapsed()}"
_TOTAL = ", active_bytes_gb + time_travel_bytes_gb + failsafe_bytes_gb + retained_for_clone_bytes_gb AS total_storage_gb"

#: Views by name: the tables each needs and its text.
LIVE_VIEWS: dict[str, tuple[tuple[str, ...], View]] = {
    "auto_clustering": (("auto_clustering",), _by("database_name", more=_E)("auto_clustering")),
    "mv_refresh": (("mv_refresh",), _by("database_name", more=_E)("mv_refresh")),
    "replication": (("replication",), _by("database_name", more=_E)("replication")),
    "search_optimization": (("search_optimization", SHEET), _service("search_optimization", "search optimization")),
    "serverless_task": (("serverless_task", SHEET), _service("serverless_task", "serverless tasks")),
    "copy_history": (
        ("copy_history",),
        lambda t, p: scoped_sql(t["copy_history"], p, [("table_catalog_name", DATABASE), ("pipe_catalog_name", DATABASE)], False),
    ),
    "load_history": (("load_history",), _by("catalog_name")("load_history")),
    "database_storage": (("database_storage",), _by("database_name")("database_storage")),
    "account_storage": (("account_storage",), _whole("account_storage")),
    "sessions": (("sessions",), _whole("sessions")),
    "pipe_credit": (("pipe_credit",), _by("pipe_database", more=_E)("pipe_credit")),
    "query_history": (("query_history",), _either("query_history", _QUERY)),
    "newest_queries": (("query_history", COUNTS), _newest),
    "reader_query_history": (("reader_query_history",), _either("reader_query_history", _QUERY)),
    "reader_warehouse_credit": (("reader_warehouse_credit",), _by("warehouse_name", WAREHOUSE, _E)("reader_warehouse_credit")),
    "task_history": (("task_history",), _by("database_name", more=f", {_elapsed('query_start_time', 'completed_time')}")("task_history")),
    "warehouse_credit": (("warehouse_credit", SHEET), _warehouse_credit),
    "org_currency": (("org_currency",), _service_only("org_currency")),
    "org_rate_sheet": ((SHEET,), _service_only(SHEET)),
    "org_metering": (("org_metering", SHEET), _org_metering),
    "query_credit": (("query_credit",), _either("query_credit")),
    "db_schema_credit": (("db_schema_credit",), lambda t, p: scoped_sql(t["db_schema_credit"], p, _EITHER)),
    "month_credits": (("month_credits",), _by("name", WAREHOUSE)("month_credits")),
    "grants_to_roles": (
        ("grants_to_roles",),
        lambda t, p: f"SELECT * FROM {t['grants_to_roles']} WHERE array_contains(session.report_role_names, grantee_name)",
    ),
    "grants_to_users": (("grants_to_users",), _whole("grants_to_users")),
    "table_storage": (("table_storage",), _by("database_name", more=_TOTAL)("table_storage")),
    "object_dependencies": (("object_dependencies",), _whole("object_dependencies")),
    **{
        f"active_{name}": (("active_resources",), _gated("active_resources", f"resource_type = '{kind}'"))
        for name, kind in (("databases", "DATABASE"), ("warehouses", "WAREHOUSE"), ("roles", "ROLE"), ("users", "USER"), ("monitors", "RM"))
    },
    "connector_types": (("connector_types",), _gated("connector_types")),
}


def register_live_views(spark: SparkSession, names: Names, access_map: str, ctx: ReportContext, prefix: str = "ext_") -> list[str]:
    """Temporary views as SQL texts over stored tables, once per session; those whose tables are named.

    ``names`` says under which name each report is stored, ``access_map`` where the
    access map is. Afterwards ``set_caller`` changes whose rows the views show, and a
    published report or access map shows from the next query on.
    """
    set_caller(spark, ctx)
    counts = counts_name(names.get("query_history", ""))
    if counts != counts_name("") and spark.catalog.tableExists(counts):
        names = {**names, COUNTS: counts}
    patterns = f"{prefix}caller_patterns"
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {patterns} AS {patterns_sql(access_map)}")
    made = []
    for view, (needed, text) in LIVE_VIEWS.items():
        if all(n in names for n in needed):
            body = text(names, patterns)
            spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {prefix}{view} AS {body}")
            if DAY in spark.table(prefix + view).columns:
                spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {prefix}{view} AS SELECT * EXCEPT ({DAY}) FROM ({body})")
            made.append(prefix + view)
    return made
