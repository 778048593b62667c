"""The registered queries as standalone SQL over the same tables, for an independent check."""

from __future__ import annotations

from orestack import registry
from orestack.plans import gold, silver
from orestack.sources import star_tables as star


def _list(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{value}'" for value in values)


_FIRST, _SECOND = star.BATCH_DATES

_RAW_ORDERS = f"""
raw_orders AS (
  SELECT
    CASE WHEN l_partkey % {star.PART_WITHOUT_ORDER_ID} <> 0
         THEN CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS order_id,
    CAST(o_custkey AS VARCHAR) AS customer_id,
    CAST(l_partkey AS VARCHAR) AS product_id,
    CASE WHEN l_partkey % {star.PART_WITH_ZERO_QUANTITY} = 0 THEN 0
         ELSE CAST(l_quantity AS INTEGER) END AS quantity,
    l_extendedprice AS unit_price,
    CASE WHEN l_partkey % {star.PART_WITH_UNKNOWN_STATUS} = 0 THEN 'unknown'
         WHEN l_returnflag = 'R' THEN ' CANCELLED '
         WHEN o_orderstatus = 'F' THEN 'delivered'
         WHEN o_orderstatus = 'O' THEN 'shipped'
         WHEN l_linestatus = 'F' THEN 'confirmed'
         ELSE 'pending' END AS status,
    CASE WHEN l_partkey % {star.PART_WITH_BAD_DATE} = 0 THEN '2024-13-45'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ingested_at,
    CASE WHEN l_shipdate < TIMESTAMP '{_FIRST}' THEN 0
         WHEN l_shipdate < TIMESTAMP '{_SECOND}' THEN 1 ELSE 2 END AS batch
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
)"""

_TYPED = """
typed AS (
  SELECT order_id, customer_id, product_id, quantity,
    unit_price,
    lower(trim(status)) AS status,
    CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) AS order_date,
    ingested_at,
    TRY_CAST(quantity * unit_price AS DECIMAL(28,6)) AS total_amount,
    batch
  FROM raw_orders
)"""

_ORDER_RULES = (
    ("order_id_present", "order_id IS NOT NULL"),
    ("customer_id_present", "customer_id IS NOT NULL"),
    ("quantity_positive", "quantity > 0"),
    ("unit_price_positive", "unit_price > 0"),
    ("status_known", f"status IN ({_list(silver.STATUSES)})"),
    ("order_date_valid", "order_date IS NOT NULL"),
    ("total_fits", "total_amount IS NOT NULL"),
)

_CUSTOMER_RULES = (
    ("customer_id_present", "customer_id IS NOT NULL"),
    ("email_has_at_sign", "contains(email, '@')"),
    ("region_known", f"region IN ({_list(star.VALID_REGIONS)})"),
)


def _all(rules: tuple[tuple[str, str], ...]) -> str:
    return " AND ".join(condition for _, condition in rules)


_VALID = f"valid AS (SELECT * FROM typed WHERE {_all(_ORDER_RULES)})"

_NEWEST = """ORDER BY ingested_at DESC NULLS LAST, product_id DESC NULLS LAST, customer_id DESC NULLS LAST,
      quantity DESC NULLS LAST, unit_price DESC NULLS LAST, status DESC NULLS LAST,
      order_date DESC NULLS LAST"""

_SILVER = f"""
silver AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id {_NEWEST}) AS newest FROM valid
  ) WHERE newest = 1
)"""

_BATCH_SILVER = f"""
batch_silver AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY batch, order_id {_NEWEST}) AS newest FROM valid
  ) WHERE newest = 1
)"""

_CUSTOMERS = f"""
cleaned AS (
  SELECT
    CAST(c_custkey AS VARCHAR) AS customer_id,
    trim('  ' || c_name || ' ') AS name,
    lower(trim(CASE
      WHEN c_custkey % {star.CUSTOMER_WITHOUT_EMAIL} = 0 THEN NULL
      WHEN c_custkey % {star.CUSTOMER_WITHOUT_AT_SIGN} = 0 THEN ' No.At.' || CAST(c_custkey AS VARCHAR)
      ELSE ' ' || c_name || '@Example.COM ' END)) AS email,
    regexp_replace('09 ' || CAST(c_custkey AS VARCHAR) || chr(9) || ' 1', '\\s+', '', 'g') AS phone,
    trim(' ' || n_name) AS city,
    trim(' ' || r_name || ' ') AS region,
    CAST(try_strptime(CASE WHEN c_custkey % {star.CUSTOMER_WITH_BAD_DATE} = 0 THEN '2022-02-30'
                           ELSE '2022-03-01' END, '%Y-%m-%d') AS DATE) AS created_date
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
),
customers AS (SELECT * FROM cleaned WHERE {_all(_CUSTOMER_RULES)})"""

_FACT = f"""
fact AS (
  SELECT order_id, order_date,
    CAST(year(order_date) AS INTEGER) AS order_year,
    CAST(month(order_date) AS INTEGER) AS order_month,
    CAST(quarter(order_date) AS INTEGER) AS order_quarter,
    silver.customer_id, customers.name AS customer_name, customers.region,
    product_id, p_name AS product_name, p_type AS category,
    quantity, unit_price, total_amount,
    coalesce(total_amount >= {gold.HIGH_VALUE_FROM}, FALSE) AS is_high_value, status
  FROM silver
  LEFT JOIN customers ON silver.customer_id = customers.customer_id
  LEFT JOIN part ON product_id = CAST(p_partkey AS VARCHAR)
)"""

_DAILY = """
daily AS (
  SELECT order_date, order_year, order_month, region, category,
    count(order_id) AS order_count,
    round(CAST(sum(total_amount) AS DECIMAL(28,2)), 0) AS revenue,
    round(CAST(CAST(sum(total_amount) AS DECIMAL(28,2)) AS DOUBLE) / count(total_amount), 0)
      AS avg_order_value,
    CAST(sum(quantity) AS BIGINT) AS units_sold,
    count(DISTINCT customer_id) AS customer_count,
    count(*) FILTER (WHERE is_high_value) AS high_value_orders
  FROM fact WHERE status <> 'cancelled'
  GROUP BY order_date, order_year, order_month, region, category
)"""

# The contents after batch n: customer and product of the first batch that has the order, the other
# columns of the last one.
_AS_OF = """
v{n} AS (
  SELECT order_id,
    arg_min(customer_id, batch) AS customer_id, arg_min(product_id, batch) AS product_id,
    arg_max(quantity, batch) AS quantity, arg_max(unit_price, batch) AS unit_price,
    arg_max(status, batch) AS status, arg_max(order_date, batch) AS order_date,
    arg_max(total_amount, batch) AS total_amount
  FROM batch_silver WHERE batch <= {n} GROUP BY order_id
)"""

# All of bronze merged into the restored first load.
_FULL_MERGE = """
full_merge AS (
  SELECT order_id, coalesce(v0.customer_id, silver.customer_id) AS customer_id,
    coalesce(v0.product_id, silver.product_id) AS product_id, silver.quantity, silver.unit_price,
    silver.status, silver.order_date, silver.total_amount, v0.order_id IS NOT NULL AS known
  FROM silver LEFT JOIN v0 USING (order_id)
)"""

# Batches refreshed one after the other: the newest copy of all, with customer and product of the first batch.
_REFRESHED = """
refreshed AS (
  SELECT order_id, v2.customer_id, v2.product_id, silver.quantity, silver.unit_price, silver.status, silver.order_date,
    silver.total_amount
  FROM silver JOIN v2 USING (order_id)
)"""
_REFRESHED_FACT = _FACT.replace("fact AS", "refreshed_fact AS").replace("silver", "refreshed")

_ORDERS = [_RAW_ORDERS, _TYPED, _VALID]
_SILVER_CHAIN = [*_ORDERS, _SILVER]
_FACT_CHAIN = [*_SILVER_CHAIN, _CUSTOMERS, _FACT]
_DAILY_CHAIN = [*_FACT_CHAIN, _DAILY]
_VERSIONS = [*_SILVER_CHAIN, _BATCH_SILVER, *(_AS_OF.format(n=n) for n in range(3)), _FULL_MERGE]

_REFRESHES = [*_VERSIONS, _REFRESHED, _CUSTOMERS, _REFRESHED_FACT]

_RAW_COLUMNS = "order_id, customer_id, product_id, quantity, unit_price, status, order_date, ingested_at"


def _doubles(*names: str) -> str:
    return ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in names)


_PRICES = _doubles("unit_price", "total_amount")
_SILVER_COLUMNS = f"order_id, customer_id, product_id, quantity, status, order_date, {_PRICES}"
_FACT_COLUMNS = f"""order_id, order_date, order_year, order_month, order_quarter, customer_id,
  customer_name, region, product_id, product_name, category, quantity, {_PRICES}, is_high_value, status"""


def _with(parts: list[str], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def _millions(amount: str, digits: int) -> str:
    return (f"CAST(round(CAST({amount} AS DECIMAL(28,2)) * CAST(0.000001 AS DECIMAL(7,6)), {digits})"
            " AS DOUBLE)")


def _thousands(average: str) -> str:
    return f"round(({average}) / 100.0, 0) / 10.0"


def _percent(part: str, whole: str) -> str:
    return f"round({part} * CAST(1000 AS DOUBLE) / {whole}, 0) / CAST(10 AS DOUBLE)"


def _accounting(rules: tuple[tuple[str, str], ...]) -> str:
    valid = f"coalesce({_all(rules)}, FALSE)"
    failed = ", ".join(
        f"count(*) FILTER (WHERE NOT coalesce({condition}, FALSE)) AS failed_{name}"
        for name, condition in rules)
    return f"""count(*) AS input_rows, count(*) FILTER (WHERE {valid}) AS valid_rows,
      count(*) FILTER (WHERE NOT {valid}) AS rejected_rows, {failed}"""


def _rows(name: str, table: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {table}"


def _first_failed(rules: tuple[tuple[str, str], ...]) -> str:
    return "CASE " + " ".join(f"WHEN NOT coalesce({condition}, FALSE) THEN '{name}'" for name, condition in rules) + " END"


_FIRST_FAILED = _first_failed(_ORDER_RULES)

_SILVER_SCHEMA = (
    ("order_id", "string"), ("customer_id", "string"), ("product_id", "string"), ("quantity", "int"),
    ("unit_price", "double"), ("status", "string"), ("order_date", "date"),
    ("total_amount", "decimal(28,6)"), ("_silver_updated_at", "timestamp"),
)

_STATUS_REPORT = f"""SELECT status, count(*) AS order_count,
  {_millions('sum(total_amount)', 2)} AS revenue_millions FROM {{table}} GROUP BY status"""

_EVENT_TIME = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"


def _history_row(version: int, operation: str, inserted: str, updated: str, table: str) -> str:
    return f"""SELECT CAST({version} AS BIGINT) AS version, '{registry.COMMIT_TIMES[version]}' AS committed_at,
      '{operation}' AS operation, {inserted} AS rows_inserted, {updated} AS rows_updated FROM {table}"""


def _merged_batch(version: int) -> str:
    known = f"order_id IN (SELECT order_id FROM v{version - 1})"
    return _history_row(
        version, "MERGE", f"count(*) FILTER (WHERE NOT ({known}))", f"count(*) FILTER (WHERE {known})",
        f"batch_silver WHERE batch = {version}")


_NONE = "count(*) FILTER (WHERE FALSE)"
_HISTORY = " UNION ALL ".join((
    _history_row(registry.FIRST_LOAD, "WRITE", "count(*)", _NONE, "v0"),
    _merged_batch(registry.FIRST_MERGE),
    _merged_batch(registry.SECOND_MERGE),
    _history_row(registry.RESTORED, "RESTORE", _NONE, _NONE, "v0"),
    _history_row(registry.FULL_MERGE, "MERGE", "count(*) FILTER (WHERE NOT known)",
                 "count(*) FILTER (WHERE known)", "full_merge"),
    _history_row(registry.FULL_MERGE_AGAIN, "MERGE", _NONE, "count(*)", "full_merge"),
))


_AMOUNT = 'CAST(sum(CAST("value" AS DECIMAL(18,4))) AS DOUBLE)'


def _moment(time: str) -> str:
    return f"strftime({time}, '%Y-%m-%d %H:%M:%S.%f')"


def _windows(start: str, size: str, join: str = "") -> str:
    return f"""SELECT {_moment('starts')} AS window_start, {_moment(f'starts + {size}')} AS window_end, event_type,
        count(*) AS event_count, {_AMOUNT} AS amount
      FROM (SELECT {start} AS starts, event_type, "value" FROM events {join} WHERE ts IS NOT NULL)
      GROUP BY starts, event_type"""


def oracle_sql() -> dict[str, str]:
    slice_filter = f"order_year = {registry.SLICE_YEAR} AND order_month = {registry.SLICE_MONTH}"
    range_filter = f"order_date BETWEEN DATE '{registry.RANGE_FIRST}' AND DATE '{registry.RANGE_LAST}'"
    sql = {
        "bronze_orders": _with([_RAW_ORDERS],
            f"SELECT {_RAW_COLUMNS}, '{registry.SOURCE_LABEL}' AS _source_file FROM raw_orders"),
        "orders_typed": _with(_ORDERS, f"SELECT {_SILVER_COLUMNS}, ingested_at FROM typed"),
        "orders_valid": _with(_ORDERS, f"SELECT {_SILVER_COLUMNS}, ingested_at FROM valid"),
        "orders_rejects": _with(_ORDERS, f"""SELECT * FROM (
            SELECT {_SILVER_COLUMNS}, ingested_at, {_FIRST_FAILED} AS rejected_by FROM typed
          ) WHERE rejected_by IS NOT NULL"""),
        "quality_orders": _with(_ORDERS, f"""SELECT *, valid_rows - unique_rows AS duplicate_rows FROM (
            SELECT {_accounting(_ORDER_RULES)},
              count(DISTINCT order_id) FILTER (WHERE {_all(_ORDER_RULES)}) AS unique_rows
            FROM typed)"""),
        "quality_customers": _with([_CUSTOMERS], f"SELECT {_accounting(_CUSTOMER_RULES)} FROM cleaned"),
        "run_rejects_customers": _with([_CUSTOMERS], f"""SELECT * FROM (
            SELECT *, {_first_failed(_CUSTOMER_RULES)} AS rejected_by FROM cleaned) WHERE rejected_by IS NOT NULL"""),
        "orders_after_refreshes": _with(_REFRESHES, f"SELECT {_SILVER_COLUMNS} FROM refreshed"),
        "fact_after_refresh": _with(_REFRESHES, f"SELECT {_FACT_COLUMNS} FROM refreshed_fact"),
        "rejects_after_refreshes": _with(_ORDERS, f"""SELECT rejected_by, count(*) AS rejected_rows
          FROM (SELECT {_FIRST_FAILED} AS rejected_by FROM typed) WHERE rejected_by IS NOT NULL GROUP BY rejected_by"""),
        "silver_orders": _with(_SILVER_CHAIN, f"SELECT {_SILVER_COLUMNS} FROM silver"),
        "silver_customers": _with([_CUSTOMERS], "SELECT * FROM customers"),
        "fact_orders": _with(_FACT_CHAIN, f"SELECT {_FACT_COLUMNS} FROM fact"),
        "agg_revenue_daily": _with(_DAILY_CHAIN, """SELECT order_date, order_year, order_month, region,
            category, order_count, CAST(revenue AS DOUBLE) AS revenue, avg_order_value, units_sold,
            customer_count, high_value_orders FROM daily"""),
        "fact_orders_month_slice": _with(_FACT_CHAIN, f"SELECT {_FACT_COLUMNS} FROM fact WHERE {slice_filter}"),
        "fact_date_range": _with(_FACT_CHAIN, f"SELECT {_FACT_COLUMNS} FROM fact WHERE {range_filter}"),
        "fact_preview": _with(_FACT_CHAIN, """SELECT order_id, order_date, customer_name, region,
            product_name, category, CAST(total_amount AS DOUBLE) AS total_amount, is_high_value, status
          FROM fact ORDER BY order_id LIMIT 5"""),
        "bronze_preview": _with([_RAW_ORDERS], f"""SELECT {_RAW_COLUMNS} FROM raw_orders
          ORDER BY {', '.join(f'{name} ASC NULLS FIRST' for name in
                              ('order_id', 'ingested_at', *registry.BRONZE_PREVIEW_COLUMNS))}
          LIMIT {registry.PREVIEW_ROWS}"""),
        "fact_history": _with(_FACT_CHAIN, f"""SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation,
            count(*) AS rows_inserted, {_NONE} AS rows_updated FROM fact"""),
        "version_preview": _with(_VERSIONS, f"""SELECT order_id, status,
            CAST(total_amount AS DOUBLE) AS total_amount, order_date
          FROM v0 ORDER BY order_id LIMIT {registry.VERSION_PREVIEW_ROWS}"""),
        "profile_nulls": _with([_RAW_ORDERS], " UNION ALL ".join(
            f"SELECT '{name}' AS column_name, count(*) - count({name}) AS null_count FROM raw_orders"
            for name in registry.NULL_PROFILE_COLUMNS)),
        "profile_duplicates": _with([_RAW_ORDERS], f"""SELECT *,
            {_percent('duplicate_rows', 'total_rows')} AS duplicate_percent
          FROM (SELECT *, total_rows - unique_keys AS duplicate_rows FROM (
            SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT order_id FROM raw_orders))
              AS unique_keys FROM raw_orders))"""),
        "profile_top_duplicates": _with([_RAW_ORDERS], """SELECT order_id, count(*) AS copies
          FROM raw_orders GROUP BY order_id HAVING count(*) > 1
          ORDER BY copies DESC, order_id ASC NULLS FIRST LIMIT 5"""),
        "check_unique_key": _with(_SILVER_CHAIN, """SELECT count(*) AS repeated_keys, count(*) = 0 AS passed
          FROM (SELECT order_id FROM silver GROUP BY order_id HAVING count(*) > 1)"""),
        "describe_schema": _with(_SILVER_CHAIN, " UNION ALL ".join(
            f"SELECT CAST({position} AS INTEGER) AS position, '{name}' AS column_name, '{kind}' AS data_type, "
            f"count({'*' if name.startswith('_') else name}) AS filled_rows FROM silver"
            for position, (name, kind) in enumerate(_SILVER_SCHEMA, start=1))),
        "compare_bronze_silver": _with(_SILVER_CHAIN, f"""SELECT *,
            {_percent('rows_removed', 'rows_before')} AS removed_percent
          FROM (SELECT *, rows_before - rows_after AS rows_removed FROM (
            SELECT (SELECT count(*) FROM raw_orders) AS rows_before,
                   (SELECT count(*) FROM silver) AS rows_after))"""),
        "layer_counts": _with(_DAILY_CHAIN, " UNION ALL ".join((
            _rows("bronze_orders", "raw_orders"), _rows("silver_orders", "silver"),
            _rows("silver_customers", "customers"), _rows("fact_orders", "fact"),
            _rows("agg_revenue_daily", "daily")))),
        "layer_summary": _with(_DAILY_CHAIN, f"""SELECT *, bronze_orders - silver_orders AS orders_removed
          FROM (SELECT (SELECT count(*) FROM raw_orders) AS bronze_orders,
            (SELECT count(*) FROM silver) AS silver_orders,
            (SELECT count(*) FROM customers) AS silver_customers,
            (SELECT count(*) FROM fact) AS fact_orders,
            count(*) AS agg_revenue_daily, {_millions('sum(revenue)', 2)} AS revenue_millions FROM daily)"""),

        "merge_change_set": _with(_VERSIONS, f"""SELECT order_id,
            coalesce(v0.customer_id, b.customer_id) AS customer_id,
            coalesce(v0.product_id, b.product_id) AS product_id,
            b.quantity, CAST(b.unit_price AS DOUBLE) AS unit_price, b.status, b.order_date,
            CAST(b.total_amount AS DOUBLE) AS total_amount,
            CASE WHEN v0.customer_id IS NULL THEN 'I' ELSE 'U' END AS _op
          FROM batch_silver b LEFT JOIN v0 USING (order_id) WHERE batch = 1"""),
        "orders_after_deletes": _with(_VERSIONS, f"""SELECT {_SILVER_COLUMNS} FROM v1 WHERE status <> 'cancelled'
            OR order_id NOT IN (SELECT order_id FROM batch_silver WHERE batch = 1)"""),
        "orders_after_undelete": _with(_VERSIONS, f"""SELECT {_SILVER_COLUMNS}, {registry.UNDELETED} AS version FROM v0
            UNION ALL SELECT {_SILVER_COLUMNS}, {registry.MERGED} AS version FROM v1"""),
        "orders_deleted": _with(_VERSIONS, """SELECT order_id, v0.status FROM v0 JOIN batch_silver b USING (order_id)
            WHERE b.batch = 1 AND b.status = 'cancelled'"""),
        "orders_after_merge": _with(_VERSIONS, f"SELECT {_SILVER_COLUMNS} FROM v2"),
        "silver_orders_current": _with(_VERSIONS, f"SELECT {_SILVER_COLUMNS} FROM full_merge"),
        "orders_as_of_version": _with(_VERSIONS, f"SELECT {_SILVER_COLUMNS} FROM v0"),
        "orders_as_of_timestamp": _with(_VERSIONS, f"SELECT {_SILVER_COLUMNS} FROM v1"),
        "table_history": _with(_VERSIONS, _HISTORY),
        "table_history_sql": _with(_VERSIONS, f"SELECT version, operation FROM ({_HISTORY})"),
        "table_history_summary": _with(_VERSIONS, f"""SELECT count(*) AS version_count,
            max(version) AS latest_version FROM ({_HISTORY})"""),
        "compare_versions": _with(_VERSIONS, """SELECT *, rows_after - rows_before AS row_difference FROM (
            SELECT (SELECT count(*) FROM v0) AS rows_before, (SELECT count(*) FROM v2) AS rows_after)"""),
        "diff_new_rows": _with(_VERSIONS,
            f"SELECT {_SILVER_COLUMNS} FROM v1 WHERE order_id NOT IN (SELECT order_id FROM v0)"),
        "diff_changed_status": _with(_VERSIONS, """SELECT order_id, v0.status AS status_before,
            v1.status AS status_after FROM v0 JOIN v1 USING (order_id) WHERE v0.status <> v1.status"""),
        "orders_after_restore": _with(_VERSIONS, f"SELECT {_SILVER_COLUMNS} FROM v0"),
        "check_merge_idempotent": _with(_VERSIONS, """SELECT count(*) AS rows_before, count(*) AS rows_after,
            CAST(0 AS BIGINT) AS changed_rows, TRUE AS passed FROM full_merge"""),
        "schema_evolve_append": _with([_RAW_ORDERS], f"""SELECT {_RAW_COLUMNS},
            CASE WHEN batch = 1 THEN lower(trim(status)) END AS channel FROM raw_orders"""),
        "csv_bronze_orders": _with([_RAW_ORDERS], f"SELECT {_RAW_COLUMNS} FROM raw_orders"),
        "csv_source_files": _with([_RAW_ORDERS], "SELECT count(*) AS input_rows, count(*) AS rows_with_file FROM raw_orders"),
        "csv_products": """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS category,
            CAST(p_retailprice AS VARCHAR) AS price, CAST(p_size AS VARCHAR) AS stock FROM part""",
        "audit_times": _with(_DAILY_CHAIN, " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count, count(*) AS timed_rows, "
            f"least(count(*), 1) AS times FROM {table}"
            for name, table in (("bronze_orders", "raw_orders"), ("silver_orders", "silver"), ("silver_customers", "customers"),
                                ("fact_orders", "fact"), ("agg_revenue_daily", "daily")))),

        "events_stream_ingest": f"""SELECT CAST(event_id AS VARCHAR) AS event_id,
            CAST(NULL AS VARCHAR) AS session_id, CAST(user_id AS VARCHAR) AS customer_id, event_type,
            CAST(NULL AS VARCHAR) AS product_id, "value" AS amount, {_EVENT_TIME} AS event_time, 'clickstream_stream' AS _source FROM events""",
        "events_stream_restart": """SELECT event_type, count(*) AS event_count,
            count(DISTINCT event_id) AS distinct_events FROM events GROUP BY event_type""",
        "events_stream_progress": f"""SELECT count(*) AS input_rows FROM events
          GROUP BY coalesce(ts >= TIMESTAMP '{registry.SECOND_ARRIVAL_FROM}', false)""",
        "events_stream_dedup": f"""SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS customer_id,
            event_type, "value" AS amount, {_EVENT_TIME} AS event_time FROM events WHERE event_id IS NOT NULL AND ts IS NOT NULL""",
        "events_upserted": f"""SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS customer_id, event_type,
            CASE WHEN event_type = 'view' THEN 0 ELSE "value" END AS amount,
            CASE WHEN event_type = 'view' THEN {_EVENT_TIME.replace("ts", "ts - INTERVAL 1 DAY", 1)} ELSE {_EVENT_TIME} END AS event_time
            FROM events WHERE event_id IS NOT NULL AND ts IS NOT NULL""",
        "events_tumbling": _windows("time_bucket(INTERVAL '6 hours', ts)", "INTERVAL '6 hours'"),
        "events_sliding": _windows("time_bucket(INTERVAL '12 hours', ts) - s.back", "INTERVAL '1 day'",
                                   "CROSS JOIN (VALUES (INTERVAL '0 hours'), (INTERVAL '12 hours')) s(back)"),
        "events_sessions": f"""WITH ahead AS (
            SELECT *, coalesce(ts > lag(ts) OVER w + INTERVAL '8 hours', TRUE)::INTEGER AS starts FROM events
            WHERE ts IS NOT NULL AND user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)
          ), numbered AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM ahead)
          SELECT {_moment('min(ts)')} AS window_start, {_moment("max(ts) + INTERVAL '8 hours'")} AS window_end,
            CAST(user_id AS VARCHAR) AS customer_id, count(*) AS event_count, {_AMOUNT} AS amount
          FROM numbered GROUP BY user_id, session""",
        "events_asof": f"""SELECT CAST(p.event_id AS VARCHAR) AS event_id, CAST(p.user_id AS VARCHAR) AS customer_id,
            p."value" AS amount, CAST(v.event_id AS VARCHAR) AS view_id, v.event_time AS viewed_at
          FROM (SELECT * FROM events WHERE event_type = 'purchase') p
          ASOF LEFT JOIN (SELECT *, {_EVENT_TIME} AS event_time FROM events WHERE event_type = 'view') v
            ON p.user_id = v.user_id AND p.ts >= v.ts""",
        "report_subtotals": _with(_DAILY_CHAIN, """SELECT "month", region, category,
            CAST(grouping_id("month", region, category) AS INTEGER) AS level, CAST(sum(order_count) AS BIGINT) AS order_count,
            CAST(sum(revenue) AS DOUBLE) AS revenue
          FROM (SELECT *, strftime(order_date, '%Y-%m') AS "month" FROM daily) GROUP BY CUBE ("month", region, category)"""),
        "report_moving_revenue": _with(_DAILY_CHAIN, """SELECT region, order_date, CAST(revenue AS DOUBLE) AS revenue,
            CAST(sum(revenue) OVER w AS DOUBLE) AS moving_revenue, count(*) OVER w AS days_with_orders,
            CAST(revenue - lag(revenue) OVER d AS DOUBLE) AS change,
            CAST(order_date - lag(order_date) OVER d AS INTEGER) AS days_since
          FROM (SELECT region, order_date, sum(revenue) AS revenue FROM daily GROUP BY region, order_date)
          WINDOW d AS (PARTITION BY region ORDER BY order_date),
            w AS (PARTITION BY region ORDER BY order_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)"""),
        "report_customers_by_month": _with(_FACT_CHAIN, """SELECT strftime(order_date, '%Y-%m') AS "month",
            count(DISTINCT customer_id) AS customer_count, TRUE AS close,
            count(DISTINCT (order_date, coalesce(region, ''), customer_id)) AS summed_counts
          FROM fact WHERE status <> 'cancelled' GROUP BY 1"""),

        "report_status": _with(_FACT_CHAIN, _STATUS_REPORT.format(table="fact")),
        "report_status_silver": _with(_SILVER_CHAIN, _STATUS_REPORT.format(table="silver")),
        "report_monthly_trend": _with(_SILVER_CHAIN, f"""SELECT strftime(order_date, '%Y-%m') AS "month",
            count(*) AS order_count, {_millions('sum(total_amount)', 1)} AS revenue_millions
          FROM silver GROUP BY 1"""),
        "report_high_value": _with(_FACT_CHAIN, f"""SELECT
            CASE WHEN is_high_value THEN 'High Value' ELSE 'Normal' END AS label,
            count(*) AS order_count, {_millions('sum(total_amount)', 1)} AS revenue_millions,
            {_thousands('CAST(sum(total_amount) AS DOUBLE) / count(total_amount)')} AS avg_thousands
          FROM fact GROUP BY is_high_value"""),
        "report_customers_by_region": _with([_CUSTOMERS],
            "SELECT region, count(*) AS customer_count FROM customers GROUP BY region"),
        "report_top_days": _with(_DAILY_CHAIN, f"""SELECT order_date,
            {_millions('sum(revenue)', 2)} AS revenue_millions
          FROM daily GROUP BY order_date ORDER BY sum(revenue) DESC, order_date LIMIT 5"""),
        "report_region": _with(_DAILY_CHAIN, f"""SELECT region,
            {_millions('sum(revenue)', 2)} AS revenue_millions,
            CAST(sum(order_count) AS BIGINT) AS order_count FROM daily GROUP BY region"""),
        "report_category": _with(_DAILY_CHAIN, f"""SELECT category, CAST(sum(revenue) AS DOUBLE) AS revenue,
            {_millions('sum(revenue)', 2)} AS revenue_millions FROM daily GROUP BY category"""),
        "report_region_avg": _with(_DAILY_CHAIN, f"""SELECT region,
            CAST(sum(order_count) AS BIGINT) AS order_count,
            {_millions('sum(revenue)', 1)} AS revenue_millions,
            {_thousands('avg(avg_order_value)')} AS avg_of_daily_avg_thousands,
            {_thousands('CAST(sum(revenue) AS DOUBLE) / CAST(sum(order_count) AS BIGINT)')}
              AS avg_order_thousands
          FROM daily GROUP BY region"""),
        "report_category_units": _with(_DAILY_CHAIN, f"""SELECT category,
            CAST(sum(order_count) AS BIGINT) AS order_count,
            {_millions('sum(revenue)', 1)} AS revenue_millions,
            CAST(sum(units_sold) AS BIGINT) AS units_sold FROM daily GROUP BY category"""),
        "report_region_share": _with(_DAILY_CHAIN, f"""SELECT region, order_count,
            {_percent('order_count', 'CAST(sum(order_count) OVER () AS BIGINT)')} AS share_percent
          FROM (SELECT region, CAST(sum(order_count) AS BIGINT) AS order_count FROM daily GROUP BY region)"""),
        "report_total_revenue": _with(_DAILY_CHAIN, f"""SELECT CAST(sum(revenue) AS DOUBLE) AS revenue,
            {_millions('sum(revenue)', 2)} AS revenue_millions FROM daily"""),
    }
    # What a run stores, and what it makes of CSV files, are the same rows.
    same = {"run_accounting": "quality_orders", "run_accounting_customers": "quality_customers", "run_rejects": "orders_rejects",
            "csv_silver_orders": "silver_orders", "csv_fact_orders": "fact_orders",
            "csv_silver_customers": "silver_customers", "schema_overwrite": "orders_valid"}
    return sql | {name: sql[other] for name, other in same.items()}
