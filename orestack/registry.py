"""Every query by name, over the star-schema test tables of a folder.

The layers and their building blocks are planned straight from the raw tables. Reports and profiles
read the tables of a lake, as their users do; the lake of a folder is written once per session.
"""

from __future__ import annotations

import datetime
import functools
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orestack import settings
from orestack.functions import rules
from orestack.operators import asof, profile, schema, versioned
from orestack.plans import bronze, checks, gold, pipeline, reports, silver
from orestack.sources import files, star_tables as star
from orestack.sources.workspace import new_folder
from orestack.streaming import events

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values.
SOURCE_LABEL = "lineitem"
COMMIT_TIMES = tuple(f"2024-01-0{day} 00:00:00" for day in range(1, 7))
AS_OF_TIME = "2024-01-02 12:00:00"
SLICE_YEAR, SLICE_MONTH = 1998, 3
RANGE_FIRST, RANGE_LAST = datetime.date(1997, 11, 15), datetime.date(1998, 2, 10)
SECOND_ARRIVAL_FROM = "2024-01-16"
REPEATED_FROM = "2024-01-15T12"
STREAM_END = "2124-01-01T00:00:00"
STREAM_FILES_PER_TRIGGER = 1000

PREVIEW_ROWS = 5
VERSION_PREVIEW_ROWS = 3
FACT_PREVIEW_COLUMNS = (
    "order_id", "order_date", "customer_name", "region", "product_name", "category",
    "total_amount", "is_high_value", "status")
VERSION_PREVIEW_COLUMNS = ("order_id", "status", "total_amount", "order_date")
BRONZE_PREVIEW_COLUMNS = (
    "order_id", "customer_id", "product_id", "quantity", "unit_price", "status", "order_date", "ingested_at")
NULL_PROFILE_COLUMNS = (
    "order_id", "customer_id", "product_id", "quantity", "unit_price", "status", "order_date")
BUSINESS_COLUMNS = (
    "customer_id", "product_id", "quantity", "unit_price", "status", "order_date", "total_amount")

_AUDIT = ("_bronze_ingested_at", "_silver_updated_at", "_gold_created_at")


def comparable(df: DataFrame) -> DataFrame:
    """Without wall-clock columns, and with decimals as doubles, which every client reads alike."""
    return df.select(*(
        F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.DecimalType) else field.name
        for field in df.schema.fields if field.name not in _AUDIT
    ))


# -- tables written once per session ----------------------------------------------------------

_written: dict[tuple[str, str, str], Any] = {}


def _once(spark: SparkSession, folder: str, name: str, write: Callable[[str], Any]) -> Any:
    session = (spark.conf.get("spark.app.id"), folder, name)
    if session not in _written:
        _written[session] = write(new_folder(spark, name))
    return _written[session]


def forget() -> None:
    """Let the next queries write their tables again."""
    _written.clear()


def lake(spark: SparkSession, folder: str) -> pipeline.Lake:
    """The lake after one run over all raw rows."""
    return _once(spark, folder, "lake", lambda path: pipeline.run_pipeline(
        spark, star.raw_orders(spark, folder), star.raw_customers(spark, folder),
        star.raw_products(spark, folder), path, star.VALID_REGIONS, star.order_bytes(spark, folder)))


def _write_csv(rows: DataFrame, path: str) -> None:
    """CSV files with a header, with white space around cells as it is."""
    with settings.tidy(rows.sparkSession):
        rows.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def csv_lake(spark: SparkSession, folder: str) -> pipeline.Lake:
    """The lake of a run over CSV files with all raw rows."""
    def write(path: str) -> pipeline.Lake:
        raw = {"orders": star.raw_orders(spark, folder), "customers": star.raw_customers(spark, folder),
               "products": star.raw_products(spark, folder)}
        for name, rows in raw.items():
            _write_csv(rows, f"{path}/{name}.csv")
        return pipeline.run_from_csv(spark, *(f"{path}/{name}.csv" for name in raw), f"{path}/lake", star.VALID_REGIONS)

    return _once(spark, folder, "csv", write)


# Versions of the orders of the merged lake. The first three merge one arrival batch each.
FIRST_LOAD, FIRST_MERGE, SECOND_MERGE, RESTORED, FULL_MERGE, FULL_MERGE_AGAIN = range(6)


def merged_lake(spark: SparkSession, folder: str) -> pipeline.Lake:
    """A lake whose orders arrived and were merged in three batches, then were restored to the first
    load, and then were merged twice from all of bronze."""
    return _once(spark, folder, "merged", lambda path: _merge_and_restore(spark, folder, path))


def _merge_and_restore(spark: SparkSession, folder: str, path: str) -> pipeline.Lake:
    target = pipeline.Lake(spark, path)
    for batch, committed_at in zip(star.raw_order_batches(spark, folder), COMMIT_TIMES):
        arrived = pipeline.ingest_orders(target, batch, SOURCE_LABEL, committed_at)
        new_rows = target.bronze_orders.changes(arrived).drop("_op")
        pipeline.refresh_silver_orders(target, new_rows, committed_at)
    target.silver_orders.restore(FIRST_LOAD, COMMIT_TIMES[RESTORED])
    for version in (FULL_MERGE, FULL_MERGE_AGAIN):
        pipeline.refresh_silver_orders(target, committed_at=COMMIT_TIMES[version], full=True)
    return target


def refreshed_lake(spark: SparkSession, folder: str) -> pipeline.Lake:
    """A lake whose orders arrive in three batches and are refreshed after each; the fact is built by month after the
    second and brought up to date after the third. Counts and rejects of the batches add up."""
    return _once(spark, folder, "refreshed", lambda path: _refresh_by_batch(spark, folder, path))


def _refresh_by_batch(spark: SparkSession, folder: str, path: str) -> pipeline.Lake:
    target, built = pipeline.Lake(spark, path), None
    products = star.raw_products(spark, folder)
    pipeline.refresh_silver_customers(target, star.raw_customers(spark, folder), star.VALID_REGIONS)
    for number, batch in enumerate(star.raw_order_batches(spark, folder)):
        pipeline.ingest_orders(target, batch, SOURCE_LABEL)
        version = pipeline.refresh_silver_orders(target)
        if number == 1:
            pipeline.refresh_fact_months(target, products)
            built = version
    pipeline.refresh_fact_months(target, products, since=built)
    return target


# -- layers -----------------------------------------------------------------------------------

def bronze_orders(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.with_audit(star.raw_orders(spark, folder), SOURCE_LABEL)


def orders_typed(spark: SparkSession, folder: str) -> DataFrame:
    return silver.type_orders(star.raw_orders(spark, folder))


def orders_valid(spark: SparkSession, folder: str) -> DataFrame:
    return rules.keep_valid(orders_typed(spark, folder), silver.order_rules())


def orders_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return rules.rejects(orders_typed(spark, folder), silver.order_rules())


def quality_orders(spark: SparkSession, folder: str) -> DataFrame:
    return rules.account(orders_typed(spark, folder), silver.order_rules(), key="order_id")


def quality_customers(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = silver.clean_customers(star.raw_customers(spark, folder))
    return rules.account(cleaned, silver.customer_rules(star.VALID_REGIONS))


def silver_orders(spark: SparkSession, folder: str) -> DataFrame:
    return silver.silver_orders(star.raw_orders(spark, folder))


def run_accounting(spark: SparkSession, folder: str) -> DataFrame:
    """The counts that the run itself stored."""
    return lake(spark, folder).order_counts.current()


def run_accounting_customers(spark: SparkSession, folder: str) -> DataFrame:
    """The counts of customers that the run itself stored."""
    return lake(spark, folder).customer_counts.current()


def run_rejects_customers(spark: SparkSession, folder: str) -> DataFrame:
    """The rejected customers that the run itself stored."""
    return lake(spark, folder).customer_rejects.current()


def run_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The rejected rows that the run itself stored."""
    rejected = lake(spark, folder).order_rejects.current()
    return rejected.drop("_bronze_ingested_at", "_source_file")


def csv_silver_orders(spark: SparkSession, folder: str) -> DataFrame:
    return csv_lake(spark, folder).silver_orders.current()


def csv_fact_orders(spark: SparkSession, folder: str) -> DataFrame:
    return csv_lake(spark, folder).fact_orders.current()


def csv_bronze_orders(spark: SparkSession, folder: str) -> DataFrame:
    return csv_lake(spark, folder).bronze_orders.current().drop("_source_file")


def csv_source_files(spark: SparkSession, folder: str) -> DataFrame:
    """How many bronze rows name the file that they came from."""
    return csv_lake(spark, folder).bronze_orders.current().agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(F.col("_source_file").rlike(r"^part-.+\.csv$")).alias("rows_with_file"))


def csv_silver_customers(spark: SparkSession, folder: str) -> DataFrame:
    return csv_lake(spark, folder).silver_customers.current()


def csv_products(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{new_folder(spark, 'products')}/products.csv"
    _write_csv(star.raw_products(spark, folder), path)
    return files.read_products(spark, path)


def silver_customers(spark: SparkSession, folder: str) -> DataFrame:
    return silver.silver_customers(star.raw_customers(spark, folder), star.VALID_REGIONS)


def fact_orders(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fact_orders(
        silver_orders(spark, folder), silver_customers(spark, folder), star.raw_products(spark, folder))


def agg_revenue_daily(spark: SparkSession, folder: str) -> DataFrame:
    return gold.agg_revenue_daily(fact_orders(spark, folder))


def orders_after_refreshes(spark: SparkSession, folder: str) -> DataFrame:
    return refreshed_lake(spark, folder).silver_orders.current()


def fact_after_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The fact of which only the months of the last batch were written again."""
    return refreshed_lake(spark, folder).fact_months.current()


def rejects_after_refreshes(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected rows per rule, over the batches."""
    return refreshed_lake(spark, folder).order_rejects.current().groupBy("rejected_by").agg(F.count(F.lit(1)).alias("rejected_rows"))


# -- slices of the partitioned fact -------------------------------------------------------------

def fact_orders_month_slice(spark: SparkSession, folder: str) -> DataFrame:
    return lake(spark, folder).fact_orders.current().filter(
        (F.col("order_year") == SLICE_YEAR) & (F.col("order_month") == SLICE_MONTH))


def fact_date_range(spark: SparkSession, folder: str) -> DataFrame:
    return lake(spark, folder).fact_orders.current().filter(gold.date_range_filter(RANGE_FIRST, RANGE_LAST))


def fact_preview(spark: SparkSession, folder: str) -> DataFrame:
    return reports.preview(
        lake(spark, folder).fact_orders.current(), FACT_PREVIEW_COLUMNS, ["order_id"], PREVIEW_ROWS)


def bronze_preview(spark: SparkSession, folder: str) -> DataFrame:
    return reports.preview(
        lake(spark, folder).bronze_orders.current(), BRONZE_PREVIEW_COLUMNS,
        ["order_id", "ingested_at", *BRONZE_PREVIEW_COLUMNS], PREVIEW_ROWS)


def fact_history(spark: SparkSession, folder: str) -> DataFrame:
    return lake(spark, folder).fact_orders.history().drop("committed_at")


# -- profiles and layer summaries ---------------------------------------------------------------

def profile_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return profile.null_counts(lake(spark, folder).bronze_orders.current(), NULL_PROFILE_COLUMNS)


def profile_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return profile.duplicates(lake(spark, folder).bronze_orders.current(), "order_id")


def profile_top_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return profile.most_repeated(lake(spark, folder).bronze_orders.current(), "order_id")


def check_unique_key(spark: SparkSession, folder: str) -> DataFrame:
    return profile.unique_key_check(lake(spark, folder).silver_orders.current(), "order_id")


def describe_schema(spark: SparkSession, folder: str) -> DataFrame:
    return schema.describe(lake(spark, folder).silver_orders.current())


def compare_bronze_silver(spark: SparkSession, folder: str) -> DataFrame:
    tables = lake(spark, folder)
    return profile.compare_counts(tables.bronze_orders.current(), tables.silver_orders.current())


def layer_counts(spark: SparkSession, folder: str) -> DataFrame:
    tables = lake(spark, folder)
    return profile.row_counts({
        "bronze_orders": tables.bronze_orders.current(),
        "silver_orders": tables.silver_orders.current(),
        "silver_customers": tables.silver_customers.current(),
        "fact_orders": tables.fact_orders.current(),
        "agg_revenue_daily": tables.agg_revenue_daily.current(),
    })


def layer_summary(spark: SparkSession, folder: str) -> DataFrame:
    tables = lake(spark, folder)
    return checks.layer_summary(
        tables.bronze_orders.current(), tables.silver_orders.current(), tables.silver_customers.current(),
        tables.fact_orders.current(), tables.agg_revenue_daily.current())


def audit_times(spark: SparkSession, folder: str) -> DataFrame:
    """Per table of a run its rows, those with an audit time, and the number of different times."""
    tables = lake(spark, folder)
    layers = {
        "bronze_orders": (tables.bronze_orders, "_bronze_ingested_at"),
        "silver_orders": (tables.silver_orders, "_silver_updated_at"),
        "silver_customers": (tables.silver_customers, "_silver_updated_at"),
        "fact_orders": (tables.fact_orders, "_gold_created_at"),
        "agg_revenue_daily": (tables.agg_revenue_daily, "_gold_created_at"),
    }
    return functools.reduce(DataFrame.unionByName, (
        table.current().agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                            F.count(time).alias("timed_rows"), F.count_distinct(time).alias("times"))
        for name, (table, time) in layers.items()))


# -- versions -----------------------------------------------------------------------------------

def _merged_orders(spark: SparkSession, folder: str) -> versioned.VersionedTable:
    return merged_lake(spark, folder).silver_orders


def merge_change_set(spark: SparkSession, folder: str) -> DataFrame:
    return _merged_orders(spark, folder).changes(FIRST_MERGE)


def orders_after_merge(spark: SparkSession, folder: str) -> DataFrame:
    return _merged_orders(spark, folder).as_of_version(SECOND_MERGE)


def orders_after_restore(spark: SparkSession, folder: str) -> DataFrame:
    return _merged_orders(spark, folder).as_of_version(RESTORED)


# Versions of the orders with deletes.
LOADED, DELETED, UNDELETED, MERGED = range(4)


def _orders_with_deletes(spark: SparkSession, folder: str) -> versioned.VersionedTable:
    """The first load of the orders; the second batch, of which cancelled orders are deleted; the first load restored;
    and the second batch again without deletes."""
    def write(path: str) -> versioned.VersionedTable:
        merged = _merged_orders(spark, folder)
        batch = merged.changes(FIRST_MERGE).drop("_op")
        table = versioned.VersionedTable(spark, path, key=["order_id"])
        table.merge(merged.as_of_version(FIRST_LOAD))
        table.merge(batch.withColumn("gone", F.col("status") == "cancelled"), deleted="gone")
        table.restore(LOADED)
        table.merge(batch)
        return table

    return _once(spark, folder, "deletes", write)


def orders_after_deletes(spark: SparkSession, folder: str) -> DataFrame:
    return _orders_with_deletes(spark, folder).as_of_version(DELETED)


def orders_after_undelete(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the restored and of the last version, told apart by ``version``."""
    table = _orders_with_deletes(spark, folder)
    return functools.reduce(DataFrame.unionByName, (
        table.as_of_version(version).withColumn("version", F.lit(version)) for version in (UNDELETED, MERGED)))


def orders_deleted(spark: SparkSession, folder: str) -> DataFrame:
    """The orders that the second version lacks of the first, by comparison of what was written in between."""
    before, after = _orders_with_deletes(spark, folder).differing(LOADED, DELETED)
    return versioned.added_rows(after, before, ["order_id"]).select("order_id", "status")


def silver_orders_current(spark: SparkSession, folder: str) -> DataFrame:
    return _merged_orders(spark, folder).current()


def orders_as_of_version(spark: SparkSession, folder: str) -> DataFrame:
    return _merged_orders(spark, folder).as_of_version(FIRST_LOAD)


def version_preview(spark: SparkSession, folder: str) -> DataFrame:
    return reports.preview(
        _merged_orders(spark, folder).as_of_version(FIRST_LOAD), VERSION_PREVIEW_COLUMNS, ["order_id"],
        VERSION_PREVIEW_ROWS)


def orders_as_of_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    return _merged_orders(spark, folder).as_of_timestamp(AS_OF_TIME)


def table_history(spark: SparkSession, folder: str) -> DataFrame:
    return _merged_orders(spark, folder).history().withColumn(
        "committed_at", F.date_format("committed_at", "yyyy-MM-dd HH:mm:ss"))


def table_history_sql(spark: SparkSession, folder: str) -> DataFrame:
    _merged_orders(spark, folder).history().createOrReplaceTempView("silver_orders_history")
    return spark.sql("SELECT version, operation FROM silver_orders_history ORDER BY version DESC")


def table_history_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _merged_orders(spark, folder).version_count()


def compare_versions(spark: SparkSession, folder: str) -> DataFrame:
    table = _merged_orders(spark, folder)
    return checks.compare_versions(table.as_of_version(FIRST_LOAD), table.current())


def diff_new_rows(spark: SparkSession, folder: str) -> DataFrame:
    before, after = _merged_orders(spark, folder).differing(FIRST_LOAD, FIRST_MERGE)
    return versioned.added_rows(before, after, ["order_id"])


def diff_changed_status(spark: SparkSession, folder: str) -> DataFrame:
    before, after = _merged_orders(spark, folder).differing(FIRST_LOAD, FIRST_MERGE)
    return versioned.changed_values(before, after, ["order_id"], "status")


def check_merge_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """All of bronze merged twice in a row."""
    table = _merged_orders(spark, folder)
    return checks.rerun_check(
        table.as_of_version(FULL_MERGE), table.as_of_version(FULL_MERGE_AGAIN), ["order_id"], BUSINESS_COLUMNS)


def schema_evolve_append(spark: SparkSession, folder: str) -> DataFrame:
    """A later batch brings a column that the table does not have yet."""
    first, second, third = star.raw_order_batches(spark, folder)
    table = versioned.VersionedTable(spark, new_folder(spark, "evolved"))
    table.append(first)
    table.append(second.withColumn("channel", F.lower(F.trim(F.col("status")))))
    table.append(third)
    return table.current()


def schema_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """The raw orders, replaced by typed ones: other columns, and other types of the same columns."""
    table = versioned.VersionedTable(spark, new_folder(spark, "replaced"))
    table.overwrite(star.raw_orders(spark, folder))
    table.overwrite(orders_valid(spark, folder))
    return table.current()


# -- streaming ----------------------------------------------------------------------------------

def _write_json(arrival: DataFrame, folder: str) -> None:
    arrival.write.mode("append").json(folder)


def events_stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    work = new_folder(spark, "events")
    _write_json(star.raw_events(spark, folder), f"{work}/in")
    events.ingest_events(spark, f"{work}/in", f"{work}/out", f"{work}/state", STREAM_FILES_PER_TRIGGER)
    return spark.read.parquet(f"{work}/out")


def _two_arrivals(spark: SparkSession, folder: str) -> str:
    """Two arrivals and three runs; the run in between finds nothing new. Returns the folder of the events."""
    work = new_folder(spark, "events")
    raw = star.raw_events(spark, folder)
    late = F.coalesce(F.col("event_time") >= SECOND_ARRIVAL_FROM, F.lit(False))

    def run() -> None:
        events.ingest_events(spark, f"{work}/in", f"{work}/out", f"{work}/state", STREAM_FILES_PER_TRIGGER)

    _write_json(raw.filter(~late), f"{work}/in")
    run()
    run()
    _write_json(raw.filter(late), f"{work}/in")
    run()
    return f"{work}/out"


def events_stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(_two_arrivals(spark, folder)).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("event_id").alias("distinct_events"),
    )


def events_stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    """Input rows of each micro-batch of the two arrivals."""
    return events.progress(spark, _two_arrivals(spark, folder)).filter("input_rows > 0").select("input_rows")


def _streamed(spark: SparkSession, folder: str, transform: Callable[[DataFrame], DataFrame], repeats: bool = False) -> DataFrame:
    """The output of a transformed stream: two arrivals, with ``repeats`` some events of the first again, and
    one last event that ends all windows."""
    work, raw = new_folder(spark, "events"), star.raw_events(spark, folder)
    late = F.coalesce(F.col("event_time") >= SECOND_ARRIVAL_FROM, F.lit(False))
    again = raw.filter(~late & (F.col("event_time") >= REPEATED_FROM)) if repeats else raw.limit(0)
    end = raw.limit(1).withColumns({"event_id": F.lit("end"), "event_time": F.lit(STREAM_END), "customer_id": F.lit("end"),
                                    "event_type": F.lit("end")})
    for arrival in (raw.filter(~late), raw.filter(late).union(again), end):
        _write_json(arrival, f"{work}/in")
        events.ingest_events(spark, f"{work}/in", f"{work}/out", f"{work}/state", STREAM_FILES_PER_TRIGGER, transform=transform)
    return spark.read.parquet(f"{work}/out")


def events_stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The events of which some arrive again after a restart, each once."""
    return _streamed(spark, folder, events.deduplicated, repeats=True).filter("event_id != 'end'").select(
        "event_id", "customer_id", "event_type", "amount", "event_time")


def events_upserted(spark: SparkSession, folder: str) -> DataFrame:
    """Provisional events a day early, then the final ones of all types but views, then the provisional ones again."""
    work, final = new_folder(spark, "events"), star.raw_events(spark, folder)
    early = F.date_format(F.col("event_time").cast("timestamp") - F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    provisional = final.withColumns({"event_time": early, "amount": F.lit(0.0)})
    table = versioned.VersionedTable(spark, f"{work}/silver", key=["event_id"])
    for arrival in (provisional, final.filter(~F.col("event_type").eqNullSafe("view")), provisional):
        _write_json(arrival, f"{work}/in")
        events.upsert_events(spark, f"{work}/in", table, f"{work}/state", STREAM_FILES_PER_TRIGGER)
    return table.current().select("event_id", "customer_id", "event_type", "amount", "event_time")


def events_tumbling(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(_streamed(spark, folder, lambda rows: events.windowed(rows, "6 hours")))


def events_sliding(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(_streamed(spark, folder, lambda rows: events.windowed(rows, "1 day", "12 hours")))


def events_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(_streamed(spark, folder, lambda rows: events.sessions(rows, "8 hours")))


def _shown(windows: DataFrame) -> DataFrame:
    return windows.withColumns({name: F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS") for name in ("window_start", "window_end")})


def events_asof(spark: SparkSession, folder: str) -> DataFrame:
    """For every purchase the latest view of its customer up to then."""
    raw = star.raw_events(spark, folder).withColumn("event_at", F.col("event_time").cast("timestamp"))
    views = raw.filter(F.col("event_type") == "view").withColumnsRenamed({"event_id": "view_id", "event_time": "viewed_at"})
    bought = raw.filter(F.col("event_type") == "purchase").select("event_id", "customer_id", "event_at", "amount")
    return asof.asof_join(bought, views, "customer_id", "event_at", ["view_id", "viewed_at"]).drop("event_at")


# -- reports ------------------------------------------------------------------------------------

def _on_daily(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(lake(spark, folder).agg_revenue_daily.current())


def _on_fact(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(lake(spark, folder).fact_orders.current())


def _on_silver(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(lake(spark, folder).silver_orders.current())


def _customers_by_region(spark: SparkSession, folder: str) -> DataFrame:
    return reports.customers_by_region(lake(spark, folder).silver_customers.current())


def report_customers_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """The exact customers per month, and whether the estimate from daily sketches is within two percent."""
    fact = lake(spark, folder).fact_orders.current()
    estimates = reports.monthly_customers(reports.customer_sketches(fact))
    exact = fact.filter(F.col("status") != "cancelled").groupBy(F.date_format("order_date", "yyyy-MM").alias("month")).agg(
        F.count_distinct("customer_id").alias("customer_count"))
    close = F.abs(F.col("customers") - F.col("customer_count")) <= F.col("customer_count") * 0.02
    return exact.join(estimates, "month").select("month", "customer_count", close.alias("close"), "summed_counts")


_LAYERS_AND_OPERATORS = (
    bronze_orders, orders_typed, orders_valid, orders_rejects, quality_orders, quality_customers,
    silver_orders, silver_customers, fact_orders, agg_revenue_daily,
    fact_orders_month_slice, fact_date_range, fact_preview, bronze_preview,
    fact_history, run_accounting, run_rejects, run_accounting_customers, run_rejects_customers,
    orders_after_refreshes, fact_after_refresh, rejects_after_refreshes, csv_silver_orders, csv_fact_orders,
    csv_bronze_orders, csv_source_files, csv_silver_customers, csv_products, audit_times,
    profile_nulls, profile_duplicates, profile_top_duplicates, check_unique_key, describe_schema,
    compare_bronze_silver, layer_counts, layer_summary,
    merge_change_set, orders_after_merge, orders_after_restore, orders_after_deletes, orders_after_undelete, orders_deleted, silver_orders_current,
    orders_as_of_version, version_preview, orders_as_of_timestamp, table_history, table_history_sql,
    table_history_summary, compare_versions, diff_new_rows, diff_changed_status,
    check_merge_idempotent, schema_evolve_append, schema_overwrite, events_stream_ingest, events_stream_restart,
    events_stream_progress, events_stream_dedup, events_upserted, events_tumbling, events_sliding, events_sessions, events_asof, report_customers_by_month,
)

_REPORTS: dict[str, Query] = {
    "report_status": _on_fact(reports.by_status),
    "report_status_silver": _on_silver(reports.by_status),
    "report_monthly_trend": _on_silver(reports.monthly_trend),
    "report_high_value": _on_fact(reports.high_value),
    "report_customers_by_region": _customers_by_region,
    "report_top_days": _on_daily(reports.top_days),
    "report_region": _on_daily(reports.by_region),
    "report_category": _on_daily(reports.by_category),
    "report_region_avg": _on_daily(reports.region_averages),
    "report_category_units": _on_daily(reports.category_units),
    "report_region_share": _on_daily(reports.region_share),
    "report_total_revenue": _on_daily(reports.total_revenue),
    "report_subtotals": _on_daily(reports.subtotals),
    "report_moving_revenue": _on_daily(reports.moving_revenue),
}


def queries() -> dict[str, Query]:
    named: dict[str, Query] = {query.__name__: query for query in _LAYERS_AND_OPERATORS} | _REPORTS

    def finished(query: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            settings.apply(spark, star.order_bytes(spark, folder))
            return comparable(query(spark, folder))
        return run

    return {name: finished(query) for name, query in named.items()}
