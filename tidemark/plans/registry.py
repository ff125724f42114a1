"""Driver queries: every operator over the driver's tables, whole tables each time.

Processing-time columns are dropped from results; they differ from run to run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import (
    epoch_ms_to_ts,
    first_event_time,
    millis_between,
    minute_floor,
    to_wall_clock,
)
from tidemark.operators import (
    COMMERCE_SUITE,
    MARKET_SUITE,
    bronze_behavior,
    bronze_changes,
    bronze_ticks,
    commerce_kpis,
    conservation,
    content_conservation,
    freshness,
    latest,
    latest_per_entity,
    long_metrics,
    market_kpis,
    order_events,
    rejected_rows,
    silver_behavior,
    table_counts,
    tick_bars,
)
from tidemark.operators.bronze import CHANGE_TABLES
from tidemark.operators.quality import Suite
from tidemark.operators.silver import entity_events
from tidemark.operators.serving import LATEST, RANK_ERROR, dashboard_rows
from tidemark.plans import catalog
from tidemark.plans.backfill import backfill, with_event_time
from tidemark.plans.driver_tables import ZONE, DriverTables, feed_rows, utc
from tidemark.plans.freshness import by_day as stored_days, measure
from tidemark.plans.lake import HASH_COLUMNS, Lake
from tidemark.plans.quality import check, history, record, run_checks
from tidemark.plans.together import together
from tidemark.session import scratch_dir
from tidemark.sources import (
    allow_listed,
    computed_columns,
    decode_json,
    hand_over,
    open_feed,
    query_batch,
    read_evolved,
    snapshot_rows,
    snapshot_then_changes,
    table_scan,
    unwrap,
)
from tidemark.streaming.accounts import account, totals
from tidemark.streaming.jobs import run_available

CHANGE_FEEDS = ("orders", "payments", "refunds")
STAMPS = {"orders": "created_at", "payments": "paid_at", "refunds": "refunded_at"}
QUALITY_LOOKBACK = "INTERVAL 400 DAY"

# Commits of the time-travel queries: events before each date, committed at each time.
COMMITS = (
    (date(1997, 1, 1), "2026-03-13 11:00:00 Asia/Seoul"),
    (date(1999, 1, 1), "2026-03-13 11:30:00 Asia/Seoul"),
    (None, "2026-03-13 12:30:00 Asia/Seoul"),
)
AS_OF = "2026-03-13 12:00:00 Asia/Seoul"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(name: str) -> Callable:
    def register(build: Callable[[DriverTables], DataFrame]) -> Callable:
        _QUERIES[name] = lambda spark, sf_dir: build(DriverTables(spark, sf_dir))
        return build
    return register


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _stored(df: DataFrame) -> DataFrame:
    return df.drop("ingest_time", "produced_at")


def _feeds(d: DriverTables) -> list[DataFrame]:
    return [d.feed(f) for f in CHANGE_FEEDS]


SLICE_DAYS = 90  # the driver's tables have a few rows a day over seven years


def _new_lake(d: DriverTables) -> Lake:
    return Lake(d.spark, scratch_dir(d.spark), ZONE, slice_days=SLICE_DAYS)


# -- sources -----------------------------------------------------------------

def _scan_changes(d: DriverTables, feed: str) -> DataFrame:
    return utc(open_feed(d.messages(feed), feed), STAMPS[feed], "updated_at", "event_time")


@_query("scan_orders_cdc")
def query_scan_orders_cdc(d: DriverTables) -> DataFrame:
    return _scan_changes(d, "orders")


@_query("scan_payments_cdc")
def query_scan_payments_cdc(d: DriverTables) -> DataFrame:
    return _scan_changes(d, "payments")


@_query("scan_refunds_cdc")
def query_scan_refunds_cdc(d: DriverTables) -> DataFrame:
    return _scan_changes(d, "refunds")


@_query("scan_behavior")
def query_scan_behavior(d: DriverTables) -> DataFrame:
    return utc(d.feed("behavior"), "event_time")


@_query("scan_ticks")
def query_scan_ticks(d: DriverTables) -> DataFrame:
    return utc(d.feed("ticks"), "event_ts")


@_query("json_tolerant_decode")
def query_json_tolerant_decode(d: DriverTables) -> DataFrame:
    """Order messages, some of them broken in each of the ways the decoder knows."""
    kind = F.pmod("key", F.lit(11))
    text = F.col("value")
    damaged = (
        F.when(kind == 0, F.substring(text, 1, 40))
        .when(kind == 1, "null")
        .when(kind == 2, "[]")
        .when(kind == 3, F.regexp_replace(text, '"total_amount":[0-9.]+', '"total_amount":"n/a"'))
        .when(kind == 4, "{}")
        .when(kind == 5, F.lit(None))
        .when(kind == 6, F.concat(F.lit("\n "), text))
        .otherwise(text)
    )
    return decode_json(d.messages("orders").withColumn("value", damaged),
                       schemas.feed_schema("orders"))


@_query("computed_columns")
def query_computed_columns(d: DriverTables) -> DataFrame:
    return utc(d.feed("orders"), "created_at", "updated_at", "event_time").select(
        "order_id", "created_at", "updated_at", "event_time")


@_query("cdc_unwrap")
def query_cdc_unwrap(d: DriverTables) -> DataFrame:
    """Change envelopes under table column names; every thirteenth key is a tombstone."""
    rows = d.rows("orders").withColumnsRenamed(
        {"created_at_ms": "created_at", "updated_at_ms": "updated_at"})
    layout = schemas.parse(
        "order_id BIGINT, user_id BIGINT, order_status STRING, total_amount DECIMAL(12,2), "
        "currency STRING, coupon_id STRING, created_at BIGINT, updated_at BIGINT")
    image = F.struct(*layout.names)
    deleted = F.col("__op") == "d"
    envelope = F.to_json(F.struct(
        F.when(deleted | (F.col("__op") == "u"), image).alias("before"),
        F.when(~deleted, image).alias("after"),
        F.col("__op").alias("op"),
        F.struct(F.lit("public").alias("schema"), F.lit("orders").alias("table"),
                 F.col("__source_ts_ms").alias("ts_ms")).alias("source"),
    ))
    messages = rows.select(F.when(F.pmod("order_id", F.lit(13)) != 0, envelope).alias("value"))
    return unwrap(messages, layout,
                  rename={"created_at": "created_at_ms", "updated_at": "updated_at_ms"})


@_query("snapshot_bootstrap")
def query_snapshot_bootstrap(d: DriverTables) -> DataFrame:
    """Orders of the first years as an initial snapshot, later ones as changes."""
    placed = F.col("o_orderdate") < F.lit(COMMITS[1][0])
    table = feed_rows(d.table("orders").where(placed), "orders").select(
        "order_id", "user_id", "order_status", "total_amount", "currency", "coupon_id",
        epoch_ms_to_ts("created_at_ms").alias("created_at"),
        epoch_ms_to_ts("updated_at_ms").alias("updated_at"))
    changes = feed_rows(d.table("orders").where(~placed), "orders")
    return snapshot_then_changes(snapshot_rows(table, "orders"), changes)


# The snapshot of the handover is read in chunks by key, a day after the other from this one on;
# the log begins before it.
SNAPSHOT_DAY, SNAPSHOT_CHUNKS, LOG_DAY = date(1997, 1, 1), 60, date(1996, 11, 1)
UPDATED_AFTER, DELETED_AFTER = 20, 40  # days


@_query("snapshot_handover")
def query_snapshot_handover(d: DriverTables) -> DataFrame:
    """A snapshot read in chunks while orders are created, updated and deleted, and their log."""
    orders = feed_rows(d.table("orders"), "orders")
    key, day = F.col("order_id"), F.lit(86_400_000).cast("bigint")
    placed = F.col("created_at_ms")

    def changes(op: str, days: int, part: Column) -> DataFrame:
        return orders.where(part).select(
            "order_id", "total_amount", F.lit(op).alias("__op"),
            (placed + days * day).alias("position"))

    begun = F.unix_millis(F.lit(SNAPSHOT_DAY).cast("timestamp"))
    read_at = begun + F.pmod(key, F.lit(SNAPSHOT_CHUNKS)) * day
    deleted = F.pmod(key, F.lit(5)) == 0
    log = (changes("c", 0, F.lit(True))
           .unionAll(changes("u", UPDATED_AFTER, F.pmod(key, F.lit(3)) == 0))
           .unionAll(changes("d", DELETED_AFTER, deleted)))
    present = (placed <= read_at) & ~(deleted & (placed + DELETED_AFTER * day <= read_at))
    snapshot = orders.where(present).select(
        "order_id", "total_amount", F.lit("r").alias("__op"), read_at.alias("position"))
    kept = log.where(F.col("position") >= F.unix_millis(F.lit(LOG_DAY).cast("timestamp")))
    return hand_over(snapshot, kept, "order_id", "position", begun)


@_query("cdc_route")
def query_cdc_route(d: DriverTables) -> DataFrame:
    """A mixed change log; lines of shipments come from a table that is not captured."""
    def tagged(df: DataFrame, table: str, key: str, op: Column) -> DataFrame:
        return df.select(F.lit("public").alias("__schema"), F.lit(table).alias("__table"),
                         F.col(key).alias("entity_id"), op.alias("__op"))

    orders, payments, refunds = [d.rows(f) for f in CHANGE_FEEDS]
    log = (
        tagged(orders, "orders", "order_id", F.col("__op"))
        .unionByName(tagged(payments, "payments", "payment_id", F.col("__op")))
        .unionByName(tagged(refunds, "refunds", "refund_id", F.col("__op")))
        .unionByName(tagged(d.table("lineitem"), "shipments", "l_orderkey", F.lit("c")))
    )
    return allow_listed(log).select("topic", "entity_id", "__op")


@_query("table_scan")
def query_table_scan(d: DriverTables) -> DataFrame:
    layout = schemas.parse("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, "
                           "event_type STRING, value DOUBLE, props STRING")
    return table_scan(d.spark, d.path("events"), layout)


@_query("query_as_dataset")
def query_query_as_dataset(d: DriverTables) -> DataFrame:
    return query_batch(
        d.spark,
        "SELECT window_start, metric_name, metric_value FROM {kpis} WHERE metric_value >= 100000",
        kpis=commerce_kpis(*_feeds(d), ZONE))


# -- layers ------------------------------------------------------------------

@_query("bronze_orders")
def query_bronze_orders(d: DriverTables) -> DataFrame:
    return _stored(bronze_changes(d.feed("orders"), "orders", ZONE))


@_query("bronze_payments")
def query_bronze_payments(d: DriverTables) -> DataFrame:
    return _stored(bronze_changes(d.feed("payments"), "payments", ZONE))


@_query("bronze_refunds")
def query_bronze_refunds(d: DriverTables) -> DataFrame:
    return _stored(bronze_changes(d.feed("refunds"), "refunds", ZONE))


@_query("bronze_ticks")
def query_bronze_ticks(d: DriverTables) -> DataFrame:
    return _stored(bronze_ticks(d.feed("ticks"), ZONE))


@_query("bronze_behavior")
def query_bronze_behavior(d: DriverTables) -> DataFrame:
    return _stored(bronze_behavior(d.feed("behavior"), ZONE))


@_query("silver_order_events")
def query_silver_order_events(d: DriverTables) -> DataFrame:
    return _stored(order_events(*_feeds(d), ZONE))


@_query("silver_ticks_1s")
def query_silver_ticks_1s(d: DriverTables) -> DataFrame:
    return _stored(tick_bars(d.feed("ticks"), ZONE))


@_query("hashed_writes")
def query_hashed_writes(d: DriverTables) -> DataFrame:
    """Raw tables hashed over files: rows of one key are in one file, whatever task read them."""
    lake = replace(_new_lake(d), files_per_batch=8)
    raw = {
        **{CHANGE_TABLES[f][0]: lambda f=f: bronze_changes(d.feed(f), f, ZONE)
           for f in CHANGE_FEEDS},
        "bronze.crypto_ticks": lambda: bronze_ticks(d.feed("ticks"), ZONE),
        "bronze.user_behavior_events": lambda: bronze_behavior(d.feed("behavior"), ZONE),
    }
    together(d.spark, *[
        lambda t=t, f=f: lake.append(f(), t, "load", 0) for t, f in raw.items()])

    def counted(table: str) -> DataFrame:
        # A file's name as a 64-bit hash: an aggregate of text would sort all rows. Keys are as
        # good as unique, so tasks combine nothing before the shuffle.
        columns = HASH_COLUMNS[table]
        rows = lake.read(table).select(*columns, F.xxhash64(F.input_file_name()).alias("file"))
        keys = rows.repartition(*columns).groupBy(*columns).agg(
            F.count("*").alias("n"), (F.min("file") == F.max("file")).alias("together"))
        return keys.agg(F.sum("n").alias("row_count"), F.every("together").alias("one_file_a_key")
                        ).select(F.lit(table).alias("table_name"), "*")

    return reduce(lambda a, b: a.unionByName(b), map(counted, raw))


@_query("processing_time")
def query_processing_time(d: DriverTables) -> DataFrame:
    """Stored receipt times: one per batch, and of this hour."""
    lake = _new_lake(d)
    lake.append(bronze_ticks(d.feed("ticks"), ZONE), "bronze.crypto_ticks", "load", 0)
    age = millis_between(F.col("ingest_time"), to_wall_clock(F.current_timestamp(), ZONE))
    return lake.read("bronze.crypto_ticks").agg(
        F.count("ingest_time").alias("stamped_rows"),
        F.countDistinct("ingest_time").alias("stamps"),
        F.every(age.between(0, 3_600_000)).alias("of_this_hour"))


@_query("minute_floor")
def query_minute_floor(d: DriverTables) -> DataFrame:
    return utc(d.feed("ticks").select("tick_id", minute_floor(F.col("event_ts")).alias("minute")),
               "minute")


@_query("silver_behavior")
def query_silver_behavior(d: DriverTables) -> DataFrame:
    return _stored(silver_behavior(bronze_behavior(d.feed("behavior"), ZONE)))


@_query("gold_commerce")
def query_gold_commerce(d: DriverTables) -> DataFrame:
    return _stored(commerce_kpis(*_feeds(d), ZONE))


@_query("gold_market")
def query_gold_market(d: DriverTables) -> DataFrame:
    return _stored(market_kpis(d.feed("ticks"), ZONE))


# The shipped feed has DOUBLE prices. Sums depend on the order of rows in their last digits,
# so these results are rounded to eight places.

def _double_ticks(d: DriverTables) -> DataFrame:
    rows = d.rows("ticks").withColumns(
        {c: F.col(c).cast("double") for c in ("price", "volume")})
    return computed_columns(rows, "ticks")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("decimal(25,8)")
                           for c, kind in df.dtypes if kind == "double"})


@_query("silver_ticks_1s_double")
def query_silver_ticks_1s_double(d: DriverTables) -> DataFrame:
    return _rounded(_stored(tick_bars(_double_ticks(d), ZONE)))


@_query("gold_market_double")
def query_gold_market_double(d: DriverTables) -> DataFrame:
    return _rounded(_stored(market_kpis(_double_ticks(d), ZONE)))


@_query("gold_commerce_seoul")
def query_gold_commerce_seoul(d: DriverTables) -> DataFrame:
    return _stored(commerce_kpis(*_feeds(d), schemas.LOCAL_ZONE))


@_query("kpi_unpivot")
def query_kpi_unpivot(d: DriverTables) -> DataFrame:
    bars = tick_bars(d.feed("ticks"), ZONE)
    return long_metrics(bars, ["window_start", "symbol", "exchange"],
                        ["tick_count", "traded_volume", "min_price", "sell_tick_count"])


@_query("filter_created")
def query_filter_created(d: DriverTables) -> DataFrame:
    rows = d.feed("orders").where(F.col("__op") == "c")
    return rows.select("order_id", "user_id", "total_amount")


@_query("filter_succeeded")
def query_filter_succeeded(d: DriverTables) -> DataFrame:
    rows = d.feed("payments").where(F.col("payment_status") == "SUCCEEDED")
    return rows.select("payment_id", "user_id", "amount")


# -- scalar functions --------------------------------------------------------

@_query("epoch_to_ts")
def query_epoch_to_ts(d: DriverTables) -> DataFrame:
    at = to_wall_clock(epoch_ms_to_ts("event_time"), ZONE)
    return d.rows("ticks").select("tick_id", at.alias("event_ts"))


@_query("event_time_coalesce")
def query_event_time_coalesce(d: DriverTables) -> DataFrame:
    at = first_event_time("__source_ts_ms", "updated_at_ms", "refunded_at_ms")
    return d.rows("refunds").select("refund_id", to_wall_clock(at, ZONE).alias("event_time"))


@_query("ltz_to_ntz")
def query_ltz_to_ntz(d: DriverTables) -> DataFrame:
    local = to_wall_clock(F.col("event_time"), schemas.LOCAL_ZONE)
    return d.feed("behavior").select("event_id", local.alias("local_time"))


# -- lake tables -------------------------------------------------------------

def _commerce_between(d: DriverTables, start: date | None, end: date | None) -> DataFrame:
    """Commerce KPIs of a range of days; the range reaches the file scans."""
    def sliced(table: str, column: str) -> DataFrame:
        df = d.table(table)
        if start is not None:
            df = df.where(F.col(column) >= F.lit(start).cast("timestamp_ntz"))
        if end is not None:
            df = df.where(F.col(column) < F.lit(end).cast("timestamp_ntz"))
        return df

    orders, lines = sliced("orders", "o_orderdate"), sliced("lineitem", "l_shipdate")
    return commerce_kpis(
        computed_columns(feed_rows(orders, "orders"), "orders"),
        computed_columns(feed_rows(orders, "payments"), "payments"),
        computed_columns(feed_rows(lines, "refunds"), "refunds"),
        ZONE)


def _committed_kpis(d: DriverTables) -> Lake:
    lake, start = _new_lake(d), None
    for batch_id, (end, committed_at) in enumerate(COMMITS):
        lake.append(_commerce_between(d, start, end), "gold.commerce_kpis_1m", "kpis", batch_id,
                    F.lit(committed_at), spread=True)
        start = end
    return lake


@_query("snapshots")
def query_snapshots(d: DriverTables) -> DataFrame:
    listed = _committed_kpis(d).snapshots("gold.commerce_kpis_1m")
    return listed.withColumn("committed_at", to_wall_clock(F.col("committed_at"), ZONE))


@_query("time_travel")
def query_time_travel(d: DriverTables) -> DataFrame:
    table = "gold.commerce_kpis_1m"
    lake = _committed_kpis(d)
    return _stored(latest(lake.newest(table, LATEST[table][1], AS_OF), table))


@_query("time_travel_all_rows")
def query_time_travel_all_rows(d: DriverTables) -> DataFrame:
    return _stored(_committed_kpis(d).read("gold.commerce_kpis_1m", AS_OF))


@_query("create_tables")
def query_create_tables(d: DriverTables) -> DataFrame:
    """All tables created, filled by a backfill, and counted through SQL by another session.

    The views are those from before the commits. The databases are dropped again.
    """
    prefix = f"tm_{uuid.uuid4().hex[:12]}_"
    lake = _new_lake(d)
    catalog.create_tables(lake, prefix)
    try:
        backfill(lake, {f: d.feed(f) for f in (*CHANGE_FEEDS, "ticks", "behavior")}, "load")
        reader = d.spark.newSession()
        counts = table_counts({
            f"{layer}.{row['tableName']}": reader.table(f"{prefix}{layer}.{row['tableName']}")
            for layer in schemas.LAYERS
            for row in catalog.tables(reader, layer, prefix).collect()  # eleven names at most
        })
        path = scratch_dir(d.spark)
        counts.write.parquet(path)
    finally:
        catalog.drop(d.spark, prefix)
    return d.spark.read.schema(counts.schema).parquet(path)


@_query("catalog_listing")
def query_catalog_listing(d: DriverTables) -> DataFrame:
    """The tables of each layer, with the newest order of each kind of table beside them."""
    prefix = f"tm_{uuid.uuid4().hex[:12]}_"
    lake = _new_lake(d)
    catalog.create_tables(lake, prefix)
    lake.append(bronze_changes(d.feed("orders"), "orders", ZONE), "bronze.orders_cdc", "load", 0,
                spread=True)
    try:
        names = [(row["namespace"].removeprefix(prefix), row["tableName"])
                 for layer in schemas.LAYERS
                 for row in catalog.tables(d.spark, layer, prefix).collect()]
    finally:
        catalog.drop(d.spark, prefix)
    listed = d.spark.createDataFrame(names, "layer string, table_name string")
    stored = lake.read("bronze.orders_cdc").agg(F.count("*").alias("order_records"))
    return listed.withColumn("order_records", stored.scalar())


@_query("schema_evolution")
def query_schema_evolution(d: DriverTables) -> DataFrame:
    """Order files from before and after the coupon column was added, read as one table."""
    root, cut = scratch_dir(d.spark), F.lit(COMMITS[1][0])
    table = d.table("orders")
    old, new = (table.where(F.col("o_orderdate") < cut), table.where(F.col("o_orderdate") >= cut))
    feed_rows(old, "orders").drop("coupon_id").write.parquet(f"{root}/version=1")
    feed_rows(new, "orders").write.parquet(f"{root}/version=2")
    return read_evolved(d.spark, root, schemas.feed_schema("orders"))


# -- serving -----------------------------------------------------------------

# The layers of one run's tables, each written once per session and state of the input files, by
# the first query that reads it; the serving queries read stored tables, as dashboards do.
_LOADED: dict[tuple, Lake] = {}


def _state(d: DriverTables, name: str) -> tuple:
    """Number and mark of a table's files, by their names, sizes and times."""
    files = d.table(name).select("_metadata.file_path", "_metadata.file_size",
                                 "_metadata.file_modification_time").distinct()
    mark = F.xxhash64("file_path", "file_size", "file_modification_time").cast("decimal(38,0)")
    return tuple(files.agg(F.count("*"), F.sum(mark)).first())


def _layers(d: DriverTables) -> dict[str, Callable[[], DataFrame]]:
    return {
        **{CHANGE_TABLES[f][0]: lambda f=f: bronze_changes(d.feed(f), f, ZONE)
           for f in CHANGE_FEEDS},
        "bronze.crypto_ticks": lambda: bronze_ticks(d.feed("ticks"), ZONE),
        "silver.order_events": lambda: order_events(*_feeds(d), ZONE),
        "silver.crypto_ticks_1s": lambda: tick_bars(d.feed("ticks"), ZONE),
        "gold.commerce_kpis_1m": lambda: commerce_kpis(*_feeds(d), ZONE),
        "gold.crypto_market_kpis_1m": lambda: market_kpis(d.feed("ticks"), ZONE),
    }


def _loaded(d: DriverTables, *tables: str) -> Lake:
    """The lake that holds ``tables``; those that it lacks are written, and no others."""
    key = (d.spark.sparkContext.applicationId, d.sf_dir,
           *(_state(d, name) for name in ("orders", "lineitem")))
    if key not in _LOADED:
        _LOADED[key] = _new_lake(d)
    lake, layers = _LOADED[key], _layers(d)
    together(d.spark, *[
        lambda t=t: lake.append(layers[t](), t, "load", 0, spread=True)
        for t in tables if not lake.committed(t)])
    return lake


def _latest(d: DriverTables, table: str) -> DataFrame:
    return _stored(latest(_loaded(d, table).newest(table, LATEST[table][1]), table))


@_query("load_layers")
def query_load_layers(d: DriverTables) -> DataFrame:
    """The stored tables that the serving queries read, written anew."""
    for key in [k for k in _LOADED if k[1] == d.sf_dir]:
        del _LOADED[key]
    lake = _loaded(d, *_layers(d))
    return reduce(DataFrame.unionAll, [lake.snapshots(t).select(
        F.lit(t).alias("table_name"), F.col("added_records").alias("row_count"))
        for t in schemas.TABLE_DDL])


@_query("latest_ticks")
def query_latest_ticks(d: DriverTables) -> DataFrame:
    return _latest(d, "bronze.crypto_ticks")


@_query("latest_bars")
def query_latest_bars(d: DriverTables) -> DataFrame:
    return _latest(d, "silver.crypto_ticks_1s")


@_query("latest_market_kpis")
def query_latest_market_kpis(d: DriverTables) -> DataFrame:
    return _latest(d, "gold.crypto_market_kpis_1m")


@_query("latest_orders")
def query_latest_orders(d: DriverTables) -> DataFrame:
    return _latest(d, "bronze.orders_cdc")


@_query("latest_commerce_kpis")
def query_latest_commerce_kpis(d: DriverTables) -> DataFrame:
    return _latest(d, "gold.commerce_kpis_1m")


@_query("latest_behavior_kpis")
def query_latest_behavior_kpis(d: DriverTables) -> DataFrame:
    """Behaviour events are stored, and no metric is made of them."""
    lake = _new_lake(d)
    backfill(lake, {"behavior": d.feed("behavior")}, "load")
    table = "gold.behavior_kpis_1m"
    return _stored(latest(lake.newest(table, LATEST[table][1]), table))


@_query("dashboard_rows")
def query_dashboard_rows(d: DriverTables) -> DataFrame:
    return _stored(dashboard_rows(bronze_ticks(d.feed("ticks"), ZONE), "bronze.crypto_ticks"))


@_query("latest_entities")
def query_latest_entities(d: DriverTables) -> DataFrame:
    frames = [utc(d.feed(f), STAMPS[f]) for f in CHANGE_FEEDS]
    return latest_per_entity(*frames)


@_query("table_counts")
def query_table_counts(d: DriverTables) -> DataFrame:
    tables = _layers(d)
    lake = _loaded(d, *tables)
    return table_counts({table: lake.read(table) for table in tables})


def _produced_kpis(d: DriverTables) -> dict[str, Callable[[], DataFrame]]:
    """KPI rows by table, produced some seconds after their window, by their value."""
    def produced(kpis: DataFrame) -> DataFrame:
        wait = F.make_dt_interval(secs=F.pmod(F.floor("metric_value"), F.lit(9)))
        return kpis.withColumn("produced_at", F.col("window_end") + wait)

    return {
        "gold.commerce_kpis_1m": lambda: produced(commerce_kpis(*_feeds(d), ZONE)),
        "gold.crypto_market_kpis_1m": lambda: produced(market_kpis(d.feed("ticks"), ZONE)),
    }


@_query("freshness")
def query_freshness(d: DriverTables) -> DataFrame:
    """Freshness of stored rows."""
    lake, kpis = _new_lake(d), _produced_kpis(d)
    together(d.spark, *[
        lambda t=t, f=f: lake.append(f(), t, "kpis", 0, spread=True) for t, f in kpis.items()])
    return freshness({t: lake.read(t) for t in kpis})


@_query("freshness_by_day")
def query_freshness_by_day(d: DriverTables) -> DataFrame:
    """Days put together from sketches of two loads, and whether the percentile's rank among
    the day's rows is the one asked for."""
    lake, kpis = _new_lake(d), _produced_kpis(d)
    for load in (0, 1):
        part = F.pmod(F.dayofmonth("window_start"), F.lit(2)) == load
        together(d.spark, *[
            lambda t=t, f=f: lake.append(f().where(part), t, "kpis", load, spread=True)
            for t, f in kpis.items()])
        measure(lake, tuple(kpis))
    rows = reduce(lambda a, b: a.unionByName(b), [
        lake.read(t).select(
            F.lit(t).alias("table_name"), F.col("window_end").cast("date").alias("day"),
            millis_between(F.col("window_end"), F.col("produced_at")).alias("lag"))
        for t in kpis])
    keys = ["table_name", "day"]
    below, upto = (F.avg(F.when(holds, 1.0).otherwise(0.0)) for holds in (
        F.col("lag") < F.col("percentile_ms"), F.col("lag") <= F.col("percentile_ms")))
    days = stored_days(lake)
    ranks = rows.join(days.select(*keys, "percentile_ms"), keys).groupBy(*keys).agg(
        ((below <= 0.95 + RANK_ERROR) & (upto >= 0.95 - RANK_ERROR)).alias("p95_in_bounds"))
    return days.join(ranks, keys, "left").select(
        *keys, "measured_rows", "avg_lag_ms", "max_lag_ms", "rows_in_target", "p95_in_bounds")


# -- quality -----------------------------------------------------------------

def _damaged(kpis: DataFrame) -> DataFrame:
    """KPI rows with faults on some days of the month."""
    day = F.dayofmonth("window_start")
    faults = {
        "metric_name": F.when(day == 27, "unlisted").otherwise(F.col("metric_name")),
        "metric_value": F.when(day == 26, F.lit(None)).when(day == 25, -F.col("metric_value"))
        .otherwise(F.col("metric_value")),
        "window_start": F.when(day != 24, F.col("window_start")),
    }
    if "symbol" in kpis.columns:
        faults["symbol"] = F.when(day != 23, F.col("symbol"))
    return kpis.withColumns(faults)


COMMERCE_CHECK = replace(COMMERCE_SUITE, lookback=QUALITY_LOOKBACK)
MARKET_CHECK = replace(MARKET_SUITE, lookback=QUALITY_LOOKBACK)


def _stored_kpis(d: DriverTables, *suites: Suite) -> Lake:
    """The checked tables as stored rows, so that the rules filter in the file scan."""
    lake = _new_lake(d)
    kpis = {
        COMMERCE_CHECK: lambda: commerce_kpis(*_feeds(d), ZONE),
        MARKET_CHECK: lambda: market_kpis(d.feed("ticks"), ZONE),
    }
    together(d.spark, *[
        lambda s=s: lake.append(_damaged(kpis[s]()), s.table, "kpis", 0, spread=True)
        for s in suites])
    return lake


def _now(d: DriverTables) -> Column:
    """Newest event time of the order feed, as a scalar subquery."""
    return d.feed("orders").agg(F.max(to_wall_clock(F.col("event_time"), ZONE))).scalar()


def _checked(d: DriverTables, suite: Suite) -> DataFrame:
    return check(_stored_kpis(d, suite), suite, _now(d))


@_query("dq_commerce")
def query_dq_commerce(d: DriverTables) -> DataFrame:
    return _checked(d, COMMERCE_CHECK)


@_query("dq_market")
def query_dq_market(d: DriverTables) -> DataFrame:
    return _checked(d, MARKET_CHECK)


@_query("dq_checkpoint")
def query_dq_checkpoint(d: DriverTables) -> DataFrame:
    suites = (COMMERCE_CHECK, MARKET_CHECK)
    return run_checks(_stored_kpis(d, *suites), _now(d), suites)


@_query("dq_rejected")
def query_dq_rejected(d: DriverTables) -> DataFrame:
    lake = _stored_kpis(d, COMMERCE_CHECK, MARKET_CHECK)
    commerce, market = [
        rejected_rows(lake.read(s.table), s, _now(d), ZONE) for s in (COMMERCE_CHECK, MARKET_CHECK)]
    return commerce.unionByName(market)


@_query("dq_conservation")
def query_dq_conservation(d: DriverTables) -> DataFrame:
    """Stored tables of a whole backfill, and of one whose refunds got no further than bronze."""
    whole, broken = _new_lake(d), _new_lake(d)
    backfill(whole, {f: d.feed(f) for f in CHANGE_FEEDS}, "load")
    backfill(broken, {f: d.feed(f) for f in CHANGE_FEEDS[:2]}, "load")
    broken.append(bronze_changes(d.feed("refunds"), "refunds", ZONE), CHANGE_TABLES["refunds"][0],
                  "load", 0, spread=True)

    def checked(lake: Lake, name: str) -> DataFrame:
        tables = [lake.read(CHANGE_TABLES[f][0]) for f in CHANGE_FEEDS]
        found = conservation(tables, lake.read("silver.order_events"))
        return found.select(F.lit(name).alias("load"), "*")

    return checked(whole, "whole").unionByName(checked(broken, "broken"))


def _swapped(events: DataFrame) -> DataFrame:
    """Events whose first order of each 7th is lost and whose last one is there twice.

    Only orders of a 7th are joined, and on day and number: a join of all rows on the 7ths sends
    those of other days, which have none, to one task.
    """
    day, number = F.col("event_time").cast("date"), F.col("event_id").cast("bigint")
    on_7th = F.coalesce((F.col("entity_type") == "order") & (F.dayofmonth("event_time") == 7),
                        F.lit(False))
    orders = events.where(on_7th).withColumns({"event_day": day, "number": number})
    ends = orders.groupBy("event_day").agg(
        F.min("number").alias("first"), F.max("number").alias("last")).where("first < last")
    copies = ends.select("event_day", F.expr("stack(2, first, 0, last, 2) AS (number, copies)"))
    swapped = orders.join(copies, ["event_day", "number"], "left").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.lit(2)))).where(
        F.col("copy") <= F.coalesce("copies", F.lit(1)))
    return events.where(~on_7th).unionByName(swapped.select(*events.columns))


@_query("dq_contents")
def query_dq_contents(d: DriverTables) -> DataFrame:
    """Event tables against the change tables they are made from, by entity and day. In one
    load the 7th of each month has lost its first order event and holds its last one twice."""
    lake = _new_lake(d)
    backfill(lake, {f: d.feed(f) for f in CHANGE_FEEDS}, "load")
    expected = reduce(DataFrame.unionByName, [
        entity_events(with_event_time(lake.read(CHANGE_TABLES[f][0]), f), f, ZONE)
        for f in CHANGE_FEEDS])
    events = lake.read("silver.order_events")

    return reduce(DataFrame.unionByName, [
        content_conservation(expected, found).select(F.lit(load).alias("load"), "*")
        for load, found in (("whole", events), ("swapped", _swapped(events)))])


@_query("dq_last_day")
def query_dq_last_day(d: DriverTables) -> DataFrame:
    """Both suites as they ship: the last day before the newest order."""
    suites = (COMMERCE_SUITE, MARKET_SUITE)
    return run_checks(_stored_kpis(d, COMMERCE_CHECK, MARKET_CHECK), _now(d), suites)


@_query("dq_history")
def query_dq_history(d: DriverTables) -> DataFrame:
    """Two runs of the checks over stored tables; the second repeats the first's id."""
    lake = _stored_kpis(d, COMMERCE_CHECK, MARKET_CHECK)
    for run_id in (1, 1, 2):
        record(lake, run_id, _now(d))
    return history(lake).drop("checked_at")


# -- streams -----------------------------------------------------------------

def _streamed(d: DriverTables, feeds: tuple[str, ...], jobs: tuple[str, ...],
              chained: bool = False) -> Lake:
    """Run streaming jobs over the tables' files until all input is processed."""
    lake = _new_lake(d)
    run_available({f: (lambda f=f: d.feed(f, streaming=True)) for f in feeds}, lake, jobs,
                  chained=chained)
    return lake


@_query("stream_bronze_orders")
def query_stream_bronze_orders(d: DriverTables) -> DataFrame:
    return _stored(_streamed(d, ("orders",), ("orders_rows",)).read("bronze.orders_cdc"))


@_query("stream_bronze_ticks")
def query_stream_bronze_ticks(d: DriverTables) -> DataFrame:
    return _stored(_streamed(d, ("ticks",), ("ticks_rows",)).read("bronze.crypto_ticks"))


@_query("stream_silver_order_events")
def query_stream_silver_order_events(d: DriverTables) -> DataFrame:
    jobs = tuple(f"{f}_rows" for f in CHANGE_FEEDS)
    return _stored(_streamed(d, CHANGE_FEEDS, jobs).read("silver.order_events"))


@_query("stream_silver_behavior")
def query_stream_silver_behavior(d: DriverTables) -> DataFrame:
    return _stored(_streamed(d, ("behavior",), ("behavior_rows",)).read("silver.user_behavior"))


@_query("stream_silver_ticks_1s")
def query_stream_silver_ticks_1s(d: DriverTables) -> DataFrame:
    return _stored(_streamed(d, ("ticks",), ("ticks_bars_1s",)).read("silver.crypto_ticks_1s"))


@_query("stream_gold_market")
def query_stream_gold_market(d: DriverTables) -> DataFrame:
    lake = _streamed(d, ("ticks",), ("ticks_kpis_1m",))
    return _stored(lake.read("gold.crypto_market_kpis_1m"))


@_query("stream_market_chained")
def query_stream_market_chained(d: DriverTables) -> DataFrame:
    """Market metrics, and some columns of their bars, by one query with two windows."""
    lake = _streamed(d, ("ticks",), ("ticks_chained",), chained=True)
    stored = lake.read_together(("silver.crypto_ticks_1s", "gold.crypto_market_kpis_1m"))
    bars = long_metrics(stored["silver.crypto_ticks_1s"], ["window_start", "symbol", "exchange"],
                        ["tick_count", "traded_volume", "min_price", "sell_tick_count"])
    return bars.unionByName(stored["gold.crypto_market_kpis_1m"].select(
        "window_start", "symbol", F.lit(None).cast("string").alias("exchange"), "metric_name",
        "metric_value"))


@_query("commit_group")
def query_commit_group(d: DriverTables) -> DataFrame:
    """Rows of both tables of a job after a crash between its two writes, and after a retry."""
    lake, cut, tables = _new_lake(d), F.lit(COMMITS[1][0]), ("bronze.orders_cdc",
                                                             "silver.order_events")
    early = F.col("o_orderdate") < cut

    def commit(batch_id: int, part: Column, crash: bool = False) -> None:
        rows = computed_columns(feed_rows(d.table("orders").where(part), "orders"), "orders")

        def events() -> DataFrame:
            if crash:
                raise InterruptedError("driver lost")
            raw = lake.read_batch(tables[0], "orders", batch_id)
            return entity_events(with_event_time(raw, "orders"), "orders", ZONE)

        lake.commit({tables[0]: lambda: bronze_changes(rows, "orders", ZONE), tables[1]: events},
                    "orders", batch_id, spread=True)

    def counted(state: str) -> DataFrame:
        return table_counts(lake.read_together(tables)).select(F.lit(state).alias("state"), "*")

    commit(0, early)
    try:
        commit(1, ~early, crash=True)
    except InterruptedError:
        broken = counted("crash")
    commit(1, ~early)
    return broken.unionByName(counted("retry"))


@_query("stream_restart")
def query_stream_restart(d: DriverTables) -> DataFrame:
    """Early orders drained, then later ones as a new generation, which has no checkpoint yet."""
    lake, cut = _new_lake(d), F.lit(COMMITS[1][0])
    early = F.col("o_orderdate") < cut
    for generation, part in (("", early), ("second", ~early)):
        def source(part=part) -> DataFrame:
            rows = feed_rows(d.stream("orders").where(part), "orders")
            return computed_columns(rows, "orders")

        run_available({"orders": source}, lake, ("orders_rows",), generation)
    return _stored(lake.read("bronze.orders_cdc"))


def _drained(d: DriverTables, jobs: tuple[str, ...], *parts: dict[str, DataFrame],
             counted: bool = False) -> Lake:
    """Feed rows that arrive part after part; all that has come is processed each time."""
    lake, root = _new_lake(d), scratch_dir(d.spark)

    def source(feed: str, schema) -> Callable[[], DataFrame]:
        files = d.spark.readStream.schema(schema)
        return lambda: computed_columns(files.parquet(f"{root}/{feed}"), feed)

    sources = {feed: source(feed, rows.schema) for feed, rows in parts[0].items()}
    for part in parts:
        for feed, rows in part.items():
            rows.write.mode("append").parquet(f"{root}/{feed}")
        run_available(sources, lake, jobs, counted=counted)
    return lake


def _late_ticks(d: DriverTables, jobs: tuple[str, ...], counted: bool = False) -> Lake:
    """Every tenth order's early ticks arrive after later ticks have closed their windows."""
    shipped, cut = d.table("lineitem"), F.lit(COMMITS[0][0])
    early = F.col("l_shipdate") < cut
    late = early & (F.col("l_orderkey") % 10 == 0)
    return _drained(d, jobs, *[
        {"ticks": feed_rows(shipped.where(part), "ticks")}
        for part in (early & ~late, ~early, late)], counted=counted)


@_query("stream_late_rows")
def query_stream_late_rows(d: DriverTables) -> DataFrame:
    return _stored(_late_ticks(d, ("ticks_kpis_1m",)).read("gold.crypto_market_kpis_1m"))


@_query("stream_dropped_rows")
def query_stream_dropped_rows(d: DriverTables) -> DataFrame:
    """What became of the rows of ``stream_late_rows``, by job."""
    jobs = {"ticks_kpis_1m": "gold.crypto_market_kpis_1m",
            "ticks_bars_1s": "silver.crypto_ticks_1s"}
    lake = _late_ticks(d, tuple(jobs), counted=True)
    found = reduce(DataFrame.unionByName, [account(lake, j, t) for j, t in jobs.items()])
    return found.drop("dropped_groups")


@_query("stream_rejects")
def query_stream_rejects(d: DriverTables) -> DataFrame:
    """Order messages as a stream, every eleventh cut short: records, rows and rejects."""
    root = scratch_dir(d.spark)
    text = F.when(F.col("key") % 11 == 0, F.substring("value", 1, 40)).otherwise(F.col("value"))
    d.messages("orders").select(text.alias("value")).write.parquet(root)
    lake = _new_lake(d)
    messages = d.spark.readStream.schema("value string")
    run_available({"orders": lambda: open_feed(messages.parquet(root), "orders")}, lake,
                  ("orders_rows",), counted=True)
    return totals(lake).select("job", "missing_batches", "records", "rows", "rejects",
                               "dropped_groups")


@_query("stream_idle_feed")
def query_stream_idle_feed(d: DriverTables) -> DataFrame:
    """Payments fall silent; orders go on, and their windows with them."""
    orders, early = d.table("orders"), F.col("o_orderdate") < F.lit(COMMITS[0][0])
    lake = _drained(
        d, ("orders_kpis", "payments_kpis"),
        {f: feed_rows(orders.where(early), f) for f in CHANGE_FEEDS[:2]},
        {"orders": feed_rows(orders.where(~early), "orders")})
    return _stored(lake.read("gold.commerce_kpis_1m"))


@_query("backfill_ranges")
def query_backfill_ranges(d: DriverTables) -> DataFrame:
    """Three adjacent ranges, cut within a minute, give the windows of one long range."""
    lake = _new_lake(d)
    cuts = [None, datetime(1995, 6, 1, 0, 0, 20, 500000), datetime(1998, 1, 1, 0, 0, 1), None]
    for i, (start, end) in enumerate(zip(cuts, cuts[1:])):
        backfill(lake, {f: d.feed(f) for f in (*CHANGE_FEEDS, "ticks")}, f"part{i}", start, end)
    kpis = lake.read("gold.commerce_kpis_1m").withColumn("symbol", F.lit(None).cast("string"))
    return _stored(kpis.unionByName(lake.read("gold.crypto_market_kpis_1m")))


@_query("backfill_strays")
def query_backfill_strays(d: DriverTables) -> DataFrame:
    """Records whose event time lies hours or days from their record time, by feed."""
    hours = {"orders": (97, -3), "refunds": (89, 50)}

    def feed(name: str) -> DataFrame:
        every, apart = hours[name]
        key = d.rows(name).columns[0]
        wait = F.make_dt_interval(hours=F.when(F.col(key) % every == 0, apart).otherwise(0))
        return d.feed(name).withColumn("record_time", F.col("event_time") - wait)

    return backfill(_new_lake(d), {name: feed(name) for name in hours}, "load")


@_query("stream_gold_commerce")
def query_stream_gold_commerce(d: DriverTables) -> DataFrame:
    jobs = tuple(f"{f}_kpis" for f in CHANGE_FEEDS)
    return _stored(_streamed(d, CHANGE_FEEDS, jobs).read("gold.commerce_kpis_1m"))
