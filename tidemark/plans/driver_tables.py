"""The feeds as views over the driver's star-schema tables.

Amounts are cast to decimals, so sums are exact and do not depend on row order. Event times
get small offsets inside their minute, and source and update times are missing on some rows,
so that every step of the event-time rule is used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import to_wall_clock
from tidemark.sources import computed_columns

ZONE = "UTC"

# Layout of the driver's tables, as far as the views use them.
TABLES = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}

# Thousandths of the interval since the epoch, so the session zone has no say.
EPOCH_MS = ("CAST(CAST(({0} - TIMESTAMP_NTZ '1970-01-01 00:00:00') * 1000 AS INTERVAL SECOND) "
            "AS BIGINT)")


def _log_columns(start: str, key: str, stamp: str) -> list[str]:
    """Times of a change record; update and source time are missing on some keys."""
    ms = EPOCH_MS.format(start)
    return [
        f"{ms} AS {stamp}_ms",
        f"IF({key} % 6 <> 0, {ms} + ({key} % 7) * 1000, NULL) AS updated_at_ms",
        f"IF({key} % 3 <> 0, {ms} + ({key} % 50) * 1000, NULL) AS __source_ts_ms",
    ]


VIEWS = {
    "orders": ("orders", "true", [
        "o_orderkey AS order_id", "o_custkey AS user_id", "o_orderstatus AS order_status",
        "CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount", "'KRW' AS currency",
        "IF(o_orderkey % 7 = 0, 'FLASH15', NULL) AS coupon_id",
        "CASE o_orderkey % 10 WHEN 0 THEN 'r' WHEN 1 THEN 'u' WHEN 2 THEN 'd' ELSE 'c' END "
        "AS __op",
        *_log_columns("o_orderdate", "o_orderkey", "created_at"),
    ]),
    "payments": ("orders", "true", [
        "o_orderkey AS payment_id", "o_orderkey AS order_id", "o_custkey AS user_id",
        "CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'P' THEN 'PENDING' ELSE 'FAILED' END "
        "AS payment_status",
        "IF(o_orderkey % 2 = 0, 'CARD', 'TRANSFER') AS payment_method",
        "CAST(o_totalprice AS DECIMAL(12,2)) AS amount",
        "IF(o_orderkey % 4 = 0, 'u', 'c') AS __op",
        *_log_columns("o_orderdate", "o_orderkey", "paid_at"),
    ]),
    "refunds": ("lineitem", "l_returnflag = 'R'", [
        "l_orderkey * 10 + l_linenumber AS refund_id", "l_orderkey AS order_id",
        "IF(l_orderkey % 5 <> 0, l_orderkey, NULL) AS payment_id", "l_suppkey AS user_id",
        "IF(l_linestatus = 'F', 'SUCCEEDED', 'REQUESTED') AS refund_status",
        "IF(l_linenumber > 3, 'CUSTOMER_CHANGED_MIND', NULL) AS refund_reason",
        "IF(l_orderkey % 9 <> 0, CAST(l_extendedprice AS DECIMAL(12,2)), NULL) "
        "AS refund_amount",
        "IF(l_orderkey % 4 = 0, 'u', 'c') AS __op",
        *_log_columns("l_shipdate", "l_orderkey", "refunded_at"),
    ]),
    # On the 13th of a month nothing trades.
    "ticks": ("lineitem", "true", [
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS tick_id",
        "l_returnflag AS symbol", "l_linestatus AS exchange",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS price",
        "CAST(IF(dayofmonth(l_shipdate) = 13, 0, l_quantity) AS DECIMAL(12,2)) AS volume",
        "CASE l_linenumber % 3 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' ELSE 'CROSS' END AS side",
        "CAST(l_partkey AS STRING) AS trade_id", "'shipments' AS ingest_source",
        f"{EPOCH_MS.format('l_shipdate')} + (l_linenumber % 2) * 1000 + l_orderkey % 1000 "
        "AS event_time",
    ]),
    "behavior": ("events", "true", [
        "CAST(event_id AS STRING) AS event_id", "user_id",
        "concat_ws('-', user_id, event_id % 16) AS session_id", "event_type",
        "CASE event_type WHEN 'view' THEN 'search' WHEN 'click' THEN 'product' "
        "WHEN 'purchase' THEN 'checkout' ELSE 'home' END AS page",
        "IF(event_type <> 'view', item, NULL) AS product_id",
        "IF(event_type = 'view', concat('k', item), NULL) AS keyword",
        "IF(event_type = 'click', concat('cart', user_id), NULL) AS cart_id",
        "IF(event_type = 'purchase', event_id, NULL) AS order_id",
        "IF(event_type = 'click', CAST(item % 5 AS INT), NULL) AS quantity",
        "IF(event_type <> 'view', value, NULL) AS price",
        "CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END "
        "AS device_type",
        "'app' AS source",
        f"timestamp_millis({EPOCH_MS.format('ts')}) AS timestamp",
    ]),
}


def feed_rows(base: DataFrame, feed: str) -> DataFrame:
    """Rows of ``feed`` from its base table, or from part of it."""
    _, condition, columns = VIEWS[feed]
    if feed == "behavior":
        base = base.selectExpr("*", "CAST(get_json_object(props, '$.k') AS BIGINT) AS item")
    elif condition != "true":
        base = base.where(condition)
    return base.selectExpr(*columns)


@dataclass(frozen=True)
class DriverTables:
    spark: SparkSession
    sf_dir: str

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(self.path(name))

    def stream(self, name: str) -> DataFrame:
        """The table's files as a stream of rows."""
        # A stream source takes folders or globs; the table may be a single file.
        glob = f"{self.sf_dir}/{name}.parque[t]"
        return self.spark.readStream.schema(TABLES[name]).parquet(glob)

    # -- opened feeds ----------------------------------------------------

    def rows(self, feed: str, streaming: bool = False) -> DataFrame:
        """Rows with the columns of the feed."""
        base = VIEWS[feed][0]
        return feed_rows(self.stream(base) if streaming else self.table(base), feed)

    def feed(self, feed: str, streaming: bool = False) -> DataFrame:
        """Rows of the feed with its computed columns."""
        return computed_columns(self.rows(feed, streaming), feed)

    def messages(self, feed: str) -> DataFrame:
        """Rows of a change feed as JSON messages, beside their key."""
        rows = self.rows(feed)
        return rows.selectExpr(f"{rows.columns[0]} AS key", "to_json(struct(*)) AS value")


def utc(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with the named instants as UTC wall-clock times."""
    return df.withColumns({c: to_wall_clock(F.col(c), ZONE) for c in columns})
