from tidemark.operators.bronze import bronze_behavior, bronze_changes, bronze_ticks
from tidemark.operators.gold import (
    commerce_kpis,
    market_kpis,
    market_kpis_from_bars,
    order_kpis,
    payment_kpis,
    refund_kpis,
)
from tidemark.operators.layout import conform, long_metrics
from tidemark.operators.quality import (
    COMMERCE_SUITE,
    MARKET_SUITE,
    checkpoint,
    conservation,
    content_conservation,
    rejected_rows,
    suite_result,
)
from tidemark.operators.serving import (
    freshness,
    lag_sketches,
    latest,
    latest_per_entity,
    merged_freshness,
    table_counts,
)
from tidemark.operators.silver import order_events, silver_behavior, tick_bars
from tidemark.operators.windows import tumble

__all__ = [
    "COMMERCE_SUITE",
    "MARKET_SUITE",
    "bronze_behavior",
    "bronze_changes",
    "bronze_ticks",
    "checkpoint",
    "commerce_kpis",
    "conform",
    "conservation",
    "content_conservation",
    "freshness",
    "lag_sketches",
    "latest",
    "latest_per_entity",
    "long_metrics",
    "market_kpis",
    "market_kpis_from_bars",
    "merged_freshness",
    "order_events",
    "order_kpis",
    "payment_kpis",
    "refund_kpis",
    "rejected_rows",
    "silver_behavior",
    "suite_result",
    "table_counts",
    "tick_bars",
    "tumble",
]
