from tidemark.functions.aggregates import count_where, mean, null_safe_sum, ratio_or_zero
from tidemark.functions.times import (
    clock_goes_back,
    epoch_ms_to_ts,
    first_event_time,
    hour_floor,
    millis_between,
    minute_floor,
    processing_time,
    to_wall_clock,
    wall_clock,
    wall_clock_to_epoch_ms,
    zoned_instant,
)

__all__ = [
    "clock_goes_back",
    "count_where",
    "epoch_ms_to_ts",
    "first_event_time",
    "hour_floor",
    "mean",
    "millis_between",
    "minute_floor",
    "null_safe_sum",
    "processing_time",
    "ratio_or_zero",
    "to_wall_clock",
    "wall_clock",
    "wall_clock_to_epoch_ms",
    "zoned_instant",
]
