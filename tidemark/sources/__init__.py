from tidemark.sources.changes import (
    allow_listed,
    hand_over,
    route,
    snapshot_rows,
    snapshot_then_changes,
    unwrap,
)
from tidemark.sources.decode import (
    avro_reader_schema,
    computed_columns,
    decode_framed_avro,
    decode_json,
    require_columns,
)
from tidemark.sources.feeds import file_feed, kafka_feed, kafka_options, open_feed
from tidemark.sources.tables import query_batch, read_evolved, table_scan, union_versions

__all__ = [
    "allow_listed",
    "avro_reader_schema",
    "computed_columns",
    "decode_framed_avro",
    "decode_json",
    "file_feed",
    "hand_over",
    "kafka_feed",
    "kafka_options",
    "open_feed",
    "query_batch",
    "read_evolved",
    "require_columns",
    "route",
    "snapshot_rows",
    "snapshot_then_changes",
    "table_scan",
    "union_versions",
    "unwrap",
]
