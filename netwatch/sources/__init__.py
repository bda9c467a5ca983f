"""Sources: batch tables, Kafka / file streams, decoding, derived event views."""

from netwatch.sources.decode import (
    LOOKUP_REQUIRED,
    ROUTING_REQUIRED,
    decode_lookups,
    decode_routing,
    keep_raw_of_rejects,
    split_rejects,
)
from netwatch.sources.fixtures import (
    allowed_origins_fixture,
    known_prefix_fixture,
    lookup_fixture,
    page_hosts,
    routing_fixture,
)
from netwatch.sources.tables import load_table
from netwatch.sources.wire import (
    encode_wire,
    kafka_stream,
    lookup_wire,
    routing_wire,
    wire_file_stream,
)

__all__ = [
    "LOOKUP_REQUIRED", "ROUTING_REQUIRED", "keep_raw_of_rejects", "allowed_origins_fixture",
    "known_prefix_fixture", "decode_lookups", "decode_routing", "encode_wire", "kafka_stream", "load_table",
    "lookup_fixture", "lookup_wire", "page_hosts", "routing_fixture", "routing_wire",
    "split_rejects", "wire_file_stream",
]
