from metaweave.functions.exprs import (
    epoch_seconds,
    escape_key_part,
    is_delta_format,
    is_describe_marker,
    is_view_type,
    node_key,
    tokens,
)
from metaweave.functions.ordered import block_ordinal, ordered_collect, ordered_join, range_ordinal
from metaweave.functions.sizing import at_most, broadcast_if_small

__all__ = [
    "at_most",
    "block_ordinal",
    "broadcast_if_small",
    "epoch_seconds",
    "escape_key_part",
    "is_delta_format",
    "is_describe_marker",
    "is_view_type",
    "node_key",
    "ordered_collect",
    "ordered_join",
    "range_ordinal",
    "tokens",
]
