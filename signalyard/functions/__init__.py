"""Column-level rules: JSON payloads, enum codes, times, sizes."""

from signalyard.functions.enums import code_of, name_of
from signalyard.functions.payload import (
    as_props,
    empty_props,
    finite_or_null,
    merge_properties,
    merged_map,
    props_of,
    typed_props,
)
from signalyard.functions.scalars import decode_key, epoch_us, null_if_empty, to_timestamp

__all__ = [
    "as_props",
    "code_of",
    "decode_key",
    "empty_props",
    "epoch_us",
    "finite_or_null",
    "merge_properties",
    "merged_map",
    "name_of",
    "null_if_empty",
    "props_of",
    "to_timestamp",
    "typed_props",
]
