"""Streaming forms of the operators.

Stateless operators (payloads, stamping, validation, filters, unpacking) run on streams unchanged.
"""

from signalyard.streaming.flows import IntakeListener, bounded_intake, enrich_asof_stream, late_split, route_stream
from signalyard.streaming.stateful import counter_stream, super_props_stream
from signalyard.streaming.windows import (
    dedupe_stream,
    enrich_stream,
    join_streams,
    profile_stream,
    session_stream,
    sliding,
    tumbling,
)

__all__ = [
    "IntakeListener",
    "bounded_intake",
    "counter_stream",
    "dedupe_stream",
    "enrich_asof_stream",
    "enrich_stream",
    "join_streams",
    "late_split",
    "profile_stream",
    "route_stream",
    "session_stream",
    "sliding",
    "super_props_stream",
    "tumbling",
]
