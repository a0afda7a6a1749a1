"""Reading signals and writing them."""

from signalyard.sources.clustered import write_clustered
from signalyard.sources.files import MALFORMED, read_batches, read_signals, stream_batches, stream_signals
from signalyard.sources.row_intake import stream_rows
from signalyard.sources.sinks import quarantine, stream_to_sink, write_signals

__all__ = [
    "MALFORMED",
    "quarantine",
    "read_batches",
    "read_signals",
    "stream_batches",
    "stream_rows",
    "stream_signals",
    "stream_to_sink",
    "write_clustered",
    "write_signals",
]
