"""Product-analytics events, structured logs and metrics on Spark."""

from signalyard.session import configure, durable, local_session

__all__ = ["configure", "durable", "local_session"]
__version__ = "0.1.0"
