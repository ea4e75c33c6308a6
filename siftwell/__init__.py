"""siftwell: evidence-based ranking of nested profile records on PySpark."""

__version__ = "0.1.0"
