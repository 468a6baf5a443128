"""tidemark: market-intelligence analytics on PySpark.

Operators take and return DataFrames (``tidemark.operators``), readers and
sinks move data in and out (``tidemark.sources``), column functions live in
``tidemark.functions``, marts and registered queries in ``tidemark.plans`` and
incremental ingest in ``tidemark.streaming``.
"""

__version__ = "0.1.0"
