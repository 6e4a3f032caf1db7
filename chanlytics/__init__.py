"""chanlytics: channel-message analytics as Spark DataFrame jobs.

Layers
------
sources/    scans: JSON message exports, image folders, driver tables
functions/  column expressions (surrogate keys, date parts, text rules)
operators/  reusable DataFrame -> DataFrame operators (ingest, top-k,
            keyword counting, data-quality checks, batch scoring)
plans/      the data model (staging, marts) and the reports built on it
streaming/  Structured Streaming entry points for incremental ingest
"""

__all__ = ["session", "model"]
