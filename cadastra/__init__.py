"""Company-registry analytics on Spark.

Sub-packages:

* ``sources``   – table catalog, registry views, raw CSV/zip/JSON readers, Parquet and CSV sinks
* ``functions`` – Column-level building blocks (codes, identifiers, text cleaning)
* ``operators`` – DataFrame-level joins, aggregates and ordering
* ``plans``     – end-to-end queries composed from the above
* ``streaming`` – incremental ingest with the file-source stream
"""

__all__ = ["sources", "functions", "operators", "plans", "streaming"]
