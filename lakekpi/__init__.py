"""lakekpi — daily-KPI lakehouse pipeline expressed as Spark DataFrame / SQL / Structured Streaming operators.

Layers (each a plain ``DataFrame -> DataFrame`` function unless it is a sink):

* ``sources``   – scans, file listings, fixtures over the driver tables, partition readers and probes
* ``functions`` – column-level helpers (text, time, decimal) built from ``pyspark.sql.functions``
* ``operators`` – admission, validation, curation, aggregation, serving, archive, metrics/alarms
* ``plans``     – composed batch jobs (silver, gold, load, one batch, backfill, late rebuild) and SQL views
* ``streaming`` – incremental file ingest with Structured Streaming + ``foreachBatch``
"""

__version__ = "0.1.0"
