"""tarmac: a Spark-native engine for building and maintaining a snowflake-schema
warehouse from wide CSV extracts and keyed JSON topics.

Everything is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions; there are no Python UDFs.  Sub-packages:

``functions``  column expressions (coercion, sentinels, durations, keys, JSON)
``operators``  dedup, surrogate ids, lookups with rejects, upserts, ranking, paging
``sources``    CSV / Parquet / landed pages / topic files, and the sinks
``plans``      composed entity loads, stream processors, reports, driver queries
``streaming``  file-backed topic streams with ``foreachBatch`` and a replay ledger
"""

__version__ = "0.1.0"
