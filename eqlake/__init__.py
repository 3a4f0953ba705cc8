"""eqlake: a Spark-native engine for end-of-day equity research.

Layers:

* ``functions``  column expressions (parsing, IEEE-safe arithmetic, ranks, correlation)
* ``sources``    raw CSV landing, the partitioned Parquet store, test-data panels
* ``operators``  normalisers, contracts, price views, repository reads, factors,
                 processors, labels, evaluation, dataset status, time-series helpers
* ``plans``      batch jobs (factor pipeline, validation, ETL jobs) and the query catalogue
* ``streaming``  incremental ingest of landed daily files into the store
"""

__all__ = ["__version__"]

__version__ = "0.1.0"
