"""Spark-native analytics for large auction-lot catalogues.

``functions``  column expressions (text labels, paths, vectors, geometry)
``operators``  DataFrame -> DataFrame operators
``sources``    readers, writers and versioned snapshots
``streaming``  incremental feedback and new-lot ingestion
``plans``      registered queries with their DuckDB checks
"""

__version__ = "0.1.0"
