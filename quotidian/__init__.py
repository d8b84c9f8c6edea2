"""Daily market-signal analytics on Spark DataFrames.

Layers, lowest first:

* ``functions``  column expressions and window columns
* ``sources``    readers, writers, catalog helpers, and tables derived from a warehouse
* ``operators``  curation, quality checks, features, scores, books
* ``plans``      mart readers and the daily / backfill runs
* ``streaming``  the daily run fed by a file stream
"""

__version__ = "0.1.0"
