"""batchlake: batch-file data lakes on Spark DataFrames.

Layers (each a plain function from DataFrames to DataFrames):

* ``functions``  column expressions (text, numbers, dates, digests)
* ``sources``    readers: delimited files, manifests, curated tables, listings, catalogue
* ``sinks``      idempotent writers
* ``operators``  row rules, skew-safe joins, keyed merge, integrity checks, as-of join
* ``plans``      whole jobs and reports built from the operators
* ``streaming``  the same jobs driven by Structured Streaming
"""
