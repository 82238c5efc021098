"""feedcat: curate web-feed catalogs as Spark DataFrames.

Every operator takes and returns DataFrames and is built from native Spark
expressions, joins, aggregates and windows, so Catalyst can prune, push down
and code-generate it.  ``now`` is always an explicit parameter.
"""

__version__ = "0.1.0"
