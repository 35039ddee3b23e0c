"""terrahaz: geospatial hazard analytics as functions on Spark DataFrames.

Every operator is ``f(df, ...) -> DataFrame`` or ``f(col, ...) -> Column``.
Sub-packages:

* ``functions``  column expressions: geometry, grid, classification
* ``operators``  DataFrame operators: cleaning, joins, ordered scans, metrics
* ``sources``    readers, feed flatteners and sinks
* ``plans``      gold builders and end-to-end flows
* ``streaming``  the same work as Structured Streaming jobs
* ``queries``    the registry the driver contract is built from
"""

__version__ = "0.1.0"
