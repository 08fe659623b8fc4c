"""strata: layered (bronze / silver / gold) retail analytics on Spark.

Every transform is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function built from Spark's own SQL functions, windows, joins and aggregates,
so Catalyst and adaptive execution plan the work.  I/O lives only in
``strata.sources`` and ``strata.sinks``.
"""

__version__ = "0.1.0"
