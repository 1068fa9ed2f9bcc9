"""retailmart: a Spark-native retail warehouse, analytics and data-quality engine.

Layout
------
sources/    staging scans (CSV with declared schemas), lookups, sinks, test fixtures
functions/  scalar Column helpers, cleaning, predicates, aggregate helpers
operators/  star-schema builders and order-sensitive operators (surrogate keys, NTILE)
plans/      named analytic queries, the warehouse pipeline, monitoring data sets
quality/    declarative data-quality rules, fused evaluation, audit, summary, gate
streaming/  (nothing: the reference system is daily batch only)
"""

__version__ = "0.1.0"
