"""tierwise: call-day topics, tobacco flags, goals and period reports on Spark.

Packages: ``sources`` (schemas, loading, month snapshots), ``functions``
(rule lists and column builders), ``operators`` (generic grouping and join
operators), ``plans`` (the cascade, reports, periods and job entry points),
``streaming`` (nothing: the job is a monthly batch).
"""

__version__ = "0.1.0"
