"""shelfwise: retail sync, stock and planning expressed as Spark DataFrame jobs.

Layout
------
sources/    readers, domain views over the driver tables, lake layout
functions/  column expressions (defaults, flags, date keys, ranges)
operators/  keys, upserts, aggregates, quality, series, forecasts, planning, similarity
plans/      load jobs that chain operators, plus the registered query catalogue
streaming/  Structured Streaming jobs (delta sync, change apply, late data, running stock)
"""

__version__ = "0.1.0"
