"""impactspark -- programme-impact reporting on Spark DataFrames.

Packages:
  functions  Column -> Column cleaning and date logic
  operators  DataFrame -> DataFrame dedup, joins, lookups, reshapes, checks
  sources    source specs, template scans, sinks
  plans      report builders and the queries over the shared test tables
  streaming  incremental (micro-batch) driving of the batch builders
"""

__version__ = "0.1.0"
