"""paymart: a payments lakehouse expressed as Spark DataFrame jobs.

Layers: raw string tables -> bronze (audit columns) -> silver (typed, cleaned,
validated, deduplicated) -> gold (Type-1 and Type-2 dimensions, calendar,
transaction fact) -> reports.  Every operator is a function from DataFrames to
a DataFrame built from Spark's own expressions, joins, windows and
aggregates; nothing is collected to the driver and no wall clock enters a
result (load stamps derive from an ``as_of`` argument).
"""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
