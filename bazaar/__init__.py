"""bazaar: customer and experiment analytics written as Spark DataFrame jobs.

Every operator takes DataFrames and returns a lazy DataFrame; nothing is
collected to the driver.  Sub-packages:

* ``sources``    - scans, sinks and the adapters that derive the analytic
                   inputs (user events, retail lines, star schema, A/B units,
                   campaign days) from the driver tables.
* ``functions``  - column expressions (normal / Student-t tails, quantile
                   functions, shared CASE ladders).
* ``operators``  - the analytics themselves (events, customers, quality,
                   profiles, cohorts, segments, experiments, ranking).
* ``plans``      - the registered queries and their DuckDB oracle SQL.
* ``streaming``  - the Structured Streaming twin of the hourly metrics.
"""

__version__ = "0.1.0"
