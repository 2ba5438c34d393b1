"""regiolake: Spark-native operators for tidy official-statistics analytics.

Subpackages
-----------
functions  Column builders (labels, numbers, text): pure expressions, JVM-side.
sources    Readers that turn raw shapes into tidy DataFrames, the table catalog, and sinks.
operators  Relational helpers, reshape, series analytics and data-quality checks.
plans      Domain models and clean-table jobs composed from the operators, plus the
           registered query set used by the correctness gate and the bench.
"""

__version__ = "0.1.0"
