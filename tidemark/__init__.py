"""tidemark: data-quality gates, incremental loads and run analytics on PySpark.

Every public function takes and returns DataFrames.  Nothing here collects
data-sized results; clocks, paths and thresholds are parameters.
"""
