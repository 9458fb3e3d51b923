"""Tidemark: layered table synchronisation on Spark.

Snapshots and watermark deltas land in a RAW layer, which feeds a
latest-row-per-key SILVER layer or a versioned SCD2 dimension.  Every operator
takes and returns DataFrames; ``tidemark.plans``, ``tidemark.staging`` and the
operators that stage (``assign_surrogate``, ``fact_lookup``, ``splice_scd2``, ``refresh_silver``,
``differing_keys``, ``missing_keys_by_sketch``, ``count_hits``) run
Spark actions.
"""

__version__ = "0.1.0"
