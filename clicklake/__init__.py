"""Click-event analytics on Spark: decode, archive, aggregate, alert, check, report.

Every transform takes DataFrames and returns a DataFrame without running a job; only ``sources.sinks``, ``streaming`` and
``plans`` write. The same transforms serve batch tables and streams.
"""
