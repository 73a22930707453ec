"""Campaign-finance filings on Spark.

Loads zipped, pipe-delimited contribution filings, keeps candidate and
committee dimensions with stable integer ids per election cycle, resolves
contribution facts against them (full refresh or add/change/delete feeds),
keeps per-committee totals and a run history, and answers the analytic
questions asked of that data.  Everything runs as DataFrame / Spark SQL
plans over Parquet.

Layout:
    functions/  column expressions (dates, text fitting, change tests)
    sources/    file catalog, manifest diff, archive discovery, zip lines
    operators/  parse, ids, lookups, dimensions, facts, history
    plans/      versioned tables, sample reports, whole runs, stand-ins
    streaming/  change feeds applied as they arrive
"""

__all__ = ["schemas"]
