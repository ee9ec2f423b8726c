"""flatland: Spark-native ingestion, profiling and publishing of delimited text files.

Files land as all-string rows, are cleaned and strictly cast, whole bad files
are quarantined, the rest are mapped into a typed stage, de-duplicated by key
and published into a versioned target. A profiler infers the mapping spec that
drives those steps. Everything is a DataFrame transformation.
"""

from flatland.session import build_session, scratch_root

__all__ = ["build_session", "scratch_root"]
