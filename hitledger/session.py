"""A Spark session with the settings the library is tuned for.

The plans work on any session; on a cluster the caller usually brings its own.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Re-plan at run time: merge small shuffle partitions, switch to a
    # broadcast when a side's measured size allows it, split skewed join sides.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Building a frame need not note the Python call site of every expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "hitledger",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session, with `settings` over the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    return builder.config(map={**SETTINGS, **(settings or {})}).getOrCreate()
