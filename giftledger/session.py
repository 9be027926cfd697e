"""Spark session settings the jobs expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Everything here can be set by the cluster instead; a session that is already running is left as it is.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM never compiles a method above 8000 bytes of bytecode; beyond that, smaller generated methods are faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(app_name: str = "giftledger", master: str | None = None, **extra: str) -> SparkSession:
    """Return the active session, or start one with the settings above.

    ``extra`` takes further settings with ``__`` for the dot, e.g. ``spark__ui__enabled="false"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
