"""Session entry for scripts. Library functions never build a session; they
take the one the caller already has."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every run wants. Memory, cores and shuffle partitions belong to the
# cluster (spark-submit / spark-defaults) and are left alone on purpose.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session. Keyword names use ``__`` for dots, for example
    ``build("prices", spark__executor__memory="2g")``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
