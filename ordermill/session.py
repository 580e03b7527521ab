"""Session defaults.  Every function in the package takes the caller's session; this is a convenience."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution carries the scale decisions: it coalesces small shuffle partitions, splits
# skewed join partitions and rebalanced write partitions, and turns a shuffled join into a broadcast
# one only when the measured size is under the threshold.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(app_name: str = "ordermill", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the defaults above; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
