"""Session settings the reports rely on.  Cluster sizing stays with the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings.  Shuffle partitions start high and AQE coalesces them,
# so the same plan fits a laptop and a cluster.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # An aggregate on the join key must not stop AQE from splitting a hot key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Planned sizes are of compressed files, so they get a lower limit for a
    # broadcast than sizes measured at run time.
    "spark.sql.autoBroadcastJoinThreshold": "3MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # Hash instead of sort-merge where every measured partition is small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tallymart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings; extra settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, "spark.sql.session.timeZone": "UTC", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
