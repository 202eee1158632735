"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Naive timestamps are read as UTC; AQE resizes shuffles, splits skewed joins and
# turns a sort-merge join into a broadcast one once the real size is known.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows of one key compress well, so a hot partition looks smaller than it is.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
}


def build_session(
    app_name: str = "tickloom",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session; without a master the submitted one is used."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
