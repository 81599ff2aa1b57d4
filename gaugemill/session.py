"""Session and catalog settings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Sized for a cluster; any of them can be overridden by the caller.
DEFAULTS = {
    "spark.driver.memory": "4g",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A failed write is a failed task: it is tried three more times, at once. Waiting between
    # tries is left to connectors that offer it; pass their settings as ``options``.
    "spark.task.maxFailures": "4",
}


def build_session(
    app_name: str,
    conf: Mapping[str, str] | None = None,
    *,
    master: str | None = None,
    packages: list[str] | None = None,
) -> SparkSession:
    """Start a session. ``packages`` names connector artifacts, ``conf`` their settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if packages:
        builder = builder.config("spark.jars.packages", ",".join(packages))
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def register_catalog(
    spark: SparkSession,
    name: str,
    implementation: str,
    options: Mapping[str, str] | None = None,
) -> str:
    """Make tables of an external store readable as ``<name>.<database>.<table>``."""
    prefix = f"spark.sql.catalog.{name}"
    spark.conf.set(prefix, implementation)
    for key, value in (options or {}).items():
        spark.conf.set(f"{prefix}.{key}", value)
    return name


def pin_utc(spark: SparkSession) -> SparkSession:
    """Month and day buckets depend on the session time zone; keep it fixed."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
