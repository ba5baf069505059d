"""Session settings the sync jobs rely on.

No master and no memory size is set here: those belong to ``spark-submit``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SESSION_CONF = {
    # Every instant is read, compared and rendered in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Parquet filter pushdown decides how much of a 100 TB source a delta reads.
    "spark.sql.parquet.filterPushdown": "true",
}


def session(app_name: str = "syncflow", **extra: str) -> SparkSession:
    """Build (or fetch) a session with the settings above."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


#: File formats of the older reader; parquet is left out, so that it is read by the newer one.
_OLDER_SOURCES = "avro,csv,json,kafka,orc,text"


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` that answers counts and extremes from parquet footers.

    It shares the application but not the settings: those of ``spark`` are copied, and
    changes here are seen by nobody else. Extremes of numbers and dates, and counts, without a
    filter on other than partition columns, then read no rows; Spark scans for the rest.
    """
    beside = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and beside.conf.isModifiable(key):
            beside.conf.set(key, value)
    beside.conf.set("spark.sql.sources.useV1SourceList", _OLDER_SOURCES)
    beside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return beside
