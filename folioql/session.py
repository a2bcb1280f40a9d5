"""Sessions with the settings the engine counts on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, **settings: str) -> SparkSession:
    """A session with UTC time, ANSI errors and adaptive execution; `settings` use __ for dots."""
    builder = SparkSession.builder.config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()})
    return (builder.master(master) if master else builder).getOrCreate()
