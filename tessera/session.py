"""The session that the library expects: UTC, ANSI casts, adaptive execution."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "tessera", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session for batch work. On a cluster the master and the sizes come from the
    submit command; tests pass a local master and few shuffle partitions."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return builder.config(map=settings | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()
