"""Spark session for standalone use. On a cluster, sizes come from the submit command; only dialect settings are set here."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "tessera", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        builder = builder.master(master)
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()
