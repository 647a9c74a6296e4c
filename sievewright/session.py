"""A session with the settings the engine counts on; everything else is the cluster's."""

from pyspark.sql import SparkSession


def session(name: str = "sievewright", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
