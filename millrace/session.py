"""Session for the bench and the tests; on a cluster the caller's session is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str, app_name: str = "millrace") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .getOrCreate()
    )
