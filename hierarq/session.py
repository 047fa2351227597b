"""Session settings shared by tests, bench and jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", app: str = "hierarq", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", **conf: str) -> SparkSession:
    """A session with UTC time, AQE (coalescing and skew splitting) and Arrow transfer.

    On a cluster only the UTC setting matters for results; the rest are defaults
    that the cluster's own configuration may override through ``conf``.
    """
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
