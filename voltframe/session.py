"""SparkSession builder and the settings the engine relies on."""
from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Settings that the semantics rely on, not only the speed.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def build_session(app: str = "voltframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; master is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        **REQUIRED,
        **conf,
    }
    spark = builder.config(map=settings).getOrCreate()
    return ensure(spark)


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """For tests and the benchmark: one JVM, few shuffle partitions."""
    base = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("VOLTFRAME_DRIVER_MEMORY", "8g"),
        "spark.driver.host": "127.0.0.1",
    }
    return build_session(master=f"local[{cores}]", **(base | conf))


def ensure(spark: SparkSession) -> SparkSession:
    """Put the required settings into a session that someone else has built."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
