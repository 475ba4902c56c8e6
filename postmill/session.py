"""Session set-up and the shared scratch folder."""

import uuid

from pyspark.sql import SparkSession


def get_spark_session(app_name: str = "postmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC dates and AQE; cluster sizing stays with spark-submit.

    ``conf`` takes any further setting, with ``__`` for the dots:
    ``get_spark_session(spark__sql__shuffle__partitions="8")``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.python.worker.reuse": "true",
        "spark.network.timeout": "600s",
        "spark.executor.heartbeatInterval": "60s",
    }
    for key, value in {**defaults, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder the session names in ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse takes its place: every session has a
    warehouse, and all executors of a cluster reach it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/postmill/{uuid.uuid4().hex}/{name}"
