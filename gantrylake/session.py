"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app: str = "gantrylake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on. These settings hold over the cluster's; ``settings`` hold over these."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Where it names none, the warehouse folder serves, which tables need to share as well.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has written."""
    return f"{shared_folder(spark)}/gantrylake/{name}-{uuid.uuid4().hex}"
