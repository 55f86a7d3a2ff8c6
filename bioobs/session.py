"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "bioobs", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and dates pinned to UTC.

    Nothing here sets ``spark.checkpoint.dir``: the cluster names it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # taxa named "1" or "true" must stay text when they become folders
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder path that every executor can reach.

    Lives under ``spark.checkpoint.dir``. Only a local-mode session (tests) may
    fall back to a temporary folder on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="bioobs-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
