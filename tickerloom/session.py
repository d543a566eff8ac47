"""Session helper for stand-alone use; jobs take whatever session they are given."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "tickerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with AQE on and UTC time. ANSI mode stays at its default (on)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only a local session, whose tasks share a disk, may leave it unset."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tickerloom-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def stage(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared checkpoint folder and go on from there.

    For tables that several branches of a job read (scored cohorts, trades,
    return panels): without it every branch computes them again. Never a local
    checkpoint, since executors may be lost.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
