"""Session builder and the shared work folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings the operators rely on.

    The zone is pinned so that dates do not depend on the machine. AQE stays on:
    it picks broadcast joins from measured sizes, splits skewed join partitions
    and sizes shuffle partitions at run time, so no operator hints a broadcast. A
    small catalogue is broadcast from the size of its files, before the other side moves.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # A side is broadcast if its files, or what adaptive execution has measured, are this small.
        .config("spark.sql.autoBroadcastJoinThreshold", "10MB")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """Folder for written intermediates: ``spark.checkpoint.dir`` where it is set.

    A local folder is made only where the session names none and runs in one
    process, as in tests.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="matchlens-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")
