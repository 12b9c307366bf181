"""A local session for tests and benchmarks. On a cluster the caller brings the session."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillroll")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_own: dict[str, str] = {}  # by application, for local sessions that name no folder


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the session names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _own:
        _own[application] = tempfile.mkdtemp(prefix="tillroll-")
    return _own[application]
