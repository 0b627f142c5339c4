"""Session for local work, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


_own_folders: dict[str, str] = {}


def local_session(cpus: int | str = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and the bench. On a cluster, use the session the cluster gives."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tiffin")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Call sites recorded for every column make building a plan several times slower.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a machine-local
    folder would be lost with its executor, so a missing setting is an error there.
    """
    application = spark.sparkContext.applicationId
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if application not in _own_folders:
            _own_folders[application] = tempfile.mkdtemp(prefix="tiffin-")
        folder = _own_folders[application]
    return f"{folder.rstrip('/')}/tiffin/{application}"
