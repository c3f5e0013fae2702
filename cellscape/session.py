"""Session helpers: a local session for tests/bench and the lineage-cut location."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "cellscape") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CELLSCAPE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used as is.
    A folder of our own is picked only when it is unset and the master is ``local``, where
    driver and executors are one process; anywhere else an unset folder is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    master = sc.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    configured = os.environ.get("CELLSCAPE_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="cellscape-checkpoints-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: dict = {"lock": threading.Lock(), "inside": 0, "before": None}


@contextmanager
def shuffle_files_dropped_at_end(spark: SparkSession):
    """Jobs inside drop their shuffle files when they end; their result is a written table.

    Threads may be inside at once; the last to leave puts the setting back.
    """
    with _cleaning["lock"]:
        if not _cleaning["inside"]:
            _cleaning["before"] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _cleaning["inside"] += 1
    try:
        yield
    finally:
        with _cleaning["lock"]:
            _cleaning["inside"] -= 1
            if not _cleaning["inside"]:
                if _cleaning["before"] is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, _cleaning["before"])


class Scratch:
    """Intermediate tables of one job in the shared checkpoint folder.

    ``put`` writes a table and reads it back, which cuts the lineage in a way that survives
    the loss of executors; ``drop`` removes tables that no later step reads.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cellscape-tables/{uuid.uuid4().hex}"
        self._count = 0
        self._paths: dict[str, str] = {}

    def put(self, name: str, df: DataFrame, codec: str | None = None) -> DataFrame:
        """``codec``: Parquet compression for a table with long texts; the session's by default."""
        self._count += 1
        path = f"{self.base}/{self._count:03d}-{name}"
        with shuffle_files_dropped_at_end(self.spark):
            df.write.parquet(path, compression=codec)
        self._paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self._paths.pop(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Cut the lineage by writing a parquet table into the shared checkpoint folder and
    reading it back.

    The folder comes from the session (``spark.checkpoint.dir`` on a cluster), so the
    table survives executor loss.  A read-back table starts a fresh plan with file
    statistics; a ``Dataset.checkpoint`` would keep the statistics of its origin plan,
    which makes iterative jobs that self-join their state plan ever more slowly.
    """
    return Scratch(df.sparkSession).put("cut", df)
