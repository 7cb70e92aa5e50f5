"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: str = "8", app: str = "entitylake", memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and measurements."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording the call site of every expression takes longer than building it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the one the cluster shares; a temporary one only in local mode."""
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="run-")
        spark.conf.set(CHECKPOINT_SETTING, root)
    return f"{root.rstrip('/')}/lake-{uuid.uuid4().hex}"


def written(table: DataFrame) -> DataFrame:
    """The table, written once to the shared folder and read back."""
    path = shared_folder(table.sparkSession)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
