"""Session settings and the shared folder that written intermediates go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings the library's plans are tuned with; a cluster adds its own sizing.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", memory: str = "4g", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("vocalis")
    settings = {**SETTINGS, "spark.sql.shuffle.partitions": "8", "spark.driver.memory": memory, **extra}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Folders that ``workspace`` has named in this process and that may be there.
_made: list[str] = []


def workspace(spark: SparkSession) -> str:
    """A new, empty folder under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a ``local`` master may go without that setting: its tasks all run on one machine,
    so a temporary folder is shared by definition.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="vocalis-")
    _made.append(f"{base.rstrip('/')}/vocalis-{uuid.uuid4().hex}")
    return _made[-1]


def clear_workspaces(spark: SparkSession) -> None:
    """Remove the folders that this process got from ``workspace``, and no others. Tables read from them are gone then."""
    while _made:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

