"""Session set-up and the two ways of cutting lineage: a checkpoint or a written table.

Both go to the folder named by ``spark.checkpoint.dir``.  Only where that setting is missing
(tests, a laptop) is a temporary folder used instead.
"""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A ``local[cores]`` session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("eavesgrid")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()
_OWN_FOLDERS: dict[str, str] = {}


def ship_package(spark: SparkSession | None = None) -> None:
    """Give the Python workers this package, once per application, so that UDFs can import it."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None or spark.sparkContext.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="eavesgrid-code-"), "eavesgrid.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(spark.sparkContext.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the cluster, also given to the Spark context."""
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError(f"a cluster needs {CHECKPOINT_KEY}: a folder that all its machines share")
        app = spark.sparkContext.applicationId
        folder = _OWN_FOLDERS.setdefault(app, _OWN_FOLDERS.get(app) or tempfile.mkdtemp(prefix="eavesgrid-"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a table that is written and read back."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df``: survives the loss of any executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now; else they stay until the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None if nothing was written there yet; whatever else is wrong with it is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
