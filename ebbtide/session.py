"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings the jobs rely on; anything the cluster already sets wins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_local_scratch: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "ebbtide", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.extraJavaOptions", "-Dlog4j2.level=ERROR")
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path every executor can reach, under the folder in spark.checkpoint.dir.

    Only a local session may do without that setting: driver and executors are then
    one process, and a temporary folder that goes away with it is enough.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_scratch.get(sc.applicationId)
        if base is None:
            base = tempfile.mkdtemp(prefix="ebbtide-")
            _local_scratch[sc.applicationId] = base
            atexit.register(shutil.rmtree, base, ignore_errors=True)
    return "/".join([base.rstrip("/"), f"ebbtide-{sc.applicationId}", *parts])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether something lies at the path. A file system that cannot be asked raises."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already. Of several callers one gets True."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, False).close()
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        return False
    return True


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names of what lies in a folder; none if there is no folder."""
    if not path_exists(spark, folder):
        return []
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return sorted(f.getPath().getName() for f in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this job's own, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give checkpoint() a folder when the session has none yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoints"))


