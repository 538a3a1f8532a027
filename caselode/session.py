"""Session helpers: a local session for tests, and tables written between stages."""

import atexit
import functools
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_staged = []


def local_session(cores="8", memory="8g", name="caselode") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores).replace("*", "8"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _scratch() -> str:
    return tempfile.mkdtemp(prefix="caselode-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, as the session names it.

    A machine-local folder is used only by a local session that names none.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.master.startswith("local"):
        return _scratch()
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")


def own_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for files that this process deletes at its end."""
    path = f"{shared_folder(spark)}/caselode/{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a stage's result once and go on from the files.

    Used where several branches read the same expensive result: the text is
    then processed once, and a lost executor costs a re-read, not a re-run.
    """
    spark = df.sparkSession
    path = own_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Delete the tables this process has staged; results built on them can no longer be read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _staged:
        path = jvm.org.apache.hadoop.fs.Path(_staged.pop())
        path.getFileSystem(conf).delete(path, True)


@atexit.register
def _clear_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _staged:
        try:
            clear_staged(spark)
        except (Py4JError, OSError):  # the session ended before the process
            pass
