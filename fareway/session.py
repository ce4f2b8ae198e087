"""Session defaults and the shared folder that cuts long lineages."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def create_session(app_name: str = "fareway", **conf: str) -> SparkSession:
    """A session with UTC timestamps, adaptive execution and no web page.

    Master, memory and shuffle width come from the submitting environment or
    from ``conf`` (dots written as double underscores).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder once; a cluster
    without it is refused, because a machine-local folder is lost with its node.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    folder = context.getLocalProperty("fareway.folder")
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="fareway-")
    context.setLocalProperty("fareway.folder", folder)
    return folder


_kept: set[str] = set()


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Remove an application's folder of intermediate tables when its driver ends."""
    if folder in _kept:
        return
    _kept.add(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark._jsc.hadoopConfiguration()

    def remove() -> None:
        try:
            path.getFileSystem(conf).delete(path, True)
        except Exception:  # noqa: BLE001  the driver's JVM may be gone before
            pass

    atexit.register(remove)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, private to this application and removed with it."""
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    _remove_at_exit(spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so later steps start there."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
