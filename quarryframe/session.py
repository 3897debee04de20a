"""Session factory, table loader and column checks."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str = "local[8]", app: str = "quarryframe", **conf: str) -> SparkSession:
    """A session with the settings that the operators expect: AQE with skew joins, UTC, Arrow."""
    builder = SparkSession.builder.master(master).appName(app)
    base = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in (base | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """This application's part of the folder that the driver and all executors share, `spark.checkpoint.dir`.

    In local mode (as in tests) a temporary folder is made where the setting is unset; on a cluster that is an error, because
    a machine's own folder cannot be read by the others.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/quarryframe/{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession) -> str:
    """A fresh path in the shared folder; it is deleted when the application ends."""
    path = f"{shared_folder(spark)}-stores/{uuid.uuid4().hex}"
    atexit.register(delete_path, spark, path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark knows; nothing happens if it is gone."""
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # at exit the JVM may be gone
        pass


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}; there are {', '.join(df.columns)}")
    return df
