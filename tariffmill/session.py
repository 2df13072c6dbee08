"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app_name: str = "tariffmill", **conf: str) -> SparkSession:
    """A session with the settings the jobs are tuned for; ``conf`` overrides them."""
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        # call-site tracking of every column function doubles the time to build these wide plans
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # whole pages go to the table reader, so batches are kept short
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        # parsing a record costs far more than opening a file, so short files are split too
        "spark.sql.files.openCostInBytes": "1m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str, base: str | None = None) -> str:
    """A fresh path in a folder that the driver and all executors share.

    That is ``base``, or the cluster's ``spark.checkpoint.dir``, or the warehouse; never a machine's own temporary folder.
    """
    base = base or spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not base:
        raise ValueError("give a shared folder, or set spark.checkpoint.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    where, fs = _hadoop(spark, path)
    return fs.exists(where)


def remove_path(spark: SparkSession, path: str) -> None:
    where, fs = _hadoop(spark, path)
    fs.delete(where, True)


def replace_folders(spark: SparkSession, source: str, target: str, like: str) -> None:
    """Move the folders of ``source`` with this beginning to ``target``, in the place of those of the same name. Broken off,
    it can be called again."""
    where, fs = _hadoop(spark, source)
    into, _ = _hadoop(spark, target)
    fs.mkdirs(into)
    for found in fs.listStatus(where):
        name = found.getPath().getName()
        if name.startswith(like):
            kept = _hadoop(spark, f"{target}/{name}")[0]
            fs.delete(kept, True)
            if not fs.rename(found.getPath(), kept):
                raise OSError(f"cannot move {name} to {target}")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for clusters where it is not installed."""
    context = spark.sparkContext
    if getattr(context, "_tariffmill_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tariffmill-")) / "tariffmill.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent).as_posix())
    # Spark serves the driver's copy to every executor
    context.addPyFile(str(archive))
    context._tariffmill_shipped = True
