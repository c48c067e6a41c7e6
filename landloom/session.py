"""Session factory and lineage cutting."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "landloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; keyword names use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: `spark.checkpoint.dir` of the session.

    Only where the session names none (tests on one machine) a local folder is
    made and set, so that every later call uses the same one.
    """
    given = spark.sparkContext._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="landloom-")
        atexit.register(shutil.rmtree, named[len("file://"):], ignore_errors=True)
    spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


_written: list[tuple[SparkSession, str]] = []


def _remove(spark: SparkSession, path: str) -> None:
    try:
        if path.startswith("file:"):
            shutil.rmtree(path.replace("file://", "").replace("file:", ""), ignore_errors=True)
        else:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone; the folder belongs to the cluster then
        pass


def _remove_written() -> None:
    for spark, path in _written:
        _remove(spark, path)


atexit.register(_remove_written)


def discard(spark: SparkSession, path: str, *, now: bool = False) -> None:
    """Remove a table of the shared folder, at exit or at once."""
    _written.append((spark, path))
    if now:
        _remove(*_written.pop())


def cut(df: DataFrame, name: str = "step") -> DataFrame:
    """Write `df` as a table in the shared folder and read it again.

    Cuts the lineage, survives the loss of executors, and stays compressed and
    columnar, so later reads prune columns. The table is removed at exit.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per context, wherever the driver found it."""
    context = spark.sparkContext
    if getattr(context, "_landloom_shipped", False):
        return spark
    source = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="landloom-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, f"{os.path.basename(source)}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for place, _, files in os.walk(source):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(place, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(source)))
    context.addPyFile(archive)
    context._landloom_shipped = True
    return spark
