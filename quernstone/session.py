"""Session helpers: shared scratch space, tables written between steps, code for executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(app: str = "quernstone", cores: int | str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def is_local(master: str) -> bool:
    """Whether driver and executors are one process; ``local-cluster`` is not."""
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only where the session names none and runs on one machine, as in tests, a temporary folder takes
    its place; on a cluster its executors would each write to a disk of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not is_local(spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quernstone-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


_STEP_FOLDER: ContextVar[str | None] = ContextVar("step folder", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path that nothing else uses, below the shared folder or that of the step at hand."""
    return f"{_STEP_FOLDER.get() or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def step_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for all scratch tables of a step, deleted behind it.

    What the step returns has to be written elsewhere before the end, to a path taken before the start.
    """
    path = scratch_path(spark, "step")
    mark = _STEP_FOLDER.set(path)
    try:
        yield path
    finally:
        _STEP_FOLDER.reset(mark)
        remove(spark, path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back with its schema."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apart(df: DataFrame, *keys: str) -> DataFrame:
    """``df``, an aggregate by ``keys``, dealt out once more by a hash of them.

    A join on ``keys`` then needs an exchange on either side, and adaptive execution can split the other
    side where a key is hot; beside a bare aggregate it cannot.
    """
    return df.repartition(F.xxhash64(*keys))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file of the shared folder, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def forget(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`stored`, once nothing reads it any more."""
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        remove(df.sparkSession, folder)


_SHIPPED: set[str] = set()


def ship_packages(spark: SparkSession) -> None:
    """Send this package to executors that do not share the driver's folders, once per application.

    The archive only has to be readable by the driver; Spark copies it to every executor.
    """
    context = spark.sparkContext
    if is_local(context.master) or context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="quernstone-"), "quernstone.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for package in ("quernstone", "checks"):
            for folder, _, names in os.walk(os.path.join(root, package)):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, root))
    context.addPyFile(archive)
