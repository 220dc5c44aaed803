"""Session, shared folder and code shipping: what every job needs before it can run on a cluster."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()
_written: list[tuple[SparkSession, str]] = []


def build_session(app: str = "marlweave", master: str | None = None, cores: int = 8) -> SparkSession:
    """A session with the settings the engine expects; an existing one is reused."""
    return (
        SparkSession.builder.master(master or f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MARLWEAVE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, unless PYTHONPATH already does."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    if str(PACKAGE.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    target = Path(tempfile.mkdtemp(prefix="marlweave-ship-")) / "marlweave.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(PACKAGE.rglob("*.py")):
            z.write(p, p.relative_to(PACKAGE.parent))
    sc.addPyFile(str(target))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or an own one in local mode if it is unset."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not at:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="marlweave-shared-")
        sc.setCheckpointDir(at)
        return sc._jsc.sc().getCheckpointDir().get()
    return at


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    _written.append((spark, at))
    return spark.read.schema(df.schema).parquet(at)


@contextmanager
def temporary_tables() -> Iterator[None]:
    """What is materialized inside is removed at the end: for long sessions, around a query whose result has been taken or written by then."""
    mark = len(_written)
    try:
        yield
    finally:
        drop_written(mark)


@atexit.register
def drop_written(keep: int = 0) -> None:
    """Remove the tables written by materialize(), but for the first `keep`."""
    while len(_written) > keep:
        spark, at = _written.pop()
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the JVM is gone
            return


def splits(spark: SparkSession) -> int:
    """Partitions of a shuffle that is to keep every core busy."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
