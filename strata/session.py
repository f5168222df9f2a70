"""Session settings the library expects."""

from __future__ import annotations

import re
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "strata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not _on_one_machine(spark):
        ship_package(spark)
    return spark


#: A query's shuffle files go when it has ended. Otherwise they stay until the driver happens to collect garbage.
SHUFFLES_DROPPED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Bytes that a stored byte of sorted keys or repeated names takes in memory, as far as sizes of files decide on broadcasts.
UNPACKED = 32


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Queries planned inside run with these settings; afterwards the session has its own again."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def lean(spark: SparkSession) -> dict[str, str]:
    """Settings for jobs of many steps over stored tables: shuffle files of a step go when it has ended, and no table is taken for small
    because it compresses well, as the driver would have to hold it unpacked."""
    factor = "spark.sql.sources.fileCompressionFactor"
    return {**SHUFFLES_DROPPED, factor: str(max(float(spark.conf.get(factor)), UNPACKED))}


def small_splits(spark: SparkSession, size: int = 32 << 20) -> dict[str, str]:
    """Settings for tasks that sort what they read: rows take a multiple of their compressed size in memory."""
    now = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return {"spark.sql.files.maxPartitionBytes": str(min(size, now))}


def _on_one_machine(spark: SparkSession) -> bool:
    return bool(re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python workers can't import it from the driver's disk."""
    package = Path(__file__).resolve().parent
    # only the driver reads the archive; Spark's file server hands it out
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='strata-package-')}/{package.name}", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset, a session on one machine (``local[n]``) gets a new folder and keeps it for later calls; on a cluster that is
    an error, as each executor would write to its own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not _on_one_machine(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-checkpoints-"))
    return spark.sparkContext.getCheckpointDir()
