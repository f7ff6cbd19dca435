"""Runtime settings the plans rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot account or id even where a later stage then has to shuffle once more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="veritally-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_folder(spark: SparkSession, kind: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(spark)}/veritally/{kind}-{uuid.uuid4().hex}"


def written(rows: DataFrame) -> DataFrame:
    """Write rows to the shared folder and read them back: later jobs start from the files."""
    path = f"{shared_folder(rows.sparkSession)}/veritally/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def side_by_side(spark: SparkSession, jobs: list[Callable[[], T]], at_once: int = 4) -> list[T]:
    """What functions return that start jobs of their own and do not depend on each other, some of them at once."""
    with ThreadPoolExecutor(min(len(jobs), at_once)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(lambda job: job()), jobs))


def written_together(frames: list[DataFrame]) -> list[DataFrame]:
    """Write frames that do not depend on each other as concurrent jobs."""
    shared_folder(frames[0].sparkSession)
    return side_by_side(frames[0].sparkSession, [lambda f=f: written(f) for f in frames], len(frames))
