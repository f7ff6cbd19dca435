from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from veritally.plans import inject  # noqa: E402
from veritally.session import configure, written  # noqa: E402
from veritally.sources import driver_tables  # noqa: E402
from veritally.sources.extract import landed  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def cfg():
    return driver_tables.CONFIG


@pytest.fixture(scope="session")
def clean(spark):
    return landed(driver_tables.clean_extract(spark, SF_DIR), written)


@pytest.fixture(scope="session")
def planted(spark, clean, cfg):
    return inject.Planted(clean, cfg, natural=driver_tables.natural_transactions(spark, SF_DIR, cfg))


@pytest.fixture(scope="session")
def dirty(planted):
    return landed(planted.dirty, written)


@pytest.fixture(scope="session")
def manifest(planted):
    return written(planted.manifest())


@pytest.fixture(scope="session")
def planted_keys(manifest) -> dict[str, set[str]]:
    keys: dict[str, set[str]] = {}
    for row in manifest.collect():
        keys.setdefault(row.defect_id, set()).add(row.key)
    return keys
