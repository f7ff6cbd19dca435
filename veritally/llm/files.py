"""Binary files in the shared folder, and the manifest that says which of them count.

A task writes files under names of its own; only names that reach the manifest, which Spark's
committer writes, are ever read. Files of lost or repeated attempts are left unread.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from veritally.session import shared_folder


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_folder(spark)}/veritally/{kind}-{uuid.uuid4().hex}"


def _at(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def create(folder: str, suffix: str):
    """(path, stream) of a new file; the folder is made where it is missing."""
    path = f"{folder}/{uuid.uuid4().hex}{suffix}"
    system, name = _at(path)
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    return path, system.open_output_stream(name, compression=None)


def open_for_reading(path: str):
    system, name = _at(path)
    return system.open_input_file(name)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever it is installed on the driver; once per context."""
    context = spark.sparkContext
    if getattr(context, "_veritally_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    path, stream = create(new_folder(spark, "code"), ".zip")
    with stream:
        stream.write(packed.getvalue())
    context.addPyFile(path)
    context._veritally_shipped = True
