"""Written tables: stages other jobs read back, and the sections of the report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veritally.session import side_by_side

PLACES = ("a", "b")


class VersionedTable:
    """A parquet table that is replaced as a whole and can be read at any time.

    It has two places and a commit mark for each. A write goes to the place that is not current,
    through Spark's committer, and is marked with the next number when it is complete; the mark
    with the highest number says which place is read. So a write that dies leaves the last version as it was, a
    rerun overwrites what the dead one left, and there are never more than two versions. Readers of a
    version that has been replaced have until the next write but one. One writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _marks(self) -> dict[str, Row]:
        try:
            rows = self.spark.read.schema("place string, number long, label string").json(f"{self.folder}/commit-*").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        return {r.place: r for r in rows}

    def _current(self) -> Row | None:
        return max(self._marks().values(), key=lambda m: m.number, default=None)

    @property
    def version(self) -> int:
        """The number of the current version, 0 where none has been written."""
        mark = self._current()
        return mark.number if mark else 0

    @property
    def label(self) -> str | None:
        """What the current version was written under."""
        mark = self._current()
        return mark.label if mark else None

    def write(self, rows: DataFrame, order: tuple[str, ...] = (), partition_by: str | None = None, label: str | None = None) -> DataFrame:
        """Replace the table and read it back. Files are sorted by ``order``; with ``partition_by`` each
        value is one folder with one file, which suits report tables of bounded size."""
        numbers = {place: mark.number for place, mark in self._marks().items()}
        place = min(PLACES, key=lambda p: numbers.get(p, 0))
        if partition_by:
            rows = rows.repartition(partition_by)
        writer = (rows.sortWithinPartitions(*order) if order else rows).write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{self.folder}/data-{place}")
        number = max(numbers.values(), default=0) + 1
        mark = self.spark.range(1, numPartitions=1).select(
            F.lit(place).alias("place"), F.lit(number).cast("long").alias("number"), F.lit(label).cast("string").alias("label"))
        mark.write.mode("overwrite").json(f"{self.folder}/commit-{place}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.folder}/data-{place}")

    def read(self, schema: StructType | None = None) -> DataFrame:
        mark = self._current()
        if mark is None:
            raise FileNotFoundError(f"{self.folder}: no version has been written")
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(f"{self.folder}/data-{mark.place}")


def written_table(
    rows: DataFrame, path: str, order: tuple[str, ...] = (), partition_by: str | None = None, label: str | None = None
) -> DataFrame:
    """Replace the table at ``path`` and read it back, so later jobs start from the files. A table that was
    written under the same ``label`` already is only read."""
    table = VersionedTable(rows.sparkSession, path)
    if label is not None and table.label == label:
        return table.read(rows.schema)
    return table.write(rows, order, partition_by, label)


def write_sections(sections: Mapping[str, DataFrame], folder: str, label: str | None = None) -> None:
    """Sections do not depend on each other: their jobs run side by side."""
    spark = next(iter(sections.values())).sparkSession
    side_by_side(spark, [lambda n=name, r=rows: written_table(r, f"{folder}/{n}", label=label) for name, rows in sections.items()])


def read_section(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return VersionedTable(spark, f"{folder}/{name}").read()
