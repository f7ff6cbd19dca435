"""The raw extract: six tables whose every column is text, and the defect manifest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from veritally.operators.frames import aggregate, stacked
from veritally.sources.numbering import PLACED, numbered, placed

# Tables and columns of the extract, in file order.
COLUMNS = {
    "branches": ["branch_code", "branch_name", "city"],
    "customers": ["customer_id", "full_name", "email", "phone", "date_of_birth", "city", "kyc_status",
                  "created_at"],
    "accounts": ["account_id", "customer_id", "branch_code", "account_type", "currency",
                 "opening_balance", "opened_on", "status"],
    "transactions": ["txn_id", "account_id", "txn_ts", "amount", "currency", "direction", "channel",
                     "counterparty", "status"],
    "fx_rates": ["rate_date", "currency", "inr_rate"],
    "closing_balances": ["account_id", "as_of", "closing_balance"],
}

class Extract:
    """The tables as attributes; each is built when it is first asked for."""

    branches: DataFrame
    customers: DataFrame
    accounts: DataFrame
    transactions: DataFrame
    fx_rates: DataFrame
    closing_balances: DataFrame

    def __init__(self, **sources: Callable[[], DataFrame]):
        self._sources = sources

    def __getattr__(self, table: str) -> DataFrame:
        if table not in COLUMNS:
            raise AttributeError(table)
        rows = self._sources[table]()
        setattr(self, table, rows)
        return rows


def landed(extract: Extract, written: Callable[[DataFrame], DataFrame]) -> Extract:
    """The same extract, each table written once when it is first asked for."""
    return Extract(**{table: lambda t=table: written(getattr(extract, t)) for table in extract._sources})


def _with_header(reader: DataFrameReader, files: str | list[str], wanted: list[str], place: bool) -> DataFrame:
    """The wanted columns by their header names; Spark fails a file whose header differs from the first one's."""
    names = reader.option("inferSchema", False).csv(files).columns
    missing = [c for c in wanted if c not in names]
    if missing:
        raise ValueError(f"{files}: no column {', '.join(missing)} in the header {', '.join(names)}")
    schema = ", ".join(f"`{n}` string" for n in names)
    scan = reader.schema(schema).option("enforceSchema", False).csv(files)
    return placed(scan).select(*wanted, *PLACED) if place else scan.select(*wanted)


def _by_header(reader: DataFrameReader, path: str) -> list[list[str]]:
    """The files of a folder, those with the same header together."""
    files = sorted(reader.csv(path).inputFiles())
    groups: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        groups.setdefault(tuple(reader.option("inferSchema", False).csv(file).columns), []).append(file)
    return list(groups.values())


def read_extract(
    spark: SparkSession, folder: str, arrival: str | None = None, line_breaks: bool = False,
    mixed_headers: bool = False, row_number: str | None = None,
) -> Extract:
    """``<folder>/<table>.csv`` (a file or a folder of files) with a header; empty means NULL.

    Columns are found by their names in the header, in any order, others than the known ones are
    left out, and a missing one is an error. Files of one table must agree in their header, or the read
    fails; with ``mixed_headers`` the header of each file is looked at first. With
    ``line_breaks`` quoted values may span lines; Spark then reads each file in one task, so such an
    extract should come in many files. ``row_number`` names a column that numbers the transactions
    from 1 in the order of files and rows; as ``Config.arrival`` it makes the copy that stands first in the
    files the first one.
    """

    def read(table: str) -> DataFrame:
        path = f"{folder}/{table}.csv"
        wanted = COLUMNS[table] + ([arrival] if arrival and table == "transactions" else [])

        def reader() -> DataFrameReader:
            return spark.read.option("header", True).option("escape", '"').option("multiLine", line_breaks)

        groups = _by_header(reader(), path) if mixed_headers else [path]
        number = row_number if table == "transactions" else None
        rows = stacked([_with_header(reader(), files, wanted, bool(number)) for files in groups])
        if number:
            rows = numbered(rows, number)
        if arrival and table == "transactions":
            rows = rows.withColumn(arrival, F.col(arrival).cast("long"))
        return rows

    return Extract(**{table: lambda t=table: read(t) for table in COLUMNS})


def write_text(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_extract(extract: Extract, folder: str) -> None:
    for table in COLUMNS:
        write_text(getattr(extract, table), f"{folder}/{table}.csv")


def write_ordered(rows: DataFrame, path: str, place: str, files: int) -> None:
    """Text files that hold the rows in the order of ``place`` from the first file to the last."""
    dealt = rows.selectExpr("*", f"{place} AS _place").repartitionByRange(files, "_place").sortWithinPartitions("_place")
    write_text(dealt.drop("_place"), path)


def text_digest(columns: list[str]) -> str:
    """Aggregate: a sum that tells multisets of text rows apart, whatever the order of the rows."""
    row = ", ".join(f"coalesce({c}, '~')" for c in columns)
    return f"sum(CAST(conv(left(md5(concat_ws('|', {row})), 8), 16, 10) AS BIGINT))"


def digests(extract: Extract) -> DataFrame:
    """(table, records, digest) of the six tables."""
    return stacked([
        aggregate(getattr(extract, table), [f"'{table}' AS table"], "count(*) AS records", f"{text_digest(columns)} AS digest")
        for table, columns in COLUMNS.items()
    ])


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("defect_id string, rule_id string, key string").json(path)


def valid_currencies(raw: Extract, base_currency: str) -> DataFrame:
    rated = raw.fx_rates.select("currency")
    return rated.union(rated.sparkSession.sql(f"SELECT '{base_currency}'")).distinct()


def copy_columns(ts_utc: str, arrival: str | None) -> list[str]:
    """Which copy of an id came first: arrival, else time; equal rows are interchangeable."""
    return [arrival or ts_utc, *COLUMNS["transactions"]]

