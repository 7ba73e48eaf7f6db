"""Raw transactions: CSV deliveries and the landed copy."""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook import schemas
from daybook.session import children, matching, read_text

#: In the folder of landed records: a small file per label that names the folder that holds.
DELIVERIES = "_deliveries"

# --- fixed value: the folder of a partition without a value ---
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# --- end of fixed values ---

# A quote inside a quoted cell is doubled. enforceSchema=false makes a file whose header
# differs from the first one fail instead of being read by position.
_CORRUPT = "_line"
_CSV = {"header": True, "escape": '"', "enforceSchema": False}


def read_transactions(
    spark: SparkSession, path: str | list[str], multi_line: bool = False
) -> DataFrame:
    """Transactions of CSV files with a header; columns are found by name, others ignored.

    Spark splits large files at line breaks. A record torn by a break inside a cell does not pass: what
    is left of its JSON cells is not a JSON object, and ``extract`` raises. ``multi_line`` reads
    such files, each in one task.
    """
    return (
        spark.read.options(**_CSV, multiLine=multi_line).csv(path).select(*schemas.RAW_COLUMNS)
    )


def read_with_rejects(
    spark: SparkSession, path: str | list[str], multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Transactions of CSV files, and the lines that do not have one cell for each column.

    The second frame has the ``line`` as it stands, how many ``cells`` of it were read, its ``file`` and the ``block`` of the file in which it is, by
    the offset where the block starts. All files have the columns of the first one's header.
    """
    header = spark.read.options(**_CSV).csv(path).columns
    columns = ", ".join(f"`{name.replace('`', '``')}` string" for name in (*header, _CORRUPT))
    # All cells are parsed, those of unused columns as well, so that each line is looked at whole.
    lines = (
        spark.read.options(**_CSV, multiLine=multi_line, columnPruning=False)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .schema(columns)
        .csv(path)
    )
    corrupt = F.col(_CORRUPT)
    cells = F.size(F.array_compact(F.array(*[F.col(f"`{name.replace('`', '``')}`") for name in header])))
    # Spark refuses to read the column of corrupt lines alone, so the conditions mention the others.
    good = lines.where(corrupt.isNull() & (cells >= 0)).select(*schemas.RAW_COLUMNS)
    bad = lines.where(corrupt.isNotNull() & (cells >= 0)).select(
        corrupt.alias("line"),
        cells.alias("cells"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return good, bad


def from_lines(lines: DataFrame, repaired: Column, header: list[str]) -> DataFrame:
    """``lines`` with the transaction that ``repaired``, an expression of ``line``, holds.

    ``unread`` is the repaired line where it does not have one cell for each name of ``header``.
    """
    columns = ", ".join(f"`{name.replace('`', '``')}` string" for name in (*header, _CORRUPT))
    options = {"escape": '"', "columnNameOfCorruptRecord": _CORRUPT}
    parsed = lines.withColumn("cells", F.from_csv(repaired, columns, options))
    cells = [F.col("cells")[name].alias(name) for name in schemas.RAW_COLUMNS]
    return parsed.select("line", "file", "block", *cells, F.col("cells")[_CORRUPT].alias("unread"))


def stream_transactions(
    spark: SparkSession,
    path: str,
    header: str = schemas.RAW,
    max_files_per_trigger: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Transactions of CSV files as they arrive in a folder, with the ``file`` and its ``size``.

    ``header`` lists all columns of the files in their order, as a stream cannot look them up.
    """
    reader = spark.readStream.schema(header).options(**_CSV, multiLine=multi_line)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path).select(
        *[F.col(c).cast("string") for c in schemas.RAW_COLUMNS],
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
    )


def deliveries(spark: SparkSession, path: str, batch: str | None = None) -> dict[str, dict]:
    """What is kept of each label, or of one: its ``edition`` and the ``records`` of each date."""
    folder = f"{path}/{DELIVERIES}"
    names = children(spark, folder) if batch is None else [batch] * matching(spark, f"{folder}/{batch}")
    return {n: json.loads(read_text(spark, f"{folder}/{n}")) for n in names if not n.startswith("_")}


def landed_records(
    spark: SparkSession, path: str, batch: str | None = None
) -> dict[datetime.date | None, int]:
    """How many records each date has, of all labels or one, as counted when they were landed."""
    total: dict[datetime.date | None, int] = {}
    for delivery in deliveries(spark, path, batch).values():
        for name, records in delivery["records"].items():
            day = None if name == NO_VALUE else datetime.date.fromisoformat(name)
            total[day] = total.get(day, 0) + records
    return total


def read_landed(
    spark: SparkSession,
    path: str,
    dates: Iterable[datetime.date | None] | None = None,
    batch: str | None = None,
) -> DataFrame:
    """Landed transactions, all or those of some dates or one batch; the date None is that of
    records without a date.

    Only the folders asked for are listed, so that a refresh of one date does not go through
    the names of all files ever landed.
    """
    asked = None if dates is None else {NO_VALUE if day is None else str(day) for day in dates}
    folders = []
    for name, delivery in deliveries(spark, path, batch).items():
        edition = f"{path}/batch={name}/edition={delivery['edition']}"
        if asked is None:
            folders += [edition] * bool(delivery["records"])
        else:
            folders += [f"{edition}/date={day}" for day in sorted(asked & delivery["records"].keys())]
    if not folders:
        return spark.createDataFrame([], schemas.BRONZE)
    reader = spark.read.schema(schemas.BRONZE).option("basePath", path)
    return reader.parquet(*folders).select(*StructType.fromDDL(schemas.BRONZE).names)
