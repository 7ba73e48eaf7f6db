"""Tables that change together, all partitions at once.

Each write of a run goes below a folder of its own, ``{table}/edition={id}/date=...``. Which edition
holds for which partition of which table is said by a catalogue: a folder of small numbered files, of
which the newest counts. A run that ends publishes one file for all its tables; a run that is
killed before leaves folders that no file names, and readers see what they saw. A reader keeps the
editions it found when it started. The file of a number is made under another name and renamed, which
file systems do in one step (object stores without a rename need a client that has one); a second
run that wants the same number fails and can be repeated.

The driver holds one entry per partition, nothing of the rows.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from daybook.session import children, matching, read_text, remove_folder, write_text

#: In a table's folder: where its catalogue is, and the table's name there.
_HOME = "_catalogue"

#: Folder name of a partition, such as ``date=2024-04-15``, to the edition that holds for it.
Partitions = dict[str, str]
#: Counts of one partition, by name.
Facts = dict[str, int]


def catalogued(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """Catalogue and name of the table at ``path``, if it has one."""
    if not matching(spark, f"{path}/{_HOME}"):
        return None
    home = json.loads(read_text(spark, f"{path}/{_HOME}"))
    return home["catalogue"], home["table"]


def enter(spark: SparkSession, path: str, catalogue: str, table: str) -> None:
    """Lets the table at ``path`` be read by the catalogue; it has no rows at first."""
    if catalogued(spark, path) is None:
        write_text(spark, f"{path}/{_HOME}", json.dumps({"catalogue": catalogue, "table": table}))


def _numbers(spark: SparkSession, catalogue: str) -> list[int]:
    return sorted(int(name) for name in children(spark, catalogue) if name.isdigit())


def _publication(spark: SparkSession, catalogue: str, number: int) -> dict[str, dict]:
    return json.loads(read_text(spark, f"{catalogue}/{number:012d}"))


def published(spark: SparkSession, catalogue: str) -> tuple[int, dict[str, Partitions]]:
    """Number of the newest publication, and the editions of each table's partitions."""
    number, newest = _newest(spark, catalogue)
    return number, newest["tables"]


def published_facts(spark: SparkSession, catalogue: str) -> dict[str, dict[str, Facts]]:
    """What was counted of each table's partitions when they were written."""
    return _newest(spark, catalogue)[1]["facts"]


def _newest(spark: SparkSession, catalogue: str) -> tuple[int, dict[str, dict]]:
    numbers = _numbers(spark, catalogue)
    if not numbers:
        return 0, {"tables": {}, "facts": {}}
    return numbers[-1], _publication(spark, catalogue, numbers[-1])


def _read(
    spark: SparkSession, path: str, schema: str | StructType, partitions: Partitions
) -> DataFrame:
    if not partitions:
        return spark.createDataFrame([], schema)
    names = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).names
    folders = [f"{path}/edition={edition}/{name}" for name, edition in sorted(partitions.items())]
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*folders).select(*names)


def read_partitions(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path`` as published last, or all of a folder that has no catalogue."""
    home = catalogued(spark, path)
    if home is None:
        return spark.read.schema(schema).parquet(path)
    catalogue, table = home
    return _read(spark, path, schema, published(spark, catalogue)[1].get(table, {}))


class Publication:
    """What one run writes, unseen by others until ``publish``."""

    def __init__(self, spark: SparkSession, catalogue: str):
        self.spark, self.catalogue = spark, catalogue
        number, newest = _newest(spark, catalogue)
        self.number = number + 1
        self.tables: dict[str, Partitions] = newest["tables"]
        self.facts: dict[str, dict[str, Facts]] = newest["facts"]
        self.changed: dict[str, set[str]] = {}

    def read(self, path: str, schema: str) -> DataFrame:
        """The table at ``path`` as this run leaves it so far."""
        _, table = catalogued(self.spark, path)
        return _read(self.spark, path, schema, self.tables.get(table, {}))

    def replace(
        self,
        rows: DataFrame,
        path: str,
        dates: Iterable[datetime.date] | None = None,
        counts: dict[str, Column] | None = None,
    ) -> None:
        """Writes ``rows`` in place of the given dates, or of the whole table.

        Of the given dates, those without rows have none any more. ``counts`` are kept per date, counted in
        what was written.
        """
        _, table = catalogued(self.spark, path)
        before = self.tables.get(table, {})
        gone = set(before) if dates is None else {f"date={day}" for day in dates} & set(before)
        self._write(rows, path, "date", gone, counts)

    def replace_written(
        self, rows: DataFrame, path: str, column: str, counts: dict[str, Column] | None = None
    ) -> None:
        """Writes ``rows`` in place of the partitions by ``column`` that occur in them."""
        self._write(rows, path, column, set(), counts)

    def replace_partition(self, rows: DataFrame, path: str, column: str, value: str) -> None:
        """Writes ``rows``, whose ``column`` is ``value``, in place of that partition; it may become empty."""
        self._write(rows, path, column, {f"{column}={value}"}, None)

    def keep_facts(self, table: str, counted: DataFrame, among: Iterable[str] | None = None) -> None:
        """Keeps counts per date, one row of ``counted`` each; a partition that has none keeps none.

        ``among`` names the partitions that the counts are about, by default all.
        """
        new = {f"date={row.date}": row.asDict() for row in counted.collect() if row.date is not None}
        for facts in new.values():
            del facts["date"]
        before = self.facts.get(table, {})
        gone = set(before if among is None else among)
        self.facts[table] = {name: facts for name, facts in before.items() if name not in gone} | new

    def _write(
        self, rows: DataFrame, path: str, column: str, gone: set[str], counts: dict[str, Column] | None
    ) -> None:
        _, table = catalogued(self.spark, path)
        edition = uuid.uuid4().hex
        folder = f"{path}/edition={edition}"
        # Adaptive execution gathers a partition's rows, splits what is large, merges what is small.
        rows.hint("rebalance", column).write.partitionBy(column).parquet(folder)
        written = {n: edition for n in children(self.spark, folder) if n.startswith(f"{column}=")}
        before = self.tables.get(table, {})
        self.tables[table] = {n: e for n, e in before.items() if n not in gone} | written
        self.changed.setdefault(table, set()).update(gone, written)
        if counts:
            found = _read(self.spark, path, rows.schema, written)
            counted = found.groupBy(column).agg(*[count.alias(name) for name, count in counts.items()])
            self.keep_facts(table, counted, gone | written.keys())

    def publish(self) -> None:
        state = {"tables": self.tables, "facts": self.facts}
        write_text(self.spark, f"{self.catalogue}/{self.number:012d}", json.dumps(state))


def vacuum(spark: SparkSession, catalogue: str, paths: Iterable[str], keep: int = 2) -> None:
    """Removes editions that none of the last ``keep`` publications names, and older publications.

    Not while a run is writing: what it has not published yet is named nowhere.
    """
    numbers = _numbers(spark, catalogue)
    named = {
        edition
        for number in numbers[-keep:]
        for partitions in _publication(spark, catalogue, number)["tables"].values()
        for edition in partitions.values()
    }
    for path in paths:
        for name in children(spark, path):
            if name.startswith("edition=") and name.removeprefix("edition=") not in named:
                remove_folder(spark, f"{path}/{name}")
    for number in numbers[:-keep]:
        remove_folder(spark, f"{catalogue}/{number:012d}")
