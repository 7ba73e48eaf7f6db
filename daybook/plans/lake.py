"""Where a deployment keeps its tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from daybook import schemas
from daybook.operators.editions import Publication, enter, published, vacuum
from daybook.operators.sinks import create_empty, register_table, show_partitions


@dataclass(frozen=True)
class Lake:
    """Paths of the tables, of the catalogue by which quotes and metrics change together, and the
    database that shows the metrics in SQL, if any."""

    bronze: str
    quotes: str
    metrics: str
    project_metrics: str
    arrivals: str
    quarantine: str
    catalogue: str
    database: str | None = None

    @classmethod
    def under(cls, root: str, database: str | None = None) -> Lake:
        root = root.rstrip("/")
        return cls(
            bronze=f"{root}/transactions",
            quotes=f"{root}/quotes",
            metrics=f"{root}/daily_metrics",
            project_metrics=f"{root}/daily_project_metrics",
            arrivals=f"{root}/arrivals",
            quarantine=f"{root}/quarantine",
            catalogue=f"{root}/_catalogue",
            database=database,
        )

    def _shown(self) -> dict[str, tuple[str, str]]:
        """Path and columns of the tables that a database shows."""
        return {
            "daily_metrics": (self.metrics, schemas.METRICS),
            "daily_project_metrics": (self.project_metrics, schemas.PROJECT_METRICS),
        }

    def create(self, spark: SparkSession) -> None:
        """Creates what does not exist yet; rows already there stay."""
        create_empty(spark, self.arrivals, schemas.ARRIVALS)
        enter(spark, self.quotes, self.catalogue, "quotes")
        enter(spark, self.quarantine, self.catalogue, "quarantine")
        for name, (path, schema) in self._shown().items():
            enter(spark, path, self.catalogue, name)
            if self.database:
                register_table(spark, f"{self.database}.{name}", path, schema)
                partitions = published(spark, self.catalogue)[1].get(name, {})
                show_partitions(spark, f"{self.database}.{name}", path, partitions)

    def publish(self, spark: SparkSession, run: Publication) -> None:
        """Makes all that a run wrote the current state at once, and shows it in SQL."""
        run.publish()
        if self.database:
            for name, (path, _) in self._shown().items():
                changed = {part: run.tables[name].get(part) for part in run.changed.get(name, ())}
                show_partitions(spark, f"{self.database}.{name}", path, changed)

    def vacuum(self, spark: SparkSession, keep: int = 2) -> None:
        """Removes what the last ``keep`` publications do not name; not while a run is writing."""
        vacuum(spark, self.catalogue, (self.quotes, self.quarantine, *[p for p, _ in self._shown().values()]), keep)
