"""First load: land a delivery and append its raw volumes per project."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession

from daybook import schemas
from daybook.operators.extraction import extract
from daybook.operators.editions import Publication
from daybook.operators.sinks import as_table, land, required
from daybook.operators.updates import on_dates
from daybook.operators.volumes import project_metrics
from daybook.plans.lake import Lake
from daybook.session import settled
from daybook.sources.transactions import read_landed, read_transactions


def initial_load(
    spark: SparkSession,
    csv: str | list[str],
    lake: Lake,
    batch: str | None = None,
    multi_line: bool = False,
    gather: bool = False,
) -> int:
    """Lands the CSV files, appends volumes per date and project, returns the rows added.

    Without a label the batch is named after the paths, so another delivery is another batch, and
    the same one landed again replaces itself. The append is an append: a second call for the same
    batch doubles its project rows. ``refresh`` rewrites whole dates instead.
    """
    lake.create(spark)
    if batch is None:
        paths = [csv] if isinstance(csv, str) else sorted(csv)
        batch = "load-" + hashlib.sha256("\n".join(paths).encode()).hexdigest()[:16]
    land(read_transactions(spark, csv, multi_line), lake.bronze, batch, gather)
    run = Publication(spark, lake.catalogue)
    rows = as_table(project_metrics(extract(read_landed(spark, lake.bronze, batch=batch))), schemas.PROJECT_METRICS)
    new = settled(required(rows, schemas.PROJECT_METRICS_REQUIRED))
    former = on_dates(run.read(lake.project_metrics, schemas.PROJECT_METRICS), new.select("date").distinct())
    run.replace_written(former.unionByName(new), lake.project_metrics, "date")
    lake.publish(spark, run)
    return new.count()
