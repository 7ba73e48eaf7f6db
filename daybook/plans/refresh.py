"""Conversion to dollars and its daily repetition.

Everything is derived from landed records and stored quotes, and a date is always written
whole, so a run can be repeated, or repeated after a failure, without changing the outcome. All that a
run writes is seen at once, when it publishes.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook import schemas
from daybook.constants import COIN_IDS
from daybook.functions.prices import usable
from daybook.operators.extraction import extract
from daybook.operators.editions import Publication
from daybook.operators.pricing import valued
from daybook.operators.quote_store import merged_quotes, missing_quotes
from daybook.operators.sinks import as_table, required, store_quotes
from daybook.operators.updates import on_dates, repriced, updated
from daybook.operators.volumes import all_volumes, price_keys, project_metrics_of, with_keys
from daybook.plans.lake import Lake
from daybook.session import settled
from daybook.sources.metrics import read_metrics
from daybook.sources.quotes import quotes_of, read_quotes, response_quotes
from daybook.sources.transactions import read_landed


#: The name under which control totals of the records read are kept.
SOURCE = "source"


def _metrics_counts() -> dict[str, Column]:
    """Kept of each date of the metrics, counted in what was written."""
    nulls = {f"null_{n}": F.count(F.when(F.col(n).isNull(), 1)) for n in schemas.METRICS_REQUIRED}
    return {"rows": F.count("*"), "transactions": F.sum("num_transactions"), **nulls}


def worklist(
    spark: SparkSession, lake: Lake, coin_ids: Mapping[str, str] = COIN_IDS
) -> DataFrame:
    """Quotes that the metrics need and the store lacks."""
    return missing_quotes(
        price_keys(read_metrics(spark, lake.metrics)), read_quotes(spark, lake.quotes), coin_ids
    )


def add_quotes(
    spark: SparkSession,
    lake: Lake,
    responses: DataFrame,
    coin_ids: Mapping[str, str] = COIN_IDS,
    run: Publication | None = None,
) -> DataFrame | None:
    """Stores the usable quotes among ``responses``; returns where prices may differ now.

    That is ``symbol``, ``first`` and ``last``: from each new quote to the day of the next one of its
    symbol, whose own price may be missing; ``last`` is NULL after the newest. Only symbols the provider
    knows are taken, and only their partitions are rewritten. None if nothing changed. As part of
    ``run`` they are seen by others when it publishes.
    """
    run, own = _run(spark, lake, run)
    symbols = list(coin_ids)
    stored = quotes_of(run.read(lake.quotes, schemas.QUOTES), *symbols)
    fetched = quotes_of(response_quotes(responses), *symbols)
    merged = settled(merged_quotes(stored, fetched))
    had = stored.where(usable("price").isNotNull())
    following = F.lead("date").over(Window.partitionBy("symbol").orderBy("date"))
    new = merged.withColumn("last", following).where(usable("price").isNotNull())
    changed = settled(
        new.join(had, ["symbol", "date"], "left_anti").select("symbol", F.col("date").alias("first"), "last")
    )
    if changed.isEmpty():
        return None
    store_quotes(merged, lake.quotes, run)
    if own:
        lake.publish(spark, run)
    return changed


def reprice(
    spark: SparkSession,
    lake: Lake,
    changed: DataFrame,
    but_not: Iterable[datetime.date] = (),
    coin_ids: Mapping[str, str] = COIN_IDS,
    run: Publication | None = None,
) -> None:
    """Values metrics rows again on the dates that have a symbol within a changed span.

    The records are left alone. Only the partitions of those dates are read, by a join on the
    partition column.
    """
    run, own = _run(spark, lake, run)
    metrics = run.read(lake.metrics, schemas.METRICS)
    keys = metrics.select("currency_symbol", "date").distinct()
    newest = keys.agg(F.max("date")).first()[0]
    if newest is None:
        return
    last = F.least(F.coalesce("last", F.lit(newest)), F.lit(newest))
    days = changed.where(F.col("first") <= F.lit(newest)).select(
        F.col("symbol").alias("currency_symbol"), F.explode(F.sequence("first", last)).alias("date")
    )
    touched = keys.join(days.distinct(), ["currency_symbol", "date"]).select("date").distinct()
    if but_not := list(but_not):
        touched = touched.where(~F.col("date").isin(but_not))
    rows = on_dates(metrics, settled(touched))
    quotes = run.read(lake.quotes, schemas.QUOTES)
    fresh = as_table(repriced(rows, quotes, coin_ids), schemas.METRICS)
    run.replace_written(fresh, lake.metrics, "date", _metrics_counts())
    if own:
        lake.publish(spark, run)


def apply_valuations(spark: SparkSession, lake: Lake, valuations: DataFrame) -> None:
    """Updates the stored metrics rows for which ``valuations`` has a price, all dates at once."""
    run = Publication(spark, lake.catalogue)
    new = settled(valuations.where(F.col("price").isNotNull()))
    rows = on_dates(run.read(lake.metrics, schemas.METRICS), new.select("date").distinct())
    fresh = as_table(updated(rows, new), schemas.METRICS)
    run.replace_written(fresh, lake.metrics, "date", _metrics_counts())
    lake.publish(spark, run)


def refresh(
    spark: SparkSession,
    lake: Lake,
    dates: Iterable[datetime.date] | None = None,
    responses: DataFrame | None = None,
    coin_ids: Mapping[str, str] = COIN_IDS,
) -> None:
    """Recomputes the given dates, or all, from landed records and replaces their partitions.

    A date that has no rows any more is left without rows.

    Responses of the quote provider are stored first. A new quote can also change later dates
    for which it is now the last known one; those are repriced.

    The records are read and parsed once: both tables come from the settled group volumes. Quotes
    and both tables are published together at the end; a run that fails changes nothing.
    """
    run = Publication(spark, lake.catalogue)
    changed = add_quotes(spark, lake, responses, coin_ids, run) if responses is not None else None
    dates = None if dates is None else [day for day in dates if day is not None]
    # Records without a date are read along: one whose date cannot be read stops the job.
    asked = None if dates is None else [*dates, None]
    volumes = settled(all_volumes(extract(read_landed(spark, lake.bronze, asked))))

    if dates is not None and changed is not None:
        reprice(spark, lake, changed, but_not=dates, coin_ids=coin_ids, run=run)
    projects = as_table(project_metrics_of(volumes), schemas.PROJECT_METRICS)
    projects = required(projects, schemas.PROJECT_METRICS_REQUIRED)
    run.replace(projects, lake.project_metrics, dates)
    quotes = run.read(lake.quotes, schemas.QUOTES)
    metrics = valued(with_keys(volumes, *schemas.METRICS_KEY), quotes, coin_ids)
    run.replace(as_table(metrics, schemas.METRICS), lake.metrics, dates, _metrics_counts())
    _keep_control_totals(run, volumes, dates)
    lake.publish(spark, run)


def _keep_control_totals(
    run: Publication, volumes: DataFrame, dates: list[datetime.date] | None
) -> None:
    """How many records the run read for each date, and how many of them metrics rows must count."""
    keyed = F.forall(F.array(*[F.col(x).isNotNull() for x in schemas.METRICS_KEY]), lambda x: x)
    countable = F.sum(F.when(keyed, F.col("num_transactions")).otherwise(0))
    counted = volumes.groupBy("date").agg(
        F.sum("records").alias("records"), countable.alias("countable")
    )
    run.keep_facts(SOURCE, counted, None if dates is None else [f"date={day}" for day in dates])


def _run(spark: SparkSession, lake: Lake, run: Publication | None) -> tuple[Publication, bool]:
    """The run, or a new one that its user publishes."""
    return (Publication(spark, lake.catalogue), True) if run is None else (run, False)
