"""Refresh for the dates touched by newly arrived transactions and quotes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daybook.constants import COIN_IDS
from daybook.operators.ledger import enter_files, files_of, forget, new_files, new_label, unfinished
from daybook.operators.sinks import land, unland
from daybook.plans.lake import Lake
from daybook.plans.refresh import refresh
from daybook.session import settled


def refresh_on_arrival(
    transactions: DataFrame,
    lake: Lake,
    name: str,
    checkpoint: str,
    coin_ids: Mapping[str, str] = COIN_IDS,
    gather: bool = False,
) -> StreamingQuery:
    """Handles all files that are there now and stops; started again, it takes up the new ones.

    ``transactions`` comes from ``stream_transactions``. Each batch is landed under a label that starts
    with ``name``, and the dates it touches are recomputed whole from everything landed so far. The lake
    keeps a ledger of the files taken up under ``name`` (see ``operators.ledger``): a file counts once even if
    the stream's ``checkpoint`` is lost or another one is used, and a batch that failed half way is taken
    back and done again. A record whose date cannot be read stops the stream.
    """

    def handle(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        touched = set()
        for label in unfinished(spark, lake.arrivals, name):
            touched.update(unland(spark, lake.bronze, label))
            forget(spark, lake.arrivals, label)
        files = settled(new_files(spark, lake.arrivals, files_of(batch)))
        label = None if files.isEmpty() else new_label(name)
        if label is not None:
            enter_files(files, lake.arrivals, label, done=False)
            # the names of a batch's files are with the driver already; a join by shuffle would take a file to one task
            taken = batch.join(F.broadcast(files), ["file", "size"], "left_semi")
            touched.update(land(taken, lake.bronze, label, gather))
        if touched:
            refresh(spark, lake, [day for day in touched if day], coin_ids=coin_ids)
        if label is not None:
            enter_files(files, lake.arrivals, label, done=True)

    lake.create(transactions.sparkSession)
    return (
        transactions.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def reprice_on_arrival(
    responses: DataFrame, lake: Lake, checkpoint: str, coin_ids: Mapping[str, str] = COIN_IDS
) -> StreamingQuery:
    """Takes up all answers of the quote provider that are there now and stops.

    ``responses`` comes from ``stream_responses``. Usable quotes are stored, and the dates for which they are
    now the price of the day or the last known one are valued again; records are not read. An answer
    for a day that has no transactions yet waits in the store. Quotes that are stored already stay, so
    answers that arrive again change nothing, and no ledger is needed: whichever of transactions and
    answers comes first, the figures are those of one refresh over all.
    """

    def handle(batch: DataFrame, _: int) -> None:
        refresh(batch.sparkSession, lake, dates=[], responses=batch, coin_ids=coin_ids)

    lake.create(responses.sparkSession)
    return (
        responses.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
