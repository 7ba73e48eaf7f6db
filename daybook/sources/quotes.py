"""Price quotes and landed quote responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import schemas
from daybook.constants import QUOTE_DATE_FORMAT
from daybook.functions.json_fields import member_or, with_member
from daybook.functions.prices import response_price
from daybook.operators.editions import read_partitions


def read_quote_objects(
    spark: SparkSession, path: str, symbol: str | None = None
) -> DataFrame:
    """Quotes kept as one JSON object per symbol and day: ``{symbol}/{date}.json``.

    Symbol and date come from the object's path. An unreadable body is a quote without a
    price; an empty object, or one not named after a date, is no quote. ``symbol`` lists that
    folder only.
    """
    if symbol is not None:
        path = f"{path.rstrip('/')}/{symbol}"
    objects = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .option("wholetext", True)
        .text(path)
        # The path is percent-encoded, in which a plus sign stands for itself.
        .withColumn("key", F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))))
    )
    parts = F.split("key", "/")
    day = F.replace(F.element_at(parts, -1), F.lit(".json"), F.lit(""))
    return with_member(objects, "price", "value", "price").select(
        F.element_at(parts, -2).alias("symbol"),
        F.to_date(F.try_to_timestamp(day, F.lit(QUOTE_DATE_FORMAT))).alias("date"),
        member_or("price", None).try_cast("double").alias("price"),
    ).where(F.col("date").isNotNull())


def read_quotes(spark: SparkSession, path: str) -> DataFrame:
    """Quotes kept as Parquet, partitioned by symbol."""
    return read_partitions(spark, path, schemas.QUOTES).select("symbol", "date", "price")


def quotes_of(quotes: DataFrame, *symbols: str) -> DataFrame:
    """Quotes of the named symbols; other partitions are not read."""
    return quotes.where(F.col("symbol").isin(*symbols))


def read_responses(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    """Landed answers of the quote provider: symbol, date, status_code, body."""
    return spark.read.schema(schemas.RESPONSES).format(file_format).load(path)


def stream_responses(
    spark: SparkSession,
    path: str,
    file_format: str = "json",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Answers of the quote provider as they arrive in a folder."""
    reader = spark.readStream.schema(schemas.RESPONSES).format(file_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def response_quotes(responses: DataFrame) -> DataFrame:
    """Quote carried by each response; NULL price where it failed or has none."""
    return responses.select("symbol", "date", response_price("status_code", "body").alias("price"))
