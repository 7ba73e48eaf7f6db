"""Raw transaction records to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook import schemas
from daybook.constants import AMOUNT_KEY, DEFAULT_AMOUNT, DEFAULT_SYMBOL, SYMBOL_KEY
from daybook.functions.dates import wall_clock_date
from daybook.functions.json_fields import member_or, with_member
from daybook.functions.numbers import number
from daybook.session import settled


def read_fields(transactions: DataFrame) -> DataFrame:
    """Typed columns next to the raw ones, plus ``problem``: the first unreadable field.

    The later columns refer to the parsed ones and do not parse again.
    """
    typed = transactions.select(
        *schemas.RAW_COLUMNS,
        wall_clock_date("ts").alias("date"),
        F.col("project_id").try_cast("bigint").alias("project"),
    )
    parsed = with_member(
        with_member(typed, "symbol", "props", SYMBOL_KEY), "value", "nums", AMOUNT_KEY
    )
    fields = parsed.withColumn("amount", number(member_or("value", DEFAULT_AMOUNT)))
    problem = (
        F.when(F.col("ts").isNotNull() & F.col("date").isNull(), F.lit("ts"))
        .when(F.col("project_id").isNotNull() & F.col("project").isNull(), F.lit("project_id"))
        .when(F.col("symbol_found").isNull(), F.lit("props"))
        .when(F.col("value_found").isNull(), F.lit("nums"))
        .when(F.col("amount").isNull(), F.lit("amount"))
    )
    return fields.select(
        *[F.col(name).alias(f"raw_{name}") for name in schemas.RAW_COLUMNS],
        "date",
        F.col("project").alias("project_id"),
        member_or("symbol", DEFAULT_SYMBOL).alias("currency_symbol"),
        "amount",
        problem.alias("problem"),
    )


def extract(transactions: DataFrame) -> DataFrame:
    """Date, project, symbol and amount of each record; an unreadable record fails the job.

    The failure is attached to ``amount``, which every volume needs.
    """
    stop = F.raise_error(F.concat(F.lit("unreadable transaction field: "), "problem"))
    return read_fields(transactions).select(
        "date",
        "project_id",
        "currency_symbol",
        F.when(F.col("problem").isNull(), F.col("amount")).otherwise(stop).alias("amount"),
    )


def extract_with_rejects(transactions: DataFrame, once: bool = False) -> tuple[DataFrame, DataFrame]:
    """Readable records as ``extract`` gives them, and the others unchanged with the problem.

    With ``once`` the parsed records are settled first, so that using both frames reads and parses
    once; else each frame reads and parses on its own when it is used.

    Each record is unfolded from a list of one or none. A filter on ``problem`` would be moved
    below the parsing and repeat it for every mention of a parsed column.
    """
    fields = read_fields(transactions)
    if once:
        fields = settled(fields)
    columns = ("date", "project_id", "currency_symbol", "amount")
    readable = F.when(F.col("problem").isNull(), F.array(F.struct(*columns)))
    unreadable = F.when(
        F.col("problem").isNotNull(),
        F.array(
            F.struct(*[F.col(f"raw_{name}").alias(name) for name in schemas.RAW_COLUMNS], "problem")
        ),
    )
    return fields.select(F.inline(readable)), fields.select(F.inline(unreadable))
