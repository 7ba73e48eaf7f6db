"""Sums of doubles that do not depend on the order in which rows arrive.

So a repeated or restarted run gives the same figures. Values are grouped by their band of exponents
as well as by the keys. Within a band they are whole multiples of one unit and are added as
decimals, exactly. Each key's few bands are then added in fixed order. One method holds for all
sizes; infinities and NaN are summed apart.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.numbers import band, put_together, units


def summed(
    frame: DataFrame,
    keys: Sequence[Column | str],
    value: Column | str,
    name: str,
    counts: Mapping[str, Column],
) -> DataFrame:
    """Per key the ``counts``, which are added up over bands, and the sum of ``value``.

    The sum is NULL where a key has no value.
    """
    value = F.col(value) if isinstance(value, str) else value
    number = band(value)
    bands = frame.groupBy(*keys, number.alias("band")).agg(
        *[count.alias(each) for each, count in counts.items()],
        F.count(value).alias("present"),
        F.sum(units(value, number)).alias("units"),
        F.sum(F.when(F.abs(value) >= float("inf"), value)).alias("odd"),
    )
    part = F.when(F.col("units").isNotNull(), F.struct("band", "units"))
    total = put_together(F.collect_list(part))
    with_odd = F.coalesce(F.sum("odd") + total, total)
    return bands.groupBy(*bands.columns[: len(keys)]).agg(
        *[F.sum(each).alias(each) for each in counts],
        F.when(F.sum("present") > 0, with_odd).alias(name),
    )
