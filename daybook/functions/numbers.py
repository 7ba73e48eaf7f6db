"""Numbers read from text, summed and written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the spellings of a number that are accepted in text ---
_DIGITS = r"\d+(?:_\d+)*"
NUMBER = rf"^\s*[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\s*$"
NOT_A_NUMBER = r'(?i)^\s*"?[+-]?nan"?\s*$'
INFINITE = r'(?i)^\s*"?[+-]?inf(?:inity)?"?\s*$'
# --- end of fixed values ---


def number(text: Column) -> Column:
    """Double spelled by ``text``, or NULL if it does not spell one.

    The bare JSON tokens ``NaN`` and ``Infinity`` arrive wrapped in double quotes.
    """
    return (
        F.when(text.rlike(NUMBER), F.translate(text, "_", "").try_cast("double"))
        .when(text.rlike(NOT_A_NUMBER), F.lit(float("nan")))
        .when(text.rlike(INFINITE), F.translate(text, '"', "").try_cast("double"))
    )


def without_nan(value: Column | str) -> Column:
    """NaN becomes NULL, so that count and sum skip it."""
    return F.nanvl(value, F.lit(None))


#: Doubles whose exponents lie in one band of this width are multiples of one unit.
_BAND = 8


def band(value: Column) -> Column:
    """Number of the band of exponents of a double; NULL for zero, NaN and infinities."""
    return F.when(F.abs(value) < float("inf"), F.floor(F.log2(F.abs(value)) / _BAND))


def _scaled(value: Column, exponent: Column) -> Column:
    """``value * 2**exponent``, in two steps, as the power itself may be out of range."""
    half = F.floor(exponent / 2)
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), exponent - half)


def _unit(number: Column) -> Column:
    """Exponent of a band's unit, fine enough for the last bit of the smallest double in it."""
    return number * _BAND - 54


def units(value: Column, number: Column) -> Column:
    """A double as a whole multiple of its band's unit, below 2**63 and exact."""
    return _scaled(value, -_unit(number)).cast("bigint").cast("decimal(28,0)")


def _exact_parts(part: Column) -> Column:
    """Doubles that add up to a band's sum: its multiple of the unit in three pieces."""
    high = F.call_function("div", part["units"], F.lit(1 << 53))
    low = part["units"] - high.cast("decimal(19,0)") * F.lit(1 << 53).cast("decimal(17,0)")
    unit = _unit(part["band"])
    return F.array(
        _scaled(F.shiftright(high, 31).cast("double"), unit + 84),
        _scaled(high.bitwiseAND(F.lit((1 << 31) - 1)).cast("double"), unit + 53),
        _scaled(low.cast("double"), unit),
    )


def put_together(sums: Column) -> Column:
    """The sum of bands (structs of ``band`` and ``units``), from the highest band down.

    What each addition of doubles rounds off is added at the end.
    """
    parts = F.flatten(F.transform(F.sort_array(sums, asc=False), _exact_parts))

    def add(state: Column, value: Column) -> Column:
        total = state["total"] + value
        larger = F.abs(state["total"]) >= F.abs(value)
        lost = F.when(larger, state["total"] - total + value).otherwise(
            value - total + state["total"]
        )
        return F.struct(total.alias("total"), (state["lost"] + lost).alias("lost"))

    start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("lost"))
    return F.aggregate(
        parts,
        start,
        add,
        lambda state: F.when(F.abs(state["total"]) < float("inf"), state["total"] + state["lost"])
        .otherwise(state["total"]),
    )


def with_cents(value: Column | str) -> Column:
    """Two decimals and thousands separators: 1,234.50."""
    return F.coalesce(F.format_number(value, 2), F.lit("nan"))


def plain_cents(value: Column | str) -> Column:
    """Two decimals without separators: 1234.50."""
    return F.replace(with_cents(value), F.lit(","), F.lit(""))
