"""Text rendering of numbers and times, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetpulse.functions.times import DAY_MICROS, utc_day

# Far beyond any measure; from here on 20*x leaves the exact integers of a
# double, and Java's own formatting is used.
_EXACT_LIMIT = 1e14


def one_decimal(column: str) -> Column:
    """The column with one decimal, rounding the exact binary value half to even.

    ``format_string`` rounds the shortest decimal text half up instead, so
    175.35 (which is stored slightly below) would print as 175.4.

    With s = fl(20|x|), the integer part of s decides the digit and only a
    whole odd s can be a tie. The sign of the exact residual 20|x| - s settles
    it: both 16|x| and 4|x| are exact, and so are the two differences.
    """
    size = f"abs({column})"
    scaled = f"({size} * 20D)"
    whole = f"floor({scaled})"
    residual = f"({size} * 4D - ({scaled} - {size} * 16D))"
    round_down = (
        f"({scaled} = CAST({whole} AS DOUBLE) AND {whole} % 2 = 1"
        f" AND ({residual} < 0D OR ({residual} = 0D AND {whole} % 4 = 1)))"
    )
    tenths = f"(shiftright({whole} + 1, 1) - CASE WHEN {round_down} THEN 1 ELSE 0 END)"
    digits = f"concat(CASE WHEN {column} < 0D OR CAST({column} AS STRING) = '-0.0' THEN '-' ELSE '' END, {tenths} div 10, '.', {tenths} % 10)"
    words = f"replace(lower(format_string('%.1f', {column})), 'infinity', 'inf')"
    return F.expr(
        f"CASE WHEN {size} < {_EXACT_LIMIT}D THEN {digits} WHEN {size} >= {_EXACT_LIMIT}D THEN {words} END"
    )


def iso_timestamp(ts: Column) -> Column:
    """ISO-8601 text in UTC, without zone; the fraction is left out when it is zero.

    The text does not depend on the session's zone.
    """
    micros = F.pmod(F.unix_micros(ts), F.lit(DAY_MICROS))

    def part(unit: int, size: int, digits: int) -> Column:
        value = F.pmod(F.call_function("div", micros, F.lit(unit)), F.lit(size))
        return F.lpad(value.cast("string"), digits, "0")

    hours, minutes, seconds = part(3_600_000_000, 24, 2), part(60_000_000, 60, 2), part(1_000_000, 60, 2)
    whole = F.concat(utc_day(ts).cast("string"), F.lit("T"), hours, F.lit(":"), minutes, F.lit(":"), seconds)
    fraction = part(1, 1_000_000, 6)
    return F.when(fraction == "000000", whole).otherwise(F.concat(whole, F.lit("."), fraction))


def or_none_text(text: Column) -> Column:
    """Absent values are printed as the word ``None`` in messages."""
    return F.coalesce(text.cast("string"), F.lit("None"))
