"""Column expressions shared by the silver and gold jobs.

All of them are built-in Spark expressions, so they stay inside whole-stage codegen.

Numbers are kept exact: durations are whole seconds turned into DECIMAL minutes, money
is DECIMAL cents, and means are rounded half-up with integer arithmetic. Summing doubles
would make the result depend on the order rows arrive in, which differs between runs and
between engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values of the reference: age brackets (inclusive bounds) and the label for the rest,
# which also takes NULL ages and ages under 13.
AGE_BRACKETS = [(13, 17, "13-17"), (18, 25, "18-25"), (26, 35, "26-35"), (36, 45, "36-45")]
AGE_BRACKET_OTHER = "45+"

# Decimal reading of a double before rounding: 12 places absorb binary noise, so a value
# meant as a short decimal rounds as written (1.005 -> 1.01, 3.4499999999999993 -> 3.45),
# the same in Spark and in the DuckDB oracle.
_DEC = "decimal(38,12)"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def age_bracket(age: ColumnOrName) -> Column:
    """CASE WHEN age BETWEEN lo AND hi ... ELSE '45+'."""
    age = _col(age)
    expr = None
    for lo, hi, label in AGE_BRACKETS:
        cond = age.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(AGE_BRACKET_OTHER)


def whole_seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """end - start after truncating each to whole seconds (BIGINT)."""
    return F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))


def duration_minutes(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Session length in minutes, one decimal, half-up, as DECIMAL(10,1)."""
    secs = whole_seconds_between(start, end).cast("decimal(20,0)")
    return F.round(secs / F.lit(60).cast("decimal(20,0)"), 1).cast("decimal(10,1)")


def round_decimal(x: ColumnOrName, places: int) -> Column:
    """Half-up rounding of a number to ``places`` decimals, as DECIMAL(18, places)."""
    return F.round(_col(x).cast(_DEC), places).cast(f"decimal(18,{places})")


def money(x: ColumnOrName) -> Column:
    """An amount rounded half-up to cents, DECIMAL(18,2)."""
    return round_decimal(x, 2)


def scaled_units(x: ColumnOrName, places: int) -> Column:
    """A value as a BIGINT count of 10**-places units (cents for 2, tenths for 1)."""
    return (round_decimal(x, places) * (10**places)).cast("long")


def half_up_mean(total_units: ColumnOrName, n: ColumnOrName, places: int) -> Column:
    """ROUND(total / n, 2) half-up, where ``total`` is a BIGINT count of 10**-places units.

    Exact integer floor division in DECIMAL(38,0): the remainder and the quotient of an
    exact multiple are exact, so the result does not depend on summation order or on the
    size of the sums (no double conversion, no BIGINT overflow). NULL when ``n`` is zero or
    NULL.
    """
    total, n = _col(total_units), _col(n)
    dec = "decimal(38,0)"
    num = F.abs(total).cast(dec) * F.lit(2 * 10 ** (2 - places)).cast(dec) + n.cast(dec)
    den = n.cast(dec) * F.lit(2).cast(dec)
    hundredths = ((num - F.pmod(num, den)) / den).cast(dec)
    return F.when(n > 0, (F.signum(total) * hundredths.cast("double")) / 100.0)


def units_to_double(total_units: ColumnOrName, places: int) -> Column:
    """A BIGINT count of 10**-places units back to a DOUBLE value."""
    return _col(total_units).cast("double") / float(10**places)


def normalise_label(x: ColumnOrName) -> Column:
    """INITCAP(LOWER(x)): 'iOS' becomes 'Ios', 'WIN' becomes 'Win'."""
    return F.initcap(F.lower(_col(x)))


def title_case(x: ColumnOrName) -> Column:
    """INITCAP(x): Spark lower-cases the rest of each word too."""
    return F.initcap(_col(x))
