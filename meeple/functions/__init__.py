"""Column expressions (JVM-side, codegen friendly)."""

from meeple.functions.exprs import (  # noqa: F401
    AGE_BRACKET_OTHER,
    AGE_BRACKETS,
    age_bracket,
    duration_minutes,
    title_case,
    half_up_mean,
    money,
    normalise_label,
    round_decimal,
    scaled_units,
    units_to_double,
    whole_seconds_between,
)
