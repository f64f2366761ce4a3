"""The business questions posed next to the reference's tables (Q9, Q10, Q12-Q14).

Each answer is one grouped aggregate over whole tables; map-side partial aggregation
keeps the shuffle at one row per group and map task, whatever the skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meeple.functions.exprs import half_up_mean, normalise_label, scaled_units, units_to_double
from meeple.plans.segments import INACTIVE, inactive_condition


def user_categories(aged_demographics: DataFrame, rule: str = "rate", **params) -> DataFrame:
    """Q9: users per category (Active / Inactive) under an inactive rule.

    NULL predicate results (e.g. a zero account age) count as Active, as they do when
    active users are all users minus the inactive ones.
    """
    inactive = F.coalesce(inactive_condition(rule, **params), F.lit(False))
    category = F.when(inactive, INACTIVE).otherwise("Active")
    return aged_demographics.groupBy(category.alias("category")).agg(
        F.count(F.lit(1)).alias("users")
    )


def hourly_activity(sessions: DataFrame) -> DataFrame:
    """Q10: sessions and distinct players per start hour over all days, busiest first."""
    return (
        sessions.groupBy(F.hour("start_time").alias("hour"))
        .agg(F.count(F.lit(1)).alias("sessions"), F.count_distinct("user_id").alias("players"))
        .orderBy(F.col("sessions").desc(), F.col("hour").asc_nulls_last())
    )


def user_base_makeup(demographics: DataFrame) -> DataFrame:
    """Q12: users per age bracket and gender."""
    return demographics.groupBy("age_bracket", "gender").agg(F.count(F.lit(1)).alias("users"))


def user_base_by_country(demographics: DataFrame) -> DataFrame:
    """Q12: users per age bracket, gender and country."""
    return demographics.groupBy("age_bracket", "gender", "country").agg(F.count(F.lit(1)).alias("users"))


def users_by_country(demographics: DataFrame) -> DataFrame:
    """Q12: users per country."""
    return demographics.groupBy("country").agg(F.count(F.lit(1)).alias("users"))


def device_usage(logins: DataFrame) -> DataFrame:
    """Q13: logins and distinct users per device (normalised label), most used first."""
    device = normalise_label("device_type").alias("device")
    return (
        logins.groupBy(device)
        .agg(F.count(F.lit(1)).alias("logins"), F.count_distinct("user_id").alias("users"))
        .orderBy(F.col("logins").desc(), F.col("device").asc_nulls_last())
    )


def _earnings(purchases: DataFrame, keys: list[str]) -> DataFrame:
    cents = F.sum(scaled_units("amount", 2))
    n = F.count("amount")
    return purchases.groupBy(*keys).agg(
        units_to_double(cents, 2).alias("revenue"),
        n.alias("purchases"),
        half_up_mean(cents, n, 2).alias("avg_amount"),
    )


def earnings_by_item(purchases: DataFrame) -> DataFrame:
    """Q14: revenue, purchases and mean amount per item."""
    return _earnings(purchases, ["item"])


def earnings_by_day(purchases: DataFrame) -> DataFrame:
    """Q14: revenue, purchases and mean amount per day."""
    return _earnings(purchases, ["event_date"])


def total_earnings(purchases: DataFrame) -> DataFrame:
    """Q14: total revenue over all purchases (one row)."""
    return _earnings(purchases, [])
