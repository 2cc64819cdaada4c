"""Column expressions shared by the operators. All of them stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"
GOLD_MONEY = "decimal(18,2)"

# Category repairs, first match wins.
CATEGORY_RULES = [
    ("contains", "BBQ Plateshttps", "BBQ Plates"),
    ("contains", "Drip Chttps", "Drip Coffee"),
    ("contains", "Kid'shttps", "Kids"),
    ("equals", "Kid's", "Kids"),
    ("equals", "Sqalads", "Salads"),
    ("equals", "Bowls0", "Bowls"),
    ("startswith", "Sandwiches", "Sandwiches"),
]


def repair_category(category: Column, rules: list[tuple[str, str, str]] = CATEGORY_RULES) -> Column:
    """Map broken category names to clean ones; a value no rule matches is kept."""
    repaired = category
    for test, text, clean in reversed(rules):
        match = category == text if test == "equals" else getattr(category, test)(text)
        repaired = F.when(match, F.lit(clean)).otherwise(repaired)
    return repaired


def to_money(text: Column) -> Column:
    """Text or number to DECIMAL(10,2); NULL where it does not parse or fit."""
    return text.try_cast(MONEY)


def to_count(text: Column) -> Column:
    """Text to INT, cutting a fraction ('2.9' is 2); NULL where it does not parse or fit."""
    return text.try_cast("decimal(20,4)").try_cast("int")


def zero_if_null(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0))


def to_gold_money(amount: Column) -> Column:
    return amount.cast(GOLD_MONEY)


def mean(amount: Column) -> Column:
    """Mean as one exact sum over one count, so that the result does not depend on the order of rows."""
    return F.try_divide(F.sum(amount).cast("double"), F.count(amount).cast("double"))


def share(part: Column, whole: Column) -> Column:
    """part / whole in percent, NULL for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def percent_one_decimal(part: Column, whole: Column) -> Column:
    """part / whole of two counts in percent, rounded to one decimal, ties to even, in whole numbers throughout."""
    thousandths = part.cast("bigint") * 1000
    whole = F.nullif(whole.cast("bigint"), F.lit(0))
    down = ((thousandths - thousandths % whole) / whole).cast("bigint")
    twice = (thousandths % whole) * 2
    up = (twice > whole) | ((twice == whole) & (down % 2 == 1))
    return ((down + up.cast("int")).cast("decimal(18,0)") * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(5,1)")


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def calendar_columns(day: Column) -> dict[str, Column]:
    return {
        "day_of_week": F.date_format(day, "EEEE"),
        "is_weekend": is_weekend(day),
        "month_name": F.date_format(day, "MMMM"),
        "month_number": F.month(day),
        "week_number": F.weekofyear(day),
        "year": F.year(day),
    }


def season(month: Column) -> Column:
    """Season of a month number. A missing month falls to Fall, as every other unmatched value does."""
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Fall")
    )


def location_label(app_name: Column, restaurant_id: Column) -> Column:
    return F.concat(app_name, F.lit(" (#"), F.substring(restaurant_id, -6, 6), F.lit(")"))


def loyalty_label(is_loyalty: Column) -> Column:
    """Loyalty Member / Non-Member; an unknown flag stays NULL."""
    return F.when(is_loyalty, "Loyalty Member").when(~is_loyalty, "Non-Member")


def order_type(option_revenue: Column) -> Column:
    return F.when(option_revenue > 0, "With Paid Add-ons").otherwise("Base Order Only")


def churn_flag(days_inactive: Column, active_days: int = 30, at_risk_days: int = 90) -> Column:
    return (
        F.when(days_inactive <= active_days, "Active")
        .when(days_inactive <= at_risk_days, "At Risk")
        .otherwise("Churned")
    )


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "VIP")
        .when((f <= 2) & (r >= 4), "New Customer")
        .when((r <= 2) & (f <= 2), "Churn Risk")
        .otherwise("Regular")
    )
