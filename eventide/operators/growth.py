"""Traffic profile, growth, churn, A/B and level changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: default holidays (month-day) of the daily traffic cycle
HOLIDAYS = ["01-01", "07-04", "12-25"]


def is_weekend(ts_col: str) -> Column:
    """Saturday or Sunday (Spark's dayofweek: Sunday = 1)."""
    return F.dayofweek(F.col(ts_col)).isin(1, 7)


def is_holiday(ts_col: str, holidays: list[str] | None = None) -> Column:
    """The date's month-day is in the holiday list."""
    return F.date_format(F.col(ts_col), "MM-dd").isin(holidays or HOLIDAYS)


def day_class(ts_col: str, holidays: list[str] | None = None) -> Column:
    return (F.when(is_holiday(ts_col, holidays), "holiday")
            .when(is_weekend(ts_col), "weekend").otherwise("workday"))


def hourly_profile(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """events per hour of day."""
    return df.groupBy(F.hour(ts_col).cast("long").alias("hour")) \
        .agg(F.count(F.lit(1)).alias("n_events"))


def weekday_profile(df: DataFrame, ts_col: str = "ts",
                    holidays: list[str] | None = None) -> DataFrame:
    """events, distinct days and events per day by day class."""
    return df.groupBy(day_class(ts_col, holidays).alias("day_class")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_distinct(F.to_date(ts_col)).alias("n_days"),
    ).withColumn("events_per_day", F.col("n_events") / F.col("n_days"))


def user_growth(df: DataFrame, user_col: str = "user_id", ts_col: str = "ts") -> DataFrame:
    """new users per day (by first event) and the running total.

    The running total is a window over the per-day table (one row per day),
    so its single ordered partition is bounded by the number of days.
    """
    first = df.groupBy(user_col).agg(F.min(ts_col).alias("_first"))
    per_day = first.groupBy(F.to_date("_first").alias("date")) \
        .agg(F.count(F.lit(1)).alias("new_users"))
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return per_day.withColumn("total_users", F.sum("new_users").over(w))


def latest_state(df: DataFrame, user_col: str = "user_id", order: list[str] | None = None,
                 cols: list[str] | None = None) -> DataFrame:
    """Last value of ``cols`` per user (``max_by`` on the order; partial
    aggregate, so a hot user is combined map-side)."""
    order = order or ["ts"]
    key = F.struct(*[F.col(c) for c in order])
    cols = cols or ["auth", "level"]
    return df.groupBy(user_col).agg(*[F.max_by(F.col(c), key).alias(f"last_{c}") for c in cols])


def churned_users(df: DataFrame, churned_value: str = "Cancelled", user_col: str = "user_id",
                  auth_col: str = "auth", order: list[str] | None = None) -> DataFrame:
    """F16: users whose latest auth state is the churned one."""
    last = latest_state(df, user_col, order, [auth_col])
    return last.where(F.col(f"last_{auth_col}") == churned_value)


def tag_comparison(df: DataFrame, tag_col: str = "tag", user_col: str = "user_id",
                   item_col: str = "item_in_session") -> DataFrame:
    """users, events, sessions and events per user by A/B tag.

    A session counts under the tag of its first row (item 0), so users are
    the only distinct count and the rows are not expanded."""
    return df.groupBy(tag_col).agg(
        F.count_distinct(user_col).alias("users"),
        F.count(F.lit(1)).alias("events"),
        F.sum((F.col(item_col) == 0).cast("long")).alias("sessions"),
    ).withColumn("events_per_user", F.col("events") / F.col("users"))


def level_changes(df: DataFrame, ts_col: str = "ts", page_col: str = "page") -> DataFrame:
    """upgrades and downgrades per day (conditional sums, one pass)."""
    p = F.col(page_col)
    return df.where(p.isin("Submit Upgrade", "Submit Downgrade")) \
        .groupBy(F.to_date(ts_col).alias("date")).agg(
            F.sum(F.when(p == "Submit Upgrade", 1).otherwise(0)).cast("long").alias("upgrades"),
            F.sum(F.when(p == "Submit Downgrade", 1).otherwise(0)).cast("long").alias("downgrades"))
