"""Row-wise features (E4, E5) and the rule score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000


def time_features(df: DataFrame) -> DataFrame:
    """Hour, day of week (Sunday 1), weekend and night flags, in UTC."""
    hour = F.expr(f"CAST(pmod(event_us div {HOUR_US}, 24) AS INT)")
    day = F.dayofweek("event_date")
    return df.withColumns({"hour": hour, "day_of_week": day, "is_weekend": day.isin(1, 7), "is_night": (hour < 6) | (hour >= 22)})


def amount_features(df: DataFrame) -> DataFrame:
    """Log of the amount, and its band of 50.00 up to 500.00 (E5)."""
    return df.withColumns({"log_amount": F.round(F.log1p(F.col("amount_cents") / 100.0), 6), "amount_band": F.expr("CAST(width_bucket(amount_cents, 0, 50000, 10) AS INT)")})


def rule_score() -> Column:
    """0 to 100 from velocity and the amount against history."""
    high = F.when(F.col("amount_cents") > 3 * F.col("avg_168h"), 50).otherwise(0)
    return F.least(F.lit(100), 10 * F.col("cnt_1h") + 5 * F.col("cnt_24h") + high).cast("int")
