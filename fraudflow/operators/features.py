"""Rolling features.

Per-card frames end before the current instant, so no transaction sees itself
or one of the same instant. Frames with the same key and order are made in one
select, hence with one shuffle and one sort. A window partition is one task;
``spread`` cuts cards with very many rows into time buckets, with what their
frames reach before each bucket as a halo.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudflow.functions.columns import HOUR_US


def trailing(hours: int):
    """The ``hours`` before the current instant of a card."""
    return Window.partitionBy("card_id").orderBy("event_us").rangeBetween(-hours * HOUR_US, -1)


def _by_time():
    return Window.partitionBy("card_id").orderBy("event_us", "txn_id")


def velocity_columns(hours: tuple[int, ...] = (1, 24, 168)) -> dict[str, Column]:
    return {f"cnt_{h}h": F.count(F.lit(1)).over(trailing(h)) for h in hours}


def amount_columns(hours: int = 168) -> dict[str, Column]:
    w = trailing(hours)
    total, n = F.sum("amount_cents").over(w), F.count("amount_cents").over(w)
    return {f"sum_{hours}h": total, f"avg_{hours}h": total.cast("double") / F.nullif(n, F.lit(0)), f"min_{hours}h": F.min("amount_cents").over(w), f"max_{hours}h": F.max("amount_cents").over(w)}


def _deviation(hours: int) -> Column:
    """Population standard deviation from integer sums."""
    w = trailing(hours)
    n, s = F.count("amount_cents").over(w), F.sum("amount_cents").over(w)
    square = F.sum(F.col("amount_cents") * F.col("amount_cents")).over(w)
    return F.sqrt((n * square - s * s).cast("double")) / F.nullif(n, F.lit(0))


def velocity(df: DataFrame, hours: tuple[int, ...] = (1, 24, 168)) -> DataFrame:
    """Transactions of the card in trailing windows."""
    return df.withColumns(velocity_columns(hours))


def rolling_amount(df: DataFrame, hours: int = 168) -> DataFrame:
    """Trailing sum, mean, least and largest amount (R2)."""
    return df.withColumns(amount_columns(hours))


def rolling_dispersion(df: DataFrame, hours: int = 168) -> DataFrame:
    """Trailing standard deviation."""
    return df.withColumn(f"std_{hours}h", F.round(_deviation(hours), 6))


def amount_vs_history(df: DataFrame, hours: int = 168) -> DataFrame:
    """Ratio to the trailing mean and z-score; null without history or spread."""
    mean, spread = amount_columns(hours)[f"avg_{hours}h"], _deviation(hours)
    cold = df.withColumns({"_mean": mean, "_spread": F.nullif(spread, F.lit(0.0))})
    return cold.withColumns({"amount_ratio": F.round(F.col("amount_cents") / F.nullif("_mean", F.lit(0.0)), 6), "amount_z": F.round((F.col("amount_cents") - F.col("_mean")) / F.col("_spread"), 6)}).drop("_mean", "_spread")


def txn_gap(df: DataFrame) -> DataFrame:
    """Microseconds since the card's previous transaction."""
    return df.withColumn("gap_us", F.col("event_us") - F.lag("event_us").over(_by_time()))


def distinct_categories(df: DataFrame, hours: int = 168) -> DataFrame:
    """Different categories in the trailing window."""
    return df.withColumn(f"categories_{hours}h", F.size(F.collect_set("category").over(trailing(hours))).cast("long"))


def last_n(df: DataFrame, n: int = 10) -> DataFrame:
    """Mean amount of the last ``n`` transactions."""
    w = _by_time().rowsBetween(-n, -1)
    return df.withColumn(f"avg_last_{n}", F.sum("amount_cents").over(w).cast("double") / F.nullif(F.count("amount_cents").over(w), F.lit(0)))


def first_seen(df: DataFrame) -> DataFrame:
    """Whether it is the card's first transaction in its category."""
    w = Window.partitionBy("card_id", "category").orderBy("event_us", "txn_id")
    return df.withColumn("is_first_in_category", F.row_number().over(w) == 1)


def category_baseline(df: DataFrame) -> DataFrame:
    """The amount against the category's mean of all earlier days.

    Sums are made per category and day before anything is ordered, so a large
    category costs a row a day.
    """
    daily = df.groupBy("category", "event_date").agg(F.sum("amount_cents").alias("s"), F.count("amount_cents").alias("n"))
    w = Window.partitionBy("category").orderBy("event_date").rowsBetween(Window.unboundedPreceding, -1)
    base = daily.select("category", "event_date", (F.sum("s").over(w).cast("double") / F.sum("n").over(w)).alias("category_mean"))
    return df.join(base, ["category", "event_date"], "left").withColumn("category_ratio", F.round(F.col("amount_cents") / F.col("category_mean"), 6))


def _windowed(df: DataFrame, window: Column) -> DataFrame:
    out = df.groupBy(window.alias("w"), "card_id").agg(F.count(F.lit(1)).alias("cnt"), F.sum("amount_cents").alias("sum_cents"))
    return out.select("card_id", F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "cnt", "sum_cents")


def tumbling(df: DataFrame, size: str = "1 day") -> DataFrame:
    """Count and sum per card and window; on a stream with a watermark too."""
    return _windowed(df, F.window("event_ts", size))


def sliding(df: DataFrame, size: str = "1 day", slide: str = "6 hours") -> DataFrame:
    """Overlapping windows."""
    return _windowed(df, F.window("event_ts", size, slide))


def session(df: DataFrame, gap: str = "2 hours") -> DataFrame:
    """Bursts of a card, split where nothing happens for ``gap``."""
    return _windowed(df, F.session_window("event_ts", gap))


def top_cards(df: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` cards that spend most each day."""
    daily = df.groupBy("event_date", "card_id").agg(F.sum("amount_cents").alias("sum_cents"))
    w = Window.partitionBy("event_date").orderBy(F.desc("sum_cents"), "card_id")
    return daily.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hot_cards(df: DataFrame, rows: int) -> DataFrame:
    """Cards (card_id) with more than ``rows`` rows: those that one task should not hold."""
    return df.groupBy("card_id").agg(F.count(F.lit(1)).alias("rows")).where((F.col("rows") > rows) & F.col("card_id").isNotNull()).select("card_id")


def _bucket(size: int) -> Column:
    return F.expr(f"(event_us - pmod(event_us, {size})) div {size}")


def spread(df: DataFrame, hours: int, add: Callable[[DataFrame], DataFrame], bucket_hours: int | None = None, hot: DataFrame | None = None) -> DataFrame:
    """``add(df)`` with the cards in ``hot`` (all, if None) cut into time buckets.

    ``add`` may make any frames of ``trailing`` up to ``hours``. Each row goes to
    the bucket of its time, and as a halo to the next ones that its frames can
    reach: once more at most where a bucket is as long as the frames, the
    default. Halo rows fill frames and do not come out. What ``add`` partitions
    by the card is partitioned by card and bucket, so the rows of a card are
    spread over as many tasks as it has buckets, still in one shuffle.
    """
    reach, size = hours * HOUR_US, (bucket_hours or hours) * HOUR_US
    own = _bucket(size)
    inside = F.filter(F.sequence(F.lit(0), F.lit(-(-reach // size))), lambda k: (k == 0) | ((own + k) * size - F.col("event_us") <= reach))
    if hot is None:
        rows = df.withColumn("_hot", F.lit(True))
    else:
        rows = df.join(hot.select("card_id", F.lit(True).alias("_hot")), "card_id", "left").select(*df.columns, F.coalesce("_hot", F.lit(False)).alias("_hot"))
    # a row without a time has no bucket, and keeps its one place
    rows = rows.withColumn("_k", F.explode(F.when(F.col("_hot") & F.col("event_us").isNotNull(), inside).otherwise(F.array(F.lit(0)))))
    rows = rows.withColumn("card_id", F.struct("card_id", F.when(F.col("_hot"), own + F.col("_k")).alias("bucket")))
    return add(rows).where("_k = 0").withColumn("card_id", F.col("card_id.card_id")).drop("_k", "_hot")


def spread_features(df: DataFrame, hot: DataFrame | None = None, hours: int = 168) -> DataFrame:
    """``all_features`` with the cards in ``hot`` (all, if None) cut into time buckets.

    The gap to a transaction before the halo comes from the last one of each
    earlier bucket: one row for each bucket of a card.
    """
    size = hours * HOUR_US
    made = spread(df, hours, all_features, hot=hot).withColumn("_bucket", _bucket(size))
    cut = df if hot is None else df.join(hot, "card_id", "left_semi")
    ends = cut.groupBy("card_id", _bucket(size).alias("_bucket")).agg(F.max("event_us").alias("_end"))
    before = ends.withColumn("_end", F.lag("_end").over(Window.partitionBy("card_id").orderBy("_bucket"))).where("_end IS NOT NULL")
    before = before.select(F.col("card_id").alias("_card"), F.col("_bucket").alias("_at"), "_end")
    out = made.join(before, F.col("card_id").eqNullSafe(F.col("_card")) & (F.col("_bucket") == F.col("_at")), "left")
    return out.withColumn("gap_us", F.coalesce("gap_us", F.col("event_us") - F.col("_end"))).select(*df.columns, *(c for c in made.columns if c not in df.columns and c != "_bucket"))


def all_features(df: DataFrame) -> DataFrame:
    """What the model and the rule score use, with one shuffle."""
    return df.withColumns({**velocity_columns(), **amount_columns(), "gap_us": F.col("event_us") - F.lag("event_us").over(_by_time())})
