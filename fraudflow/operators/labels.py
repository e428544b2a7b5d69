"""Labels and training sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudflow.functions.columns import HOUR_US

HORIZON_US = 6 * HOUR_US
CUTOFF_US = 1_706_486_400_000_000  # 2024-01-29


def _near(reports: DataFrame, horizon: int) -> DataFrame:
    """Each report (card_id, report_us) in its own time bucket and the one before, where its transactions are."""
    at = F.expr(f"report_us div {horizon}")
    return reports.where("card_id IS NOT NULL AND report_us IS NOT NULL").withColumn("_bucket", F.explode(F.array(at, at - 1)))


def attach_labels(txn: DataFrame, reports: DataFrame, horizon: int = HORIZON_US) -> DataFrame:
    """Label 1 if a report (card_id, report_us) for the card lands within ``horizon`` after the transaction.

    Transactions and reports lie in one order by card and time bucket, so a card
    with many rows is spread over its buckets, a row is shuffled once, and
    repeated ids keep a label each. A null card or time has label 0.
    """
    near = _near(reports.select("card_id", "report_us"), horizon)
    near = near.select("card_id", "_bucket", F.col("report_us").alias("_at"), F.col("report_us").alias("_report_us"))
    rows = txn.withColumns({"_bucket": F.expr(f"event_us div {horizon}"), "_at": F.col("event_us"), "_txn": F.lit(True)})
    later = Window.partitionBy("card_id", "_bucket").orderBy(-F.col("_at")).rangeBetween(Window.unboundedPreceding, -1)
    first = F.min("_report_us").over(later)
    both = rows.unionByName(near, allowMissingColumns=True).withColumn("_first", first).where("_txn")
    found = F.when(F.col("_first") <= F.col("event_us") + horizon, F.col("_first"))
    return both.withColumn("label_us", found).withColumn("label", F.col("label_us").isNotNull().cast("int")).drop("_bucket", "_at", "_report_us", "_txn", "_first")


def attach_labels_stream(txn: DataFrame, reports: DataFrame, horizon: int = HORIZON_US, delay: str = "2 days") -> DataFrame:
    """The same of two streams, with event_ts and report_ts; a row comes out once its label can change no more.

    An interval join, outer on the side of the transactions, then the first
    report of each. Both states end with the watermark: a transaction is kept
    for ``delay`` and ``horizon``, a report for ``delay``.
    """
    left = txn.select("txn_id", "card_id", "event_us", "event_ts", F.expr(f"event_us div {horizon}").alias("_bucket")).withWatermark("event_ts", delay)
    right = _near(reports.select(F.col("card_id").alias("_card"), "report_us", "report_ts", "card_id"), horizon)
    right = right.select("_card", "report_us", "report_ts", F.col("_bucket").alias("_near")).withWatermark("report_ts", delay)
    inside = F.expr(f"_card = card_id AND _near = _bucket AND report_ts > event_ts AND report_ts <= event_ts + INTERVAL {horizon // 1_000_000} SECONDS")
    found = left.join(right, inside, "left_outer").select("txn_id", "card_id", "event_us", "event_ts", "report_us")
    first = found.groupBy("event_ts", "txn_id", "card_id", "event_us").agg(F.min("report_us").alias("label_us"))
    return first.withColumn("label", F.col("label_us").isNotNull().cast("int"))


def mature(df: DataFrame, cutoff_us: int = CUTOFF_US, horizon: int = HORIZON_US) -> DataFrame:
    """Rows whose label can change no more; open ones are unknown, not 0."""
    return df.where(F.col("event_us") + horizon <= cutoff_us)


def split(df: DataFrame, t1: int, t2: int) -> DataFrame:
    """Train, validation and test by time (T4)."""
    part = F.when(F.col("event_us") < t1, "train").when(F.col("event_us") < t2, "validation").otherwise("test")
    return df.withColumn("part", part)


def weights(train: DataFrame) -> DataFrame:
    """Weight of each class for a balanced sum (T5)."""
    counts = train.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("classes"))
    return counts.crossJoin(F.broadcast(total)).select("label", "n", (F.col("total").cast("double") / (F.col("classes") * F.col("n"))).alias("weight"))
