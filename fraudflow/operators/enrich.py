"""Deduplication and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup(df: DataFrame, key: list[str] | str = "txn_id", order: list[str] | None = None, last: bool = False) -> DataFrame:
    """The first row of each key by ``order``, or the ``last``; ties go by all other columns, so the choice is fixed."""
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in df.columns if c not in keys and c not in (order or [])]
    w = Window.partitionBy(*keys).orderBy(*(F.desc(c) if last else c for c in order or []), *rest)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def enrich(txn: DataFrame, cards: DataFrame) -> DataFrame:
    """Card attributes beside each transaction; unmatched ones keep nulls (E1, and E2 on a stream).

    The join is left to Spark: it broadcasts the cards when their size allows
    and shuffles both sides otherwise.
    """
    return txn.join(cards, "card_id", "left")


def unmatched(txn: DataFrame, cards: DataFrame) -> DataFrame:
    """Transactions without a card."""
    return txn.join(cards, "card_id", "left_anti")


def asof(left: DataFrame, right: DataFrame, by: str, left_us: str, right_us: str, values: list[str]) -> DataFrame:
    """Each left row with the ``values`` of the latest right row of its key at or before it.

    One shuffle by key: both sides are stacked and the last right value is
    carried forward.
    """
    inner = F.struct(*(F.col(c).alias(c) for c in values))
    l = left.select(F.col(by).alias("_by"), F.col(left_us).alias("_us"), F.lit(1).alias("_side"), F.struct("*").alias("_row"))
    r = right.select(F.col(by).alias("_by"), F.col(right_us).alias("_us"), F.lit(0).alias("_side"), inner.alias("_found"))
    w = Window.partitionBy("_by").orderBy("_us", "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = l.unionByName(r, allowMissingColumns=True).withColumn("_last", F.last("_found", ignorenulls=True).over(w))
    return both.where("_side = 1").select("_row.*", *(F.col("_last").getField(c).alias(f"asof_{c}") for c in values))
