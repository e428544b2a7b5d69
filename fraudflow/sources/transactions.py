"""Reading card transactions: batch, stream, conforming and validation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Raw events, as a streaming source needs them beforehand.
RAW = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def micros(ts: str) -> Column:
    """Microseconds since 1970 of a timestamp without zone, in any session time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {ts})")


def conform(raw: DataFrame) -> DataFrame:
    """Raw events in the canonical schema: cents, micros, date, parsed attribute (I4)."""
    return raw.select(
        F.col("event_id").alias("txn_id"), F.col("user_id").alias("card_id"), F.timestamp_micros(micros("ts")).alias("event_ts"), micros("ts").alias("event_us"),
        F.to_date("ts").alias("event_date"), F.col("event_type").alias("category"), F.expr("CAST(round(value * 100) AS BIGINT)").alias("amount_cents"),
        F.from_json("props", "k INT").getField("k").alias("attr_k"),
    )


def read_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All history in the canonical schema."""
    return conform(spark.read.parquet(f"{sf_dir}/events.parquet"))


def stream_transactions(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """The same schema from files as they arrive."""
    return conform(spark.readStream.schema(RAW).option("maxFilesPerTrigger", max_files).parquet(path))


def stream_path(sf_dir: str) -> str:
    """``events`` as a pattern: a streaming source takes a single file only so."""
    return f"{sf_dir}/event[s].parquet"


@dataclass(frozen=True)
class SourceConfig:
    """Which source to open; ``options`` go to its reader."""

    format: str = "parquet"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)


def open_source(spark: SparkSession, cfg: SourceConfig) -> DataFrame:
    """A stream of canonical transactions from files, Kafka (JSON values) or a rate source for load tests."""
    reader = spark.readStream.format(cfg.format).options(**cfg.options)
    if cfg.format == "kafka":
        return conform(reader.load().select(F.from_json(F.col("value").cast("string"), RAW).alias("r")).select("r.*"))
    if cfg.format == "rate":
        made = reader.load().select(
            F.col("value").alias("event_id"), F.to_timestamp_ntz(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("ts"), (F.col("value") % 1000).alias("user_id"),
            F.lit("purchase").alias("event_type"), (F.col("value") % 500).cast("double").alias("value"), F.lit('{"k": 0}').alias("props"),
        )
        return conform(made)
    return conform(reader.schema(RAW).load(cfg.path))


def read_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The card dimension: customer with nation and region."""
    table = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    joined = table("customer").join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        F.col("c_custkey").alias("card_id"), F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"), F.col("r_name").alias("region"),
        F.expr("CAST(round(c_acctbal * 100) AS BIGINT)").alias("acctbal_cents"),
    )


def with_reason(raw: DataFrame) -> DataFrame:
    """Raw events and the first rule each breaks; null if none."""
    return raw.withColumn(
        "reason",
        F.when(F.col("event_id").isNull() | F.col("user_id").isNull(), "no key")
        .when(F.col("ts").isNull(), "no time")
        .when(F.col("value").isNull() | F.isnan("value"), "no amount")
        .when(F.col("value") < 0, "negative amount")
        .when(F.from_json("props", "k INT").getField("k").isNull(), "bad attributes"),
    )


def split_valid(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): canonical good rows, and bad raw rows with the reason (I5). Every row is in one of them."""
    judged = with_reason(raw)
    return conform(judged.where("reason IS NULL").drop("reason")), judged.where("reason IS NOT NULL")


def stream_raw(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Raw events from files as they arrive."""
    return spark.readStream.schema(RAW).option("maxFilesPerTrigger", max_files).parquet(path)


def stream_valid(spark: SparkSession, path: str, max_files: int = 1) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of a stream of files, as ``split_valid``; a sink with ``rejected`` writes both."""
    return split_valid(stream_raw(spark, path, max_files))
