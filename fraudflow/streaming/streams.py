"""Streaming operators: deduplication, exact rolling features, sinks, audit."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from fraudflow.operators.store import PARTITION, Files, append_batch, has_iceberg, new_path, new_table, read, schema_of
from fraudflow.streaming.panes import features_stream

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Longest batches that an audit remembers: the slowest twentieth of 2,000.
SLOWEST = 100


def dedup_stream(stream: DataFrame, delay: str = "2 days", key: str = "txn_id") -> DataFrame:
    """Drops repeats of a key that come within the watermark."""
    return stream.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark([key])


def progress_stats(query: StreamingQuery) -> list[dict]:
    """Rows in, rows dropped as late and duration of each of the last batches, 100 at most; ``Audit`` counts all (I8)."""
    return [
        {
            "batch": p["batchId"],
            "rows": p["numInputRows"],
            "late": sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"]),
            "millis": p["durationMs"].get("triggerExecution", 0),
        }
        for p in (dict(x) if not hasattr(x, "jsonValue") else x.jsonValue for x in query.recentProgress)
    ]


class Audit(StreamingQueryListener):
    """Adds up rows in, rows dropped as late and batches of every query of a session, in a folder that outlives them (I8).

    There is a file for each query id, which a restart from a checkpoint keeps,
    replaced whole after every batch. A batch counts once: what Spark tells again
    of the last one, or of an idle trigger, adds nothing. ``spark.streams.addListener``
    starts it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.files = Files(spark, path)
        self.ended = threading.Condition()
        self.over: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.note(str(event.progress.id), event.progress.batchId, event.progress.numInputRows, sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators), event.progress.batchDuration)

    def onQueryTerminated(self, event) -> None:
        with self.ended:
            self.over.add(str(event.runId))
            self.ended.notify_all()

    def note(self, query: str, batch: int, rows: int, late: int, millis: int) -> None:
        """Counts a batch, unless it is counted already."""
        had = self.totals(query)
        if batch > had["last_batch"]:
            slowest = sorted([*had["slowest"], millis], reverse=True)[:SLOWEST]
            self.files.write(f"{query}.json", json.dumps({"last_batch": batch, "batches": had["batches"] + 1, "rows": had["rows"] + rows, "late": had["late"] + late, "millis": had["millis"] + millis, "slowest": slowest}))

    def totals(self, query: str) -> dict:
        text = self.files.read(f"{query}.json")
        return json.loads(text) if text else {"last_batch": -1, "batches": 0, "rows": 0, "late": 0, "millis": 0, "slowest": []}

    def settled(self, query: StreamingQuery, seconds: float = 60) -> dict:
        """The totals of a query that has ended, once all that Spark has to tell of it is heard."""
        with self.ended:
            if not self.ended.wait_for(lambda: str(query.runId) in self.over, seconds):
                raise TimeoutError(f"query {query.id} has not ended")
        return self.totals(str(query.id))


def rolling_stream(stream: DataFrame, hours: int = 24, expires: bool = False, late_dropped: bool = False) -> DataFrame:
    """Count and sum of R1 and R2 for each event of a stream (R13); see ``features_stream``."""
    out = features_stream(stream, (hours,), expires=expires, late_dropped=late_dropped)
    return out.select("txn_id", "card_id", "event_us", "amount_cents", F.col(f"cnt_{hours}h").alias("cnt"), F.col(f"sum_{hours}h").alias("sum_cents"))


def with_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _write(rows: DataFrame, table: str, number: int, name: str) -> None:
    """One batch into a table: inside its dates if it has any, else into a folder of its own."""
    if has_iceberg(rows.sparkSession) or PARTITION in rows.columns:
        append_batch(rows, table, number, name)
    else:
        rows.write.mode("overwrite").parquet(f"{table}/batch_id={number}")


def sink(
    stream: DataFrame, table: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, every: str | None = None, rejected: str | None = None, name: str = "stream"
) -> StreamingQuery:
    """Writes each batch; one that is replayed replaces itself, in every table.

    Rows with an event_date go into the partitions of their dates, under names
    of the stream and the batch, so the table is read and compacted like any
    other. With ``rejected``, rows that have a ``reason`` go to that table, as
    JSON of what they hold, and the others on: one query and one checkpoint for
    both (I5). ``every`` is the interval of a live stream; without it the stream
    ends when it has read what is there. Streams that share a table need
    different names.
    """

    def write(batch: DataFrame, number: int) -> None:
        if rejected is None:
            _write(prepare(batch), table, number, name)
            return
        batch.persist()  # state is made once for both tables
        try:
            _write(prepare(batch.where("reason IS NULL").drop("reason", "rejected")), table, number, name)
            _write(batch.where("reason IS NOT NULL").select("reason", "rejected"), rejected, number, name)
        finally:
            batch.unpersist()

    started = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (started.trigger(processingTime=every) if every else started.trigger(availableNow=True)).start()


def with_rejected(good: DataFrame, bad: DataFrame) -> DataFrame:
    """A stream and the rejected raw rows of the same source as one, for a sink with ``rejected``.

    What became of the good rows may have any columns. Rejected ones have only
    their ``reason`` and themselves as JSON. Both read the same files in the same
    batch.
    """
    raw = [c for c in bad.columns if c != "reason"]
    return good.unionByName(bad.select("reason", F.to_json(F.struct(*raw), {"ignoreNullFields": "false"}).alias("rejected")), allowMissingColumns=True)


def drained(stream: DataFrame, name: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Runs a stream over all that is there, through the sink, and reads the table."""
    spark = stream.sparkSession
    table = new_table(spark, name)
    sink(stream, table, new_path(spark, f"{name}-checkpoint"), prepare).awaitTermination()
    return read_sink(spark, table)


def drained_with_rejected(stream: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): what a stream of ``with_rejected`` has written when all is read."""
    spark = stream.sparkSession
    good, bad = new_table(spark, name), new_table(spark, f"{name}-rejected")
    sink(stream, good, new_path(spark, f"{name}-checkpoint"), rejected=bad).awaitTermination()
    return read_sink(spark, good), read_sink(spark, bad)


def read_sink(spark: SparkSession, table: str) -> DataFrame:
    """What a sink has written, without the marks of its batches."""
    if has_iceberg(spark):
        return spark.table(table).drop("batch_id", "stream")
    schema = schema_of(spark, table)
    return read(spark, table, schema) if schema is not None else spark.read.parquet(table).drop("batch_id")


def closed_windows(stream: DataFrame, delay: str = "2 days", size: str = "1 day") -> DataFrame:
    """Tumbling windows of a stream in append mode: those that the watermark has passed."""
    w = F.window("event_ts", size).alias("w")
    out = stream.withWatermark("event_ts", delay).groupBy(w, "card_id").agg(F.count(F.lit(1)).alias("cnt"), F.sum("amount_cents").alias("sum_cents"))
    return out.select("card_id", F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "cnt", "sum_cents")
