"""Semantics on small planted inputs."""

import datetime
import os

import pandas as pd
import pytest
from conftest import SF
from pyspark.sql import functions as F

from fraudflow.functions.columns import HOUR_US
from fraudflow.operators import enrich, features, labels, store
from fraudflow.plans import serve, train
from fraudflow.sources import transactions
from fraudflow.streaming import panes, streams

SCHEMA = "txn_id long, card_id long, event_us long, category string, amount_cents long"


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({"event_ts": F.timestamp_micros("event_us"), "event_date": F.to_date(F.timestamp_micros("event_us"))})


ROWS = [(1, 1, 0, "a", 100), (2, 1, HOUR_US, "a", 200), (3, 1, HOUR_US, "b", 300), (4, 1, 2 * HOUR_US, "a", 50), (5, 2, 5, "a", 7), (6, 1, 30 * HOUR_US, "b", 1), (7, None, 9, "a", 4)]


def test_rolling_equals_quadratic_model_with_ties(spark):
    got = {r.txn_id: (r.cnt_24h, r.sum_168h) for r in features.all_features(frame(spark, ROWS)).collect()}
    for i, card, at, _, _ in ROWS:
        before = lambda h: [a for _, c, t, _, a in ROWS if c == card and at - h * HOUR_US <= t < at]  # noqa: E731, B023
        assert got[i] == (len(before(24)), sum(before(168)) if before(168) else None)


def test_later_rows_change_no_feature(spark):
    early = {r.txn_id: r for r in features.all_features(frame(spark, ROWS[:4])).collect()}
    late = {r.txn_id: r for r in features.all_features(frame(spark, ROWS)).collect()}
    assert all(early[i] == late[i] for i in early)


def test_quarantine_keeps_every_row(spark):
    at = datetime.datetime(2024, 1, 1)
    rows = [(1, at, 1, "a", 1.0, '{"k": 1}'), (2, None, 1, "a", 1.0, '{"k": 1}'), (3, at, 1, "a", -1.0, '{"k": 1}'), (4, at, 1, "a", None, '{"k": 1}'), (5, at, 1, "a", 1.0, "{broken"), (None, at, 1, "a", 1.0, '{"k": 1}')]
    good, bad = transactions.split_valid(spark.createDataFrame(rows, transactions.RAW))
    assert [r.txn_id for r in good.collect()] == [1]
    assert {r.reason for r in bad.collect()} == {"no time", "negative amount", "no amount", "bad attributes", "no key"}


def test_dedup_is_fixed_under_ties(spark):
    rows = [(1, 1, 5, "b", 2), (1, 1, 5, "a", 2), (2, 1, 5, "a", 2)]
    assert sorted((r.txn_id, r.category) for r in enrich.dedup(frame(spark, rows), "txn_id", ["event_us"]).collect()) == [(1, "a"), (2, "a")]


def test_asof_takes_the_latest_at_or_before(spark):
    right = spark.createDataFrame([(1, 0, "x"), (1, HOUR_US, "y")], "card_id long, at long, v string")
    out = {r.txn_id: r.asof_v for r in enrich.asof(frame(spark, ROWS), right, "card_id", "event_us", "at", ["v"]).collect()}
    assert out == {1: "x", 2: "y", 3: "y", 4: "y", 5: None, 6: "y", 7: None}


def test_labels_come_from_later_reports_within_the_horizon(spark):
    reports = spark.createDataFrame([(1, HOUR_US), (1, 8 * HOUR_US), (2, 5)], "card_id long, report_us long")
    out = {r.txn_id: r.label for r in labels.attach_labels(frame(spark, ROWS), reports).collect()}
    assert out == {1: 1, 2: 0, 3: 0, 4: 1, 5: 0, 6: 0, 7: 0}


def test_decisions_at_the_edges(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.5,)], "score double")
    assert [r.decision for r in serve.decide(df, 0.2, 0.5).collect()] == ["approve", "review", "decline"]


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (2, 1)], "score int, label int")
    assert train.auc(df).first().roc_auc == 0.875
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    many = spark.range(400).selectExpr("CAST(pmod(xxhash64(id), 97) AS DOUBLE) AS score", "CAST(pmod(xxhash64(id), 97) + pmod(hash(id), 90) > 120 AS INT) AS label")
    own = train.auc(many).first()
    of = lambda metric: BinaryClassificationEvaluator(rawPredictionCol="score", metricName=metric).evaluate(many)
    assert abs(own.roc_auc - of("areaUnderROC")) < 1e-6 and abs(own.pr_auc - of("areaUnderPR")) < 0.02


def test_pruned_read_opens_only_its_partitions(spark):
    table = store.new_table(spark, "t")
    store.append(frame(spark, ROWS), table)
    plan = store.read_range(spark, table, "1970-01-02", "1970-01-02")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    with pytest.raises(NotImplementedError):
        store.read_as_of(spark, table, 1)


def test_replayed_batch_replaces_itself(spark):
    table = store.new_table(spark, "s")
    rows = frame(spark, ROWS)
    source = store.new_table(spark, "src")
    rows.write.parquet(source)
    for attempt in range(2):  # a new checkpoint replays batch 0
        stream = spark.readStream.schema(rows.schema).parquet(source)
        streams.sink(stream, table, store.new_table(spark, f"c{attempt}")).awaitTermination()
    assert spark.read.parquet(table).count() == len(ROWS)


def test_rate_source_and_late_audit(spark):
    stream = transactions.open_source(spark, transactions.SourceConfig("rate", options={"rowsPerSecond": "5"}))
    assert stream.isStreaming and "amount_cents" in stream.columns
    source = store.new_table(spark, "late")
    frame(spark, [(i, 1, i * 48 * HOUR_US, "a", 1) for i in range(5)]).write.parquet(source)
    query = streams.sink(streams.dedup_stream(spark.readStream.schema(frame(spark, ROWS).schema).parquet(source)), store.new_table(spark, "o"), store.new_table(spark, "k"))
    query.awaitTermination()
    stats = streams.progress_stats(query)
    assert sum(s["rows"] for s in stats) == 5 and all(s["late"] >= 0 for s in stats)


def raw_files(spark, name, slices):
    """Raw events in files, one written after the other, in the order of their times of change."""
    path = store.new_path(spark, name)
    for i, rows in enumerate(slices):
        spark.createDataFrame(rows, transactions.RAW).coalesce(1).write.mode("append").parquet(path)
        folder = path.removeprefix("file://")
        for file in os.listdir(folder):
            if file.endswith(".parquet") and not file.startswith("seen-"):
                os.rename(f"{folder}/{file}", f"{folder}/seen-{i}-{file}")
                os.utime(f"{folder}/seen-{i}-{file}", (1_700_000_000 + 10 * i,) * 2)
    return path


def event(i, card, hour, value=1.0):
    return (i, datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=hour), card, "purchase", value, '{"k": 1}')


def test_stream_over_several_batches_equals_batch(spark):
    """Repeats, a bad row and a row without an amount are planted; stream and batch agree over five files."""
    streams.with_rocksdb(spark)
    rows = [event(i, i % 3, i * 2 + i % 2, float(i % 7)) for i in range(50)]
    slices = [rows[10 * i : 10 * i + 10] for i in range(5)]
    slices[2] = [*slices[2], rows[15], rows[22], event(99, 1, 47, -1.0), event(98, 1, 47, None)]
    path = raw_files(spark, "served", slices)
    live = streams.drained(streams.rolling_stream(streams.dedup_stream(transactions.stream_valid(spark, path)[0]), 168), "out")
    batch = transactions.conform(spark.createDataFrame(rows, transactions.RAW))
    want = features.rolling_amount(features.velocity(batch))
    got = {r.txn_id: (r.cnt, r.sum_cents) for r in live.collect()}
    assert got == {r.txn_id: (r.cnt_168h, r.sum_168h) for r in want.collect()} and live.count() == 50
    unjudged = streams.drained(streams.rolling_stream(transactions.conform(spark.readStream.schema(transactions.RAW).parquet(path))), "nulls")
    assert unjudged.where("amount_cents IS NULL").count() == 1


def test_late_rows_are_counted_exactly(spark):
    slices = [[event(1, 1, 0)], [event(2, 1, 24 * 10)], [event(3, 1, 24 * 20)], [event(4, 1, 24), event(5, 1, 25), event(6, 1, 24 * 21)]]
    stream = streams.dedup_stream(transactions.stream_valid(spark, raw_files(spark, "late", slices))[0])
    query = streams.sink(stream, store.new_path(spark, "o"), store.new_path(spark, "k"))
    query.awaitTermination()
    stats = streams.progress_stats(query)
    assert sum(s["late"] for s in stats) == 2 and sum(s["rows"] for s in stats) == 6


def test_restart_after_a_lost_commit(spark):
    """The sink replaces the batch that is written again; a plain append repeats it."""
    path = raw_files(spark, "restart", [[event(i, 1, i)] for i in range(4)])

    def run(write):
        checkpoint = store.new_path(spark, "restart-checkpoint")
        for _ in range(2):
            write(transactions.stream_valid(spark, path)[0], checkpoint)
            folder = checkpoint.removeprefix("file://") + "/commits"
            last = max(int(f) for f in os.listdir(folder) if f.isdigit())
            for f in (str(last), f".{last}.crc"):
                if os.path.exists(f"{folder}/{f}"):
                    os.remove(f"{folder}/{f}")

    table, control = store.new_path(spark, "t"), store.new_path(spark, "c")
    run(lambda stream, checkpoint: streams.sink(stream, table, checkpoint).awaitTermination())
    append = lambda batch, _: batch.write.mode("append").parquet(control)
    run(lambda stream, checkpoint: stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    assert spark.read.parquet(table).count() == 4 and spark.read.parquet(control).count() == 5


def test_state_of_idle_cards_expires(spark, monkeypatch):
    """A card that comes back after its trailing hours counts from none; its old panes were dropped before, its last time was not."""
    streams.with_rocksdb(spark)
    slices = [[event(1, 1, 0), event(2, 2, 1)], [event(3, 2, 24 * 5)], [event(4, 2, 24 * 10)], [event(5, 1, 24 * 10 + 1), event(6, 2, 24 * 10 + 2)]]
    path = raw_files(spark, "idle", slices)

    class Told(panes.CardFeatures):
        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self._opened()
            held = sum(t[0] for t in self.totals.values())
            yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)
            self._opened()
            row = {"txn_id": -1, "card_id": key[0], "event_us": 0, "category": "", "amount_cents": 0} | {n: False if k == "boolean" else 0 for n, k in panes._columns(self.hours, self.last_n)}
            yield pd.DataFrame([row | {"cnt_24h": held if not self.totals else -1}])

    monkeypatch.setattr(panes, "CardFeatures", Told)
    for expires in (False, True):
        stream = transactions.stream_valid(spark, path)[0].withWatermark("event_ts", "1 hour")
        out = streams.drained(panes.features_stream(stream, (24,), expires=expires), "idle-out").collect()
        assert {r.txn_id: r.cnt_24h for r in out if r.txn_id > 0} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 1}
        assert {r.txn_id: r.gap_us and r.gap_us // HOUR_US for r in out if r.txn_id > 0} == {1: None, 2: None, 3: 119, 4: 120, 5: 241, 6: 2}
        cleared = [(r.card_id, r.cnt_24h) for r in out if r.txn_id < 0]
        assert ((1, 1) in cleared and all(n > 0 for _, n in cleared)) if expires else not cleared


def test_labels_with_null_and_repeated_keys(spark):
    rows = [(1, 7, 0, "a", 1), (1, 7, 0, "a", 1), (2, 7, 10 * HOUR_US, "a", 1), (3, None, 0, "a", 1), (4, 7, None, "a", 1), (5, 8, 0, "a", 1), (6, 7, 5 * HOUR_US, "a", 1)]
    reports = spark.createDataFrame([(7, HOUR_US), (7, 6 * HOUR_US + 1), (7, 10 * HOUR_US), (None, HOUR_US), (7, None), (8, 6 * HOUR_US)], "card_id long, report_us long")
    out = labels.attach_labels(frame(spark, rows), reports).collect()
    assert sorted((r.txn_id, r.label_us) for r in out if r.label) == [(1, HOUR_US), (1, HOUR_US), (5, 6 * HOUR_US), (6, 6 * HOUR_US + 1)] and len(out) == 7


def test_label_streams_equal_batch(spark):
    """Over four files: rows older than the watermark less the horizon come out once, with the label of the batch."""
    rows = [event(i, i % 4, i * 3) for i in range(80)]
    path = raw_files(spark, "labels", [rows[20 * i : 20 * i + 20] for i in range(4)])
    live = transactions.stream_valid(spark, path)[0]
    as_reports = lambda df: df.where("txn_id % 5 = 0").select(F.col("card_id"), F.col("event_us").alias("report_us"), F.col("event_ts").alias("report_ts"))
    horizon = 30 * HOUR_US
    got = streams.drained(labels.attach_labels_stream(live, as_reports(transactions.stream_valid(spark, path)[0]), horizon, "10 hours"), "label-out")
    batch = transactions.conform(spark.createDataFrame(rows, transactions.RAW))
    want = labels.attach_labels(batch, as_reports(batch), horizon)
    end = batch.where("txn_id % 5 = 0").agg(F.max("event_us")).first()[0] - 40 * HOUR_US
    closed = {(r.txn_id, r.label_us) for r in want.where(F.col("event_us") < end).collect()}
    assert sorted((r.txn_id, r.label_us or 0) for r in got.collect()) == sorted((t, u or 0) for t, u in closed) and closed
