"""The store: upserts that move rows, batches of a stream inside dates, lost writers, reads without footers."""

import datetime

import pytest
from pyspark.sql import functions as F
from test_operators import event, raw_files

from fraudflow.operators import store
from fraudflow.plans import train
from fraudflow.sources import transactions
from fraudflow.streaming import streams

SCHEMA = "txn_id long, event_date date, v string"
D = [datetime.date(2024, 1, d) for d in range(1, 10)]


def table_of(spark, rows, name="t"):
    table = store.new_table(spark, name)
    store.append(spark.createDataFrame(rows, SCHEMA), table)
    return table


def held(df):
    return sorted(((r.txn_id, r.event_date, r.v) for r in df.collect()), key=repr)


def test_upsert_moves_rows_and_empties_dates(spark):
    table = table_of(spark, [(1, D[0], "old"), (2, D[1], "stays"), (3, D[1], "old"), (None, D[2], "no key")])
    updates = [(1, D[1], "new"), (3, D[1], "new"), (4, D[3], "added"), (None, D[2], "no key too"), (5, None, "no date")]
    want = sorted([(1, D[1], "new"), (2, D[1], "stays"), (3, D[1], "new"), (4, D[3], "added"), (None, D[2], "no key"), (None, D[2], "no key too"), (5, None, "no date")], key=repr)
    assert held(store.upsert(spark.createDataFrame(updates, SCHEMA), table)) == want
    assert str(D[0]) not in store.days_of(store.Files(spark, table))
    # all rows of a date go, none come; the row without a date gets one
    store.upsert(spark.createDataFrame([(4, D[0], "back"), (5, D[4], "dated")], SCHEMA), table)
    assert [(k, d) for k, d, _ in held(store.read(spark, table)) if k in (4, 5)] == [(4, D[0]), (5, D[4])]
    assert held(store.upsert(spark.createDataFrame([], SCHEMA), table)) == held(store.read(spark, table))
    # old rows are looked for in the given dates only
    store.upsert(spark.createDataFrame([(2, D[6], "moved")], SCHEMA), table, dates=("2024-01-02", "2024-01-02"))
    assert [d for k, d, _ in held(store.read(spark, table)) if k == 2] == [D[6]]


def test_upsert_of_repeated_keys(spark):
    table = table_of(spark, [(1, D[0], "old")])
    twice = spark.createDataFrame([(1, D[1], "a"), (1, D[2], "b"), (2, D[0], "x"), (None, D[0], "n"), (None, D[0], "n")], SCHEMA)
    with pytest.raises(ValueError):
        store.upsert(twice, table)
    assert held(store.read(spark, table)) == [(1, D[0], "old")]
    assert held(store.upsert(twice, table, order=["event_date"])) == sorted([(1, D[2], "b"), (2, D[0], "x"), (None, D[0], "n"), (None, D[0], "n")], key=repr)


def test_lost_writers_leave_all_or_nothing(spark, monkeypatch):
    rows = [(i, D[i % 3], "old") for i in range(9)]
    updates = spark.createDataFrame([(i, D[(i + 1) % 3], "new") for i in range(5)], SCHEMA)
    want = sorted([(i, D[(i + 1) % 3], "new") for i in range(5)] + rows[5:], key=repr)
    apply = store._apply
    for stop in range(0, 6):
        table = table_of(spark, rows)
        moved = []

        def move(self, name, to, stop=stop, moved=moved, real=store.Files.move):
            if len(moved) == stop:
                raise OSError("lost")
            moved.append(to)
            real(self, name, to)

        with monkeypatch.context() as m:
            m.setattr(store.Files, "move", move)
            try:
                store.upsert(updates, table)
            except OSError:
                pass
        store.recovered(spark, table)
        assert held(store.read(spark, table)) == want
    table = table_of(spark, rows)
    with monkeypatch.context() as m:  # lost before the journal was written: nothing has changed
        m.setattr(store.Files, "write", lambda self, name, text: (_ for _ in ()).throw(OSError("lost")) if name.startswith(store.JOURNAL) else None)
        with pytest.raises(OSError):
            store.upsert(updates, table)
    store.recovered(spark, table)
    assert held(store.read(spark, table)) == sorted(rows, key=repr) and store._apply is apply


def test_reads_open_no_footers_and_start_no_job(spark):
    days = [datetime.date(2024, 1, 1) + datetime.timedelta(days=i) for i in range(40)]
    table = table_of(spark, [(i, d, "x") for i, d in enumerate(days)])
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        df = store.read_range(spark, table, "2024-01-10", "2024-01-12")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert "PartitionFilters: [isnotnull(event_date" in plan and plan.count("2024-01-10") and df.count() == 3
    assert len(df.inputFiles()) == 3
    assert store.read_range(spark, table, "2030-01-01", "2030-01-02").count() == 0


def test_columns_stay_in_the_schema(spark):
    table = table_of(spark, [(1, D[0], "x")])
    assert store.add_column(spark, table, "more", "int").columns == [*store.read(spark, table).columns] and "more" in store.schema_of(spark, table).names
    store.append(spark.createDataFrame([(2, D[0], "y", 7)], f"{SCHEMA}, more int"), table)
    assert {(r.txn_id, r.more) for r in store.read(spark, table).collect()} == {(1, None), (2, 7)}
    store.upsert(spark.createDataFrame([(1, D[0], "z", "new")], f"{SCHEMA}, other string"), table)
    assert {(r.txn_id, r.v, r.more, r.other) for r in store.read(spark, table).collect()} == {(1, "z", None, "new"), (2, "y", 7, None)}
    with pytest.raises(ValueError):
        store.append(spark.createDataFrame([(3, D[0], "y", "text")], f"{SCHEMA}, more string"), table)


def test_batches_replace_themselves_inside_dates(spark):
    table = store.new_table(spark, "batches")
    batch = lambda rows: spark.createDataFrame(rows, SCHEMA)
    store.append_batch(batch([(1, D[0], "a"), (2, D[1], "a")]), table, 0)
    store.append_batch(batch([(3, D[1], "b"), (4, D[2], "b")]), table, 1)
    store.append_batch(batch([(3, D[1], "c")]), table, 1)  # again, with less
    store.append_batch(batch([(9, D[1], "other stream")]), table, 1, "second")
    want = [(1, D[0], "a"), (2, D[1], "a"), (3, D[1], "c"), (9, D[1], "other stream")]
    assert held(store.read(spark, table)) == want
    # compaction leaves the newest batches, which may come again
    store.append_batch(batch([(5, D[1], "d")]), table, 2)
    store.compact(spark, table, str(D[1]))
    names = {n.split("/")[1].split("-")[0] for n in store.data_files(store.Files(spark, table), str(D[1]))}
    assert names == {"compact", "stream", "second"}
    store.append_batch(batch([(5, D[1], "e")]), table, 2)
    assert held(store.read(spark, table)) == sorted([*want, (5, D[1], "e")], key=repr)


def test_a_stream_table_is_pruned_and_trained_from(spark):
    path = raw_files(spark, "dated", [[event(10 * i + j, j, 24 * i + j, 1.0 + i) for j in range(6)] for i in range(5)])
    table = store.new_table(spark, "dated")
    for _ in range(2):  # a second checkpoint replays every batch
        streams.sink(transactions.stream_valid(spark, path)[0], table, store.new_path(spark, "dated-checkpoint")).awaitTermination()
    assert store.read(spark, table).count() == 30 and len(store.days_of(store.Files(spark, table))) == 5
    some = train.training_slice(spark, table, "2024-01-04", "2024-01-04", cutoff_us=1 << 62, warm_up_days=1)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date=2024-01-01" not in " ".join(some.inputFiles())
    assert sorted(r.txn_id for r in some.collect()) == [30, 31, 32, 33, 34, 35] and {r.cnt_168h for r in some.collect()} == {1}
    assert {n.split("=")[1][:10] for f in some.inputFiles() for n in f.split("/") if n.startswith("event_date=")} == {"2024-01-03", "2024-01-04", "2024-01-05"}
    assert store.read(spark, table).where(F.col("event_date") == "2024-01-04").count() == 6
