"""Stateful operators: state in memory against brute force, and whole streams over several files against batch."""

import datetime
import json
import os
import random
import time
from types import SimpleNamespace

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SF
from pyspark.sql import functions as F
from test_operators import SCHEMA, event, frame, raw_files

from fraudflow.functions.columns import HOUR_US
from fraudflow.operators import features, store
from fraudflow.plans import serve, train
from fraudflow.sources import transactions
from fraudflow.streaming import joins, panes, streams


class Value:
    def __init__(self, calls):
        self.held, self.calls = None, calls

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.calls.append(("head", len(value[0])))
        self.held = value


class Map(dict):
    def __init__(self, calls):
        super().__init__()
        self.calls = calls

    def getValue(self, key):
        self.calls.append(("read", key[0]))
        return self[key]

    def updateValue(self, key, value):
        self.calls.append(("write", key[0]))
        self[key] = value

    def removeKey(self, key):
        del self[key]


class Handle:
    """State of one key in memory; ``calls`` lists what is read and written."""

    def __init__(self):
        self.calls, self.timers = [], set()

    def getValueState(self, *_):
        return Value(self.calls)

    def getMapState(self, *_):
        return Map(self.calls)

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def opened(processor):
    processor.init(Handle())
    return processor


def brute(rows, us, txn, kind):
    """The features of a row among all known ones, from their definition."""
    span = 168 * HOUR_US
    near = [r for r in rows if us - span <= r[0] < us]
    known = [r[2] for r in near if r[2] is not None]
    before = sorted(r[:3] for r in rows if r[:2] < (us, txn))
    recent = [a for *_, a in before[-10:] if a is not None]
    counts = [sum(us - h * HOUR_US <= r[0] < us for r in rows) for h in (1, 24, 168)]
    amounts = [sum(known), sum(known) / len(known), min(known), max(known)] if known else [None] * 4
    return [*counts, *amounts, us - before[-1][0] if before else None, len({r[3] for r in near} - {None}), sum(recent) / len(recent) if recent else None, (us, txn) == min(r[:2] for r in rows if r[3] == kind)]


@pytest.mark.parametrize("inline", [512, 10, 0])
def test_pane_state_equals_brute_force(inline, monkeypatch):
    monkeypatch.setattr(panes, "INLINE", inline)
    rng = random.Random(inline)
    for spread in (40, 2000):
        processor, rows, txn = opened(panes.CardFeatures((1, 24, 168))), [], 0
        names = [n for n, _ in panes._columns((1, 24, 168), 10)]
        at = 0
        for _ in range(25):
            batch = []
            for _ in range(rng.randint(1, 12)):
                txn += 1
                at += rng.choice([0, 0, 1, HOUR_US // 3, HOUR_US, rng.randint(1, spread) * HOUR_US // 10])
                batch.append((at, txn, rng.choice([None, 5, 7, -3, 10**12]), rng.choice(["a", "b", "c", None])))
            at += 1
            rng.shuffle(batch)
            rows += batch
            frame_ = pd.DataFrame(batch, columns=["event_us", "txn_id", "amount_cents", "category"]).astype({"amount_cents": "Int64"})
            cut = rng.randint(0, len(batch))
            (out,) = processor.handleInputRows((1,), iter([p for p in (frame_[:cut], frame_[cut:]) if len(p)]), None)
            kinds = {t: k for _, t, _, k in batch}
            for got in out.to_dict("records"):
                values = [None if pd.isna(got[n]) else got[n] for n in names]
                assert values == pytest.approx(brute(rows, got["event_us"], got["txn_id"], kinds[got["txn_id"]]))


@pytest.mark.parametrize("at_once", [1 << 16, 0])
def test_packed_rows_equal_brute_force(at_once, monkeypatch):
    """A card's features cross as one packed row, made by numpy or pane by pane; nulls come back as nulls."""
    from pyspark.sql import Row

    monkeypatch.setattr(panes, "AT_ONCE", at_once)
    rng = random.Random(3)
    columns = panes._columns((1, 24, 168), 10)
    processor, rows, at, txn = opened(panes.Packed(panes.CardFeatures((1, 24, 168)))), [], 0, 0
    schema = pa.schema([("card_id", pa.int64()), ("kinds", pa.list_(pa.string())), ("packed", pa.binary())])
    for _ in range(6):
        batch = []
        for _ in range(40):
            txn += 1
            at += rng.choice([0, 1, HOUR_US // 2, 9 * HOUR_US])
            batch.append((at, txn, rng.choice([None, 5, -3, 10**12]), rng.choice(["a", "b", None])))
        at += 1
        rows += batch
        fed = [Row(card_id=7, txn_id=t, event_us=u, amount_cents=a, category=c) for u, t, a, c in rng.sample(batch, 40)]
        packed = [r.asDict() for r in processor.handleInputRows((7,), iter(fed), None)]
        assert len(packed) == 1
        (out,) = panes._unpacked(columns)([pa.RecordBatch.from_pylist([*packed, *packed], schema)])
        assert out.num_rows == 80
        for got, (u, t, a, c) in zip(out.to_pylist()[40:], batch, strict=True):
            assert [got[n] for n in ("event_us", "txn_id", "amount_cents", "category", "card_id")] == [u, t, a, c, 7]
            assert [got[n] for n, _ in columns] == pytest.approx(brute(rows, u, t, c))
    cold = panes.Packed(panes.CardFeatures((24,)))
    opened(cold)
    fed = [Row(card_id=None, txn_id=None, event_us=None, amount_cents=1, category="a"), *(Row(card_id=None, txn_id=i, event_us=i, amount_cents=1, category="a") for i in range(5000))]
    packed = [r.asDict() for r in cold.handleInputRows((None,), iter(fed), None)]
    (out,) = panes._unpacked(panes._columns((24,), 10))([pa.RecordBatch.from_pylist(packed, schema)])
    first, last = out.slice(0, 1).to_pylist()[0], out.slice(5000).to_pylist()[0]
    assert len(packed) == 2 and (first["card_id"], first["txn_id"], first["event_us"], first["cnt_24h"]) == (None, None, None, 0)
    assert (last["txn_id"], last["cnt_24h"], last["is_first_in_category"]) == (4999, 4999, False)


def test_rows_of_a_card_reach_its_state_packed(monkeypatch):
    """A task hands over a row for a card, not one for each of its rows; nulls come back as nulls, and no pack is longer than allowed."""
    monkeypatch.setattr(panes, "GATHERED", 300)
    monkeypatch.setattr(panes, "PACKED", 50)
    rng = random.Random(4)
    rows = [(rng.choice([None, 0, 1, 2, 2, 2]), i or None, rng.choice([None, i]), rng.choice([None, 0, 5]), rng.choice([None, "a", "b", "c"])) for i in range(800)]
    names = ["card_id", "txn_id", "event_us", "amount_cents", "category"]
    table = pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in rows], pa.schema([(n, pa.string() if n == "category" else pa.int64()) for n in names]))
    found, packs = [], 0
    for batch in panes._gathered(iter(table.to_batches(max_chunksize=100))):
        for r in batch.to_pylist():
            us, ids, amount, known, code = (x.tolist() for x in panes.np.frombuffer(r["packed"], panes.np.int64).reshape(5, -1))
            assert len(us) <= 50 and len(set(r["names"])) == len(r["names"])
            null = lambda v: None if v == panes._NULL else v
            found += [(r["card_id"], null(i), null(u), a if k else None, r["names"][c]) for u, i, a, k, c in zip(us, ids, amount, known, code, strict=True)]
            packs += 1
    key = lambda r: [repr(x) for x in r]
    assert sorted(found, key=key) == sorted(rows, key=key) and packs < 40
    assert list(panes._gathered(iter([]))) == []


def test_packed_rows_after_deduplication_lose_late_rows_alike(spark):
    """Behind a deduplication the state need not look at the watermark of each row: what is late never comes."""
    streams.with_rocksdb(spark)
    files = [[event(i, i % 3, i, float(i)) for i in range(30)], [event(40, 1, 400, 4.0), event(5, 2, 5, 5.0)], [event(41, 1, 20, 1.0), event(42, 2, 399, 2.0), event(43, 0, 900, 2.0)], [event(44, 2, 340, 1.0), event(45, 0, 901, 1.0)]]
    path = raw_files(spark, "late-dropped", files)
    found = []
    for dropped in (False, True):
        good, _ = transactions.stream_valid(spark, path)
        made = panes.features_stream(streams.dedup_stream(good), expires=True, late_dropped=dropped)
        found.append(sorted(map(tuple, streams.drained(made, "late-dropped").select("txn_id", "card_id", "event_us", "cnt_168h", "sum_168h", "gap_us", "is_first_in_category").collect())))
    assert found[0] == found[1] and {r[0] for r in found[0]} >= {*range(30), 40, 42, 43, 45} and not {r[0] for r in found[0]} & {44}


def test_late_rows_change_later_rows_only():
    processor = opened(panes.CardFeatures((1, 24, 168)))
    make = lambda *rows: iter([pd.DataFrame([(h * HOUR_US, i, 10, "a") for i, h in rows], columns=["event_us", "txn_id", "amount_cents", "category"])])
    list(processor.handleInputRows((1,), make((1, 0), (2, 400)), None))
    (late,) = processor.handleInputRows((1,), make((3, 1), (4, 390)), None)
    assert late["cnt_168h"].tolist() == [0, 0] and late["gap_us"].tolist()[1] == 389 * HOUR_US  # the window of row 3 is dropped, its last time is not
    (after,) = processor.handleInputRows((1,), make((5, 401)), None)
    assert after["cnt_168h"].tolist() == [2] and after["gap_us"].tolist() == [HOUR_US]


def test_a_hot_card_reads_and_writes_the_panes_it_touches():
    """All rows of sf0.1 in one card: a batch of a day's hundredth touches three panes, and no value holds the card."""
    raw = pq.read_table("/root/testdata/sf0.1/events.parquet", columns=["event_id", "ts", "event_type", "value"]).to_pandas().sort_values("ts")
    rows = pd.DataFrame({"event_us": raw["ts"].astype("datetime64[us]").astype("int64"), "txn_id": raw["event_id"], "amount_cents": (raw["value"] * 100).round().astype("int64"), "category": raw["event_type"]}).reset_index(drop=True)
    processor = opened(panes.CardFeatures((1, 24, 168)))
    calls = processor.handle.calls
    most, counts = 0, []
    for low in range(0, len(rows), 4_000):
        calls.clear()
        (out,) = processor.handleInputRows((1,), iter([rows[low : low + 4_000]]), None)
        counts += out["cnt_168h"].tolist()
        most = max(most, len({c for c in calls if c[0] != "head"}))
        assert all(size < 20_000 for name, size in calls if name == "head")
    assert most <= 14 and max(len(v[0]) for v in processor.rows.values()) < 1 << 20 and len(processor.rows) <= 10
    us = rows["event_us"].to_numpy()
    assert counts == (us.searchsorted(us) - us.searchsorted(us - 168 * HOUR_US)).tolist()


@pytest.mark.parametrize("inline", [512, 3])
def test_asof_state_waits_for_late_versions(inline, monkeypatch):
    monkeypatch.setattr(joins, "INLINE", inline)
    rng = random.Random(5)
    processor, watermark, out = opened(joins.AsOf()), 0, []
    rows = [(rng.randint(0, 60 * HOUR_US), rng.randint(0, 1), str(i)) for i in range(300)]
    rows += [(u, 1 - s, f"same {r}") for u, s, r in rows[:40]]
    arrive = sorted(rows, key=lambda r: r[0] + rng.randint(0, 5 * HOUR_US))  # at most five hours late
    for low in range(0, len(arrive), 17):
        part = arrive[low : low + 17]
        list(processor.handleInputRows((1,), iter([pd.DataFrame(part, columns=["us", "side", "row"])]), None))
        watermark = max(watermark, max(r[0] for r in part) // 1000 - 5 * HOUR_US // 1000)
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)  # noqa: B023
        for timer in sorted(t for t in processor.handle.timers if t <= watermark):
            processor.handle.timers.remove(timer)
            for made in processor.handleExpiredTimer((1,), now, None):
                out += made.itertuples(index=False, name=None)
    versions = sorted((u, r) for u, s, r in rows if s == 0)
    latest = lambda us: next((r for u, r in reversed(versions) if u <= us), None)
    done = [(r, latest(u)) for u, s, r in rows if s == 1 and (u // HOUR_US + 1) * (HOUR_US // 1000) <= watermark]
    assert sorted(out, key=repr) == sorted(done, key=repr) and len(done) > 120


def test_asof_stream_over_several_files(spark):
    """A version that comes two files after its transactions still counts for them."""
    streams.with_rocksdb(spark)
    slices = [[event(1, 1, 10), event(2, 2, 10)], [event(3, 1, 30, 9.0)], [event(4, 1, 9, 7.0), event(5, None, 9, 3.0), event(6, None, 10)], [event(7, 3, 24 * 6)], [event(8, 3, 24 * 9)]]
    path = raw_files(spark, "versions", slices)
    live = lambda: transactions.conform(transactions.stream_raw(spark, path))
    right = live().where("txn_id IN (3, 4, 5)").select("card_id", F.col("event_us").alias("at"), "amount_cents")
    left = live().where("txn_id NOT IN (3, 4, 5)").select("txn_id", "card_id", "event_us", "event_date", "category")
    found = streams.drained(joins.asof_stream(left, right, "card_id", "event_us", "at", ["at", "amount_cents"]), "asof")
    assert {r.txn_id: r.asof_amount_cents for r in found.collect()} == {1: 700, 2: None, 6: 300, 7: None}
    assert found.schema["event_date"].dataType.simpleString() == "date"


def test_alerts_never_exceed_the_budget():
    rng = random.Random(9)
    for both in (True, False):
        processor, force, rows = opened(joins.TopK(5, both)), set(), []
        for low in range(0, 300, 7):
            new = [(i, rng.randint(0, 50)) for i in range(low, low + 7)]
            rows += new
            (out,) = processor.handleInputRows((datetime.date(2024, 1, 1),), iter([pd.DataFrame(new, columns=["txn_id", "score"])]), None)
            for r in out.itertuples():
                force.add((r.txn_id, r.score)) if r.action == "add" else force.remove((r.txn_id, r.score))
                assert len(force) <= 5 or not both
            best = set(sorted(rows, key=lambda r: (-r[1], r[0]))[:5])
            assert force == best if both else force >= best


def test_rows_that_cannot_be_alerts_go_no_further():
    rng = random.Random(4)
    days = [None, datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)]
    rows = [(rng.choice(days), i, rng.randint(0, 9), 0) for i in range(200)] + [(datetime.date(2024, 1, 3), 999, 1, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["event_date", "txn_id", "score", "part"])
    got = [tuple(r.values()) for b in joins._best(5)([batch, batch.slice(0, 0)]) for r in b.to_pylist()]
    want = [r for d in [*days, datetime.date(2024, 1, 3)] for r in sorted((r for r in rows if r[0] == d), key=lambda r: (-r[2], r[1]))[:5]]
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(got) == 16


def test_alerts_over_several_files_equal_batch(spark):
    streams.with_rocksdb(spark)
    path = raw_files(spark, "alerts", [[event(50 * i + j, j, 5 * i, float((j * 37 + i) % 60)) for j in range(50)] for i in range(4)])
    scored = transactions.conform(transactions.stream_raw(spark, path)).withColumn("score", F.col("amount_cents"))
    actions = streams.drained(joins.alert_stream(scored, 3, parts=4).withColumnRenamed("event_date", "day"), "alerts").withColumnRenamed("day", "event_date")
    batch = transactions.conform(spark.read.schema(transactions.RAW).parquet(path)).withColumn("score", F.col("amount_cents"))
    want = {(r.event_date, r.txn_id, r.score) for r in serve.top_alerts(batch, 3).collect()}
    assert {(r.event_date, r.txn_id, r.score) for r in joins.in_force(actions).collect()} == want and actions.where("action = 'drop'").count() > 0


def test_served_scores_and_rejected_rows(spark):
    """The whole chain over several files: features and scores equal batch, and every raw row is served or rejected once, also when a batch comes again."""
    streams.with_rocksdb(spark)
    history = store.kept(train.planted_set(spark, SF), "history")
    model = train.fit(history.where(history.event_us < train.T1_US))
    want = {r.txn_id: r for r in serve.score(history.select("txn_id", "category", *train.NUMBERS), model).collect()}
    got = {r.txn_id: r for r in serve.serve_model(spark, SF).collect()}
    assert len(got) == len(want) and all(abs(got[i].score - want[i].score) < 1e-6 and all(got[i][c] == want[i][c] for c in train.NUMBERS[1:]) for i in want)
    rows = [event(i, i % 4, i * 3, float(i)) for i in range(40)]
    bad = [event(100, None, 4), event(101, 1, 30, -1.0), event(102, 1, 31, None), (103, rows[3][1], 1, "a", 1.0, "{broken"), (104, None, 1, "a", 1.0, '{"k": 1}'), (None, rows[3][1], 1, "a", 1.0, '{"k": 1}')]
    path = raw_files(spark, "letters", [[*rows[:20], *bad[:2]], [*rows[20:30], *bad[2:4], rows[5]], [*rows[30:], *bad[4:]]])
    cards = transactions.read_cards(spark, SF)
    good, rejected = store.new_table(spark, "good"), store.new_table(spark, "bad")
    models = store.new_path(spark, "models")
    train.save(model, models, "one")
    train.promote(models, "one")
    for turn in range(2):
        checkpoint = store.new_path(spark, f"letters-{turn}")
        serve.serve_current(transactions.stream_raw(spark, path), cards, models, good, rejected, checkpoint).awaitTermination()
    served, letters = streams.read_sink(spark, good).collect(), streams.read_sink(spark, rejected).collect()
    assert sorted(r.txn_id for r in served) == list(range(40)) and {r.model_id for r in served} == {"one"}
    assert sorted((json.loads(r.rejected).get("event_id") or 0, r.reason) for r in letters) == [(0, "no key"), (100, "no key"), (101, "negative amount"), (102, "no amount"), (103, "bad attributes"), (104, "no time")]
    assert json.loads(next(r.rejected for r in letters if r.reason == "bad attributes"))["props"] == "{broken"
    batch = features.all_features(transactions.conform(spark.createDataFrame(rows, transactions.RAW)))
    assert {r.txn_id: (r.cnt_24h, r.max_168h, r.gap_us) for r in served} == {r.txn_id: (r.cnt_24h, r.max_168h, r.gap_us) for r in batch.collect()}


def test_a_running_stream_takes_up_a_new_model(spark):
    streams.with_rocksdb(spark)
    history = store.kept(train.planted_set(spark, SF), "history").limit(400)
    models, cards = store.new_path(spark, "models"), transactions.read_cards(spark, SF)
    one = train.fit(history)
    train.save(one, models, "one", cutoff_us=5, seed=7)
    train.save(train.fit(history.withColumn("label", 1 - F.col("label"))), models, "two")
    train.save(train.fit(history, columns=["amount_cents"], category=None), models, "other", ["amount_cents"])
    assert train.described(models, "one") == {"model_id": "one", "columns": train.NUMBERS, "cutoff_us": 5, "seed": 7}
    assert train.current(models) is None
    for refused in (lambda: train.promote(models, "missing"), lambda: train.load(models, "other"), lambda: train.load(models, "one", ["amount_cents"])):
        with pytest.raises(ValueError):
            refused()
    same = [train.load(models, "one"), one]
    scores = [{r.txn_id: r.score for r in serve.score(history, m).collect()} for m in same]
    assert scores[0] == scores[1]
    train.promote(models, "one")
    path = raw_files(spark, "live", [[event(1, 1, 1)]])
    table, bad = store.new_table(spark, "served"), store.new_table(spark, "letters")
    query = serve.serve_current(transactions.stream_raw(spark, path), cards, models, table, bad, store.new_path(spark, "live-checkpoint"), every="0 seconds")

    def served(n):
        for _ in range(300):
            if query.exception():
                raise query.exception()
            rows = streams.read_sink(spark, table).collect() if store.schema_of(spark, table) else []
            if len(rows) >= n:
                return {r.txn_id: r.model_id for r in rows}
            time.sleep(0.2)
        raise AssertionError("the stream stands still")

    def arrive(i, hour):
        made = raw_files(spark, "more", [[event(i, 1, hour)]]).removeprefix("file://")
        for name in os.listdir(made):
            if name.endswith(".parquet"):
                os.rename(f"{made}/{name}", f"{path.removeprefix('file://')}/more-{i}.parquet")

    try:
        assert served(1) == {1: "one"}
        train.promote(models, "two")
        arrive(2, 2)
        assert served(2) == {1: "one", 2: "two"}
        train.promote(models, "other")
        arrive(3, 3)
        with pytest.raises(Exception, match="takes"):
            query.awaitTermination(60)
    finally:
        query.stop()


def test_the_audit_counts_every_batch_once(spark):
    """Over 100 batches and a restart: rows and late rows exactly, and again nothing for a batch that is told twice."""
    audit = streams.Audit(spark, store.new_path(spark, "audit"))
    audit.note("q", 0, 5, 1, 10)
    audit.note("q", 0, 5, 1, 10)
    audit.note("q", 1, 3, 0, 30)
    assert audit.totals("q") == {"last_batch": 1, "batches": 2, "rows": 8, "late": 1, "millis": 40, "slowest": [30, 10]}
    folder = store.new_path(spark, "many").removeprefix("file://")
    os.makedirs(folder)
    kinds = pa.schema([("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()), ("event_type", pa.string()), ("value", pa.float64()), ("props", pa.string())])

    def files(low, high):
        for i in range(low, high):
            rows = [event(2 * i, 1, 24 * i)] + ([event(2 * i + 1, 1, 24 * (i - 9))] if i % 10 == 9 else [])
            pq.write_table(pa.Table.from_pylist([dict(zip(kinds.names, r, strict=True)) for r in rows], kinds), f"{folder}/{i:03d}.parquet")
            os.utime(f"{folder}/{i:03d}.parquet", (1_700_000_000 + 10 * i,) * 2)

    spark.streams.addListener(audit)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        checkpoint = store.new_path(spark, "audited")
        for low, high in ((0, 100), (100, 112)):
            files(low, high)
            stream = streams.dedup_stream(transactions.conform(transactions.stream_raw(spark, f"file://{folder}"))).select("txn_id")
            query = streams.sink(stream, store.new_path(spark, "o"), checkpoint)
            query.awaitTermination()
            found = audit.settled(query)
            assert found["rows"] == high + high // 10 and found["late"] == high // 10 and found["batches"] >= high
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.streams.removeListener(audit)


def test_halo_frames_of_one_card_run_in_many_tasks(spark):
    rng = random.Random(8)
    rows, at = [], -300 * HOUR_US
    for i in range(400):
        at += rng.choice([0, 1, HOUR_US, 5 * HOUR_US, 30 * HOUR_US] + ([400 * HOUR_US] if i % 97 == 0 else []))
        rows.append((i, rng.choice([7, 7, 7, 8, None]), at if i % 50 else None, rng.choice("abc"), rng.choice([None, 5, 70, 900])))
    df = frame(spark, rows)
    add = lambda x: features.distinct_categories(features.amount_vs_history(features.rolling_dispersion(features.rolling_amount(features.velocity(x)))))
    held = lambda d: sorted((tuple(r[c] for c in sorted(d.columns)) for r in d.collect()), key=repr)
    want = held(add(df))
    for bucket, hot in ((None, None), (24, None), (1000, None), (None, spark.createDataFrame([(7,), (99,)], "card_id long"))):
        assert held(features.spread(df, 168, add, bucket, hot)) == want
    timed = df.where("event_us IS NOT NULL")
    for hot in (None, spark.createDataFrame([(7,)], "card_id long")):
        assert held(features.spread_features(timed, hot)) == held(features.all_features(timed))
    assert [r.card_id for r in features.hot_cards(df, 150).collect()] == [7]
    # one card with all rows: its frames are made in several tasks, in the shuffle by card and bucket
    one = timed.withColumn("card_id", F.lit(1).cast("long")).repartition(4)
    spread = features.spread(one, 168, features.velocity)
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(card_id" in plan and "bucket" in plan and "range_" not in plan
    held_tasks = lambda d: len({r.p for r in d.withColumn("p", F.spark_partition_id()).collect()})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert held_tasks(features.velocity(one)) == 1 < held_tasks(spread)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert held(spread) == held(features.velocity(one))


def test_encoder_of_new_categories_and_nulls(spark):
    rows = [(float(i), i % 2, "ab"[i % 2]) for i in range(20)] + [(None, 0, "a")]
    seen = spark.createDataFrame(rows, "amount_cents double, label int, category string")
    model = train.fit(seen, columns=["amount_cents"])
    new = spark.createDataFrame([(1.0, "a"), (1.0, "never seen"), (None, None)], "amount_cents double, category string")
    out = model.transform(train.numbers(new, ["amount_cents"])).collect()
    assert len(out) == 3 and [r.features.size for r in out] == [3, 3, 3]
    assert out[0].features.toArray().tolist()[:2] in ([1.0, 0.0], [0.0, 1.0]) and out[1].features.toArray().tolist()[:2] == [0.0, 0.0] == out[2].features.toArray().tolist()[:2]
    assert out[2].features.toArray()[2] == pytest.approx(sum(__import__("math").log1p(r[0]) for r in rows[:20]) / 20)
    assert SCHEMA.startswith("txn_id")
