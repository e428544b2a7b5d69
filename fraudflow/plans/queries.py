"""All queries of the transaction pipeline with their SQL."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudflow.functions.columns import amount_features, rule_score, time_features
from fraudflow.operators import enrich as E
from fraudflow.operators import features as R
from fraudflow.operators import labels as L
from fraudflow.operators import store as S
from fraudflow.plans import serve as P
from fraudflow.plans import train as T
from fraudflow.sources import transactions as I
from fraudflow.streaming import joins as J
from fraudflow.streaming import panes as N
from fraudflow.streaming import streams as X

Query = Callable[[SparkSession, str], DataFrame]
_ALL = ["txn_id", "card_id", "event_us", "event_date", "category", "amount_cents", "attr_k"]
_TRAINING = ["txn_id", "amount_cents", "cnt_1h", "cnt_24h", "cnt_168h", "sum_168h", "avg_168h", "max_168h", "gap_us", "label"]
_STREAMED = ["cnt_1h", "cnt_24h", "cnt_168h", "sum_168h", "avg_168h", "min_168h", "max_168h", "gap_us", "categories_168h", "avg_last_10", "is_first_in_category"]
#: Dates that an upsert empties.
_MOVED = (datetime.date(2024, 1, 5), datetime.date(2024, 1, 11))
#: Dates of the training slice.
_SLICE = ("2024-01-15", "2024-01-24")
#: Rows that make a card hot: more than about half of the cards have.
_HOT = 66
_CARD = ["segment", "nation", "region", "acctbal_cents"]


def _txn(spark: SparkSession, d: str) -> DataFrame:
    return I.read_transactions(spark, d)


def _stream(spark: SparkSession, d: str) -> DataFrame:
    X.with_rocksdb(spark)
    return I.stream_transactions(spark, I.stream_path(d))


def _feature(f: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    return lambda s, d: f(_txn(s, d)).select("txn_id", *columns)


def _quarantine(s: SparkSession, d: str) -> DataFrame:
    raw = s.read.parquet(f"{d}/events.parquet")
    return I.with_reason(raw).select("event_id", F.coalesce("reason", F.lit("ok")).alias("reason"))


def _dedup_batch(s: SparkSession, d: str) -> DataFrame:
    orders = s.read.parquet(f"{d}/orders.parquet").select("o_custkey", F.to_date("o_orderdate").alias("o_date"), "o_orderkey")
    return E.dedup(orders, ["o_custkey", "o_date"], ["o_orderkey"])


def _asof(s: SparkSession, d: str) -> DataFrame:
    txn = _txn(s, d).select("txn_id", "card_id", "event_us", "category", "amount_cents")
    views = txn.where("category = 'view'").select("card_id", F.col("event_us").alias("view_us"), "amount_cents")
    return E.asof(txn.where("category = 'purchase'"), views, "card_id", "event_us", "view_us", ["view_us", "amount_cents"]).select("txn_id", "asof_view_us", "asof_amount_cents")


def _stored(s: SparkSession, d: str) -> str:
    table = S.new_table(s, "transactions")
    S.append(S.dealt(_txn(s, d).select(*_ALL)), table)
    return table


def _store_append(s: SparkSession, d: str) -> DataFrame:
    return S.read(s, _stored(s, d)).select(*_ALL)


def _store_upsert(s: SparkSession, d: str) -> DataFrame:
    """Errors lose their amount, every signup is added once more under a negative id, and all of two dates move to a later one."""
    txn = _txn(s, d).select(*_ALL)
    moved = F.when(F.col("event_date").isin(*_MOVED), F.date_add("event_date", 60)).otherwise(F.col("event_date"))
    changed = txn.where((F.col("category") == "error") | F.col("event_date").isin(*_MOVED)).withColumn("amount_cents", F.when(F.col("category") == "error", 0).otherwise(F.col("amount_cents"))).withColumn("event_date", moved)
    added = txn.where("category = 'signup'").withColumn("txn_id", -F.col("txn_id") - 1)
    return S.upsert(changed.unionByName(added), _stored(s, d)).select(*_ALL)


def _store_pruned(s: SparkSession, d: str) -> DataFrame:
    return S.read_range(s, _stored(s, d), "2024-01-10", "2024-01-19").select(*_ALL)


def _store_evolve(s: SparkSession, d: str) -> DataFrame:
    """Older rows are stored without the category, newer ones with it."""
    table, txn = S.new_table(s, "evolving"), S.dealt(_txn(s, d).select(*_ALL))
    S.append(txn.where("event_date < '2024-01-15'").drop("category"), table)
    S.append(txn.where("event_date >= '2024-01-15'"), table)
    return S.add_column(s, table, "category", "string").select("txn_id", "event_date", "category", "amount_cents")


def _store_compact(s: SparkSession, d: str) -> DataFrame:
    table = _stored(s, d)
    S.append(_txn(s, d).where("category = 'error'").withColumn("txn_id", -F.col("txn_id") - 1).select(*_ALL), table)
    S.compact(s, table, "2024-01-15")
    return S.read(s, table).select(*_ALL)


def _spoiled(raw: DataFrame) -> DataFrame:
    """Raw events of which many break a rule, some of them two."""
    spoil = lambda every, c, bad: F.when(F.col("event_id") % every == 0, bad).otherwise(F.col(c))
    return raw.withColumns({
        "user_id": spoil(19, "user_id", F.lit(None).cast("long")), "ts": spoil(17, "ts", F.lit(None).cast("timestamp_ntz")),
        "value": F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 11 == 0, -F.col("value")).otherwise(F.col("value")), "props": spoil(13, "props", F.lit("{broken")),
    })


def _dead_letters(s: SparkSession, d: str) -> DataFrame:
    """What a stream accepts and what it rejects, from the two tables that its sink writes."""
    X.with_rocksdb(s)
    good, bad = I.split_valid(_spoiled(I.stream_raw(s, I.stream_path(d))))
    taken, rejected = X.drained_with_rejected(X.with_rejected(X.dedup_stream(good).select("txn_id", "event_date", "amount_cents"), bad), "letters")
    told = rejected.select(F.get_json_object("rejected", "$.event_id").cast("long").alias("event_id"), "reason", F.lit(None).cast("long").alias("amount_cents"))
    return taken.select(F.col("txn_id").alias("event_id"), F.lit("ok").alias("reason"), "amount_cents").unionByName(told)


def _asof_stream(s: SparkSession, d: str) -> DataFrame:
    """Purchases with the card's latest view, from two streams of the same files."""
    views = _stream(s, d).where("category = 'view'").select("card_id", F.col("event_us").alias("view_us"), "amount_cents")
    bought = _stream(s, d).where("category = 'purchase'").select("txn_id", "card_id", "event_us")
    return X.drained(J.asof_stream(bought, views, "card_id", "event_us", "view_us", ["view_us", "amount_cents"]), "asof").select("txn_id", "asof_view_us", "asof_amount_cents")


def _alert_stream(s: SparkSession, d: str) -> DataFrame:
    """Alerts of a stream by rule score that are in force when all is read."""
    scored = N.features_stream(_stream(s, d)).withColumn("event_date", F.to_date(F.timestamp_micros("event_us"))).withColumn("score", rule_score())
    return J.in_force(X.drained(J.alert_stream(scored).withColumnRenamed("event_date", "day"), "alerts").withColumnRenamed("day", "event_date"))


def _training_from_store(s: SparkSession, d: str) -> DataFrame:
    """A slice of the table that a stream has written by date."""
    table = S.new_table(s, "history")
    X.sink(_stream(s, d).select(*_ALL), table, S.new_path(s, "history-checkpoint")).awaitTermination()
    return T.training_slice(s, table, *_SLICE).select(*_TRAINING)


def _frames(df: DataFrame) -> DataFrame:
    return R.distinct_categories(R.amount_vs_history(R.rolling_dispersion(R.rolling_amount(R.velocity(df)))))


def _labelled(s: SparkSession, d: str) -> DataFrame:
    return T.purchases_with_labels(s, d).select("txn_id", "card_id", "event_us", "label", "label_us")


def _labelled_stream(s: SparkSession, d: str) -> DataFrame:
    """Purchases whose label is closed, from two streams of the same files."""
    reports = _stream(s, d).where("category = 'error'").select("card_id", F.col("event_us").alias("report_us"), F.col("event_ts").alias("report_ts"))
    closed = L.attach_labels_stream(_stream(s, d).where("category = 'purchase'"), reports)
    return X.drained(closed.select("txn_id", "card_id", "event_us", "label", "label_us"), "labels")


def _scored(s: SparkSession, d: str) -> DataFrame:
    return T.training_set(s, d).withColumn("score", rule_score())


def _scores(s: SparkSession, d: str) -> DataFrame:
    return R.all_features(_txn(s, d)).withColumn("score", rule_score()).select("txn_id", "event_date", "score")


def _model_scores(s: SparkSession, d: str) -> DataFrame:
    rows = S.kept(T.planted_set(s, d), "planted")
    return P.score(rows, T.fit(rows.where(F.col("event_us") < T.T1_US))).select("txn_id", "label", "score")


def _model_scores_stream(s: SparkSession, d: str) -> DataFrame:
    """Features written to the store, then read as a stream and scored by the saved model."""
    rows = S.kept(T.planted_set(s, d), "planted")
    path = S.new_path(s, "models")
    T.save(T.fit(rows.where(F.col("event_us") < T.T1_US)), path, "planted")
    live = S.new_path(s, "live")
    rows.write.parquet(live)
    stream = s.readStream.schema(s.read.parquet(live).schema).parquet(live)
    return X.drained(P.score_stream(stream, T.load(path, "planted")).select("txn_id", "label", "score"), "model-scores")


def _fit_model(s: SparkSession, d: str) -> DataFrame:
    """How well each algorithm ranks the planted label after the time of training."""
    rows = S.kept(T.planted_set(s, d), "planted")
    out = None
    for algo, model in T.fit_each(rows.where(F.col("event_us") < T.T1_US), ["logistic", "forest", "boosted"]).items():
        own = T.auc(P.score(rows.where(F.col("event_us") >= T.T1_US), model)).withColumn("algorithm", F.lit(algo))
        out = own if out is None else out.unionByName(own)
    return out


def queries() -> dict[str, Query]:
    tumble = ["card_id", "start_us", "end_us", "cnt", "sum_cents"]
    return {
        "ingest_batch": lambda s, d: _txn(s, d).select(*_ALL),
        "ingest_stream": lambda s, d: X.drained(_stream(s, d).select(*_ALL), "ingest"),
        "conform": lambda s, d: I.conform(s.read.parquet(f"{d}/events.parquet")).select("txn_id", "event_us", "amount_cents", "attr_k"),
        "quarantine": _quarantine,
        "dedup_batch": _dedup_batch,
        "dedup_stream": lambda s, d: X.drained(X.dedup_stream(_stream(s, d)).select("txn_id", "card_id", "event_us"), "dedup"),
        "enrich_dim": lambda s, d: E.enrich(_txn(s, d), I.read_cards(s, d)).select("txn_id", "card_id", *_CARD),
        "enrich_stream": lambda s, d: X.drained(E.enrich(_stream(s, d), I.read_cards(s, d)).select("txn_id", "card_id", *_CARD), "enriched"),
        "enrich_unmatched": lambda s, d: E.unmatched(_txn(s, d), I.read_cards(s, d).where("acctbal_cents >= 0")).select("txn_id", "card_id"),
        "time_features": _feature(time_features, "hour", "day_of_week", "is_weekend", "is_night"),
        "amount_features": _feature(amount_features, "log_amount", "amount_band"),
        "asof_enrich": _asof,
        "velocity": _feature(R.velocity, "cnt_1h", "cnt_24h", "cnt_168h"),
        "rolling_amount": _feature(R.rolling_amount, "sum_168h", "avg_168h", "min_168h", "max_168h"),
        "rolling_dispersion": _feature(R.rolling_dispersion, "std_168h"),
        "amount_vs_history": _feature(R.amount_vs_history, "amount_ratio", "amount_z"),
        "txn_gap": _feature(R.txn_gap, "gap_us"),
        "distinct_categories": _feature(R.distinct_categories, "categories_168h"),
        "last_n": _feature(R.last_n, "avg_last_10"),
        "first_seen": _feature(R.first_seen, "is_first_in_category"),
        "category_baseline": _feature(R.category_baseline, "category_mean", "category_ratio"),
        "tumbling": lambda s, d: R.tumbling(_txn(s, d)).select(*tumble),
        "tumbling_stream": lambda s, d: X.drained(X.closed_windows(_stream(s, d)), "tumbling"),
        "sliding": lambda s, d: R.sliding(_txn(s, d)).select(*tumble),
        "session": lambda s, d: R.session(_txn(s, d)).select(*tumble),
        "rolling_stream": lambda s, d: X.drained(X.rolling_stream(_stream(s, d)), "rolling").select("txn_id", "cnt", "sum_cents"),
        "features_stream": lambda s, d: X.drained(N.features_stream(_stream(s, d)), "features").select("txn_id", *_STREAMED),
        "spread_frames": _feature(lambda df: R.spread(df, 168, _frames), "cnt_1h", "cnt_24h", "cnt_168h", "sum_168h", "avg_168h", "min_168h", "max_168h", "std_168h", "amount_ratio", "amount_z", "categories_168h"),
        "spread_hot": lambda s, d: R.spread_features(_txn(s, d), S.kept(R.hot_cards(_txn(s, d), _HOT), "hot")).select("txn_id", "cnt_1h", "cnt_24h", "cnt_168h", "sum_168h", "max_168h", "gap_us"),
        "asof_stream": _asof_stream,
        "dead_letters": _dead_letters,
        "top_cards": lambda s, d: R.top_cards(_txn(s, d)).select("event_date", "card_id", "sum_cents", "rank"),
        "store_append": _store_append,
        "store_stream": lambda s, d: X.drained(_stream(s, d).select(*_ALL), "store"),
        "store_upsert": _store_upsert,
        "store_pruned_read": _store_pruned,
        "store_evolve": _store_evolve,
        "store_compact": _store_compact,
        "label_delayed": _labelled,
        "label_stream": _labelled_stream,
        "label_maturity": lambda s, d: L.mature(_labelled(s, d)),
        "training_set": lambda s, d: T.training_set(s, d).select(*_TRAINING),
        "training_from_store": _training_from_store,
        "temporal_split": lambda s, d: L.split(_labelled(s, d), T.T1_US, T.T2_US).select("txn_id", "part", "label"),
        "class_weights": lambda s, d: L.weights(L.split(_labelled(s, d), T.T1_US, T.T2_US).where("part = 'train'")),
        "fit_model": _fit_model,
        "evaluate": lambda s, d: T.auc(_scored(s, d)),
        "threshold_sweep": lambda s, d: T.sweep(_scored(s, d)),
        "score_batch": _model_scores,
        "score_stream": _model_scores_stream,
        "decide": lambda s, d: P.decide(_scores(s, d), 20, 60).select("txn_id", "score", "decision"),
        "alert_budget": lambda s, d: P.top_alerts(_scores(s, d)).select("event_date", "txn_id", "score", "rank"),
        "alert_stream": _alert_stream,
        "serve_rules": P.serve_rules,
        "serve_model": P.serve_model,
    }


_H = 3_600_000_000
_BASE = f"""WITH txn AS (SELECT event_id AS txn_id, user_id AS card_id, epoch_us(ts) AS event_us, CAST(ts AS DATE) AS event_date, event_type AS category,
  CAST(round(value * 100) AS BIGINT) AS amount_cents, CAST(json_extract_string(props, '$.k') AS INT) AS attr_k FROM events),
cards AS (SELECT c_custkey AS card_id, c_mktsegment AS segment, n_name AS nation, r_name AS region, CAST(round(c_acctbal * 100) AS BIGINT) AS acctbal_cents
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
_WINDOWS = f"""WINDOW w1 AS (PARTITION BY card_id ORDER BY event_us RANGE BETWEEN {_H} PRECEDING AND 1 PRECEDING),
  w24 AS (PARTITION BY card_id ORDER BY event_us RANGE BETWEEN {24 * _H} PRECEDING AND 1 PRECEDING),
  w7 AS (PARTITION BY card_id ORDER BY event_us RANGE BETWEEN {168 * _H} PRECEDING AND 1 PRECEDING)"""
_SUM = "CAST(sum(amount_cents) OVER w7 AS BIGINT)"
_AVG = "CAST(sum(amount_cents) OVER w7 AS DOUBLE) / nullif(count(*) OVER w7, 0)"
_STD = "sqrt(CAST(count(*) OVER w7 * sum(amount_cents * amount_cents) OVER w7 - (sum(amount_cents) OVER w7) * (sum(amount_cents) OVER w7) AS DOUBLE)) / nullif(count(*) OVER w7, 0)"
_FEATURES = f""", features AS (SELECT *, count(*) OVER w1 AS cnt_1h, count(*) OVER w24 AS cnt_24h, count(*) OVER w7 AS cnt_168h, {_SUM} AS sum_168h, {_AVG} AS avg_168h,
  max(amount_cents) OVER w7 AS max_168h, event_us - lag(event_us) OVER (PARTITION BY card_id ORDER BY event_us, txn_id) AS gap_us FROM txn {_WINDOWS}),
scores AS (SELECT *, CAST(least(100, 10 * cnt_1h + 5 * cnt_24h + CASE WHEN amount_cents > 3 * avg_168h THEN 50 ELSE 0 END) AS INT) AS score FROM features)"""
_LABELS = f""", labelled AS (SELECT p.*, (SELECT min(e.event_us) FROM txn e WHERE e.category = 'error' AND e.card_id = p.card_id AND e.event_us > p.event_us
  AND e.event_us <= p.event_us + {6 * _H}) AS label_us FROM scores p WHERE category = 'purchase'),
known AS (SELECT *, CASE WHEN label_us IS NULL THEN 0 ELSE 1 END AS label FROM labelled), ripe AS (SELECT * FROM known WHERE event_us + {6 * _H} <= {L.CUTOFF_US})"""
_COLUMNS = ", ".join(_ALL)
_REASON = "CASE WHEN event_id IS NULL OR user_id IS NULL THEN 'no key' WHEN ts IS NULL THEN 'no time' WHEN value IS NULL OR isnan(value) THEN 'no amount' WHEN value < 0 THEN 'negative amount' WHEN NOT coalesce(json_valid(props), false) OR json_extract_string(props, '$.k') IS NULL THEN 'bad attributes' ELSE 'ok' END"
# an amount of zero stays zero when its sign is turned, so it is no negative one
_SPOILED = """SELECT event_id, CASE WHEN event_id % 19 = 0 THEN NULL ELSE user_id END AS user_id, CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END AS ts,
  CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN -value ELSE value END AS value, CASE WHEN event_id % 13 = 0 THEN '{broken' ELSE props END AS props FROM events"""


def _grouped(start: str, source: str, size: int) -> str:
    return f"SELECT card_id, {start} AS start_us, {start} + {size} AS end_us, count(*) AS cnt, CAST(sum(amount_cents) AS BIGINT) AS sum_cents FROM {source} GROUP BY card_id, {start}"


def oracle_sql() -> dict[str, str]:
    day = 24 * _H
    tumbling = _grouped(f"event_us // {day} * {day}", "txn", day)
    by_score = "SELECT score, CAST(sum(label) AS BIGINT) AS p, CAST(sum(1 - label) AS BIGINT) AS n FROM ripe GROUP BY score"
    part = f"CASE WHEN event_us < {T.T1_US} THEN 'train' WHEN event_us < {T.T2_US} THEN 'validation' ELSE 'test' END"
    decided = lambda a, b: f"CASE WHEN score < {a} THEN 'approve' WHEN score < {b} THEN 'review' ELSE 'decline' END AS decision"
    plain = {
        "ingest_batch": f"SELECT {_COLUMNS} FROM txn",
        "ingest_stream": f"SELECT {_COLUMNS} FROM txn",
        "conform": "SELECT txn_id, event_us, amount_cents, attr_k FROM txn",
        "quarantine": f"SELECT event_id, {_REASON} AS reason FROM events",
        "dedup_batch": "SELECT o_custkey, CAST(o_orderdate AS DATE) AS o_date, min(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL",
        "dedup_stream": "SELECT txn_id, card_id, event_us FROM txn",
        "enrich_dim": "SELECT txn_id, card_id, segment, nation, region, acctbal_cents FROM txn LEFT JOIN cards USING (card_id)",
        "enrich_stream": "SELECT txn_id, card_id, segment, nation, region, acctbal_cents FROM txn LEFT JOIN cards USING (card_id)",
        "enrich_unmatched": "SELECT txn_id, card_id FROM txn WHERE card_id NOT IN (SELECT card_id FROM cards WHERE acctbal_cents >= 0)",
        "time_features": f"SELECT txn_id, CAST(event_us // {_H} % 24 AS INT) AS hour, CAST(dayofweek(event_date) + 1 AS INT) AS day_of_week, dayofweek(event_date) IN (0, 6) AS is_weekend, (event_us // {_H} % 24 < 6 OR event_us // {_H} % 24 >= 22) AS is_night FROM txn",
        "amount_features": "SELECT txn_id, round(ln(1 + amount_cents / 100.0::DOUBLE), 6) AS log_amount, CAST(CASE WHEN amount_cents < 0 THEN 0 WHEN amount_cents >= 50000 THEN 11 ELSE amount_cents // 5000 + 1 END AS INT) AS amount_band FROM txn",
        "asof_enrich": "SELECT p.txn_id, v.event_us AS asof_view_us, v.amount_cents AS asof_amount_cents FROM (SELECT * FROM txn WHERE category = 'purchase') p ASOF LEFT JOIN (SELECT * FROM txn WHERE category = 'view') v ON p.card_id = v.card_id AND p.event_us >= v.event_us",
        "velocity": f"SELECT txn_id, count(*) OVER w1 AS cnt_1h, count(*) OVER w24 AS cnt_24h, count(*) OVER w7 AS cnt_168h FROM txn {_WINDOWS}",
        "rolling_amount": f"SELECT txn_id, {_SUM} AS sum_168h, {_AVG} AS avg_168h, min(amount_cents) OVER w7 AS min_168h, max(amount_cents) OVER w7 AS max_168h FROM txn {_WINDOWS}",
        "rolling_dispersion": f"SELECT txn_id, round({_STD}, 6) AS std_168h FROM txn {_WINDOWS}",
        "amount_vs_history": f"SELECT txn_id, round(amount_cents / nullif({_AVG}, 0), 6) AS amount_ratio, round((amount_cents - {_AVG}) / nullif({_STD}, 0), 6) AS amount_z FROM txn {_WINDOWS}",
        "txn_gap": "SELECT txn_id, event_us - lag(event_us) OVER (PARTITION BY card_id ORDER BY event_us, txn_id) AS gap_us FROM txn",
        "distinct_categories": f"SELECT txn_id, count(DISTINCT category) OVER w7 AS categories_168h FROM txn {_WINDOWS}",
        "last_n": "SELECT txn_id, CAST(sum(amount_cents) OVER w AS DOUBLE) / nullif(count(*) OVER w, 0) AS avg_last_10 FROM txn WINDOW w AS (PARTITION BY card_id ORDER BY event_us, txn_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)",
        "first_seen": "SELECT txn_id, row_number() OVER (PARTITION BY card_id, category ORDER BY event_us, txn_id) = 1 AS is_first_in_category FROM txn",
        "category_baseline": "SELECT txn_id, m AS category_mean, round(amount_cents / m, 6) AS category_ratio FROM txn JOIN (SELECT category, event_date, CAST(sum(s) OVER w AS DOUBLE) / sum(n) OVER w AS m FROM (SELECT category, event_date, sum(amount_cents) AS s, count(*) AS n FROM txn GROUP BY ALL) WINDOW w AS (PARTITION BY category ORDER BY event_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) USING (category, event_date)",
        "tumbling": tumbling,
        "tumbling_stream": f"SELECT * FROM ({tumbling}) WHERE end_us <= (SELECT max(event_us) FROM txn) // 1000 * 1000 - {2 * day}",
        "sliding": _grouped("start", f"(SELECT *, (event_us // {6 * _H} - k) * {6 * _H} AS start FROM txn, range(4) AS s(k))", day),
        "session": f"SELECT card_id, min(event_us) AS start_us, max(event_us) + {2 * _H} AS end_us, count(*) AS cnt, CAST(sum(amount_cents) AS BIGINT) AS sum_cents FROM (SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY card_id ORDER BY event_us, txn_id) AS g FROM (SELECT *, coalesce(event_us - lag(event_us) OVER (PARTITION BY card_id ORDER BY event_us, txn_id) >= {2 * _H}, true) AS new FROM txn)) GROUP BY card_id, g",
        "rolling_stream": f"SELECT txn_id, count(*) OVER w24 AS cnt, CAST(sum(amount_cents) OVER w24 AS BIGINT) AS sum_cents FROM txn {_WINDOWS}",
        "features_stream": f"SELECT txn_id, count(*) OVER w1 AS cnt_1h, count(*) OVER w24 AS cnt_24h, count(*) OVER w7 AS cnt_168h, {_SUM} AS sum_168h, {_AVG} AS avg_168h, min(amount_cents) OVER w7 AS min_168h, max(amount_cents) OVER w7 AS max_168h, event_us - lag(event_us) OVER o AS gap_us, count(DISTINCT category) OVER w7 AS categories_168h, CAST(sum(amount_cents) OVER w10 AS DOUBLE) / nullif(count(*) OVER w10, 0) AS avg_last_10, row_number() OVER oc = 1 AS is_first_in_category FROM txn {_WINDOWS}, o AS (PARTITION BY card_id ORDER BY event_us, txn_id), oc AS (PARTITION BY card_id, category ORDER BY event_us, txn_id), w10 AS (PARTITION BY card_id ORDER BY event_us, txn_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)",
        "spread_frames": f"SELECT txn_id, count(*) OVER w1 AS cnt_1h, count(*) OVER w24 AS cnt_24h, count(*) OVER w7 AS cnt_168h, {_SUM} AS sum_168h, {_AVG} AS avg_168h, min(amount_cents) OVER w7 AS min_168h, max(amount_cents) OVER w7 AS max_168h, round({_STD}, 6) AS std_168h, round(amount_cents / nullif({_AVG}, 0), 6) AS amount_ratio, round((amount_cents - {_AVG}) / nullif({_STD}, 0), 6) AS amount_z, count(DISTINCT category) OVER w7 AS categories_168h FROM txn {_WINDOWS}",
        "spread_hot": f"SELECT txn_id, count(*) OVER w1 AS cnt_1h, count(*) OVER w24 AS cnt_24h, count(*) OVER w7 AS cnt_168h, {_SUM} AS sum_168h, max(amount_cents) OVER w7 AS max_168h, event_us - lag(event_us) OVER (PARTITION BY card_id ORDER BY event_us, txn_id) AS gap_us FROM txn {_WINDOWS}",
        "asof_stream": f"SELECT p.txn_id, v.event_us AS asof_view_us, v.amount_cents AS asof_amount_cents FROM (SELECT * FROM txn WHERE category = 'purchase') p ASOF LEFT JOIN (SELECT * FROM txn WHERE category = 'view') v ON p.card_id = v.card_id AND p.event_us >= v.event_us WHERE (p.event_us // {_H} + 1) * {_H} <= (SELECT max(event_us) FROM txn WHERE category IN ('view', 'purchase')) // 1000 * 1000 - {48 * _H}",
        "dead_letters": f"SELECT event_id, reason, CASE WHEN reason = 'ok' THEN CAST(round(value * 100) AS BIGINT) END AS amount_cents FROM (SELECT *, {_REASON} AS reason FROM ({_SPOILED}))",
        "top_cards": "SELECT event_date, card_id, sum_cents, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY event_date ORDER BY sum_cents DESC, card_id) AS r FROM (SELECT event_date, card_id, CAST(sum(amount_cents) AS BIGINT) AS sum_cents FROM txn GROUP BY ALL)) WHERE r <= 3",
        "store_append": f"SELECT {_COLUMNS} FROM txn",
        "store_stream": f"SELECT {_COLUMNS} FROM txn",
        "store_upsert": "SELECT txn_id, card_id, event_us, CASE WHEN event_date IN ('2024-01-05', '2024-01-11') THEN CAST(event_date + 60 AS DATE) ELSE event_date END AS event_date, category, CASE WHEN category = 'error' THEN 0 ELSE amount_cents END AS amount_cents, attr_k FROM txn UNION ALL SELECT -txn_id - 1, card_id, event_us, event_date, category, amount_cents, attr_k FROM txn WHERE category = 'signup'",
        "store_pruned_read": f"SELECT {_COLUMNS} FROM txn WHERE event_date BETWEEN '2024-01-10' AND '2024-01-19'",
        "store_evolve": "SELECT txn_id, event_date, CASE WHEN event_date >= '2024-01-15' THEN category END AS category, amount_cents FROM txn",
        "store_compact": f"SELECT {_COLUMNS} FROM txn UNION ALL SELECT -txn_id - 1, card_id, event_us, event_date, category, amount_cents, attr_k FROM txn WHERE category = 'error'",
    }
    deep = {
        "label_delayed": "SELECT txn_id, card_id, event_us, label, label_us FROM known",
        "label_stream": f"SELECT txn_id, card_id, event_us, label, label_us FROM known WHERE event_us < (SELECT least(max(event_us) FILTER (category = 'purchase'), max(event_us) FILTER (category = 'error')) FROM txn) // 1000 * 1000 - {2 * day + L.HORIZON_US}",
        "label_maturity": "SELECT txn_id, card_id, event_us, label, label_us FROM ripe",
        "training_set": "SELECT txn_id, amount_cents, cnt_1h, cnt_24h, cnt_168h, sum_168h, avg_168h, max_168h, gap_us, label FROM ripe",
        "alert_stream": "SELECT event_date, txn_id, score FROM scores QUALIFY row_number() OVER (PARTITION BY event_date ORDER BY score DESC, txn_id) <= 10",
        "temporal_split": f"SELECT txn_id, {part} AS part, label FROM known",
        "class_weights": f"SELECT label, n, CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n) AS weight FROM (SELECT label, count(*) AS n FROM known WHERE {part} = 'train' GROUP BY label)",
        "evaluate": f"SELECT round(CAST(sum(n * (2 * tp - p)) AS DOUBLE) / nullif(2 * sum(p) * sum(n), 0), 9) AS roc_auc, round(sum(p * tp / CAST(tp + fp AS DOUBLE)) / nullif(sum(p), 0), 9) AS pr_auc, CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives FROM (SELECT *, sum(p) OVER d AS tp, sum(n) OVER d AS fp FROM ({by_score}) WINDOW d AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))",
        "threshold_sweep": f"SELECT threshold, tp, fp, CAST(pos - tp AS BIGINT) AS fn, CAST(neg - fp AS BIGINT) AS tn, round(tp / CAST(tp + fp AS DOUBLE), 9) AS precision, round(tp / CAST(nullif(pos, 0) AS DOUBLE), 9) AS recall FROM (SELECT score AS threshold, CAST(sum(p) OVER d AS BIGINT) AS tp, CAST(sum(n) OVER d AS BIGINT) AS fp, sum(p) OVER () AS pos, sum(n) OVER () AS neg FROM ({by_score}) WINDOW d AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))",
        "decide": f"SELECT txn_id, score, {decided(20, 60)} FROM scores",
        "alert_budget": "SELECT event_date, txn_id, score, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY event_date ORDER BY score DESC, txn_id) AS r FROM scores) WHERE r <= 10",
        "serve_rules": f"SELECT txn_id, card_id, event_us, cnt_24h AS cnt, CAST(sum_24h AS BIGINT) AS sum_cents, segment, nation, score, {decided(20, 50)} FROM (SELECT txn_id, card_id, event_us, count(*) OVER w24 AS cnt_24h, sum(amount_cents) OVER w24 AS sum_24h, CAST(least(100, 10 * count(*) OVER w24) AS INT) AS score FROM txn {_WINDOWS}) LEFT JOIN cards USING (card_id)",
    }
    # eight days before the slice and one after it are read
    read = _BASE.replace("FROM events)", f"FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '{_SLICE[0]}' - 8 AND DATE '{_SLICE[1]}' + 1)")
    sliced = {"training_from_store": f"SELECT {', '.join(_TRAINING)} FROM ripe WHERE event_date BETWEEN '{_SLICE[0]}' AND '{_SLICE[1]}'"}
    return {k: f"{base} {q}" for base, found in ((_BASE, plain), (f"{_BASE}{_FEATURES}{_LABELS}", deep), (f"{read}{_FEATURES}{_LABELS}", sliced)) for k, q in found.items()}
