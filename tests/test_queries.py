"""Every query against DuckDB on the same tables."""

import pytest
from conftest import SF

from fraudflow.plans import queries as plans

SQL = plans.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(agree, name):
    agree(plans.queries()[name], SQL[name])


def test_dead_letters_of_zero_amounts_equal_sql(spark, tmp_path):
    """Amounts of zero under ids whose sign is turned (22), of one that is negative (3) and one that is turned back (33)."""
    import datetime

    import duckdb

    from fraudflow.sources.transactions import RAW

    at = datetime.datetime(2024, 1, 1)
    rows = [(i, at, 1, "view", v, '{"k": 1}') for i, v in ((1, 5.0), (2, 0.0), (3, -4.0), (22, 0.0), (33, -6.0), (44, 6.0), (7, 1.0), (13, 1.0), (17, 1.0), (19, 1.0))]
    spark.createDataFrame(rows, RAW).coalesce(1).write.parquet(f"file://{tmp_path}/events.parquet")
    found = plans.queries()["dead_letters"](spark, f"file://{tmp_path}").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    want = con.execute(SQL["dead_letters"]).fetchall()
    assert sorted((r.event_id, r.reason, r.amount_cents) for r in found) == sorted(want)
    assert {22: "ok", 3: "negative amount", 33: "ok", 44: "negative amount"}.items() <= {r.event_id: r.reason for r in found}.items()


def test_models_rank_the_planted_label(spark):
    for row in plans.queries()["fit_model"](spark, SF).collect():
        assert row.roc_auc > 0.9


def test_rows_are_encoded_once_for_all_algorithms(spark, monkeypatch):
    from fraudflow.plans import train

    rows, coders, made = train.planted_set(spark, SF), [], train.encoder
    monkeypatch.setattr(train, "encoder", lambda *a: coders.append(a) or made(*a))
    models = train.fit_each(rows, ["logistic", "forest"])
    assert len(coders) == 1 and list(models) == ["logistic", "forest"]
    alone = train.fit(rows, "logistic")
    a, b = ([round(v, 9) for v in m.stages[-1].coefficients] for m in (models["logistic"], alone))
    assert a == b and len(alone.stages) == 5


def test_stream_scores_equal_batch_scores(spark):
    made = [plans.queries()[n](spark, SF) for n in ("score_batch", "score_stream")]
    a, b = ({(r.txn_id, r.score) for r in df.collect()} for df in made)
    assert a == b


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
