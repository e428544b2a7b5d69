"""Scoring live transactions (P1 to P4) and the whole serving stream."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from fraudflow.operators.enrich import enrich
from fraudflow.operators.store import kept
from fraudflow.plans.train import NUMBERS, T1_US, current, fit, load, numbers, planted_set
from fraudflow.sources.transactions import read_cards, split_valid, stream_path, stream_raw, stream_valid
from fraudflow.streaming.panes import features_stream
from fraudflow.streaming.streams import dedup_stream, drained_with_rejected, rolling_stream, sink, with_rejected, with_rocksdb


def score(df: DataFrame, model: PipelineModel, columns: list[str] = NUMBERS) -> DataFrame:
    """Adds the probability of fraud, rounded so that ties are ties everywhere; batch or stream."""
    return model.transform(numbers(df, columns)).withColumn("score", F.round(vector_to_array("probability")[1], 9)).select(*df.columns, "score")


score_stream = score


def decide(scored: DataFrame, approve_below: float, decline_at: float, column: str = "score") -> DataFrame:
    """approve, review or decline; a score at an edge belongs to the stricter side."""
    return scored.withColumn("decision", decision(F.col(column), approve_below, decline_at))


def decision(value: Column, approve_below: float, decline_at: float) -> Column:
    return F.when(value < approve_below, "approve").when(value < decline_at, "review").otherwise("decline")


def top_alerts(scored: DataFrame, k: int = 10, column: str = "score") -> DataFrame:
    """The ``k`` highest scores of each day."""
    w = Window.partitionBy("event_date").orderBy(F.desc(column), "txn_id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def serve_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source to scores as one stream: validate, deduplicate, roll, enrich, decide, write.

    Scores by rule (10 for each transaction of the last 24 hours), so results
    can be checked without a model.
    """
    with_rocksdb(spark)
    good, bad = stream_valid(spark, stream_path(sf_dir))
    rolled = enrich(rolling_stream(dedup_stream(good), expires=True, late_dropped=True), read_cards(spark, sf_dir))
    scored = rolled.withColumn("score", F.least(F.lit(100), 10 * F.col("cnt")).cast("int"))
    served, _ = drained_with_rejected(with_rejected(decide(scored, 20, 50), bad), "scores")
    return served.select("txn_id", "card_id", "event_us", "cnt", "sum_cents", "segment", "nation", "score", "decision")


def featured(raw: DataFrame, cards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of a raw stream: deduplicated with all features of training and the card's attributes, and rejected."""
    good, bad = split_valid(raw)
    made = features_stream(dedup_stream(good), expires=True, late_dropped=True)
    return enrich(made, cards).withColumn("event_date", F.to_date(F.timestamp_micros("event_us"))), bad


def serving(raw: DataFrame, cards: DataFrame, model: PipelineModel) -> DataFrame:
    """Scored and decided transactions of a raw stream, with the rejected rows, for a sink with ``rejected``."""
    good, bad = featured(raw, cards)
    return with_rejected(decide(score_stream(good, model), 0.5, 0.9), bad)


class CurrentModel:
    """Scores batches with the model that is current when each begins; for the ``prepare`` of a sink.

    A promoted model is loaded between two batches of a running stream; one that
    takes other features is refused, which stops the stream. Each row says which
    model scored it.
    """

    def __init__(self, path: str, columns: list[str] = NUMBERS):
        self.path, self.columns = path, columns
        self.model_id: str | None = None
        self.model: PipelineModel | None = None

    def __call__(self, batch: DataFrame) -> DataFrame:
        wanted = current(self.path)
        if wanted is None:
            raise ValueError(f"no model in {self.path} is current")
        if wanted != self.model_id:
            self.model, self.model_id = load(self.path, wanted, self.columns), wanted
        return decide(score(batch, self.model, self.columns), 0.5, 0.9).withColumn("model_id", F.lit(wanted))


def serve_current(raw: DataFrame, cards: DataFrame, models: str, table: str, rejected: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Serves a raw stream with whatever model is current in ``models``; scores by date, rejected rows beside them."""
    return sink(with_rejected(*featured(raw, cards)), table, checkpoint, CurrentModel(models), every, rejected)


def serve_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain with a model fitted on history: files to decisions as one stream.

    The stream makes every feature that the model was trained on. A live service
    starts the same frame with ``sink(..., every="1 second")``.
    """
    with_rocksdb(spark)
    history = kept(planted_set(spark, sf_dir), "history")
    model = fit(history.where(F.col("event_us") < T1_US))
    served, _ = drained_with_rejected(serving(stream_raw(spark, stream_path(sf_dir)), read_cards(spark, sf_dir), model), "served")
    return served.select("txn_id", "card_id", "event_us", *NUMBERS[1:], "segment", "nation", "score", "decision")
