"""Training, evaluation and the model store."""

from __future__ import annotations

import datetime
import json
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fraudflow.operators.features import all_features
from fraudflow.operators.labels import CUTOFF_US, HORIZON_US, attach_labels, mature, weights
from fraudflow.operators.store import Files, kept, read_range
from fraudflow.sources.transactions import read_transactions

T1_US, T2_US = 1_705_708_800_000_000, 1_706_140_800_000_000  # 2024-01-20, 2024-01-25
NUMBERS = ["amount_cents", "cnt_1h", "cnt_24h", "cnt_168h", "avg_168h", "max_168h", "gap_us"]


def purchases_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with features as of each, and labels from later ``error`` reports."""
    return labelled(read_transactions(spark, sf_dir))


def labelled(txn: DataFrame) -> DataFrame:
    """The same of any transactions."""
    reports = txn.where("category = 'error'").select("card_id", F.col("event_us").alias("report_us"))
    return attach_labels(all_features(txn).where("category = 'purchase'"), reports, HORIZON_US)


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features joined to matured labels."""
    return mature(purchases_with_labels(spark, sf_dir))


def training_slice(spark: SparkSession, table: str, first: str, last: str, cutoff_us: int = CUTOFF_US, warm_up_days: int = 8) -> DataFrame:
    """The training set of the dates ``first`` to ``last`` from a stored table, also one that a stream has written.

    Only folders of these dates are opened, of ``warm_up_days`` before, which the
    frames need, and of the day after, where reports of the last purchases are.
    A gap that is longer than the warm-up is null.
    """
    day = datetime.timedelta(days=1)
    begin, end = (datetime.date.fromisoformat(d) for d in (first, last))
    rows = read_range(spark, table, str(begin - warm_up_days * day), str(end + day))
    inside = F.col("event_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return mature(labelled(rows).where(inside), cutoff_us)


def run(spark: SparkSession, table: str, first: str, last: str, path: str, model_id: str, cutoff_us: int = CUTOFF_US, algo: str = "logistic", seed: int = 7) -> str:
    """Trains on a slice of a stored table and stores the model with what it was made from."""
    rows = kept(training_slice(spark, table, first, last, cutoff_us), "slice")
    model = fit(rows, algo, seed)
    return save(model, path, model_id, NUMBERS, cutoff_us=cutoff_us, seed=seed, algo=algo, table=table, first=first, last=last)


def planted_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transactions with a label that follows from their features: tests that training can learn."""
    label = (F.col("amount_cents") > 3 * F.col("avg_168h")) & (F.col("cnt_24h") >= 2)
    return all_features(read_transactions(spark, sf_dir)).withColumn("label", F.coalesce(label, F.lit(False)).cast("int"))


def encoder(columns: list[str] = NUMBERS, category: str | None = "category") -> list:
    """Category index and one-hot, cold nulls filled, one vector."""
    own = [f"{c}_f" for c in columns]
    filled = Imputer(inputCols=[f"{c}_d" for c in columns], outputCols=own)
    if category is None:
        return [filled, VectorAssembler(inputCols=own, outputCol="features")]
    return [
        StringIndexer(inputCol=category, outputCol="category_i", handleInvalid="keep"),
        OneHotEncoder(inputCols=["category_i"], outputCols=["category_v"]),
        filled,
        VectorAssembler(inputCols=["category_v", *own], outputCol="features"),
    ]


def numbers(df: DataFrame, columns: list[str] = NUMBERS) -> DataFrame:
    """The numeric features as doubles, the type that imputation takes; large amounts on a log scale."""
    scaled = {c: F.log1p(F.col(c).cast("double")) if c.endswith(("cents", "us")) or c[:3] in ("avg", "max") else F.col(c).cast("double") for c in columns}
    return df.withColumns({f"{c}_d": v for c, v in scaled.items()})


def classifier(algo: str, seed: int = 7):
    common = {"labelCol": "label", "weightCol": "weight"}
    return {
        "logistic": lambda: LogisticRegression(maxIter=50, regParam=0.01, **common),
        "forest": lambda: RandomForestClassifier(numTrees=30, maxDepth=6, seed=seed, **common),
        "boosted": lambda: GBTClassifier(maxIter=20, maxDepth=4, seed=seed, **common),
    }[algo]()


def fit(train: DataFrame, algo: str = "logistic", seed: int = 7, columns: list[str] = NUMBERS, category: str | None = "category") -> PipelineModel:
    """A pipeline of encoder and classifier, classes balanced by weight."""
    return fit_each(train, [algo], seed, columns, category)[algo]


def fit_each(train: DataFrame, algos: list[str], seed: int = 7, columns: list[str] = NUMBERS, category: str | None = "category") -> dict[str, PipelineModel]:
    """A pipeline for each algorithm; the rows are weighed, encoded and written once for all."""
    spark = train.sparkSession
    rows = numbers(train, columns).join(F.broadcast(weights(train).select("label", "weight")), "label")
    coder = Pipeline(stages=encoder(columns, category)).fit(rows)
    coded = kept(coder.transform(rows).select("features", "label", "weight"), "encoded")
    # their many small jobs run side by side
    with ThreadPool(len(algos)) as pool:
        made = pool.map(inheritable_thread_target(spark)(lambda algo: classifier(algo, seed).fit(coded)), algos)
    return {algo: PipelineModel([*coder.stages, model]) for algo, model in zip(algos, made, strict=True)}


META, CURRENT = "fraudflow.json", "current"


def save(model: PipelineModel, path: str, model_id: str, columns: list[str] = NUMBERS, **made_from) -> str:
    """Stores a fitted pipeline under its id, with its features and what it was made from: cutoff, seed and so on.

    The description is written last, so a model that was saved in part has none.
    """
    spark = SparkSession.getActiveSession()
    files = Files(spark, f"{path}/{model_id}")
    files.delete(META)
    model.write().overwrite().save(f"{path}/{model_id}")
    files.write(META, json.dumps({"model_id": model_id, "columns": columns, **made_from}))
    return f"{path}/{model_id}"


def described(path: str, model_id: str) -> dict:
    """What is known of a stored model."""
    text = Files(SparkSession.getActiveSession(), f"{path}/{model_id}").read(META)
    if text is None:
        raise ValueError(f"no whole model {model_id} in {path}")
    return json.loads(text)


def load(path: str, model_id: str, columns: list[str] = NUMBERS) -> PipelineModel:
    """A stored pipeline; refused if it was fitted on other features than ``columns``."""
    wants = described(path, model_id)["columns"]
    if wants != columns:
        raise ValueError(f"model {model_id} takes {wants}, not {columns}")
    return PipelineModel.load(f"{path}/{model_id}")


def promote(path: str, model_id: str) -> None:
    """Makes a whole stored model the current one, at once for all who look."""
    described(path, model_id)
    Files(SparkSession.getActiveSession(), path).write(CURRENT, model_id)


def current(path: str) -> str | None:
    """The id of the current model."""
    return Files(SparkSession.getActiveSession(), path).read(CURRENT)


def _running(scored: DataFrame, score: str, label: str) -> DataFrame:
    """(s, p, n, tp, fp): positives and negatives of each score, and of all at or above it.

    Scores are dealt by range, so each task sums its own; the sums of the ranges,
    as many as there are partitions, are added by a small join.
    """
    by = scored.groupBy(F.col(score).alias("s")).agg(F.sum(label).cast("long").alias("p"), F.sum(1 - F.col(label)).cast("long").alias("n"))
    by = kept(by.repartitionByRange(F.desc("s")).withColumn("part", F.spark_partition_id()), "scores")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = by.groupBy("part").agg(F.sum("p").alias("pp"), F.sum("n").alias("nn"))
    parts = parts.select("part", F.coalesce(F.sum("pp").over(before), F.lit(0)).alias("p0"), F.coalesce(F.sum("nn").over(before), F.lit(0)).alias("n0"))
    down = Window.partitionBy("part").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    return by.join(parts, "part").select("s", "p", "n", (F.col("p0") + F.sum("p").over(down)).alias("tp"), (F.col("n0") + F.sum("n").over(down)).alias("fp"))


def auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Areas under the ROC curve, ties counted half, and under precision and recall by steps."""
    by = _running(scored, score, label)
    # a negative of this score loses to all positives above it, and half to those of its own
    twice = by.select((F.col("n") * (2 * F.col("tp") - F.col("p"))).alias("w"), (F.col("p") * F.col("tp") / (F.col("tp") + F.col("fp")).cast("double")).alias("a"), "p", "n")
    total = twice.agg(F.sum("w").alias("w"), F.sum("a").alias("a"), F.sum("p").alias("p"), F.sum("n").alias("n"))
    return total.select(
        F.round(F.col("w").cast("double") / F.nullif(2 * F.col("p") * F.col("n"), F.lit(0)), 9).alias("roc_auc"),
        F.round(F.col("a") / F.nullif(F.col("p"), F.lit(0)), 9).alias("pr_auc"), F.col("p").alias("positives"), F.col("n").alias("negatives"),
    )


def sweep(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Confusion counts, precision and recall if all at or above each score are declined."""
    by = _running(scored, score, label)
    total = by.agg(F.sum("p").alias("pos"), F.sum("n").alias("neg"))
    return by.withColumnRenamed("s", "threshold").join(F.broadcast(total)).select(
        "threshold", "tp", "fp", (F.col("pos") - F.col("tp")).alias("fn"), (F.col("neg") - F.col("fp")).alias("tn"),
        F.round(F.col("tp") / (F.col("tp") + F.col("fp")).cast("double"), 9).alias("precision"), F.round(F.col("tp") / F.nullif(F.col("pos"), F.lit(0)).cast("double"), 9).alias("recall"),
    )


__all__ = ["auc", "encoder", "fit", "fit_each", "load", "labelled", "numbers", "planted_set", "promote", "purchases_with_labels", "run", "save", "sweep", "training_set", "training_slice"]
