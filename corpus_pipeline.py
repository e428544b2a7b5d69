"""The corpus pipeline: five stages over ``documents``, each written before the next reads it.

Toxicity, near duplicates, benchmark decontamination, personal data, packing.
All but the last stage return the columns of ``documents``, and more if there are
more, whatever their names. Each decision depends on a row's own text and the
tables. A null text is empty; null ids name nothing, so such rows are told apart
by their texts; an empty table stays empty; texts of any length are read whole.
Rows that repeat an id and a text become one at the second stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudflow.llm.common import read_table, scratch_path, text_keys, written
from fraudflow.llm.decontaminate import BROADCAST_BYTES, contamination
from fraudflow.llm.near_dedup import near_duplicates
from fraudflow.llm.packing import pack_documents
from fraudflow.llm.pii import pseudonyms
from fraudflow.llm.toxicity import fit, scored
from fraudflow.session import ship_package

#: Key of the pseudonyms where the session sets none: published, so good for made-up tables only.
OPEN_KEY = "made-up tables"

#: SQL cannot express compression distances, signatures, Feistel networks or tokenizers: the stages are tested against brute force.
ORACLE_SQL = None


def _named(docs: DataFrame) -> DataFrame:
    """(name, text): the name is the id, which may be null or repeated, and the keys of the text; least where the id is."""
    keys = text_keys(F.coalesce("text", F.lit("")))
    return docs.select(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), *keys).alias("name"), "text")


def _kept(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` but those whose id and text are named in ``gone`` (name).

    The names are written first. They are broadcast below ``BROADCAST_BYTES``, so
    texts stay where they are; beyond it Spark shuffles both sides.
    """
    gone = written(gone.select(F.col("name.id").alias("id"), F.col("name.k1").alias("k1"), F.col("name.k2").alias("k2")).distinct(), "gone")
    size = F.sum(F.coalesce(F.octet_length(F.col("id").cast("string")), F.lit(0)) + 32)
    if (gone.agg(size.alias("bytes")).first().bytes or 0) <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    k1, k2 = text_keys(F.coalesce(docs["text"], F.lit("")))
    # columns of their frames: docs may have columns of these names
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["id"]) & (k1 == gone["k1"]) & (k2 == gone["k2"]), "left_anti")


def _beside(docs: DataFrame) -> DataFrame:
    """(row, text): all columns but the text in one, to pass through an operator as its key."""
    return docs.select(F.struct(*(c for c in docs.columns if c != "text")).alias("row"), "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    ship_package(spark)
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    kept = scored(_beside(docs), model, key="row").where("predicted = 0")
    return kept.select(*(F.col("text") if c == "text" else F.col(f"row.{c}") for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id (and text keys) of each class; of rows that repeat id and text the least by all columns stays."""
    ship_package(spark)
    classes = near_duplicates(_named(docs), key="name")
    kept = _kept(docs, classes.where("name != class_id"))
    # rows of one name stay or go together, so the names of all rows tell whether any repeats; no text is moved for it
    again = _named(docs).groupBy("name").count().where("count > 1")
    if again.isEmpty():
        return kept
    k1, k2 = text_keys(F.coalesce("text", F.lit("")))
    rows = kept.select(F.struct(*kept.columns).alias("row"), F.struct("doc_id", k1, k2).alias("named"))
    return rows.groupBy("named").agg(F.min("row").alias("row")).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    ship_package(spark)
    found = contamination(_named(docs), read_table(spark, sf_dir, "benchmark"), key="name")
    return _kept(docs, found.where("contaminated"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data; their length is counted again."""
    ship_package(spark)
    done = pseudonyms(_beside(docs), key="row", secret_key=spark.conf.get("spark.fraudflow.pii.key", OPEN_KEY))
    text = F.col("new_text")
    values = {"text": text, "n_chars": F.length(text).cast("long")}
    return done.select(*(values.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the tokens of each document lie in the training sequences."""
    ship_package(spark)
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", pseudonymise),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
