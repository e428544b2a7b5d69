"""The lakehouse store (S1 to S7): Iceberg where a catalog ``lake`` is set, partitioned Parquet otherwise.

A Parquet table is a folder with a folder for each date, and its schema beside
them in ``_schema``, so no read has to open files to learn it. What replaces
files (a batch of a stream, an upsert, a compaction) is first written whole to a
staging folder; then a journal entry names the files to move in and those to
delete, and is carried out. A writer that finds an entry of a lost one carries
it out again, so a table ends either without the change or with all of it.
Readers may see it half done meanwhile; Iceberg's commits are atomic.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudflow.operators.enrich import dedup

PARTITION = "event_date"
SCHEMA, JOURNAL, STAGING, BATCHES = "_schema", "_journal", "_staging", "_batches"


def has_iceberg(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.catalog.lake", None) is not None


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for checkpoints, models and copies."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="fraudflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def new_table(spark: SparkSession, name: str) -> str:
    """A place for a table: a name in the catalog, or a path in the shared folder."""
    return f"lake.{name.replace('-', '_')}_{uuid.uuid4().hex}" if has_iceberg(spark) else new_path(spark, name)


@dataclass(frozen=True)
class Files:
    """Small files and names in a folder of any file system that Spark knows."""

    spark: SparkSession
    root: str

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def exists(self, name: str = "") -> bool:
        fs, path = self._at(name)
        return fs.exists(path)

    def names(self, name: str = "") -> list[str]:
        """Names in a folder, but those of files that are being written."""
        fs, path = self._at(name)
        found = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(n for n in found if not n.endswith(".new"))

    def read(self, name: str) -> str | None:
        fs, path = self._at(name)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Writes a file whole: it appears at once, in place of an older one."""
        fs, path = self._at(name)
        _, fresh = self._at(f"{name}.{uuid.uuid4().hex}.new")
        stream = fs.create(fresh, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), self.spark._jsc.hadoopConfiguration())
        overwrite = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = overwrite
        context.rename(fresh, path, options)

    def move(self, name: str, to: str) -> None:
        """Moves a file; one that was moved already stays."""
        fs, path = self._at(name)
        _, target = self._at(to)
        if fs.exists(path):
            fs.mkdirs(target.getParent())
            fs.delete(target, False)
            if not fs.rename(path, target):
                raise OSError(f"cannot move {path.toString()} to {target.toString()}")

    def delete(self, name: str = "") -> None:
        fs, path = self._at(name)
        fs.delete(path, True)


def discard(spark: SparkSession, *paths: str) -> None:
    """Deletes folders that nothing reads any more."""
    for path in paths:
        Files(spark, path).delete()


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read again, for what is used several times."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, key: str = "txn_id", files: int = 4) -> DataFrame:
    """Rows of a date go to at most ``files`` tasks, and so to as many files."""
    return df.repartition(PARTITION, F.pmod(F.xxhash64(key), F.lit(files)))


def schema_of(spark: SparkSession, table: str) -> T.StructType | None:
    """The schema kept beside a Parquet table; None if there is none."""
    text = Files(spark, table).read(SCHEMA)
    return T.StructType.fromJson(json.loads(text)) if text else None


def keep_schema(spark: SparkSession, table: str, new: T.StructType) -> T.StructType:
    """Adds the columns of ``new`` to the schema of a Parquet table; a column keeps its type."""
    have = schema_of(spark, table)
    fields = {f.name: T.StructField(f.name, f.dataType, True) for f in (have.fields if have else [])}
    for f in new.fields:
        if f.name in fields and fields[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} is {fields[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
        fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    merged = T.StructType(list(fields.values()))
    if merged != have:
        Files(spark, table).write(SCHEMA, merged.json())
    return merged


def _apply(files: Files, entry: str) -> None:
    change = json.loads(files.read(f"{JOURNAL}/{entry}"))
    for source, target in change["moves"]:
        files.move(source, target)
    for name in change["gone"]:
        files.delete(name)
    for folder in {n.split("/")[0] for n in change["gone"]}:
        if not [n for n in files.names(folder) if not n.startswith(("_", "."))]:
            files.delete(folder)
    files.delete(change["staging"])
    files.delete(f"{JOURNAL}/{entry}")


def recovered(spark: SparkSession, table: str) -> Files:
    """The files of a Parquet table, after the changes of lost writers are carried out."""
    files = Files(spark, table)
    for entry in files.names(JOURNAL):
        if entry.endswith(".json"):
            _apply(files, entry)
    return files


def data_files(files: Files, day: str) -> list[str]:
    """Names of the data files of a date, below the table."""
    return [f"{PARTITION}={day}/{n}" for n in files.names(f"{PARTITION}={day}") if not n.startswith(("_", "."))]


def days_of(files: Files) -> list[str]:
    return [n.removeprefix(f"{PARTITION}=") for n in files.names() if n.startswith(f"{PARTITION}=")]


def replace(df: DataFrame, table: str, gone: list[str], prefix: str) -> None:
    """Puts the rows of ``df`` in place of the files ``gone`` in one journalled change; new files begin with ``prefix``."""
    spark = df.sparkSession
    files = recovered(spark, table)
    keep_schema(spark, table, df.schema)
    staging = f"{STAGING}/{uuid.uuid4().hex}"
    df.write.partitionBy(PARTITION).parquet(f"{table}/{staging}")
    moves = []
    for day in files.names(staging):
        if day.startswith(f"{PARTITION}="):
            names = [n for n in files.names(f"{staging}/{day}") if n.endswith(".parquet")]
            moves += [(f"{staging}/{day}/{n}", f"{day}/{prefix}-{i:05d}.parquet") for i, n in enumerate(names)]
    targets = {to for _, to in moves}
    entry = f"{uuid.uuid4().hex}.json"
    files.write(f"{JOURNAL}/{entry}", json.dumps({"moves": moves, "gone": [g for g in gone if g not in targets], "staging": staging}))
    _apply(files, entry)


def append(df: DataFrame, table: str) -> None:
    """Adds rows, partitioned by date (S1); see ``dealt`` for their files."""
    spark = df.sparkSession
    if has_iceberg(spark):
        writer = df.writeTo(table)
        writer.append() if spark.catalog.tableExists(table) else writer.partitionedBy(F.col(PARTITION)).create()
    else:
        recovered(spark, table)
        keep_schema(spark, table, df.schema)
        df.write.mode("append").partitionBy(PARTITION).parquet(table)


def append_batch(df: DataFrame, table: str, number: int, stream: str = "stream") -> None:
    """Adds the batch ``number`` of a stream; a batch that comes again replaces itself inside its dates.

    Files are named by stream and batch. In an Iceberg table the rows carry both.
    """
    spark = df.sparkSession
    if has_iceberg(spark):
        rows = df.withColumns({"stream": F.lit(stream), "batch_id": F.lit(number).cast("long")})
        exists = spark.catalog.tableExists(table)
        writer = rows.writeTo(table)
        writer.overwrite((F.col("batch_id") == number) & (F.col("stream") == stream)) if exists else writer.partitionedBy(F.col(PARTITION)).create()
        return
    prefix = f"{stream}-{number:09d}"
    files = recovered(spark, table)
    newest = int(files.read(f"{BATCHES}/{stream}") or -1)
    again = [n for day in days_of(files) for n in data_files(files, day) if n.split("/")[1].startswith(f"{prefix}-")] if newest >= number else []
    # noted before the files are there, so that whoever repeats the batch looks for them
    files.write(f"{BATCHES}/{stream}", str(max(number, newest)))
    replace(df, table, again, prefix)


def read(spark: SparkSession, table: str, schema=None) -> DataFrame:
    """A table with the schema beside it; one without is read by the schemas of all its files."""
    if has_iceberg(spark):
        return spark.table(table)
    schema = schema if schema is not None else schema_of(spark, table)
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    return reader.parquet(table)


def read_range(spark: SparkSession, table: str, first: str, last: str) -> DataFrame:
    """Rows of the dates ``first`` to ``last``; other folders are neither listed nor opened."""
    inside = F.col(PARTITION).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    schema = None if has_iceberg(spark) else schema_of(spark, table)
    if schema is None:
        return read(spark, table).where(inside)
    days = [d for d in days_of(Files(spark, table)) if first <= d <= last]
    if not days:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", table).parquet(*(f"{table}/{PARTITION}={d}" for d in days)).where(inside)


def upsert(updates: DataFrame, table: str, key: str = "txn_id", order: list[str] | None = None, dates: tuple[str, str] | None = None) -> DataFrame:
    """Replaces rows with the keys of ``updates`` and adds the others; returns the table read again (S3).

    A row whose date changes leaves its old date. Of updates that repeat a key
    the last by ``order`` counts, ties by all other columns; without an order
    they are refused. A null key matches nothing. ``dates`` says between which
    dates the old rows lie, so that only those are searched. Parquet has no
    MERGE: dates that hold a replaced or a new row are written anew in one
    journalled change.
    """
    spark = updates.sparkSession
    copy = new_path(spark, "updates")
    updates.write.parquet(copy)
    updates = spark.read.schema(updates.schema).parquet(copy)
    known = updates.where(F.col(key).isNotNull())
    if order is not None:
        updates = dedup(known, key, order, last=True).unionByName(updates.where(F.col(key).isNull()))
    elif not known.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"updates repeat a {key}: give an order to choose by")
    if has_iceberg(spark):
        updates.createOrReplaceTempView("fraudflow_updates")
        spark.sql(f"MERGE INTO {table} t USING fraudflow_updates s ON t.{key} = s.{key} WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")
        return spark.table(table)
    files = recovered(spark, table)
    schema = keep_schema(spark, table, updates.schema)
    keys = updates.select(key).where(F.col(key).isNotNull())
    old = read_range(spark, table, *dates) if dates else read(spark, table, schema)
    touched = old.join(keys, key, "left_semi").select(PARTITION).union(updates.select(PARTITION)).distinct()
    days = sorted("__HIVE_DEFAULT_PARTITION__" if r[0] is None else str(r[0]) for r in touched.collect())  # one for each date at most
    gone = [name for day in days for name in data_files(files, day)]
    fresh = updates
    if gone:
        left = spark.read.schema(schema).option("basePath", table).parquet(*(f"{table}/{n}" for n in gone)).join(keys, key, "left_anti")
        fresh = left.unionByName(updates, allowMissingColumns=True)
    replace(dealt(fresh.select(*(c for c in schema.names if c in fresh.columns)), key), table, gone, f"upsert-{uuid.uuid4().hex}")
    discard(spark, copy)
    return read(spark, table)


def add_column(spark: SparkSession, table: str, name: str, kind: str) -> DataFrame:
    """The table with one column more, null in old rows (S5); it stays in the table's schema."""
    if has_iceberg(spark):
        spark.sql(f"ALTER TABLE {table} ADD COLUMN {name} {kind}")
        return spark.table(table)
    old = schema_of(spark, table) or read(spark, table).schema
    if name not in old.names:
        keep_schema(spark, table, T.StructType([*old.fields, *T._parse_datatype_string(f"{name} {kind}").fields]))
    return read(spark, table)


def read_as_of(spark: SparkSession, table: str, snapshot: int) -> DataFrame:
    """An earlier snapshot (S6). Parquet keeps none."""
    if not has_iceberg(spark):
        raise NotImplementedError("time travel needs an Iceberg catalog: set spark.sql.catalog.lake")
    return spark.sql(f"SELECT * FROM {table} VERSION AS OF {snapshot}")


def compact(spark: SparkSession, table: str, day: str, key: str = "txn_id") -> None:
    """Rewrites the small files of a date as a few.

    Files of the newest batch of each stream stay: it may come again and has to
    find them.
    """
    if has_iceberg(spark):
        spark.sql(f"CALL lake.system.rewrite_data_files(table => '{table}', where => \"{PARTITION} = DATE '{day}'\")")
        return
    files = recovered(spark, table)
    open_batches = tuple(f"{stream}-{int(files.read(f'{BATCHES}/{stream}')):09d}-" for stream in files.names(BATCHES))
    settled = [n for n in data_files(files, day) if not n.split("/")[1].startswith(open_batches)] if open_batches else data_files(files, day)
    if settled:
        schema = schema_of(spark, table) or read(spark, table).schema
        rows = spark.read.schema(schema).option("basePath", table).parquet(*(f"{table}/{n}" for n in settled))
        replace(dealt(rows, key), table, settled, f"compact-{uuid.uuid4().hex}")
