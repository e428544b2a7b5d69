"""Benchmark decontamination by winnowing, in built-in functions only.

Method: words are hashed, ``gram`` consecutive words make a k-gram hash, and of
every ``window - gram + 1`` consecutive k-grams the least is kept as a
fingerprint. Any ``window`` consecutive words that a document shares with an
item have the same least k-gram, so they share a fingerprint: no such span can
be missed. The windows of documents that hold a fingerprint are then joined with
the items' windows by their words, which extends the hits to the whole shared
spans and drops the rest: no document meets an item without a common window.

Only fingerprints and windows of the items (a few per item) meet those of the
documents. They are broadcast when their size is below a bound, and joined by
shuffle beyond it. Copies of a text are compared once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import read_table, text_keys, written

_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of a benchmark's fingerprints, and of its windows, that every task may hold.
BROADCAST_BYTES = 16 << 20


def words(text: Column) -> Column:
    """Words of a lower-cased text."""
    return F.filter(F.split(text, _GAP), lambda w: w != "")


def _shifted(array: Column, by: int) -> Column:
    return F.slice(array, by + 1, F.greatest(F.size(array) - by, F.lit(0)))


def _paired(a: Column, b: Column, by: int, of) -> Column:
    """``of(a[i], b[i + by])`` for all i that have both."""
    n = F.greatest(F.size(b) - by, F.lit(0))
    return F.zip_with(F.slice(a, 1, n), _shifted(b, by), of)


def _grams(df: DataFrame, hashes: str, size: int) -> tuple[DataFrame, str]:
    """Adds a column with the hashes of ``size`` consecutive words."""
    last = hashes
    for i in range(1, size):
        df = df.withColumn(f"g{size}_{i}", _paired(F.col(last), F.col(hashes), i, lambda a, b: F.xxhash64(a, b)))
        last = f"g{size}_{i}"
    return df, last


# explode_outer below: explode would make Spark filter on the size of its array before
# computing it, with all steps of the fingerprints written out inside that filter
def fingerprints(rows: DataFrame, window: int, gram: int, short: list[int]) -> DataFrame:
    """``rows`` (with ``ws``) and their fingerprints ``fps``; all grams of the ``short`` sizes count too."""
    kept = rows.columns
    df = rows.withColumn("h", F.transform("ws", lambda w: F.xxhash64(w)))
    df, grams = _grams(df, "h", gram)
    have, last = 1, grams
    width = window - gram + 1
    while have < width:
        step = min(have, width - have)
        df = df.withColumn(f"m{have + step}", _paired(F.col(last), F.col(last), step, lambda a, b: F.least(a, b)))
        last, have = f"m{have + step}", have + step
    found = [F.col(last)]
    for size in short:
        df, grams = _grams(df, "h", size)
        found.append(F.col(grams))
    return df.select(*kept, F.array_distinct(F.concat(*found)).alias("fps"))


def _windows(array: Column, size: Column) -> Column:
    """The texts of all ``size`` consecutive words; words hold no spaces, so texts are equal where words are."""
    starts = F.when(F.size(array) >= size, F.sequence(F.lit(0), F.size(array) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.concat_ws(" ", F.slice(array, i + 1, size)))


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = 10, gram: int = 5
) -> DataFrame:
    """What each row of ``docs`` shares with the benchmark.

    Returns (key, n_words, n_hit, n_items, items_sha256, contaminated, items):
    words inside occurrences of ``window`` consecutive item words (or of a whole
    shorter item), and the items they come from. A null or empty text has no
    words; an item without words matches nothing; items with one id count once,
    a null id as an empty one; repeated rows get equal results; a null key stays
    null; an empty table gives no rows, an empty benchmark no hits. Other
    columns are ignored, whatever their names.
    """
    plain = lambda c: F.coalesce(F.col(c), F.lit(""))
    exact = lambda c: words(F.translate(c, _UPPER, _LOWER))
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), exact(plain(item_text)).alias("iw"))
    items = written(items.where(F.size("iw") > 0).distinct(), "items")
    sizes = items.select(F.size("iw").alias("n")).where(F.col("n") < window).distinct()
    short = sorted(r.n for r in sizes.collect())  # at most window - 1 rows
    # fingerprints and comparison see the same words: F.lower depends on what surrounds a letter
    worded = items.select("item", F.col("iw").alias("ws"))
    prints = fingerprints(worded.where(F.size("ws") >= window), window, gram, []).select(F.explode_outer("fps").alias("fp"))
    for n in short:
        prints = prints.unionByName(fingerprints(worded.where(F.size("ws") == n), window, gram, [n]).select(F.explode_outer("fps").alias("fp")))
    known = written(prints.distinct(), "fingerprints")
    item_windows = worded.select("item", F.explode_outer(_windows(F.col("ws"), F.least(F.size("ws"), F.lit(window)))).alias("w"), F.least(F.size("ws"), F.lit(window)).alias("n"))
    item_windows = written(item_windows.distinct(), "item-windows")

    def near(table: DataFrame, size: Column) -> DataFrame:
        held = table.agg(F.sum(size + 32).alias("bytes")).first().bytes or 0
        return F.broadcast(table) if held <= BROADCAST_BYTES else table

    rows = docs.select(F.col(key).alias("id"), plain(text).alias("text"), *text_keys(plain(text)))
    marked = fingerprints(rows.select("id", "k1", "k2", exact("text").alias("ws")), window, gram, short)
    # one row for each fingerprint of the document; the text stays behind
    hits = marked.select("id", "k1", "k2", F.explode_outer("fps").alias("fp")).join(near(known, F.lit(8)), "fp")
    met = hits.groupBy("k1", "k2").agg(F.min("id").alias("first"))
    looked = rows.join(met, ["k1", "k2"]).where(F.col("id").eqNullSafe(F.col("first"))).select("k1", "k2", exact("text").alias("dw"))
    in_text = lambda n: F.transform(_windows(F.col("dw"), F.lit(n)), lambda w, i: F.struct(i.alias("i"), w.alias("w"), F.lit(n).alias("n")))
    own = looked.select("k1", "k2", F.explode_outer(F.concat(*map(in_text, [window, *short]))).alias("own")).select("k1", "k2", "own.*")
    spans = own.join(near(item_windows, F.octet_length("item") + F.octet_length("w")), ["n", "w"]).select("k1", "k2", "item", "i", (F.col("i") + F.col("n")).alias("end"))
    spans = written(spans, "spans")
    matched = spans.groupBy("k1", "k2").agg(F.array_sort(F.collect_set("item")).alias("items"))
    order = Window.partitionBy("k1", "k2").orderBy("i", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = spans.select("k1", "k2", "i", "end").distinct().withColumn("before", F.coalesce(F.max("end").over(order), F.lit(0)))
    hit = fresh.groupBy("k1", "k2").agg(F.sum(F.greatest(F.col("end") - F.greatest("i", "before"), F.lit(0))).cast("long").alias("n_hit"))
    out = rows.select("id", "k1", "k2", F.size(exact("text")).cast("long").alias("n_words")).join(hit.join(matched, ["k1", "k2"]), ["k1", "k2"], "left")
    none = F.array().cast("array<string>")
    return out.select(
        F.col("id").alias(key), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("items", none)).cast("binary"), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"), F.coalesce("items", none).alias("items"),
    )


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    """``contamination`` of ``documents`` by ``benchmark``."""
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("items")


OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT item, least(len(ws), 10) AS n, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS t FROM bw),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT r, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n),
dt AS (SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS t FROM dw),
hit AS (SELECT r, item, i, dt.n FROM dt JOIN win ON dt.n = win.n AND dt.t = win.t),
cover AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM hit, range(10) AS s(k) WHERE k < n GROUP BY r),
own AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (r) LEFT JOIN own USING (r)
"""
