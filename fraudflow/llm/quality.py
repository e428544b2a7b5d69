"""Quality rules: repetition inside a document and line frequency across documents.

Method: every line is normalised (case, white space, digits) and hashed; the
documents of a host that hold it are counted; a line held by more than
``share`` of the host's documents, and by more than ``least`` of them, is taken
out; a document that loses more than ``depleted`` of its words is rejected.

Counts are made before shuffling, by (host, line), so a host with a third of
all documents is spread over its lines and a line of every document is one
number per task.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, read_table, utf8, written
from .debruijn_dedup import word_hashes
from .hashing import all_ranges, mix, prefix

SLICE = 1 << 20
_SPAN = 8
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_DIGITS = re.compile(r"[0-9]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[at[1:]] - total[at[:-1]]


def repeated_words(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Words of each text inside windows of 8 words that the text has twice or more."""
    if len(words) < _SPAN:
        return np.zeros(len(at) - 1, np.int64)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    n = len(words) - _SPAN + 1
    inside = text[:n] == text[_SPAN - 1 :]
    h = mix(all_ranges(prefix(words), _SPAN) ^ mix(text[:n].astype(np.uint64) + np.uint64(1)))
    own = np.flatnonzero(inside)
    _, kind, count = np.unique(h[own], return_inverse=True, return_counts=True)
    hit = own[count[kind] > 1]
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, hit, 1)
    np.add.at(change, hit + _SPAN, -1)
    return _per_text(np.cumsum(change[:-1]) > 0, at)


def normal_line(line: str) -> str:
    """ASCII letters in lower case, one space between words, runs of ASCII digits as 0."""
    return _DIGITS.sub("0", " ".join(_WORD.findall(line)).translate(_LOWER))


def _lines(text: str) -> tuple[int, dict[int, int]]:
    """Lines equal to an earlier one, and the words under each normalised line's hash."""
    seen: set[str] = set()
    again, words = 0, {}
    for line in text.split("\n"):
        n = len(_WORD.findall(line))
        if n:
            again += line in seen
            seen.add(line)
            h = xxhash.xxh3_64_intdigest(normal_line(line).encode()) - (1 << 63)
            words[h] = words.get(h, 0) + n
    return again, words


def _measure(rows):
    number = TaskContext.get().partitionId() << 40
    for batch in batches(rows, SLICE, "text"):
        data, at = utf8(batch["text"])
        words, ends = word_hashes(data, at)
        solid = ~_SPACE[data] & ((data & 0xC0) != 0x80)
        lines = [_lines(t) for t in batch["text"].to_pylist()]
        hashes = pa.array([list(w) for _, w in lines], pa.list_(pa.int64()))
        counts = pa.array([list(w.values()) for _, w in lines], pa.list_(pa.int64()))
        n = batch.num_rows
        out = [np.arange(number, number + n), np.diff(ends), _per_text(solid, at), _per_text(_SYMBOL[data], at), np.array([a for a, _ in lines], np.int64), repeated_words(words, ends)]
        number += n
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["host"], *(pa.array(x.astype(np.int64)) for x in out), hashes, counts],
            names=["id", "host", "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines", "line_words"],
        )


def quality(
    docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", share: float = 0.02, least: int = 10, depleted: float = 0.5
) -> DataFrame:
    """Counts and verdict for each row of ``docs``.

    Returns (key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_common_words, kept). ``base_failed``: under 20 words, or over
    30 % of the words in repeated 8-word windows. ``n_common_words``: words in
    the lines taken out. A null or empty text has no words and fails; a null
    host and an empty one are the same; repeated rows count as documents each; a null
    key stays null; an empty table gives no rows. Other columns of ``docs`` are
    ignored, whatever their names.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = f"id {kind}, host string, row long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<long>, line_words array<long>"
    base = written(rows.mapInArrow(_measure, schema), "quality")
    lines = base.select("row", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("l")).select("row", "host", F.col("l.lines").alias("h"), F.col("l.line_words").alias("n"))
    held = lines.groupBy("host", "h").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > least)
    hosts = base.groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    common = held.join(hosts, "host").where(F.col("held") > F.col("of") * share).select("host", "h")
    lost = lines.join(common, ["host", "h"]).groupBy("row").agg(F.sum("n").alias("n_common_words"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    common_words = F.coalesce("n_common_words", F.lit(0))
    return base.join(lost, "row", "left").select(
        F.col("id").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), common_words.alias("n_common_words"),
        (~failed & (common_words <= depleted * F.col("n_words"))).alias("kept"),
    )


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """``quality`` over ``documents``, hosts being their sources."""
    return quality(read_table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
line AS (SELECT r, host, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
solid AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM line),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup FROM solid WHERE n > 0 GROUP BY r),
nl AS (SELECT r, host, regexp_replace(translate(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g') AS l, sum(n) AS n FROM solid WHERE n > 0 GROUP BY ALL),
held AS (SELECT host, l, count(*) AS held FROM nl GROUP BY ALL),
hosts AS (SELECT host, count(*) AS total FROM d GROUP BY host),
common AS (SELECT host, l FROM held JOIN hosts USING (host) WHERE held > 10 AND held > total * 0.02::DOUBLE),
lost AS (SELECT r, sum(n) AS n FROM nl JOIN common USING (host, l) GROUP BY r),
pos AS (SELECT r, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
win AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS t FROM pos),
rep AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, t) > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, range(8) AS s(k) GROUP BY r),
o AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(length(array_to_string(ws, '')), 0) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_common_words
  FROM w LEFT JOIN dup USING (r) LEFT JOIN cov USING (r) LEFT JOIN lost USING (r))
SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_common_words <= 0.5::DOUBLE * n_words AS kept FROM o
"""
