"""The Spark skeleton of exact long-repeat removal, shared by bytes and words.

Windows of a fixed length are grouped into *segments*: runs of consecutive
windows with the same minimiser. A segment is one short row, so what is
shuffled is a small fraction of the text. Equal windows have equal minimisers,
so a window can only recur inside segments with its own minimiser:

* one segment has that minimiser: none of its windows recurs;
* segments with equal content (a 128-bit BLAKE2b digest of it, no polynomial
  hash): all their windows recur;
* segments that differ (*mixed*): one of each kind is looked into.

Minimisers are counted in partial sums and joined back, a join whose large
partitions Spark can split; contents are counted by (minimiser, digest). So a
passage of every document is no task's burden. Texts are shuffled once, when
segments are looked into and spans are cut; the segments come from the rows as
they are read, copies too: a text with a copy loses all its windows anyway.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_keys, utf8, written
from .hashing import pieces, segments

SEGMENT = "m long, s long, t long, k1 long, k2 long, pos long, n int, place int, times int"


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, k1, k2) of all rows; a null text is empty."""
    held = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("id"), held.alias("text"), *text_keys(held))


def copies(rows: DataFrame) -> DataFrame:
    """For each different text how many rows have it (``c``), the least id of them and how many have that too (``again``); written."""
    ids = rows.groupBy("k1", "k2", "id").agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.struct(F.col("id").isNull(), F.col("id").alias("first"), F.col("n").alias("again"))).alias("least")
    return written(ids.groupBy("k1", "k2").agg(F.sum("n").alias("c"), least).select("k1", "k2", "c", "least.first", "least.again"), "copies")


def cuts_of(batch: pa.RecordBatch, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first unit, units) of the listed segments of each row, with the list's other fields in order."""
    offsets = batch["cuts"].offsets.to_numpy()
    flat = batch["cuts"].flatten()
    row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
    return row, flat.field("pos").to_numpy(), flat.field("n").to_numpy().astype(np.int64) + window - 1


def segment_rows(batch: pa.RecordBatch, values: np.ndarray, at: np.ndarray, content: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int, gram: int):
    """``SEGMENT`` rows of a batch of texts, or of their listed segments if there is a list.

    ``values`` are the hashed units of all texts, ``at`` the texts' offsets in
    them; unit i is ``content[starts[i]:ends[i]]``, and a run of units the bytes
    from the first start to the last end.
    """
    if "cuts" in batch.schema.names:
        row, begin, size = cuts_of(batch, window)
        begin = begin + at[row]
    else:
        row, begin, size = np.arange(batch.num_rows), at[:-1], np.diff(at)
    k1, k2 = (batch[k].to_numpy() for k in ("k1", "k2"))
    held = memoryview(np.ascontiguousarray(content))
    for group in pieces(begin, begin + size, window):
        own = np.concatenate([values[b:e] for _, b, e in group])
        sizes = np.array([e - b for _, b, e in group])
        start, n, place, m = segments(own, sizes, window, gram)
        if not len(start):
            continue
        first = np.concatenate([[0], np.cumsum(sizes)])
        piece = np.searchsorted(first, start, side="right") - 1
        text = row[np.array([i for i, _, _ in group])[piece]]
        unit = start + np.array([b for _, b, _ in group])[piece] - first[piece]
        spans = zip(starts[unit].tolist(), ends[unit + n + window - 2].tolist(), strict=True)
        digest = np.frombuffer(b"".join(hashlib.blake2b(held[a:b], digest_size=16).digest() for a, b in spans), "<i8").reshape(-1, 2)
        pos = unit - at[text]
        # what a text repeats itself is one segment with a number of times, and spans that are known at once
        order = np.lexsort((pos, digest[:, 1], digest[:, 0], text))
        lead = np.ones(len(order), bool)
        lead[1:] = (text[order][1:] != text[order][:-1]) | (digest[order][1:] != digest[order][:-1]).any(axis=1)
        heads = np.flatnonzero(lead)
        times = np.diff(np.append(heads, len(order)))
        i = order[heads]
        yield _segment_batch(m[i].view(np.int64), None, digest[i], k1[text[i]], k2[text[i]], pos[i], n[i], (place - start)[i], times)
        own = np.sort(order[np.repeat(times, times) > 1])
        if len(own):
            end = pos[own] + n[own] + window - 1
            new = np.ones(len(own), bool)
            new[1:] = (text[own][1:] != text[own][:-1]) | (pos[own][1:] > end[:-1]) | (pos[own][1:] < pos[own][:-1])
            first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(own)) - 1
            i, zero = own[first], np.zeros(len(first), np.int64)
            yield _segment_batch(zero, np.ones(len(first), bool), np.zeros((len(first), 2), np.int64), k1[text[i]], k2[text[i]], pos[i], end[last] - pos[i], zero, zero)


def _segment_batch(m, none, digest, k1, k2, pos, n, place, times) -> pa.RecordBatch:
    rest = (digest[:, 0], digest[:, 1], k1, k2, pos, n.astype(np.int32), place.astype(np.int32), times.astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(m, mask=none), *map(pa.array, rest)], names=[c.split()[0] for c in SEGMENT.split(", ")])


def met(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments whose minimiser recurs, and the spans that a text repeats itself; both written."""
    found = written(found, "segments")
    again = found.groupBy("m").agg(F.count(F.lit(1)).alias("rows"), F.max("times").alias("times")).where("m IS NOT NULL AND (rows > 1 OR times > 1)")
    # written, so that Spark can split the partition of a minimiser that many texts have
    again = written(again.select("m"), "minimisers")
    return written(found.join(again, "m"), "met"), own_spans(found)


def own_spans(found: DataFrame) -> DataFrame:
    """Spans that a text repeats itself: the rows without a minimiser."""
    return found.where("m IS NULL").select("k1", "k2", "pos", (F.col("pos") + F.col("n")).alias("end"))


def kinds(segments_: DataFrame) -> DataFrame:
    """A row for each different segment: how many are equal to it (``kin``) and the first of them."""
    first = F.min(F.struct("k1", "k2", "pos", "n", "place")).alias("first")
    return written(segments_.groupBy("m", "s", "t").agg(F.sum("times").alias("kin"), first), "kinds")


def mixed(kinds_: DataFrame) -> DataFrame:
    """The first segment of each kind where a minimiser has several, with the number of these (``kinds``) and of their windows."""
    groups = kinds_.groupBy("m").agg(F.count(F.lit(1)).alias("kinds"), F.sum(F.col("first.n").cast("long")).alias("windows")).where("kinds > 1")
    return kinds_.join(groups, "m").select("m", "kinds", "windows", "first.*")


def whole_spans(segments_: DataFrame, kinds_: DataFrame, window: int) -> DataFrame:
    """Spans of the segments all of whose windows recur."""
    again = kinds_.where("kin > 1").select("m", "s", "t")
    return segments_.join(again, ["m", "s", "t"]).select("k1", "k2", "pos", (F.col("pos") + F.col("n") + window - 1).alias("end"))


def cut_rows(rows: DataFrame, groups: DataFrame, listed: DataFrame) -> DataFrame:
    """One row for each different text that holds listed segments, with the list of them: never more than the text has places.

    ``first`` is the least id, null if all are. Put as an order, the condition
    is no join key, so this join has the keys of ``with_spans`` and the texts are
    shuffled once for both. Rows that repeat id and text become one where there are any.
    """
    lists = listed.groupBy("k1", "k2").agg(F.collect_list(F.struct("m", "pos", "n", "place")).alias("cuts"))
    cuts = lists.join(groups, ["k1", "k2"]).select("k1", "k2", "first", "cuts")
    found = rows.join(cuts, ["k1", "k2"]).where(F.coalesce(F.col("id") <= F.col("first"), F.col("first").isNull()))
    found = found.select("text", "k1", "k2", "cuts")
    return found if groups.where("again > 1").isEmpty() else found.dropDuplicates(["k1", "k2"])


def runs(spans: DataFrame) -> DataFrame:
    """Overlapping or touching spans (k1, k2, pos, end) of a text joined."""
    own = Window.partitionBy("k1", "k2").orderBy("pos", "end")
    before = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    new = spans.distinct().withColumn("new", F.coalesce(F.col("pos") > before, F.lit(True)).cast("long"))
    numbered = new.withColumn("run", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("k1", "k2", "run").agg(F.min("pos").alias("pos"), F.max("end").alias("end")).drop("run")


def with_spans(rows: DataFrame, groups: DataFrame, spans: DataFrame) -> DataFrame:
    """Each row with the number of its copies and the removed spans of its text."""
    lists = runs(spans).groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("pos", "end"))).alias("spans"))
    known = groups.join(lists, ["k1", "k2"], "left").select("k1", "k2", "c", "spans")
    return rows.join(known, ["k1", "k2"]).select("id", "text", "c", "spans")
