"""Toxicity by compression distance.

Method: two zstandard dictionaries are trained, one on ordinary text and one on
toxic text. Every window (a word) of a text is compressed with both; where the
toxic dictionary does better than the ordinary one, the window is nearer to
toxic text. How near is calibrated for each pair of compressed lengths on
labelled texts that trained no dictionary; the nearest window of a text and the
number of windows past a threshold give its score.

Toxic texts are mostly ordinary words, and windows of several words with
dictionaries trained on plain toxic text find nearly nothing (see the README for
figures). So a window is a word, and the toxic dictionary is trained on the
windows, and beginnings of windows, that toxic texts hold much more often than
ordinary ones. The fit uses a bounded sample of labelled rows (``fit_rows`` and
``fit_bytes``, by hash of the id; one text of each id); the scores cover all rows
and whole texts, without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, read_table, utf8, written
from .hashing import BYTE_WORDS, all_ranges, mix, prefix, range_hash

SLICE = 1 << 20
#: Windows whose evidence a Python worker keeps; a full cache is emptied.
CACHED = 600_000
#: The fit reads at most so many labelled rows, and so many bytes of text.
FIT_ROWS, FIT_BYTES = 6_000, 64 << 20
ORDINARY_SIZE, TOXIC_SIZE = 8192, 4096
#: Windows that train the ordinary dictionary, and how often each counts at most.
TRAINING_WINDOWS, MOST_TIMES = 60_000, 20
#: Partitions of the sample.
FIT_PARTS = 32
#: Ends every window: zstandard looks for no match in the last bytes of an input.
PAD = b" " * 12
#: How many times likelier in toxic texts, in how many of them and in what share of them a toxic window is.
TIMES, TEXTS, SHARE = 16.0, 5, 0.01
#: Bytes of the shortest beginning of a window that is looked at for itself.
BEGINNING = 4


def _is_word() -> np.ndarray:
    out = np.ones(256, bool)
    out[:0x30] = out[0x3A:0x61] = out[0x7B:0x80] = False
    return out


_WORD = _is_word()
_LOWER = np.arange(256, dtype=np.uint8) + 32 * ((np.arange(256) >= 65) & (np.arange(256) <= 90)).astype(np.uint8)


def windows(data: np.ndarray, at: np.ndarray):
    """Lower-cased bytes and the start, end and text of each window."""
    low = _LOWER[data]
    inside = _WORD[low]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    starts = np.flatnonzero(inside & (edge[:-1] | np.concatenate([[True], ~inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | np.concatenate([~inside[1:], [True]]))) + 1
    return low, starts, ends, np.searchsorted(at, starts, side="right") - 1


def _hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix(range_hash(prefix(BYTE_WORDS[low]), starts, ends - starts) ^ (ends - starts).astype(np.uint64))


def _compressor(dictionary: bytes):
    import zstandard as z

    kind = z.DICT_TYPE_FULLDICT if dictionary[:4] == b"\x37\xa4\x30\xec" else z.DICT_TYPE_RAWCONTENT
    held = z.ZstdCompressionDict(dictionary + b"\n" * 16, dict_type=kind)
    return z.ZstdCompressor(level=3, dict_data=held, write_content_size=False, write_dict_id=False, write_checksum=False)


def cells(words: list[bytes], ordinary, toxic) -> np.ndarray:
    """A number for each window's size and its two compressed sizes."""
    if not words:
        return np.zeros(0, np.int64)
    sizes = [np.array([len(x) for x in c.multi_compress_to_buffer([b" " + w + b" " + PAD for w in words])], np.int64) for c in (ordinary, toxic)]
    n = np.array([len(w) for w in words], np.int64)
    return (np.minimum(n, 30) * 64 + np.minimum(sizes[0], 63)) * 64 + np.minimum(sizes[1], 63)


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    evidence: dict[int, int]
    threshold: int
    weights: tuple[float, float, float]

    def score(self, largest: np.ndarray, past: np.ndarray) -> np.ndarray:
        a, b, c = self.weights
        return 1 / (1 + np.exp(-np.clip(a + b * _bounded(largest) + c * np.minimum(past, 4), -30, 30)))


def _bounded(largest: np.ndarray) -> np.ndarray:
    return np.clip(largest, 0, 60) / 10


def _evidence(found: list[tuple[int, np.ndarray]]) -> dict[int, int]:
    """Tenths of the log odds of toxic text for each cell, from the different cells of labelled texts."""
    count = {y: Counter(c for z, own in found if z == y for c in np.unique(own).tolist()) for y in (0, 1)}
    n = {y: sum(1 for z, _ in found if z == y) for y in (0, 1)}
    return {c: max(0, round(10 * np.log((k + 0.5) / (n[1] + 1) / ((count[0][c] + 1) / (n[0] + 2))))) for c, k in count[1].items() if k > 1}


def _train(samples: list[bytes], size: int) -> bytes:
    import zstandard as z

    try:
        return z.train_dictionary(size, samples).as_bytes()
    except z.ZstdError:  # too few samples to train on: their text is the dictionary
        return b"".join(samples)[-size:] or b" "


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, times: np.ndarray | float = 1.0) -> np.ndarray:
    w, times = np.zeros(x.shape[1]), np.broadcast_to(times, len(x))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (times * p * (1 - p))[:, None]).T @ x + ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1)) + 1e-9 * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, x.T @ (times * (y - p)) - ridge * np.r_[0.0, w[1:]])
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def beginnings(word: bytes) -> list[bytes]:
    """A window with its spaces, and its beginnings of ``BEGINNING`` to 8 bytes."""
    return [b" " + word[:i] for i in range(BEGINNING, min(len(word), 9))] + [b" " + word + b" "]


def without_copies(sketches: list[tuple]) -> list:
    """Names of (label, half, name, shingle minima) but those that share a minimum with one before: (near) copies count once."""
    seen: set[tuple[int, int]] = set()
    out = []
    for _, _, name, sketch in sketches:
        own = set(enumerate(sketch))
        if not own & seen:
            out.append(name)
        seen |= own
    return out


def train(ordinary_words: list[tuple[bytes, int]], toxic_text: list[bytes]) -> tuple[bytes, bytes]:
    """The two dictionaries, from counted ordinary windows and the telling strings of toxic texts in their order."""
    ordinary_text = [b" " + w + b" " for w, c in sorted(ordinary_words) for _ in range(min(c, MOST_TIMES))]
    ordinary, toxic = _train(ordinary_text, ORDINARY_SIZE), _train(toxic_text, TOXIC_SIZE)
    # training leaves out strings that its segments do not reach: they follow, the most frequent last
    left = [p for p, _ in Counter(toxic_text).most_common() if p not in toxic]
    kept = [p for p, end in zip(left, np.cumsum([len(p) for p in left]).tolist(), strict=True) if len(toxic) + end <= TOXIC_SIZE]
    return ordinary, toxic + b"".join(reversed(kept))


def calibrated(ordinary: bytes, toxic: bytes, found: list[tuple[int, list[int]]]) -> Model:
    """The model of two dictionaries, from (label, different cells) of texts that trained neither."""
    y = np.array([y for y, _ in found])
    evidence = _evidence([(z, np.array(own, np.int64)) for z, own in found])
    told = [np.array([evidence.get(c, 0) for c in own] or [0]) for _, own in found]
    largest = np.array([v.max() for v in told])
    threshold = max(range(5, 61, 5), key=lambda t: ((largest >= t) == (y == 1)).mean())
    past = np.array([(v >= threshold).sum() for v in told])
    weights = _logistic(np.column_stack([np.ones(len(y)), _bounded(largest), np.minimum(past, 4)]).astype(float), y)
    return Model(ordinary, toxic, evidence, threshold, tuple(weights.tolist()))


def _minima(hashes: np.ndarray) -> list[int]:
    """Minima of four hashes over the 5-word shingles of a text; none for shorter texts."""
    if len(hashes) < 5:
        return []
    shingles = all_ranges(prefix(hashes), 5)
    return [int(mix(shingles ^ np.uint64(i)).min() >> np.uint64(1)) for i in range(1, 5)]


def _own_windows(batch: pa.RecordBatch) -> tuple[list[list[bytes]], list[list[int]]]:
    """The different windows of each text, and the minima of its shingles."""
    low, starts, ends, text = windows(*utf8(batch["text"]))
    raw = low.tobytes()
    hashes = _hashes(low, starts, ends)
    bounds = np.searchsorted(text, np.arange(batch.num_rows + 1))
    own: list[set[bytes]] = [set() for _ in range(batch.num_rows)]
    for a, b, i in zip(starts.tolist(), ends.tolist(), text.tolist(), strict=True):
        own[i].add(raw[a:b])
    return [sorted(w) for w in own], [_minima(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _sketches(rows):
    for batch in batches(rows, SLICE, "text"):
        yield pa.RecordBatch.from_arrays([batch["toxic"], batch["half"], batch["name"], pa.array(_own_windows(batch)[1], pa.list_(pa.int64()))], names=["toxic", "half", "name", "sketch"])


def _strings(rows):
    """Windows of each text (``whole``), and their beginnings."""
    for batch in batches(rows, SLICE, "text"):
        out = []
        for y, own in zip(batch["toxic"].to_pylist(), _own_windows(batch)[0], strict=True):
            out += [(y, True, w) for w in own]
            out += [(y, False, p) for p in {p for w in own for p in beginnings(w)}]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.bool_(), pa.binary()), strict=True)], names=["toxic", "whole", "p"])


def _told(telling: frozenset[bytes]):
    """The longest telling string of each window of each text."""

    def work(rows):
        for batch in batches(rows, SLICE, "text"):
            found = [[max(own, key=len) for w in words if (own := [p for p in beginnings(w) if p in telling])] for words in _own_windows(batch)[0]]
            yield pa.RecordBatch.from_arrays([batch["name"], pa.array(found, pa.list_(pa.binary()))], names=["name", "found"])

    return work


def _cells(ordinary: bytes, toxic: bytes):
    """The different cells of each text."""

    def work(rows):
        pair = _compressor(ordinary), _compressor(toxic)
        for batch in batches(rows, SLICE, "text"):
            found = [np.unique(cells(words, *pair)).tolist() for words in _own_windows(batch)[0]]
            yield pa.RecordBatch.from_arrays([batch["toxic"], batch["name"], pa.array(found, pa.list_(pa.int64()))], names=["toxic", "name", "found"])

    return work


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES) -> Model | None:
    """The model from at most ``fit_rows`` labelled rows, and ``fit_bytes`` of text, that are not held out.

    An id counts once, with the least of its texts.
    """
    marked = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("toxic"))
    order = F.xxhash64(F.lit("fit"), F.col(key))
    usable = marked.where(~held_out(F.col(key))).withColumn("order", order)
    # a bounded set of ids and labels, small enough for every task
    chosen = usable.orderBy("order", key).limit(fit_rows).select(key, "toxic", F.pmod("order", F.lit(2)).cast("int").alias("half"))
    rows = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), key)
    rows = written(rows.groupBy(key, "toxic", "half").agg(F.min("text").alias("text")), "fit")
    # at most fit_rows numbers go through this window
    so_far = F.sum("size").over(Window.orderBy(order, key).rowsBetween(Window.unboundedPreceding, 0))
    within = rows.select(key, F.octet_length("text").cast("long").alias("size")).withColumn("so_far", so_far).where(F.col("so_far") <= fit_bytes)
    rows = rows.join(F.broadcast(within.select(key)), key).select(F.col(key).cast("string").alias("name"), "toxic", "half", "text").repartition(FIT_PARTS, "name")
    sketches = rows.mapInArrow(_sketches, "toxic int, half int, name string, sketch array<long>").collect()
    names = without_copies(sorted((r.toxic, r.half, r.name, list(r.sketch)) for r in sketches))
    known = docs.sparkSession.createDataFrame([(n,) for n in names], "name string")
    rows = written(rows.join(F.broadcast(known), "name"), "fit")
    sizes = {(r.toxic, r.half): r["count"] for r in rows.groupBy("toxic", "half").count().collect()}
    if len(sizes) < 4:
        return None
    learn, check = rows.where("half = 0"), rows.where("half = 1")
    # strings are counted in Spark; the telling ones and the commonest come to the driver
    strings = learn.mapInArrow(_strings, "toxic int, whole boolean, p binary").groupBy("whole", "p")
    counted = written(strings.agg(F.sum(F.col("toxic").cast("long")).alias("c1"), F.sum(1 - F.col("toxic").cast("long")).alias("c0")), "strings")
    odds = ((F.col("c1") + 0.5) / (sizes[1, 0] + 1)) / ((F.col("c0") + 0.5) / (sizes[0, 0] + 1))
    often = counted.where(~F.col("whole") & (F.col("c1") >= max(TEXTS, SHARE * sizes[1, 0])) & (odds >= TIMES))
    telling = frozenset(bytes(r.p) for r in often.select("p").collect())  # 100 times the windows of a toxic text at most, by SHARE
    common = counted.where("whole AND c0 > 0").orderBy(F.desc("c0"), "p").limit(TRAINING_WINDOWS).select("p", "c0").collect()
    told = learn.where("toxic = 1").mapInArrow(_told(telling), "name string, found array<binary>").collect()
    toxic_text = [bytes(p) for r in sorted(told, key=lambda r: r.name) for p in r.found]
    ordinary, toxic = train([(bytes(r.p), r.c0) for r in common], toxic_text)
    found = check.mapInArrow(_cells(ordinary, toxic), "toxic int, name string, found array<long>").collect()
    return calibrated(ordinary, toxic, [(r.toxic, list(r.found)) for r in sorted(found, key=lambda r: r.name)])


def held_out(key):
    """Rows that no fit may read: crc32 of the id as text divisible by 5."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _score(model: Model | None):
    def work(rows):
        cache: dict[int, int] = {}
        pair = (_compressor(model.ordinary), _compressor(model.toxic)) if model else None
        for batch in batches(rows, SLICE, "text"):
            score = np.zeros(batch.num_rows)
            if model:
                low, starts, ends, text = windows(*utf8(batch["text"]))
                largest, past = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
                if len(starts):
                    kinds, first, kind = np.unique(_hashes(low, starts, ends), return_index=True, return_inverse=True)
                    if len(cache) > CACHED:
                        cache.clear()
                    known = kinds.tolist()
                    saved = np.array([cache.get(h, -1) for h in known])
                    new = np.flatnonzero(saved < 0)
                    raw = low.tobytes()
                    found = cells([raw[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)], *pair)
                    saved[new] = [model.evidence.get(c, 0) for c in found.tolist()]
                    cache.update(zip(kinds[new].tolist(), saved[new].tolist(), strict=True))
                    np.maximum.at(largest, text, saved[kind])
                    hits = np.flatnonzero(saved[kind] >= model.threshold)
                    different = np.unique(np.column_stack([text[hits], kind[hits]]), axis=0)
                    np.add.at(past, different[:, 0], 1)
                score = model.score(largest, past)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "score"])

    return work


def scored(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, held_out, score, predicted) of every row of ``docs``.

    A null or empty text has no windows and gets the score of none; without
    labels of both kinds all scores are 0; a null key stays null and is not
    held out; repeated rows score alike; an empty table gives no rows. Other
    columns of ``docs`` are ignored, whatever their names.
    """
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    out = rows.mapInArrow(_score(model), f"id {kind}, text string, score double")
    return out.select(F.col("id").alias(key), F.col("text").alias(text), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of ``documents``, learned from ``labels``."""
    docs = read_table(spark, sf_dir, "documents")
    return scored(docs, fit(docs, read_table(spark, sf_dir, "labels"))).drop("text")
