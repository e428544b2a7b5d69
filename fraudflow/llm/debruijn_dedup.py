"""Removal of long word sequences that occur more than once (De Bruijn compaction).

A window of ``window`` words is an edge of the De Bruijn graph of the corpus,
from its first ``window - 1`` words to its last. A text is a walk; an edge that
is walked twice is a repeat. A row per edge would multiply the text, so walks
are first cut where the least k-mer (``gram`` words) of the edges changes, as
compacted De Bruijn graphs are built by minimiser: consecutive edges with one
least k-mer form a path with a digest of its words and its source coordinates
(text, first word, length).

* Paths meet by k-mer and by digest, in joins. Where all paths of a k-mer are
  equal they do not branch and stay one unit with their multiplicity.
* Where they differ, they branch somewhere inside: one path of each kind becomes
  single edges, which meet by the digests of their words.
* By the source coordinates, repeated paths and edges that follow each other in
  a text are compacted to maximal spans, which are cut from the text itself.

Hashes of words only bring paths together. What repeats is decided by 128-bit
BLAKE2b digests of the words themselves, so a collision of word hashes cannot
remove text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .common import batches, read_table, utf8, written
from .hashing import BYTE_WORDS, mix, prefix, range_hash
from .suffix_dedup import SLICE


def word_places(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of the texts in ``data``."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    inside = ~space
    starts = np.flatnonzero(inside & (edge[:-1] | np.concatenate([[True], space[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | np.concatenate([space[1:], [True]]))) + 1
    return starts, ends


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word."""
    return mix(range_hash(prefix(BYTE_WORDS[data]), starts, ends - starts) ^ (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the texts in ``data`` and the offsets of texts in words."""
    starts, ends = word_places(data, at)
    return hashed(data, starts, ends), np.searchsorted(starts, at)


def single_spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space after each, and their starts and ends there."""
    size = ends - starts
    new = np.cumsum(size + 1) - size - 1
    out = np.full(int(size.sum()) + len(size), 32, np.uint8)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[inside + np.repeat(new, size)] = data[inside + np.repeat(starts, size)]
    return out, new, new + size


def _paths(window: int, gram: int):
    def work(rows):
        for batch in batches(rows, SLICE, "text"):
            data, at = utf8(batch["text"])
            starts, ends = word_places(data, at)
            yield from repeats.segment_rows(batch, hashed(data, starts, ends), np.searchsorted(starts, at), *single_spaced(data, starts, ends), window, gram)

    return work


def _remove(window: int):
    def work(rows):
        for batch in batches(rows, SLICE, "text"):
            data, at = utf8(batch["text"])
            out = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
            for i, (copies, spans) in enumerate(zip(batch["c"].to_pylist(), batch["spans"].to_pylist(), strict=True)):
                words = data[at[i] : at[i + 1]].tobytes().split()
                gone = [(s["pos"], s["end"]) for s in spans or ()]
                if copies > 1 and len(words) >= window:
                    gone = [(0, len(words))]
                kept, last = [], 0
                for a, b in gone:
                    kept += words[last:a]
                    last = b
                kept += words[last:]
                text = b" ".join(kept)
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["kept_sha256"].append(hashlib.sha256(text).hexdigest())
                out["kept"].append(text.decode())
            kinds = {"kept_sha256": pa.string(), "kept": pa.string()}
            yield pa.RecordBatch.from_arrays([batch["id"], *(pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items())], names=["id", *out])

    return work


def remove_repeated_words(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 35, gram: int = 12) -> DataFrame:
    """Cuts every word covered by a sequence of ``window`` words that also starts elsewhere.

    Words are runs of anything but ASCII white space, compared unchanged.
    Returns (key, n_words, n_removed, kept_sha256, kept), a row for each row of
    ``docs``; ``kept`` joins the remaining words by one space. A null or empty
    text has no words; texts shorter than ``window`` lose nothing; repeated rows
    repeat each other, so long ones lose all; a null key stays null; an empty
    table gives no rows. Other columns of ``docs`` are ignored, whatever their
    names.
    """
    rows = repeats.keyed(docs, key, text)
    groups = repeats.copies(rows)
    paths, own = repeats.met(rows.select("text", "k1", "k2").mapInArrow(_paths(window, gram), repeats.SEGMENT))
    kinds = repeats.kinds(paths)
    branching = repeats.cut_rows(rows, groups, repeats.mixed(kinds))
    edges = written(branching.mapInArrow(_paths(window, window), repeats.SEGMENT), "edges")
    walked = edges.where("m IS NOT NULL").groupBy("s", "t").agg(F.sum("times").alias("walked")).where("walked > 1").select("s", "t")
    again = edges.where("m IS NOT NULL").join(walked, ["s", "t"]).select("k1", "k2", "pos", (F.col("pos") + window).alias("end"))
    spans = repeats.whole_spans(paths, kinds, window).unionByName(again).unionByName(own).unionByName(repeats.own_spans(edges))
    kind = docs.schema[key].dataType.simpleString()
    out = repeats.with_spans(rows, groups, spans).mapInArrow(_remove(window), f"id {kind}, n_words long, n_removed long, kept_sha256 string, kept string")
    return out.withColumnRenamed("id", key)


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Digest columns of ``remove_repeated_words`` over ``documents``."""
    out = remove_repeated_words(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")
