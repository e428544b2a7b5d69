"""Removal of long byte strings that occur more than once (suffix-array dedup).

Method: suffixes are sorted by mergesort; two suffixes are compared through
their common extension, which a binary search over prefix polynomial hashes
finds in logarithmic time; neighbours in the sorted order with a common
extension of a whole window are repeats, and their bytes are compared before
they count (hash collisions cannot remove text).

Only suffixes that can have a twin are sorted. See ``repeats`` for how windows
are grouped by minimiser: the sort runs on groups of segments that share a
minimiser but are not equal, in tasks that hold a bounded block at a time. A
group with too many windows for a task is cut anew by the minimisers of longer
grams, at last by whole windows; each cut puts equal windows together again, so
every part is closed and nothing is left to compare across parts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .common import batches, utf8, written
from .hashing import BYTE_WORDS, powers, prefix, range_hash

SLICE = 1 << 20
#: Suffixes that are sorted at once in a task, and bytes that hold them (besides one open group).
BLOCK, BLOCK_BYTES = 200_000, 4 << 20
#: Windows of a group that one task looks into, some places at a time, and bytes of its segments; a larger group is cut anew.
GROUP, GROUP_BYTES = 2_000_000, 8 << 20
_CUT = "m long, k1 long, k2 long, pos long, place int, text binary"
_FOUND = "k1 long, k2 long, pos long, end long"


def _segments(window: int, gram: int):
    def work(rows):
        for batch in batches(rows, SLICE, "text"):
            data, at = utf8(batch["text"])
            byte = np.arange(len(data))
            yield from repeats.segment_rows(batch, BYTE_WORDS[data], at, data, byte, byte + 1, window, gram)

    return work


def _cut(window: int):
    """Bytes of the listed segments; more than ``SLICE`` bytes go out at once only if one text has them."""

    def work(rows):
        for batch in batches(rows, SLICE, "text"):
            data, at = utf8(batch["text"])
            text, pos, sizes = repeats.cuts_of(batch, window)
            flat = batch["cuts"].flatten()
            begin = at[text] + pos
            ends = np.concatenate([[0], np.cumsum(sizes)])
            for low in range(0, len(pos), 50_000):
                high = min(low + 50_000, len(pos))
                take = np.arange(ends[high] - ends[low]) + np.repeat(begin[low:high] - (ends[low:high] - ends[low]), sizes[low:high])
                own = pa.Array.from_buffers(pa.binary(), high - low, [None, pa.py_buffer((ends[low : high + 1] - ends[low]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[take]))])
                part, where = flat.slice(low, high - low), pa.array(text[low:high])
                yield pa.RecordBatch.from_arrays(
                    [part.field("m"), batch["k1"].take(where), batch["k2"].take(where), pa.array(pos[low:high]), part.field("place"), own],
                    names=["m", "k1", "k2", "pos", "place", "text"],
                )

    return work


class Suffixes:
    """Suffixes of a byte buffer, each judged on its first ``window`` bytes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, window: int):
        self.data, self.start, self.window = data, start, window
        self.h = prefix(BYTE_WORDS[data])
        self.up = powers(len(self.h))[0]
        self.whole = range_hash(self.h, start, window)
        self.steps = [1 << i for i in reversed(range(window.bit_length()))]

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes ``a`` and ``b``, at most a window."""
        x, y = self.start[a].copy(), self.start[b].copy()
        length = np.zeros(len(a), np.int64)
        h, up = self.h, self.up
        for step in self.steps:
            fits = length + step <= self.window
            p, q = np.where(fits, x, 0), np.where(fits, y, 0)
            same = fits & ((h[p + step] - h[p]) * up[p] == (h[q + step] - h[q]) * up[q]) if len(h) > step else fits & False
            grow = step * same
            length += grow
            x += grow
            y += grow
        return length

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """a < b, or a <= b where ``or_equal``."""
        out = or_equal.copy()
        differ = np.flatnonzero(self.whole[a] != self.whole[b])
        if len(differ):
            i, j = a[differ], b[differ]
            l = np.minimum(self.extension(i, j), self.window - 1)
            out[differ] = self.data[self.start[i] + l] < self.data[self.start[j] + l]
        return out

    def merge_sort(self, order: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Sorts each block ``begin[i]:end[i]`` of ``order`` (given for each place)."""
        order = order.copy()
        run = 1
        places = np.flatnonzero(end - begin > 1)
        while len(places):
            b, e = begin[places], end[places]
            local = places - b
            number = local // run
            other = b + (number ^ 1) * run
            stop = np.maximum(np.minimum(other + run, e), other)
            low, high = np.minimum(other, e), np.minimum(stop, e)
            base = low.copy()
            from_right = (number & 1) == 1
            own = order[places]
            open_ = np.flatnonzero(low < high)
            while len(open_):
                middle = (low[open_] + high[open_]) // 2
                before = self.less(order[middle], own[open_], from_right[open_])
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
                open_ = open_[low[open_] < high[open_]]
            order[b + (number // 2) * 2 * run + local % run + (low - base)] = own
            run *= 2
            places = places[(end - begin)[places] > run]
        return order

    def verified(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the windows of ``a`` and ``b`` hold the same bytes."""
        same = np.ones(len(a), bool)
        for low in range(0, len(a), 50_000):
            x, y = self.start[a[low : low + 50_000]], self.start[b[low : low + 50_000]]
            span = np.arange(self.window)
            same[low : low + 50_000] = (self.data[x[:, None] + span] == self.data[y[:, None] + span]).all(axis=1)
        return same


def repeated_suffixes(suffixes: Suffixes, bucket: np.ndarray) -> np.ndarray:
    """For each suffix, whether its window recurs in its bucket; whole buckets are sorted, about ``BLOCK`` suffixes at a time."""
    again = np.zeros(len(bucket), bool)
    order = np.argsort(bucket, kind="stable")
    heads = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    low = 0
    while low < len(order):
        after = np.searchsorted(heads, low + BLOCK)
        high = heads[after] if after < len(heads) else len(order)
        take = order[low:high]
        again[take] = _repeated(suffixes, take, bucket[take])
        low = high
    return again


def _repeated(suffixes: Suffixes, take: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    data, start = suffixes.data, suffixes.start[take]
    first = np.zeros(len(start), np.uint64)
    for i in range(8):
        first = (first << np.uint64(8)) | data[start + i].astype(np.uint64)
    order = np.lexsort((first, bucket))
    new = np.ones(len(order), bool)
    new[1:] = (bucket[order][1:] != bucket[order][:-1]) | (first[order][1:] != first[order][:-1])
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(order)))
    begin, end = np.repeat(heads, sizes), np.repeat(heads + sizes, sizes)
    order = suffixes.merge_sort(take[order], begin, end)
    near = np.flatnonzero(~new[1:]) + 1
    a, b = order[near - 1], order[near]
    close = suffixes.whole[a] == suffixes.whole[b]
    close[close] = suffixes.verified(a[close], b[close])
    same = np.zeros(len(order) + 1, bool)
    same[near] = close
    again = np.zeros(len(suffixes.start), bool)
    again[order] = same[:-1] | same[1:]
    return again[take]


def _block(window: int, table: pa.Table):
    data, at = utf8(table["text"])
    m, k1, k2, pos, place = (table[c].to_numpy() for c in ("m", "k1", "k2", "pos", "place"))
    n = np.diff(at) - window + 1
    row = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    new = np.ones(len(m), bool)
    new[1:] = m[1:] != m[:-1]
    # the minimiser lies at one place in all segments of a group: windows line up by their distance to it
    bucket = (np.cumsum(new) - 1)[row] * (2 * window) + (place[row] - offset)
    hits = np.flatnonzero(repeated_suffixes(Suffixes(data, at[row] + offset, window), bucket))
    cut = np.ones(len(hits), bool)
    cut[1:] = (np.diff(hits) != 1) | (row[hits][1:] != row[hits][:-1])
    heads = np.flatnonzero(cut)
    size = np.diff(np.append(heads, len(hits)))
    h = row[hits[heads]]
    p = pos[h] + offset[hits[heads]]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (k1[h], k2[h], p, p + size + window - 1)], names=["k1", "k2", "pos", "end"])


def _sort(window: int):
    """Reads segments in the order of their minimisers and sorts the suffixes of whole groups."""

    def work(rows):
        held, size, long = [], 0, 0
        for whole in rows:
            for low in range(0, whole.num_rows, 512):
                batch = whole.slice(low, 512)
                held.append(batch)
                own = sum(len(x) for x in batch["text"].to_pylist())
                size, long = size + own - (window - 1) * batch.num_rows, long + own
                if size < BLOCK and long < BLOCK_BYTES:
                    continue
                table = pa.Table.from_batches(held).combine_chunks()
                m = table["m"].to_numpy()
                same = m == m[-1]
                keep = int(np.argmin(same[::-1])) if not same.all() else len(m)
                done = len(m) - keep
                if done:
                    yield from _block(window, table.slice(0, done).combine_chunks())
                rest = table.slice(done).combine_chunks()
                held = rest.to_batches()
                long = sum(len(x) for x in rest["text"].to_pylist())
                size = long - (window - 1) * rest.num_rows
        if held:
            yield from _block(window, pa.Table.from_batches(held).combine_chunks())

    return work


def _remove(window: int):
    def work(rows):
        for batch in batches(rows, SLICE, "text"):
            data, at = utf8(batch["text"])
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
            for i, (copies, spans) in enumerate(zip(batch["c"].to_pylist(), batch["spans"].to_pylist(), strict=True)):
                own = data[at[i] : at[i + 1]]
                gone = [(s["pos"], s["end"]) for s in spans or ()]
                if copies > 1 and len(own) >= window:
                    gone = [(0, len(own))]
                parts, last = [], 0
                for a, b in gone:
                    parts.append(own[last:a].tobytes())
                    last = b
                kept = b"".join([*parts, own[last:].tobytes()])
                out["n_bytes"].append(len(own))
                out["n_removed"].append(len(own) - len(kept))
                out["n_spans"].append(len(gone))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept)
            yield pa.RecordBatch.from_arrays([batch["id"], *(pa.array(v, pa.binary() if k == "kept" else None) for k, v in out.items())], names=["id", *out])

    return work


def remove_repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 200, gram: int = 40) -> DataFrame:
    """Cuts every byte covered by a ``window``-byte string that also starts elsewhere.

    Returns (key, n_bytes, n_removed, n_spans, kept_sha256, kept), a row for
    each row of ``docs``; ``kept`` are the remaining bytes. Null and empty texts
    give zeros and the digest of nothing; texts shorter than ``window`` are
    kept; repeated rows repeat each other, so long ones are removed whole; a
    null key stays null; an empty table gives no rows. Other columns of
    ``docs`` are ignored, whatever their names.
    """
    rows = repeats.keyed(docs, key, text)
    groups = repeats.copies(rows)
    source, spans, small = rows.select("text", "k1", "k2"), None, None
    for size in (gram, (gram + window) // 2, window):
        met, own = repeats.met(source.mapInArrow(_segments(window, size), repeats.SEGMENT))
        kinds = repeats.kinds(met)
        mixed = written(repeats.mixed(kinds), "mixed")
        whole = repeats.whole_spans(met, kinds, window).unionByName(own)
        spans = whole if spans is None else spans.unionByName(whole)
        if size == window:  # a group is one window: what is mixed here differs
            break
        fits = (F.col("windows") <= GROUP) & (F.col("windows") + F.col("kinds") * (window - 1) <= GROUP_BYTES)
        few = mixed.where(fits)
        small = few if small is None else small.unionByName(few)
        large = mixed.where(~fits)
        if large.isEmpty():
            break
        source = repeats.cut_rows(rows, groups, large)
    cuts = repeats.cut_rows(rows, groups, small).mapInArrow(_cut(window), _CUT)
    judged = cuts.repartition("m").sortWithinPartitions("m").mapInArrow(_sort(window), _FOUND)
    spans = spans.unionByName(judged)
    kind = docs.schema[key].dataType.simpleString()
    out = repeats.with_spans(rows, groups, spans).mapInArrow(
        _remove(window), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    return out.withColumnRenamed("id", key)


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Digest columns of ``remove_repeated_bytes`` over ``documents``."""
    from .common import read_table

    out = remove_repeated_bytes(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
