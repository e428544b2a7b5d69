"""Tokenising documents and packing them into training sequences.

Method: bounded-space online best-fit. Pieces arrive one by one; each goes into
the open bin that it fills most nearly. Open bins are kept by their free space:
a bitset has a bit for each amount of free space that some open bin has, so the
best fit is the lowest set bit at or above the piece's length. The number of
open bins is fixed; when one too many is open, the fullest closes.

Spark deals the pieces (a short row each, never the tokens) evenly, whatever
their ids, to as many tasks as their number asks for, longest first within a
task, and each task packs its own. A task ends with at most ``open_bins`` bins that are not full.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, read_table, utf8, written
from .hashing import BYTE_WORDS, mix, prefix, range_hash

#: Bytes of text that are split at once: a worker takes some sixty times as much for it.
SLICE = 1 << 18
#: Parts whose ids a Python worker keeps; a full cache is emptied.
CACHED = 300_000
#: Pieces that one task packs.
PIECES_A_TASK = 50_000


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The place of a public vocabulary file, asked of the module that holds them; another file is passed by its path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, 3, np.uint8)
    kinds[list(b" \t\n\v\f\r")] = 0
    kinds[[*range(65, 91), *range(97, 123)]] = 1
    kinds[48:58] = 2
    return kinds


#: 0 white space, 1 letter, 2 digit, 3 other.
_CLASS = _byte_classes()
_LOWER = np.arange(256, dtype=np.uint8) + 32 * ((np.arange(256) >= 65) & (np.arange(256) <= 90)).astype(np.uint8)


class Words:
    """Token ids of texts from the ids of their parts, each part looked up once.

    No token of this vocabulary spans white space, and inside a chunk its
    tokenizer first splits off runs of letters, single digits and runs of other
    signs. Where a chunk holds plain letters (ASCII and the accented letters up
    to U+00FF), digits and signs, the split and the lower case are made here
    on the bytes of many texts at once and the tokenizer's model gives the ids
    of each new part. Any other chunk (apostrophes, control characters,
    combining marks, other scripts, special tokens) is one part that goes
    through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
        hidden = [b for b in range(256) if b not in shown]
        self.signs = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.forget()

    def forget(self) -> None:
        self.place: dict[int, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.begin = self.size = np.zeros(0, np.int64)

    def learn(self, parts: list[tuple[int, bytes, bool]]) -> None:
        """Adds (hash, bytes, odd) parts."""
        model, signs, place = self.tokenizer.model, self.signs, self.place
        ids, sizes = [], []
        for h, part, odd in parts:
            own = self.tokenizer.encode(part.decode(), add_special_tokens=False).ids if odd else [t.id for t in model.tokenize(part.decode("latin-1").translate(signs))]
            place[h] = len(self.size) + len(sizes)
            ids += own
            sizes.append(len(own))
        size = np.array(sizes, np.int64)
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, np.array(ids, np.uint32)])

    @staticmethod
    def parts(data: np.ndarray, at: np.ndarray):
        """Lower-cased bytes, and the start, end and oddity of each part in them."""
        kind = _CLASS[data]
        low = _LOWER[data]
        lead = data == 0xC3
        after = np.zeros(len(data), bool)
        after[1:] = lead[:-1]
        accented = after & (data >= 0x80) & (data <= 0xBF) & (data != 0x97) & (data != 0xB7)
        kind[accented] = 1
        kind[:-1][accented[1:]] = 1
        low[accented & (data <= 0x9E)] += 32
        odd = ((data >= 0x80) & (kind != 1)) | (data == 39) | (data < 9) | ((data > 13) & (data < 32)) | (data == 127)
        odd[:-1] |= (data[:-1] == 60) & (data[1:] == 124)
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True
        space = kind == 0
        change = np.ones(len(data), bool)
        change[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2) | edge[1:-1]
        chunk_start = edge[:-1].copy()
        chunk_start[1:] |= space[1:] != space[:-1]
        chunk_start[:1] = True
        chunk = np.cumsum(chunk_start) - 1
        odd_chunk = np.zeros(chunk[-1] + 1, bool)
        odd_chunk[chunk[np.flatnonzero(odd)]] = True
        odd = odd_chunk[chunk]
        low[odd] = data[odd]
        change = np.where(odd, chunk_start, change)
        starts = np.flatnonzero(change)
        ends = np.append(starts[1:], len(data))
        keep = ~space[starts]
        starts, ends = starts[keep], ends[keep]
        return low, starts, ends, odd[starts]

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the offsets of the texts in them."""
        nothing = np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        if not len(data):
            return nothing
        low, starts, ends, odd = self.parts(data, at)
        if not len(starts):
            return nothing
        salt = (ends - starts).astype(np.uint64) * np.uint64(2) + odd
        hashes = mix(range_hash(prefix(BYTE_WORDS[low]), starts, ends - starts) ^ salt)
        kinds, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.place) > CACHED:
            self.forget()
        place = self.place
        known = kinds.tolist()
        rows = np.array([place.get(h, -1) for h in known], np.int64)
        new = np.flatnonzero(rows < 0)
        if len(new):
            text = low.tobytes()
            self.learn([(known[i], text[a:b], o) for i, a, b, o in zip(new.tolist(), starts[first[new]].tolist(), ends[first[new]].tolist(), odd[first[new]].tolist(), strict=True)])
            rows[new] = [place[known[i]] for i in new.tolist()]
        rows = rows[kind]
        n = self.size[rows]
        stops = np.cumsum(n)
        take = np.arange(stops[-1]) + np.repeat(self.begin[rows] - (stops - n), n)
        bounds = np.concatenate([[0], stops])[np.searchsorted(starts, at)]
        return self.ids[take], bounds


_words: dict[str, Words] = {}


def _tokenise(path: str, size: int, end_id: int):
    def work(rows):
        words = _words.get(path) or _words.setdefault(path, Words(path))
        for batch in batches(rows, SLICE, "text"):
            ids, at = words.encode(*utf8(batch["text"]))
            out = {"row": [], "piece": [], "start": [], "length": [], "crc": []}
            last = np.array([end_id], np.uint32)
            for i in range(batch.num_rows):
                own = np.concatenate([ids[at[i] : at[i + 1]], last]).astype("<u4")
                for piece, start in enumerate(range(0, len(own), size)):
                    part = own[start : start + size]
                    for k, v in zip(out, (i, piece, start, len(part), zlib.crc32(part.tobytes())), strict=True):
                        out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [batch["id"].take(pa.array(out["row"], pa.int64())), pa.array(out["piece"], pa.int32()), *(pa.array(out[k], pa.int64()) for k in ("start", "length", "crc"))],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )

    return work


class OpenBins:
    """A fixed number of open bins, found by free space through a bitset."""

    def __init__(self, size: int, most: int, number: int):
        self.size, self.most, self.next = size, most, number
        self.bits, self.count = 0, 0
        self.by_free: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        found = bins.pop()
        if not bins:
            del self.by_free[free]
            self.bits ^= 1 << free
        self.count -= 1
        return found

    def put(self, length: int) -> tuple[int, int]:
        """The bin for a piece of ``length`` and the piece's place in it."""
        fits = self.bits >> length
        if fits:
            free = length + ((fits & -fits).bit_length() - 1)
            found = self._take(free)
        else:
            free, found = self.size, self.next
            self.next += 1
        left = free - length
        if left:
            self.bits |= 1 << left
            self.by_free.setdefault(left, []).append(found)
            self.count += 1
            if self.count > self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return found, self.size - free


def _pack(size: int, open_bins: int):
    def work(rows):
        bins = OpenBins(size, open_bins, TaskContext.get().partitionId() << 40)
        for batch in rows:
            placed = [bins.put(n) for n in batch["length"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                names=[*batch.schema.names, "sequence_id", "offset"],
            )

    return work


def pack_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4096, open_bins: int = 16384, path: str | None = None, end_id: int = 1
) -> DataFrame:
    """Places every document, in pieces of at most ``size`` tokens, in sequences of ``size``.

    Returns a row per piece: (key, piece, start, length, ids_crc32,
    sequence_id, offset). Only documents longer than ``size`` are cut. A null or
    empty text is its end token alone; repeated rows are packed each for
    itself; a null key stays null; an empty table gives no rows. Other columns
    of ``docs`` are ignored, whatever their names.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long"
    pieces = written(rows.mapInArrow(_tokenise(path or tokenizer_path(), size, end_id), schema), "pieces")
    tasks = -(-pieces.count() // PIECES_A_TASK) or 1
    dealt = pieces.repartition(tasks) if tasks > 1 else pieces.coalesce(1)
    ordered = dealt.sortWithinPartitions(F.desc("length"), "id", "piece", "ids_crc32")
    out = ordered.mapInArrow(_pack(size, open_bins), f"{schema}, sequence_id long, offset long")
    return out.withColumnRenamed("id", key)


def op2_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """``pack_documents`` over ``documents``."""
    return pack_documents(read_table(spark, sf_dir, "documents"))
