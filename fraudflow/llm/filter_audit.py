"""How document filters act together: what each removes in every order of applying them.

Method: for each part of the corpus and each filter the ids of the failing
documents are kept as sorted posting lists, in blocks of an id range each. The
lists of a block are merged by a k-way merge that gallops: where one list alone
is next, an exponential search skips all its ids below the heads of the others.
Each id comes out once with the set of lists that hold it, so the merge yields
the sizes of all unions and differences of the lists; the sizes of the blocks
add up. From them every order of the filters follows, without looking at a
document again.

An id is a row's place in its block, so rows may repeat keys. Blocks hold a
bounded number of rows, and a part with a third of all documents is many blocks.
Copies meet by a digest of their text, a row for each block and different text.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, discard, read_table, utf8, written

SLICE = 1 << 20
#: Rows of an id range, all parts together.
BLOCK = 1 << 16
#: Filters of one audit at most: all their orders are reported.
MOST_FILTERS = 6
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_SYMBOL = np.isin(np.arange(256), list(b"#$%&*|"))


@dataclass(frozen=True)
class Measures:
    """What filters may ask of some texts."""

    words: np.ndarray
    distinct_words: np.ndarray
    code_points: np.ndarray
    capitals: np.ndarray
    symbols: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes], data: np.ndarray, at: np.ndarray) -> Measures:
        # bytes.split() parts at just the six ASCII white spaces
        words = [t.split() for t in texts]
        count = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[at])
        n, distinct = (np.array(x, np.int64) for x in ([len(w) for w in words], [len(set(w)) for w in words]))
        return cls(n, distinct, count((data & 0xC0) != 0x80), count(_UPPER[data]), count(_SYMBOL[data]))


#: Failure conditions by letter; the copies' filter comes after them.
FILTERS: dict[str, Callable[[Measures], np.ndarray]] = {
    "A": lambda m: m.words < 100,
    "B": lambda m: 100 * m.distinct_words < 80 * m.words,
    "C": lambda m: 100 * m.capitals > 10 * m.code_points,
    "D": lambda m: m.symbols > 0,
}


def gallop(ids: list[int], low: int, bound: int) -> int:
    """The first place from ``low`` on whose id is not below ``bound``, by doubling steps and a binary search."""
    step, n = 1, len(ids)
    while low + step < n and ids[low + step] < bound:
        step *= 2
    return bisect_left(ids, bound, low + step // 2, min(low + step + 1, n))


def merged(lists: list[list[int]]) -> Counter:
    """How many ids each set of lists, as a mask, has for itself: one galloping merge of sorted lists without repeats."""
    sizes: Counter = Counter()
    at = [0] * len(lists)
    going = [i for i, ids in enumerate(lists) if ids]
    while going:
        heads = [lists[i][at[i]] for i in going]
        least = min(heads)
        at_least = [i for i, h in zip(going, heads, strict=True) if h == least]
        if len(at_least) == 1:
            i = at_least[0]
            others = [h for h in heads if h != least]
            to = gallop(lists[i], at[i], min(others)) if others else len(lists[i])
            sizes[1 << i] += to - at[i]
            at[i] = to
        else:
            sizes[sum(1 << i for i in at_least)] += 1
            for i in at_least:
                at[i] += 1
        going = [i for i in going if at[i] < len(lists[i])]
    return sizes


def _blocks(filters: dict[str, Callable[[Measures], np.ndarray]]):
    """A row for each part of an id range: posting lists of the filters, and its different texts with their rows and keys."""

    def made(number: int, part: np.ndarray, names: list[str], fails: np.ndarray, digest: np.ndarray, keys: pa.Array):
        for p in np.unique(part).tolist():
            own = np.flatnonzero(part == p)
            order = own[np.lexsort((own, digest[own, 1], digest[own, 0]))]
            heads = np.flatnonzero(np.concatenate([[True], (np.diff(digest[order], axis=0) != 0).any(axis=1)]))
            place = np.searchsorted(own, order).astype(np.int32)
            bounds = pa.array(np.append(heads, len(order)).astype(np.int32))
            whole = pa.array([0, len(heads)], pa.int32())
            failing = pa.array([[np.flatnonzero(f[own]).astype(np.int32).tolist() for f in fails]], pa.list_(pa.list_(pa.int32())))
            texts = pa.StructArray.from_arrays(
                [pa.array(digest[order[heads], 0]), pa.array(digest[order[heads], 1]), pa.ListArray.from_arrays(bounds, pa.array(place)), pa.ListArray.from_arrays(bounds, keys.take(pa.array(order)))],
                names=["d1", "d2", "rows", "ids"],
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[p]]), pa.array([number], pa.int64()), pa.array([len(own)], pa.int64()), failing, pa.ListArray.from_arrays(whole, texts)],
                names=["part", "block", "n", "failing", "texts"],
            )

    def work(rows):
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def flush():
            known: dict[str, int] = {}
            part = np.array([known.setdefault(p, len(known)) for h in held for p in h[0]])
            fails, digest = np.concatenate([h[1] for h in held], axis=1), np.concatenate([h[2] for h in held])
            keys = pa.concat_arrays([h[3] for h in held])
            return made(number, part, list(known), fails, digest, keys)

        for batch in batches(rows, SLICE, "text"):
            texts = batch["text"].cast(pa.binary()).to_pylist()
            measures = Measures.of(texts, *utf8(batch["text"]))
            digest = np.frombuffer(b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts), "<i8").reshape(-1, 2)
            fails = np.stack([f(measures) for f in filters.values()]) if filters else np.zeros((0, len(texts)), bool)
            for low in range(0, batch.num_rows, BLOCK):
                cut = slice(low, low + BLOCK)
                part = batch["part"].slice(low, BLOCK)
                if size and size + len(part) > BLOCK:
                    yield from flush()
                    number, held, size = number + 1, [], 0
                held.append((part.to_pylist(), fails[:, cut], digest[cut], batch["id"].slice(low, BLOCK)))
                size += len(part)
        if held:
            yield from flush()

    return work


def _merge(rows):
    """(part, mask, n) of every block: rows that fail just the filters of the mask; the labels' bits come above."""
    for batch in rows:
        found: Counter = Counter()
        failing = batch["failing"].to_pylist()
        rest = [batch[c].to_pylist() for c in ("late", "good", "toxic")]
        for part, n, own, *more in zip(batch["part"].to_pylist(), batch["n"].to_pylist(), failing, *rest, strict=True):
            sizes = merged([*own, *([] if m is None else sorted(m) for m in more)])
            sizes[0] = n - sizes.total()
            for mask, size in sizes.items():
                found[part, mask] += size
        if found:
            parts, masks = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array(masks, pa.int32()), pa.array(list(found.values()), pa.int64())], names=["part", "mask", "n"])


_STEP = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def _orders(letters: str):
    """All orders of the filters for each part, from the sizes of its masks."""
    k = len(letters)
    full = (1 << k) - 1

    def work(rows):
        for batch in rows:
            for part, held in zip(batch["part"].to_pylist(), batch["sizes"].to_pylist(), strict=True):
                mask, n = np.array([s["mask"] for s in held]), np.array([s["n"] for s in held])
                good, toxic, fails = n * (mask >> k & 1), n * (mask >> (k + 1) & 1), mask & full
                lost = lambda f, before, of: int(of[(fails >> f & 1 == 1) & (fails & before == 0)].sum())  # noqa: B023, E731
                shapley = [
                    sum(factorial(before.bit_count()) * factorial(k - 1 - before.bit_count()) * lost(f, before, n) for before in range(full + 1) if not before >> f & 1) for f in range(k)
                ]
                out = []
                for order in permutations(range(k)):
                    before, left, name = 0, int(n.sum()), "".join(letters[f] for f in order)
                    for step, f in enumerate(order, 1):
                        removed, failing = lost(f, before, n), lost(f, 0, n)
                        left -= removed
                        out.append((part, name, step, left, removed, failing - removed, lost(f, full & ~(1 << f), n), lost(f, before, good), lost(f, before, toxic), shapley[f]))
                        before |= 1 << f
                kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[c.split()[0] for c in _STEP.split(", ")])

    return work


def filter_audit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang", filters: dict[str, Callable[[Measures], np.ndarray]] = FILTERS, copies: str = "E"
) -> DataFrame:
    """What each step of each order of the filters removes, by part.

    ``filters`` are failure conditions under one letter each; one more, named
    ``copies``, fails a text that a row with a smaller key has too, anywhere in
    the table. Returns (part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley): documents left after the
    step, removed by it, failing its filter but gone before, failing its filter
    alone, removed with label quality 1 and toxic 1, and removed summed over all
    orders. A null part is an empty string, a null text empty. A null key is
    neither smaller nor larger than another and has no labels; equal keys are
    not smaller than each other; repeated rows count each; several labels of a
    key count if one is 1. An empty table gives no rows, without labels nothing
    good or toxic is lost. Other columns are ignored, whatever their names.
    """
    letters = "".join(filters) + copies
    if len(letters) > MOST_FILTERS or len(set(letters)) != len(filters) + 1:
        raise ValueError(f"an audit takes at most {MOST_FILTERS} filters with different letters")
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = f"part string, block long, n long, failing array<array<int>>, texts array<struct<d1:bigint,d2:bigint,rows:array<int>,ids:array<{kind}>>>"
    blocks = written(rows.mapInArrow(_blocks(filters), schema), "blocks")
    texts = blocks.select("part", "block", F.explode("texts").alias("t")).select("part", "block", "t.*")
    spans = texts.groupBy("d1", "d2").agg(F.min(F.array_min("ids")).alias("first"), F.max(F.array_max("ids")).alias("last"))
    # written, so that Spark knows its size and can split the partition of a text that many blocks have
    firsts = written(spans.where("first < last").select("d1", "d2", "first"), "firsts")
    later = F.filter(F.arrays_zip("rows", "ids"), lambda x: x["ids"] > F.col("first"))["rows"]
    late = texts.join(firsts, ["d1", "d2"]).select("part", "block", later.alias("rows")).groupBy("part", "block").agg(F.flatten(F.collect_list("rows")).alias("late"))
    own = texts.select("part", "block", F.explode(F.arrays_zip("rows", "ids")).alias("x")).select("part", "block", F.col("x.rows").alias("row"), F.col("x.ids").alias("id")).where("id IS NOT NULL")
    told = labels.where("quality = 1 OR toxic = 1").groupBy(F.col(key).alias("id")).agg(F.max(F.expr("coalesce(quality = 1, false)")).alias("good"), F.max(F.expr("coalesce(toxic = 1, false)")).alias("toxic"))
    told = written(told, "told")
    marks = own.join(told, "id").groupBy("part", "block").agg(F.collect_list(F.when(F.col("good"), F.col("row"))).alias("good"), F.collect_list(F.when(F.col("toxic"), F.col("row"))).alias("toxic"))
    lists = blocks.select("part", "block", "n", "failing").join(late, ["part", "block"], "left").join(marks, ["part", "block"], "left")
    sizes = lists.drop("block").mapInArrow(_merge, "part string, mask int, n long").groupBy("part", "mask").agg(F.sum("n").alias("n"))
    sizes = written(sizes, "sizes")
    discard(blocks, firsts, told)
    by_part = sizes.groupBy("part").agg(F.collect_list(F.struct("mask", "n")).alias("sizes"))  # 4 times 2**filters at most
    return by_part.mapInArrow(_orders(letters), _STEP)


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    """``filter_audit`` of ``documents`` by ``lang`` and ``labels``."""
    return filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS late FROM d),
l AS (SELECT doc_id, bool_or(coalesce(quality, 0) = 1) AS good, bool_or(coalesce(toxic, 0) = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END
  + CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN late THEN 16 ELSE 0 END AS m
  FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, m, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM f GROUP BY ALL),
letter AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(l, b)),
orders AS (SELECT p.l || q.l || r.l || s.l || t.l AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bs FROM letter p, letter q, letter r, letter s, letter t WHERE p.b + q.b + r.b + s.b + t.b = 31
  AND len(list_distinct([p.l, q.l, r.l, s.l, t.l])) = 5),
steps AS (SELECT filter_order, CAST(i AS INT) AS step, bs[i] AS f, CAST(coalesce(list_sum(bs[1:i - 1]), 0) AS INT) AS before FROM orders, range(1, 6) AS r(i)),
o AS (SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (m & (before | f) = 0), 0) AS kept, coalesce(sum(n) FILTER (m & f = f AND m & before = 0), 0) AS removed,
  coalesce(sum(n) FILTER (m & f = f AND m & before != 0), 0) AS redundant, coalesce(sum(n) FILTER (m = f), 0) AS unique_fails,
  coalesce(sum(g) FILTER (m & f = f AND m & before = 0), 0) AS good_lost, coalesce(sum(x) FILTER (m & f = f AND m & before = 0), 0) AS toxic_lost FROM c, steps GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM o
"""
