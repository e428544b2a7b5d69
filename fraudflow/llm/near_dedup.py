"""Near-duplicate classes by weighted MinHash (BagMinHash).

A text is the multiset of its 5-word shingles. Method: each shingle runs
Poisson processes over its weight axis, discretised into the intervals [0, 1),
[1, 2), [2, 4), [4, 8) and so on; a wider interval has a faster process, and a
point counts if it lies below the shingle's weight. Every point falls into one
of the signature's registers, which keep the earliest. Two texts agree in a
register with probability equal to their weighted Jaccard similarity, and
points are drawn in order of time only until no register can change any more.

Signatures are cut into bands; texts that agree in a band are candidates, and
the exact multiset overlap decides. Candidates are not all pairs of a bucket:

* equal texts are one (their rows only count);
* each text is compared with its bucket's pivot, the text that meets most
  others, and with its neighbours in orders of the bucket by hash, two for each
  bucket: a few pairs a text, whatever a bucket's size; as the buckets of a text
  have different orders, groups grow together into components;
* texts of buckets that hold several components by then are cut into longer
  bands; only texts that meet another component there go on;
* among those the last round is exact. Shingles are put in one order, rarest
  first, and shingles that one component alone has only count; two texts that
  are similar enough share a shingle near the beginning of both, and how near
  follows from their lengths. The join is on shingle and length classes, so a
  group of texts that are much alike but not enough makes hardly any pair: what
  makes them differ comes first. What is linked already is not compared.

A class is a connected component of links, so no link between classes is left.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, discard, read_table, text_keys, utf8, written
from .debruijn_dedup import word_hashes
from .hashing import all_ranges, mix, prefix, range_hash

SLICE = 1 << 20
SHINGLE, BANDS, ROWS = 5, 24, 4
#: Times that neighbours in a bucket are compared.
CHAINS = 2
#: Bands of the second signature: a pair of similarity 0.8 has none in common with probability 0.000002.
LONG_BANDS, LONG_ROWS = 56, 7
#: Logarithm of the width of a length class.
GRID = 0.02
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _nth(i: int) -> np.uint64:
    return np.uint64(i * int(_STEP) % (1 << 64))


def shingles(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of all shingles; a text of 1 to 4 words is one shingle."""
    n = np.diff(at)
    text = np.repeat(np.arange(len(n)), n)
    own, hashes = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(words) >= SHINGLE:
        inside = text[: len(words) - SHINGLE + 1] == text[SHINGLE - 1 :]
        own, hashes = text[: len(inside)][inside], mix(all_ranges(prefix(words), SHINGLE)[inside])
    few = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(few):
        whole = mix(range_hash(prefix(words), at[few], n[few]) ^ n[few].astype(np.uint64))
        own, hashes = np.concatenate([own, few]), np.concatenate([hashes, whole])
    return own, hashes


def weighted(own: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each text and how often it has them."""
    order = np.lexsort((hashes, own))
    own, hashes = own[order], hashes[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    return own[first], hashes[first], np.diff(np.append(first, len(own)))


def signatures(own: np.ndarray, hashes: np.ndarray, weight: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """Earliest point of each register, a row for each text; infinite for texts without shingles."""
    least = np.full((texts, registers), np.inf)
    flat = least.reshape(-1)
    parts = []
    level, low = 0, 0
    while True:  # the intervals that begin below each weight
        high = 1 << level
        take = np.flatnonzero(weight > low)
        if not len(take):
            break
        parts.append((own[take], mix(hashes[take] + _nth(level + 1)), weight[take], np.full(len(take), low), np.full(len(take), high - low)))
        low, level = high, level + 1
    if not parts:
        return least
    text, seed, limit, begin, width = (np.concatenate(x) for x in zip(*parts, strict=True))
    time = np.zeros(len(text))
    step = 0
    while len(text):
        step += 1
        draw = mix(seed + _nth(2 * step))
        place = mix(seed + _nth(2 * step + 1))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / width
        counts = begin + (place >> np.uint64(32)).astype(np.int64) * width // (1 << 32) < limit
        register = (place & np.uint64(0xFFFFFFFF)).astype(np.int64) % registers
        np.minimum.at(flat, (text * registers + register)[counts], time[counts])
        going = time < least.max(axis=1)[text]
        text, seed, limit, begin, width, time = (x[going] for x in (text, seed, limit, begin, width, time))
    return least


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash for each band of each signature."""
    # times are rounded, so that the last bit of a logarithm does not part two machines
    points = mix((np.minimum(signature, 1e5) * (1 << 36)).astype(np.uint64))
    out = np.zeros((len(signature), bands), np.uint64)
    for r in range(rows):
        out = mix(out + points[:, r::rows][:, :bands])
    return mix(out + np.arange(1, bands + 1, dtype=np.uint64) * _STEP)


def _signatures(bands: int, rows: int):
    def work(batches_):
        for batch in batches(batches_, SLICE, "text"):
            own, hashes = shingles(*word_hashes(*utf8(batch["text"])))
            texts = batch.num_rows
            least = signatures(*weighted(own, hashes), texts, bands * rows)
            keys = band_hashes(least, bands, rows).view(np.int64)
            some = np.bincount(own, minlength=texts) > 0
            lists = [k.tolist() if s else [] for k, s in zip(keys, some, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["k1"], batch["k2"], pa.array(lists, pa.list_(pa.int64()))], names=["id", "k1", "k2", "bands"])

    return work


def _sets(batches_):
    """Sorted 64-bit ids of the shingles of a text, their number and its long bands; the same shingle again has another id."""
    for batch in batches(batches_, SLICE, "text"):
        own, hashes = shingles(*word_hashes(*utf8(batch["text"])))
        own, hashes, weight = weighted(own, hashes)
        bands = band_hashes(signatures(own, hashes, weight, batch.num_rows, LONG_BANDS * LONG_ROWS), LONG_BANDS, LONG_ROWS).view(np.int64)
        again = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
        own = np.repeat(own, weight)
        ids = mix(np.repeat(hashes, weight) + again.astype(np.uint64) * _STEP)
        order = np.lexsort((ids, own))
        packed = ids[order]
        ends = np.searchsorted(own[order], np.arange(batch.num_rows + 1))
        yield pa.RecordBatch.from_arrays(
            [batch["k1"], batch["k2"], pa.array([packed[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()), pa.array(np.diff(ends)), pa.array(list(bands), pa.list_(pa.int64()))],
            names=["k1", "k2", "ids", "n", "long"],
        )


def unpacked(ids: bytes) -> np.ndarray:
    """The ids of a packed set."""
    return np.frombuffer(ids, np.int64)


def overlap(a: bytes, b: bytes) -> int:
    """Common ids of two packed sets."""
    return len(np.intersect1d(unpacked(a), unpacked(b), assume_unique=True))


def _listed(batches_):
    """A row for each shingle id of a text."""
    for batch in batches_:
        if batch.num_rows:
            own = [unpacked(x) for x in batch["ids"].to_pylist()]
            row = pa.array(np.repeat(np.arange(len(own)), [len(x) for x in own]))
            yield pa.RecordBatch.from_arrays([batch["v"].take(row), batch["c"].take(row), pa.array(np.concatenate(own))], names=["v", "c", "id"])


def _linked(similarity: float):
    def work(batches_):
        for batch in batches_:
            keep = []
            for a, b in zip(batch["ids_a"], batch["ids_b"], strict=True):
                x, y = a.as_py(), b.as_py()
                common = overlap(x, y)
                keep.append(common >= similarity * ((len(x) + len(y)) // 8 - common) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return work


_V = "struct<k1:bigint,k2:bigint>"


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float, name: str) -> DataFrame:
    """The pairs (a, b) whose multisets are similar enough."""
    left = pairs.join(sets.select(F.col("v").alias("a"), F.col("ids").alias("ids_a")), "a")
    both = left.join(sets.select(F.col("v").alias("b"), F.col("ids").alias("ids_b")), "b")
    # a set much smaller than the other cannot be similar to it
    near = both.where(F.least(F.length("ids_a"), F.length("ids_b")) >= F.lit(similarity) * F.greatest(F.length("ids_a"), F.length("ids_b")) - 1e-6)
    return written(near.select("a", "b", "ids_a", "ids_b").mapInArrow(_linked(similarity), f"a {_V}, b {_V}"), name)


def _rooted(trees: DataFrame) -> DataFrame:
    """(v, c) with the root of the tree of each ``v``, where c is its parent and a root its own; each round halves the depth."""
    while True:
        up = trees.select(F.col("v").alias("c"), F.col("c").alias("up"))
        new = written(trees.join(up, "c").select("v", F.col("up").alias("c"), (F.col("up") != F.col("c")).alias("moved")), "labels")
        discard(trees)
        trees = new
        if new.where("moved").isEmpty():
            return trees


def _renamed(names: DataFrame, trees: DataFrame) -> DataFrame:
    """``names`` (v, c), where each c that ``trees`` (v, c) knows has the name that it has there."""
    known = trees.select(F.col("v").alias("c"), F.col("c").alias("root"))
    return names.join(known, "c", "left").select("v", F.coalesce("root", "c").alias("c"))


def components(links: DataFrame) -> DataFrame:
    """(v, c) of every vertex of ``links`` (a, b): the least vertex of its component.

    Each round hangs every vertex on its least neighbour, if that is less, and
    makes each tree one vertex, named by its root. Links inside a tree are gone
    then and parallel ones are one, so a link is joined once, not once a round,
    and at most half the vertices are left; all of it stays in distributed tables.
    """
    edges, names = links, None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        trees = _rooted(written(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("c")), "labels"))
        ends = [trees.select(F.col("v").alias(x), F.col("c").alias(f"c{x}")) for x in ("a", "b")]
        left = written(_ordered(edges.join(ends[0], "a").join(ends[1], "b").where("ca != cb"), "ca", "cb"), "edges")
        if names is None:
            names = trees
        else:
            new = written(_renamed(names, trees), "labels")
            discard(edges, names, trees)
            names = new
        edges = left
        if left.isEmpty():
            discard(left)
            return names


def _ordered(df: DataFrame, x: str, y: str) -> DataFrame:
    """Different pairs (a, b), the lesser first."""
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _joined(names: DataFrame, more: DataFrame) -> DataFrame:
    """(v, c): the components ``names`` (v, c) after further links (a, b); only what these links touch is gone through again."""
    if more.isEmpty():
        return names
    ends = more.select(F.col("a").alias("v")).unionByName(more.select(F.col("b").alias("v"))).distinct()
    held = written(ends.join(names, "v", "left").select("v", F.coalesce("c", "v").alias("c")), "touched")
    a, b = (held.select(F.col("v").alias(x), F.col("c").alias(f"c{x}")) for x in ("a", "b"))
    between = written(_ordered(more.join(a, "a").join(b, "b").where("ca != cb"), "ca", "cb"), "between")
    merged = components(between)
    known = names.join(held.select("v"), "v", "left_anti").unionByName(held)
    out = written(_renamed(known, merged), "labels")
    discard(held, between, merged)
    return out


def _class(n):
    return F.floor(F.log(n) / GRID).cast("int")


def _reach(n, other, similarity: float):
    """The last place in the order of shingles at which a text of ``n`` can first meet one of ``other`` or more."""
    return n - F.ceil(F.lit(similarity / (1 + similarity)) * (n + other) - 1e-6)


def across(members: DataFrame, sets: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b), and the sets of their texts: pairs of texts of different components that can be similar enough.

    ``members`` has (v, c): texts and (a hash of) the component of each. A text
    takes part if it shares a long band with another component. The pairs hold
    all that are similar enough among the texts that share a long band.
    """
    spark = members.sparkSession
    banded = members.join(sets.select("v", "n", "long"), "v").select("v", "c", "n", F.explode("long").alias("b"))
    # the lengths, by class, that a text meets and that are near enough to its own
    own = _class(F.col("n"))
    bucket = Window.partitionBy("b")
    seen = banded.select("v", "c", "n", F.min("c").over(bucket).alias("low"), F.max("c").over(bucket).alias("high"), F.collect_set(own).over(bucket).alias("classes")).where("low != high")
    near = F.filter("classes", lambda c: F.abs(c - own) <= F.lit(int(-math.log(similarity) / GRID) + 1))
    met = written(seen.select("v", "c", "n", near.alias("near")), "met")
    if met.isEmpty():
        discard(met)
        return spark.createDataFrame([], f"a {_V}, b {_V}"), sets
    seekers = met.groupBy("v", "c", "n").agg(F.array_distinct(F.flatten(F.collect_set("near"))).alias("classes"))
    held = written(seekers.join(sets.select("v", "ids"), "v"), "seekers")
    listed = written(held.select("v", "c", "ids").mapInArrow(_listed, f"v {_V}, c long, id long"), "listed")
    common = listed.groupBy("id").agg(F.count(F.lit(1)).alias("df"), (F.min("c") != F.max("c")).alias("shared"))
    order = Window.partitionBy("v").orderBy("shared", "df", "id")
    placed = listed.join(common, "id").select("v", "id", "shared", (F.row_number().over(order) - 1).alias("at"))
    first = placed.where("shared").join(held.drop("ids"), "v").where(F.col("at") <= _reach(F.col("n"), F.col("n") * similarity, similarity))
    first = written(first, "prefixes")
    least = lambda c: F.ceil(F.exp(c * GRID) - 1e-6)
    longer_ones = F.filter("classes", lambda c: (c >= own) & (F.col("at") <= _reach(F.col("n"), F.greatest("n", least(c)), similarity)))
    shorter_ones = F.filter("classes", lambda c: (c <= own) & (F.col("at") <= _reach(F.col("n"), F.greatest(F.col("n") * similarity, least(c)), similarity)))
    x = first.select("id", own.alias("s"), F.explode(longer_ones).alias("l"), F.col("v").alias("x"), F.col("c").alias("cx"), F.col("n").alias("nx"), F.col("at").alias("px"))
    y = first.select("id", F.explode(shorter_ones).alias("s"), own.alias("l"), F.col("v").alias("y"), F.col("c").alias("cy"), F.col("n").alias("ny"), F.col("at").alias("py"))
    met_at = x.join(y, ["id", "s", "l"]).where("cx != cy AND nx <= ny").where((F.col("px") <= _reach(F.col("nx"), F.col("ny"), similarity)) & (F.col("py") <= _reach(F.col("ny"), F.col("nx"), similarity)))
    pairs = written(_ordered(met_at, "x", "y"), "across")
    discard(met, listed, first)
    return pairs, held


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = 0.8, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(key, class_id, class_size) of every row of ``docs``.

    ``class_id`` is the least id of the rows whose texts are linked, directly or
    through others, by a multiset Jaccard similarity of at least ``similarity``
    over 5-word shingles. A pair of just that similarity is a candidate with
    probability 1 - (1 - similarity**rows)**bands, 0.999997 here. Words are runs
    of anything but ASCII white space, unchanged. Equal texts, null or empty
    ones too (null is empty), are one class; a text of 1 to 4 words is one
    shingle; repeated rows are members each; a null key stays null and never
    names a class that has an id; an empty table gives no rows. Other columns
    of ``docs`` are ignored, whatever their names.
    """
    kind = docs.schema[key].dataType.simpleString()
    held = F.coalesce(F.col(text), F.lit(""))
    all_rows = docs.select(F.col(key).alias("id"), held.alias("text"), *text_keys(held))
    v = F.struct("k1", "k2").alias("v")
    signed = written(all_rows.mapInArrow(_signatures(bands, rows), f"id {kind}, k1 long, k2 long, bands array<long>"), "signatures")
    texts = signed.groupBy("k1", "k2").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("size"), F.first("bands").alias("bands"))
    banded = texts.select(v, F.explode("bands").alias("b"))
    # what is told of a bucket is told beside its rows, as they lie: one pass and no join
    bucket = Window.partitionBy("b")
    buckets = written(banded.withColumn("met", F.count(F.lit(1)).over(bucket)).where("met > 1"), "buckets")
    weights = buckets.groupBy("v").agg(F.sum("met").alias("meets"))
    ranked = buckets.join(weights, "v").select("b", "v", F.struct(-F.col("meets"), "v").alias("rank"))
    star = ranked.select(F.col("v").alias("x"), F.min("rank").over(bucket).getField("v").alias("y")).where("x != y")
    for turn in range(CHAINS):
        order = Window.partitionBy("b").orderBy(F.xxhash64(F.lit(turn), "b", "v"), "v")
        star = star.unionByName(buckets.select("v", F.lag("v").over(order).alias("x")).where("x IS NOT NULL").select("x", F.col("v").alias("y")))
    tested = written(_ordered(star, "x", "y"), "tested")

    candidates = buckets.select("v").distinct().select("v.k1", "v.k2")
    chosen = texts.select("k1", "k2", "first").join(candidates, ["k1", "k2"])
    source = all_rows.join(chosen, ["k1", "k2"]).where(F.col("id").eqNullSafe(F.col("first"))).select("text", "k1", "k2")
    sets = written(source.mapInArrow(_sets, "k1 long, k2 long, ids binary, n long, long array<long>").dropDuplicates(["k1", "k2"]).select(v, "ids", "n", "long"), "sets")
    links = _verified(tested, sets, similarity, "links")
    parts = components(links)
    placed = buckets.select("b", "v").join(parts.select("v", "c"), "v", "left").select("b", "v", F.coalesce("c", "v").alias("c"))
    split = placed.select("v", "c", F.min("c").over(bucket).alias("low"), F.max("c").over(bucket).alias("high")).where("low != high")
    members = split.select("v", F.xxhash64("c.k1", "c.k2").alias("c")).distinct()
    pairs, held = across(members, sets, similarity)
    more = _verified(pairs.join(tested, ["a", "b"], "left_anti"), held, similarity, "links")
    classes = _joined(parts, more)

    named = texts.select(v, "k1", "k2", "first", "size").join(classes.select("v", "c"), "v", "left").withColumn("c", F.coalesce("c", "v"))
    named = written(named.select("k1", "k2", "c", "first", "size"), "named")
    discard(buckets, tested, sets, links, more, parts, *([] if classes is parts else [classes]))
    totals = named.groupBy("c").agg(F.min("first").alias("class_id"), F.sum("size").alias("class_size"))
    known = named.join(totals, "c").select("k1", "k2", "class_id", "class_size")
    return signed.select("id", "k1", "k2").join(known, ["k1", "k2"]).select(F.col("id").alias(key), "class_id", "class_size")


def op10_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """``near_duplicates`` of ``documents``."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))
