"""Fill-in-middle: texts cut into prefix, middle and suffix at token boundaries, and put in another order.

Method: the places at which tokens begin are kept as a Roaring-style set. Places
are dealt to containers by their high bits; a container is an array of its
places, a bitmap, or a list of runs, whichever is smallest, and a directory
holds how many places come before each container. The place of the i-th token is
found by a binary search in the directory and a select inside one container:
both cuts of a text come from it.

A token is a run of ASCII letters or any other single character. How many tokens
the prefix and the middle get, and which form a text takes, follows from a hash
of its key alone, so the work is one pass without a shuffle, and a lost task is
repeated with the same result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, read_table

SLICE = 1 << 20
#: Places of a container.
CHUNK = 1 << 16
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class ArrayContainer:
    """The places themselves: best for few of them."""

    def __init__(self, places: np.ndarray):
        self.places = places.astype(np.uint16)

    def select(self, i: int) -> int:
        return int(self.places[i])


class BitmapContainer:
    """A bit for each place, and how many come before each word of 64."""

    def __init__(self, places: np.ndarray):
        bits = np.zeros(-(-CHUNK // 64) * 64, np.uint8)
        bits[places] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, i: int) -> int:
        word = int(np.searchsorted(self.before, i, side="right")) - 1
        left, rest = int(self.words[word]), i - int(self.before[word])
        for _ in range(rest):
            left &= left - 1
        return 64 * word + (left & -left).bit_length() - 1


class RunContainer:
    """First place of each run of neighbours, and how many places come before it."""

    def __init__(self, places: np.ndarray):
        heads = np.flatnonzero(np.diff(places, prepend=-2) != 1)
        self.first, self.before = places[heads].astype(np.uint16), heads.astype(np.uint16)

    def select(self, i: int) -> int:
        run = int(np.searchsorted(self.before, i, side="right")) - 1
        return int(self.first[run]) + i - int(self.before[run])


def container(places: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container of sorted places below ``CHUNK``."""
    runs = int((np.diff(places, prepend=-2) != 1).sum())
    sizes = {ArrayContainer: 2 * len(places), BitmapContainer: CHUNK // 8, RunContainer: 4 * runs}
    return min(sizes, key=sizes.get)(places)


class BoundarySet:
    """Where the tokens of a text begin, in code points."""

    def __init__(self, text: str):
        self.length = len(text)
        self.containers, self.high, sizes = [], [], []
        letter_before = False
        for low in range(0, len(text), CHUNK):
            codes = np.frombuffer(text[low : low + CHUNK].encode("utf-32-le", "surrogatepass"), "<u4")
            letter = ((codes | 32) - np.uint32(97)) < 26
            begins = ~letter
            begins[0] |= not letter_before
            begins[1:] |= ~letter[:-1]
            letter_before = bool(letter[-1])
            places = np.flatnonzero(begins)
            if len(places):
                self.containers.append(container(places))
                self.high.append(low)
                sizes.append(len(places))
        self.before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64)

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, i: int) -> int:
        """The place of token ``i``; the end of the text for the number of tokens."""
        if i >= len(self):
            return self.length
        at = int(np.searchsorted(self.before, i, side="right")) - 1
        return self.high[at] + self.containers[at].select(i - int(self.before[at]))


def _cut(marks: tuple[str, str, str], plain_share: int, spm_share: int):
    prefix, suffix, middle = marks

    def work(rows):
        for batch in batches(rows, SLICE, "text"):
            out = {"output": [], "form": [], "n": [], "prefix_chars": [], "middle_chars": []}
            draws = (batch[h].to_pylist() for h in ("h1", "h2", "h3", "h4"))
            for text, h1, h2, h3, h4 in zip(batch["text"].to_pylist(), *draws, strict=True):
                bounds = BoundarySet(text)
                n = len(bounds)
                if not text or any(m in text for m in marks) or h3 % 100 >= 100 - plain_share:
                    made = (text, "plain", n, None, None)
                else:
                    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
                    x, y = bounds.select(a), bounds.select(b)
                    p, m, s = text[:x], text[x:y], text[y:]
                    spm = h4 % 100 < spm_share
                    whole = f"{suffix}{s}{prefix}{p}{middle}{m}" if spm else f"{prefix}{p}{suffix}{s}{middle}{m}"
                    made = (whole, "spm" if spm else "psm", n, x, y - x)
                for column, value in zip(out.values(), made, strict=True):
                    column.append(value)
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch["id"], *(pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True))], names=["id", *out])

    return work


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = "1", plain_share: int = 10, spm_share: int = 20, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)
) -> DataFrame:
    """(key, output, form, n, prefix_chars, middle_chars) of every row of ``docs``.

    ``n`` is the number of tokens. ``form`` is psm (prefix, suffix, middle), spm
    (suffix, prefix, middle) or plain: ``plain_share`` per cent of the texts, all
    empty ones and all that hold one of the ``marks``, which stay as they are
    and have null lengths. A null text is empty; a null key draws as an empty
    one; repeated rows give equal results; an empty table gives no rows; texts
    of any length are cut whole, a chunk of code points at a time. Other columns
    of ``docs`` are ignored, whatever their names.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *draws)
    kind = docs.schema[key].dataType.simpleString()
    out = rows.mapInArrow(_cut(marks, plain_share, spm_share), f"id {kind}, output string, form string, n long, prefix_chars long, middle_chars long")
    return out.withColumnRenamed("id", key)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that ``fill_in_middle`` was given: no mark can begin inside another, so each is the first of its kind."""
    prefix, suffix, middle = (F.locate(m, output) for m in marks)
    p, s, m = (F.lit(len(x)) for x in marks)
    end = F.length(output) + 1
    part = lambda begin, stop: F.substring(output, begin, stop - begin)
    last = part(middle + m, end)
    psm = F.concat(part(prefix + p, suffix), last, part(suffix + s, middle))
    spm = F.concat(part(prefix + p, middle), last, part(suffix + s, prefix))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """Digest columns of ``fill_in_middle`` over ``documents``, and of the texts restored from its outputs."""
    made = fill_in_middle(read_table(spark, sf_dir, "documents"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256")
    )


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
t AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS ts, CAST('0x' || h[1:8] AS UBIGINT) AS h1, CAST('0x' || h[9:16] AS UBIGINT) AS h2,
  CAST('0x' || h[17:24] AS UBIGINT) AS h3, CAST('0x' || h[25:32] AS UBIGINT) AS h4 FROM d),
c AS (SELECT *, CAST(len(ts) AS BIGINT) AS n, CAST(least(h1 % (len(ts) + 1), h2 % (len(ts) + 1)) AS BIGINT) AS a, CAST(greatest(h1 % (len(ts) + 1), h2 % (len(ts) + 1)) AS BIGINT) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT *, coalesce(array_to_string(ts[1:a], ''), '') AS p, coalesce(array_to_string(ts[a + 1:b], ''), '') AS m, coalesce(array_to_string(ts[b + 1:n], ''), '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form != 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form != 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p
"""
