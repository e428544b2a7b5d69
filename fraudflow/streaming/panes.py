"""Exact rolling features of each event of a stream (R1, R2, R5 to R8, R13), from state cut into panes of time.

A card's trailing rows lie in panes, an eighth of the longest window each. The
totals of all panes are one small value. The rows of a card with few of them are
in that value too, so a batch reads and writes it once. Beyond ``INLINE`` rows a
pane is an entry of its own, packed, and a batch reads and writes those panes
only in which its events and the beginnings of their windows lie; between those
two a window is made of totals. So a card with very many rows never has its
whole state in memory.

The features of a card whose rows are all beside the totals are made by numpy
over all its new rows at once. What a card gives crosses to Spark as one packed
row, and ``_unpacked`` makes columns of many cards at once: a frame of its own
for each card costs far more than its features. The new rows come packed as
well, some thousands of a card in one row (``_gathered``), for Spark hands rows
to a card one value at a time.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fraudflow.functions.columns import HOUR_US

#: Rows of a card that lie beside the totals; more go to entries of their own.
INLINE = 512
#: Rows and categories of a card up to which its features are made at once.
AT_ONCE, KINDS_AT_ONCE = 1 << 16, 64
#: Rows of a card in one packed row.
PACKED = 4096
#: Rows that a task gathers before it packs them by card.
GATHERED = 1 << 18
_FAR = (1 << 63) - 1
#: Stands for a null time or id.
_NULL = -(1 << 62)


def _extremes(values: np.ndarray, start: np.ndarray, stop: np.ndarray, pick, none: int) -> np.ndarray:
    """The least or largest of each range of ``values``, from ranges whose lengths are powers of two."""
    out, n, width = np.full(len(start), none), stop - start, 1
    longest = int(n.max(initial=0))
    while width <= longest:
        own = np.flatnonzero((n >= width) & (n < 2 * width))
        out[own] = pick(values[start[own]], values[stop[own] - width])
        if 2 * width <= longest:
            values = pick(values[:-width], values[width:])
        width *= 2
    return out


class Pane:
    """The rows of a pane in order of time and id, with sums and extremes from either end."""

    def __init__(self, held: np.ndarray):
        self.held = held  # time, id, amount, whether it is known, category
        self.us, self.ids, self.kinds = held[0].tolist(), held[1].tolist(), held[4].tolist()
        amount, known = held[2], held[3].astype(bool)
        self.known = [0, *np.cumsum(known).tolist()]
        self.sums = [0, *np.cumsum(np.where(known, amount, 0)).tolist()]
        low, high = np.where(known, amount, _FAR), np.where(known, amount, -_FAR)
        self.low_before, self.high_before = [_FAR, *np.minimum.accumulate(low).tolist()], [-_FAR, *np.maximum.accumulate(high).tolist()]
        self.low_from, self.high_from = [*np.minimum.accumulate(low[::-1])[::-1].tolist(), _FAR], [*np.maximum.accumulate(high[::-1])[::-1].tolist(), -_FAR]
        self.first, self.last = {}, {}
        for i, kind in enumerate(self.kinds):
            self.first.setdefault(kind, i)
            self.last[kind] = i

    @classmethod
    def of(cls, packed: bytes) -> Pane:
        return cls(np.frombuffer(packed, np.int64).reshape(5, -1))

    def with_rows(self, new: np.ndarray) -> Pane:
        both = np.concatenate([self.held, new], axis=1)
        return Pane(both[:, np.lexsort((both[1], both[0]))])

    def totals(self) -> list:
        """Rows, rows with an amount, sum, least, largest, last time, categories."""
        return [len(self.us), self.known[-1], self.sums[-1], self.low_before[-1], self.high_before[-1], self.us[-1], sorted(self.last)]

    def place(self, us: int, txn: int) -> int:
        i = bisect_left(self.us, us)
        while i < len(self.us) and self.us[i] == us and self.ids[i] < txn:
            i += 1
        return i


class CardFeatures(StatefulProcessor):
    """Features of a card's events from what was known when their batch was processed.

    Late rows enter the panes and change later rows only. A row without an
    amount counts but adds nothing, as in batch; a null category is none of the
    distinct ones. Events of a card have different (event_us, txn_id), as after
    deduplication. Panes older than the longest window before the card's last
    event are dropped; with ``expires`` an event-time timer drops all of them
    once the watermark is past that window. What the gap, the last rows and the
    first of each category need is kept, so no result changes.
    """

    def __init__(self, hours: tuple[int, ...], last_n: int = 10, panes: int = 8, expires: bool = False):
        self.hours = hours
        self.span = max(hours) * HOUR_US
        self.size = self.span // panes
        self.last_n = last_n
        self.expires = expires

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "held string")
        self.rows = handle.getMapState("rows", "pane long", "held binary")

    def _loaded(self) -> None:
        """What is in the value of the card, its rows still in one array."""
        found = self.head.get()
        known = json.loads(found[0]) if found else {"panes": [], "before": None, "tail": [], "kinds": [], "firsts": [], "timer": None, "inline": [[]] * 5, "stored": []}
        self.totals = {p: t for p, t in known["panes"]}
        self.before, self.tail, self.kinds, self.timer = known["before"], known["tail"], known["kinds"], known["timer"]
        self.firsts = {k: tuple(v) for k, v in known["firsts"]}
        self.flat, self.held = np.array(known["inline"], np.int64), {}
        self.stored = set(known["stored"])

    def _opened(self) -> None:
        """The same, with its rows in panes."""
        self._loaded()
        self._cut()

    def _cut(self) -> set[int]:
        """Panes from the rows in one array; tells which."""
        numbers = self.flat[0] // self.size
        found = set(np.unique(numbers).tolist())
        for p in found:
            self.held[p] = Pane(self.flat[:, numbers == p])
            self.totals[p] = self.held[p].totals()
        self.flat = self.flat[:, :0]
        return found

    def _closed(self, touched: set[int]) -> None:
        """Writes the head, and the entries of those panes that changed or are too much for it."""
        inline = sorted(p for p in self.totals if p not in self.stored)
        if sum(self.totals[p][0] for p in inline) > INLINE:
            self.stored |= set(inline)
            touched, inline = touched | set(inline), []
        for p in touched & self.stored:
            self.rows.updateValue((p,), (self.held[p].held.tobytes(),))
        self._write(np.concatenate([self.flat, *(self.held[p].held for p in inline)], axis=1))
        self.held = {}

    def _write(self, inline: np.ndarray) -> None:
        panes = sorted((p, t) for p, t in self.totals.items() if p in self.stored)
        self.head.update((json.dumps({"panes": panes, "before": self.before, "tail": self.tail, "kinds": self.kinds, "firsts": sorted(self.firsts.items()), "timer": self.timer, "inline": inline.tolist(), "stored": sorted(self.stored)}),))

    def _pane(self, number: int) -> Pane:
        if number not in self.held:
            self.held[number] = Pane.of(bytes(self.rows.getValue((number,))[0]))
        return self.held[number]

    def _drop(self, number: int) -> None:
        """Forgets a pane but for its last rows."""
        pane = self._pane(number)
        self.before = pane.us[-1] if self.before is None else max(self.before, pane.us[-1])
        rows = [[u, i, a if k else None] for u, i, a, k in pane.held[:4, -self.last_n :].T.tolist()]
        self.tail = sorted(self.tail + rows, key=lambda r: r[:2])[-self.last_n :]
        if number in self.stored:
            self.rows.removeKey((number,))
            self.stored.discard(number)
        del self.totals[number], self.held[number]

    def _last_amounts(self, number: int, place: int, order: list[int]) -> tuple[int, int]:
        """How many of the last rows before a place have an amount, and their sum."""
        left, known, total = self.last_n, 0, 0
        for p in [number, *reversed(order[: bisect_left(order, number)])]:
            pane = self._pane(p)
            stop = place if p == number else len(pane.us)
            start = max(0, stop - left)
            known, total = known + pane.known[stop] - pane.known[start], total + pane.sums[stop] - pane.sums[start]
            left -= stop - start
            if not left:
                return known, total
        pane = self._pane(number)
        at = [pane.us[place], pane.ids[place]] if place < len(pane.us) else [_FAR, _FAR]
        more = [a for *key, a in self.tail if key < at][-left:]
        return known + sum(a is not None for a in more), total + sum(a or 0 for a in more)

    def _window(self, low: int, number: int, place: int, order: list[int]) -> tuple:
        """Rows, known amounts, sum, least, largest and categories from ``low`` to a place."""
        first, pane = low // self.size, self._pane(number)
        if first >= number:
            start = bisect_left(pane.us, low)
            n, known, total = place - start, pane.known[place] - pane.known[start], pane.sums[place] - pane.sums[start]
            amounts = [a for a, k in pane.held[2:4, start:place].T.tolist() if k]
            return n, known, total, min(amounts, default=_FAR), max(amounts, default=-_FAR), set(pane.kinds[start:place])
        n, known, total, least, most = place, pane.known[place], pane.sums[place], pane.low_before[place], pane.high_before[place]
        kinds = {k for k, at in pane.first.items() if at < place}
        if first in self.totals:
            edge = self._pane(first)
            start = bisect_left(edge.us, low)
            n, known, total = n + len(edge.us) - start, known + edge.known[-1] - edge.known[start], total + edge.sums[-1] - edge.sums[start]
            least, most = min(least, edge.low_from[start]), max(most, edge.high_from[start])
            kinds |= {k for k, at in edge.last.items() if at >= start}
        for p in order[bisect_left(order, first + 1) : bisect_left(order, number)]:
            own = self.totals[p]
            n, known, total, least, most = n + own[0], known + own[1], total + own[2], min(least, own[3]), max(most, own[4])
            kinds |= set(own[6])
        return n, known, total, least, most, kinds

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        known = new["amount_cents"].notna()
        packed = np.stack([new["event_us"].fillna(_NULL), new["txn_id"].fillna(_NULL), new["amount_cents"].fillna(0), known]).astype(np.int64)
        yield self._frame(key, *self.taken(packed, [None if pd.isna(c) else str(c) for c in new["category"]]))

    def _frame(self, key, new: np.ndarray, made: list[tuple]) -> pd.DataFrame:
        whole = lambda values, missing: pd.arrays.IntegerArray(values.astype(np.int64), missing)
        out = pd.DataFrame({
            "txn_id": whole(new[1], new[1] == _NULL), "card_id": key[0], "event_us": whole(new[0], new[0] == _NULL),
            "category": [self.kinds[c] if c >= 0 else None for c in new[4].tolist()], "amount_cents": whole(new[2], new[3] == 0),
        })
        for (name, kind), (values, missing) in zip(_columns(self.hours, self.last_n), made, strict=True):
            out[name] = whole(values, missing) if kind == "long" else np.where(missing, np.nan, values) if kind == "double" else values
        return out

    def taken(self, packed: np.ndarray, names: list[str | None]) -> tuple[np.ndarray, list[tuple]]:
        """New rows (time, id, amount, whether it is known, category), in order, and their features: values and where there is none."""
        self._loaded()
        order = np.lexsort((packed[1], packed[0]))
        names = [names[i] for i in order.tolist()]
        kind_of = {k: i for i, k in enumerate(self.kinds)}
        codes = [-1 if c is None else kind_of.setdefault(c, len(kind_of)) for c in names]
        self.kinds = list(kind_of)
        new = np.concatenate([packed[:, order], np.array([codes], np.int64)])
        kinds, first, kind = np.unique(new[4], return_index=True, return_inverse=True)
        for k, us, txn in zip(kinds.tolist(), *new[:2, first].tolist(), strict=True):
            self.firsts[k] = min(self.firsts.get(k, (us, txn)), (us, txn))
        if not self.stored and self.flat.shape[1] + new.shape[1] <= AT_ONCE and len(self.kinds) <= KINDS_AT_ONCE:
            made, newest, touched = self._at_once(new)
        else:
            made, newest, touched = self._by_panes(new)
        firsts = np.array([self.firsts[k] for k in kinds.tolist()], np.int64)[kind]
        made.append(((firsts[:, 0] == new[0]) & (firsts[:, 1] == new[1]), np.zeros(len(kind), bool)))
        if self.expires:
            timer = (newest + self.span) // 1000 + 1
            if timer != self.timer:
                if self.timer is not None:
                    self.handle.deleteTimer(self.timer)
                self.handle.registerTimer(timer)
                self.timer = timer
        if touched is None:
            self._write(self.flat)
        else:
            self._closed(touched)
        return new, made

    def _at_once(self, new: np.ndarray) -> tuple[list[tuple], int, set[int] | None]:
        """Features of all new rows of a card whose rows are in one array; the panes to write if it outgrows that."""
        both = np.concatenate([self.flat, new], axis=1)
        order = np.lexsort((both[1], both[0]))
        both = both[:, order]
        us, ids, amount, known, codes = both
        n = len(us)
        fresh = np.ones(n, bool)
        fresh[1:] = (us[1:] != us[:-1]) | (ids[1:] != ids[:-1])
        place = np.empty(n, np.int64)
        place[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        place = place[n - new.shape[1] :]
        at = new[0]
        stop, start = np.searchsorted(us, at), np.searchsorted(us, at - self.span)
        some = known != 0
        knowns, sums = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        np.cumsum(some, out=knowns[1:])
        np.cumsum(np.where(some, amount, 0), out=sums[1:])
        never = np.zeros(len(at), bool)
        made = [(stop - np.searchsorted(us, at - h * HOUR_US), never) for h in self.hours]
        in_window, total = knowns[stop] - knowns[start], sums[stop] - sums[start]
        none = in_window == 0
        least = _extremes(np.where(some, amount, _FAR), start, stop, np.minimum, _FAR)
        most = _extremes(np.where(some, amount, -_FAR), start, stop, np.maximum, -_FAR)
        made += [(total, none), (total / np.maximum(in_window, 1), none), (least, none), (most, none)]
        cold = place == 0
        previous = np.where(cold, 0 if self.before is None else self.before, us[place - 1])
        made.append((at - previous, (cold if self.before is None else never) | (previous > at)))
        kinds, seen = np.zeros(len(at), np.int64), np.zeros(n + 1, np.int64)
        for k in range(len(self.kinds)):
            np.cumsum(codes == k, out=seen[1:])
            kinds += seen[stop] > seen[start]
        made.append((kinds, never))
        low = np.maximum(place - self.last_n, 0)
        recent, recent_sum = knowns[place] - knowns[low], sums[place] - sums[low]
        for i in np.flatnonzero(place < self.last_n).tolist() if self.tail else []:
            key = [int(at[i]), int(new[1, i])]
            more = [a for *k, a in self.tail if k < key][-(self.last_n - int(place[i])) :]
            recent[i] += sum(a is not None for a in more)
            recent_sum[i] += sum(a or 0 for a in more)
        made.append((recent_sum / np.maximum(recent, 1), recent == 0))
        newest = int(us[-1])
        gone = int(np.searchsorted(us, (newest - self.span) // self.size * self.size))
        if gone:
            self.before = max(int(us[gone - 1]), int(us[gone - 1]) if self.before is None else self.before)
            rows = [[u, i, a if k else None] for u, i, a, k in both[:4, max(0, gone - self.last_n) : gone].T.tolist()]
            self.tail = sorted(self.tail + rows, key=lambda r: r[:2])[-self.last_n :]
        self.flat = both[:, gone:]
        return made, newest, self._cut() if n - gone > INLINE else None

    def _by_panes(self, new: np.ndarray) -> tuple[list[tuple], int, set[int]]:
        """Features of the new rows of a card with many, from the panes that they touch, which are to be written."""
        self._cut()
        numbers = new[0] // self.size
        for p in np.unique(numbers).tolist():
            own = new[:, numbers == p]
            pane = self._pane(p).with_rows(own) if p in self.totals else Pane(own)
            self.held[p], self.totals[p] = pane, pane.totals()
        order = sorted(self.totals)
        rows = [self._features(us, txn, order) for us, txn in new[:2].T.tolist()]
        touched = set(numbers.tolist())
        newest = max(t[5] for t in self.totals.values())
        for p in order:
            if (p + 1) * self.size <= newest - self.span:
                self._drop(p)
                touched.discard(p)
        made = []
        for (_, kind), values in zip(_columns(self.hours, self.last_n), zip(*rows, strict=True), strict=False):
            missing = np.array([v is None for v in values])
            made.append((np.array([0 if v is None else v for v in values], float if kind == "double" else np.int64), missing))
        return made, newest, touched

    def _features(self, us: int, txn: int, order: list[int]) -> list:
        number = us // self.size
        pane = self._pane(number)
        place, start = pane.place(us, txn), bisect_left(pane.us, us)
        counts = [self._window(us - h * HOUR_US, number, start, order)[0] for h in self.hours if h * HOUR_US != self.span]
        n, known, total, least, most, kinds = self._window(us - self.span, number, start, order)
        counts.insert(self.hours.index(self.span // HOUR_US), n)
        if place:
            previous = pane.us[place - 1]
        else:
            earlier = order[: bisect_left(order, number)]
            previous = self.totals[earlier[-1]][5] if earlier else self.before
        recent, recent_sum = self._last_amounts(number, place, order)
        amounts = [total, total / known, least, most] if known else [None] * 4
        return [
            *counts, *amounts, us - previous if previous is not None and previous <= us else None, len(kinds - {-1}),
            recent_sum / recent if recent else None,
        ]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._opened()
        for p in sorted(self.totals):
            self._drop(p)
        self.timer = None
        self._closed(set())
        yield pd.DataFrame()

    def close(self) -> None:
        pass


def _columns(hours: tuple[int, ...], last_n: int) -> list[tuple[str, str]]:
    h = max(hours)
    counts = [(f"cnt_{x}h", "long") for x in hours]
    return [*counts, (f"sum_{h}h", "long"), (f"avg_{h}h", "double"), (f"min_{h}h", "long"), (f"max_{h}h", "long"), ("gap_us", "long"), (f"categories_{h}h", "long"), (f"avg_last_{last_n}", "double"), ("is_first_in_category", "boolean")]


class Packed(StatefulProcessor):
    """A ``CardFeatures`` that gives packed rows: the new rows with their features as one matrix, and the names of the categories."""

    def __init__(self, cards: CardFeatures):
        self.cards = cards

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cards.init(handle)

    def _rows(self, card, new: np.ndarray, made: list[tuple], kinds: list[str]) -> Iterator[Row]:
        flags = np.zeros(new.shape[1], np.int64)
        for i, (_, missing) in enumerate(made):
            flags |= missing.astype(np.int64) << i
        whole = [v.view(np.int64) if v.dtype == np.float64 else v.astype(np.int64) for v, _ in made]
        matrix = np.stack([*new, *whole, flags])
        for low in range(0, matrix.shape[1], PACKED):
            yield Row(card_id=card, kinds=kinds, packed=matrix[:, low : low + PACKED].tobytes())

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rows = list(rows)
        if "packed" in rows[0].__fields__:
            parts = [np.frombuffer(r.packed, np.int64).reshape(5, -1) for r in rows]
            names = [r.names[c] for r, part in zip(rows, parts, strict=True) for c in part[4].tolist()]
            new, made = self.cards.taken(np.concatenate(parts, axis=1)[:4], names)
            yield from self._rows(key[0], new, made, self.cards.kinds)
            return
        held = dict(zip(rows[0].__fields__, zip(*rows, strict=True), strict=True))
        whole = lambda name, null: [null if v is None else v for v in held[name]]
        amounts = held["amount_cents"]
        packed = np.array([whole("event_us", _NULL), whole("txn_id", _NULL), whole("amount_cents", 0), [a is not None for a in amounts]], np.int64)
        new, made = self.cards.taken(packed, list(held["category"]))
        yield from self._rows(key[0], new, made, self.cards.kinds)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        for out in self.cards.handleExpiredTimer(key, timerValues, expiredTimerInfo):
            if len(out):
                kinds = sorted(set(out["category"].dropna()))
                codes = [kinds.index(c) if c in kinds else -1 for c in out["category"]]
                own = [out["event_us"], out["txn_id"], out["amount_cents"].fillna(0), out["amount_cents"].notna(), codes]
                names = _columns(self.cards.hours, self.cards.last_n)
                made = [(out[n].fillna(0).to_numpy(float if k == "double" else np.int64), out[n].isna().to_numpy()) for n, k in names]
                yield from self._rows(key[0], np.array(own, np.int64), made, kinds)

    def close(self) -> None:
        self.cards.close()


def _gathered(batches):
    """Rows of a card in packed rows: a matrix of time, id, amount, whether it is known and place in the names of categories, which are beside it."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= GATHERED:
            yield _by_card(pa.Table.from_batches(held))
            held, n = [], 0
    if n:
        yield _by_card(pa.Table.from_batches(held))


def _by_card(rows: pa.Table) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    whole = lambda name, null: rows[name].fill_null(null).to_numpy()
    card, unknown = whole("card_id", 0), rows["card_id"].is_null().to_numpy()
    order = np.lexsort((card, unknown))
    card, unknown = card[order], unknown[order]
    n, at = len(order), np.arange(len(order))
    new = np.ones(n, bool)
    new[1:] = (card[1:] != card[:-1]) | (unknown[1:] != unknown[:-1])
    new |= (at - np.maximum.accumulate(np.where(new, at, 0))) % PACKED == 0
    part, first = np.cumsum(new) - 1, np.flatnonzero(new)
    kinds = rows["category"].combine_chunks().dictionary_encode()
    code = kinds.indices.fill_null(len(kinds.dictionary)).to_numpy().astype(np.int64)[order]  # a null's name is null
    own, place = np.unique(part * (len(kinds.dictionary) + 1) + code, return_inverse=True)
    begin = np.searchsorted(own, np.arange(len(first) + 1) * (len(kinds.dictionary) + 1))
    names = pa.concat_arrays([kinds.dictionary, pa.nulls(1, kinds.dictionary.type)]).take(pa.array(own % (len(kinds.dictionary) + 1)))
    matrix = np.stack([whole("event_us", _NULL)[order], whole("txn_id", _NULL)[order], whole("amount_cents", 0)[order], rows["amount_cents"].is_valid().to_numpy()[order], place - begin[part]]).astype(np.int64)
    packed = [matrix[:, a:b].tobytes() for a, b in zip(first, [*first[1:], n], strict=True)]
    return pa.RecordBatch.from_arrays(
        [rows["card_id"].combine_chunks().take(pa.array(order[first])), pa.array(packed, pa.binary()), pa.ListArray.from_arrays(pa.array(begin, pa.int32()), names)],
        names=["card_id", "packed", "names"],
    )


def _unpacked(columns: list[tuple[str, str]]):
    def work(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [np.frombuffer(b, np.int64).reshape(len(columns) + 6, -1) for b in batch["packed"].to_pylist()]
            row = np.repeat(np.arange(len(parts)), [p.shape[1] for p in parts])
            us, ids, amount, known, code, *values, flags = np.concatenate(parts, axis=1)
            kinds = batch["kinds"]
            begin = np.cumsum([0, *kinds.value_lengths().to_pylist()])[row]
            out = [
                pa.array(ids, mask=ids == _NULL), batch["card_id"].take(pa.array(row)), pa.array(us, mask=us == _NULL),
                kinds.flatten().take(pa.array(begin + code, mask=code < 0)), pa.array(amount, mask=known == 0),
            ]
            for i, ((_, kind), v) in enumerate(zip(columns, values, strict=True)):
                own = v.view(np.float64) if kind == "double" else v != 0 if kind == "boolean" else v
                out.append(pa.array(own, mask=(flags >> i & 1) != 0))
            yield pa.RecordBatch.from_arrays(out, names=["txn_id", "card_id", "event_us", "category", "amount_cents", *(n for n, _ in columns)])

    return work


def features_stream(stream: DataFrame, hours: tuple[int, ...] = (1, 24, 168), last_n: int = 10, expires: bool = False, late_dropped: bool = False) -> DataFrame:
    """R1, R2 and R5 to R8 for each event of a stream, named as in batch.

    Needs the RocksDB state store; ``expires`` needs a watermark on event_ts, and
    drops what is later. That is told of each row, so such rows come one by one,
    unless ``late_dropped`` says that a deduplication within the same watermark
    lies before this and has dropped them.
    """
    single = expires and not late_dropped
    columns = ["card_id", "txn_id", "event_us", "amount_cents", "category", *(["event_ts"] if single else [])]
    schema = "txn_id long, card_id long, event_us long, category string, amount_cents long, " + ", ".join(f"{n} {k}" for n, k in _columns(hours, last_n))
    rows = stream.select(*columns)
    if not single:
        rows = rows.repartition("card_id").mapInArrow(_gathered, "card_id long, packed binary, names array<string>")
    rows = rows.groupBy("card_id")
    processor = Packed(CardFeatures(hours, last_n, expires=expires))
    made = rows.transformWithState(processor, "card_id long, kinds array<string>, packed binary", "append", "EventTime" if expires else "None")
    return made.mapInArrow(_unpacked(_columns(hours, last_n)), schema)
