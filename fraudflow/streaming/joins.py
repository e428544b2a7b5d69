"""As-of join of two streams (E6) and the alert budget of a stream."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fraudflow.functions.columns import HOUR_US


#: Rows of a key that wait in one value; more wait in an entry for each hour.
INLINE = 512


class AsOf(StatefulProcessor):
    """Holds the rows of a key until the watermark has passed their hour, and then finds the version in force at each.

    Few rows wait in one value; of a key with more, an hour is an entry of its
    own, so a batch reads and writes the hours of its rows only. Of all hours
    that are done one version is kept. A key has one timer, for its first hour.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "held string")
        self.hours = handle.getMapState("hours", "hour long", "held string")

    def _opened(self) -> dict:
        found = self.head.get() if self.head.exists() else None
        return json.loads(found[0]) if found else {"inline": [], "stored": [], "last": None, "timer": None}

    def _add(self, head: dict, rows: list) -> None:
        by_hour: dict[int, list] = {}
        for row in rows:
            by_hour.setdefault(row[0] // HOUR_US, []).append(row)
        for hour, own in by_hour.items():
            had = json.loads(self.hours.getValue((hour,))[0]) if hour in head["stored"] else []
            self.hours.updateValue((hour,), (json.dumps(had + own),))
        head["stored"] = sorted({*head["stored"], *by_hour})

    def _closed(self, head: dict) -> None:
        if len(head["inline"]) > INLINE:
            self._add(head, head["inline"])
            head["inline"] = []
        open_hours = [*head["stored"][:1], *(row[0] // HOUR_US for row in head["inline"])]
        timer = (min(open_hours) + 1) * (HOUR_US // 1000) if open_hours else None
        if timer != head["timer"]:
            if head["timer"] is not None:
                self.handle.deleteTimer(head["timer"])
            if timer is not None:
                self.handle.registerTimer(timer)
            head["timer"] = timer
        self.head.update((json.dumps(head),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        head = self._opened()
        stored = set(head["stored"])
        for new in rows:
            made = list(zip(new["us"].tolist(), new["side"].tolist(), new["row"].tolist(), strict=True))
            head["inline"] += [r for r in made if r[0] // HOUR_US not in stored]
            self._add(head, [r for r in made if r[0] // HOUR_US in stored])
        self._closed(head)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        head = self._opened()
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        done = lambda us: (us // HOUR_US + 1) * HOUR_US <= upto
        ready = [tuple(r) for r in head["inline"] if done(r[0])]
        head["inline"] = [r for r in head["inline"] if not done(r[0])]
        for hour in [h for h in head["stored"] if done(h * HOUR_US)]:
            ready += map(tuple, json.loads(self.hours.getValue((hour,))[0]))
            self.hours.removeKey((hour,))
            head["stored"].remove(hour)
        out = []
        for _, side, row in sorted(ready):  # a version comes before the rows of its instant
            if side == 0:
                head["last"] = row
            else:
                out.append((row, head["last"]))
        head["timer"] = None
        self._closed(head)
        yield pd.DataFrame(out, columns=["row", "found"])

    def close(self) -> None:
        pass


def asof_stream(left: DataFrame, right: DataFrame, by: str, left_us: str, right_us: str, values: list[str], delay: str = "2 days") -> DataFrame:
    """``asof`` of two streams: each left row once with the ``values`` of the latest right row at or before it.

    A left row comes out when the watermark has passed its hour, so versions that
    come later than the row, but within ``delay``, still count. Of versions of
    one instant the greatest (as JSON) is taken. A null key is a key like any
    other. Rows without a time are dropped; columns may be of any type that JSON
    keeps.
    """
    packed = lambda df, names: F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    side = lambda df, us, n, row: df.where(F.col(us).isNotNull()).select(F.col(by).alias("by"), F.col(us).alias("us"), F.lit(n).alias("side"), row.alias("row"))
    both = side(left, left_us, 1, packed(left, left.columns)).unionByName(side(right, right_us, 0, packed(right, values)))
    held = both.withColumn("ts", F.timestamp_micros("us")).withWatermark("ts", delay).groupBy("by")
    out = held.transformWithStateInPandas(AsOf(), "row string, found string", "append", "EventTime")
    found = T.StructType([right.schema[v] for v in values])
    return out.select(F.from_json("row", left.schema).alias("l"), F.from_json("found", found).alias("r")).select("l.*", *(F.col(f"r.{v}").alias(f"asof_{v}") for v in values))


class TopK(StatefulProcessor):
    """The ``k`` best rows of a group as a heap; tells what enters, and with ``both`` what leaves for it, before it does."""

    def __init__(self, k: int, both: bool):
        self.k, self.both = k, both

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.heap = handle.getValueState("heap", "held string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = [tuple(x) for x in json.loads(self.heap.get()[0])] if self.heap.exists() else []
        new = pd.concat(list(rows), ignore_index=True)
        before, out = set(held), []
        # the worst of the heap is its root: the least score, and of those the greatest id
        best = heapq.nlargest(self.k, [*held, *((s, -t) for s, t in zip(new["score"].tolist(), new["txn_id"].tolist(), strict=True))])
        left = sorted(before - set(best))
        for row in sorted(set(best) - before, reverse=True):
            if self.both and left and len(held) >= self.k:
                out.append((*left.pop(0), "drop"))
            else:
                held.append(row)
            out.append((*row, "add"))
        self.heap.update((json.dumps(best),))
        if out:
            yield pd.DataFrame({"event_date": [key[0]] * len(out), "txn_id": [-t for _, t, _ in out], "score": [s for s, _, _ in out], "action": [a for *_, a in out], "turn": range(len(out))})
        else:
            yield pd.DataFrame()

    def close(self) -> None:
        pass


def _best(k: int):
    """The rows of each record batch that are among its ``k`` best of their day; no other can be among those of the day."""

    def work(batches):
        for batch in batches:
            day = batch["event_date"].cast(pa.int32()).fill_null(-(1 << 31)).to_numpy(zero_copy_only=False)
            order = np.lexsort((batch["txn_id"].to_numpy(zero_copy_only=False), -batch["score"].to_numpy(zero_copy_only=False), day))
            first = np.flatnonzero(np.diff(day[order], prepend=day[order[:1]] - 1))
            sizes = np.diff(first, append=len(order))
            yield batch.take(pa.array(order[np.arange(len(order)) - np.repeat(first, sizes) < k]))

    return work


def alert_stream(scored: DataFrame, k: int = 10, parts: int = 16, column: str = "score") -> DataFrame:
    """(event_date, txn_id, score, action, turn) of a stream: alerts as they come, at most ``k`` of a day in force.

    An alert is ``add``ed when its score is among the day's ``k`` highest so far,
    and ``drop``ped when a higher one takes its place; those in force when all is
    read are ``top_alerts``. Rows that are not among the ``k`` best of their day
    in their own record batch go no further; a day's others are spread over ``parts`` heaps first,
    so only what enters one of them meets the heap of the day. ``turn`` is the
    order of a day's actions within a batch. Ids are unique, as after
    deduplication; rows without a score are never alerts.
    """
    schema = f"event_date date, txn_id long, score {scored.schema[column].dataType.simpleString()}, action string, turn long"
    rows = scored.where(F.col(column).isNotNull()).select("event_date", "txn_id", F.col(column).alias("score"), F.pmod(F.xxhash64("txn_id"), F.lit(parts)).alias("part"))
    rows = rows.mapInArrow(_best(k), rows.schema)
    near = rows.groupBy("event_date", "part").transformWithStateInPandas(TopK(k, False), schema, "append", "None")
    return near.select("event_date", "txn_id", "score").groupBy("event_date").transformWithStateInPandas(TopK(k, True), schema, "append", "None")


def in_force(actions: DataFrame) -> DataFrame:
    """(event_date, txn_id, score) of the alerts that were added and not dropped."""
    turn = F.sum(F.when(F.col("action") == "add", 1).otherwise(-1))
    return actions.groupBy("event_date", "txn_id", "score").agg(turn.alias("n")).where("n > 0").drop("n")
