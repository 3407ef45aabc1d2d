"""Stateful processors for ``transformWithState``.

State per key is a few numbers (dedup, anomaly), the last values of windowed rules, or one
open snapshot. Within a
micro-batch a key's rows are put in (time, position) order here, because a
shuffle does not keep order; how many rows that can be is bounded by the
source's per-trigger limit (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``).
Across micro-batches rows count in arrival order. Batch and streaming results
are equal for input that arrives in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.anomaly import MINIMUM_SAMPLES
from ..operators.rolling import merged, quartiles, running, window_moments
from ..session import ship_with_tasks

ship_with_tasks(__name__)


def in_order(rows: Iterator[Row], time: str, position: str) -> list[Row]:
    """Nulls come first, in time and in position."""
    def place(row: Row) -> tuple:
        at, number = row[time], row[position]
        return (at is not None, at or 0, number is not None, number) if number is not None else (at is not None, at or 0, False)

    return sorted(rows, key=place)


def extended(row: Row, name: str, value: Any) -> Row:
    return Row(*row.__fields__, name)(*row, value)


class DedupProcessor(StatefulProcessor):
    """Adds a boolean: is the row the first of its key within the limit. Holds
    the time of the last accepted row; an event-time timer drops it."""

    def __init__(self, time: str, position: str, live: str, ttl_ms: int) -> None:
        self.time, self.position, self.live, self.ttl_ms = time, position, live, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_accepted", "t bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        stored = self.last.get()
        last = before = stored[0] if stored else None
        for row in in_order(rows, self.time, self.position):
            accepted = False
            if row[self.live]:
                at = row[self.time] or 0
                accepted = last is None or at - last >= self.ttl_ms
                last = at if accepted else last
            yield extended(row, "_accepted", accepted)
        if last is not None and last != before:
            self.last.update((last,))
            if before is not None:
                self.handle.deleteTimer(before + self.ttl_ms)
            self.handle.registerTimer(last + self.ttl_ms)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


class AnomalyProcessor(StatefulProcessor):
    """Adds one flag per rule. Holds count, mean and squared deviations per rule without a
    window, and for rules with one their last values: a list per rule to which a micro-batch
    only adds, until it is twice as long as the window and is cut. The rows of a micro-batch
    go through the kernel that tables use, rule by rule. ``expire_ms`` after a key's newest row,
    in event time, its state goes; without it state stays."""

    def __init__(self, time: str, position: str, live: str, values: str, rules: list[dict[str, Any]], expire_ms: int | None = None) -> None:
        self.time, self.position, self.live, self.values, self.rules = time, position, live, values, rules
        self.expire_ms = expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.moments = handle.getMapState("moments_of_rule", "rule int", "n double, mean double, squares double")
        self.recent = [handle.getListState(f"recent_{i}", "value double") if rule["rows"] else None for i, rule in enumerate(self.rules)]
        self.due = handle.getValueState("expires", "at bigint") if self.expire_ms else None

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        ordered = in_order(rows, self.time, self.position)
        flags = np.zeros((len(ordered), len(self.rules)), bool)
        live = np.array([bool(row[self.live]) for row in ordered])
        for i, rule in enumerate(self.rules):
            found = [(k, row[self.values][i]) for k, row in enumerate(ordered) if live[k] and row[self.values][i] is not None]
            if not found:
                continue
            at, values = np.array([k for k, _ in found]), np.array([v for _, v in found], float)
            outside = self._windowed(i, rule, values) if rule["rows"] else self._cumulative(i, rule, values)
            flags[at, i] = outside
            if rule["suppress"]:
                live[at[outside]] = False
        if self.due is not None:
            self._postpone(max((row[self.time] or 0) for row in ordered))
        for row, own in zip(ordered, flags.tolist()):
            yield extended(row, "_flags", own)

    def _windowed(self, i: int, rule: dict[str, Any], values: np.ndarray) -> np.ndarray:
        width, exact = rule["rows"], rule["method"] == "IQR_EXACT"
        before = np.array([r[0] for r in self.recent[i].get()], float)
        stats = (quartiles if exact else window_moments)(before, values, width)
        if len(before) + len(values) > 2 * width:
            self.recent[i].put([(float(v),) for v in np.concatenate([before, values])[-width:]])
        else:
            self.recent[i].appendList([(float(v),) for v in values])
        return is_outside(rule, values, *stats)

    def _cumulative(self, i: int, rule: dict[str, Any], values: np.ndarray) -> np.ndarray:
        stored = self.moments.getValue((i,)) if self.moments.containsKey((i,)) else (0.0, 0.0, 0.0)
        own = [np.append(0.0, part[0]) for part in running(values[None, :])]
        n, mean, squares = merged(tuple(np.full(len(values) + 1, x) for x in stored), tuple(own))
        self.moments.updateValue((i,), (float(n[-1]), float(mean[-1]), float(squares[-1])))
        return is_outside(rule, values, n[:-1], mean[:-1], squares[:-1])

    def _postpone(self, newest: int) -> None:
        stored = self.due.get()
        at = newest + self.expire_ms
        if stored is None or at > stored[0]:
            if stored is not None:
                self.handle.deleteTimer(stored[0])
            self.due.update((at,))
            self.handle.registerTimer(at)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        for state in (self.moments, self.due, *filter(None, self.recent)):
            state.clear()
        return iter(())

    def close(self) -> None:
        pass


def is_outside(rule: dict[str, Any], value: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The verdicts from the statistics before each value: moments, or both quartiles."""
    with np.errstate(invalid="ignore", divide="ignore"):
        if rule["method"] == "THRESHOLD":
            hit = value < rule["threshold"]
        elif rule["method"] == "IQR_EXACT":
            margin = rule["threshold"] * (b - a)
            hit = (value < a - margin) | (value > b + margin)
        else:
            deviation = np.sqrt(b / np.maximum(n - 1, 1))
            hit = (deviation > 0) & (np.abs(value - a) > rule["threshold"] * deviation)
    return (n >= MINIMUM_SAMPLES) & ~np.isnan(value) & hit


class SnapshotProcessor(StatefulProcessor):
    """Merges a scan's events; emits on completion or when the time is up.

    ``event_time``: the limit counts in event time, and an event at or after it
    starts a new snapshot even if the timer has not fired yet. Otherwise it
    counts in processing time from the first arrival. ``stamped`` adds the time
    at which a snapshot closed (its completion, or its timer's time, which no
    watermark has passed when it is emitted) as event time, for a windowed
    aggregation to follow."""

    STATE = (
        "customerId string, scores map<string,double>, extras map<string,string>, concerns array<string>, "
        "first bigint, last bigint, events bigint, timer bigint"
    )

    def __init__(self, time: str, position: str, stream: str, completion: str, scores: list[tuple[str, str]],
                 timeout_ms: int, event_time: bool = True, stamped: bool = False) -> None:
        self.stamped = stamped
        self.time, self.position, self.stream, self.completion = time, position, stream, completion
        self.scores, self.timeout_ms, self.event_time = scores, timeout_ms, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("snapshot", self.STATE)

    def _read(self) -> dict[str, Any] | None:
        stored = self.open.get()
        if not stored:
            return None
        customer, scores, extras, concerns, first, last, events, timer = stored
        return {
            "customerId": customer, "scores": dict(scores or {}), "extras": dict(extras or {}), "concerns": concerns,
            "first": first, "last": last, "events": events, "timer": timer,
        }

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        state = self._read()
        armed = state["timer"] if state else None
        for row in in_order(rows, self.time, self.position):
            at = row[self.time] or 0
            if state and self.event_time and at >= state["first"] + self.timeout_ms:
                yield self._emit(key, state, complete=False, at=state["timer"])
                state = None
            if state is None:
                now = at if self.event_time else timerValues.getCurrentProcessingTimeInMs()
                state = {
                    "customerId": None, "scores": {}, "extras": {}, "concerns": None,
                    "first": at, "last": at, "events": 0, "timer": now + self.timeout_ms,
                }
            self._merge(state, row, at)
            if row[self.stream] == self.completion:
                yield self._emit(key, state, complete=True, at=at)
                state = None
        self._store(state, armed)

    def _merge(self, state: dict[str, Any], row: Row, at: int) -> None:
        state["customerId"] = state["customerId"] or row["customerId"]
        state["last"], state["events"] = max(state["last"], at), state["events"] + 1
        for name, column in self.scores:
            if row[column] is not None:
                state["scores"][name] = float(row[column])
        if row["_tone"] is not None:
            state["extras"]["skinToneLabel"] = row["_tone"]
        if row["_concerns"] is not None:
            state["concerns"] = list(row["_concerns"])
            state["extras"]["topConcerns"] = "[" + ", ".join(row["_concerns"]) + "]"

    def _store(self, state: dict[str, Any] | None, armed: int | None) -> None:
        timer = state["timer"] if state else None
        if armed is not None and armed != timer:
            self.handle.deleteTimer(armed)
        if state is None:
            if armed is not None:
                self.open.clear()
            return
        self.open.update(tuple(state.values()))
        if armed != timer:
            self.handle.registerTimer(timer)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        state = self._read()
        if state is not None:
            yield self._emit(key, state, complete=False, at=state["timer"])
            self.open.clear()

    def _emit(self, key: Any, state: dict[str, Any], complete: bool, at: int) -> Row:
        stamp = {"closedTs": pd.Timestamp(at, unit="ms", tz="UTC")} if self.stamped else {}
        return Row(
            customerId=state["customerId"], scanId=key[0], eventTimeMs=state["last"], firstEventMs=state["first"],
            events=state["events"], scores=state["scores"], extras=state["extras"], topConcerns=state["concerns"],
            complete=complete, emittedAtMs=at, **stamp,
        )

    def close(self) -> None:
        pass
