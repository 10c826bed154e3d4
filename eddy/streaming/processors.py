"""Keyed stateful processors for ``transformWithState``.

Each processor holds the reference's keyed state in Spark's state store
(RocksDB, checkpointed with the query) and emits rows as the reference's
functions do.  Rows of one key reach a processor unsorted within a
micro-batch, as frames; each processor orders those of its key, which the
trigger bounds, and applies them as arrays.

``RunningHoldings``  A1: holding after each ownership change.
``Portfolio``        J2: each price revalues every holder (map state).
``Lots``             J3: each price with every earlier lot (list state).
``ToggleTimeout``    J4 as coded: processing-time timer per opening.
``CleanTimeout``     J4 as intended, in event time: rows wait in time buckets
                     until the watermark passes them, then are taken in
                     order, so results do not depend on batch boundaries.
``SidedTimeout``     J4 by side, in event time, in the same buckets.

Only ``ToggleTimeout`` goes row by row: it depends on the wall clock.  (J3
is a stream-stream join as well: ``jobs.lot_valuation``.)

The reference's state never expires.  ``state_ttl_ms`` (holdings,
portfolio, toggle) gives every state variable a processing-time
time-to-live; the job then runs in ``processingTime`` mode, which TTL needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

HOLDINGS_SCHEMA = "nav_id bigint, user_id bigint, seq bigint, share bigint, holding bigint"
PORTFOLIO_SCHEMA = ("user_id bigint, nav_id bigint, unit_value bigint, "
                    "new_valuation bigint, seq bigint")
LOTS_SCHEMA = ("nav_id bigint, user_id bigint, share bigint, unit_value bigint, new_valuation bigint, "
               "nav_seq bigint, lot_seq bigint")
TRANSACTION_SCHEMA = "trans_id bigint, timestamp bigint, event_id bigint, amount string"


class _Ttl(StatefulProcessor):
    def __init__(self, state_ttl_ms: int | None = None):
        self.state_ttl_ms = int(state_ttl_ms) if state_ttl_ms else None


class RunningHoldings(_Ttl):
    """A1, keyed by (nav_id, user_id): value state = holding so far.

    A pandas processor: the rows of the key in the micro-batch come as
    frames, and their holdings are one cumulative sum.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.holding = handle.getValueState("holding", "holding bigint", self.state_ttl_ms)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.holding.update((int(initialState["holding"].iloc[-1]),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        cur = self.holding.get()
        out = pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable")
        out["holding"] = out["share"].cumsum() + (cur[0] if cur else 0)
        self.holding.update((int(out["holding"].iloc[-1]),))
        yield out[["nav_id", "user_id", "seq", "share", "holding"]]

    def close(self) -> None:
        pass


class Portfolio(_Ttl):
    """J2, keyed by (nav_id, bucket of users) over a tagged union (kind 'own' / 'nav').

    A nav's holders are dealt to buckets and its prices go to all of them, so
    a nav with most of the rows is as many tasks as there are buckets, each
    with its own part of the map state user_id -> holding.

    Inside a micro-batch, changes become a grid (price, user) of shares whose
    running sum down the prices is what each price sees; users without a
    change are read from the state, a piece at a time, and multiplied with all
    prices at once.  Neither holds more than ``cells`` values.
    """

    def __init__(self, state_ttl_ms: int | None = None, cells: int = 1 << 20):
        super().__init__(state_ttl_ms)
        self.cells = int(cells)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.holdings = handle.getMapState("holdings", "user_id bigint", "holding bigint",
                                           self.state_ttl_ms)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for user, holding in zip(initialState["user_id"].tolist(), initialState["holding"].tolist()):
            self.holdings.updateValue((user,), (holding,))

    @staticmethod
    def _rows(nav_id, users, units, holdings, seqs) -> pd.DataFrame:
        value = units * holdings
        if (abs(units.astype(float) * holdings) >= 2.0 ** 63).any():
            raise OverflowError(f"a valuation of nav {nav_id} exceeds 64 bits")
        return pd.DataFrame({"user_id": users, "nav_id": nav_id, "unit_value": units, "new_valuation": value, "seq": seqs})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        is_own = (batch["kind"] == "own").to_numpy()
        prices = batch[~is_own].sort_values("seq")
        seq, unit = prices["seq"].to_numpy(), prices["unit_value"].to_numpy()
        users, which = np.unique(batch["user_id"].to_numpy()[is_own], return_inverse=True)
        share = batch["share"].to_numpy()[is_own]
        # the first price that sees a change: one at the same seq comes before it
        first = np.searchsorted(seq, batch["seq"].to_numpy()[is_own], side="right")
        stored = [self.holdings.getValue((int(u),)) for u in users]
        base = np.array([h[0] if h else 0 for h in stored], np.int64)
        before = np.array([h is not None for h in stored], bool)
        if len(seq):
            step = max(1, self.cells // (len(seq) + 1))
            for a in range(0, len(users), step):
                b = min(len(users), a + step)
                mine = (which >= a) & (which < b)
                grid = np.zeros((len(seq) + 1, b - a), np.int64)
                seen = np.zeros((len(seq) + 1, b - a), np.int64)
                np.add.at(grid, (first[mine], which[mine] - a), share[mine])
                np.add.at(seen, (first[mine], which[mine] - a), 1)
                holding = base[a:b] + grid[:-1].cumsum(axis=0)
                p, u = np.nonzero(before[a:b] | (seen[:-1].cumsum(axis=0) > 0))
                if len(p):
                    yield self._rows(key[0], users[a + u], unit[p], holding[p, u], seq[p])
            changed, step = set(users.tolist()), max(1, self.cells // len(seq))
            entries = self.holdings.iterator() if self.holdings.exists() else iter(())
            others = ((u, h) for (u,), (h,) in entries if u not in changed)
            while part := list(islice(others, step)):
                u, h = np.array(part, np.int64).T
                yield self._rows(key[0], np.tile(u, len(seq)), np.repeat(unit, len(u)), np.tile(h, len(seq)), np.repeat(seq, len(u)))
        np.add.at(base, which, share)
        for u, h in zip(users.tolist(), base.tolist()):
            self.holdings.updateValue((u,), (h,))

    def close(self) -> None:
        pass


class Lots(_Ttl):
    """J3, keyed by (nav_id, bucket of users) over a tagged union: list state.

    The lots of a micro-batch are appended to the list (the stored ones aren't
    rewritten), and each price meets all lots with a smaller ``seq``, read a
    piece at a time.  ``cells`` bounds the rows made at once.
    """

    def __init__(self, state_ttl_ms: int | None = None, cells: int = 1 << 20):
        super().__init__(state_ttl_ms)
        self.cells = int(cells)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.lots = handle.getListState("lots", "user_id bigint, seq bigint, share bigint", self.state_ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        is_own = (batch["kind"] == "own").to_numpy()
        own, prices = batch[is_own], batch[~is_own].sort_values("seq")
        if len(own):
            self.lots.appendList(list(zip(own["user_id"].tolist(), own["seq"].tolist(), own["share"].tolist())))
        if not len(prices) or not self.lots.exists():
            return
        seq, unit = prices["seq"].to_numpy(), prices["unit_value"].to_numpy()
        stored = self.lots.get()
        while part := list(islice(stored, max(1, self.cells // len(seq)))):
            user, at, share = np.array(part, np.int64).T
            first = np.searchsorted(seq, at, side="right")       # the first price that sees the lot
            n = len(seq) - first
            lot = np.repeat(np.arange(len(part)), n)
            price = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
            if len(lot):
                out = Portfolio._rows(key[0], user[lot], unit[price], share[lot], seq[price])
                yield pd.DataFrame({"nav_id": key[0], "user_id": out["user_id"], "share": share[lot], "unit_value": out["unit_value"],
                                    "new_valuation": out["new_valuation"], "nav_seq": seq[price], "lot_seq": at[lot]})

    def close(self) -> None:
        pass


class _Wake:
    """One outstanding event-time timer per key, kept in value state.

    Registering a timer per buffered row would fire once per row when the
    watermark jumps, and each firing re-reads the key's buffers.  Instead
    the processor asks to be woken at the earliest time anything can
    change, and moves that single timer when the time changes.
    """

    def __init__(self, handle: StatefulProcessorHandle):
        self.handle = handle
        self.at = handle.getValueState("wake", "at bigint")

    def set(self, when: int | None) -> None:
        cur = self.at.get()[0] if self.at.exists() else None
        if cur == when:
            return
        if cur is not None:
            self.handle.deleteTimer(cur)
        if when is None:
            self.at.clear()
        else:
            self.handle.registerTimer(when)
            self.at.update((when,))

    def fired(self) -> None:
        self.at.clear()


class _Buckets:
    """Rows in map state by time bucket: a call reads and writes only the buckets it needs.

    A bucket's rows are one entry, a list for each column.  A small value
    state lists the buckets and the earliest time in each.
    """

    def __init__(self, handle: StatefulProcessorHandle, name: str, columns: dict[str, str], width: int):
        self.columns, self.width = list(columns), max(1, int(width))
        self.rows = handle.getMapState(name, "bucket bigint", ", ".join(f"{c} array<{t}>" for c, t in columns.items()))
        self.index = handle.getValueState(f"{name}_index", "buckets array<bigint>, earliest array<bigint>")

    def _listed(self) -> dict[int, int]:
        got = self.index.get() if self.index.exists() else None
        return dict(zip(got[0], got[1])) if got else {}

    def _list(self, earliest: dict[int, int]) -> None:
        if earliest:
            keys = sorted(earliest)
            self.index.update((keys, [earliest[k] for k in keys]))
        elif self.index.exists():
            self.index.clear()

    def add(self, frame: pd.DataFrame) -> None:
        if not len(frame):
            return
        listed = self._listed()
        for bucket, part in frame.groupby(frame["timestamp"] // self.width):
            bucket = int(bucket)
            old = self.rows.getValue((bucket,)) if bucket in listed else None
            new = [part[c].tolist() for c in self.columns]
            self.rows.updateValue((bucket,), tuple([*o, *n] for o, n in zip(old, new)) if old else tuple(new))
            least = int(part["timestamp"].min())
            listed[bucket] = min(least, listed.get(bucket, least))
        self._list(listed)

    def take(self, since: int | None, until: int) -> pd.DataFrame:
        """Remove and return all rows of the buckets with times in [since, until)."""
        listed, parts = self._listed(), []
        for bucket in [b for b, least in listed.items() if least < until and (since is None or (b + 1) * self.width > since)]:
            parts.append(pd.DataFrame(dict(zip(self.columns, map(list, self.rows.getValue((bucket,)))))))
            self.rows.removeKey((bucket,))
            del listed[bucket]
        if parts:
            self._list(listed)
            return pd.concat(parts, ignore_index=True)
        return pd.DataFrame({c: pd.Series(dtype="int64" if c in ("timestamp", "event_id") else object) for c in self.columns})

    def earliest(self) -> int | None:
        return min(self._listed().values(), default=None)


def _frames(rows, columns: list[str]) -> pd.DataFrame:
    return pd.concat([r[columns] for r in rows], ignore_index=True)


def _in_time_order(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.sort_values(["timestamp", "event_id"], kind="stable", ignore_index=True)


def _keyed(trans_id, frame: pd.DataFrame, columns: list[str]) -> pd.DataFrame:
    out = frame[columns].copy()
    out.insert(0, "trans_id", trans_id)
    return out


_TX = {"timestamp": "bigint", "event_id": "bigint", "amount": "string"}
_SIDED = {**_TX, "side": "string"}


def _tx_row(t) -> Row:
    return Row(trans_id=t[0], timestamp=t[1], event_id=t[2], amount=t[3])


class ToggleTimeout(_Ttl):
    """J4 exactly as coded, keyed by trans_id, processing time.

    An arrival on a closed key stores it and arms a timer at now + ttl; an
    arrival on an open key clears it.  Timers are never cancelled and an
    emit does not clear the key.
    """

    def __init__(self, ttl_ms: int, state_ttl_ms: int | None = None):
        super().__init__(state_ttl_ms)
        self.ttl_ms = int(ttl_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", TRANSACTION_SCHEMA, self.state_ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        for r in sorted(rows, key=lambda r: (r["timestamp"], r["event_id"])):
            if self.open.exists():
                self.open.clear()
            else:
                self.open.update((r["trans_id"], r["timestamp"], r["event_id"], r["amount"]))
                self.handle.registerTimer(now + self.ttl_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.open.exists():
            yield _tx_row(self.open.get())

    def close(self) -> None:
        pass


class CleanTimeout(StatefulProcessor):
    """J4 as intended, keyed by trans_id, event time (``timestamp`` in ms).

    A match cancels the pending timeout and an emit clears the key.  Rows
    wait in time buckets until the watermark passes them; a call takes the
    buckets that are due and leaves the others unread.  Due rows, behind the
    open arrival, split into chains at gaps over ttl: an odd chain leaves its
    last arrival without a partner, and the last chain's stays open until the
    watermark is past its deadline (a partner exactly at the deadline is in
    time).
    """

    def __init__(self, ttl_ms: int, bucket_ms: int | None = None):
        self.ttl_ms = int(ttl_ms)
        self.bucket_ms = int(bucket_ms or max(1000, self.ttl_ms // 8))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.wake = _Wake(handle)
        self.buffer = _Buckets(handle, "buffer", _TX, self.bucket_ms)
        self.open = handle.getValueState("open", TRANSACTION_SCHEMA)

    def _advance(self, trans_id, wm: int) -> Iterator[pd.DataFrame]:
        columns = list(_TX)
        taken = self.buffer.take(None, wm)
        # rows at the watermark itself may still have peers on the way
        late = taken["timestamp"] >= wm
        self.buffer.add(taken[late])
        ready = _in_time_order(taken[~late])
        opened = self.open.get() if self.open.exists() else None
        if opened is not None:
            ready = pd.concat([pd.DataFrame([tuple(opened)[1:]], columns=columns), ready], ignore_index=True)
        wakes = []
        if len(ready):
            t = ready["timestamp"].to_numpy(np.int64)
            chain = np.cumsum(np.append(0, np.diff(t) > self.ttl_ms))
            last = np.append(np.flatnonzero(np.diff(chain)), len(t) - 1)
            odd = last[np.bincount(chain) % 2 == 1]
            waits = len(odd) and odd[-1] == len(t) - 1 and t[-1] + self.ttl_ms >= wm
            if waits:
                odd = odd[:-1]
                self.open.update((trans_id, int(t[-1]), int(ready["event_id"].iloc[-1]), ready["amount"].iloc[-1]))
                wakes.append(int(t[-1]) + self.ttl_ms + 1)
            elif opened is not None:
                self.open.clear()
            if len(odd):
                yield _keyed(trans_id, ready.iloc[odd], columns)
        if (next_row := self.buffer.earliest()) is not None:
            wakes.append(next_row + 1)
        self.wake.set(min(wakes) if wakes else None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self.buffer.add(_frames(rows, list(_TX)))
        yield from self._advance(key[0], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.wake.fired()
        yield from self._advance(key[0], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


SIDED_SCHEMA = ("trans_id bigint, timestamp bigint, event_id bigint, amount string, "
                "side string")


class SidedTimeout(StatefulProcessor):
    """J4 by side, keyed by trans_id, event time: arrivals with no arrival
    of the other side within +-ttl.

    Rows wait in time buckets until the watermark passes them.  Due rows are
    compared, by binary search, with the nearest arrivals of the other side
    before (among them and the latest of earlier calls) and after.  Those
    without a partner wait, in buckets too, until nothing in reach can come
    any more; a call takes only those that a due arrival may reach, or whose
    time is up.  No pairs are formed.
    """

    def __init__(self, ttl_ms: int, sides=("debit", "credit"), bucket_ms: int | None = None):
        self.ttl_ms = int(ttl_ms)
        self.sides = tuple(sides)
        self.bucket_ms = int(bucket_ms or max(1000, self.ttl_ms // 8))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.wake = _Wake(handle)
        self.buffer = _Buckets(handle, "buffer", _SIDED, self.bucket_ms)
        self.alone = _Buckets(handle, "alone", _SIDED, self.bucket_ms)
        self.last = handle.getMapState("last", "side string", "timestamp bigint")

    def _advance(self, trans_id, wm: int) -> Iterator[pd.DataFrame]:
        taken = self.buffer.take(None, wm)
        late = taken["timestamp"] >= wm
        self.buffer.add(taken[late])
        ready = _in_time_order(taken[~late])
        done = wm - self.ttl_ms                         # of earlier rows all partners are known
        waiting = self.alone.take(None, done)
        if len(ready):
            first = int(ready["timestamp"].iloc[0])
            waiting = pd.concat([waiting, self.alone.take(first - self.ttl_ms, wm)], ignore_index=True)
        rows = _in_time_order(pd.concat([waiting, ready], ignore_index=True))
        if len(rows):
            t, side = rows["timestamp"].to_numpy(np.int64), rows["side"].to_numpy()
            met = np.zeros(len(rows), bool)
            for one, other in (self.sides, self.sides[::-1]):
                mine = np.flatnonzero(side == one)
                known = self.last.getValue((other,))
                theirs = ready["timestamp"].to_numpy(np.int64)[ready["side"].to_numpy() == other]
                theirs = np.append([known[0]] if known else [], theirs).astype(np.int64)
                if not len(theirs):
                    continue
                at = np.searchsorted(theirs, t[mine], side="right")
                before = (at > 0) & (t[mine] - theirs[np.maximum(at - 1, 0)] <= self.ttl_ms)
                after = (at < len(theirs)) & (theirs[np.minimum(at, len(theirs) - 1)] - t[mine] <= self.ttl_ms)
                met[mine] = before | after
            left = rows[~met]
            over = left["timestamp"] < done
            self.alone.add(left[~over])
            if over.any():
                yield _keyed(trans_id, left[over], list(_SIDED))
            for s in self.sides:
                times = ready["timestamp"][ready["side"] == s]
                if len(times):
                    self.last.updateValue((s,), (int(times.max()),))
        wakes = []
        if (next_row := self.buffer.earliest()) is not None:
            wakes.append(next_row + 1)
        if (next_done := self.alone.earliest()) is not None:
            wakes.append(next_done + self.ttl_ms + 1)
        self.wake.set(min(wakes) if wakes else None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self.buffer.add(_frames(rows, list(_SIDED)))
        yield from self._advance(key[0], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.wake.fired()
        yield from self._advance(key[0], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass
