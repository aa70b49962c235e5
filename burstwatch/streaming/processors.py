"""What runs beside a state store, key by key.

This module is sent to the workers by value, as the worker that starts a query on the
driver does not see the files a session has been given; so it imports nothing of this package.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class FirstComments(StatefulProcessor):
    """The earliest comments of the windows of one page that end within one span of time.

    The state is a list of at most ``n`` comments for each of these windows. A timer at the
    span's end clears it when the watermark passes, as no window of it can change any more.
    """

    def __init__(self, n: int, span: int, separator: str):
        self.n, self.span, self.separator = n, span, separator

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "comments array<struct<window_end:bigint,at:bigint,id:string,text:string>>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        found: dict[int, list] = {}
        known = self.kept.get()
        for end, *comment in known[0] if known else ():
            found.setdefault(end, []).append(tuple(comment))
        touched, changed = set(), False
        for row in rows:
            touched.add(row.window_end)
            if row.candidate is None:
                continue
            own = found.setdefault(row.window_end, [])
            own.append((row.at, row.event_id, row.candidate))
            if len(own) > self.n:
                own.sort(key=_when)
                changed |= own.pop() != (row.at, row.event_id, row.candidate)
            else:
                changed = True
        if changed:
            if not known:
                self.handle.registerTimer((int(key[1]) + 1) * self.span // 1000)
            self.kept.update(([(end, *c) for end, own in found.items() for c in own],))
        for end in touched:
            own = sorted(found.get(end, ()), key=_when)
            yield Row(page_title=key[0], window_end=end, comments=self.separator.join(c[2] for c in own))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.kept.clear()
        return iter(())

    def close(self) -> None:
        pass


def _when(comment: tuple) -> tuple:
    at, key, _ = comment
    return at, key is not None, key


class Settling(StatefulProcessor):
    """Files of one minute, held until the minute is complete or has waited long enough.

    A minute is let go ``hold`` after its table of contents came in, if its quadgrams are
    there by then; else as soon as they are, or without them after ``give_up``. Timers run on
    the processing clock. What was let go is remembered for ``remember``, so that a file that comes
    later does not publish the minute again.
    """

    def __init__(self, hold: timedelta, give_up: timedelta, remember: timedelta):
        self.hold, self.give_up, self.remember = (int(t / timedelta(milliseconds=1)) for t in (hold, give_up, remember))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "toc array<string>, ngrams array<string>, since bigint, done boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        toc, ngrams, since, done = self.seen.get() or ([], [], None, False)
        toc, ngrams = list(toc), list(ngrams)
        for row in rows:
            (toc if row.kind == "toc" else ngrams).append(row.path)
        if since is None and toc:
            since = now
        if done or since is None:
            self.seen.update((toc, ngrams, since, done))
            if since is None:  # quadgrams without a table of contents are dropped in the end
                self.handle.registerTimer(now + self.remember)
            return
        yield from self._decided(key, toc, ngrams, since, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        known = self.seen.get()
        if known is None:
            return
        toc, ngrams, since, done = known
        if done or since is None:
            if since is None or now >= since + self.remember:
                self.seen.clear()
            return
        yield from self._decided(key, list(toc), list(ngrams), since, now)

    def _decided(self, key, toc: list, ngrams: list, since: int, now: int) -> Iterator[Row]:
        due = now >= since + (self.hold if ngrams else self.give_up)
        self.seen.update((toc, ngrams, since, due))
        # looked at again every hold, so that other settings count from the next look on
        self.handle.registerTimer(since + self.remember if due else min(now + self.hold, since + self.give_up))
        if due:
            yield Row(toc_timestamp=key[0], toc=toc, ngrams=ngrams, held_ms=now - since)

    def close(self) -> None:
        pass
