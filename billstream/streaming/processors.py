"""Keyed state of the streams: what is kept for the bills of a bucket, and when it goes.

A call of the state store costs the same for one value as for many, so bills share a key by the hash
of their id, and a bucket's rows are read and appended together.

The module is pickled by value, so executors need no copy of the package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor

#: Rows in one element of a list state.
PART = 10_000


class OrphanTracker(StatefulProcessor):
    """One open placeholder per bill that votes or hearings name; it goes when the bill arrives.

    Rows ``bucket`` (the key), ``bill_id``, ``kind`` (vote, event, bill) and ``run``. A placeholder is
    there in every run from its first one on, so the first run is all that its age needs. The open
    placeholders of a bucket are read at once; only bills that change are written.
    """

    STATE = "first_run INT, vote_count BIGINT, event_count BIGINT"
    CHANGES = "bill_id STRING, change STRING, first_run INT, run INT, vote_count BIGINT, event_count BIGINT"

    def init(self, handle) -> None:
        self.orphan = handle.getMapState("orphan", "bill_id STRING", self.STATE)

    def handleInputRows(self, key, rows, timerValues):
        arrived, named, run = set(), {}, None
        for row in rows:
            run = row.run if run is None else max(run, row.run)
            if row.kind == "bill":
                arrived.add(row.bill_id)
            else:
                votes, events = named.get(row.bill_id, (0, 0))
                named[row.bill_id] = (votes + (row.kind == "vote"), events + (row.kind == "event"))
        stored = {bill: value for (bill,), value in self.orphan.iterator()}
        for bill in arrived & stored.keys() | named.keys():
            known = stored.get(bill)
            first, old_votes, old_events = known or (run, 0, 0)
            votes, events = named.get(bill, (0, 0))
            votes, events = votes + old_votes, events + old_events
            if bill not in arrived:
                self.orphan.updateValue((bill,), (first, votes, events))
                change = "seen" if known else "new"
            elif known:
                self.orphan.removeKey((bill,))
                change = "resolved"
            else:
                continue
            yield Row(bill_id=bill, change=change, first_run=first, run=run, vote_count=votes, event_count=events)

    def close(self) -> None:
        pass


class HearingWaiter(StatefulProcessor):
    """Agenda rows wait in the bucket of the bill they name; the bill's session wakes all of them.

    Rows ``bucket`` (the key), ``bill_id``, ``kind`` (agenda, bill), ``event_id``, ``pos``,
    ``session_id``, ``date_folder``, ``run``. New rows are appended to what waits, at once for the
    bucket and unread; a bucket is read, and written anew without the rows that leave, only where a
    bill arrives. An element of the state is the rows of one append, column by column. An agenda row
    that comes again may wait twice; its last run counts.
    """

    STATE = "bill_id ARRAY<STRING>, event_id ARRAY<BIGINT>, pos ARRAY<INT>, since ARRAY<INT>"

    LINKS = "event_id BIGINT, pos INT, bill_id STRING, session_id STRING, date_folder STRING, since INT, run INT"

    def init(self, handle) -> None:
        self.waiting = handle.getListState("waiting", self.STATE)

    def handleInputRows(self, key, rows, timerValues):
        sessions, fresh, run = {}, {}, None
        for row in rows:
            run = row.run if run is None else max(run, row.run)
            if row.kind == "bill":
                sessions[row.bill_id] = (row.session_id, row.date_folder)
            elif row.session_id is not None:  # the bill was there before: no need to wait
                yield Row(
                    event_id=row.event_id, pos=row.pos, bill_id=row.bill_id, session_id=row.session_id,
                    date_folder=row.date_folder, since=row.run, run=row.run,
                )
            else:
                fresh[(row.bill_id, row.event_id, row.pos)] = row.run
        stored = {}
        if sessions and self.waiting.exists():
            for columns in self.waiting.get():
                for *place, since in zip(*columns):
                    place = tuple(place)
                    stored[place] = max(since, stored.get(place, since))
        leave = any(bill in sessions for bill, _, _ in stored)
        for place, since in {**stored, **fresh}.items():
            if place[0] in sessions:
                bill, event_id, pos = place
                session_id, date_folder = sessions[bill]
                yield Row(event_id=event_id, pos=pos, bill_id=bill, session_id=session_id, date_folder=date_folder, since=since, run=run)
        if leave:
            self.waiting.clear()
            fresh = {**stored, **fresh}
        rest = [(*place, since) for place, since in fresh.items() if place[0] not in sessions]
        for at in range(0, len(rest), PART):
            self.waiting.appendValue(tuple(map(list, zip(*rest[at : at + PART]))))

    def close(self) -> None:
        pass


cloudpickle.register_pickle_by_value(sys.modules[__name__])
