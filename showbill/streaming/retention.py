"""The catalogue kept as the state of a stream: each event is upserted under its key and leaves when its time has passed.

A key's state is its merged record. Columns are merged like a batch's records, with the record's own order deciding, so late and repeated rows give
what rows in order give. An event-time timer per key fires when the event's retention ends; the key's state is then
removed, and a row tells so. State grows with the events that are relevant and not with the stream.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Days that an event stays after its end, and days ahead that it may start (fixed values).
AFTER, AHEAD = 7, 550
STATE = "title string, title_ord bigint, venue string, venue_ord bigint, description string, description_ord bigint, start_date date, end_date date, dates_ord bigint, first_seen bigint, last_seen bigint, version bigint"
OUTPUT = "key string, change string, title string, venue string, description string, start_date date, end_date date, first_seen bigint, last_seen bigint, at bigint, version bigint"
#: Moments are microseconds since then, which carry no time zone.
EPOCH = datetime.date(1970, 1, 1)
DAY_US = 86_400_000_000


def relevant(start: datetime.date | None, end: datetime.date | None, today: datetime.date) -> bool:
    """Whether an event is kept on a day; without dates it is. Rows and timers ask the same."""
    last = end or start
    return (last is None or last >= today - datetime.timedelta(AFTER)) and (start is None or start <= today + datetime.timedelta(AHEAD))


def merged(old: dict | None, row: dict) -> dict:
    """A key's record after another row: later values over earlier ones by `ord`, empty ones never; descriptions don't shrink, of equally long ones the earliest stays.

    The result doesn't depend on the order in which rows come.
    """
    new = dict(old) if old else {"title": "", "title_ord": -1, "venue": "", "venue_ord": -1, "description": "", "description_ord": -1, "start_date": None, "end_date": None, "dates_ord": -1, "first_seen": row["us"], "last_seen": row["us"], "version": 0}
    for c in ("title", "venue"):
        if row[c] and (row["ord"], row[c]) > (new[f"{c}_ord"], new[c]):
            new[c], new[f"{c}_ord"] = row[c], row["ord"]
    told = row["description"] or ""
    if (len(told), -row["ord"], told) > (len(new["description"]), -new["description_ord"], new["description"]):
        new["description"], new["description_ord"] = told, row["ord"]
    days = (row["start_date"], row["end_date"])
    if days != (None, None) and (row["ord"], *(d or EPOCH for d in days)) > (new["dates_ord"], *(d or EPOCH for d in (new["start_date"], new["end_date"]))):
        new["start_date"], new["end_date"], new["dates_ord"] = *days, row["ord"]
    new["first_seen"], new["last_seen"] = min(new["first_seen"], row["us"]), max(new["last_seen"], row["us"])
    return new


def told(key: str, change: str, state: dict, at: int) -> Row:
    return Row(key=key, change=change, title=state["title"], venue=state["venue"], description=state["description"], start_date=state["start_date"], end_date=state["end_date"], first_seen=state["first_seen"], last_seen=state["last_seen"], at=at, version=state["version"])


class Retention(StatefulProcessor):
    """One state per key. A row of an event that isn't relevant on the day it was seen is dropped, a key's timer is its expiry."""

    NAMES = [part.split(" ")[0] for part in STATE.split(", ")]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("event", STATE)

    def _read(self) -> dict | None:
        return dict(zip(self.NAMES, self.state.get())) if self.state.exists() else None

    def _timer(self, state: dict) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        last = state["end_date"] or state["start_date"]
        if last is not None:
            self.handle.registerTimer((last - EPOCH).days * 86_400_000 + (AFTER + 1) * 86_400_000)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state, changed = self._read(), False
        for row in rows:
            r = row.asDict()
            if relevant(r["start_date"], r["end_date"], EPOCH + datetime.timedelta(r["us"] // DAY_US)):
                state, changed = merged(state, r), True
        if changed:
            state["version"] += 1
            self.state.update(tuple(state[n] for n in self.NAMES))
            self._timer(state)
            yield told(key[0], "upsert", state, state["last_seen"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self._read()
        if state is not None:
            self.state.clear()
            yield told(key[0], "expired", state, expiredTimerInfo.getExpiryTimeInMs() * 1000)

    def close(self) -> None:
        pass


def retained(incoming: DataFrame, late: str = "2 days") -> DataFrame:
    """Changes of the catalogue: a row per key and batch that changed it (`upsert`), and one when it leaves (`expired`).

    incoming: a stream of key, title, venue, description, start_date, end_date, seen (timestamp) and ord. `late` is how far behind the newest rows still count; the
    watermark also drives the timers. Needs the RocksDB state store; start the query in append mode. Rows without a key are dropped.
    """
    rows = incoming.where("key is not null and seen is not null").select("key", "title", "venue", "description", "start_date", "end_date", "seen", F.unix_micros("seen").alias("us"), F.col("ord").cast("long").alias("ord")).withWatermark("seen", late)
    changes = rows.groupBy("key").transformWithState(statefulProcessor=Retention(), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")
    return changes.withColumns({c: F.timestamp_micros(c) for c in ("first_seen", "last_seen", "at")})


def catalogue(changes: DataFrame) -> DataFrame:
    """The catalogue as of the last change of each key, from the changes that a sink has gathered; expired keys are left out.

    A key's changes are ordered by last_seen, of equal ones by the state's version, an expiry after the upserts of the state that it ends.
    """
    order = F.struct("last_seen", (F.col("change") == "expired").alias("gone"), "version")
    last = changes.groupBy("key").agg(F.max_by(F.struct(*[c for c in changes.columns if c != "key"]), order).alias("r"))
    return last.where("r.change <> 'expired'").select("key", "r.title", "r.venue", "r.description", "r.start_date", "r.end_date", "r.first_seen", "r.last_seen")


def replayed(rows: DataFrame, today: Column) -> DataFrame:
    """The same catalogue from all rows at once, for replays and as the stream's measure: rows relevant on the day they were seen, merged, without what has expired by `today`.

    The two agree where no row comes after the watermark and no key comes back after it has left, as the stream then begins its record anew.
    """
    last = F.coalesce("end_date", "start_date")
    day = F.to_date("seen")
    kept = rows.where("key is not null and seen is not null").where((last.isNull() | (last >= F.date_sub(day, AFTER))) & (F.col("start_date").isNull() | (F.col("start_date") <= F.date_add(day, AHEAD))))
    newest = lambda c: F.max_by(c, F.when(F.coalesce(F.col(c), F.lit("")) != "", F.struct("ord", c)))
    days = F.struct("ord", F.coalesce("start_date", F.lit(EPOCH)), F.coalesce("end_date", F.lit(EPOCH)))
    dated = F.max_by(F.struct("start_date", "end_date"), F.when(last.isNotNull(), days))
    described = F.max_by("description", F.when(F.coalesce("description", F.lit("")) != "", F.struct(F.length("description"), -F.col("ord"), "description")))
    text = lambda c, name: F.coalesce(c, F.lit("")).alias(name)
    out = kept.groupBy("key").agg(text(newest("title"), "title"), text(newest("venue"), "venue"), text(described, "description"), dated.alias("_d"), F.min("seen").alias("first_seen"), F.max("seen").alias("last_seen"))
    out = out.select("key", "title", "venue", "description", F.col("_d.start_date").alias("start_date"), F.col("_d.end_date").alias("end_date"), "first_seen", "last_seen")
    return out.where(last.isNull() | (last >= F.date_sub(today, AFTER)))
