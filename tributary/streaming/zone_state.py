"""I4: per-(object, zone) visit state in a stream, whatever order rows arrive in.

The same state machine as ``operators.movement.zone_speed``.  Each key keeps its
rows of the last ``keep_seconds`` of event time in an ordered buffer, cut into
time buckets, with the machine's carry at each bucket's end.  New rows are merged
into their buckets; from the first touched bucket on the machine runs again,
bucket by bucket, until a bucket ends with the carry it had before, and every row
whose result is new or has changed is sent with a higher ``revision``.  Rows in
time order are sent once each.

A call of the processor costs far more than its rows, so Spark groups by a slot (a
hash of the key), not by the key: a call takes all keys of a slot, and the machine
runs over them in one pass.  A slot's state is one entry a time bucket (rows of
all its keys) and one of the keys and their carries.

Nothing is dropped: a row that comes after its part of the buffer has expired
(older than ``keep_seconds`` against the key's newest row, or after the key was
idle for ``idle_ms``) is sent with ``expired`` set and no result, for a sink of
its own.  A row delivered again changes nothing.  State is bounded by the rows
of ``keep_seconds`` a live key; an idle key keeps a few numbers.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

OUT_SCHEMA = ("object_id long, zone_name string, event_id long, ts timestamp, new_track boolean, entry boolean, exit boolean, "
              "exit_speed double, speed_kmh double, revision long, expired boolean")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# A key's carry: time of its last row, was it inside, entry time of the open visit
# (NaN: none), held speed.
CARRY = [("last_t", "f8"), ("was_in", "?"), ("entered", "f8"), ("held", "f8")]
FIELDS = [name for name, _ in CARRY]
# What a buffered row holds (k: its key's place in the slot), then the result that was sent for it.
ROW = np.dtype([("k", "i4"), ("t", "f8"), ("event_id", "i8"), ("ts", "i8"), ("inside", "?"), ("length", "f8"),
                ("new_track", "?"), ("entry", "?"), ("exit", "?"), ("exit_speed", "f8"), ("speed", "f8"), ("sent", "?")])
# A key: newest time, time up to which its buffer is gone with the carry there, when last seen (-1: idle since).
KEY = np.dtype([("object_id", "i8"), ("no_object", "?"), ("zone", "i4"), ("newest", "f8"), ("horizon", "f8"), ("revision", "i8"),
                ("seen", "i8"), *CARRY])
# A key's carry at the end of a bucket that holds rows of it.
SPAN = np.dtype([("k", "i4"), ("b", "i8"), *CARRY])
# New rows that a call holds before it puts them into their buckets.
PENDING = 1_000_000


def _py_round(x: float, nd: int) -> float:
    # Half to even on the decimal text, as Spark's bround does.
    from decimal import ROUND_HALF_EVEN, Decimal
    return float(Decimal(repr(float(x))).quantize(Decimal(1).scaleb(-nd), rounding=ROUND_HALF_EVEN))


def advance(rows: np.ndarray, carry: np.ndarray, gap: float, min_t: float, max_t: float) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Results of rows in the order (key, time), and each key's carry after them
    (SPAN without a bucket).  ``carry`` is by key place.

    Running maxima of positions give the last entry, leave and track start of the
    same key; the held speed is that of the last leave unless a new track began since."""
    t, inside, n = rows["t"], rows["inside"], len(rows)
    idx = np.arange(n)
    first = np.concatenate([[True], rows["k"][1:] != rows["k"][:-1]])
    start = np.maximum.accumulate(np.where(first, idx, 0))
    before = carry[rows["k"]]
    prev_t = np.where(first, before["last_t"], np.concatenate([[np.nan], t[:-1]]))
    prev_in = np.where(first, before["was_in"], np.concatenate([[False], inside[:-1]]))
    new_track = np.isnan(prev_t) | ((t - prev_t) > gap)
    pit = ~new_track & prev_in
    entry = inside & ~pit
    leave = ~inside & pit
    en_pos, ex_pos, nt_pos = (np.maximum.accumulate(np.where(what, idx, -1)) for what in (entry, leave, new_track))
    last_entry = np.where(en_pos >= start, t[en_pos], -np.inf)
    seed = np.where(np.isnan(before["entered"]), -np.inf, before["entered"])
    last_entry = np.maximum(last_entry, np.where(nt_pos >= start, -np.inf, seed))
    dt = t - last_entry
    ok = leave & (dt > min_t) & (dt < max_t)
    exit_speed = np.where(leave, 0.0, np.nan)
    for i in np.flatnonzero(ok):  # rounding on the decimal text, leave rows only
        exit_speed[i] = _py_round(rows["length"][i] / dt[i] * 3.6, 1)
    held = np.where((ex_pos >= start) & (ex_pos > nt_pos), exit_speed[ex_pos],
                    np.where((ex_pos < start) & (nt_pos < start), before["held"], 0.0))
    speed = np.where(inside, 0.0, held)
    last = np.flatnonzero(np.concatenate([first[1:], [True]]))
    after = np.zeros(len(last), SPAN)
    after["k"], after["last_t"], after["was_in"], after["held"] = rows["k"][last], t[last], inside[last], speed[last]
    after["entered"] = np.where(inside[last] & np.isfinite(last_entry[last]), last_entry[last], np.nan)
    return {"new_track": new_track, "entry": entry, "exit": leave, "exit_speed": exit_speed, "speed": speed}, after


def _differs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ~((a == b) | ((a != a) & (b != b)))


# The driver starts a worker of its own for the stream, which gets this module by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class ZoneProcessor(StatefulProcessor):
    """The buffers and machines of a slot's keys (see the module's text)."""

    def __init__(self, gap: float, min_t: float, max_t: float, keep_seconds: float, idle_ms: int | None, bucket_seconds: float):
        self.limits, self.keep, self.idle_ms, self.width = (gap, min_t, max_t), keep_seconds, idle_ms, bucket_seconds

    def init(self, handle) -> None:
        self.handle = handle
        self.buckets = handle.getMapState("buckets", "bucket long", "rows binary")
        self.head = handle.getValueState("head", "keys binary, spans binary, zones string")

    def close(self) -> None:
        pass

    def _load(self) -> None:
        keys, spans, zones = self.head.get() or (b"", b"", "[]")
        self.keys, self.spans, self.zones = np.frombuffer(keys, KEY).copy(), np.frombuffer(spans, SPAN).copy(), json.loads(zones)
        self.place = {k: i for i, k in enumerate(zip(self.keys["object_id"].tolist(), self.keys["no_object"].tolist(), self.keys["zone"].tolist()))}

    def _save(self) -> None:
        self.head.update((self.keys.tobytes(), self.spans.tobytes(), json.dumps(self.zones)))

    def _bucket(self, b: int) -> np.ndarray:
        got = self.buckets.getValue((int(b),))
        return np.frombuffer(got[0], ROW).copy() if got else np.zeros(0, ROW)

    def _put(self, b: int, rows: np.ndarray) -> None:
        self.buckets.updateValue((int(b),), (rows.tobytes(),))

    def _places(self, pdf: pd.DataFrame) -> np.ndarray:
        """The place of each row's key; new keys get one."""
        codes, names = pd.factorize(pdf["zone_name"], use_na_sentinel=False)
        names = [None if pd.isna(z) else z for z in names]
        self.zones += [z for z in names if z not in self.zones]
        ids = pd.DataFrame({"o": pdf["object_id"].to_numpy(), "n": pdf["no_object"].to_numpy(),
                            "z": np.array([self.zones.index(z) for z in names], np.int64)[codes]})
        group = ids.groupby(["o", "n", "z"], sort=False).ngroup().to_numpy()
        one = ids.iloc[np.unique(group, return_index=True)[1]]
        at, added = [], []
        for key in zip(one["o"].tolist(), one["n"].tolist(), one["z"].tolist()):
            if key not in self.place:
                self.place[key] = len(self.place)
                added.append((*key, -np.inf, -np.inf, 0, -1, np.nan, False, np.nan, 0.0))
            at.append(self.place[key])
        if added:
            self.keys = np.concatenate([self.keys, np.array(added, KEY)])
        return np.array(at, np.int64)[group]

    @staticmethod
    def _merge(held: np.ndarray, new: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """A bucket's rows with the new ones, and the keys that got any."""
        both = np.concatenate([held, *new])                      # the first copy of a row stays
        order = np.arange(len(both))
        at = np.lexsort((order, both["event_id"], both["t"], both["k"]))
        both, order = both[at], order[at]
        same = (both["k"][1:] == both["k"][:-1]) & (both["event_id"][1:] == both["event_id"][:-1]) & (both["t"][1:] == both["t"][:-1])
        fresh = np.concatenate([[True], ~same])
        return both[fresh], np.unique(both["k"][fresh & (order >= len(held))])

    def _frame(self, rows: np.ndarray, expired: bool) -> pd.DataFrame:
        key = self.keys[rows["k"]]
        flag = lambda name: pd.array([pd.NA] * len(rows), "boolean") if expired else rows[name]
        value = lambda name: np.full(len(rows), np.nan) if expired else rows[name]
        zones = np.array([*self.zones, None], object)
        return pd.DataFrame({"object_id": pd.arrays.IntegerArray(key["object_id"].copy(), key["no_object"].copy()),
                             "zone_name": zones[key["zone"]], "event_id": rows["event_id"], "ts": pd.to_datetime(rows["ts"]),
                             "new_track": flag("new_track"), "entry": flag("entry"), "exit": flag("exit"), "exit_speed": value("exit_speed"),
                             "speed_kmh": value("speed"), "revision": key["revision"], "expired": expired})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self._load()
        now = timerValues.getCurrentProcessingTimeInMs() if self.idle_ms is not None else 0
        met, pending, held, touched = np.zeros(0, np.int64), {}, 0, {}

        def flush(b: int) -> np.ndarray:
            both, got = self._merge(self._bucket(b), pending.pop(b))
            touched[b] = np.union1d(touched.get(b, got), got)
            return both

        for pdf in rows:                                          # a frame at a time: a slot's batch may be large
            k = self._places(pdf)
            fresh = np.setdiff1d(k, met)
            self.keys["revision"][fresh] += 1
            met = np.union1d(met, fresh)
            new = np.zeros(len(pdf), ROW)
            new["k"], new["length"] = k, pdf["length_m"].to_numpy()
            for name in ("t", "event_id", "inside"):
                new[name] = pdf[name].to_numpy()
            new["ts"] = pdf["ts"].astype("datetime64[ns]").astype("int64").to_numpy()
            gone = new["t"] < self.keys["horizon"][k]
            if gone.any():
                yield self._frame(new[gone], True)
            new = new[~gone]
            np.maximum.at(self.keys["newest"], new["k"], new["t"])
            bucket = np.floor(new["t"] / self.width).astype(np.int64)
            for b in np.unique(bucket).tolist():
                pending.setdefault(b, []).append(new[bucket == b])
            held += len(new)
            if held > PENDING:
                for b in list(pending):
                    self._put(b, flush(b))
                held = 0
        self.keys["seen"][met] = now
        yield from self._run(pending, flush, touched)
        old = (self.spans["b"] + 1) * self.width <= self.keys["newest"][self.spans["k"]] - self.keep
        if old.any():
            self._forget(old)
            last = self.gone
            self.keys["horizon"][last["k"]] = (last["b"] + 1) * self.width
        self._save()
        if self.idle_ms is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t[0] if isinstance(t, tuple) else t)
            self._next_timer()

    def _run(self, pending: dict, flush, touched: dict) -> Iterator[pd.DataFrame]:
        """The machine over what was touched, in bucket order; ``carry`` is each key's at the bucket's start."""
        carry = self.keys[FIELDS].astype(CARRY)
        again = np.zeros(len(self.keys), bool)
        buckets = np.union1d(np.unique(self.spans["b"]), np.array([*pending, *touched], np.int64)).tolist()
        spans = {b: self.spans[self.spans["b"] == b] for b in buckets}
        for b in buckets:
            span, rows = spans[b], flush(b) if b in pending else None
            need = np.union1d(touched.get(b, np.zeros(0, np.int64)), span["k"][again[span["k"]]]).astype(np.int64)
            if len(need):
                rows = self._bucket(b) if rows is None else rows
                mine = np.isin(rows["k"], need)
                part = rows[mine]
                result, after = advance(part, carry, *self.limits)
                changed = ~part["sent"]
                for name, value in result.items():
                    changed |= _differs(part[name], value)
                    part[name] = value
                part["sent"] = True
                rows[mine] = part
                self._put(b, rows)
                after["b"] = b
                known = np.searchsorted(span["k"], after["k"])
                new = np.ones(len(after), bool)
                if len(span):
                    before = span[np.minimum(known, len(span) - 1)]
                    new = before["k"] != after["k"]
                    for name in FIELDS:
                        new |= _differs(before[name], after[name])
                again[after["k"]] = new
                span = np.concatenate([span[~np.isin(span["k"], need)], after])
                spans[b] = span = span[np.argsort(span["k"])]
                if changed.any():
                    yield self._frame(part[changed], False)
            for name in FIELDS:
                carry[name][span["k"]] = span[name]
        self.spans = np.concatenate([np.zeros(0, SPAN), *spans.values()])

    def _forget(self, old: np.ndarray) -> None:
        """Drop the spans of a mask with their rows; the keys' carries move to the end of the last dropped one."""
        dropped, self.spans = self.spans[old], self.spans[~old]
        for b in np.unique(dropped["b"]).tolist():
            live = self.spans["k"][self.spans["b"] == b]
            if len(live):
                rows = self._bucket(b)
                self._put(b, rows[np.isin(rows["k"], live)])
            else:
                self.buckets.removeKey((b,))
        dropped = dropped[np.lexsort((dropped["b"], dropped["k"]))]
        self.gone = dropped[np.concatenate([dropped["k"][1:] != dropped["k"][:-1], [True]])]
        for name in FIELDS:
            self.keys[name][self.gone["k"]] = self.gone[name]

    def _next_timer(self) -> None:
        seen = self.keys["seen"][self.keys["seen"] >= 0]
        if len(seen):
            self.handle.registerTimer(int(seen.min()) + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._load()
        idle = (self.keys["seen"] >= 0) & (self.keys["seen"] + self.idle_ms <= expiredTimerInfo.getExpiryTimeInMs())
        old = idle[self.spans["k"]]
        if old.any():
            self._forget(old)
        self.keys["horizon"][idle] = np.nextafter(self.keys["newest"][idle], np.inf)
        self.keys["seen"][idle] = -1
        self._save()
        self._next_timer()
        yield from ()


def stream_zone_speed(zoned: DataFrame, gap: float = 10.0, min_t: float = 0.1, max_t: float = 10.0, keep_seconds: float = 86_400.0,
                      idle_ms: int | None = None, bucket_seconds: float = 300.0, slots: int = 512) -> DataFrame:
    """``zoned`` is a stream of (object_id, zone_name, event_id, ts, t, inside,
    length_m); without a watermark Spark drops none of it.  ``keep_seconds`` is on
    the scale of ``t``, ``idle_ms`` is wall time.  A call holds the touched time
    buckets of the keys of one of ``slots``; a checkpoint keeps their number."""
    spark = zoned.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)  # what map states and timers need
    object_id = F.col("object_id").cast("long")
    # No nulls in the whole numbers: a frame of pandas would make them doubles.
    rows = zoned.select(F.pmod(F.xxhash64("object_id", "zone_name"), F.lit(slots)).cast("int").alias("slot"),
                        F.coalesce(object_id, F.lit(0)).alias("object_id"), object_id.isNull().alias("no_object"), "zone_name",
                        F.coalesce(F.col("event_id").cast("long"), F.lit(-(1 << 63))).alias("event_id"), "ts", "t", "inside", "length_m")
    return rows.groupBy("slot").transformWithStateInPandas(
        ZoneProcessor(gap, min_t, max_t, keep_seconds, idle_ms, bucket_seconds), OUT_SCHEMA, "Update", "None" if idle_ms is None else "ProcessingTime")


def latest(sent: DataFrame) -> DataFrame:
    """Each row's last revision, without the expired rows."""
    kept = sent.filter(~F.col("expired"))
    w = Window.partitionBy("object_id", "zone_name", "event_id", "ts").orderBy(F.col("revision").desc())
    return kept.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n", "expired")


def expired(sent: DataFrame) -> DataFrame:
    """The side output: rows that came after their part of the state was gone."""
    return sent.filter("expired").select("object_id", "zone_name", "event_id", "ts").distinct()
