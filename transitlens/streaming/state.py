"""Keyed state: the last N report times per vehicle (ST6, A4).

State per vehicle is at most N ``(lastupdate, seq)`` pairs.  A report enters
when the buffer is not full or when it is newer than the oldest kept one,
which then leaves; each admitted report emits the buffer's mean gap.  In
event-time order this equals the batch rows frame of ``gaps.gap_per_vehicle``.

A vehicle's rows of a micro-batch come in Arrow batches (10,000 rows by
default) in any order.  All of them are sorted together by event time, so the
result does not depend on the batch size; a report takes 16 bytes until then.
``merges.last_n_per_vehicle_writer`` gives the same without holding a vehicle's
micro-batch in one task.

Two forms: ``last_n_per_vehicle_stream`` keeps one state row per vehicle with
``applyInPandasWithState``; ``last_n_per_vehicle_listed`` keeps a list of times
per vehicle with ``transformWithStateInPandas`` (RocksDB provider, see
``runner.keyed_state``), so that a micro-batch reads and writes the states of the
vehicles that it touches only, and may forget a vehicle after a time of silence.
There a key costs several calls and frames, so the key is a group of vehicles
(by hash), and a vehicle's list is an entry of the group's map state.
"""

from __future__ import annotations

import bisect
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from ..operators.filters import active
from ..schema import LAST_N

GAP_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("seq", LongType()),
        StructField("lastupdate", LongType()),
        StructField("n", LongType()),
        StructField("span_ms", LongType()),
        StructField("gap_ms", DoubleType()),
    ]
)
#: rows of a frame handed on
OUT_ROWS = 10_000
#: groups of vehicles; part of what a checkpoint holds
VEHICLE_GROUPS = 512
_DTYPES = {"id": "object", "seq": "int64", "lastupdate": "int64", "n": "int64", "span_ms": "int64", "gap_ms": "float64"}
STATE_SCHEMA = StructType([StructField("times", ArrayType(LongType())), StructField("seqs", ArrayType(LongType()))])


def _frame(out: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({f.name: pd.Series(c, dtype=_DTYPES[f.name]) for f, c in zip(GAP_SCHEMA.fields, zip(*out))})


def _admitted_rows(vehicle, times: np.ndarray, seqs: np.ndarray, buf: list[tuple[int, int]], n: int):
    """The gap of each report that enters ``buf`` (sorted, changed in place), for
    all of a vehicle's reports of a micro-batch."""
    order = np.lexsort((seqs, times))
    for first in range(0, len(order), OUT_ROWS):
        part = order[first : first + OUT_ROWS]
        for t, s in zip(times[part].tolist(), seqs[part].tolist()):
            item = (t, s)
            if len(buf) >= n:
                if item <= buf[0]:
                    continue
                buf.pop(0)
            bisect.insort(buf, item)
            if len(buf) > 1:
                span = buf[-1][0] - buf[0][0]
                yield (vehicle, s, t, len(buf), span, span / (len(buf) - 1))


def _frames(rows):
    """Rows in frames of OUT_ROWS."""
    while out := list(islice(rows, OUT_ROWS)):
        yield _frame(out)


def _admitted(vehicle, parts: list[tuple[np.ndarray, np.ndarray]], buf: list[tuple[int, int]], n: int):
    """Frames of ``_admitted_rows`` of a vehicle's ``(times, seqs)``."""
    t_all, s_all = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 2
    yield from _frames(_admitted_rows(vehicle, t_all, s_all, buf, n))


def _times(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return rows["lastupdate"].to_numpy(np.int64), rows["seq"].to_numpy(np.int64)


def _buffer_update(n: int):
    def update(key, batches, state):
        buf = sorted(zip(*state.get)) if state.exists else []
        yield from _admitted(key[0], [_times(rows) for rows in batches], buf, n)
        state.update(([t for t, _ in buf], [s for _, s in buf]))

    return update


class LastTimes(StatefulProcessor):
    """The last ``n`` report times of each vehicle of a group, a list per vehicle
    in a map state; ``forget_ms`` after its last report a vehicle's list is
    dropped (processing time)."""

    def __init__(self, n: int, forget_ms: int | None):
        self.n, self.forget_ms = n, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.times = handle.getMapState("times", "id string", "times array<long>, seqs array<long>", self.forget_ms)

    def _gaps(self, id_: np.ndarray, t: np.ndarray, s: np.ndarray):
        code, vehicles = pd.factorize(id_, use_na_sentinel=False)
        order = np.argsort(code, kind="stable")
        ends = np.cumsum(np.bincount(code, minlength=len(vehicles)))
        for vehicle, mine in zip(vehicles, np.split(order, ends[:-1])):
            vehicle = None if pd.isna(vehicle) else vehicle
            kept = self.times.getValue((vehicle,))
            buf = [] if kept is None else sorted(zip(*kept))
            yield from _admitted_rows(vehicle, t[mine], s[mine], buf, self.n)
            self.times.updateValue((vehicle,), ([x for x, _ in buf], [x for _, x in buf]))

    def handleInputRows(self, key, rows, timerValues):
        parts = [(pdf["id"].to_numpy(object), *_times(pdf)) for pdf in rows]
        yield from _frames(self._gaps(*(np.concatenate(x) for x in zip(*parts))))

    def close(self) -> None:
        pass


def last_n_per_vehicle_listed(reports: DataFrame, n: int = LAST_N, forget_ms: int | None = None) -> DataFrame:
    """The same stream of gaps over a list of times per vehicle; run it inside
    ``runner.keyed_state``."""
    a = active(reports).select("id", "seq", "lastupdate", F.pmod(F.xxhash64("id"), F.lit(VEHICLE_GROUPS)).alias("vehicles"))
    mode = "None" if forget_ms is None else "ProcessingTime"
    return a.groupBy("vehicles").transformWithStateInPandas(LastTimes(n, forget_ms), GAP_SCHEMA, "Append", mode)


def last_n_per_vehicle_stream(reports: DataFrame, n: int = LAST_N) -> DataFrame:
    """Stream of ``(id, seq, lastupdate, n, span_ms, gap_ms)`` per admitted report."""
    a = active(reports).select("id", "seq", "lastupdate")
    return a.groupBy("id").applyInPandasWithState(
        _buffer_update(n), GAP_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )
