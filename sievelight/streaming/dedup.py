"""Replay dedup over streams: every landed row comes out once, with an outcome.

* ``judge_ttl``: the time-to-live rule of ``operators.dedup.dedup_ttl``, in event time. A copy waits, in keyed state under its
  instant, until the watermark has passed it; then the copies of an id are judged in the order of their times. The result
  is that of the batch job for every order of arrival within ``delay``.
* ``judge_replays``: the first copy of an id to arrive is accepted at once, its state goes with the watermark.

Outcomes: ``accepted``, ``duplicate``, and ``late`` for a row behind the watermark, which can not be judged any more: a
backfill judges it through the batch job. Rows without an id are always accepted, and spread by a salt. ``dedup_ttl_stream`` and
``dedup_watermark`` are the accepted rows alone. All need the RocksDB state store (``ROCKSDB``) in the caller's session but
``dedup_watermark``, which is Spark's own ``dropDuplicatesWithinWatermark``: there late rows are dropped by the engine.

Event time reaches the operator without its watermark mark, or the engine would drop late rows before they are seen. The
watermark itself is the query's, as usual.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ACCEPTED, DUPLICATE, LATE = "accepted", "duplicate", "late"
#: Tasks that rows without an id are dealt to, and the grain of timers.
SALTS, TIMER_MS = 64, 1000
#: New instants of an id that are held in memory before they go to its state.
CHUNK = 4096


def _has_id(id_col: str) -> Column:
    return F.coalesce(F.col(id_col), F.lit("")) != ""


def dedup_watermark(stream: DataFrame, keys: list[str], ts: str = "received_at", delay: str = "1 day") -> DataFrame:
    rows = stream.withWatermark(ts, delay)
    named = _has_id(keys[-1])
    return rows.where(named).dropDuplicatesWithinWatermark(keys).unionByName(rows.where(~named))


class _Judge(StatefulProcessor):
    """Rows end with the columns ``_named, _tie, _t``: has an id, tie breaker, micros. Results are rows and their outcome."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", T.StructType([T.StructField("last", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[tuple], timerValues) -> Iterator[tuple]:
        watermark = timerValues.getCurrentWatermarkInMs()
        for row in rows:
            row, (named, tie, micros) = row[:-3], row[-3:]
            if not named:
                yield (*row, ACCEPTED)
            elif micros is None or micros // 1000 < watermark:
                yield (*row, LATE)
            else:
                yield from self._arrive(row, tie, micros)
        yield from self._arrived()

    def _arrived(self) -> Iterator[tuple]:
        """After the last row of an id in a batch."""
        return iter([])

    def _when(self, ms: int) -> None:
        self._handle.registerTimer((ms // TIMER_MS + 1) * TIMER_MS)

    def _last_micros(self) -> int | None:
        return self._last.get()[0] if self._last.exists() else None

    def close(self) -> None:
        pass


class TtlJudge(_Judge):
    """Keyed by delivery id: a copy is accepted when it is more than ``ttl`` after the last accepted one."""

    # Every call of the state is a round trip to the JVM: a new id costs one a row, and what has passed leaves in bulk.

    def __init__(self, ttl_seconds: int) -> None:
        self._ttl, self._judged, self._new = ttl_seconds * 1_000_000, None, {}

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self._waiting = handle.getMapState(
            "waiting", T.StructType([T.StructField("t", T.LongType())]),
            T.StructType([T.StructField("tie", T.BinaryType()), T.StructField("row", T.BinaryType())]))

    def _arrive(self, row: tuple, tie, micros: int) -> Iterator[tuple]:
        """One row per instant waits, that of the least tie breaker; the others of the instant are duplicates."""
        if micros in self._new:
            other_tie, other = self._new[micros]
            if not _before(tie, other_tie):
                yield (*row, DUPLICATE)
                return
            yield (*other, DUPLICATE)
        self._new[micros] = (tie, row)
        if len(self._new) >= CHUNK:
            yield from self._arrived()

    def _arrived(self) -> Iterator[tuple]:
        new, self._new = self._new, {}
        if not new:
            return
        known = self._waiting.exists()
        for micros, (tie, row) in new.items():
            if known and self._waiting.containsKey((micros,)):
                other_tie, other = (pickle.loads(x) for x in self._waiting.getValue((micros,)))
                if not _before(tie, other_tie):
                    yield (*row, DUPLICATE)
                    continue
                yield (*other, DUPLICATE)
            self._waiting.updateValue((micros,), (pickle.dumps(tie), pickle.dumps(row)))
        self._when(min(new) // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[tuple]:
        watermark = timerValues.getCurrentWatermarkInMs()
        if self._judged == (key, watermark):  # another timer of the key in this batch
            return
        self._judged = (key, watermark)
        last = before = self._last_micros()
        passed, later = [], None
        for (t,) in self._waiting.keys():
            if t // 1000 < watermark:
                passed.append(t)
            else:
                later = t if later is None else min(later, t)
        accepted = set()
        for t in sorted(passed):
            if last is None or t - last > self._ttl:
                last = t
                accepted.add(t)
        if passed:
            for (t,), (_, row) in self._waiting.iterator():
                if t // 1000 < watermark:
                    yield (*pickle.loads(row), ACCEPTED if t in accepted else DUPLICATE)
            if later is None:
                self._waiting.clear()
            else:
                for t in passed:
                    self._waiting.removeKey((t,))
        if later is not None:
            self._when(later // 1000)  # one timer stands for all that wait: that of the first
        if last is None:
            return
        if (last + self._ttl) // 1000 < watermark and later is None:
            self._last.clear()  # no copy that can still come is within its window
        elif last != before:
            self._last.update((last,))
            self._when((last + self._ttl) // 1000)


class ReplayJudge(_Judge):
    """Keyed by delivery id: the first copy to arrive is accepted, until the watermark passes it by ``window``."""

    def __init__(self, window_ms: int) -> None:
        self._window = window_ms

    def _arrive(self, row: tuple, tie, micros: int) -> Iterator[tuple]:
        if self._last.exists():
            yield (*row, DUPLICATE)
            return
        self._last.update((micros,))
        self._when(micros // 1000 + self._window)
        yield (*row, ACCEPTED)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[tuple]:
        last = self._last_micros()
        if last is not None and last // 1000 + self._window < timerValues.getCurrentWatermarkInMs():
            self._last.clear()
        return iter([])


def _before(a, b) -> bool:
    """Nulls come first, as in Spark's order."""
    return b is not None and (a is None or a < b)


def _judged(stream: DataFrame, processor: StatefulProcessor, keys: list[str], ts: str, tiebreak: str | None, delay: str,
            passed: Column | None = None, spread: Column | None = None) -> DataFrame:
    columns = stream.columns
    named = _has_id(keys[-1]) if passed is None else _has_id(keys[-1]) & passed
    by = [F.col(ts), *([] if tiebreak is None else [F.col(tiebreak)]), *([] if spread is None else [spread])]
    salt = F.when(named, F.lit(0)).otherwise(F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))
    rows = stream.withWatermark(ts, delay).select(
        *[F.col(c) if c != ts else F.timestamp_micros(F.unix_micros(ts)).alias(ts) for c in columns], salt.alias("_salt"),
        named.alias("_named"), (F.lit(None).cast("int") if tiebreak is None else F.col(tiebreak)).alias("_tie"), F.unix_micros(ts).alias("_t"))
    schema = T.StructType([*stream.schema.fields, T.StructField("outcome", T.StringType())])
    packed = rows.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], "_salt", *columns, "_named", "_tie", "_t")
    return packed.groupBy(*[f"_key_{i}" for i in range(len(keys))], "_salt").transformWithState(
        _Unkeyed(processor, len(keys) + 1, schema.names), schema, "Append", "EventTime")


class _Unkeyed(StatefulProcessor):
    """Hands plain rows without the grouping columns in front to a judge, and names what it returns."""

    def __init__(self, judge: _Judge, keys: int, names: list[str]) -> None:
        self._judge, self._keys, self._row = judge, keys, Row(*names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._judge.init(handle)

    def handleInputRows(self, key, rows, timerValues):
        return (self._row(*x) for x in self._judge.handleInputRows(key, (tuple(r)[self._keys:] for r in rows), timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return (self._row(*x) for x in self._judge.handleExpiredTimer(key, timerValues, expiredTimerInfo))

    def close(self) -> None:
        self._judge.close()


def judge_ttl(stream: DataFrame, keys: list[str], ts: str, tiebreak: str, ttl_seconds: int = 86_400, delay: str = "1 day") -> DataFrame:
    """All rows with an ``outcome`` by the time-to-live rule; exact for rows at most ``delay`` late.

    A row comes out when the watermark has passed it. State holds one row per distinct instant of the last ``delay`` and
    one timestamp per id seen within ttl + delay. Close a backfill with a row without an id in the far future.
    """
    return _judged(stream, TtlJudge(ttl_seconds), keys, ts, tiebreak, delay)


def judge_replays(stream: DataFrame, keys: list[str], ts: str = "received_at", delay: str = "1 day", window_seconds: int = 86_400,
                  passed: Column | None = None, spread: Column | None = None) -> DataFrame:
    """All rows with an ``outcome``: the first copy of an id to arrive is accepted, copies within ``window_seconds`` of it are not.

    Rows for which ``passed`` does not hold are not judged and come out as accepted; ``spread`` helps the time to deal them out.
    """
    return _judged(stream, ReplayJudge(window_seconds * 1000), keys, ts, None, delay, passed, spread)


def dedup_ttl_stream(
    stream: DataFrame, keys: list[str], ts: str, tiebreak: str, ttl_seconds: int = 86_400, delay: str = "1 day"
) -> DataFrame:
    """The accepted rows of ``judge_ttl``; output columns are the input's."""
    return judge_ttl(stream, keys, ts, tiebreak, ttl_seconds, delay).where(F.col("outcome") == ACCEPTED).drop("outcome")
