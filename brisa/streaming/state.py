"""Weighted mean of the last hours with keyed state: sums per hour of each series, expired by event-time timers.

A low-latency companion of :func:`brisa.streaming.jobs.nowcast`: no table of readings is read in a batch.
State holds the hours that can still matter, so a reading corrects what was given out as long as it comes
within ``late`` hours; what comes later is the table job's.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_EVEN, Decimal

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from brisa.functions import air
from brisa.operators import panel
from brisa.sources import sinks
from brisa.streaming.jobs import NOWCAST_OUT, _each_batch, _part, _table


def _processor(factor: float, hours: int, late: int, expire: int):
    """Processor of one series; a local class, so that it travels to the workers by value."""
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    def weighted(values: list[float]) -> float | None:
        if len(values) < 3:
            return None
        top = max(values)
        # half to even on the decimal that is written, as the column expression rounds
        w = max(float(Decimal(repr(min(values) / top)).quantize(Decimal("0.01"), ROUND_HALF_EVEN)) if top else 0.0, 0.5)
        return sum(x * w ** k for k, x in enumerate(values)) / sum(w ** k for k in range(len(values))) * factor

    class LastHours(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.hours = handle.getMapState("hours", "h bigint", "s double, n bigint")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            have = {k[0]: tuple(v) for k, v in self.hours.iterator()}
            new: set[int] = set()
            for pdf in rows:
                for h, s, n in pdf.groupby("h")["val"].agg(["sum", "count"]).itertuples():
                    old = have.get(int(h), (0.0, 0))
                    have[int(h)] = (old[0] + float(s), old[1] + int(n))
                    new.add(int(h))
            if not new:
                return
            top = max(have)
            touched = sorted({h + k for h in new for k in range(hours)} & set(have))
            means = {h: s / n for h, (s, n) in have.items()}
            out = [(h, weighted([means[x] for x in range(h - hours + 1, h + 1) if x in means])) for h in touched]
            for h in [h for h in have if h <= top - late - hours]:
                if self.hours.containsKey((h,)):
                    self.hours.removeKey((h,))
                new.discard(h)
            for h in new:
                self.hours.updateValue((h,), have[h])
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t[0] if isinstance(t, tuple) else t)
            self.handle.registerTimer((top + expire) * 3_600_000)
            yield pd.DataFrame({"pollutant": key[0], "id_est": key[1], "h": [h for h, _ in out], "nowcast": pd.Series([x for _, x in out], dtype="float64")})

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            self.hours.clear()
            return iter([])

        def close(self) -> None:
            pass

    return LastHours()


def nowcast_state(stream: DataFrame, path: str, checkpoint: str, pollutant: str = "PM10", hours: int = 12, late: int = 12, expire: int = 48) -> DataFrame:
    """As :func:`jobs.nowcast` for readings that come within ``late`` hours of their series' newest one.

    ``stream``: (pollutant, id_est, ts, h, val). A series keeps ``hours + late`` sums; a timer drops them
    once the watermark is ``expire`` hours past its last reading. Results of a batch replace those of the
    same hour given out before.
    """
    marked = stream.filter(F.col("val").isNotNull()).withWatermark("ts", f"{late} hours")
    out = marked.groupBy(*panel.SERIES).transformWithStateInPandas(_processor(air.NOWCAST_FACTOR[pollutant], hours, late, expire), NOWCAST_OUT, "Update", "EventTime")

    def write(batch: DataFrame, _id: int) -> None:
        sinks.upsert_table(batch.sparkSession, path, batch.withColumn("part", _part(F.col("h"))), [*panel.SERIES, "h"], "part")

    _each_batch(out, checkpoint, write, "update")
    return _table(stream.sparkSession, path, NOWCAST_OUT + ", part bigint").drop("part")
