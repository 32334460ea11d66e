"""The incremental forms: known rows dropped, failures counted, changes written batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.query import StreamingQuery


def look_back(days: int) -> int:
    """For how many days an address counts as known: twice the days asked for, 30 at least."""
    return max(2 * days, 30)


def first_seen(stream: DataFrame, key: str, time: str, days: int) -> DataFrame:
    """A stream's rows without those whose key came within the look-back; state is dropped as the watermark passes it, later rows are too late."""
    return stream.withWatermark(time, f"{look_back(days)} days").dropDuplicatesWithinWatermark([key])


def counts_by_window(stream: DataFrame, time: str, by: list[str], late: str = "1 day", width: str = "7 days") -> DataFrame:
    """``window_start, by..., n``: rows by event-time window, up to ``late`` after the newest."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")


STATE = "older bigint, ok_at bigint, ok_nr bigint, ats array<bigint>, nrs array<bigint>"


def failure_runs(events: DataFrame, source: str, failed: F.Column, time: str, order: str, late: str = "30 days") -> DataFrame:
    """``source, consecutive_failures``, updated with each batch: the failures after a source's last success, by time and the whole number ``order``.

    Events may come in any order up to ``late`` after the newest; those still later are left out. The state is the last success, the failures after
    it that the watermark hasn't passed, by time, and the number of those it has; batches are folded a piece at a time, so no frame holds a source.
    """

    def after(ats, nrs, at, nr):
        return (ats > at) | ((ats == at) & (nrs > nr))

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = max(0, state.getCurrentWatermarkMs()) * 1000
        older, at, nr, ats, nrs = state.get if state.exists else (0, -(2**63), -(2**63), [], [])
        ats, nrs = np.array(ats, "int64"), np.array(nrs, "int64")
        for b in batches:
            b = b[b["us"] >= mark]
            ok = b[~b["failed"]]
            if len(ok):
                new = max(zip(ok["us"], ok["nr"]))
                if new > (at, nr):
                    at, nr, older = int(new[0]), int(new[1]), 0
            bad = b[b["failed"]]
            ats, nrs = np.concatenate([ats, bad["us"].to_numpy("int64")]), np.concatenate([nrs, bad["nr"].to_numpy("int64")])
            kept = after(ats, nrs, at, nr)
            ats, nrs = ats[kept], nrs[kept]
        passed = ats < mark
        older += int(passed.sum())
        ats, nrs = ats[~passed], nrs[~passed]
        state.update((older, at, nr, ats.tolist(), nrs.tolist()))
        yield pd.DataFrame({"source": [key[0]], "consecutive_failures": [older + len(ats)]})

    rows = events.withWatermark(time, late).where(F.col(time).isNotNull()).select(F.col(source).cast("string").alias("source"), F.coalesce(failed, F.lit(False)).alias("failed"), F.unix_micros(time).alias("us"), F.coalesce(F.col(order).cast("bigint"), F.lit(0)).alias("nr"), time)
    return rows.groupBy("source").applyInPandasWithState(fold, "source string, consecutive_failures bigint", STATE, "update", GroupStateTimeout.NoTimeout)


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run a stream over what is there now and stop; ``each`` commits a batch before the checkpoint moves on, so a batch may come again after a failure."""
    q = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
