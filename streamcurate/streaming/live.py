"""The checks on live feeds (T1 to T5), by Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators import integrity as ig
from ..operators import normalize as nz
from ..operators import qc
from ..specs import SensorSpec


def plausible(spec: SensorSpec) -> list[Column]:
    """The checks of a sensor that need no other record."""
    out = ig.non_finite(spec.of_type("float", "integer")) + ig.extremes(spec.limits)
    return out + (ig.lat_lon_range() + ig.negative_speed() if spec.name == "gps" else [])


def validate_normalize(stream: DataFrame, spec: SensorSpec, units: dict[str, str], good: Callable[[DataFrame, int], None], bad: Callable[[DataFrame, int], None]):
    """A writer that sends each micro-batch's normalized records to `good` and the others to `bad`.

    Records that an integrity check without memory (C1 to C5) calls an error go to `bad` too, with the
    field that is to blame; warnings stay.
    """

    def batch(df: DataFrame, number: int) -> None:
        df.persist()
        try:
            fine, rest = nz.normalize(df, spec, units, on_error="quarantine")
            errors = F.filter(F.array(*plausible(spec)), lambda x: x["severity"] == "error")
            judged = fine.withColumn("_fault", F.get(errors, F.lit(0))["field"])
            good(judged.where("_fault is null").drop("_fault"), number)
            faulty = judged.where("_fault is not null").select("record_number", F.col("_fault").alias("_field"))
            bad(rest.unionByName(df.join(faulty, "record_number").withColumn("bad_field", F.col("_field")).select(*rest.columns)), number)
        finally:
            df.unpersist()

    return stream.writeStream.foreachBatch(batch)


def order_check(stream: DataFrame) -> DataFrame:
    """Issues of records that go back or stand still in time, in order of arrival.

    State: the last time of a (session, stream).  Spark brings a group's rows of one micro-batch in any order, so they
    are put in that of their record numbers first; they are held at once, as two columns.
    """

    def run(key, parts, state):
        rows = pd.concat([p[["record_number", "epoch_us"]] for p in parts], ignore_index=True).sort_values("record_number", kind="stable")
        at = rows["epoch_us"].to_numpy()
        if not state.exists:
            before = np.concatenate((at[:1] - 1, at[:-1]))  # the first record has none before it
        else:
            before = np.concatenate((np.array(state.get, at.dtype), at[:-1]))
        state.update((int(at[-1]),))
        found = at <= before
        if found.any():
            codes = np.where(at < before, "TIMESTAMP_OUT_OF_ORDER", "DUPLICATE_TIMESTAMP")
            yield pd.DataFrame({"session_id": key[0], "stream": key[1], "record": rows["record_number"].to_numpy()[found], "code": codes[found]})

    groups = stream.select("session_id", "stream", "record_number", "epoch_us").groupBy("session_id", "stream")
    return groups.applyInPandasWithState(run, "session_id string, stream string, record long, code string", "epoch_us long", "append", GroupStateTimeout.NoTimeout)


def dedup(stream: DataFrame, time: str, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """Copies inside the watermark go."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def time_windows(stream: DataFrame, time: str, fields: list[str], duration: str, stride: str, delay: str) -> DataFrame:
    """T4: statistics per session over epoch-anchored windows."""
    w = F.window(time, duration, stride)
    stats = [getattr(F, f)(c).alias(f"{c}_{n}") for c in fields for n, f in (("mean", "avg"), ("std", "stddev_pop"), ("min", "min"), ("max", "max"))]
    out = stream.withWatermark(time, delay).groupBy("session_id", w).agg(F.count("*").alias("row_count"), *stats)
    return out.select("session_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "row_count", *(c for c in out.columns if c not in ("session_id", "window", "row_count")))


class AnchoredWindows:
    """State of a bucket of sessions: each one's first and last time, and counts and moments of its open windows, as arrays.

    A window is a partial result (session, k, row_count, and n, mean, m2, low, high of each field); so is a row for each
    of its windows, and partial results of one window add up.
    """

    def __init__(self, time: str, fields: list[str], duration: int, stride: int):
        self.time, self.fields, self.duration, self.stride = time, fields, duration, stride
        self.kinds = [np.int64] * 3 + [np.int64, float, float, float, float] * len(fields)
        moments = "".join(f", n{i} array<long>, mean{i} array<double>, m2{i} array<double>, low{i} array<double>, high{i} array<double>" for i in range(len(fields)))
        self.state = f"names array<string>, first array<long>, last array<long>, session array<long>, k array<long>, row_count array<long>{moments}"

    def __call__(self, key, parts, state):
        names, first, last, *windows = state.get if state.exists else [[]] * (3 + len(self.kinds))
        names, first, last = list(names), np.array(first, np.int64), np.array(last, np.int64)
        windows = [np.array(x, kind) for x, kind in zip(windows, self.kinds, strict=True)]
        closed_to, known = state.getCurrentWatermarkMs() * 1000, len(names)
        if not state.hasTimedOut:
            rows = pd.concat(list(parts), ignore_index=True)
            at = rows[self.time].astype("datetime64[us]").astype("int64").to_numpy()
            code, found = pd.factorize(rows["session_id"], use_na_sentinel=False)
            place = {name: i for i, name in enumerate(names)}
            session = np.array([place.setdefault(None if pd.isna(x) else x, len(place)) for x in found])[code]
            names = list(place)
            low, high = np.full(len(names), np.iinfo(np.int64).max), np.full(len(names), np.iinfo(np.int64).min)
            np.minimum.at(low, session, at)
            np.maximum.at(high, session, at)
            first, last = np.concatenate((first, low[known:])), np.maximum(np.concatenate((last, high[known:])), high)
            windows, held = self.added(windows, self.of_rows(rows, session, at - first[session]))
            # windows that the watermark has closed take no more
            ends = self.ends(first, windows)
            windows = [x[held | (windows[0] >= known) | (ends > closed_to)] for x in windows]
        # the windows that the watermark has passed and a row of the session has closed
        ends = self.ends(first, windows)
        ripe = ends <= last[windows[0]]
        done = ripe & (ends <= closed_to)
        if done.any():
            yield self.result(names, ends[done], [x[done] for x in windows])
        if (ripe & ~done).any():
            state.setTimeoutTimestamp(int(ends[ripe & ~done].min()) // 1000 + 1)
        state.update((names, first.tolist(), last.tolist(), *(x[~done].tolist() for x in windows)))

    def ends(self, first, windows):
        return first[windows[0]] + windows[1] * self.stride + self.duration

    def of_rows(self, rows, session, since):
        low = np.maximum(0, (since - self.duration) // self.stride + 1)
        high = since // self.stride
        # each row's windows are few, however far apart rows are; rows before the first one are in none
        reach = low[:, None] + np.arange(max(0, int((high - low).max())) + 1)
        row, column = np.nonzero(reach <= high[:, None])
        out = [session[row], reach[row, column], np.ones(len(row), np.int64)]
        for f in self.fields:
            v = pd.to_numeric(rows[f]).to_numpy(float)[row]
            there = ~np.isnan(v)
            out += [there.astype(np.int64), np.where(there, v, 0.0), np.zeros(len(v)), np.where(there, v, np.inf), np.where(there, v, -np.inf)]
        return out

    def added(self, held, new):
        """Both as one partial result for each window, and which windows were among the held ones."""
        every = [np.concatenate(x) for x in zip(held, new, strict=True)]
        if not len(every[0]):
            return every, np.zeros(0, bool)
        order = np.lexsort((every[1], every[0]))
        session, k, count, *moments = (x[order] for x in every)
        at = np.concatenate(([0], np.flatnonzero((np.diff(session) != 0) | (np.diff(k) != 0)) + 1))
        sizes = np.diff(np.concatenate((at, [len(k)])))
        out = [session[at], k[at], np.add.reduceat(count, at)]
        for i in range(0, len(moments), 5):
            n, mean, m2, low, high = moments[i : i + 5]
            total = np.add.reduceat(n, at)
            centre = np.add.reduceat(n * mean, at) / np.maximum(total, 1)
            out += [total, centre, np.add.reduceat(m2 + n * (mean - np.repeat(centre, sizes)) ** 2, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)]
        return out, np.logical_or.reduceat(order < len(held[0]), at)

    def result(self, names, ends, windows):
        out = {"session_id": np.array(names, object)[windows[0]], "k": windows[1], "start_us": ends - self.duration, "end_us": ends, "row_count": windows[2]}
        for i, f in enumerate(self.fields):
            n, mean, m2, low, high = windows[3 + 5 * i : 8 + 5 * i]
            for s, v in {"mean": mean, "std": np.sqrt(m2 / np.maximum(n, 1)), "min": low, "max": high}.items():
                out[f"{f}_{s}"] = pd.Series(v).astype(object).where(n > 0, None) if (n == 0).any() else v
        return pd.DataFrame(out)


def anchored_windows(stream: DataFrame, time: str, fields: list[str], duration_ms: float, stride_ms: float, delay: str, buckets: int = 256) -> DataFrame:
    """T4 with the windows of W2: half-open windows from each session's first row on, by state and an event-time timer.

    A window comes once the watermark has passed its end and a row of the session lies at or after it, so for
    rows in order the windows are those that W2 keeps when it drops incomplete ones.  Defined otherwise: rows before the
    session's first row are in no window, rows later than the watermark allows are dropped, and the first row is the
    earliest of the session's first micro-batch.  Sessions share `buckets` states, so that a micro-batch calls
    Python once per bucket and not once per session; a bucket's rows of one micro-batch are held at once.
    """
    stats = "".join(f", `{f}_{s}` double" for f in fields for s in ("mean", "std", "min", "max"))
    work = AnchoredWindows(time, fields, int(duration_ms * 1000), int(stride_ms * 1000))
    rows = stream.withWatermark(time, delay).select("session_id", time, *fields, F.pmod(F.xxhash64("session_id"), F.lit(buckets)).alias("_bucket"))
    shape = f"session_id string, k long, start_us long, end_us long, row_count long{stats}"
    return rows.groupBy("_bucket").applyInPandasWithState(work, shape, work.state, "append", GroupStateTimeout.EventTimeTimeout)


def qc_profile(stream: DataFrame, columns: list[str], baseline: DataFrame, sink: Callable[[DataFrame, int], None]):
    """T5: a writer that sends each micro-batch's profile and drift against a fixed baseline to `sink`."""

    def batch(df: DataFrame, number: int) -> None:
        profile = qc.feature_profile(qc.long_form(df, columns), percentiles=True)
        sink(profile.join(qc.drift(profile, baseline), "path"), number)

    return stream.writeStream.foreachBatch(batch)


def running_profile(stream: DataFrame, columns: list[str], folder: str, sink: Callable[[DataFrame, int], None], baseline: DataFrame | None = None):
    """T5: a writer that sends `sink` the profile of all rows so far after each micro-batch, with drift against a baseline if there is one.

    A batch adds its counts, moments and quantile sketches to those of the batches before it, which lie in `folder`
    under the last batch's number.  A batch that runs again starts from the same state, so nothing counts
    twice; only the last two states are kept.  The folder belongs to the query as its checkpoint does.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
        done = sorted(int(n.removeprefix("batch-")) for n in names if n.startswith("batch-") and int(n.removeprefix("batch-")) < number)
        state = qc.mergeable_profile(qc.long_form(df, columns))
        if done:
            state = qc.merged_profiles(spark.read.parquet(f"{folder}/batch-{done[-1]}"), state)
        state.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch-{number}")
        for old in done[:-1]:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch-{old}"), True)
        profile = qc.profile_of(spark.read.parquet(f"{folder}/batch-{number}"))
        sink(profile if baseline is None else profile.join(qc.drift(profile, baseline), "path"), number)

    return stream.writeStream.foreachBatch(batch)


__all__ = ["AnchoredWindows", "anchored_windows", "dedup", "order_check", "plausible", "qc_profile", "running_profile", "time_windows", "validate_normalize"]
