"""Alignment of independently clocked streams.

All streams and the targets are one table; one exchange by session and one sort per direction serve
any number of streams.  A long session can be cut into time buckets: tasks then get a bucket each,
and what a bucket needs from beyond its ends comes from a scan over one summary row per bucket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import last_before

#: Rows of one session that a sort task may take.
SESSION_ROWS = 100_000
#: Ticks of a fixed rate that one row makes.
TICKS = 100_000


def to_stream(df: DataFrame, fields: list[str]) -> DataFrame:
    """session_id, record_number, epoch_us, payload; numbers become double."""
    kinds = dict(df.dtypes)
    number = ("int", "bigint", "float", "double", "smallint", "tinyint")
    payload = F.struct(*(F.col(f).cast("double").alias(f) if kinds[f] in number or kinds[f].startswith("decimal") else F.col(f) for f in fields))
    return df.select("session_id", "record_number", "epoch_us", payload.alias("payload"))


def disorder(stream: DataFrame) -> DataFrame:
    """Records whose time lies before the one before; empty for a monotonic stream."""
    return last_before(stream, ["session_id"], "record_number", "epoch_us", "previous_us").where("epoch_us < previous_us")


def assert_monotonic(stream: DataFrame) -> DataFrame:
    """The stream itself; running it fails where time goes back."""
    back = F.coalesce(F.col("epoch_us") < F.col("_previous_us"), F.lit(False))
    seen = last_before(stream, ["session_id"], "record_number", "epoch_us", "_previous_us")
    return seen.withColumn("epoch_us", F.when(back, F.raise_error(F.lit("time goes back inside a stream")).cast("long")).otherwise(F.col("epoch_us"))).drop("_previous_us")


def clock_correct(stream: DataFrame, offset_ms: float = 0.0, drift_ppm: float = 0.0) -> DataFrame:
    """S3: offset and drift around the stream's own first time, rounded half to even."""
    scale = 1 + drift_ppm / 1e6
    if scale <= 0:
        raise ValueError("the clock would stand still or run backwards")
    first = stream.groupBy("session_id").agg(F.min_by("epoch_us", "record_number").alias("_anchor"))
    moved = F.col("_anchor") + (F.col("epoch_us") - F.col("_anchor")) * F.lit(scale) + F.lit(offset_ms * 1000.0)
    return stream.join(first, "session_id").withColumn("epoch_us", F.rint(moved).cast("long")).drop("_anchor")


def timeline_reference(stream: DataFrame) -> DataFrame:
    """Every record of the stream is a target."""
    return stream.select("session_id", F.col("record_number").alias("target_no"), "epoch_us")


def intersection_interval(streams: dict[str, DataFrame]) -> DataFrame:
    """Latest first and earliest last time over the streams of each session (all have to be there)."""
    ends = [s.groupBy("session_id").agg(F.min("epoch_us").alias("a"), F.max("epoch_us").alias("b")) for s in streams.values()]
    both = reduce(lambda x, y: x.unionByName(y), ends)
    found = both.groupBy("session_id").agg(F.count("*").alias("n"), F.max("a").alias("start_us"), F.min("b").alias("end_us"))
    return found.where(F.col("n") == len(streams)).drop("n")


def timeline_fixed_rate(streams: dict[str, DataFrame], hz: float) -> DataFrame:
    """A tick every round(1e6 / hz) microseconds of the common interval, both ends included."""
    if not 0 < hz <= 1000:
        raise ValueError("the rate has to be in (0, 1000]")
    period = round(1e6 / hz)
    spans = intersection_interval(streams).where("start_us <= end_us")
    # chunks first, so that no row holds all ticks of a long session
    last = F.floor((F.col("end_us") - F.col("start_us")) / F.lit(period))
    chunks = spans.select("session_id", "start_us", last.alias("last"), F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(TICKS).cast("long"))).alias("first"))
    ticks = chunks.select("session_id", "start_us", F.explode(F.sequence("first", F.least(F.col("first") + (TICKS - 1), F.col("last")))).alias("i"))
    return ticks.select("session_id", (F.col("i") + 1).alias("target_no"), (F.col("start_us") + F.col("i") * period).alias("epoch_us"))


def bucket_for(frames: list[DataFrame], most: int = SESSION_ROWS) -> int | None:
    """Microseconds of a time bucket such that none holds much more than `most` rows of a session; None if no session needs buckets."""
    rows = reduce(lambda x, y: x.unionByName(y), [f.select("session_id", "epoch_us") for f in frames])
    per = rows.groupBy("session_id").agg(F.count("*").alias("n"), (F.max("epoch_us") - F.min("epoch_us")).alias("span"))
    found = per.where(F.col("n") > most).agg(F.min(F.col("span") * F.lit(float(most)) / F.col("n"))).first()[0]
    return None if found is None else max(1, int(found))


def neighbours(targets: DataFrame, streams: dict[str, DataFrame], bucket_us: int | str | None = "auto") -> DataFrame:
    """For each target and stream: prev (last record in file order with time <= target), next (first one after).

    Adds struct columns prev_<name> and next_<name>: epoch_us, payload.  bucket_us: length of time
    buckets, None for whole sessions, or "auto" to find it from the rows of the sessions.
    """
    names = list(streams)
    if bucket_us == "auto":
        bucket_us = bucket_for([targets, *streams.values()])
    shapes = {n: streams[n].select(F.struct("epoch_us", "payload").alias("x")).schema["x"].dataType for n in names}
    parts = [targets.select("session_id", "epoch_us", F.lit(1).alias("side"), F.col("target_no").alias("no"), *(F.lit(None).cast(shapes[n]).alias(f"at_{n}") for n in names))]
    for n in names:
        parts.append(streams[n].select("session_id", "epoch_us", F.lit(0).alias("side"), F.col("record_number").alias("no"), *(F.struct("epoch_us", "payload").cast(shapes[n]).alias(f"at_{m}") if m == n else F.lit(None).cast(shapes[m]).alias(f"at_{m}") for m in names)))
    rows = reduce(lambda x, y: x.unionByName(y), parts)
    keys = ["session_id"]
    if bucket_us:
        rows = rows.withColumn("bucket", F.floor(F.col("epoch_us") / F.lit(bucket_us)))
        keys = ["session_id", "bucket"]
    forward = Window.partitionBy(*keys).orderBy("epoch_us", "side", "no").rowsBetween(Window.unboundedPreceding, 0)
    backward = Window.partitionBy(*keys).orderBy(F.desc("epoch_us"), F.desc("side"), F.desc("no")).rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.withColumns({f"prev_{n}": F.last(f"at_{n}", ignorenulls=True).over(forward) for n in names} | {f"next_{n}": F.last(f"at_{n}", ignorenulls=True).over(backward) for n in names})
    found = seen.where("side = 1").select(*keys, F.col("no").alias("target_no"), "epoch_us", *(f"{p}_{n}" for n in names for p in ("prev", "next")))
    if not bucket_us:
        return found
    order = F.struct("epoch_us", "no")
    ends = rows.groupBy(*keys).agg(*(F.max_by(f"at_{n}", F.when(F.col(f"at_{n}").isNotNull(), order)).alias(f"z_{n}") for n in names), *(F.min_by(f"at_{n}", F.when(F.col(f"at_{n}").isNotNull(), order)).alias(f"a_{n}") for n in names))
    before = Window.partitionBy("session_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("session_id").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, *(F.last(f"z_{n}", ignorenulls=True).over(before).alias(f"cp_{n}") for n in names), *(F.last(f"a_{n}", ignorenulls=True).over(after).alias(f"cn_{n}") for n in names))
    out = found.join(carried, keys)
    return out.select("session_id", "target_no", "epoch_us", *(F.coalesce(f"{p}_{n}", f"{c}_{n}").alias(f"{p}_{n}") for n in names for p, c in (("prev", "cp"), ("next", "cn"))))


def alignment(matched: Column, method: str, delta_us: Column, reason: Column) -> Column:
    return F.struct(matched.alias("matched"), F.lit(method).alias("method"), F.when(matched, delta_us / 1000.0).alias("delta_ms"), F.when(~matched, reason).alias("reason"))


def nearest(name: str, tolerance_us: int) -> tuple[Column, Column]:
    """The nearer side, ties to prev, within the tolerance (inclusive)."""
    prev, nxt, t = F.col(f"prev_{name}"), F.col(f"next_{name}"), F.col("epoch_us")
    dp, dn = t - prev["epoch_us"], nxt["epoch_us"] - t
    use_prev = prev.isNotNull() & (nxt.isNull() | (dp <= dn))
    delta = F.when(use_prev, dp).otherwise(dn)
    matched = F.coalesce(delta <= tolerance_us, F.lit(False))
    value = F.when(matched, F.when(use_prev, prev["payload"]).otherwise(nxt["payload"]))
    return value, alignment(matched, "nearest", delta, F.when(prev.isNull() & nxt.isNull(), "NO_DATA").otherwise("OUTSIDE_TOLERANCE"))


def linear(name: str, tolerance_us: int, payload, max_gap_us: int | None = None) -> tuple[Column, Column]:
    """Exact hits verbatim; numbers interpolated between both sides whatever the tolerance; others from the nearer side within it."""
    prev, nxt, t = F.col(f"prev_{name}"), F.col(f"next_{name}"), F.col("epoch_us")
    t0, t1 = prev["epoch_us"], nxt["epoch_us"]
    exact = F.coalesce(t0 == t, F.lit(False))
    between = prev.isNotNull() & nxt.isNotNull()
    if max_gap_us is not None:
        between = between & (t1 - t0 <= max_gap_us)
    share = (t - t0) / (t1 - t0)
    near_prev = (t - t0) <= (t1 - t)
    near = F.least(t - t0, t1 - t)
    parts = []
    for f in payload.fields:
        x0, x1 = prev["payload"][f.name], nxt["payload"][f.name]
        mixed = x0 + (x1 - x0) * share if f.dataType.typeName() == "double" else F.when(near <= tolerance_us, F.when(near_prev, x0).otherwise(x1))
        parts.append(F.when(exact, x0).otherwise(mixed).alias(f.name))
    matched = exact | between
    return F.when(matched, F.struct(*parts)), alignment(matched, "linear", F.when(exact, F.lit(0)).otherwise(near), F.lit("NO_EXTRAPOLATION"))


def synchronize(streams: dict[str, DataFrame], reference: str | float, methods: dict[str, str] | None = None, tolerance_ms: float = 100.0, corrections: dict[str, tuple[float, float]] | None = None, bucket_us: int | str | None = "auto") -> DataFrame:
    """One row per target with `streams` (payload by name) and `alignment` (diagnostics by name).

    reference: name of the stream that gives the targets, or a rate in Hz.  corrections: name to
    (offset_ms, drift_ppm).
    """
    if len(streams) < 2:
        raise ValueError("at least two streams are needed")
    methods, tolerance = methods or {}, round(tolerance_ms * 1000)
    ready = {n: clock_correct(s, *(corrections or {})[n]) if n in (corrections or {}) else s for n, s in streams.items()}
    fixed = not isinstance(reference, str)
    targets = timeline_fixed_rate(ready, reference) if fixed else timeline_reference(ready[reference])
    found = neighbours(targets, ready, bucket_us)
    values, notes = [], []
    for n in streams:
        if n == reference:
            # the target's own record: of equal times each target keeps its own
            value, note = F.col(f"own_{n}"), alignment(F.lit(True), "reference", F.lit(0), F.lit(None).cast("string"))
        elif methods.get(n, "nearest") == "linear":
            value, note = linear(n, tolerance, ready[n].schema["payload"].dataType)
        else:
            value, note = nearest(n, tolerance)
        values.append(value.alias(n))
        notes.append(note.alias(n))
    if not fixed:
        own = ready[reference].select("session_id", F.col("record_number").alias("target_no"), F.col("payload").alias(f"own_{reference}"))
        found = found.join(own, ["session_id", "target_no"])
    return found.select("session_id", F.col("target_no").alias("row_index"), "epoch_us", F.struct(*values).alias("streams"), F.struct(*notes).alias("alignment"))


def sync_metrics(rows: DataFrame) -> DataFrame:
    """Per stream rows matched and not, coverage, mean and largest delta, exact and interpolated counts.

    The mean comes from whole microseconds, so it doesn't depend on the order of partitions.
    """
    names = rows.schema["alignment"].dataType.names
    long = rows.select(F.explode(F.array(*(F.struct(F.lit(n).alias("stream"), F.col(f"alignment.{n}").alias("a")) for n in names))).alias("x")).select("x.stream", "x.a.*")
    hit = F.col("matched")
    is_linear = F.col("method") == "linear"
    return long.groupBy("stream").agg(
        F.count("*").alias("rows"),
        F.sum(hit.cast("long")).alias("matched"),
        F.sum((~hit).cast("long")).alias("unmatched"),
        F.avg(hit.cast("double")).alias("coverage"),
        (F.sum(F.round(F.col("delta_ms") * 1000).cast("long")) / F.count("delta_ms") / 1000.0).alias("mean_delta_ms"),
        F.max("delta_ms").alias("max_delta_ms"),
        F.sum(F.when(is_linear, (hit & (F.col("delta_ms") == 0)).cast("long"))).alias("exact"),
        F.sum(F.when(is_linear, (hit & (F.col("delta_ms") > 0)).cast("long"))).alias("interpolated"),
    )
