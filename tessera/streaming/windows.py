"""Windowed event counts, batch and streaming, over the same column functions.

Windows are on event time (``window(ts, length, slide)``); the studied jobs used batch
(processing) time with an inverse reduce, which Spark's state store makes unnecessary.
The stream path reads files from a folder (``maxFilesPerTrigger`` per micro-batch),
keeps state in ``checkpointLocation`` and writes through ``foreachBatch``: the changed rows
of a batch to its own folder (update mode, so a replayed epoch overwrites only itself), the
whole result (complete mode), or one folder per window.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

# Fixed regions of the test stand-in: (name, x_min, x_max, y_min, y_max), bounds inclusive,
# first match wins.
REGIONS = [("a", 10.0, 60.0, 20.0, 40.0), ("b", 61.0, 95.0, 50.0, 90.0)]


def _session_tz(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.session.timeZone")


UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def event_time(ts: Column, tz: str) -> Column:
    """Event time usable by ``withWatermark`` (which refuses TIMESTAMP_NTZ): the wall clock read as UTC.

    Only in a session of UTC: elsewhere an hour that clocks skip or repeat has no wall-clock window of its own, and a
    stream would print other windows than a batch."""
    if tz not in UTC_NAMES:
        raise ValueError(f"streams count wall-clock windows in UTC; spark.sql.session.timeZone is {tz!r}")
    return ts.cast("timestamp")


def window_start_text(w: Column) -> Column:
    """Window start as ``yyyy-MM-dd HH:mm:ss`` text: the wall clock of a TIMESTAMP_NTZ (a cast, in any session), the
    session's clock of a TIMESTAMP."""
    return w["start"].cast("string")


def positions(events: DataFrame) -> DataFrame:
    """P5/SRC10: (ts, x, y) with the layout chosen by event type: ``click`` gives
    x = value, y = k; any other type x = k, y = value. A bad ``k`` is null."""
    k = F.get_json_object(F.col("props"), "$.k").try_cast("double")
    click = F.col("event_type") == "click"
    return events.select("ts",
                         F.when(click, F.col("value")).otherwise(k).alias("x"),
                         F.when(click, k).otherwise(F.col("value")).alias("y"))


# Fixed columns of a comma line: x and y of a ``click``, of any other type, and the time.
CLICK_AT, OTHER_AT, TIME_AT = (10, 11), (8, 9), 2


def parse_event_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """SRC10: comma lines ``type,id,ts,..`` (batch or stream) -> (ts, x, y).

    Where x and y stand depends on the type, and so does the length of a line. What is missing or is no number or time is
    null, so the line falls into no region (or no window)."""
    p = F.split(F.col(column), ",", -1)
    click = F.col("p")[0] == "click"
    at = lambda i: F.get("p", F.lit(i)).try_cast("double")
    return (lines.select(p.alias("p"))
            .select(F.get("p", F.lit(TIME_AT)).try_cast("timestamp_ntz").alias("ts"),
                    *[F.when(click, at(c)).otherwise(at(o)).alias(n) for n, c, o in zip("xy", CLICK_AT, OTHER_AT)]))


def classify_region(x: Column, y: Column, regions=REGIONS) -> Column:
    """Name of the first region whose box holds (x, y), else null (F5 drops it).

    The regions are a short fixed list, so this is one CASE expression in the
    projection: no join, no shuffle."""
    expr = None
    for name, x0, x1, y0, y1 in regions:
        cond = x.between(x0, x1) & y.between(y0, y1)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def window_counts(events: DataFrame, length: str = "1 hour", slide: str | None = None,
                  keys: list[str] | None = None) -> DataFrame:
    """ST1/ST3/P4: events per window (optionally per key) -> (*keys, window_start, n).

    Grouping is by the window struct itself (keeps the watermark usable in streams)."""
    w = F.window("ts", length, slide) if slide else F.window("ts", length)
    keys = keys or []
    text = window_start_text(F.col("w"))
    return (events.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
            .select(*keys, text.alias("window_start"), "n"))


def region_window_counts(events: DataFrame, length: str = "1 hour", slide: str | None = None,
                         regions=REGIONS) -> DataFrame:
    """ST2: events per (region, window); events outside every region are dropped."""
    return position_window_counts(positions(events), length, slide, regions)


def position_window_counts(p: DataFrame, length: str = "1 hour", slide: str | None = None, regions=REGIONS) -> DataFrame:
    """ST2 from (ts, x, y)."""
    r = p.select("ts", classify_region(F.col("x"), F.col("y"), regions).alias("region"))
    return window_counts(r.where(F.col("region").isNotNull()), length, slide, ["region"])


# ---------------------------------------------------------------- stream replay (SRC9, ST4-ST8, SNK5)

def read_replay(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1,
                watermark: str | None = None) -> DataFrame:
    """SRC9/SRC11: the folder as a stream, ``files_per_trigger`` files per micro-batch in order of their modification
    time, only ``part-*`` files; ``ts`` as event time.

    Without a ``watermark`` no row is ever late, and state grows with the number of windows. With one, rows of windows
    that it has passed are dropped; ``late_rows`` tells how many."""
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
         .option("pathGlobFilter", "part-*").parquet(path))
    s = s.withColumn("ts", event_time(F.col("ts"), _session_tz(spark)))
    return s.withWatermark("ts", watermark) if watermark else s


def late_rows(query) -> int:
    """Partial counts that a finished query dropped behind its watermark (rows of one task and window count once), over
    the micro-batches that Spark still remembers (``spark.sql.streaming.numRecentProgressUpdates``)."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


@contextmanager
def _state_partitions(spark: SparkSession, n: int | None):
    """Number of state-store partitions of a stateful query started inside the block.

    A streaming query copies the session settings when it starts and keeps its
    partition count in its checkpoint, so the setting is changed only while
    ``start()`` runs. Windowed counts keep one row per window and key: their state
    is small and the input is partially aggregated before the shuffle, so a few
    partitions serve any input rate; the session default (200) would mean 200
    state tasks per micro-batch."""
    if n is None:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def _finish(q, timeout_s: int | None) -> None:
    """Wait for the end of a stream; a time limit that is reached stops it and raises."""
    done = q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination()
    if done is False:
        q.stop()
        raise TimeoutError("stream did not finish in time")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_complete(result: DataFrame, out_base: str, checkpoint: str,
                 timeout_s: int | None = None, per_batch=None,
                 state_partitions: int | None = None) -> DataFrame:
    """ST4-ST8: run a streaming aggregation in complete mode over all available input
    (``availableNow``) and return the final full result as a batch DataFrame.

    Each epoch's full result goes to ``{out_base}/epoch=<id>``; the last epoch is the
    answer. ``per_batch(df, epoch_id)`` (optional) is an extra action per finished
    batch (e.g. counting windows); then the batch is persisted while both outputs read it.
    """
    spark = result.sparkSession
    last = {"epoch": None}

    def sink(df: DataFrame, epoch_id: int) -> None:
        if per_batch is not None:
            df.persist()
        df.write.mode("overwrite").parquet(f"{out_base}/epoch={epoch_id}")
        if per_batch is not None:
            per_batch(df, epoch_id)
            df.unpersist()
        last["epoch"] = epoch_id

    with _state_partitions(spark, state_partitions):
        q = (result.writeStream.outputMode("complete").foreachBatch(sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _finish(q, timeout_s)
    if last["epoch"] is None:
        # No new input: the answer is that of the last epoch of an earlier run, if there was one.
        try:
            seen = spark.read.parquet(out_base)
        except AnalysisException:
            return spark.createDataFrame([], result.schema)
        last["epoch"] = seen.agg(F.max("epoch")).first()[0]
    return spark.read.parquet(f"{out_base}/epoch={last['epoch']}")


def run_update(result: DataFrame, out_base: str, checkpoint: str, keys: list[str], value: str = "n",
               timeout_s: int | None = None, state_partitions: int | None = None) -> DataFrame:
    """ST4-ST6: run a streaming aggregation over all available input; each micro-batch writes only the rows that it
    changed, to ``{out_base}/epoch=<id>``. The answer is the last value of each of ``keys`` over all epochs, those
    of earlier runs of the same checkpoint included."""
    spark = result.sparkSession

    def sink(df: DataFrame, epoch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out_base}/epoch={epoch_id}")

    with _state_partitions(spark, state_partitions):
        q = (result.writeStream.outputMode("update").foreachBatch(sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _finish(q, timeout_s)
    try:
        seen = spark.read.parquet(out_base)
    except AnalysisException:  # there was no input at all
        return spark.createDataFrame([], result.schema)
    return seen.groupBy(*keys).agg(F.max_by(value, "epoch").alias(value)).select(*result.columns)


def write_windows(result: DataFrame, path: str, checkpoint: str, keys: list[str] | None = None,
                  timeout_s: int | None = None, state_partitions: int | None = None):
    """SNK5: one folder per window, ``{path}/window_start=../`` (and ``key=../`` below it for each of ``keys``), holding the
    window's count. Returns the finished query.

    Update mode: a micro-batch overwrites the folders of the windows that it changed and no others, so each window has
    its folder from its first event on, the last one of the input too, and a replayed epoch overwrites with the same."""
    def sink(df: DataFrame, epoch_id: int) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("window_start", *(keys or [])).parquet(path))

    with _state_partitions(result.sparkSession, state_partitions):
        q = (result.writeStream.outputMode("update").foreachBatch(sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _finish(q, timeout_s)
    return q


def start_live(result: DataFrame, sink, checkpoint: str, interval: str = "1 minute",
               output_mode: str = "update", state_partitions: int | None = None):
    """ST4: run a stream on a processing-time trigger (one micro-batch per ``interval``)
    until stopped; ``sink(df, epoch_id)`` receives each batch's changed rows."""
    with _state_partitions(result.sparkSession, state_partitions):
        return (result.writeStream.outputMode(output_mode).foreachBatch(sink)
                .option("checkpointLocation", checkpoint).trigger(processingTime=interval).start())
