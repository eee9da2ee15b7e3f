from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.registry import register
from tessera.session import scratch_path
from tessera.sources.tables import read_table
from tessera.streaming import windows as S

FILES = 12  # micro-batches of the replayed stream (event_id ranges)

POS_CTE = """pos AS (SELECT ts,
    CASE WHEN event_type = 'click' THEN value ELSE TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS x,
    CASE WHEN event_type = 'click' THEN TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) ELSE value END AS y
  FROM events),
reg AS (SELECT ts, CASE WHEN x BETWEEN 10 AND 60 AND y BETWEEN 20 AND 40 THEN 'a'
                        WHEN x BETWEEN 61 AND 95 AND y BETWEEN 50 AND 90 THEN 'b' END AS region FROM pos)"""

HOURLY_SQL = """SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n
FROM events GROUP BY 1"""

# Sliding 60-minute windows every 15 minutes: each event is in the 4 windows that start
# at its 15-minute bucket and the three before it.
SLIDING_SQL = """SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n FROM (
  SELECT time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL (15 * k) MINUTE AS s
  FROM events, (SELECT unnest([0, 1, 2, 3]) AS k)) GROUP BY 1"""

REGION_SQL = f"""WITH {POS_CTE}
SELECT region, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n
FROM reg WHERE region IS NOT NULL GROUP BY 1, 2"""


def _events(spark, sf):
    return read_table(spark, sf, "events")


@register("hourly_count", HOURLY_SQL)
def hourly_count(spark, sf):
    return S.window_counts(_events(spark, sf), "1 hour")


@register("sliding_count", SLIDING_SQL)
def sliding_count(spark, sf):
    return S.window_counts(_events(spark, sf), "60 minutes", "15 minutes")


@register("region_hourly_count", REGION_SQL)
def region_hourly_count(spark, sf):
    return S.region_window_counts(_events(spark, sf), "1 hour")


@register("region_lines_count", REGION_SQL)
def region_lines_count(spark, sf):
    # The test tables have no comma lines: the positions of events are written as such, in a layout by type, then read back.
    path = scratch_path(spark, "event-lines")
    whole = _events(spark, sf).withColumn("ts", F.struct("event_type", "event_id", "ts"))
    head = F.concat_ws(",", *[F.col(f"ts.{c}").cast("string") for c in ("event_type", "event_id", "ts")])
    gap = F.when(F.col("ts.event_type") == "click", F.lit("," * 8)).otherwise(F.lit("," * 6))
    x, y = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in "xy")
    S.positions(whole).select(F.concat(head, gap, x, F.lit(","), y).alias("value")).write.text(path)
    return S.position_window_counts(S.parse_event_lines(spark.read.text(path)), "1 hour")


def replay_files(events, path, n_batches=FILES, order_col="event_id", rows_per_file=1_000_000):
    """Stand-in for a folder that receives the events of one period at a time: the table cut into ``order_col`` ranges, one
    ``part-*`` file each, written by one job. Returns how many files make a micro-batch (1, but for large tables).

    Tasks end in any order, and the file source replays by modification time: read it without a watermark, or with
    one that allows for that."""
    files = max(n_batches, -(-events.count() // rows_per_file))
    events.repartitionByRange(files, order_col).sortWithinPartitions(order_col).write.parquet(path)
    return -(-files // n_batches)


def _stream(spark, sf, build, run):
    ev = _events(spark, sf)
    base = scratch_path(spark, "event-stream")
    per_batch = replay_files(ev, f"{base}/in")
    stream = S.read_replay(spark, f"{base}/in", ev.schema, files_per_trigger=per_batch)
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return run(build(stream), f"{base}/out", f"{base}/state", parts)


def _updates(keys):
    return lambda result, out, state, parts: S.run_update(result, out, state, keys, state_partitions=parts)


@register("stream_hourly_count", HOURLY_SQL)
def stream_hourly_count(spark, sf):
    return _stream(spark, sf, lambda s: S.window_counts(s, "1 hour"), _updates(["window_start"]))


@register("stream_sliding_count", SLIDING_SQL)
def stream_sliding_count(spark, sf):
    return _stream(spark, sf, lambda s: S.window_counts(s, "60 minutes", "15 minutes"), _updates(["window_start"]))


@register("stream_region_count", REGION_SQL)
def stream_region_count(spark, sf):
    return _stream(spark, sf, lambda s: S.region_window_counts(s, "1 hour"), _updates(["region", "window_start"]))


@register("stream_window_folders", """
SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n
FROM events GROUP BY 1""")
def stream_window_folders(spark, sf):
    def folders(result, out, state, parts):
        S.write_windows(result, out, state, state_partitions=parts)
        return spark.read.schema("n bigint, window_start string").parquet(out)
    return _stream(spark, sf, lambda s: S.window_counts(s, "1 day"), folders)
