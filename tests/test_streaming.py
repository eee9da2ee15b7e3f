"""Stream replay: complete and update mode equal batch, restart from a checkpoint counts nothing
twice, every window has its folder, rows behind the watermark are dropped and counted."""

import datetime as dt
import os

from pyspark.sql import functions as F

import pytest

from tessera.plans.events import replay_files
from tessera.streaming import windows as S


def replay_in_order(events, path, ranges):
    """The ranges of ``event_id`` as one ``part-*`` file each whose modification times rise."""
    replay_files(events, path, ranges)
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    for i, f in enumerate(files):
        os.utime(f"{path}/{f}", (1_700_000_000 + i, 1_700_000_000 + i))
    assert len(files) == ranges


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string, value double, props string")


def _rows(n, start_min=0, step_min=7):
    base = dt.datetime(2024, 1, 1)
    return [(i, base + dt.timedelta(minutes=start_min + i * step_min), "click" if i % 3 else "view",
             float(10 + (i * 13) % 80), '{"k": %d}' % ((i * 7) % 100)) for i in range(n)]


def _as_set(df):
    return sorted(tuple(r) for r in df.collect())


BUILDS = {"hour": (["window_start"], lambda s: S.window_counts(s, "1 hour")),
          "slide": (["window_start"], lambda s: S.window_counts(s, "60 minutes", "15 minutes")),
          "region": (["region", "window_start"], lambda s: S.region_window_counts(s, "1 hour"))}


@pytest.mark.parametrize("name", BUILDS)
def test_complete_and_update_mode_equal_batch(spark, tmp_dir, name):
    keys, build = BUILDS[name]
    ev = _events(spark, _rows(200))
    replay_in_order(ev, tmp_dir + "/in", 5)
    batches = []
    got = S.run_complete(build(S.read_replay(spark, tmp_dir + "/in", ev.schema)), tmp_dir + "/o1", tmp_dir + "/s1",
                         per_batch=lambda df, eid: batches.append(eid))
    assert _as_set(got) == _as_set(build(ev))
    assert len(batches) == 5  # five files, one micro-batch each
    got = S.run_update(build(S.read_replay(spark, tmp_dir + "/in", ev.schema)), tmp_dir + "/o2", tmp_dir + "/s2", keys)
    assert _as_set(got) == _as_set(build(ev)) and got.columns == build(ev).columns


def test_restart_from_checkpoint_adds_nothing_twice(spark, tmp_dir):
    ev = _events(spark, _rows(120))
    replay_in_order(ev.where("event_id < 60"), tmp_dir + "/stage1", 2)
    replay_in_order(ev.where("event_id >= 60"), tmp_dir + "/stage2", 2)
    os.makedirs(tmp_dir + "/in")
    want = _as_set(S.window_counts(ev, "1 hour"))

    def counts():
        return S.window_counts(S.read_replay(spark, tmp_dir + "/in", ev.schema), "1 hour")
    for stage in ("stage1", "stage2"):
        for f in sorted(os.listdir(f"{tmp_dir}/{stage}")):
            if f.startswith("part-"):
                os.link(f"{tmp_dir}/{stage}/{f}", f"{tmp_dir}/in/{stage}-{f}".replace(f"{stage}-part", f"part-{stage}"))
        complete = S.run_complete(counts(), tmp_dir + "/o1", tmp_dir + "/s1")
        update = S.run_update(counts(), tmp_dir + "/o2", tmp_dir + "/s2", ["window_start"])
    assert _as_set(complete) == want and _as_set(update) == want
    # A third run with no new files has the same answer.
    assert _as_set(S.run_complete(counts(), tmp_dir + "/o1", tmp_dir + "/s1")) == want
    assert _as_set(S.run_update(counts(), tmp_dir + "/o2", tmp_dir + "/s2", ["window_start"])) == want


def _folder_counts(spark, path):
    rows = spark.read.parquet(path).select(F.col("window_start").cast("string"), "n").collect()
    assert len({r.window_start for r in rows}) == len(rows)
    return {r.window_start: r.n for r in rows}


def test_every_window_has_its_folder_and_late_rows_are_counted(spark, tmp_dir):
    ev = _events(spark, _rows(60))  # 7 hours of events
    late = [(1000, dt.datetime(2024, 1, 1, 0, 5), "view", 1.0, '{"k": 1}')]  # far behind the watermark
    batch = {r.window_start: r.n for r in S.window_counts(ev, "1 hour").collect()}
    replay_in_order(ev, tmp_dir + "/in", 3)

    def run():
        stream = S.read_replay(spark, tmp_dir + "/in", ev.schema, watermark="10 minutes")
        return S.write_windows(S.window_counts(stream, "1 hour"), tmp_dir + "/out", tmp_dir + "/state")
    assert S.late_rows(run()) == 0
    folders = [d for d in os.listdir(tmp_dir + "/out") if d.startswith("window_start=")]
    assert len(folders) == len(batch) and _folder_counts(spark, tmp_dir + "/out") == batch
    _events(spark, late).write.mode("overwrite").parquet(tmp_dir + "/late")
    for f in os.listdir(tmp_dir + "/late"):
        if f.startswith("part-"):
            os.link(f"{tmp_dir}/late/{f}", f"{tmp_dir}/in/part-zlate-{f}")
    assert S.late_rows(run()) == 1
    assert _folder_counts(spark, tmp_dir + "/out") == batch  # the late row changed nothing
    # Without a watermark no row is late.
    stream = S.read_replay(spark, tmp_dir + "/in", ev.schema)
    S.write_windows(S.window_counts(stream, "1 hour"), tmp_dir + "/out2", tmp_dir + "/state2")
    assert _folder_counts(spark, tmp_dir + "/out2") == batch | {"2024-01-01 00:00:00": batch["2024-01-01 00:00:00"] + 1}


def test_folders_by_window_and_region(spark, tmp_dir):
    ev = _events(spark, _rows(200))
    replay_in_order(ev, tmp_dir + "/in", 4)
    result = S.region_window_counts(S.read_replay(spark, tmp_dir + "/in", ev.schema), "1 hour")
    S.write_windows(result, tmp_dir + "/out", tmp_dir + "/state", keys=["region"])
    got = spark.read.parquet(tmp_dir + "/out").select("region", F.col("window_start").cast("string"), "n")
    assert _as_set(got) == _as_set(S.region_window_counts(ev, "1 hour"))


def test_replay_of_many_files_per_batch(spark, tmp_dir):
    ev = _events(spark, _rows(90))
    per = replay_files(ev, tmp_dir + "/in", 3, rows_per_file=10)  # 9 files, 3 a micro-batch
    assert per == 3 and len([f for f in os.listdir(tmp_dir + "/in") if f.startswith("part-")]) == 9
    stream = S.read_replay(spark, tmp_dir + "/in", ev.schema, files_per_trigger=per)
    q = S.write_windows(S.window_counts(stream, "1 hour"), tmp_dir + "/out", tmp_dir + "/state")
    assert sum(p["numInputRows"] > 0 for p in q.recentProgress) == 3
    assert _folder_counts(spark, tmp_dir + "/out") == {r.window_start: r.n for r in S.window_counts(ev, "1 hour").collect()}


def test_streams_refuse_another_zone_and_batches_keep_the_wall_clock(spark, tmp_dir):
    night = dt.datetime(2024, 3, 10, 1, 30)  # the hour after is skipped by clocks in New York
    ev = _events(spark, [(i, night + dt.timedelta(minutes=30 * i), "view", 1.0, "{}") for i in range(6)])
    want = _as_set(S.window_counts(ev, "1 hour"))
    ev.write.parquet(tmp_dir + "/in")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert _as_set(S.window_counts(ev, "1 hour")) == want == [("2024-03-10 01:00:00", 1), ("2024-03-10 02:00:00", 2), ("2024-03-10 03:00:00", 2), ("2024-03-10 04:00:00", 1)]
        with pytest.raises(ValueError, match="UTC"):
            S.read_replay(spark, tmp_dir + "/in", ev.schema)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_comma_lines_by_type(spark):
    lines = ["click,1,2024-01-01 00:10:00,,,,,,,,20.5,30", "view,2,2024-01-01 00:20:00.25,,,,,,70,60", "other,3,2024-01-01 01:00:00,,,,,,70,x",
             "click,4,2024-01-01 01:00:00,,,,,,70,60", "view", "", "view,5,never,,,,,,70,60", "click,6,2024-01-01 00:59:59,,,,,,,,10,40,more"]
    p = S.parse_event_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = [(r.x, r.y) for r in p.collect()]
    assert got == [(20.5, 30.0), (70.0, 60.0), (70.0, None), (None, None), (None, None), (None, None), (70.0, 60.0), (10.0, 40.0)]
    assert _as_set(S.position_window_counts(p)) == [("a", "2024-01-01 00:00:00", 2), ("b", "2024-01-01 00:00:00", 1)]
