"""Incremental semantics: watermarks, NOT IN, upserts, metamorphic runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lanecast import schemas
from lanecast.operators import incremental as I
from lanecast.operators.joins import null_aware_anti
from lanecast.plans import pipeline as P
from lanecast.session import scratch_path
from lanecast.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_watermark_strict_and_empty_target(spark):
    t = spark.createDataFrame([(1, dt.datetime(2020, 1, 2))], "d_id long, created timestamp_ntz")
    b = spark.createDataFrame([(2, dt.datetime(2020, 1, 2)), (3, dt.datetime(2020, 1, 3))],
                              "d_id long, created timestamp_ntz")
    assert [r.d_id for r in I.newer_than_target(b, t, "created").collect()] == [3]
    empty = t.limit(0)
    assert I.newer_than_target(b, empty, "created").count() == 0


def test_not_in_is_null_aware(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "d_id long")
    right = spark.createDataFrame([(2,)], "d_id long")
    assert sorted(r.d_id for r in null_aware_anti(left, right, "d_id").collect()) == [1]
    right_null = spark.createDataFrame([(2,), (None,)], "d_id long")
    assert null_aware_anti(left, right_null, "d_id").count() == 0


def test_upsert_delete_insert(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    new = spark.createDataFrame([(1, "x"), (3, "y")], "k long, v string")
    got = sorted(tuple(r) for r in I.upsert(old, new, "k").collect())
    assert got == [(1, "x"), (2, "c"), (3, "y")]


def test_schema_evolution_appends_columns(spark):
    old = spark.createDataFrame([(1,)], "k long")
    new = spark.createDataFrame([(2, "n")], "k long, extra string")
    got = sorted(tuple(r) for r in I.evolve_schema(old, new).collect())
    assert got == [(1, None), (2, "n")]


def _rows(df):
    cols = [c for c in schemas.MART_COLUMNS if c != "load_date"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_batches_equal_full_build_and_rerun_is_noop(spark):
    root = scratch_path(spark, "test-batches")
    b1, b2 = fx.batches(spark, SF_SMALL)
    P.run_full(spark, b1, root, fx.BATCH1_LOAD_DATE)
    P.run_incremental(spark, b2, root, fx.BATCH2_LOAD_DATE, P.SNAPSHOT_TS)
    inc = P.stored_mart(spark, root).drop("valid_month")
    full = P.build_mart(P.stage(fx.full_load(spark, SF_SMALL), fx.FULL_LOAD_DATE),
                        P.M.MartParams(load_date=fx.FULL_LOAD_DATE))
    first = _rows(inc)
    assert first == _rows(full) and len(first) > 0
    # the same batch again: nothing is newer, the mart does not change
    P.run_incremental(spark, b2, root, fx.BATCH2_LOAD_DATE, ("2025-09-07 00:00:00", "2025-09-07 00:05:00"))
    assert _rows(P.stored_mart(spark, root).drop("valid_month")) == first
    log = P.coverage_log_table(spark, root).orderBy("snapshot_ts").collect()
    assert [r.stage for r in log] == ["before", "after", "before", "after"]
    assert log[1].covered_lane_count == log[2].covered_lane_count == log[3].covered_lane_count
    # a run repeated with its own times logs nothing twice
    P.run_incremental(spark, b2, root, fx.BATCH2_LOAD_DATE, P.SNAPSHOT_TS)
    assert P.coverage_log_table(spark, root).count() == 4
    # an incremental run scans no history for its marks
    text = P.affected_window(spark, root, P.TB.table_path(root, *P.MART_TABLE))._jdf.queryExecution().executedPlan().toString()
    assert "daily_lane_equipment_prices" not in text


def test_affected_window_none_when_nothing_new(spark):
    dp = spark.createDataFrame([(1, dt.datetime(2020, 1, 1), dt.date(2020, 1, 1), dt.date(2020, 1, 3))],
                               "datapoint_id long, created timestamp_ntz, valid_from date, valid_to date")
    mart = spark.createDataFrame([(dt.datetime(2020, 1, 1),)], "created timestamp_ntz")
    w = I.affected_window(dp, mart).first()
    assert w.lo is None and w.hi is None
    newer = mart.select(F.lit(dt.datetime(2019, 1, 1)).cast("timestamp_ntz").alias("created"))
    w = I.affected_window(dp, newer).first()
    assert (w.lo, w.hi) == (dt.date(2020, 1, 1), dt.date(2020, 1, 3))


def test_full_write_replaces_all_months_swap_only_present(spark):
    from lanecast.sources import tables as TB

    def rows(days):
        vals = [(dt.date(2020, m, 1), 1, "A to B", 1, "A", "A", "R", "C", 2, "B", "B", "R", "C",
                 1.0, 1.0, 1, 1, False, dt.datetime(2020, 1, 1), dt.date(2020, 1, 1)) for m in days]
        return spark.createDataFrame(vals, schemas.MART)

    path = scratch_path(spark, "test-modes") + "/mart"
    P.write_mart(rows([1, 2, 3]), path)
    P.write_mart(rows([2]), path)
    assert [r.valid_day.month for r in P.read_mart(spark, path).collect()] == [2]
    P.write_mart(rows([1, 2, 3]), path)
    swap = rows([2]).withColumn("avg_price_usd", F.lit(9.0)).withColumn(
        "valid_month", F.trunc("valid_day", "month"))
    TB.replace_partitions(swap, path)
    got = sorted((r.valid_day.month, r.avg_price_usd) for r in P.read_mart(spark, path).collect())
    assert got == [(1, 1.0), (2, 9.0), (3, 1.0)]


def _pairs(spark, path):
    from lanecast.sources import tables as TB
    return sorted(tuple(r) for r in TB.read(spark, path).collect())


def _kv(spark, pairs):
    return spark.createDataFrame(pairs, "k long, v string")


WRITES = {
    "overwrite": (lambda TB, df, path: TB.overwrite(df, path), [(2, "x"), (9, "y")]),
    "append": (lambda TB, df, path: TB.append(df, path), [(1, "a"), (2, "b"), (2, "x"), (9, "y")]),
    "upsert": (lambda TB, df, path: TB.upsert(df, path, "k"), [(1, "a"), (2, "x"), (9, "y")]),
}


@pytest.mark.parametrize("kind", WRITES)
def test_aborted_write_keeps_the_table(spark, monkeypatch, kind):
    """A write that is lost in its data, its manifest or the last rename leaves
    the version before; the next one leaves no orphans."""
    from lanecast.sources import tables as TB
    write, after = WRITES[kind]
    path = scratch_path(spark, "test-abort") + "/t"
    TB.overwrite(_kv(spark, [(1, "a"), (2, "b")]), path)
    batch = _kv(spark, [(2, "x"), (9, "y")])

    def lost(*a, **k):
        raise OSError("lost")
    for owner, name in ((TB.Folder, "rename"), (TB.Folder, "write_text"), (TB, "_evolved" if kind != "overwrite" else "_commit")):
        with monkeypatch.context() as m:
            m.setattr(owner, name, lost)
            with pytest.raises(OSError):
                write(TB, batch, path)
        assert _pairs(spark, path) == [(1, "a"), (2, "b")]
    write(TB, batch, path)
    assert _pairs(spark, path) == after
    named = TB.manifest(spark, path).folders()
    TB.append(_kv(spark, [(7, "z")]), path)
    kept = {n for n in TB.Folder(spark, path).names() if "=" in n}
    assert kept == named | TB.manifest(spark, path).folders()


def test_every_lost_commit_of_a_rebuild_leaves_readable_tables(spark, monkeypatch):
    from dataclasses import replace
    from lanecast.sources import tables as TB
    b1, _ = fx.batches(spark, SF_SMALL)
    raw = replace(b1, datapoints=b1.datapoints.filter("d_id < 200"))
    root = scratch_path(spark, "test-rebuild")
    P.run_full(spark, raw, root, fx.BATCH1_LOAD_DATE)
    tables = [TB.table_path(root, layer, n) for layer in ("raw", "staging") for n in P.RAW_NAMES] + [TB.table_path(root, *P.MART_TABLE)]
    state = lambda: {t: TB.read(spark, t).count() for t in tables}
    old, commit, done = state(), TB._commit, []
    fewer = replace(b1, datapoints=b1.datapoints.filter("d_id < 100"))
    for at in range(0, len(tables), 2):
        calls = []

        def lost(*args, at=at):
            calls.append(1)
            if len(calls) > at:
                raise OSError("lost")
            return commit(*args)
        with monkeypatch.context() as m:
            m.setattr(TB, "_commit", lost)
            with pytest.raises(OSError):
                P.run_full(spark, fewer, root, fx.BATCH1_LOAD_DATE)
        now = state()
        assert sum(now[t] != old[t] for t in tables) <= at and now[tables[-1]] == old[tables[-1]] > 0
        done.append(now)
    P.run_full(spark, fewer, root, fx.BATCH1_LOAD_DATE)
    assert 0 < state()[tables[-1]] < old[tables[-1]]


def test_bytes_written_grow_with_the_batch(spark):
    import os
    from lanecast.sources import tables as TB
    path = scratch_path(spark, "test-bytes") + "/t"

    def size():
        return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    rows = lambda a, b: spark.range(a, b, 1, 1).select(
        F.col("id").alias("d_id"), F.timestamp_seconds(F.col("id")).alias("created"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    TB.overwrite(rows(0, 50_000), path)
    written = []
    for a, b in ((49_990, 50_010), (49_000, 52_000)):
        before = size()
        P.merge_raw_datapoints(spark, rows(a, b).withColumn("created", F.col("created") + F.expr("INTERVAL 1 DAY")), path)
        after = size()
        assert before.items() <= after.items()  # nothing is written again
        written.append(sum(after.values()) - sum(before.values()))
    assert written[0] < sum(before.values()) / 100 and written[0] * 10 < written[1]
    assert TB.read(spark, path).count() == 52_000 and TB.read(spark, path).select("d_id").distinct().count() == 52_000


def test_marks_need_no_scan(spark):
    from lanecast.sources import tables as TB
    path = scratch_path(spark, "test-marks") + "/t"
    one = lambda k, day: spark.createDataFrame([(k, dt.datetime(2020, 1, day), dt.date(2020, 2, day))],
                                               "d_id long, created timestamp_ntz, load_date date")
    TB.overwrite(one(1, 1).limit(0), path)
    assert TB.mark(spark, path, "created") is None and TB.read(spark, path, newer=("created", None)).count() == 0
    for day in (3, 2):
        TB.append(one(day, day), path)
    for folder in TB.segment_paths(spark, path)[1:]:
        assert TB.mark(spark, path, "created") == "2020-01-03 00:00:00.000000" and TB.mark(spark, path, "load_date") == "2020-02-03"
        got = TB.read(spark, path, newer=("load_date", "2020-02-02")).collect()
        assert [r.d_id for r in got] == [3]  # the other segment is not read
    TB.Folder(spark, TB.segment_paths(spark, path)[-1]).delete()
    assert TB.mark(spark, path, "created") == "2020-01-03 00:00:00.000000"


def test_many_writes_are_compacted(spark, monkeypatch):
    from lanecast.sources import tables as TB
    monkeypatch.setattr(TB, "MAX_SEGMENTS", 3)
    path, want = scratch_path(spark, "test-compact") + "/t", {}
    for i in range(8):
        rows = [(i, f"v{i}"), (i % 3, f"w{i}")] if i % 3 != i else [(i, f"v{i}")]
        TB.upsert(_kv(spark, rows), path, "k")
        want.update(rows)
        assert dict(_pairs(spark, path)) == want and len(TB.segment_paths(spark, path)) <= 3
    TB.upsert(_kv(spark, [(None, "n"), (None, "m")]), path, "k")
    TB.upsert(_kv(spark, [(None, "o")]), path, "k")  # a NULL key replaces nothing
    assert TB.read(spark, path).filter("k IS NULL").count() == 3


def test_plain_folder_is_taken_over(spark):
    from lanecast.sources import tables as TB
    path = scratch_path(spark, "test-plain") + "/t"
    _kv(spark, [(1, "a"), (2, "b")]).write.parquet(path)
    assert _pairs(spark, path) == [(1, "a"), (2, "b")]
    TB.upsert(_kv(spark, [(2, "c")]), path, "k")
    assert _pairs(spark, path) == [(1, "a"), (2, "c")]


def test_another_type_is_an_error(spark):
    from lanecast.sources import tables as TB
    path = scratch_path(spark, "test-types") + "/t"
    TB.overwrite(_kv(spark, [(1, "a")]), path)
    with pytest.raises(TypeError, match="column v is string"):
        TB.append(spark.createDataFrame([(1, 2)], "k long, v int"), path)
    assert _pairs(spark, path) == [(1, "a")]


def test_unreadable_log_is_an_error(spark):
    import os
    path = scratch_path(spark, "test-broken") + "/log"
    os.makedirs(path)
    with open(f"{path}/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        P.TB.read_or_empty(spark, path, schemas.COVERAGE).collect()


def test_raw_columns_come_and_go(spark):
    def batch(ids, day, **extra):
        df = spark.createDataFrame([(i, dt.datetime(2020, 1, day)) for i in ids], "d_id long, created timestamp")
        return df.withColumns({k: F.lit(v) for k, v in extra.items()})
    path = scratch_path(spark, "test-evolve") + "/t"
    P.TB.overwrite(batch([1, 2], 1), path)
    P.merge_raw_datapoints(spark, batch([2, 3], 2, tier=7), path)
    P.merge_raw_datapoints(spark, batch([4], 3), path)
    got = {r.d_id: r.tier for r in P.TB.read_evolved(spark, path).collect()}
    assert got == {1: None, 2: 7, 3: 7, 4: None}


def test_replace_window_drops_vanished_groups(spark):
    """A contract's newer version shrinks: by key its old days stay, with
    replace_window they go."""
    from dataclasses import replace
    b1, _ = fx.batches(spark, SF_SMALL)
    one = b1.datapoints.filter(F.col("valid_from") < F.col("valid_to")).orderBy("d_id").limit(1)
    raw = replace(b1, datapoints=one)
    newer = replace(b1, datapoints=one.withColumn("created", F.col("created") + F.expr("INTERVAL 9 DAYS"))
                    .withColumn("equipment_id", F.lit(6).cast("bigint")).withColumn("load_date", F.lit("2025-09-06").cast("date")))
    counts = []
    for window in (False, True):
        root = scratch_path(spark, "test-window")
        P.run_full(spark, raw, root, fx.BATCH1_LOAD_DATE)
        before = P.stored_mart(spark, root).count()
        P.run_incremental(spark, newer, root, fx.BATCH2_LOAD_DATE, P.SNAPSHOT_TS, replace_window=window)
        counts.append(P.stored_mart(spark, root).count() - before)
    assert counts[1] == 0 and counts[0] > 0
