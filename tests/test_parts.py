"""Heavy hitters, row numbers, mergeable listeners, deltas, observed profiles, malformed rows, ordered export."""

import datetime as dt
import glob
import os

import pytest
from conftest import SF0001, rows
from pyspark.sql import functions as F

from listenkpi import clean_songs, daily_kpis
from listenkpi.operators import enrich, heavy, listeners, numbering, quality
from listenkpi.plans import inspect
from listenkpi.session import scratch_path
from listenkpi.sources import csv as C
from listenkpi.sources import export
from listenkpi.sources.months import MonthTable
from listenkpi.sources.views import domain
from listenkpi.streaming import deltas

PLAYS = "user_id string, track_id string, listen_time string"
SONGS = "track_id string, track_name string, artists string, track_genre string, duration_ms bigint, popularity bigint"


@pytest.fixture
def songs(spark):
    return clean_songs(spark.createDataFrame([("t1", "n1", "a", "pop", 60000, 1), ("t1", "n1", "a", "jazz", 60000, 1), ("t2", "n2", "a", "rock", 30000, 1)], SONGS))


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


def test_hot_tracks_are_broadcast_and_no_song_row_is_repeated(spark, songs, no_broadcast):
    plays = spark.createDataFrame([(f"u{i}", "t1" if i % 3 == 0 else f"x{i}", "2024-01-01") for i in range(900)] + [("u", None, "2024-01-01"), ("v", "t2", "2024-01-01")], PLAYS)
    assert [r["track_id"] for r in heavy.hot_tracks(plays, 0.05).collect()] == ["t1"]
    got, want = heavy.join_songs_hot(plays, songs, 0.05), enrich.join_songs(plays, songs)
    cols = want.columns
    plan = inspect.plan_text(got, "simple")
    assert got.columns == cols and rows(got, *cols) == rows(want, *cols) and got.count() == 300 * 2 + 602
    # the hot tracks' songs by broadcast, the rest by key; nothing is exploded
    assert plan.count("SortMergeJoin") == 1 and "Generate" not in plan and "LeftOuter, BuildRight" in plan
    many = heavy.join_songs_hot(plays, songs, 0.05, most_rows=1)  # too many rows for a hint
    assert inspect.plan_text(many, "simple").count("SortMergeJoin") == 2 and rows(many, *cols) == rows(want, *cols)
    assert heavy.join_songs_hot(plays.limit(0), songs).count() == 0


def test_numbers_are_dense_and_follow_the_order(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k")).repartition(7)
    got = numbering.numbered(df.orderBy("k"), "n", 5).collect()
    assert sorted((r["k"], r["n"]) for r in got) == [(k, k + 5) for k in range(1000)]
    assert numbering.numbered(df.limit(0), "n").count() == 0
    plan = inspect.plan_text(numbering.numbered(df, "n"), "simple")
    assert "Window" not in plan


def test_ordered_export_is_in_order_file_by_file(spark, tmp_path):
    df = spark.range(500).select(((F.col("id") * 37) % 500).alias("k"), F.when(F.col("id") % 5 != 0, F.lit('a "q", b')).alias("t")).repartition(6)
    export.write_ordered_csv(df, str(tmp_path / "out"), [F.col("k").desc()], parts=4)
    files = sorted(glob.glob(str(tmp_path / "out" / "part-*.csv")))
    lines = [line for f in files for line in open(f).read().splitlines()[1:]]
    assert len(files) > 1 and [(int(x.split(",")[0]), int(x.rsplit(",", 1)[1])) for x in lines] == [(499 - i, i + 1) for i in range(500)]
    export.write_ordered_csv(df.limit(0), str(tmp_path / "none"), [F.col("k")])


def _listens(spark, rows_):
    return spark.createDataFrame([(dt.date(2024, 1, d) if d else None, g, u) for d, g, u in rows_], "date date, track_genre string, user_id string")


def test_listeners_of_drops_merge_exactly(spark):
    path = scratch_path(spark, "numbers")
    one = _listens(spark, [(1, "pop", "a"), (1, "pop", "b"), (1, "pop", "a"), (2, None, "a"), (None, "pop", "c"), (1, "pop", None)])
    two = _listens(spark, [(1, "pop", "b"), (1, "pop", "d"), (2, "pop", "a")])
    parts = [listeners.listener_bitmaps(x, listeners.number_listeners(x, path)).persist() for x in (one, two)]
    got = listeners.count_listeners(listeners.merge_bitmaps(parts[0].unionByName(parts[1])))
    assert rows(got, "date", "track_genre", "unique_listeners") == rows(
        one.unionByName(two).where("user_id IS NOT NULL").groupBy("date", "track_genre").agg(F.countDistinct("user_id").alias("n")), "date", "track_genre", "n")
    numbers = listeners.number_listeners(two, path)
    assert sorted(r["number"] for r in numbers.collect()) == [1, 2, 3, 4]  # the same again adds none
    many = spark.range(100_000).select(F.lit(dt.date(2024, 1, 1)).alias("date"), F.lit("pop").alias("track_genre"), F.col("id").cast("string").alias("user_id"))
    wide = listeners.listener_bitmaps(many, listeners.number_listeners(many, scratch_path(spark, "numbers-many")))
    assert wide.count() == 4 and listeners.count_listeners(wide).first()["unique_listeners"] == 100_000


def test_bitmaps_of_few_listeners_are_small(spark):
    """A bitmap holds the words that have a listener: of 100 groups with 3 listeners each among 100,000, 3 words each."""
    path = scratch_path(spark, "numbers-sparse")
    users = spark.range(100_000).select(F.lit(None).cast("date").alias("date"), F.lit("x").alias("track_genre"), F.col("id").cast("string").alias("user_id"))
    numbers = listeners.number_listeners(users, path)
    few = numbers.where("number % 333 = 0").select(F.lit(dt.date(2024, 1, 1)).alias("date"), (F.col("number") % 100).cast("string").alias("track_genre"), "user_id")
    made = listeners.listener_bitmaps(few, numbers)
    assert made.agg(F.sum(F.size("listeners.bits")).alias("n")).first()["n"] == few.count()
    twice = listeners.count_listeners(listeners.merge_bitmaps(made.unionByName(made)))
    assert rows(twice, "track_genre", "unique_listeners") == rows(few.groupBy("track_genre").agg(F.countDistinct("user_id").alias("n")), "track_genre", "n")


def _kpis(df):
    return rows(df, *df.columns)


def test_deltas_add_replace_and_can_be_retried(spark, songs, monkeypatch):
    root = scratch_path(spark, "t-deltas")
    make = lambda r: spark.createDataFrame(r, PLAYS)
    a = [("u1", "t1", "2024-01-01 10:00:00"), ("u1", "t1", "2024-01-01 10:00:00"), ("u2", "t2", "2024-02-01 10:00:00"), ("u2", "t9", "bad time"), ("u3", None, "2024-01-01")]
    b = [("u4", "t2", "2024-01-01 11:00:00"), ("u1", "t2", "2024-01-01 12:00:00")]
    deltas.put_drop(spark, root, "a", make(a), songs)
    assert _kpis(deltas.read_delta_kpis(spark, root)) == _kpis(daily_kpis(make(a), songs))
    february = MonthTable(spark, f"{root}/groups").commit()["months"]["2024-02"]
    deltas.put_drop(spark, root, "b", make(b), songs)
    both = _kpis(daily_kpis(make(a + b), songs))
    assert _kpis(deltas.read_delta_kpis(spark, root)) == both
    assert MonthTable(spark, f"{root}/groups").commit()["months"]["2024-02"] == february  # not a month of the drop
    deltas.put_drop(spark, root, "b", make(b), songs)  # a retry
    assert _kpis(deltas.read_delta_kpis(spark, root)) == both
    # the drop comes again with other plays: its old groups go, also one that has no play any more
    new = [("u5", "t1", "2024-01-01 09:00:00"), ("u5", "t2", "2024-03-01 09:00:00")]
    for step in ("_refresh", "keyed_upsert"):  # and fails half-way first
        with monkeypatch.context() as m:
            m.setattr(deltas, step, lambda *a, **b: (_ for _ in ()).throw(OSError("store unreachable")))
            with pytest.raises(OSError):
                deltas.put_drop(spark, root, "a", make(new), songs, version=1)
    deltas.put_drop(spark, root, "a", make(new), songs, version=1)
    assert _kpis(deltas.read_delta_kpis(spark, root)) == _kpis(daily_kpis(make(new + b), songs))
    deltas.put_drop(spark, root, "a", make([]), songs, version=2)
    assert _kpis(deltas.read_delta_kpis(spark, root)) == _kpis(daily_kpis(make(b), songs))


def test_observed_profiles_cost_no_scan_of_their_own(spark, monkeypatch):
    plays, songs_, users = domain(spark, SF0001, "events")
    raw, seen = quality.observed(plays)
    done, after = quality.observed(quality.clean_plays(raw))
    assert inspect.plan_text(done, "simple").count("FileScan") == inspect.plan_text(quality.clean_plays(plays), "simple").count("FileScan") == 1
    staged, told = quality.stage_clean({"plays": plays}, {"plays": quality.clean_plays})
    assert {r["column"]: r["loaded"] for r in told.collect()} == quality.null_profile(plays).first().asDict()
    assert {r["cleaned"] for r in told.collect()} == {0} and staged["plays"].count() == quality.clean_plays(plays).count()


def test_malformed_rows_by_file(spark, tmp_path):
    d = tmp_path / "p"
    os.makedirs(d)
    (d / "a.csv").write_text('user_id,track_id,listen_time\nu1,t1,2024-01-01\nu2,t2\nu3\n\nu4,t4,2024-01-01,x\nu5,"t,5",nonsense\nu6,t6,NA\n')
    (d / "b.csv").write_text('listen_time,user_id,track_id,device\n2024-01-01,u1,t1,"x ""y"", z"\n2024-01-01,u1,t1\n2024-01-01,u1,t1,"d, e",f\n')
    (d / "c.csv").write_text("user_id,track_id,listen_time\n")
    got = {r["path"][-5:]: tuple(r)[1:] for r in C.malformed_rows(spark, str(d), "plays").collect()}
    assert got == {"a.csv": (6, 2, 1, 1), "b.csv": (3, 1, 1, 0)}
    s = tmp_path / "s"
    os.makedirs(s)
    (s / "a.csv").write_text('track_id,track_name,artists,track_genre,duration_ms,popularity\nt1,"a\n""b"", c",x,pop,12,1\nt2,n,x,pop,abc,1.5\nt3,"n\n,m"\n')
    assert [tuple(r)[1:] for r in C.malformed_rows(spark, str(s), "songs").collect()] == [(3, 1, 0, 1)]
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError):
        C.malformed_rows(spark, str(tmp_path / "none"), "plays")


def test_delta_stream_takes_drops_whole(spark, songs, tmp_path):
    head, src, root = "user_id,track_id,listen_time\n", tmp_path / "in", scratch_path(spark, "t-delta-stream")
    a = [("u1", "t1", "2024-01-01 10:00:00"), ("u2", "t2", "2024-01-02 10:00:00")]
    b, late = [("u3", "t1", "2024-01-01 11:00:00")], [("u1", "t1", "2024-01-01 10:00:00"), ("u4", "t2", "2024-01-01 12:00:00")]

    def drop(folder, name, rows_, header=head):
        os.makedirs(src / folder, exist_ok=True)
        (src / folder / name).write_text(header + "".join(",".join(r) + "\n" for r in rows_))

    def run(plays):
        q = deltas.delta_stream(spark, str(src) + "/*", songs, root)
        q.awaitTermination()
        assert q.exception() is None
        assert _kpis(deltas.read_delta_kpis(spark, root)) == _kpis(daily_kpis(spark.createDataFrame(plays, PLAYS), songs))

    drop("a", "1.csv", a)
    drop("b", "1.csv", b)
    drop("b", "bad.csv", [("u9", "t1")], "user_id,track_id\n")
    run(a + b)
    drop("a", "2.csv", late)  # a later file of a drop, with a copy of one of its plays
    run(a + b + late)
