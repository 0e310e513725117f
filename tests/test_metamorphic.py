"""Properties that must hold on the real tables: order, partitioning and exact copies."""

from pyspark.sql import functions as F
from conftest import SF0001, rows

from listenkpi import daily_kpis, daily_kpis_per_play, plays_with_songs
from listenkpi.operators import quality
from listenkpi.sources import views

COLS = ["date", "track_genre", "listen_count", "unique_listeners", "total_listening_time",
        "avg_listening_time_per_user", "top_3_songs_per_genre", "top_5_genres_per_day"]


def test_partitioning_and_row_order_change_nothing(spark):
    plays, songs, _ = views.domain(spark, SF0001)
    base = rows(daily_kpis(plays, songs), *COLS)
    shuffled = plays.repartition(7).orderBy(F.rand(3))
    assert rows(daily_kpis(shuffled, songs.repartition(3)), *COLS) == base


def test_exact_copies_change_nothing_in_job_and_double_notebook_counts(spark):
    plays, songs, _ = views.domain(spark, SF0001)
    doubled = plays.unionByName(plays)
    assert rows(daily_kpis(doubled, songs), *COLS) == rows(daily_kpis(plays, songs), *COLS)
    once = {(r["date"], r["track_genre"]): r["listen_count"] for r in daily_kpis_per_play(plays, songs).collect()}
    twice = {(r["date"], r["track_genre"]): r["listen_count"] for r in daily_kpis_per_play(doubled, songs).collect()}
    assert twice == {k: 2 * v for k, v in once.items()}


def test_listen_counts_sum_to_joined_plays_per_day(spark):
    plays, songs, _ = views.domain(spark, SF0001)
    per_day = {r["date"]: r["n"] for r in daily_kpis(plays, songs).groupBy("date")
               .agg(F.sum("listen_count").alias("n")).collect()}
    merged = plays_with_songs(quality.clean_plays(plays), quality.clean_songs(songs))
    joined = {r["date"]: r["n"] for r in merged.groupBy("date").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per_day == joined


def test_salted_song_join_gives_the_same_result(spark):
    plays, songs, _ = views.domain(spark, SF0001)
    assert rows(daily_kpis(plays, songs, salt_buckets=4), *COLS) == rows(daily_kpis(plays, songs), *COLS)


def test_plays_without_a_track_are_spread_and_kept(spark):
    from listenkpi.operators import enrich
    from listenkpi.plans import inspect
    plays = spark.range(200).selectExpr("concat('u', id) as user_id", "case when id % 2 = 0 then null else 't1' end as track_id",
                                        "'2024-01-01 10:00:00' as listen_time")
    songs = spark.createDataFrame([("t1", "n", "pop", 1)], "track_id string, track_name string, track_genre string, duration_ms bigint")
    got = enrich.join_songs(plays, songs)
    assert sorted({(r["track_id"], r["track_genre"]) for r in got.collect()}, key=str) == [("t1", "pop"), (None, None)] and got.count() == 200
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "_salt" in inspect.plan_text(enrich.join_songs(plays, songs), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
