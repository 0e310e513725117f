"""Edge fixtures: small inline tables with expected results worked out by hand."""

import datetime as dt

from conftest import rows

from listenkpi import daily_kpis, daily_kpis_per_play

D1 = dt.date(2024, 1, 1)
D2 = dt.date(2024, 1, 2)


def song(tid, name, genre="pop", dur=60000, artists="a", pop=1):
    return (tid, name, artists, genre, dur, pop)


def play(user, tid, t="2024-01-01 10:00:00"):
    return (user, tid, t)


def by_genre(df):
    return {r["track_genre"]: r for r in df.collect()}


def test_tie_breaks_by_name(make):
    plays, songs = make([play("u1", "t1"), play("u2", "t2")], [song("t1", "beta"), song("t2", "alpha")])
    out = by_genre(daily_kpis(plays, songs, k_songs=1))
    assert out["pop"]["top_3_songs_per_genre"] == "alpha"


def test_top3_cut_in_rank_order(make):
    ps = [play(f"u{i}", t) for t, n in [("t1", 4), ("t2", 3), ("t3", 2), ("t4", 1)] for i in range(n)]
    songs = [song("t1", "a4"), song("t2", "b3"), song("t3", "c2"), song("t4", "d1")]
    plays, s = make(ps, songs)
    out = by_genre(daily_kpis(plays, s))
    assert out["pop"]["top_3_songs_per_genre"] == "a4|b3|c2"
    assert out["pop"]["listen_count"] == 10


def test_play_without_song_is_null_genre_and_takes_a_top5_slot(make):
    ps = [play("u1", "x")] + [play(f"u{i}", f"t{g}") for g in range(5) for i in range(2 + g)]
    songs = [song(f"t{g}", f"s{g}", genre=f"g{g}") for g in range(5)]
    plays, s = make(ps, songs)
    out = by_genre(daily_kpis(plays, s))
    null = out[None]
    assert null["listen_count"] == 1 and null["unique_listeners"] == 1
    assert null["total_listening_time"] is None and null["avg_listening_time_per_user"] is None
    assert null["top_3_songs_per_genre"] is None
    # ranking: g4 (6), g3 (5), g2 (4), g1 (3), g0 (2), NULL (1): the NULL genre is 6th, not listed.
    assert out["g4"]["top_5_genres_per_day"] == "g4|g3|g2|g1|g0"


def test_null_genre_slot_shortens_the_list(make):
    ps = [play(f"u{i}", "x") for i in range(9)] + [play(f"u{i}", f"t{g}") for g in range(5) for i in range(1 + g)]
    songs = [song(f"t{g}", f"s{g}", genre=f"g{g}") for g in range(5)]
    plays, s = make(ps, songs)
    out = by_genre(daily_kpis(plays, s))
    # NULL genre (9 plays) ranks first; its slot is used but its name is skipped: 4 names listed.
    assert out["g4"]["top_5_genres_per_day"] == "g4|g3|g2|g1"


def test_track_in_two_genres_counts_once_in_each(make):
    plays, s = make([play("u1", "t1")], [song("t1", "n", genre="pop"), song("t1", "n", genre="rock")])
    out = by_genre(daily_kpis(plays, s))
    assert out["pop"]["listen_count"] == 1 and out["rock"]["listen_count"] == 1


def test_same_name_two_tracks_merge(make):
    plays, s = make([play("u1", "t1"), play("u2", "t2"), play("u3", "t3")],
                    [song("t1", "same"), song("t2", "same"), song("t3", "other")])
    out = by_genre(daily_kpis(plays, s, k_songs=1))
    assert out["pop"]["top_3_songs_per_genre"] == "same"


def test_exact_copy_counted_once_in_job_twice_in_notebook(make):
    plays, s = make([play("u1", "t1"), play("u1", "t1")], [song("t1", "n")])
    assert by_genre(daily_kpis(plays, s))["pop"]["listen_count"] == 1
    assert by_genre(daily_kpis_per_play(plays, s))["pop"]["listen_count"] == 2


def test_null_user_dropped_in_job_counted_as_play_in_notebook(make):
    plays, s = make([(None, "t1", "2024-01-01 10:00:00"), play("u1", "t1")], [song("t1", "n")])
    job = by_genre(daily_kpis(plays, s))["pop"]
    assert (job["listen_count"], job["unique_listeners"]) == (1, 1)
    nb = by_genre(daily_kpis_per_play(plays, s))["pop"]
    assert (nb["listen_count"], nb["unique_listeners"]) == (2, 1)


def test_song_null_genre_becomes_unknown(make):
    plays, s = make([play("u1", "t1")], [song("t1", "n", genre=None)])
    assert set(by_genre(daily_kpis(plays, s))) == {"Unknown"}


def test_song_null_duration(make):
    plays, s = make([play("u1", "t1")], [song("t1", "n", dur=None)])
    job = by_genre(daily_kpis(plays, s))
    assert set(job) == {None} and job[None]["listen_count"] == 1
    nb = by_genre(daily_kpis_per_play(plays, s))
    assert set(nb) == {"pop"}
    assert nb["pop"]["total_listening_time"] is None and nb["pop"]["avg_play_duration_ms"] is None


def test_bad_time_gives_null_date_group(make):
    plays, s = make([play("u1", "t1", "xx"), play("u2", "t1")], [song("t1", "n")])
    out = rows(daily_kpis(plays, s), "date", "listen_count")
    assert out == [(None, 1), (D1, 1)]


def test_midnight_splits_dates(make):
    plays, s = make([play("u1", "t1", "2024-01-01 23:59:59"), play("u1", "t1", "2024-01-02 00:00:00")],
                    [song("t1", "n")])
    assert rows(daily_kpis(plays, s), "date", "listen_count") == [(D1, 1), (D2, 1)]


def test_half_cent_rounds_up(make):
    plays, s = make([play("u1", "t1")], [song("t1", "n", dur=60300)])
    r = by_genre(daily_kpis(plays, s))["pop"]
    assert r["total_listening_time"] == 1.01 and r["avg_listening_time_per_user"] == 1.01
    plays, s = make([play("u1", "t1")], [song("t1", "n", dur=300)])
    assert by_genre(daily_kpis(plays, s))["pop"]["total_listening_time"] == 0.01


def test_average_divides_by_distinct_listeners(make):
    plays, s = make([play("u1", "t1"), play("u1", "t1", "2024-01-01 11:00:00"), play("u2", "t1")],
                    [song("t1", "n", dur=120000)])
    r = by_genre(daily_kpis(plays, s))["pop"]
    assert (r["listen_count"], r["unique_listeners"]) == (3, 2)
    assert r["total_listening_time"] == 6.0 and r["avg_listening_time_per_user"] == 3.0


def test_output_is_unique_on_date_and_genre(make):
    ps = [play(f"u{i % 3}", f"t{i % 4}", f"2024-01-0{1 + i % 2} 1{i % 10}:00:00") for i in range(40)]
    songs = [song(f"t{i}", f"n{i}", genre=f"g{i % 2}") for i in range(4)]
    plays, s = make(ps, songs)
    out = daily_kpis(plays, s)
    assert out.count() == out.select("date", "track_genre").distinct().count()
