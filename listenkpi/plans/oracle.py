"""ANSI SQL twins of the registered queries, run by DuckDB on the driver's tables (the correctness
oracle). They restate the domain views and the job's rules independently of the DataFrame code.

DuckDB differs from Spark in ways the SQL below accounts for: NULLs sort last by default (the job
sorts them first), ``string_agg`` of nothing is NULL (``concat_ws`` gives ``""``), ``sum`` of BIGINT is
HUGEINT, and ``round`` on a double is not half-up on the decimal value (Spark's is), so rounding goes
through DECIMAL.
"""

from __future__ import annotations

PLAYS_ORDERS = """
SELECT o_custkey AS user_id, l_partkey AS track_id, l_shipdate AS listen_time
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

PLAYS_EVENTS = """
SELECT CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS track_id,
       ts AS listen_time
FROM events"""

SONGS = """
SELECT p_partkey AS track_id, p_name AS track_name, p_type AS artists,
       CASE WHEN p_type <> 'PROMO' THEN p_brand END AS track_genre,
       CASE WHEN p_size <= 45 THEN CAST(p_size AS BIGINT) * 7919 END AS duration_ms,
       CAST(floor(p_retailprice) AS BIGINT) AS popularity
FROM part
UNION ALL
SELECT p_partkey, p_name, p_type, p_type, CAST(p_size AS BIGINT) * 7919, CAST(floor(p_retailprice) AS BIGINT)
FROM part WHERE p_type = 'LARGE'"""

USERS = """
SELECT c_custkey AS user_id, c_name AS user_name, n_name AS user_country
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

PLAYS = {"orders": PLAYS_ORDERS, "events": PLAYS_EVENTS}

# Ship date splitting the CSV test drops in two (both halves are used).
SPLIT_DATE = "1998-01-01"
# Date, inside a month, that parts the two writes of the keyed table.
UPSERT_DATE = "1998-03-15"


def r2(expr: str) -> str:
    """Half-up rounding to 2 decimals of a double expression, as Spark's ``round``."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38,10)), 2) AS DOUBLE)"


def base_ctes(view: str = "orders") -> str:
    """``pv`` raw plays, ``sv`` raw songs, ``uv`` users, ``s`` clean plays, ``g`` clean songs,
    ``m`` the merged rows with ``date``."""
    return f"""
pv AS ({PLAYS[view]}),
sv AS ({SONGS}),
uv AS ({USERS}),
s AS (SELECT DISTINCT * FROM pv WHERE user_id IS NOT NULL AND track_id IS NOT NULL AND listen_time IS NOT NULL),
sf AS (SELECT track_id, coalesce(track_name, 'Unknown') AS track_name, coalesce(artists, 'Unknown') AS artists,
              coalesce(track_genre, 'Unknown') AS track_genre, duration_ms, popularity FROM sv),
g AS (SELECT DISTINCT * FROM sf WHERE track_id IS NOT NULL AND duration_ms IS NOT NULL AND popularity IS NOT NULL),
m AS (SELECT s.track_id, s.user_id, s.listen_time, g.track_name, g.artists, g.track_genre, g.duration_ms, g.popularity,
             CAST(s.listen_time AS DATE) AS date
      FROM s LEFT JOIN g ON s.track_id = g.track_id)"""


def kpi_ctes() -> str:
    """``k`` genre KPIs, ``p`` song plays, ``r`` ranked songs, ``t3``/``t5`` lists, ``r5`` ranked genres."""
    return f"""
k0 AS (SELECT date, track_genre, count(track_id) AS listen_count, count(DISTINCT user_id) AS unique_listeners,
              CAST(sum(duration_ms) AS BIGINT) AS tms FROM m GROUP BY date, track_genre),
k AS (SELECT date, track_genre, listen_count, unique_listeners,
             {r2('tms / 60000')} AS total_listening_time,
             {r2('tms / unique_listeners / 60000')} AS avg_listening_time_per_user FROM k0),
p AS (SELECT date, track_genre, track_name, count(track_id) AS play_count FROM m GROUP BY date, track_genre, track_name),
r AS (SELECT *, row_number() OVER (PARTITION BY date, track_genre ORDER BY play_count DESC, track_name ASC NULLS FIRST) AS rank FROM p),
t3 AS (SELECT date, track_genre, coalesce(string_agg(track_name, '|' ORDER BY rank), '') AS top_3_songs_per_genre
       FROM r WHERE rank <= 3 GROUP BY date, track_genre),
r5 AS (SELECT date, track_genre, listen_count,
              row_number() OVER (PARTITION BY date ORDER BY listen_count DESC, track_genre ASC NULLS FIRST) AS rank FROM k),
t5 AS (SELECT date, coalesce(string_agg(track_genre, '|' ORDER BY rank), '') AS top_5_genres_per_day
       FROM r5 WHERE rank <= 5 GROUP BY date)"""


KPI_SELECT = """
SELECT k.date, k.track_genre, k.listen_count, k.unique_listeners, k.total_listening_time,
       k.avg_listening_time_per_user, t3.top_3_songs_per_genre, t5.top_5_genres_per_day
FROM k LEFT JOIN t3 ON k.date = t3.date AND k.track_genre = t3.track_genre
       LEFT JOIN t5 ON k.date = t5.date"""


def with_ctes(body: str, view: str = "orders", kpis: bool = True, plays: str = "true") -> str:
    """``plays``: a condition on the raw plays that the query is about."""
    ctes = base_ctes(view).replace(f"pv AS ({PLAYS[view]})", f"pv AS (SELECT * FROM ({PLAYS[view]}) WHERE {plays})")
    return f"WITH {ctes}{',' + kpi_ctes() if kpis else ''}\n{body}"


def daily_genre_kpis(view: str = "orders", plays: str = "true") -> str:
    return with_ctes(KPI_SELECT, view, plays=plays)


LATE = f"coalesce(listen_time >= TIMESTAMP '{UPSERT_DATE}', true)"


def kpi_upsert() -> str:
    """Days before the date as published first, later days as put last."""
    return (f"SELECT * FROM ({daily_genre_kpis(plays=f'NOT ({LATE}) OR track_id % 2 = 0')}) WHERE date < DATE '{UPSERT_DATE}'\n"
            f"UNION ALL\nSELECT * FROM ({daily_genre_kpis(plays=LATE)})")


def kpi_put_items() -> str:
    """The items of the second put, and those of the first that have no successor."""
    return f"""
SELECT * FROM ({daily_genre_kpis(plays='track_id % 2 = 0')})
UNION ALL
SELECT * FROM ({daily_genre_kpis()}) a WHERE NOT EXISTS (
  SELECT 1 FROM ({daily_genre_kpis(plays='track_id % 2 = 0')}) b
  WHERE a.date IS NOT DISTINCT FROM b.date AND a.track_genre IS NOT DISTINCT FROM b.track_genre)"""


def daily_genre_kpis_per_play(view: str = "orders") -> str:
    """Notebook variant: songs filled only, plays as they are."""
    return f"""
WITH pv AS ({PLAYS[view]}),
sv AS ({SONGS}),
g AS (SELECT track_id, coalesce(track_name, 'Unknown') AS track_name, coalesce(track_genre, 'Unknown') AS track_genre,
             duration_ms FROM sv),
m AS (SELECT pv.track_id, pv.user_id, g.track_name, g.track_genre, g.duration_ms, CAST(pv.listen_time AS DATE) AS date
      FROM pv LEFT JOIN g ON pv.track_id = g.track_id),
k AS (SELECT date, track_genre, count(track_id) AS listen_count, count(DISTINCT user_id) AS unique_listeners,
             CAST(sum(duration_ms) AS BIGINT) AS total_listening_time, avg(duration_ms) AS avg_play_duration_ms
      FROM m GROUP BY date, track_genre),
p AS (SELECT date, track_genre, track_name, count(track_id) AS play_count FROM m GROUP BY date, track_genre, track_name),
r AS (SELECT *, row_number() OVER (PARTITION BY date, track_genre ORDER BY play_count DESC, track_name ASC NULLS FIRST) AS rank FROM p),
t3 AS (SELECT date, track_genre, coalesce(string_agg(track_name, '|' ORDER BY rank), '') AS top_3_songs_per_genre
       FROM r WHERE rank <= 3 GROUP BY date, track_genre),
r5 AS (SELECT date, track_genre, row_number() OVER (PARTITION BY date ORDER BY listen_count DESC, track_genre ASC NULLS FIRST) AS rank FROM k),
t5 AS (SELECT date, coalesce(string_agg(track_genre, '|' ORDER BY rank), '') AS top_5_genres_per_day
       FROM r5 WHERE rank <= 5 GROUP BY date)
SELECT k.date, k.track_genre, k.listen_count, k.unique_listeners, k.total_listening_time, k.avg_play_duration_ms,
       t3.top_3_songs_per_genre, t5.top_5_genres_per_day
FROM k LEFT JOIN t3 ON k.date = t3.date AND k.track_genre = t3.track_genre
       LEFT JOIN t5 ON k.date = t5.date"""


def null_profile(source: str, columns: list[str], name: str) -> str:
    parts = [
        f"SELECT '{name}' AS \"table\", '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count FROM {source}"
        for c in columns
    ]
    return "\nUNION ALL\n".join(parts)


def _q(body: str, view: str = "orders", kpis: bool = True) -> str:
    return with_ctes(body, view, kpis)


CLEAN_USERS = "SELECT DISTINCT * FROM uv WHERE user_id IS NOT NULL AND user_name IS NOT NULL AND user_country IS NOT NULL"


def _profiles(plays: str, songs: str, users: str) -> str:
    return "\nUNION ALL\n".join([
        null_profile(plays, ["user_id", "track_id", "listen_time"], "plays"),
        null_profile(songs, ["track_id", "track_name", "artists", "track_genre", "duration_ms", "popularity"], "songs"),
        null_profile(users, ["user_id", "user_name", "user_country"], "users"),
    ])


def oracle_queries() -> dict[str, str]:
    """SQL twin per registered query name."""
    return {
        "daily_genre_kpis": daily_genre_kpis("orders"),
        "daily_genre_kpis_events": daily_genre_kpis("events"),
        "daily_genre_kpis_per_play": daily_genre_kpis_per_play("orders"),
        "daily_genre_kpis_per_play_events": daily_genre_kpis_per_play("events"),
        "genre_kpis": _q("SELECT * FROM k"),
        "plays_with_songs": _q("SELECT * FROM m", kpis=False),
        "song_plays": _q("SELECT date, track_genre, track_name, play_count FROM p"),
        "top_songs": _q("SELECT date, track_genre, track_name AS top_3_songs, play_count AS song_play_count, rank "
                        "FROM r WHERE rank <= 3"),
        "top_songs_list": _q("SELECT * FROM t3"),
        "top_genres": _q("SELECT date, track_genre, listen_count, rank FROM r5 WHERE rank <= 5"),
        "top_genres_list": _q("SELECT * FROM t5"),
        "null_profile": _q(_profiles("pv", "sv", "uv"), "events", kpis=False),
        "null_profile_after_clean": _q(
            f"{_profiles('s', 'g', 'cu')}".replace("FROM cu", f"FROM ({CLEAN_USERS}) cu"), "events", kpis=False
        ),
        "fill_unknown": _q("SELECT * FROM sf", kpis=False),
        "distinct_plays": _q("SELECT DISTINCT * FROM pv", "events", kpis=False),
        "drop_incomplete": _q("SELECT * FROM pv WHERE user_id IS NOT NULL AND track_id IS NOT NULL "
                              "AND listen_time IS NOT NULL", "events", kpis=False),
        "clean_songs": _q("SELECT * FROM g", kpis=False),
        "clean_users": _q(CLEAN_USERS, kpis=False),
        "plays_with_songs_events": _q("SELECT * FROM m", "events", kpis=False),
        "ambiguous_tracks": _q("SELECT track_id, count(*) AS song_rows, count(DISTINCT track_genre) AS genres "
                               "FROM g GROUP BY track_id HAVING count(*) > 1", kpis=False),
        "plays_without_song": _q("SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.track_id = s.track_id)",
                                 kpis=False),
        "csv_roundtrip_kpis": daily_genre_kpis("orders"),
        "csv_mixed_headers": _q("SELECT * FROM k"),
        "missing_columns_report": _q(f"""
SELECT 'plays' AS "table", c AS "column", true AS present,
       CAST(CASE WHEN c = 'listen_time' THEN n ELSE 0 END AS BIGINT) AS rows_missing
FROM (SELECT count(*) FILTER (WHERE coalesce(listen_time >= TIMESTAMP '{SPLIT_DATE}', true)) AS n FROM pv) t,
     (VALUES ('user_id'), ('track_id'), ('listen_time')) v(c)""", kpis=False),
        "csv_blank_lines": daily_genre_kpis("orders"),
        "csv_quoted_songs": _q("""
SELECT track_id, CASE WHEN track_id % 7 = 0 THEN NULL WHEN track_id % 5 = 0 THEN 'He said "' || track_name || '", twice'
         WHEN track_id % 3 = 0 THEN track_name || chr(10) || 'second line, ' || track_genre ELSE track_name END AS track_name,
       artists, track_genre, duration_ms, popularity FROM sv""", kpis=False),
        "column_gate": """
SELECT * FROM (VALUES ('plays', 'user_id', true, true), ('plays', 'track_id', true, true), ('plays', 'listen_time', true, true),
  ('songs', 'track_id', true, true), ('songs', 'track_name', true, true), ('songs', 'artists', true, true), ('songs', 'track_genre', true, true),
  ('songs', 'duration_ms', true, true), ('songs', 'popularity', false, true), ('users', 'user_id', true, true), ('users', 'user_name', true, true),
  ('users', 'user_country', false, true)) t("table", "column", present, refused)""",
        "load_and_stage": _q("""
SELECT 'plays' AS "table", count(*) AS rows FROM pv
UNION ALL SELECT 'songs', count(*) FROM sv
UNION ALL SELECT 'users', count(*) FROM uv""", kpis=False),
        "kpi_upsert": kpi_upsert(),
        "kpi_put_items": kpi_put_items(),
        "kpi_incremental": daily_genre_kpis("orders"),
        "plays_with_songs_skewed": _q("SELECT * FROM m", kpis=False).replace(
            f"({PLAYS['orders']})", f"(SELECT user_id, CASE WHEN (user_id + track_id) % 3 = 0 THEN 1 ELSE track_id END AS track_id, listen_time FROM ({PLAYS['orders']}))"),
        "observed_profile": f"""
SELECT "table", "column", a.null_count AS loaded, b.null_count AS cleaned
FROM ({_q(_profiles("pv", "sv", "uv"), "events", kpis=False)}) a
JOIN ({_q(_profiles("s", "g", "cu").replace("FROM cu", f"FROM ({CLEAN_USERS}) cu"), "events", kpis=False)}) b USING ("table", "column")""",
        "csv_malformed_rows": _q(f"""
SELECT CASE WHEN listen_time < TIMESTAMP '{SPLIT_DATE}' THEN 'a' ELSE 'b' END AS drop, count(*) AS rows,
       count(*) FILTER (WHERE track_id % 7 = 0) AS short_rows, count(*) FILTER (WHERE track_id % 7 <> 0 AND track_id % 11 = 0) AS long_rows,
       count(*) FILTER (WHERE track_id % 7 <> 0 AND track_id % 13 = 0) AS bad_values
FROM pv GROUP BY 1""", kpis=False),
        "ordered_kpi_export": f"""
SELECT *, row_number() OVER (ORDER BY date NULLS FIRST, listen_count DESC, track_genre NULLS FIRST) AS row FROM ({daily_genre_kpis("orders")})""",
        "kpi_delta": daily_genre_kpis("orders"),
        "kpi_merged_listeners": _q("SELECT date, track_genre, unique_listeners FROM k"),
        "incremental_extra_columns": daily_genre_kpis("orders", plays="track_id % 7 <> 0"),
        "expand_records": """
SELECT CAST(1 AS BIGINT) AS number, n_name AS craft, c_name AS name,
       c_name || ' is currently in space flying on the ' || n_name || '! Hello! :)' AS message,
       true AS number_matches
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    }
