"""Required columns and fixed values of the KPI job.

CSV columns are read as text, named by their file's header (no ``inferSchema`` pass over the data);
numeric song columns are converted after the read (see ``functions.columns.to_long``), so ``230000``
and ``230000.0`` both parse, and a malformed value becomes NULL instead of failing the job.
"""

from __future__ import annotations

# --- Fixed values (must equal the reference's behaviour) -----------------------------------------
# Required columns per input table, in the reference's order.
PLAYS_REQUIRED = ["user_id", "track_id", "listen_time"]
SONGS_REQUIRED = ["track_id", "track_name", "artists", "track_genre", "duration_ms", "popularity"]
USERS_REQUIRED = ["user_id", "user_name", "user_country"]
# Value that replaces NULL strings in the song table.
FILL_VALUE = "Unknown"
# Separator of the ranked lists.
LIST_SEPARATOR = "|"
# List lengths: top songs per (date, genre) and top genres per date.
TOP_SONGS = 3
TOP_GENRES = 5
# Names of the ranking's output columns: a top song, its plays, and the two lists.
TOP_SONG = "top_3_songs"
TOP_SONG_PLAYS = "song_play_count"
SONG_LIST = "top_3_songs_per_genre"
GENRE_LIST = "top_5_genres_per_day"
# Milliseconds per minute, and decimals kept by the rounding.
MS_PER_MINUTE = 60000
ROUND_DIGITS = 2
# Text cells that the pandas CSV reader turns into missing values by default (public pandas
# documentation, ``na_values``); the reference's combine step round-trips every file through it.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# --------------------------------------------------------------------------------------------------

REQUIRED = {"plays": PLAYS_REQUIRED, "songs": SONGS_REQUIRED, "users": USERS_REQUIRED}

# Song columns converted to long after the read.
SONGS_NUMERIC = ["duration_ms", "popularity"]

# Output of the daily job, in column order.
KPI_COLUMNS = [
    "date",
    "track_genre",
    "listen_count",
    "unique_listeners",
    "total_listening_time",
    "avg_listening_time_per_user",
    SONG_LIST,
    GENRE_LIST,
]
