"""listenkpi: daily listening KPIs (plays, listeners, listening time, top songs and genres) on Spark.

Public entry points (DataFrame in, DataFrame out unless noted) are re-exported here.
"""

from listenkpi.operators.diagnostics import ambiguous_tracks, plays_without_song
from listenkpi.operators.enrich import daily_plays, join_songs, listen_table, plays_with_songs, with_date
from listenkpi.operators.heavy import hot_tracks, join_songs_hot
from listenkpi.operators.jobs import daily_kpis, daily_kpis_per_play, kpis_from_clean
from listenkpi.operators.kpis import genre_kpis, genre_kpis_per_play
from listenkpi.operators.listeners import count_listeners, listener_bitmaps, merge_bitmaps, number_listeners
from listenkpi.operators.numbering import numbered
from listenkpi.operators.quality import (
    clean_plays,
    clean_songs,
    clean_users,
    column_report,
    distinct_rows,
    drop_incomplete,
    fill_unknown,
    null_profile,
    null_profile_long,
    observed,
    stage_clean,
    validate,
)
from listenkpi.operators.rank import ranked_list, song_plays, top_genres, top_genres_list, top_songs, top_songs_list
from listenkpi.session import checkpoint_root, ensure_defaults, local_session, scratch_path, scratch_scope
from listenkpi.sources.csv import (
    file_headers,
    folder_headers,
    load_inputs,
    malformed_rows,
    missing_columns_by_file,
    missing_columns_report,
    read_csv_folder,
    read_plays,
    read_songs,
    read_users,
)
from listenkpi.sources.export import write_ordered_csv
from listenkpi.sources.records import expand_records
from listenkpi.sources.months import MonthTable
from listenkpi.sources.sinks import keyed_upsert, read_keyed, stage, write_csv
from listenkpi.streaming.deltas import delta_stream, put_drop, read_delta_kpis
from listenkpi.streaming.incremental import compact, kpi_stream, read_kpis, read_rejects, recompute

__all__ = [name for name in dir() if not name.startswith("_")]
