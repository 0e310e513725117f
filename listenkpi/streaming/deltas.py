"""The KPI table kept by deltas: a drop adds its counts to the stored ones, a replaced drop takes its old ones back.

Layout under one shared ``root`` folder:

* ``counts/``: signed counts, a ``MonthTable`` with one folder for each put: ``_drop, date, track_genre, track_name, plays,
  total_ms``. The first put of a drop has its counts; a later one has what changes, the new counts less the drop's
  earlier rows. A group's counts are the sums over all rows.
* ``marks/``: the listeners of each drop as bitmaps (``operators.listeners``), a ``MonthTable`` with one folder for
  each drop: bitmaps can't be subtracted, so a replaced drop's folder is left out of the pointer.
* ``listeners/``: the number of each listener.
* ``groups/``: KPIs and top songs by (date, genre); ``days/``: top genres by date. Both are keyed tables.

A put reads its drop, the drop's own earlier counts, and the aggregates of the (date, genre) groups that it
touches; no play of another drop is read again. Only those groups are ranked and counted anew, and the genres of their dates.
Dates lie between the first and the last that the drop touches, which prunes the row groups read of its months.

A drop is cleaned by itself (copies within it count once), and drops add up, as separate runs of the reference's
job would: a play that comes in two drops counts in both. Plays without a song are the group without genre.
A put is known by its drop and version; the same put again (a retry after a failure, at whatever step) gives the same tables.
One writer at a time.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from listenkpi.operators.enrich import SONG_FIELDS, listen_table
from listenkpi.operators.kpis import KEYS, kpis_from_totals
from listenkpi.operators.listeners import count_listeners, listener_bitmaps, merge_bitmaps, number_listeners
from listenkpi.operators.quality import clean_plays, clean_songs
from listenkpi.operators.rank import top_genres, top_genres_list, top_songs, top_songs_list
from listenkpi.schemas import GENRE_LIST, KPI_COLUMNS, SONG_LIST, TOP_GENRES, TOP_SONGS
from listenkpi.session import ensure_defaults, scratch_scope
from listenkpi.sources.csv import file_folders, folder_headers, normalize_path, read_files_by_header
from listenkpi.sources.months import MonthTable, month_of
from listenkpi.sources.sinks import keyed_upsert, null_safe_equal, read_keyed, stage
from listenkpi.streaming.incremental import checked, play_files

_NAME = [*KEYS, "track_name"]


def _paths(root: str) -> dict[str, str]:
    return {name: f"{normalize_path(root)}/{name}" for name in ("counts", "marks", "listeners", "groups", "days")}


def _of_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    return rows.join(groups, null_safe_equal(rows, groups, groups.columns), "left_semi")


def _signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.select(*_NAME, (F.col("plays") * sign).alias("plays"), (F.col("total_ms") * sign).alias("total_ms"))


def _put_counts(listens: DataFrame, table: MonthTable, drop: str, folder: str, earlier: list[str]) -> None:
    """The signed counts of the put; every group of the drop, old or new, has rows in it, those of no change too."""
    rows = listens.groupBy(*_NAME).agg(F.sum("plays").alias("plays"), F.sum(F.col("plays") * F.col("duration_ms")).alias("total_ms"))
    for old in earlier:
        rows = rows.unionByName(_signed(table.read_folder(old), -1))
    rows = rows.groupBy(*_NAME).agg(F.sum("plays").alias("plays"), F.sum("total_ms").alias("total_ms"))
    table.append(rows.select(F.lit(drop).alias("_drop"), *_NAME, "plays", "total_ms"), "date", folder)


def put_drop(spark: SparkSession, root: str, drop: str, plays: DataFrame, songs: DataFrame, version: int = 0) -> None:
    """Add a drop's plays to the KPIs at ``root``, or replace what an earlier ``version`` of it added. ``plays`` are as
    read (text or typed times), ``songs`` clean."""
    ensure_defaults(spark)
    p, name = _paths(root), hashlib.md5(drop.encode()).hexdigest()
    folder = f"{name}-{version:012d}"
    counts, marks = MonthTable(spark, p["counts"]), MonthTable(spark, p["marks"])
    with scratch_scope(spark):
        listens = stage(listen_table(clean_plays(plays), songs.select(*SONG_FIELDS)), "drop-listens", spark)
        if not counts.holds(folder):
            _put_counts(listens, counts, drop, folder, counts.folders(f"{name}-"))
        if not marks.holds(folder):
            own = listener_bitmaps(listens, number_listeners(listens, p["listeners"]))
            marks.append(own, "date", folder, instead=marks.folders(f"{name}-"))
        changed = counts.read_folder(folder)
        if changed is None:  # no play at all
            return
        _refresh(spark, p, counts, marks, stage(changed.select(*KEYS).distinct(), "touched", spark))


def _refresh(spark: SparkSession, p: dict[str, str], counts: MonthTable, marks: MonthTable, touched: DataFrame) -> None:
    """KPIs and top songs of the groups ``touched``, and the top genres of their dates."""
    told = touched.agg(F.collect_set(month_of(F.col("date"))).alias("m"), F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    near = F.col("date").isNull() | F.col("date").between(F.lit(told["lo"]), F.lit(told["hi"]))
    now = _of_groups(counts.read(told["m"]).where(near), touched).groupBy(*_NAME).agg(F.sum("plays").alias("play_count"), F.sum("total_ms").alias("total_ms"))
    now = stage(now.where("play_count > 0"), "named-counts", spark)
    totals = now.groupBy(*KEYS).agg(F.sum("play_count").alias("listen_count"), F.sum("total_ms").alias("total_listening_time_ms"))
    heard = count_listeners(merge_bitmaps(_of_groups(marks.read(told["m"]).where(near), touched)))
    raw = totals.join(heard.select(*[F.col(k).alias(f"_{k}") for k in KEYS], "unique_listeners"),
                      F.col("date").eqNullSafe(F.col("_date")) & F.col("track_genre").eqNullSafe(F.col("_track_genre")), "left")
    groups = kpis_from_totals(raw.withColumn("unique_listeners", F.coalesce("unique_listeners", F.lit(0).cast("bigint"))))
    songs = top_songs_list(top_songs(now.select(*_NAME, "play_count"), TOP_SONGS))
    keyed_upsert(groups.join(songs, KEYS, "left"), p["groups"], KEYS, replaced=touched)
    dates = touched.select("date").distinct()
    ranked = top_genres(_of_groups(MonthTable(spark, p["groups"]).read(told["m"]).where(near), dates), TOP_GENRES)
    keyed_upsert(top_genres_list(ranked), p["days"], replaced=dates)


def process_drops(spark: SparkSession, root: str, songs: DataFrame, na_tokens: bool = True):
    """The ``foreachBatch`` function of ``delta_stream``. ``songs`` is clean."""
    def run(files: DataFrame, batch_id: int) -> None:
        paths = files.select("path")
        for folder in file_folders(paths):
            drop = folder.rsplit("/", 1)[-1]
            headers = checked(folder_headers(spark, folder)).where("reason IS NULL").select("path", "header")
            plays = read_files_by_header(spark, headers, na_tokens=na_tokens)
            if plays is not None:
                put_drop(spark, root, drop, plays, songs, version=batch_id)
    return run


def delta_stream(spark: SparkSession, source_dir: str, songs: DataFrame, root: str, na_tokens: bool = True) -> StreamingQuery:
    """Start the query that keeps the KPIs at ``root`` by deltas: each new play file's drop (its folder) is put again, whole,
    in place of what it had added, so results don't depend on how files come in batches. Processes what is there and
    stops. Files must stay in their folders while their drop may still grow; a file without a header or a required
    column is passed over. The drops of a batch are put one after the other."""
    ensure_defaults(spark)
    state = normalize_path(root)
    clean_songs(songs).select(*SONG_FIELDS).write.mode("overwrite").parquet(f"{state}/songs")
    writer = play_files(spark, source_dir).writeStream.foreachBatch(process_drops(spark, root, spark.read.parquet(f"{state}/songs"), na_tokens))
    return writer.option("checkpointLocation", f"{state}/_checkpoint").trigger(availableNow=True).start()


def read_delta_kpis(spark: SparkSession, root: str) -> DataFrame:
    """The KPI table, in the job's column order."""
    p = _paths(root)
    groups, days = read_keyed(spark, p["groups"]), read_keyed(spark, p["days"])
    return groups.select(*KPI_COLUMNS[:6], SONG_LIST).join(days.select("date", GENRE_LIST), "date", "left").select(*KPI_COLUMNS)
