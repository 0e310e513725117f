"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator or composite query

View B (``orders``: line items as plays) is the default; ``_events`` variants use view A.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from listenkpi.operators import diagnostics, enrich, heavy, jobs, kpis, listeners, quality, rank
from listenkpi.schemas import KPI_COLUMNS
from listenkpi.session import ensure_defaults, scratch_path
from listenkpi.sources import csv as csv_source
from listenkpi.sources import export, records, sinks, views
from listenkpi.streaming import deltas, incremental

Query = Callable[[SparkSession, str], DataFrame]


def _domain(spark: SparkSession, sf_dir: str, view: str = "orders"):
    ensure_defaults(spark)
    return views.domain(spark, sf_dir, view)


def _listens(spark: SparkSession, sf_dir: str, view: str = "orders") -> DataFrame:
    plays, songs, _ = _domain(spark, sf_dir, view)
    return enrich.listen_table(quality.clean_plays(plays), quality.clean_songs(songs))


# --- Q1 / Q2: full jobs ----------------------------------------------------------------------------

def daily_genre_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1, the flagship: the daily job on view B."""
    plays, songs, _ = _domain(spark, sf_dir)
    return jobs.daily_kpis(plays, songs)


def daily_genre_kpis_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 on view A (events as plays; error events have no listener)."""
    plays, songs, _ = _domain(spark, sf_dir, "events")
    return jobs.daily_kpis(plays, songs)


def daily_genre_kpis_per_play(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2, the notebook variant, on view B."""
    plays, songs, _ = _domain(spark, sf_dir)
    return jobs.daily_kpis_per_play(plays, songs)


def daily_genre_kpis_per_play_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 on view A: NULL listeners count as plays, not as listeners."""
    plays, songs, _ = _domain(spark, sf_dir, "events")
    return jobs.daily_kpis_per_play(plays, songs)


# --- parts of Q1 -----------------------------------------------------------------------------------

def genre_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: genre KPIs alone (A1-A4)."""
    return kpis.genre_kpis(_listens(spark, sf_dir))


def plays_with_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + P6/P7: cleaned plays left-joined to cleaned songs, one row per play and song row."""
    plays, songs, _ = _domain(spark, sf_dir)
    return enrich.plays_with_songs(quality.clean_plays(plays), quality.clean_songs(songs))


def song_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays per (date, genre, song name)."""
    return rank.song_plays(_listens(spark, sf_dir))


def top_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 songs per (date, genre), one row per song."""
    return rank.top_songs(rank.song_plays(_listens(spark, sf_dir)))


def top_songs_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top 3 songs per (date, genre) as one ``|``-joined string."""
    return rank.top_songs_list(rank.top_songs(rank.song_plays(_listens(spark, sf_dir))))


def top_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 5 genres per date, with rank."""
    return rank.top_genres(kpis.genre_kpis(_listens(spark, sf_dir)))


def top_genres_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top 5 genres per date as one ``|``-joined string."""
    return rank.top_genres_list(rank.top_genres(kpis.genre_kpis(_listens(spark, sf_dir))))


# --- data quality (Q6) -----------------------------------------------------------------------------

def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL count per column of plays (view A), songs and users, as loaded."""
    plays, songs, users = _domain(spark, sf_dir, "events")
    return quality.null_profile_long({"plays": plays, "songs": songs, "users": users})


def null_profile_after_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: the same profile after cleaning (all zero by construction of the cleaning)."""
    plays, songs, users = _domain(spark, sf_dir, "events")
    return quality.null_profile_long({
        "plays": quality.clean_plays(plays),
        "songs": quality.clean_songs(songs),
        "users": quality.clean_users(users),
    })


def fill_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs with NULL strings replaced by ``Unknown``; numeric NULLs stay."""
    _, songs, _ = _domain(spark, sf_dir)
    return quality.fill_unknown(songs)


def distinct_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-row distinct plays (view A)."""
    plays, _, _ = _domain(spark, sf_dir, "events")
    return quality.distinct_rows(plays)


def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: plays (view A) without any NULL field."""
    plays, _, _ = _domain(spark, sf_dir, "events")
    return quality.drop_incomplete(plays)


def clean_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2-C4 in the job's order on songs: fill, drop incomplete, distinct."""
    _, songs, _ = _domain(spark, sf_dir)
    return quality.clean_songs(songs)


def clean_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3/C4 on users: complete rows, each distinct row once (users are cleaned, never joined)."""
    _, _, users = _domain(spark, sf_dir)
    return quality.clean_users(users)


def plays_with_songs_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 on view A: cleaned event plays left-joined to cleaned songs."""
    plays, songs, _ = _domain(spark, sf_dir, "events")
    return enrich.plays_with_songs(quality.clean_plays(plays), quality.clean_songs(songs))


# --- diagnostics (J4, J5) --------------------------------------------------------------------------

def ambiguous_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks with more than one cleaned song row (their plays fan out)."""
    _, songs, _ = _domain(spark, sf_dir)
    return diagnostics.ambiguous_tracks(quality.clean_songs(songs))


def plays_without_song(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned plays whose track has no cleaned song (the NULL-genre group)."""
    plays, songs, _ = _domain(spark, sf_dir)
    return diagnostics.plays_without_song(quality.clean_plays(plays), quality.clean_songs(songs))


def plays_with_songs_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 with a heavy hitter: a third of the plays (by listener and track) are of track 1, whose song rows are broadcast;
    the other tracks are joined by key."""
    plays, songs, _ = _domain(spark, sf_dir)
    hot = F.when((F.col("user_id") + F.col("track_id")) % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("track_id"))
    plays = sinks.stage(quality.clean_plays(plays.withColumn("track_id", hot)), "plays")
    return enrich.with_date(heavy.join_songs_hot(plays, quality.clean_songs(songs)))


def observed_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 / Q6 inside the job: the NULL counts of plays (view A), songs and users as loaded and as cleaned, observed by the
    one write that stages each cleaned table."""
    tables = dict(zip(("plays", "songs", "users"), _domain(spark, sf_dir, "events"), strict=True))
    _, profile = quality.stage_clean(tables, {"plays": quality.clean_plays, "songs": quality.clean_songs, "users": quality.clean_users})
    return profile


# --- sources and sinks (S1-S9, C5-C7, Q7) ---------------------------------------------------------
# These queries write the view's tables as CSV folders under the shared scratch folder, then run the
# readers (or writers) under test over them; the result must equal the same query on the tables.

SPLIT_DATE = "1998-01-01"
#: Inside a month, so that a month of the keyed table is really merged.
UPSERT_DATE = "1998-03-15"


def _early(date: str = SPLIT_DATE):
    """Plays before the date; those without a time are not early, so no play falls between the parts."""
    return F.coalesce(F.col("listen_time") < F.lit(date).cast("timestamp"), F.lit(False))


def _write_inputs(spark: SparkSession, sf_dir: str, root: str) -> None:
    """CSV drops of the three tables under ``root``: ``streams/`` (plays), ``songs/``, ``users/``."""
    plays, songs, users = _domain(spark, sf_dir)
    sinks.write_csv(plays, f"{root}/streams")
    sinks.write_csv(songs, f"{root}/songs")
    sinks.write_csv(users, f"{root}/users")


def csv_roundtrip_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job read back from CSV folders (typed after the read)."""
    root = scratch_path(spark, "csv-roundtrip")
    _write_inputs(spark, sf_dir, root)
    t = csv_source.load_inputs(spark, root)
    return jobs.daily_kpis(t["plays"], t["songs"])


def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of play files whose columns come in two different orders (by ship year);
    the union by name must give the same KPIs as the table itself."""
    plays, songs, _ = _domain(spark, sf_dir)
    root = scratch_path(spark, "csv-mixed")
    sinks.write_csv(plays.where(_early()).select("user_id", "track_id", "listen_time"), f"{root}/a")
    sinks.write_csv(plays.where(~_early()).select("listen_time", "track_id", "user_id"), f"{root}/b")
    return kpis.genre_kpis(enrich.listen_table(
        quality.clean_plays(csv_source.read_plays(spark, root)), quality.clean_songs(songs)))


def _write_under(lines: DataFrame, head: list[str], path: str) -> None:
    """Write ready CSV lines (``value``) by as many tasks as there are, under the lines ``head`` in each file; one file has
    those alone."""
    lines = lines.unionByName(lines.sparkSession.range(0, 1, 1, 1).select(F.lit(None).cast("string").alias("value")))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # of its task, and so of its file
    told = lines.select("value", first.alias("first")).select(
        F.explode(F.when(F.col("first"), F.array(*map(F.lit, head), F.col("value"))).otherwise(F.array("value"))).alias("value"))
    out = told.where("value IS NOT NULL").write.option("sep", "\u0001").option("emptyValue", "")
    out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def csv_blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play files that begin with blank lines, half of them with another order of columns; the
    header is the first line that isn't blank, and no play is lost."""
    plays, songs, _ = _domain(spark, sf_dir)
    root = scratch_path(spark, "csv-blank")
    for name, cols, rows in (("a", ["user_id", "track_id", "listen_time"], plays.where(_early())),
                             ("b", ["listen_time", "user_id", "track_id"], plays.where(~_early()))):
        line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
        _write_under(rows.select(line.alias("value")), [" ", "  ", ",".join(cols)], f"{root}/{name}")
    return jobs.daily_kpis(csv_source.read_plays(spark, root), songs)


def csv_quoted_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs whose names hold quotes, commas and line breaks, and some that are a missing-value token,
    through the CSV round trip: values are kept, tokens become NULL."""
    _, songs, _ = _domain(spark, sf_dir)
    root = scratch_path(spark, "csv-quoted")
    odd = (F.when(F.col("track_id") % 7 == 0, "NA").when(F.col("track_id") % 5 == 0, F.concat(F.lit('He said "'), F.col("track_name"), F.lit('", twice')))
           .when(F.col("track_id") % 3 == 0, F.concat(F.col("track_name"), F.lit("\nsecond line, "), F.col("track_genre"))).otherwise(F.col("track_name")))
    sinks.write_csv(songs.withColumn("track_name", odd), root)
    return csv_source.read_songs(spark, root).withColumn("track_id", F.col("track_id").cast("bigint"))


def missing_columns_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play files from the ship year 1998 on lack ``listen_time``; report what is missing where (the
    combined table still has the column, so the gate passes). How many files lack it depends on how the
    writer cut them, so that column is left out here."""
    plays, _, _ = _domain(spark, sf_dir)
    root = scratch_path(spark, "csv-missing")
    sinks.write_csv(plays.where(_early()), f"{root}/a")
    sinks.write_csv(plays.where(~_early()).drop("listen_time"), f"{root}/b")
    return csv_source.missing_columns_report(spark, root, "plays").drop("files_missing")


def csv_malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play files with short rows (no time), long rows (a cell more) and times that don't parse, in two drops
    with other orders of columns; how many of each a drop has. (Files are cut by the writer, so their counts are added up.)"""
    plays, _, _ = _domain(spark, sf_dir)
    root = scratch_path(spark, "csv-malformed")
    t, u, at = F.col("track_id"), F.col("user_id"), F.date_format("listen_time", "yyyy-MM-dd HH:mm:ss")
    at = F.when(t % 13 == 0, F.lit("no time")).otherwise(at)
    for name, header, cells, part in (("a", "user_id,track_id,listen_time", [u, t, at], _early()), ("b", "track_id,user_id,note,listen_time", [t, u, F.lit('"one, two"'), at], ~_early())):
        line = F.concat_ws(",", *[c.cast("string") for c in cells])
        line = F.when(t % 7 == 0, F.concat_ws(",", *[c.cast("string") for c in cells[:-1]])).when(t % 11 == 0, F.concat(line, F.lit(",more"))).otherwise(line)
        sinks.write_lines(plays.where(part).select(line.alias("value")), f"{root}/{name}", header)
    found = csv_source.malformed_rows(spark, root, "plays")
    drop = F.regexp_extract("path", "/([ab])/[^/]*$", 1).alias("drop")
    return found.groupBy(drop).agg(*[F.sum(c).alias(c) for c in ("rows", "short_rows", "long_rows", "bad_values")])


def ordered_kpi_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job's rows in their final order as CSV files, each row with its number through all files."""
    plays, songs, _ = _domain(spark, sf_dir)
    path = scratch_path(spark, "ordered")
    kpis_ = jobs.daily_kpis(plays, songs, ordered=False)
    export.write_ordered_csv(kpis_, path, jobs.final_order())
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kpis_.schema.fields)
    return spark.read.schema(f"{schema}, row bigint").option("header", True).option("escape", '"').option("nullValue", export.NULL).csv(path)


def column_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops of which no song file has ``popularity`` and no user file ``user_country``: the gate
    refuses them, and the report tells for each required column whether it is there."""
    plays, songs, users = _domain(spark, sf_dir)
    root = scratch_path(spark, "csv-gate")
    for name, df in (("plays", plays), ("songs", songs.drop("popularity")), ("users", users.drop("user_country"))):
        sinks.write_csv(df, f"{root}/{name}")
    tables = {t: csv_source.read_table(spark, f"{root}/{t}", t, require=False) for t in ("plays", "songs", "users")}
    try:
        quality.validate(tables)
        refused = False
    except ValueError:
        refused = True
    return quality.column_report(spark, tables).withColumn("refused", F.lit(refused))


def load_and_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combine the three CSV drops, check them, stage them as Parquet; row count per
    staged table."""
    root = scratch_path(spark, "load")
    _write_inputs(spark, sf_dir, root)
    staged = sinks.stage_tables(csv_source.load_inputs(spark, root), f"{root}/stage")
    parts = [spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, path in staged.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def kpi_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish a first version of the days up to a date (their plays with an even track only) and all
    earlier days, then put the days from that date on. The table read back holds the earlier days untouched
    and the later ones as put last; the date lies inside a month."""
    plays, songs, _ = _domain(spark, sf_dir)
    path = scratch_path(spark, "kpi-table")
    late = ~_early(UPSERT_DATE)
    draft = plays.where(~late | (F.col("track_id") % 2 == 0))
    sinks.keyed_upsert(jobs.daily_kpis(draft, songs, ordered=False), path)
    sinks.keyed_upsert(jobs.daily_kpis(plays.where(late), songs, ordered=False), path)
    return sinks.read_keyed(spark, path, KPI_COLUMNS)


def kpi_put_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 with item keys: the KPIs of all days are put, then those of the plays with an even track are put
    by (date, genre): items of both are replaced, genres of a day that have no such play stay."""
    plays, songs, _ = _domain(spark, sf_dir)
    path = scratch_path(spark, "kpi-items")
    keys = ["date", "track_genre"]
    sinks.keyed_upsert(jobs.daily_kpis(plays, songs, ordered=False), path, keys=keys)
    sinks.keyed_upsert(jobs.daily_kpis(plays.where(F.col("track_id") % 2 == 0), songs, ordered=False), path, keys=keys)
    return sinks.read_keyed(spark, path, KPI_COLUMNS)


def _streamed(spark: SparkSession, songs: DataFrame, root: str) -> None:
    q = incremental.kpi_stream(spark, f"{root}/incoming/*", songs, f"{root}/state", archive_dir=f"{root}/archive")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def kpi_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays arrive as two CSV drops, taken by two runs of the file stream: first all but a late tenth
    (by listener and track) of the plays of 1998, then that tenth, for days already published. The second
    run recomputes the days it touches; the final table equals the daily job over all plays."""
    plays, songs, _ = _domain(spark, sf_dir)
    root = scratch_path(spark, "incremental")
    of_1998 = F.coalesce(F.year("listen_time") == 1998, F.lit(False))
    late = of_1998 & F.coalesce((F.col("user_id") + F.col("track_id")) % 10 == 0, F.lit(False))
    for name, rows in (("drop1", plays.where(~late)), ("drop2", plays.where(late))):
        sinks.write_csv(rows, f"{root}/incoming/{name}")
        _streamed(spark, songs, root)
    return incremental.read_kpis(spark, f"{root}/state")


def kpi_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 by deltas: a first drop comes as a draft (its plays with an even track), then a late tenth of the plays
    of 1998 as a second drop, then the first drop again, whole, in place of the draft. No play of another drop is read
    again; the table equals the daily job over all plays."""
    plays, songs, _ = _domain(spark, sf_dir)
    root, songs = scratch_path(spark, "deltas"), quality.clean_songs(songs)
    of_1998 = F.coalesce(F.year("listen_time") == 1998, F.lit(False))
    late = of_1998 & F.coalesce((F.col("user_id") + F.col("track_id")) % 10 == 0, F.lit(False))
    deltas.put_drop(spark, root, "main", plays.where(~late & (F.col("track_id") % 2 == 0)), songs)
    deltas.put_drop(spark, root, "late", plays.where(late), songs)
    deltas.put_drop(spark, root, "main", plays.where(~late), songs, version=1)
    return deltas.read_delta_kpis(spark, root)


def kpi_merged_listeners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 from mergeable parts: the listeners of two drops (by listener and track, so each day is in both) are
    bitmaps made apart, which are then merged and counted."""
    plays, songs, _ = _domain(spark, sf_dir)
    path = scratch_path(spark, "listener-numbers")
    half = F.coalesce((F.col("user_id") + F.col("track_id")) % 2 == 0, F.lit(False))
    parts = []
    for rows in (plays.where(half), plays.where(~half)):
        listens = sinks.stage(enrich.listen_table(quality.clean_plays(rows), quality.clean_songs(songs)), "listens")
        parts.append(sinks.stage(listeners.listener_bitmaps(listens, listeners.number_listeners(listens, path)), "bitmaps"))
    return listeners.count_listeners(listeners.merge_bitmaps(parts[0].unionByName(parts[1])))


def incremental_extra_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 with a further column ``device`` in the play files, which some plays lack: like the batch job, the
    stream drops plays that are incomplete in any column of their file."""
    plays, songs, _ = _domain(spark, sf_dir)
    root = scratch_path(spark, "incremental-extra")
    device = F.when(F.col("track_id") % 7 != 0, F.concat(F.lit("d"), (F.col("user_id") % 3).cast("string")))
    sinks.write_csv(plays.withColumn("device", device), f"{root}/incoming/drop1")
    _streamed(spark, songs, root)
    return incremental.read_kpis(spark, f"{root}/state")


def expand_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records (one per customer) parsed, expanded to one row per person, messaged."""
    ensure_defaults(spark)
    recs = records.customer_records(views.table(spark, sf_dir, "customer"), views.table(spark, sf_dir, "nation"))
    return records.expand_records(recs)


REGISTRY: dict[str, Query] = {
    "daily_genre_kpis": daily_genre_kpis,
    "daily_genre_kpis_events": daily_genre_kpis_events,
    "daily_genre_kpis_per_play": daily_genre_kpis_per_play,
    "daily_genre_kpis_per_play_events": daily_genre_kpis_per_play_events,
    "genre_kpis": genre_kpis,
    "plays_with_songs": plays_with_songs,
    "song_plays": song_plays,
    "top_songs": top_songs,
    "top_songs_list": top_songs_list,
    "top_genres": top_genres,
    "top_genres_list": top_genres_list,
    "null_profile": null_profile,
    "null_profile_after_clean": null_profile_after_clean,
    "fill_unknown": fill_unknown,
    "distinct_plays": distinct_plays,
    "drop_incomplete": drop_incomplete,
    "clean_songs": clean_songs,
    "clean_users": clean_users,
    "plays_with_songs_events": plays_with_songs_events,
    "ambiguous_tracks": ambiguous_tracks,
    "plays_without_song": plays_without_song,
    "csv_roundtrip_kpis": csv_roundtrip_kpis,
    "csv_mixed_headers": csv_mixed_headers,
    "csv_blank_lines": csv_blank_lines,
    "csv_quoted_songs": csv_quoted_songs,
    "missing_columns_report": missing_columns_report,
    "column_gate": column_gate,
    "load_and_stage": load_and_stage,
    "kpi_upsert": kpi_upsert,
    "kpi_put_items": kpi_put_items,
    "kpi_incremental": kpi_incremental,
    "incremental_extra_columns": incremental_extra_columns,
    "plays_with_songs_skewed": plays_with_songs_skewed,
    "observed_profile": observed_profile,
    "csv_malformed_rows": csv_malformed_rows,
    "ordered_kpi_export": ordered_kpi_export,
    "kpi_delta": kpi_delta,
    "kpi_merged_listeners": kpi_merged_listeners,
    "expand_records": expand_records,
}
