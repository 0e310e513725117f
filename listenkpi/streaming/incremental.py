"""Keep the KPI table current as play files arrive (Structured Streaming file source + foreachBatch).

Layout under one shared ``root`` folder:

* ``plays/``: every play received, with all columns of its file, a ``MonthTable`` by the play's date. A
  retried micro-batch finds its folder there and adds nothing.
* ``files/``: one row for each file that came (``path, header, reason, batch_id``), stored by a digest of its drop's
  name, then by batch. ``reason`` tells why a file was set aside: no header, or a required column missing. A bad file
  does not stop the stream.
* ``kpis/``: the KPI table (``keyed_upsert`` by date).
* ``songs/``: the cleaned song table, written once when the stream starts.
* ``_checkpoint/``: the stream's checkpoint (offsets, committed batches).

A *drop* is the folder that a play file lies in. Results depend on the drops, not on how the trigger cuts
them into micro-batches: a play is complete if it has a value in every column of its drop, and each batch
recomputes all dates of the drops that it adds files to. By default the drops of a day add up. With
``replace=True`` a day's numbers are those of one drop alone, of the drops with plays of that day the one
whose folder name sorts last.

Per micro-batch: store the batch, take the dates of its drops, read back the stored plays of those dates
(only their months are listed and read), run the daily job on them and replace those dates. The distinct
count of listeners and the ranking are not incremental aggregates (Spark rejects both on a stream), so the
unit of recompute is the date (``deltas`` keeps counts and bitmaps in place of plays, where a drop's cost may not
follow the days it touches). Dates and paths stay in tables. The driver sees the folders of the batch's files and their
distinct headers, one digest for each drop that has plays of the touched dates, and month names; of
``files/`` only those drops' folders are read, whatever came before.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from listenkpi.functions.columns import named, parse_time
from listenkpi.operators.enrich import SONG_FIELDS
from listenkpi.operators.jobs import kpis_from_clean
from listenkpi.operators.quality import clean_songs
from listenkpi.schemas import KPI_COLUMNS, PLAYS_REQUIRED
from listenkpi.session import ensure_defaults, path_exists, scratch_scope
from listenkpi.sources.csv import file_folders, file_headers, normalize_path, read_files_by_header
from listenkpi.sources.months import MonthTable, month_of
from listenkpi.sources.sinks import keyed_upsert, null_safe_equal, read_keyed, stage

#: Columns of a stored play that are not part of it.
_OWN = ["_date", "_drop", "_header"]


def paths(root: str) -> dict[str, str]:
    root = normalize_path(root)
    return {name: f"{root}/{name}" for name in ("plays", "files", "kpis", "songs")} | {"checkpoint": f"{root}/_checkpoint"}


def play_files(spark: SparkSession, source_dir: str, archive_dir: str | None = None,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the paths of new ``.csv`` play files (``binaryFile`` source; only ``path`` is
    selected, so file contents are not read here). Each micro-batch then reads its files with the
    batch reader: columns are matched by header name, and missing-value tokens are handled the same way
    as in the batch job. Processed files move to ``archive_dir`` when given."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.csv")
    )
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", normalize_path(archive_dir))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(normalize_path(source_dir)).select("path")


def drop_of(path: Column) -> Column:
    """The folder of a file, by its last name."""
    return F.element_at(F.split(path, "/"), -2)


def checked(headers: DataFrame) -> DataFrame:
    """``path, header, reason``: why a file is set aside (NULL: it is taken)."""
    lacking = F.array_except(F.array(*[F.lit(c) for c in PLAYS_REQUIRED]), F.col("header"))
    reason = F.when(F.size("header") == 0, "no header").when(F.size(lacking) > 0, F.concat(F.lit("missing: "), F.array_join(lacking, ", ")))
    return headers.withColumn("reason", reason)


def _digest(drop: Column) -> Column:
    """A drop's name as a folder name."""
    return F.md5(drop)


def store_batch(spark: SparkSession, files: DataFrame, batch_id: int, root: str, na_tokens: bool = True) -> tuple[list[str], list[str]]:
    """Note the files of the batch and store the plays of the good ones; returns the months of its plays (none if
    no file was taken) and the digests of its drops. Idempotent for a batch id."""
    p, folders = paths(root), file_folders(files)
    noted = checked(file_headers(files, folders)).withColumns({"drop": _digest(drop_of(F.col("path"))), "batch_id": F.lit(batch_id).cast("bigint")})
    # a retried batch replaces its own folders
    noted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("drop", "batch_id").parquet(p["files"])
    drops = drop_names(folders)
    good = _noted(spark, root, drops).where(F.col("batch_id") == batch_id).where("reason IS NULL").select("path", "header")
    of_file = {"_drop": drop_of(F.col("path")), "_header": F.array_sort("header")}
    plays = read_files_by_header(spark, good, na_tokens=na_tokens, keep=of_file)
    if plays is None:
        return [], drops
    ts = parse_time("listen_time", plays.schema["listen_time"].dataType)
    return MonthTable(spark, p["plays"]).append(plays.withColumn("_date", F.to_date(ts)), "_date", f"b{batch_id:012d}"), drops


_FILES = "path string, header array<string>, reason string, drop string, batch_id bigint"


def drop_names(folders: list[str]) -> list[str]:
    """The digests of the drops that lie in ``folders``."""
    return sorted({hashlib.md5(f.rsplit("/", 1)[-1].encode()).hexdigest() for f in folders})


def _noted(spark: SparkSession, root: str, drops: list[str]) -> DataFrame:
    """The files noted of ``drops`` (digests). Only those drops' folders are listed and read; a drop of empty files only
    has none."""
    at = paths(root)["files"]
    own = [folder for d in drops if path_exists(spark, folder := f"{at}/drop={d}")]
    return spark.read.schema(_FILES).option("basePath", at).parquet(*own) if own else spark.createDataFrame([], _FILES)


def drop_headers(spark: SparkSession, root: str, drops: list[str]) -> DataFrame:
    """``_drop, header, batch_id`` of the files taken of ``drops`` (digests): their column sets."""
    good = _noted(spark, root, drops).where("reason IS NULL")
    return good.select(drop_of(F.col("path")).alias("_drop"), F.array_sort("header").alias("header"), "batch_id").distinct()


def _complete(plays: DataFrame, headers: DataFrame) -> DataFrame:
    """Stored plays that have a value in every column of their drop. A file that lacks a column which
    another file of its drop has gives no complete play."""
    columns = [c for c in plays.columns if c not in _OWN]
    own = F.lit(True)
    for c in columns:
        own = own & (named(c).isNotNull() | ~F.array_contains("_header", c))
    of_drop = headers.groupBy("_drop").agg(F.array_distinct(F.flatten(F.collect_set("header"))).alias("all"))
    short = headers.join(of_drop, "_drop").where(F.size(F.array_except("all", "header")) > 0).select("_drop", F.col("header").alias("_header"))
    return plays.where(own).join(short.distinct(), ["_drop", "_header"], "left_anti")


def recompute(spark: SparkSession, root: str, songs: DataFrame, dates: DataFrame, months: list[str], replace: bool = False,
              drops: list[str] | None = None) -> None:
    """Recompute the KPIs of ``dates`` (one column ``date``), which lie in ``months``, from the stored
    plays and replace them. ``songs`` is clean. ``drops``: the digests of all drops with plays of those dates, where
    the caller knows them; otherwise they are found in the plays."""
    p = paths(root)
    stored = MonthTable(spark, p["plays"]).read(months)
    stored = stored.join(dates, stored["_date"].eqNullSafe(dates["date"]), "left_semi")
    if replace:
        last = stored.groupBy(F.col("_date").alias("date")).agg(F.max("_drop").alias("last"))
        stored = stored.join(last, stored["_date"].eqNullSafe(last["date"]) & (stored["_drop"] == last["last"]), "left_semi")
    if drops is None:
        drops = [r["d"] for r in stored.select(_digest(F.col("_drop")).alias("d")).distinct().collect()]
    plays = _complete(stored, drop_headers(spark, root, drops)).drop(*_OWN).dropDuplicates()
    keyed_upsert(kpis_from_clean(plays, songs), p["kpis"], replaced=dates, months=months)


def process_batch(spark: SparkSession, root: str, songs: DataFrame, replace: bool = False,
                  na_tokens: bool = True):
    """The ``foreachBatch`` function of ``kpi_stream``. ``songs`` is clean."""
    def run(files: DataFrame, batch_id: int) -> None:
        ensure_defaults(spark)
        with scratch_scope(spark):
            own, batch_drops = store_batch(spark, files.select("path"), batch_id, root, na_tokens)
            if not own:
                return
            plays = MonthTable(spark, paths(root)["plays"])
            name = f"b{batch_id:012d}"
            found = lambda df: df.select("_drop", F.col("_date").alias("date")).distinct()
            own_dates = stage(found(plays.read_folder(name)), "dates", spark)
            # files of one drop may have come in earlier batches: their dates may change with it
            drops = own_dates.select("_drop").distinct()
            batches = [r["batch_id"] for r in drop_headers(spark, root, batch_drops).select("batch_id").distinct().collect()]
            if batches == [batch_id]:
                dates, months = own_dates.select("date").distinct(), own
            else:
                folders = [plays.read_folder(f"b{b:012d}") for b in batches]
                # a compacted table has no folders of batches
                rows = plays.read() if any(f is None for f in folders) else reduce(DataFrame.unionByName, folders)
                dates = stage(found(rows).join(drops, "_drop", "left_semi").select("date").distinct(), "dates", spark)
                months = [r["m"] for r in dates.select(month_of(F.col("date")).alias("m")).distinct().collect()]
            alone = plays.folders_of(months) == {name}  # no play of another drop lies in these months
            recompute(spark, root, songs, dates, months, replace, batch_drops if alone else None)
    return run


def kpi_stream(spark: SparkSession, source_dir: str, songs: DataFrame, root: str,
               archive_dir: str | None = None, max_files_per_trigger: int | None = None,
               available_now: bool = True, replace: bool = False, na_tokens: bool = True) -> StreamingQuery:
    """Start the incremental KPI query; with ``available_now`` it processes what is there and stops.

    ``max_files_per_trigger`` bounds the files of a micro-batch; left unset, each trigger takes all that
    arrived as one batch, which recomputes each touched date once. ``songs`` is cleaned here, once."""
    ensure_defaults(spark)
    p = paths(root)
    clean_songs(songs).select(*SONG_FIELDS).write.mode("overwrite").parquet(p["songs"])
    writer = (
        play_files(spark, source_dir, archive_dir, max_files_per_trigger)
        .writeStream.foreachBatch(process_batch(spark, root, spark.read.parquet(p["songs"]), replace, na_tokens))
        .option("checkpointLocation", p["checkpoint"])
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def compact(spark: SparkSession, root: str, folders: int = 8) -> list[str]:
    """Rewrite the stored plays of months that came in more than ``folders`` batches; run it between
    streams (one writer at a time). Returns the months."""
    return MonthTable(spark, paths(root)["plays"]).compact("_date", folders)


def read_kpis(spark: SparkSession, root: str) -> DataFrame:
    """The KPI table maintained by ``kpi_stream``, in the job's column order."""
    return read_keyed(spark, paths(root)["kpis"], KPI_COLUMNS)


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """``path, reason, batch_id`` of the files set aside."""
    return spark.read.parquet(paths(root)["files"]).where("reason IS NOT NULL").select("path", "reason", "batch_id")
