"""CSV folder sources: many files per folder, headers that may differ from file to file.

The input of the job is a folder (or several) of CSV files with a header row. Files may list their
columns in different orders, and some may lack a column. A single ``spark.read.csv`` over such a
folder maps fields by position using one header, silently swapping values between columns. So the
read goes in two distributed steps, both through Spark's own file system (its credentials, its listing):

1. the headers: one text scan of the folders keeps, for each file, the first line of its first block
   that isn't blank (``path, header``, a partial aggregate in each task);
2. the rows. Files of one header are one CSV scan, with the columns that header names, and each file opened
   is checked against it (``enforceSchema`` off), so a file that arrives in between under another header
   fails the read instead of swapping values. Files of several headers are one CSV scan too, by position:
   its rows meet their file's header by ``_metadata.file_path``, and each column is picked at the place
   that header gives it. A column absent from a file is NULL for its rows; a file without a known header
   fails the read.

The driver sees the distinct headers, never the files: the table of files and headers is joined like any
other (Spark broadcasts it if it is small). Where a step takes single files (a micro-batch), it scans the
folders they lie in, whose names come to the driver, and keeps the rows of those files.

All fields are read as text (no ``inferSchema`` pass); typed columns are derived afterwards. Text
cells equal to a pandas missing-value token become NULL when ``na_tokens`` is on (the reference's
combine step round-trips every file through pandas, which does exactly that). As pandas does, blank lines
are skipped, a file without a header is an error, and a repeated column name gets a number. A header is one
line. (Spark's file sources pass over files of zero bytes, so those are no error here.)
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenkpi.functions.columns import named, null_if_token, parse_time, to_long
from listenkpi.operators.quality import validate
from listenkpi.schemas import NA_TOKENS, REQUIRED, SONGS_NUMERIC

HEADER_SCHEMA = "path string, header array<string>"


def normalize_path(path: str) -> str:
    """Drop trailing and doubled slashes after the scheme (``s3://b/x//streams/`` -> ``s3://b/x/streams``)."""
    if "://" in path:
        scheme, rest = path.split("://", 1)
        while "//" in rest:
            rest = rest.replace("//", "/")
        return f"{scheme}://{rest.rstrip('/')}"
    while "//" in path:
        path = path.replace("//", "/")
    return path.rstrip("/") or "/"


def _decoded(path: Column) -> Column:
    """A percent-encoded path, as the file sources' ``path`` column names it."""
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def file_path() -> Column:
    """The row's file, as the file sources' ``path`` column names it (``_metadata`` has it percent-encoded)."""
    return _decoded(F.col("_metadata.file_path"))


def list_files(spark: SparkSession, paths: str | Sequence[str], suffix: str = ".csv") -> DataFrame:
    """``path, length`` of every file under ``paths`` (recursively) whose name ends in ``suffix``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .load([normalize_path(p) for p in paths])
        .select("path", "length")
    )


def _cells_of(record: Column) -> Column:
    """The cells of a record of CSV."""
    plain = F.split(record, ",", -1)
    quoted = F.transform(
        F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(r',("(?:[^"]|"")*+"[^,]*|[^,]*)'), F.lit(1)),
        lambda c: F.when(c.startswith('"'), F.replace(F.regexp_replace(c, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(c),
    )
    return F.when(record.contains('"'), quoted).otherwise(plain)


def _names(line: Column) -> Column:
    """The cells of a header line; repeated names are numbered as pandas does."""
    names = _cells_of(line)
    seen = lambda x, i: F.size(F.filter(F.slice(names, 1, i), lambda y: y == x))
    numbered = F.transform(names, lambda x, i: F.when(seen(x, i) > 0, F.concat(x, F.lit("."), seen(x, i).cast("string"))).otherwise(x))
    return F.when(F.size(F.array_distinct(names)) < F.size(names), numbered).otherwise(names)


def _headers(spark: SparkSession, paths: Sequence[str], deep: bool) -> DataFrame:
    lines = (
        spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", str(deep).lower()).text(list(paths))
        .where("_metadata.file_block_start = 0")
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"), F.monotonically_increasing_id().alias("at"))
    )
    blank = F.col("line").rlike('^\ufeff?\\s*(?:"")?\\s*$')
    # min_by of texts alone would be a sort of every line (their state has no fixed width); with a set beside it, the files are hashed
    first = lines.groupBy("file").agg(F.min_by("line", F.when(~blank, F.col("at"))).alias("line"), F.collect_set(blank).alias("kinds"))
    first = first.select(_decoded(F.col("file")).alias("path"), F.regexp_replace("line", "^\ufeff", "").alias("line"), "kinds")
    told = F.when(F.array_contains("kinds", False), _names(F.col("line")))
    return first.select("path", F.coalesce(told, F.array().cast("array<string>")).alias("header"))


def folder_headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, header`` of each ``.csv`` file under ``paths`` (recursively): its column names; an empty list for a
    file of blank lines only."""
    return _headers(spark, [normalize_path(p) for p in ([paths] if isinstance(paths, str) else paths)], True)


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def file_folders(files: DataFrame) -> list[str]:
    """The folders of ``files`` (``path``)."""
    return sorted(r["folder"] for r in files.select(_folder(F.col("path")).alias("folder")).distinct().collect())


def file_headers(files: DataFrame, folders: list[str] | None = None) -> DataFrame:
    """``path, header`` for each row of ``files`` (``path``), found by a scan of their ``folders`` (found by a job, if not
    given)."""
    folders = file_folders(files) if folders is None else folders
    spark = files.sparkSession
    if not folders:
        return spark.createDataFrame([], HEADER_SCHEMA)
    return _headers(spark, folders, False).join(files.select("path").distinct(), "path", "left_semi")


def _read_group(spark: SparkSession, header: Sequence[str], files: list[str], multi_line: bool = False, check: bool = True) -> DataFrame:
    """One CSV scan of files (or folders) whose ``.csv`` files all have ``header``; with ``check`` each is held to it."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
    numbered = any("." in c and c.rpartition(".")[0] in header for c in header)  # their files hold the bare name
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", numbered or not check)
        .option("mode", "PERMISSIVE")
        .option("quote", '"')
        .option("escape", '"')
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
    )
    if multi_line:
        reader = reader.option("multiLine", True)
    return reader.csv(files)


def _grouped(headers: DataFrame) -> dict[tuple[str, ...], int]:
    """Distinct header -> number of files; raises for files without a header."""
    rows = headers.groupBy("header").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("first")).collect()
    empty = [r for r in rows if not r["header"]]
    if empty:
        raise ValueError(f"{empty[0]['n']} files without a header, such as {empty[0]['first']}")
    return {tuple(r["header"]): r["n"] for r in rows}


def _by_position(spark: SparkSession, headers: DataFrame, known: Sequence[Sequence[str]], scanned: Sequence[str], deep: bool,
                 multi_line: bool = False, only: bool = False, keep: dict[str, Column] | None = None) -> DataFrame:
    """One CSV scan of the folders ``scanned``, whose files have the headers that ``headers`` (``path, header``) tells, all of
    them in ``known``. ``only``: files that ``headers`` doesn't name are left out; otherwise they are an error. ``keep``:
    further columns of each row, worked out from its file's ``path`` and ``header``."""
    names = list(dict.fromkeys(c for header in sorted(known) for c in header))
    width = max(map(len, known))
    cells = [f"_{i}" for i in range(width)]
    reader = (
        spark.read.schema(T.StructType([T.StructField(c, T.StringType(), True) for c in cells]))
        .option("header", True)  # each file's first line goes, whatever its names (enforceSchema)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", str(deep).lower())
    )
    rows = reader.csv(list(scanned)).select(F.array(*cells).alias("_cells"), file_path().alias("_path"))
    # where each column stands under a header: worked out once for each file, not for each row
    wanted = F.array(*[F.lit(c) for c in names])
    places = F.transform(wanted, lambda c: (F.array_position(F.col("header"), c) - 1).cast("int"))
    kept = [c.alias(name) for name, c in (keep or {}).items()]
    told = headers.where(F.size("header") > 0).select(F.col("path").alias("_path"), places.alias("_places"), *kept)
    rows = rows.join(told, "_path", "inner" if only else "left")
    if not only:
        unknown = F.raise_error(F.concat(F.lit("no header was read for "), F.col("_path"))).cast("array<int>")
        rows = rows.withColumn("_places", F.coalesce("_places", unknown))
    place = lambda k: F.get("_places", F.lit(k))
    picked = [F.when(place(k) >= 0, F.get("_cells", place(k))).alias(c) for k, c in enumerate(names)]
    return rows.select(*picked, *(keep or {}))


def read_files_by_header(spark: SparkSession, headers: DataFrame, multi_line: bool = False, na_tokens: bool = True,
                         keep: dict[str, Column] | None = None) -> DataFrame | None:
    """Union by column name of the files of ``headers`` (``path, header``), by one scan of their folders; None
    without any file. The driver sees the folders and the distinct headers. ``keep`` adds columns worked out, once for
    each file, from its ``path`` and ``header``."""
    told = headers.where(F.size("header") > 0).select(_folder(F.col("path")).alias("folder"), "header").distinct().collect()
    if not told:
        return None
    known = {tuple(r["header"]) for r in told}
    out = _by_position(spark, headers, sorted(known), sorted({r["folder"] for r in told}), False, multi_line, only=True, keep=keep)
    return replace_na_tokens(out) if na_tokens else out


def replace_na_tokens(df: DataFrame, tokens: Iterable[str] = NA_TOKENS) -> DataFrame:
    """Text cells equal to a missing-value token -> NULL, in every string column."""
    tokens = list(tokens)
    return df.select(*[
        null_if_token(named(c), tokens).alias(c) if isinstance(df.schema[c].dataType, T.StringType) else named(c)
        for c in df.columns
    ])


def read_csv_folder(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False,
                    na_tokens: bool = True) -> DataFrame:
    """Union by column name of every ``.csv`` file under ``paths``; all columns text.

    Raises ``ValueError`` when there is no file at all, no ``.csv`` file, or a file without a header."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    headers = folder_headers(spark, paths)
    groups = _grouped(headers)
    if not groups:
        if list_files(spark, paths, "").isEmpty():
            raise ValueError(f"No files found in {paths}")
        raise ValueError(f"No .csv files in {paths}")
    if len(groups) > 1:
        out = _by_position(spark, headers, list(groups), [normalize_path(p) for p in paths], True, multi_line)
        return replace_na_tokens(out) if na_tokens else out
    ((header, _),) = groups.items()  # the common case: Spark lists the folders itself, in parallel
    out = _read_group(spark, header, [normalize_path(p) for p in paths], multi_line)
    return replace_na_tokens(out) if na_tokens else out


def typed(df: DataFrame, table: str) -> DataFrame:
    """Typed columns after the text read: song numbers -> long. Ids and names stay text, play
    times stay text until after cleaning (a bad time must survive the NULL drop)."""
    if table == "songs":
        return df.select(*[to_long(c).alias(c) if c in SONGS_NUMERIC else named(c) for c in df.columns])
    return df


def read_table(spark: SparkSession, paths: str | Sequence[str], table: str, na_tokens: bool = True,
               require: bool = True) -> DataFrame:
    """Read one input table (``plays``, ``songs`` or ``users``) from a CSV folder.

    Songs are read as quoted multi-line CSV. With ``require``, a required column missing from every
    file raises ``ValueError`` before anything runs (a column missing from only some files is NULL
    for their rows; ``missing_columns_by_file`` reports them)."""
    df = typed(read_csv_folder(spark, paths, multi_line=(table == "songs"), na_tokens=na_tokens), table)
    if require:
        validate({table: df})
    return df


def read_plays(spark: SparkSession, paths, na_tokens: bool = True) -> DataFrame:
    return read_table(spark, paths, "plays", na_tokens)


def read_songs(spark: SparkSession, paths, na_tokens: bool = True) -> DataFrame:
    return read_table(spark, paths, "songs", na_tokens)


def read_users(spark: SparkSession, paths, na_tokens: bool = True) -> DataFrame:
    return read_table(spark, paths, "users", na_tokens)


def missing_columns_by_file(headers: DataFrame, required: Sequence[str]) -> DataFrame:
    """``path, missing``: for each file lacking a required column, the columns it lacks (no data scan)."""
    req = F.array(*[F.lit(c) for c in required])
    return (
        headers.select("path", F.array_except(req, F.col("header")).alias("missing"))
        .where(F.size("missing") > 0)
    )


def malformed_rows(spark: SparkSession, paths: str | Sequence[str], table: str) -> DataFrame:
    """``path, rows, short_rows, long_rows, bad_values`` for each file with rows: how many have fewer or more cells than the
    file's header, and how many have a cell in a typed column (song numbers, play times) that doesn't parse. The
    read keeps such rows (padded, cut, NULL); this tells where they come from. One scan with Spark's corrupt-record
    column, which holds the record wherever its cells don't fit the schema."""
    paths = [normalize_path(p) for p in ([paths] if isinstance(paths, str) else paths)]
    headers = folder_headers(spark, paths)
    groups = _grouped(headers)
    if not groups:
        raise ValueError(f"No .csv files in {paths}")
    names = list(dict.fromkeys(c for header in sorted(groups) for c in header))
    width = max(map(len, groups))
    cells = [f"_{i}" for i in range(width)]
    rows = (
        spark.read.schema(T.StructType([T.StructField(c, T.StringType(), True) for c in [*cells, "_corrupt"]]))
        .option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
        .option("quote", '"').option("escape", '"').option("multiLine", table == "songs")
        .option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").csv(paths)
        .select(F.array(*cells).alias("_cells"), F.col("_corrupt"), file_path().alias("path"))
        .join(headers, "path")
    )
    size = F.when(F.col("_corrupt").isNull(), F.lit(width)).otherwise(F.size(_cells_of(F.col("_corrupt"))))
    value = lambda c: null_if_token(F.get("_cells", (F.array_position("header", F.lit(c)) - 1).cast("int")), NA_TOKENS)
    parses = {**{c: to_long for c in SONGS_NUMERIC}, "listen_time": lambda x: parse_time(x, T.StringType())}
    typed_columns = [c for c in names if c in (SONGS_NUMERIC if table == "songs" else ["listen_time"] if table == "plays" else [])]
    bad = F.lit(False)
    for c in typed_columns:
        there = F.array_contains("header", c) & value(c).isNotNull()
        bad = bad | F.coalesce(there & parses[c](value(c)).isNull(), F.lit(False))
    return rows.groupBy("path").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(size < F.size("header")).alias("short_rows"),
        F.count_if(size > F.size("header")).alias("long_rows"), F.count_if(bad).alias("bad_values"))


def missing_columns_report(spark: SparkSession, paths: str | Sequence[str], table: str) -> DataFrame:
    """``table, column, present, files_missing, rows_missing`` for every required column of ``table``:
    whether the combined table has it, and how many files and rows lack it. Rows are counted by one scan that
    reads no column; their counts meet the lacking files by path."""
    required = REQUIRED[table]
    paths = [paths] if isinstance(paths, str) else list(paths)
    headers = folder_headers(spark, paths)
    groups = _grouped(headers)
    if not groups:
        raise ValueError(f"No .csv files in {paths}")
    present = set().union(*[set(h) for h in groups])
    lacking = missing_columns_by_file(headers, required)
    rows = _read_group(spark, required, [normalize_path(p) for p in paths], table == "songs", check=False)
    rows = rows.select(file_path().alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
    counts = lacking.join(rows, "path", "left").select(F.explode("missing").alias("column"), "rows").groupBy("column").agg(
        F.count(F.lit(1)).alias("files_missing"), F.sum("rows").alias("rows_missing"))
    cols = spark.createDataFrame([(table, c, c in present) for c in required], "table string, column string, present boolean")
    none = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return cols.join(counts, "column", "left").select("table", "column", "present", none("files_missing"), none("rows_missing"))


def load_inputs(spark: SparkSession, root: str, na_tokens: bool = True) -> dict[str, DataFrame]:
    """Read ``streams/``, ``songs/`` and ``users/`` under ``root`` and check them all (the gate): a
    ``ValueError`` names every table with a missing column, before anything is computed or written."""
    root = normalize_path(root)
    folders = {"plays": f"{root}/streams", "songs": f"{root}/songs", "users": f"{root}/users"}
    tables = {t: read_table(spark, p, t, na_tokens, require=False) for t, p in folders.items()}
    validate(tables)
    return tables
