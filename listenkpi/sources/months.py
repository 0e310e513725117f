"""A table stored by month: one write of the touched months into a folder of their own, then one pointer file.

Layout under its path: ``data/<folder>/month=YYYY-MM/*.parquet`` (a folder for each write, written by Spark
with ``partitionBy``) and ``current.json``, which names, for each month, the folders that are current, and the
columns. A change writes its folder first and then replaces the pointer, so a reader sees the table before or after it,
and a write that dies half-way leaves the table as it was. One writer at a time. Folders that the pointer
no longer names are not read; they go as the store's owner sees fit. The pointer grows with the number of months,
not with rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_DATE = "none"


def month_of(date: Column) -> Column:
    """The month a date belongs to, as text (``none`` for a NULL date). Computed in Spark only: dates of any
    year have one."""
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(NO_DATE))


class MonthTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def commit(self) -> dict:
        """The pointer: ``months`` (month -> folders) and ``schema``; empty before the first write."""
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/current.json")
        files = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(at):
            return {"months": {}, "schema": None}
        stream = files.open(at)  # one small file: no Spark job
        try:
            return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, months: dict[str, list[str]], schema: T.StructType) -> None:
        """Replace the pointer: a draft, renamed over it."""
        hadoop, conf = self.spark.sparkContext._jvm.org.apache.hadoop.fs, self.spark.sparkContext._jsc.hadoopConfiguration()
        draft, target = hadoop.Path(f"{self.path}/.draft-{uuid.uuid4().hex}"), hadoop.Path(f"{self.path}/current.json")
        out = draft.getFileSystem(conf).create(draft)
        out.write(bytearray(json.dumps({"months": months, "schema": schema.json()}).encode()))
        out.close()
        over = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        over[0] = hadoop.Options.Rename.OVERWRITE
        hadoop.FileContext.getFileContext(draft.getFileSystem(conf).getUri(), conf).rename(draft, target, over)

    def read(self, months: list[str] | None = None) -> DataFrame:
        """The rows of ``months`` (all, if not given); only their folders are listed and read."""
        told = self.commit()
        if told["schema"] is None:
            raise ValueError(f"no table at {self.path}")
        schema = T.StructType.fromJson(json.loads(told["schema"]))
        paths = [f"{self.path}/data/{f}/month={m}" for m in sorted(told["months"]) if months is None or m in months
                 for f in told["months"][m]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def folders(self, prefix: str) -> list[str]:
        """The current folders whose name begins with ``prefix``."""
        return sorted({f for told in self.commit()["months"].values() for f in told if f.startswith(prefix)})

    def folders_of(self, months: Sequence[str]) -> set[str]:
        """The current folders that hold rows of ``months``."""
        told = self.commit()["months"]
        return {f for m in months for f in told.get(m, [])}

    def holds(self, folder: str) -> bool:
        return folder in self.folders(folder)

    def read_folder(self, folder: str) -> DataFrame | None:
        """The rows of one write, while the pointer names it; None if it has none."""
        told = self.commit()
        paths = [f"{self.path}/data/{folder}/month={m}" for m in sorted(told["months"]) if folder in told["months"][m]]
        return self.spark.read.schema(T.StructType.fromJson(json.loads(told["schema"]))).parquet(*paths) if paths else None

    def months(self) -> list[str]:
        return sorted(self.commit()["months"])

    def _write(self, df: DataFrame, date: str, folder: str) -> list[str]:
        """Write ``df`` into a folder; returns its months. ``rebalance`` gathers a month's rows in few
        tasks and lets AQE cut what is over the advisory size, so a hot day is written by several tasks, with
        no sampling pass over the input."""
        path = f"{self.path}/data/{folder}"
        rows = df.withColumn("month", month_of(F.col(date)))
        rows.hint("rebalance", F.col("month")).sortWithinPartitions("month", date).write.mode("overwrite").partitionBy("month").parquet(path)
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        found = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
        return sorted(s.getPath().getName().removeprefix("month=") for s in found if s.isDirectory() and "=" in s.getPath().getName())

    def _schema(self, old: dict, df: DataFrame) -> T.StructType:
        """The table's columns, then those that only ``df`` has (NULL in earlier rows)."""
        known = T.StructType.fromJson(json.loads(old["schema"])).fields if old["schema"] else []
        names = {f.name for f in known}
        return T.StructType([*known, *[T.StructField(f.name, f.dataType, True) for f in df.schema.fields if f.name not in names]])

    def append(self, df: DataFrame, date: str, folder: str | None = None, instead: Sequence[str] = ()) -> list[str]:
        """Add rows, as ``folder``, and leave out the folders ``instead``; adding under a name that is current
        already changes nothing (a retry). Returns the months of that folder."""
        folder, old = folder or f"w{uuid.uuid4().hex[:12]}", self.commit()
        months = {m: [x for x in f if x not in instead] for m, f in old["months"].items()}
        if not (own := [m for m, f in months.items() if folder in f]):
            own = self._write(df, date, folder)
            for m in own:
                months.setdefault(m, []).append(folder)
            self._put({m: f for m, f in months.items() if f}, self._schema(old, df))
        return own

    def replace(self, df: DataFrame, date: str, touched: list[str]) -> None:
        """Make ``df`` all rows of the months ``touched``; a month it has no row of goes."""
        folder, old = f"w{uuid.uuid4().hex[:12]}", self.commit()
        own = self._write(df, date, folder)
        if extra := [m for m in own if m not in touched]:
            raise ValueError(f"rows of months outside the change: {extra}")
        months = {m: f for m, f in old["months"].items() if m not in touched}
        self._put({**months, **{m: [folder] for m in own}}, self._schema(old, df))

    def compact(self, date: str, folders: int = 8) -> list[str]:
        """Rewrite the months that are spread over more than ``folders`` folders as one; returns them."""
        large = [m for m, f in self.commit()["months"].items() if len(f) > folders]
        if large:
            self.replace(self.read(large), date, large)
        return large
