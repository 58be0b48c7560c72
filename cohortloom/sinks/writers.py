"""Exports and stores."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Measures of a report, which the driver holds, at most.
MAX_MEASURES = 10_000


def flat_columns(df: DataFrame, sep: str = ", ", first: tuple[str, ...] = ()) -> DataFrame:
    """Every column as text or number: lists of text joined, anything nested as JSON; ``first`` columns lead."""
    order = [c for c in first if c in df.columns] + [c for c in df.columns if c not in first]
    out = []
    for c in order:
        kind = df.schema[c].dataType
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            out.append(F.array_join(c, sep).alias(c))
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            out.append(F.to_json(c).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, sep: str = ", ") -> None:
    flat_columns(df, sep).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """One CSV folder for each table."""
    for name, df in tables.items():
        write_csv(df, os.path.join(folder, name))


class TableStore:
    """A table that is replaced as a whole: a new version is written beside the old one, then a pointer is swapped.

    Everything goes through the Hadoop file system, so the folder can be on any storage that Spark reaches. Versions
    are numbered; the pointer is the largest number that has a mark, and a mark is made after its version is written,
    so a run that dies leaves the old version in place.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.fs.mkdirs(self._path())

    def _path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def _current(self) -> int | None:
        names = [f.getPath().getName() for f in self.fs.listStatus(self._path())]
        return max((int(n.removeprefix("CURRENT-")) for n in names if n.startswith("CURRENT-")), default=None)

    def read(self) -> DataFrame | None:
        number = self._current()
        return None if number is None else self.spark.read.parquet(f"{self.folder}/v-{number:08d}")

    def replace(self, df: DataFrame, keep: int = 2) -> None:
        number = (self._current() or 0) + 1
        df.write.mode("overwrite").parquet(f"{self.folder}/v-{number:08d}")
        self.fs.create(self._path(f"CURRENT-{number:08d}"), True).close()
        for old in range(max(1, number - keep - 3), number - keep + 1):  # readers of the version before may still be at work
            self.fs.delete(self._path(f"CURRENT-{old:08d}"), False)
            self.fs.delete(self._path(f"v-{old:08d}"), True)


def summary_file(report: DataFrame, path: str) -> None:
    """A small report (measure, value) as one JSON object; one beyond MAX_MEASURES is refused, not cut."""
    rows = report.limit(MAX_MEASURES + 1).collect()
    if len(rows) > MAX_MEASURES:
        raise ValueError(f"the report has more than {MAX_MEASURES} measures")
    with open(path, "w", encoding="utf-8") as f:
        json.dump({r["measure"]: r["value"] for r in rows}, f, indent=2, ensure_ascii=False, default=str)
