"""Session construction and the shared scratch tables that cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "cohortloom", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the engine is designed for (UTC, ANSI, AQE)."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once for each context, so that workers need no installation."""
    sc = spark.sparkContext
    if getattr(sc, "_cohortloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="cohortloom-"), "cohortloom.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.join("cohortloom", os.path.relpath(path, root)))
    sc.addPyFile(target)  # Spark's own file server sends it; nothing reads the local copy
    sc._cohortloom_shipped = True


def scratch_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; set to a private folder only where it is unset.

    The setting is read from the session, because on a cluster it names storage that all executors share. Without
    it only a local master gets a folder of its own; anything else is refused, as executors could not read it.
    """
    value = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not value:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        value = "file://" + tempfile.mkdtemp(prefix="cohortloom-", dir=os.environ.get("TMPDIR"))
        spark.conf.set("spark.checkpoint.dir", value)
    return value.rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/cohortloom/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> bool:
    """Remove all scratch tables of this application; results that were not written yet can't be read afterwards."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))


_SCOPES: list[str] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are removed at the end, when the results that read them have been written.

        with scratch_scope(spark):
            query(spark, folder).write.parquet(target)
    """
    _SCOPES.append(uuid.uuid4().hex)
    try:
        yield
    finally:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path("/".join([_scratch_root(spark), *_SCOPES]))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _SCOPES.pop()


def materialize(df: DataFrame, label: str = "step", **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back.

    This cuts lineage without keeping blocks on executors, so a lost executor costs nothing: the table is
    re-read from shared storage. The written schema is kept, and an empty frame gives an empty table. ``options`` go to
    the writer.
    """
    spark = df.sparkSession
    path = "/".join([_scratch_root(spark), *_SCOPES, f"{label}-{uuid.uuid4().hex}"])
    df.write.mode("overwrite").options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove scratch tables made by ``materialize`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Each action inside removes its shuffle files at its end; else they stay until the driver collects its garbage.

    A frame must not be run twice inside but through ``materialize``, as its shuffles would be made again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least one task a core: rows that cost much CPU for few bytes would else be coalesced into a few."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
