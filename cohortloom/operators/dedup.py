"""Keep-first and keep-last, duplicate groups, modes and set operations, with map-side combination."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order (rows with a null key are one group each key's null).

    An aggregate, not a window: copies are combined before the shuffle, so a hot key is no hot task. The order
    must be total for a determined result.
    """
    ks = [(F.col(k) if isinstance(k, str) else k).alias(f"_k{i}") for i, k in enumerate(keys)]
    by = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    grouped = df.select(*ks, F.struct(*df.columns).alias("_row"), by.alias("_by")).groupBy(*[f"_k{i}" for i in range(len(ks))])
    return grouped.agg(F.min_by("_row", "_by").alias("_row")).select("_row.*")


def keep_last(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """The last row of each key in the given order."""
    ks = [(F.col(k) if isinstance(k, str) else k).alias(f"_k{i}") for i, k in enumerate(keys)]
    by = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    grouped = df.select(*ks, F.struct(*df.columns).alias("_row"), by.alias("_by")).groupBy(*[f"_k{i}" for i in range(len(ks))])
    return grouped.agg(F.max_by("_row", "_by").alias("_row")).select("_row.*")


def duplicate_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once; the counts are aggregated before they are joined back."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    cond = None
    right = counts.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    return df.join(right, cond, "left_semi")


def mode_first_seen(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """The most frequent value of each key; ties go to the one seen first. Null and empty values don't count."""
    counts = df.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct(F.col("_n"), -F.col("_first"))).alias(value), F.max("_n").alias("n"))


def top_counts(df: DataFrame, value: str, order: str, k: int) -> DataFrame:
    """The k most frequent values with their counts; ties in the order in which they were first seen."""
    return df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).orderBy(F.desc("n"), "first").limit(k).select(value, "n")


def merged_by_title(first: DataFrame, second: DataFrame, title: str, order: Sequence[str]) -> DataFrame:
    """Rows of both sources, one for each normalised title: those of the first source win, then the earliest."""
    from cohortloom.functions.text import title_key

    both = first.withColumn("_rank", F.lit(0)).unionByName(second.withColumn("_rank", F.lit(1)))
    return keep_first(both, [title_key(F.col(title))], ["_rank", *order]).drop("_rank")


def replace_rows(stored: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """Upsert: rows of ``incoming`` replace those of the same key; of repeats the last holds."""
    new = keep_last(incoming, [key], [order])
    return stored.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Rows with their number within the key."""
    return df.withColumn("row_no", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
