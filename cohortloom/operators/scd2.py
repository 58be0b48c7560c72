"""Version history (SCD type 2): upsert with change detection, audit log, point-in-time queries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: the columns whose changes make a new version
TRACKED = ("status", "phase", "enrollment", "completion_date", "description", "eligibility_criteria", "interventions", "normalized_drugs", "harmonized_drugs", "adverse_events", "meddra_codes")
META = ("valid_from", "valid_to", "is_current", "version", "record_hash", "change_type", "changed_columns")


@dataclass
class Upsert:
    """What an upsert results in: the whole new history, one row of counts, and the audit rows."""

    history: DataFrame
    stats: DataFrame
    log: DataFrame


def record_hash(df: DataFrame, tracked: Sequence[str]) -> Column:
    """SHA-256 of the tracked columns' canonical JSON: fixed order, sorted arrays, nulls kept."""
    cols = []
    for c in tracked:
        kind = df.schema[c].dataType
        plain = isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.MapType,))
        cols.append((F.array_sort(c) if plain else F.col(c)).alias(c))
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)


def changed_columns(old: str, new: str, tracked: Sequence[str]) -> Column:
    """The tracked columns in which two structs differ; null equals null."""
    return F.array_compact(F.array(*[F.when(~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")), F.lit(c)) for c in tracked]))


def scd2_upsert(history: DataFrame | None, staged: DataFrame, key: str, tracked: Sequence[str], now: Column, order: str | Sequence[str] = ()) -> Upsert:
    """Apply a batch to a history.

    Rows without key are counted as errors. A key without a current version starts version 1; a row whose hash
    differs from the version before closes it at ``now`` and opens the next; an equal one is counted as unchanged
    and written nowhere, whatever its untracked columns hold. A key repeated in the batch makes its versions in
    ``order`` (columns that are not stored; without them in the order in which the rows arrive), the middle ones with
    an empty period. Keys that the batch lacks stay current. ``history`` is read several times: give a stored table.
    """
    order = [order] if isinstance(order, str) else list(order)
    payload = [c for c in staged.columns if c not in order]
    arrival = F.struct(*order) if order else F.struct(F.monotonically_increasing_id().alias("o"))
    good = staged.where(F.col(key).isNotNull() & (F.trim(F.col(key).cast("string")) != ""))
    rows = good.select(F.col(key).alias("_key"), F.lit(0).alias("_level"), arrival.alias("_ord"), F.struct(*payload).alias("_row"), record_hash(good, tracked).alias("_hash"), F.lit(0).alias("_version"), F.lit(None).cast("timestamp").alias("_from"))
    if history is not None:
        current = history.where("is_current")
        rows = rows.unionByName(
            current.join(good.select(F.col(key)).distinct(), key, "left_semi").select(
                F.col(key).alias("_key"), F.lit(-1).alias("_level"), F.lit(None).cast(rows.schema["_ord"].dataType).alias("_ord"), F.struct(*[F.col(c).cast(staged.schema[c].dataType).alias(c) for c in payload]).alias("_row"),
                F.col("record_hash").alias("_hash"), F.col("version").alias("_version"), F.col("valid_from").cast("timestamp").alias("_from"),
            )
        )
    w = Window.partitionBy("_key").orderBy("_level", "_ord", "_hash")
    marked = rows.withColumn("_prev", F.lag("_hash").over(w)).withColumn("_new", F.col("_prev").isNull() | (F.col("_prev") != F.col("_hash")))
    runs = marked.where("_new").withColumn("_before", F.lag(F.struct("_row")).over(w)["_row"]).withColumn("_no", F.row_number().over(w)).withColumn("_base", F.max("_version").over(Window.partitionBy("_key"))).withColumn("_last", F.lead("_level").over(w).isNull())
    version = F.when(F.col("_base") > 0, F.col("_base") + F.col("_no") - 1).otherwise(F.col("_no"))
    made = runs.select(
        "_row.*",
        F.when(F.col("_level") < 0, F.col("_from")).otherwise(now).alias("valid_from"),
        F.when(~F.col("_last"), now).alias("valid_to"),
        F.col("_last").alias("is_current"),
        version.cast("int").alias("version"),
        F.col("_hash").alias("record_hash"),
        F.when(version == 1, "INSERT").otherwise("UPDATE").alias("change_type"),
        F.when(F.col("_before").isNotNull(), changed_columns("_before", "_row", tracked)).alias("changed_columns"),
        (F.col("_level") < 0).alias("_was"),
    )
    keep = [*payload, *META]
    if history is not None:
        # the closed version keeps what it said about its own origin
        origin = history.where("is_current").select(F.col(key).alias("_okey"), F.col("change_type").alias("_otype"), F.col("changed_columns").alias("_ocols"))
        made = made.join(origin, F.col(key) == F.col("_okey"), "left").withColumn("change_type", F.when(F.col("_was"), F.col("_otype")).otherwise(F.col("change_type"))).withColumn("changed_columns", F.when(F.col("_was"), F.col("_ocols")).otherwise(F.col("changed_columns")))
        untouched = history.join(good.select(F.col(key)).distinct(), key, "left_anti").select(*keep).unionByName(history.where("not is_current").join(good.select(F.col(key)).distinct(), key, "left_semi").select(*keep))
        out = untouched.unionByName(made.select(*keep))
    else:
        out = made.select(*keep)
    fresh = made.where("not _was")
    blank = F.col(key).isNull() | (F.trim(F.col(key).cast("string")) == "")
    counts = fresh.select((F.col("change_type") == "INSERT").cast("long").alias("i"), (F.col("change_type") == "UPDATE").cast("long").alias("u"), F.lit(0).cast("long").alias("g"), F.lit(0).cast("long").alias("e"))
    total = staged.select(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("u"), (~blank).cast("long").alias("g"), blank.cast("long").alias("e"))
    n = {c: F.coalesce(F.sum(c), F.lit(0)) for c in "iuge"}
    stats = counts.unionByName(total).agg(n["i"].alias("inserted"), n["u"].alias("updated"), (n["g"] - n["i"] - n["u"]).alias("unchanged"), n["e"].alias("errors"))
    log = fresh.select(F.col(key).alias("trial_id"), "version", "change_type", "changed_columns", F.col("valid_from").alias("changed_at"))
    return Upsert(out, stats, log)


def current_versions(history: DataFrame, limit: int | None = None, key: str = "trial_id", **equal: object) -> DataFrame:
    """Current versions with optional equality filters, ordered by key."""
    out = history.where("is_current")
    for c, v in equal.items():
        out = out.where(F.col(c) == v)
    return out.orderBy(key).limit(limit) if limit is not None else out


def history_of(history: DataFrame, key: str, value: object) -> DataFrame:
    """All versions of one key, newest first."""
    return history.where(F.col(key) == value).orderBy(F.desc("version"))


def valid_at(t: Column) -> Column:
    return (F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t))


def as_of(history: DataFrame, t: Column) -> DataFrame:
    """The versions that were valid at one moment."""
    return history.where(valid_at(t))


def as_of_join(facts: DataFrame, history: DataFrame, key: str, at: str) -> DataFrame:
    """Each fact with the version of its key that was valid then; facts without one are left out.

    The equality on the key makes it a hash or sort-merge join; only the validity test is a range predicate.
    """
    h = history.select(F.col(key).alias("_hk"), *[F.col(c).alias(f"v_{c}") for c in history.columns if c != key])
    cond = (F.col(key) == F.col("_hk")) & (F.col("v_valid_from") <= F.col(at)) & (F.col("v_valid_to").isNull() | (F.col("v_valid_to") > F.col(at)))
    return facts.join(h, cond).drop("_hk")


def recently_changed(history: DataFrame, now: Column, days: int) -> DataFrame:
    """Updates of the last days, newest first."""
    return history.where((F.col("change_type") == "UPDATE") & (F.col("valid_from") >= now - F.make_dt_interval(F.lit(days)))).orderBy(F.desc("valid_from"))


def change_counts(history: DataFrame, now: Column, days: int) -> DataFrame:
    """Changes of the last days by type."""
    return history.where(F.col("valid_from") >= now - F.make_dt_interval(F.lit(days))).groupBy("change_type").agg(F.count(F.lit(1)).alias("n"))


def most_changed(history: DataFrame, now: Column, days: int, key: str, k: int) -> DataFrame:
    """The keys with more than one change in the last days, most changed first (ties by key)."""
    recent = history.where(F.col("valid_from") >= now - F.make_dt_interval(F.lit(days)))
    return recent.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(F.desc("n"), key).limit(k)


def versions_from_events(df: DataFrame, key: str, at: str, payload: Sequence[str]) -> DataFrame:
    """Intervals from a log in which every row is a new state: valid until the key's next row."""
    w = Window.partitionBy(key).orderBy(at)
    return df.select(key, F.col(at).alias("valid_from"), F.lead(at).over(w).alias("valid_to"), F.row_number().over(w).alias("version"), *payload)
