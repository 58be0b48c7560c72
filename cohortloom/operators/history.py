"""Versions of changing entity attributes, by tree-reduction coalescing of snapshot intervals."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions.dates import canonical_date
from cohortloom.session import materialize

RUN = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("valid_from", T.TimestampNTZType()),
        T.StructField("last_seen", T.TimestampNTZType()),
        T.StructField("valid_to", T.TimestampNTZType()),
        T.StructField("observations", T.LongType()),
    ]
)
_FIELDS = RUN.fieldNames()


def plain_text(c: Column) -> Column:
    """Letters and digits in lower case; null for null and blank."""
    return F.nullif(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", ""), F.lit(""))


def _local_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Coalesce the sorted unit intervals of one partition.

    Every batch is reduced with column operations only: a run starts wherever entity or payload differs
    from the row before. Runs that touch neither end of the partition are closed here; the first and the
    last stay open for the tree. ``edge`` is null for closed runs, else the partition's number.
    """
    import numpy as np
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    schema = pa.schema(
        [
            ("entity", pa.string()), ("payload", pa.string()), ("valid_from", pa.timestamp("us")),
            ("last_seen", pa.timestamp("us")), ("valid_to", pa.timestamp("us")), ("observations", pa.int64()), ("edge", pa.int64()),
        ]
    )
    held: list[tuple] = []  # the last run so far: entity, payload, from, last_seen, n
    first = True

    def emit(rows: list[tuple], edge: bool) -> pa.RecordBatch:
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(cols, schema)] + [pa.array([part if edge else None] * len(rows), pa.int64())], schema=schema
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        ent, pay = batch.column("entity").dictionary_encode(), batch.column("payload").dictionary_encode()
        ei, pi = ent.indices.to_numpy(), pay.indices.to_numpy()
        ts = batch.column("ts").cast(pa.timestamp("us")).cast(pa.int64()).to_numpy()
        starts = np.flatnonzero(np.r_[True, (ei[1:] != ei[:-1]) | (pi[1:] != pi[:-1])])
        stops = np.r_[starts[1:], len(ts)]
        ents = ent.dictionary.take(pa.array(ei[starts])).to_pylist()
        pays = pay.dictionary.take(pa.array(pi[starts])).to_pylist()
        runs = list(zip(ents, pays, ts[starts].tolist(), ts[stops - 1].tolist(), (stops - starts).tolist()))
        if held:
            last = held.pop()
            if last[:2] == runs[0][:2]:
                runs[0] = (*last[:3], runs[0][3], last[4] + runs[0][4])
            else:
                runs.insert(0, last)
        held = [runs.pop()]
        if runs:
            nxt = runs[1:] + held
            rows = [(e, p, a, z, n[2] if n[0] == e else None, c) for (e, p, a, z, c), n in zip(runs, nxt)]
            if first:
                yield emit(rows[:1], True)
                rows, first = rows[1:], False
            if rows:
                yield emit(rows, False)
    if held:
        e, p, a, z, c = held[0]
        yield emit([(e, p, a, z, None, c)], True)


def _join_runs(left: Column, right: Column) -> Column:
    """The monoid product of two neighbouring run lists: fuse equal payloads at the seam, else close the left run."""
    a, b = F.try_element_at(left, F.lit(-1)), F.try_element_at(right, F.lit(1))
    same = a["entity"] == b["entity"]
    fuse = same & (a["payload"] == b["payload"])

    def run(valid_to: Column, last_seen: Column, n: Column) -> Column:
        return F.array(F.struct(a["entity"].alias("entity"), a["payload"].alias("payload"), a["valid_from"].alias("valid_from"), last_seen.alias("last_seen"), valid_to.alias("valid_to"), n.alias("observations")))

    head = F.slice(left, F.lit(1), F.size(left) - 1)
    return (
        F.when(F.size(left) == 0, right)
        .when(F.size(right) == 0, left)
        .when(fuse, F.concat(head, run(b["valid_to"], b["last_seen"], a["observations"] + b["observations"]), F.slice(right, F.lit(2), F.greatest(F.size(right) - 1, F.lit(0)))))
        .when(same, F.concat(head, run(b["valid_from"], a["last_seen"], a["observations"]), right))
        .otherwise(F.concat(left, right))
    )


#: Neighbouring nodes of the tree that one task joins, pair by pair, in a round.
FAN_IN = 16


def coalesce_history(df: DataFrame, entity: str, observed_at: str, written_at: str, tie: str, payload: dict[str, Column]) -> DataFrame:
    """Versions of each entity: entity, payload (JSON of the compared values), valid_from, last_seen, valid_to, observations.

    Each kept observation is a unit interval. Neighbouring runs of one entity with an equal payload are merged
    pairwise: inside the ordered partitions by column kernels, then across partitions over a tree with a logarithmic
    number of rounds. A node passes on only its first and its last run, which may go on in a neighbour; the runs
    between them are closed and leave the tree in that round, so no node grows with the data. Partitions are ranges
    of (entity, time), so one hot entity spreads over many tasks, and copies are combined map-side before anything is
    shuffled.

    Rows whose entity or observation time is null or blank are no observations. Of rows with the same entity and
    time the latest written holds (null written_at is earliest), then the largest ``tie``. ``valid_to`` is the
    start of the entity's next version, null for the current one. An empty table gives no versions.
    """
    obs = (
        df.where(F.col(entity).isNotNull() & (F.trim(F.col(entity)) != "") & F.col(observed_at).isNotNull())
        .select(
            F.col(entity).alias("entity"), F.col(observed_at).cast("timestamp_ntz").alias("ts"),
            F.struct(F.col(written_at).alias("w"), F.col(tie).alias("t"), F.to_json(F.struct(*[c.alias(k) for k, c in payload.items()])).alias("p")).alias("v"),
        )
        .groupBy("entity", "ts").agg(F.max("v").alias("v"))
        .select("entity", "ts", F.col("v.p").alias("payload"))
    )
    ordered = obs.repartitionByRange("entity", "ts").sortWithinPartitions("entity", "ts")
    runs = materialize(ordered.mapInArrow(_local_runs, T.StructType([*RUN.fields, T.StructField("edge", T.LongType())])), "runs")
    closed = runs.where(F.col("edge").isNull()).select(*_FIELDS)
    # a partition has at most two edge runs, in the order of (entity, time)
    before = lambda x, y: F.when(x["entity"] < y["entity"], -1).when(x["entity"] > y["entity"], 1).when(x["valid_from"] < y["valid_from"], -1).otherwise(1)
    edges = runs.where(F.col("edge").isNotNull())
    node = edges.groupBy(F.col("edge").alias("node")).agg(F.array_sort(F.collect_list(F.struct(*_FIELDS)), before).alias("runs"))
    top = edges.agg(F.max("edge")).first()[0] or 0
    none = F.array().cast(T.ArrayType(RUN))
    while top > 0:
        group = node.groupBy(F.floor(F.col("node") / FAN_IN).cast("long").alias("node")).agg(F.array_sort(F.collect_list(F.struct("node", "runs"))).alias("parts"))
        joined = group.select("node", F.aggregate("parts", none, lambda t, x: _join_runs(t, x["runs"])).alias("runs"))
        top //= FAN_IN
        if top > 0:  # at the root everything is closed
            joined = materialize(joined, "joined")
            closed = closed.unionByName(joined.select(F.inline(F.slice("runs", F.lit(2), F.greatest(F.size("runs") - 2, F.lit(0))))).select(*_FIELDS))
            ends = F.when(F.size("runs") > 2, F.array(F.get("runs", 0), F.try_element_at("runs", F.lit(-1)))).otherwise(F.col("runs"))
            joined = joined.select("node", ends.alias("runs"))
        node = joined
    return closed.unionByName(node.select(F.inline("runs")).select(*_FIELDS))


def trial_versions(snapshots: DataFrame) -> DataFrame:
    """Versions of the trials of ``trials_scd2_snapshots`` by status, enrollment and completion_date.

    Null and blank are one value; status compares by its letters and digits in lower case; a completion date
    compares by the date it means, a month by year and month. Other columns, and other columns of the same
    names in different case, are not looked at.
    """
    payload = {
        "status": F.coalesce(plain_text(F.col("status")), F.lit("")),
        "enrollment": F.coalesce(F.col("enrollment").cast("string"), F.lit("")),
        "completion_date": F.coalesce(canonical_date(F.col("completion_date")), F.lit("")),
    }
    return coalesce_history(snapshots, "trial_id", "data_collection_date", "processing_timestamp", "snapshot_id", payload)


def version_starts(snapshots: DataFrame) -> DataFrame:
    """trial_id and valid_from (``yyyy-MM-dd HH:mm:ss``) of every version."""
    return trial_versions(snapshots).select(F.col("entity").alias("trial_id"), F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss").alias("valid_from"))
