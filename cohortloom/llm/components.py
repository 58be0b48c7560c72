"""One group id for every record linked directly or through others."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.components import least_labels
from cohortloom.session import materialize

#: The breadth-first peel goes on while a frontier holds at least this share of what was reached already ...
FRONTIER_SHARE = 0.05
#: ... and at most so many rounds; whatever it has not reached by then is left to the propagation, exactly.
PEEL_ROUNDS = 12
#: Edges that are few enough for the propagation to end in one task (16 bytes each); more are contracted in rounds of joins.
TASK_EDGES = 200_000


def _peel(sym: DataFrame) -> tuple[int, DataFrame]:
    """The highest-degree vertex (ties: smallest id) and the vertices reached from it by frontier joins."""
    spark = sym.sparkSession
    hub = sym.groupBy("src").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "src").first()["src"]
    start = spark.createDataFrame([(hub,)], "id long")
    # the hub may touch a third of all edges: its own neighbours come from a literal filter, not from a join
    frontier = materialize(sym.where(F.col("src") == F.lit(hub)).select(F.col("dst").alias("id")).distinct(), "frontier")
    visited, reached = start.unionByName(frontier), frontier.count() + 1
    rest = sym.where((F.col("src") != F.lit(hub)) & (F.col("dst") != F.lit(hub)))
    for _ in range(PEEL_ROUNDS):
        frontier = materialize(
            rest.join(frontier, F.col("src") == F.col("id"), "left_semi").select(F.col("dst").alias("id")).distinct().join(visited, "id", "left_anti"), "frontier"
        )
        n = frontier.count()
        if not n:
            break
        visited, reached = visited.unionByName(frontier), reached + n
        if n < FRONTIER_SHARE * reached:
            break
    return hub, visited


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, root) of the vertices of at most TASK_EDGES edges by minimum propagation."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    a, b = (np.concatenate([p.column(c).to_numpy() for p in parts]) for c in (0, 1))
    ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = least_labels(place[: len(a)], place[len(a) :], len(ids))
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[label])], names=["id", "root"])


def _propagate(edges: DataFrame) -> DataFrame | None:
    """(id, root) of every vertex of ``edges`` (a, b): minimum propagation with contraction.

    In each round every vertex takes the neighbour (or itself) of least priority, edges move to those, and loops
    and repeats vanish; priorities are new in each round, so even long chains shrink geometrically. As soon as at
    most TASK_EDGES edges are left, their minima are propagated in one task. The maps of the rounds are composed
    from the smallest up.
    """
    maps, k, size = [], 0, edges.count()
    while size > TASK_EDGES:
        sym = edges.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(edges.select(F.col("b").alias("src"), F.col("a").alias("dst")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(k)).alias("h"), c.alias("id"))  # noqa: B023, E731
        rep = sym.groupBy(F.col("src").alias("id")).agg(F.min(rank(F.col("dst"))).alias("m")).select("id", F.least("m", rank(F.col("id")))["id"].alias("rep"))
        rep = materialize(rep, "rep")
        maps.append(rep)
        moved = edges.join(rep.select(F.col("id").alias("a"), F.col("rep").alias("ra")), "a").join(rep.select(F.col("id").alias("b"), F.col("rep").alias("rb")), "b")
        edges = materialize(moved.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        k, size = k + 1, edges.count()
    if not maps and not size:
        return None
    out = materialize(edges.select("a", "b").coalesce(1).mapInArrow(_in_one_task, "id long, root long"), "roots") if size else None
    for rep in reversed(maps):
        far = rep.select("id", F.col("rep").alias("root"))
        if out is not None:
            far = rep.join(out.select(F.col("id").alias("rep"), "root"), "rep", "left").select("id", F.coalesce("root", "rep").alias("root"))
        out = materialize(far, "roots")
    return out


def connected_groups(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, group_id) of every vertex, group_id being the smallest id linked with it directly or through others.

    ``vertices`` has ``id``; ``edges`` has ``a`` and ``b``; both are long. Repeats, self-links, either direction
    and rows with a null end are allowed; a null end links nothing. Vertices that only occur in edges are included,
    null vertices are not. A vertex without links is its own group; empty tables give no rows.

    The giant component is peeled off by breadth-first frontier joins from the highest-degree vertex and
    anti-joined away; where it has long tails, what the peel reached becomes one vertex and the tails are left
    to the propagation, which labels the remaining small components.
    """
    e = edges.where("a is not null and b is not null")
    ids = vertices.select("id").unionByName(edges.select(F.col("a").alias("id"))).unionByName(edges.select(F.col("b").alias("id"))).where("id is not null").distinct()
    one_way = materialize(e.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if one_way.isEmpty():
        return ids.select("id", F.col("id").alias("group_id"))
    sym = one_way.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(one_way.select(F.col("b").alias("src"), F.col("a").alias("dst")))
    hub, visited = _peel(sym)
    visited = materialize(visited.distinct(), "giant")
    # anti-join the giant away; only its tails still touch it, and there the hub stands for all of it
    outside = one_way.join(visited.select(F.col("id").alias("a")), "a", "left_anti").select("a", "b")
    half = one_way.join(visited.select(F.col("id").alias("a")), "a", "left_semi").select("b").distinct().join(visited.select(F.col("id").alias("b")), "b", "left_anti")
    inner = outside.join(visited.select(F.col("id").alias("b")), "b", "left_anti").select("a", "b")
    tail = outside.join(visited.select(F.col("id").alias("b")), "b", "left_semi").select("a").distinct().select(F.lit(hub).alias("a"), F.col("a").alias("b"))
    todo = inner.unionByName(tail).unionByName(half.select(F.lit(hub).alias("a"), "b")).distinct()
    roots = _propagate(materialize(todo, "todo"))
    top = hub
    if roots is not None:
        row = roots.where(F.col("id") == F.lit(hub)).first()
        top = row["root"] if row else hub
        members = visited.join(roots.select("id"), "id", "left_anti").select("id", F.lit(top).alias("root")).unionByName(roots)
    else:
        members = visited.select("id", F.lit(hub).alias("root"))
    members = materialize(members, "members")
    giant = members.where(F.col("root") == F.lit(top))
    least = giant.agg(F.min("id")).first()[0]
    small = members.where(F.col("root") != F.lit(top))
    mins = small.groupBy("root").agg(F.min("id").alias("group_id"))
    linked = giant.select("id", F.lit(least).alias("group_id")).unionByName(small.join(mins, "root").select("id", "group_id"))
    return ids.join(linked, "id", "left").select("id", F.coalesce("group_id", "id").alias("group_id"))


def mention_groups(interventions: DataFrame, links: DataFrame) -> DataFrame:
    """(name_id, group_id): see ``connected_groups``; a pair is linked if any of its rows has is_match true."""
    matched = links.where("is_match").select(F.col("name_id_a").alias("a"), F.col("name_id_b").alias("b"))
    return connected_groups(interventions.select(F.col("name_id").alias("id")), matched).select(F.col("id").alias("name_id"), "group_id")
