"""Synonym closure: groups of names linked through pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.session import materialize


#: Pairs that are few enough to be labelled in one task; more go through rounds of joins.
TASK_PAIRS = 200_000


def least_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n vertices the least vertex linked with it by the pairs (a, b): minimum propagation with jumps."""
    label = np.arange(n)
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        moved = low < high
        if not moved.any():
            return label
        np.minimum.at(label, high[moved], low[moved])
        while (label[label] != label).any():
            label = label[label]


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    whole = pa.Table.from_batches(parts)
    names = sorted(set(whole.column("a").to_pylist()) | set(whole.column("b").to_pylist()), key=lambda x: x.encode())
    number = {x: i for i, x in enumerate(names)}
    label = least_labels(*(np.array([number[x] for x in whole.column(c).to_pylist()]) for c in "ab"), len(names))
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([names[i] for i in label], pa.string())], names=["name", "root"])


def synonym_groups(pairs: DataFrame) -> DataFrame:
    """(name, root): the smallest name linked with each name of the pairs (a, b), directly or through others.

    Minimum labels spread along pairs and jump to their label's label in each round, so the number of rounds grows
    with the logarithm of the longest chain. At most TASK_PAIRS pairs are labelled in one task instead. Pairs with a
    null side link nothing.
    """
    e = materialize(pairs.where("a is not null and b is not null").select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b")).distinct(), "pairs")
    if e.count() <= TASK_PAIRS:
        return e.coalesce(1).mapInArrow(_in_one_task, "name string, root string")
    sym = materialize(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "synonyms")
    labels = materialize(sym.groupBy(F.col("a").alias("name")).agg(F.least(F.min("b"), F.min("a")).alias("root")), "labels")
    while True:
        near = sym.join(labels.select(F.col("name").alias("b"), "root"), "b").groupBy(F.col("a").alias("name")).agg(F.min("root").alias("near"))
        step = labels.join(near, "name").select("name", F.least("root", "near").alias("next"), "root")
        jump = step.join(step.select(F.col("name").alias("next"), F.col("next").alias("far")), "next", "left")
        new = materialize(jump.select("name", F.least("next", F.coalesce("far", "next")).alias("next"), "root"), "labels")
        changed = new.where("next <> root").limit(1).count()
        labels = new.select("name", F.col("next").alias("root"))
        if not changed:
            return labels
