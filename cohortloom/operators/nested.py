"""Deeply nested records to flat element tables, by Arrow list offsets and parent indices."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.session import materialize

#: Bytes of JSON text turned into Arrow buffers in one go, which bounds a worker's memory.
GROUP_BYTES = 4_000_000


@dataclass(frozen=True)
class Node:
    """An array of objects (or of plain values, with no label paths) inside a record."""

    name: str
    label: tuple[str, ...] = ()
    children: tuple[Node, ...] = field(default=())

    def arrow(self) -> pa.DataType:
        return pa.list_(pa.struct([("label", pa.string()), *[(c.name, c.arrow()) for c in self.children]]))

    def spark(self) -> T.DataType:
        return T.ArrayType(T.StructType([T.StructField("label", T.StringType()), *[T.StructField(c.name, c.spark()) for c in self.children]]))


US_STUDY = (
    Node("secondaryIdInfos", ("id",)),
    Node("locations", ("country",)),
    Node("interventions", ("name",), (Node("otherNames"),)),
    Node("armGroups", ("label",), (Node("interventionNames"),)),
    Node("measures", ("title",), (Node("classes", ("title",), (Node("categories", ("title",), (Node("measurements", ("groupId",)),)),)),)),
    Node("seriousEvents", ("term",), (Node("stats", ("groupId",)),)),
    Node("otherEvents", ("term",), (Node("stats", ("groupId",)),)),
)
EU_TRIAL = (
    Node("partIMedicalConditions", ("medicalCondition",)),
    Node("sponsors", ("organisation.organisationFullName", "organisation.organisationName", "organisation.name", "organisationFullName", "organisationName", "organization.organizationName", "organization.name", "organizationName", "name")),
    Node("products", ("productDictionaryInfo.prodName", "productDictionaryInfo.productName", "productDictionaryInfo.name", "prodName", "productName", "name"), (Node("activeSubstances", ("substanceName",)),)),
    Node("rowCountriesInfo", ("name",), (Node("sites", ("siteName",)),)),
)

ELEMENT = T.StructType([T.StructField(c, T.StringType()) for c in ("record_id", "array_path", "node_path", "parent_path", "label")])


def _inside(value: Any) -> Any:
    """The object or array that a string holds as JSON text, else the value itself."""
    while isinstance(value, str) and value.lstrip()[:1] in ("{", "[", '"'):  # every layer is shorter than the one around it
        try:
            inner = json.loads(value, parse_float=str, parse_int=str)
        except ValueError:
            break
        if not isinstance(inner, (dict, list, str)):
            break
        value = inner
    return value


def read_record(text: str | None) -> dict | None:
    """The object of a JSON text, unwrapped from a string or a list of one; None if it can't be read as a whole."""
    if not text or not text.strip():
        return None
    try:
        value = _inside(json.loads(text, parse_float=str, parse_int=str))
    except (ValueError, RecursionError):
        return None
    if isinstance(value, list) and len(value) == 1:
        value = _inside(value[0])
    return value if isinstance(value, dict) else None


def _mentions(value: Any, key: str) -> bool:
    """Whether a plain value anywhere in the record is the key."""
    if isinstance(value, dict):
        return any(_mentions(v, key) for v in value.values())
    if isinstance(value, list):
        return any(_mentions(v, key) for v in value)
    if isinstance(value, str) and value[:1] in ("{", "[") and isinstance(inner := _inside(value), (dict, list)):
        return _mentions(inner, key)
    return value == key


def of_several(studies: list, key: str | None) -> list[dict]:
    """The study of a wrapper that the record is about: the one with its id, else the first."""
    found = [x for x in map(_inside, studies) if isinstance(x, dict)]
    if len(found) > 1 and key:
        found = [x for x in found if _mentions(x, key)] or found
    return found[:1]


def _find(record: dict, names: set[str], key: str | None = None) -> dict[str, Any]:
    """The values of the named keys, wherever the enclosing modules and wrappers put them; the outermost wins."""
    found: dict[str, Any] = {}
    level: list[dict] = [record]
    while level and len(found) < len(names):
        deeper: list[dict] = []
        for obj in level:
            for k, v in obj.items():
                if k in names:
                    if v is not None and found.get(k) is None:
                        found[k] = v
                    continue
                v = _inside(v)
                if isinstance(v, dict):
                    deeper.append(v)
                elif k == "studies" and isinstance(v, list):
                    deeper += of_several(v, key)
        level = deeper
    return found


def _text(value: Any) -> str:
    """A plain value as it is written."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _label(obj: dict, paths: tuple[str, ...]) -> str:
    for path in paths:
        value: Any = obj
        for part in path.split("."):
            value = _inside(value) if isinstance(value, str) else value
            value = value.get(part) if isinstance(value, dict) else None
        if value is not None:
            return _text(value)
    return ""


def _shape(value: Any, node: Node) -> list[dict] | None:
    """The canonical form of one array: a bare value is an array of one, null is none."""
    if isinstance(value, str):
        inner = _inside(value)
        value = inner if isinstance(inner, (dict, list)) else value
    if value is None:
        return None
    out = []
    for x in value if isinstance(value, list) else [value]:
        if node.label:
            obj = _inside(x) if isinstance(x, str) else x
            if not isinstance(obj, dict):
                obj = {node.label[0]: obj} if obj is not None else {}
            out.append({"label": _label(obj, node.label), **{c.name: _shape(obj.get(c.name), c) for c in node.children}})
        else:
            out.append({"label": _text(x)})
    return out


def _emit(lists: pa.ListArray, keys: pa.Array, paths: pa.Array | None, node: Node, above: str) -> Iterator[pa.RecordBatch]:
    """The element rows of one list column and, from its flattened values, those of the lists below it."""
    child, parent = lists.flatten(), pc.list_parent_indices(lists)
    if not len(child):
        return
    starts = pc.take(lists.offsets, parent).to_numpy()
    place = pc.cast(pa.array(np.arange(lists.offsets[0].as_py(), lists.offsets[0].as_py() + len(child)) - starts), pa.string())
    rec = keys.take(parent)
    own = pc.binary_join_element_wise(pa.scalar(node.name + "["), place, pa.scalar("]"), "")
    up = pa.repeat(pa.scalar("", pa.string()), len(child)) if paths is None else paths.take(parent)
    path = own if paths is None else pc.binary_join_element_wise(up, own, ".")
    array_path = f"{above}.{node.name}" if above else node.name
    tag = pa.repeat(pa.scalar(array_path, pa.string()), len(child))
    yield pa.RecordBatch.from_arrays([rec, tag, path, up, pc.struct_field(child, "label")], names=ELEMENT.fieldNames())
    for i, c in enumerate(node.children):
        yield from _emit(pc.struct_field(child, c.name), rec, path, c, array_path)


def shaped_records(df: DataFrame, nodes: tuple[Node, ...], text: str, key: str) -> DataFrame:
    """The rows of ``df`` whose text can be read, with one list column for each of ``nodes`` instead of the text.

    This is the only pass that parses: JSON text is decoded once, straight into Arrow list buffers. If a text wraps
    several studies, the one with the row's key counts, else the first. Narrow: nothing is shuffled.
    """
    keep = [c for c in df.columns if c != text]
    shape = pa.struct([(n.name, n.arrow()) for n in nodes])
    names = {n.name for n in nodes}
    kept, at = df.select(*keep, text), keep.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(at).to_pylist()
            rows, records, size = [], [], 0

            def flush() -> pa.RecordBatch:
                whole = pa.array(records, shape)  # noqa: B023
                place = pa.array(rows, pa.int64())  # noqa: B023
                return pa.RecordBatch.from_arrays([*[c.take(place) for c in batch.columns[: len(keep)]], *whole.flatten()], names=[*keep, *[n.name for n in nodes]])  # noqa: B023

            for i, t in enumerate(batch.column(len(keep))):
                t = t.as_buffer().to_pybytes().decode("utf-8", "replace") if t.is_valid else None
                if (rec := read_record(t)) is None:
                    continue
                found = _find(rec, names, ids[i])
                rows.append(i)
                records.append({n.name: _shape(found.get(n.name), n) for n in nodes})
                size += len(t)
                if size >= GROUP_BYTES:
                    yield flush()
                    rows, records, size = [], [], 0
            if rows:
                yield flush()

    return kept.mapInArrow(run, T.StructType([*[kept.schema[c] for c in keep], *[T.StructField(n.name, n.spark()) for n in nodes]]))


def elements(records: DataFrame, key: str, nodes: tuple[Node, ...]) -> DataFrame:
    """One row for each element of the list columns named by ``nodes``: record_id, array_path, node_path, parent_path, label.

    No row is looked at: the children of a whole batch are one flattened buffer, their places come from the list
    offsets, and keys and paths go down by take on the parent indices.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, n in enumerate(nodes):
                yield from _emit(batch.column(i + 1), batch.column(0), None, n, "")

    return records.select(F.col(key).cast("string"), *[n.name for n in nodes]).mapInArrow(run, ELEMENT)


def flatten_elements(df: DataFrame, key: str, text: str, nodes: tuple[Node, ...]) -> DataFrame:
    """The elements of every readable text of ``df``; unreadable, null and blank texts give no rows."""
    return elements(shaped_records(df.select(F.col(key).cast("string").alias(key), F.col(text).alias(text)), nodes, text, key), key, nodes)


def latest_elements(df: DataFrame, key: str, text: str, fetched_at: str, row_id: str, nodes: tuple[Node, ...]) -> DataFrame:
    """The elements of the most recently fetched readable row of each key (ties: largest row id); rows without key are left out.

    Every text is parsed once, into a table of lists; the rows that another one replaces, usually few, are anti-joined
    away from it by their ids, so the lists themselves are shuffled only if those ids can't be broadcast.
    """
    keyed = df.where(F.col(key).isNotNull() & (F.trim(F.col(key)) != "")).select(F.col(key).cast("string").alias("k"), F.col(fetched_at).alias("f"), F.col(row_id).alias("r"), F.col(text).alias("t"))
    rows = materialize(shaped_records(keyed, nodes, "t", "k"), "records")
    best = rows.groupBy("k").agg(F.max(F.struct("f", "r")).alias("b")).select("k", F.col("b.r").alias("best"))
    replaced = rows.select("k", "r").join(best, "k").where("r <> best").select("r")
    return elements(rows.join(replaced, "r", "left_anti"), "k", nodes)


def us_elements(trials: DataFrame) -> DataFrame:
    """Elements of the newest readable raw_study of each nct_id."""
    return latest_elements(trials, "nct_id", "raw_study", "fetched_at", "row_id", US_STUDY)


def eu_elements(trials: DataFrame) -> DataFrame:
    """Elements of the newest readable raw_trial of each eudract_number."""
    return latest_elements(trials, "eudract_number", "raw_trial", "fetched_at", "row_id", EU_TRIAL)


def record_elements(us: DataFrame, eu: DataFrame) -> DataFrame:
    """record_id, node_path, parent_path and label of every element of both registries' records."""
    return us_elements(us).unionByName(eu_elements(eu)).select("record_id", "node_path", "parent_path", "label")
