"""Documents into windows of fixed capacity: lexical neighbours from a sharded BM25 index fill each seed's window."""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from copy import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.tokens import TOKENIZERS, _groups, encode_texts, vocabulary
from cohortloom.session import materialize

#: Documents of one shard of the index. Shards are ranges of (topic, id), so a hot topic spreads over many of them.
SHARD = 4096
#: Terms of a seed that its neighbours are searched by, those that say most about it.
QUERY_TERMS = 128
#: The table of windows is fixed and goes to every task; more rows than this are refused.
MAX_WINDOWS = 1000
K1, B = 1.2, 0.75
#: Share of a capacity that may stay free without another search.
SLACK = 0.005
#: How a piece came into its window.
SPLIT, SEED, NEIGHBOUR, FILLER = 0, 1, 2, 3

ITEM = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("topic", T.StringType()), T.StructField("n_tokens", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.IntegerType()))]
)
PLACED = T.StructType(
    [T.StructField("window_id", T.IntegerType()), T.StructField("container_id", T.LongType()), T.StructField("position", T.IntegerType()), T.StructField("placed", T.IntegerType())]
    + [T.StructField(c, T.LongType()) for c in ("doc_id", "piece", "token_start", "token_end", "n_tokens")]
)


def _items(tokenizer: str, folder: str):
    """The tokens of each text, counted: they measure it and are the terms that it is indexed by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(tokenizer, folder)
        for batch in batches:
            for start, texts in _groups(batch.column(2)):
                ids = encode_texts(texts, v)
                sizes = np.array([len(x) for x in ids], np.int64)
                keys = (np.repeat(np.arange(len(ids)), sizes) << 32) | np.concatenate(ids).astype(np.int64)
                keys.sort()
                first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
                times = np.diff(np.r_[first, len(keys)])
                terms, owner = (keys[first] & 0xFFFFFFFF).astype(np.int32), keys[first] >> 32
                offsets = pa.array(np.searchsorted(owner, np.arange(len(ids) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)).cast(pa.int64()), batch.column(1).slice(start, len(texts)), pa.array(sizes),
                     pa.ListArray.from_arrays(offsets, pa.array(terms)), pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))],
                    names=ITEM.fieldNames(),
                )

    return run


class Index:
    """The inverted index of one shard, with impacts that already hold length norm and idf."""

    def __init__(self, terms: list[np.ndarray], tfs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        n = len(terms)
        sizes = np.array([len(t) for t in terms], np.int64)
        flat = np.concatenate(terms) if n else np.zeros(0, np.int32)
        tf = np.concatenate(tfs).astype(np.float32) if n else np.zeros(0, np.float32)
        owner = np.repeat(np.arange(n), sizes)
        length = np.bincount(owner, tf, n)
        impact = idf[flat] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[owner] / max(mean_length, 1e-9)))
        order = np.argsort(flat, kind="stable")
        self.docs, self.impact = owner[order], impact[order].astype(np.float64)
        self.vocab, self.starts = np.unique(flat[order], return_index=True)
        self.stops = np.r_[self.starts[1:], len(flat)]
        # of each document the terms that say most about it, most telling first
        ranked, ends = np.searchsorted(self.vocab, flat)[np.lexsort((-impact, owner))], np.cumsum(sizes)
        self.n, self.places = n, [ranked[e - k : min(e, e - k + QUERY_TERMS)] for e, k in zip(ends, sizes)]

    def without(self, used: np.ndarray) -> Index:
        """The same index without the postings of the used documents."""
        out = copy(self)
        keep = ~used[self.docs]
        before = np.r_[0, np.cumsum(keep)]
        out.docs, out.impact, out.starts, out.stops = self.docs[keep], self.impact[keep], before[self.starts], before[self.stops]
        return out

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of every document of the shard for the QUERY_TERMS terms that say most about ``doc``."""
        at = self.places[doc]
        if not len(at):
            return np.zeros(self.n)
        a, b = self.starts[at], self.stops[at]
        sizes = b - a
        idx = np.repeat(a - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        return np.bincount(self.docs[idx], self.impact[idx], self.n)


def fill_windows(sizes: list[int], index: Index, capacity: int) -> list[list[tuple[int, int, int, int, int]]]:
    """Windows as lists of (document, piece, first token, end token, how it was placed).

    The largest unused item is the seed. Of the unused neighbours that fit, and behind which something unused still
    fits or next to nothing is left, the one with the highest BM25 score for the seed is taken, again and again; what is left is filled with the largest unused
    item that fits. Only a document longer than the capacity is split, into full pieces and a rest.
    """
    windows: list[list[tuple[int, int, int, int, int]]] = []
    rest: dict[int, tuple[int, int]] = {}  # document -> (size of its unsplit item, first token)
    for d, size in enumerate(sizes):
        first = 0
        while size - first > capacity:
            windows.append([(d, first // capacity, first, first + capacity, SPLIT)])
            first += capacity
        if size - first > 0:
            rest[d] = (size - first, first)
    free = sorted((s, d) for d, (s, _) in rest.items())
    left = np.zeros(len(sizes), np.int64)
    for d, (s, _) in rest.items():
        left[d] = s

    def take(d: int, how: int) -> tuple[int, int, int, int, int]:
        size, first = rest[d]
        free.pop(bisect.bisect_left(free, (size, d)))
        left[d] = 0
        return (d, first // capacity, first, first + size, how)

    indexed = len(free)
    while free:
        if len(free) < 0.8 * indexed:  # postings of used documents are dropped now and then
            index, indexed = index.without(left == 0), len(free)
        seed = free[-1][1]
        window, room = [take(seed, SEED)], capacity - rest[seed][0]
        if free and room > SLACK * capacity and room >= free[0][0]:
            fits = (left > 0) & (left <= room)
            score = index.scores(seed)
            near = np.flatnonzero(fits & (score > 0))
            rank = score[near]
            while free and room >= free[0][0]:
                after = room - left[near]
                behind = np.where(near == free[0][1], free[1][0] if len(free) > 1 else capacity + 1, free[0][0])
                good = (after >= 0) & ((after <= SLACK * capacity) | (behind <= after)) & (left[near] > 0)
                if not good.any():
                    break
                k = int(np.argmax(np.where(good, rank, -1.0)))
                window.append(take(int(near[k]), NEIGHBOUR))
                room = int(after[k])
            while free and room >= free[0][0]:
                k = bisect.bisect_right(free, (room, len(sizes))) - 1
                d = free[k][1]
                window.append(take(d, FILLER))
                room -= rest[d][0]
        windows.append(window)
    return windows


def packed_windows(documents: DataFrame, windows: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(window_id, container_id, position, placed, doc_id, piece, token_start, token_end, n_tokens) for each piece.

    Every document is in exactly one container for each window_id with a positive capacity, or in several if it is
    longer than the capacity. Empty and null texts have no tokens and go, as pieces of length 0, behind the items of
    a container of their shard. Repeated rows, and rows without doc_id, are each placed. Texts are measured and indexed whole; document
    frequencies and the mean length are those of all documents. No documents or no windows give no rows.
    """
    topic = F.col("nct_id") if "nct_id" in documents.columns else F.lit(None).cast("string")
    docs = documents.select("doc_id", topic.cast("string").alias("topic"), F.col("text").cast("string").alias("text"))
    items = materialize(docs.mapInArrow(_items(tokenizer, folder), ITEM), "items")
    caps = [(int(w), int(c)) for w, c in windows.where("capacity_tokens > 0 and window_id is not null").select("window_id", "capacity_tokens").distinct().limit(MAX_WINDOWS + 1).collect()]
    if len(caps) > MAX_WINDOWS:
        raise ValueError(f"more than {MAX_WINDOWS} kinds of windows; pack them in several calls, as each kind is packed apart")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(0, np.int64)
        for b in batches:
            one = np.bincount(b.column(0).flatten().to_numpy(), minlength=len(df))
            one[: len(df)] += df
            df = one
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(df[seen])], names=["term", "df"])

    freq = items.select("terms").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()  # at most one row for each token of the vocabulary
    n, tokens = items.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    df = np.zeros(int(freq.term.max()) + 1 if len(freq) else 1)
    df[freq.term.to_numpy(dtype=int)] = freq.df.to_numpy()
    shared = items.sparkSession.sparkContext.broadcast((np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32), tokens / max(n, 1)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        idf, mean_length = shared.value
        base = TaskContext.get().partitionId() << 32
        made = 0

        def shard(ids: list, sizes: list[int], terms: list, tfs: list) -> Iterator[pa.RecordBatch]:
            nonlocal made
            index = Index(terms, tfs, idf, mean_length)
            empty = [d for d, s in enumerate(sizes) if s == 0]
            for window_id, capacity in caps:
                found = fill_windows(sizes, index, capacity)
                if empty:
                    found = found or [[]]
                    found[-1] = found[-1] + [(d, 0, 0, 0, FILLER) for d in empty]
                rows = [(made + k, i, *piece) for k, w in enumerate(found) for i, piece in enumerate(w)]
                made += len(found)
                cont, pos, doc, piece, first, end, how = (np.array(c, np.int64) for c in zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), window_id, np.int32)), pa.array(base + cont), pa.array(pos.astype(np.int32)), pa.array(how.astype(np.int32)), pa.array(ids, pa.int64()).take(pa.array(doc)), pa.array(piece), pa.array(first), pa.array(end), pa.array(end - first)], names=PLACED.fieldNames())

        ids, sizes, terms, tfs = [], [], [], []
        for b in batches:
            offsets = b.column(2).offsets.to_numpy()
            flat_terms, flat_tfs = b.column(2).values.to_numpy(), b.column(3).values.to_numpy()
            shift = b.column(3).offsets[0].as_py() - int(offsets[0])
            for i, (d, s) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                ids.append(d)
                sizes.append(s)
                terms.append(flat_terms[offsets[i] : offsets[i + 1]])
                tfs.append(flat_tfs[offsets[i] + shift : offsets[i + 1] + shift])
                if len(ids) == SHARD:
                    yield from shard(ids, sizes, terms, tfs)
                    ids, sizes, terms, tfs = [], [], [], []
        if ids:
            yield from shard(ids, sizes, terms, tfs)

    shards = max(1, -(-n // SHARD))
    return items.repartitionByRange(shards, "topic", "doc_id").sortWithinPartitions("topic", "doc_id").select("doc_id", "n_tokens", "terms", "tfs").mapInArrow(pack, PLACED)


def fill_report(placed: DataFrame, windows: DataFrame) -> DataFrame:
    """For each window_id: containers, tokens, share of the capacity that is filled, documents that were split, and the
    share of the pieces behind the seeds that retrieval placed (the others filled what was left)."""
    per = placed.groupBy("window_id").agg(
        F.count_distinct("container_id").alias("containers"), F.sum("n_tokens").alias("tokens"), F.count_distinct(F.when(F.col("piece") > 0, F.col("doc_id"))).alias("split_documents"),
        F.round(F.count_if(F.col("placed") == NEIGHBOUR) / F.greatest(F.count_if((F.col("placed") >= NEIGHBOUR) & (F.col("n_tokens") > 0)), F.lit(1)), 4).alias("retrieved"),
    )
    return per.join(windows.dropDuplicates(["window_id"]), "window_id").select("window_id", "capacity_tokens", "containers", "tokens", "split_documents", "retrieved", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 4).alias("filled"))
