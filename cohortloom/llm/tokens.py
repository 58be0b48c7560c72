"""Token ids of whole texts by monoid tree reduction over a public byte-level tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder of the public vocabulary files; a parameter of every operator here.
TOKENIZERS = os.environ.get("COHORTLOOM_TOKENIZERS", "/opt/tokenizers")
#: Texts are halved until a piece has at most so many characters.
LEAF_CHARS = 4096
#: Characters on each side of a seam that are looked at first; doubled until the tokens outside are stable.
SEAM_CHARS = 32
#: Characters of text encoded in one go, which bounds a worker's memory.
GROUP_CHARS = 4_000_000
#: fixed value: the published pre-tokenizer pattern of the byte-level vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Vocabulary:
    """A rank file, its encoder, and the byte length of each token."""

    def __init__(self, name: str = "byte_bpe_50k", folder: str = TOKENIZERS):
        import tiktoken

        with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        size = max(ranks.values()) + 1
        self.lengths = np.zeros(size, np.int64)
        self.bytes = [b""] * size
        for token, rank in ranks.items():
            self.lengths[rank], self.bytes[rank] = len(token), token

    def encode(self, text: str) -> np.ndarray:
        return np.asarray(self.encoding.encode_ordinary(text), np.int32) if text else np.empty(0, np.int32)


@lru_cache(4)
def vocabulary(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> Vocabulary:
    return Vocabulary(name, folder)


def _cut_left(text: str, lo: int, hi: int) -> int | None:
    """The last place in text[lo:hi] where a blank follows a character that is none."""
    for i in range(hi - 1, lo, -1):
        if text[i] in " \n" and not text[i - 1].isspace():
            return i
    return None


def _cut_right(text: str, lo: int, hi: int) -> int | None:
    for i in range(lo + 1, hi):
        if text[i] in " \n" and not text[i - 1].isspace():
            return i
    return None


def join_tokens(v: Vocabulary, text: str, lo: int, mid: int, hi: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Tokens of text[lo:hi] from those of text[lo:mid] and text[mid:hi].

    No match of the pre-tokenizer runs from a non-blank into a blank, and its scan keeps no memory, so a place
    where a blank follows a non-blank separates the tokens whatever lies around it. The window grows until it
    holds such a place on either side of the seam, or reaches the end of that side; tokens outside cannot change.
    """
    w = SEAM_CHARS
    while (a := _cut_left(text, max(lo, mid - w), mid)) is None and mid - w > lo:
        w *= 2
    a = lo if a is None else a
    w = SEAM_CHARS
    while (b := _cut_right(text, mid, min(hi, mid + w))) is None and mid + w < hi:
        w *= 2
    b = hi if b is None else b
    ends = np.cumsum(v.lengths[left][::-1])  # bytes from the seam backwards
    drop_left = int(np.searchsorted(ends, len(text[a:mid].encode()))) + 1 if a < mid else 0
    starts = np.cumsum(v.lengths[right])
    drop_right = int(np.searchsorted(starts, len(text[mid:b].encode()))) + 1 if b > mid else 0
    return np.concatenate([left[: len(left) - min(drop_left, len(left))], v.encode(text[a:b]), right[min(drop_right, len(right)) :]])


def encode_texts(texts: list[str], v: Vocabulary, leaf: int = LEAF_CHARS) -> list[np.ndarray]:
    """Token ids of every text: its leaves, then neighbours joined pairwise up the tree."""
    spans: list[list[tuple[int, int]]] = []
    for t in texts:
        if len(t) <= leaf:
            spans.append([(0, len(t))] if t else [])
            continue
        n = 1 << ((len(t) - 1) // leaf).bit_length()
        edges = [len(t) * i // n for i in range(n + 1)]
        spans.append([(a, b) for a, b in zip(edges, edges[1:]) if a < b])
    encode = v.encoding.encode_ordinary
    flat = [encode(t if len(s) == 1 else t[a:b]) for t, s in zip(texts, spans) for a, b in s]
    out, k = [], 0
    for t, s in zip(texts, spans):
        level = [(a, b, np.asarray(ids, np.int32)) for (a, b), ids in zip(s, flat[k : k + len(s)])]
        k += len(s)
        while len(level) > 1:
            level = [
                (x[0], y[1], join_tokens(v, t, x[0], x[1], y[1], x[2], y[2])) for x, y in zip(level[::2], level[1::2])
            ] + ([level[-1]] if len(level) % 2 else [])
        out.append(level[0][2] if level else np.empty(0, np.int32))
    return out


def decode_ids(ids: np.ndarray, v: Vocabulary) -> str:
    """The text of ids: the tokens' bytes, concatenated up the tree."""
    level = [v.bytes[i] for i in ids]
    while len(level) > 1:
        level = [b"".join(level[i : i + 2]) for i in range(0, len(level), 2)]
    return (level[0] if level else b"").decode("utf-8", "replace")


def _groups(column: pa.ChunkedArray | pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Pieces of the column with a bounded number of characters: (first row, texts); null is an empty text."""
    texts, start, size = [], 0, 0
    for i, raw in enumerate(column):
        t = raw.as_buffer().to_pybytes().decode("utf-8", "replace") if raw.is_valid else ""
        texts.append(t)
        size += len(t)
        if size >= GROUP_CHARS:
            yield start, texts
            texts, start, size = [], i + 1, 0
    if texts:
        yield start, texts


def token_ids(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(key, ids): the ids of each whole text, without special tokens; strings of special tokens are plain text.

    Every row gives a row. An empty and a null text give an empty list; blank texts and broken characters are
    encoded like any others; repeated rows are each encoded. No shuffle: one narrow pass over two columns.
    """
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(tokenizer, folder)
        for batch in batches:
            for start, texts in _groups(batch.column(1)):
                ids = encode_texts(texts, v)
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                values = pa.array(np.concatenate(ids).astype(np.int32)) if ids else pa.array([], pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(ids)), pa.ListArray.from_arrays(pa.array(offsets), values)], names=[key, "ids"])

    schema = T.StructType([T.StructField(key, kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, schema)


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(key, n_tokens): the size of each whole text in tokens; 0 for an empty or null text."""
    return token_ids(df, key, text, tokenizer, folder).select(F.col(key), F.size("ids").cast("long").alias("n_tokens"))


def decoded(df: DataFrame, key: str = "doc_id", ids: str = "ids", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(key, text): the text of each list of ids; a null list gives an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(tokenizer, folder)
        for batch in batches:
            texts = [decode_ids(np.asarray(x.values) if x.is_valid else [], v) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return df.select(key, ids).mapInArrow(run, T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("text", T.StringType())]))
