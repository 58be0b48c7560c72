"""Reading level of documents from interpolated n-gram models of words and of sentence structure."""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.session import discard, materialize, shuffles_removed, spread

#: Least words of running text of a document that gets a level.
LEAST_WORDS = 40
#: Rows of the hashed count tables for one, two and three tokens; the models' size does not depend on the corpus.
SLOTS = (1 << 16, 1 << 18, 1 << 18)
#: Weights of trigram, bigram, unigram and word length in the interpolation.
MIX = (0.35, 0.3, 0.25, 0.1)
ROUNDS = 6
BINS = 121
#: Words that are scored at a time, and rows of a count table that are added up in one group.
TOKENS_A_STEP, ROWS_A_GROUP = 100_000, 1 << 15
#: Parts of the scale of contrasts (-6 to 6) whose documents are pooled apart before the driver pools what is left.
CELLS = 1200
#: Quantiles of a document's sentences that stand for the distribution of its surprisal contrasts.
QUANTILES = (0.1, 0.3, 0.5, 0.7, 0.9)

# fixed values: words that join or subordinate clauses, in four languages
JOINING = frozenset("and or but und oder aber doch et ou mais y e o u pero after then dann ensuite después nor sowie".split())
SUBORDINATE = frozenset(
    """because if when whenever unless until whereas while although though which that who whose whom provided since so even notwithstanding once
    denn weil während sodass wobei wenn obwohl sofern dass damit nachdem bevor falls indem sobald obgleich wohingegen vorausgesetzt
    car parce que tandis quoique lorsque puisque si condition sachant bien pendant dont afin alors quand comme sorte
    porque mientras aunque puesto siempre cuenta modo condición cuando sino ya""".split()
)
_MARKUP = re.compile(r"<[^<>]{1,80}>|https?://\S+|&[a-z]+;")
#: Scripts written without blanks: a word there is taken as two letters, of which a token is made.
_DENSE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
_HAS_DENSE = re.compile(f"[{_DENSE}]")
_WORD = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*|\d+(?:[.,]\d+)*|[.!?;:,()—–-]|\n")
_DENSE_WORD = re.compile(rf"[{_DENSE}]{{1,2}}|(?:(?![{_DENSE}])[^\W\d_])+(?:[-'’](?:(?![{_DENSE}])[^\W\d_])+)*|\d+(?:[.,]\d+)*|[.!?。！？;:,()—–-]|\n")


def clean(text: str) -> str:
    """Text without markup, entities and byte-order marks; table rows and list marks become line breaks."""
    text = html.unescape(text) if "&" in text else text
    return _MARKUP.sub(" ", text.replace("﻿", "")).replace("\r\n", "\n").replace("\r", "\n")


def is_word(token: str) -> bool:
    return token[0].isalpha()


@dataclass
class Streams:
    """The words and the structure of one document, each as sentences of token hashes."""

    words: list[list[int]]
    lengths: list[list[int]]
    shape: list[list[int]]
    n_words: int


def _hash(token: str) -> int:
    return zlib.crc32(token.encode())


_RUN = [_hash(f"r{i}") for i in range(7)]
_LENGTH = [_hash(f"n{i}") for i in range(13)]
_STOP = _hash(".")
_DIGIT = re.compile(r"\d")
#: Distinct tokens that a worker remembers; beyond them nothing is remembered, so memory is bounded.
KNOWN_TOKENS = 500_000


@lru_cache(KNOWN_TOKENS)
def _token(t: str) -> tuple[bool, int, int, int]:
    """Of a token: whether it is a word, the hash and length it has among the words (-1 if it is none), and of its kind as a joint (0 if it is none)."""
    low = t.lower()
    kind = "j" if low in JOINING else "s" if low in SUBORDINATE else t if t in ";:,()—–-" else ""
    kind = "-" if kind in ("—", "–") else kind
    alnum = t[0].isalnum()
    return is_word(t), (_hash(low) if t[0].isalpha() else 0) if alnum else -1, min(len(t), 15), _hash(kind) if kind else 0


def streams(text: str) -> Streams:
    words: list[list[int]] = []
    lengths: list[list[int]] = []
    shape: list[list[int]] = []
    total = 0
    tokens = (_DENSE_WORD if _HAS_DENSE.search(text) else _WORD).findall
    for line in clean(text).split("\n"):
        if not line:
            continue
        digits = len(_DIGIT.findall(line))
        if digits * 2 > len(line) or "\t" in line and digits * 3 > len(line):
            continue  # a row of figures
        w: list[int] = []
        n: list[int] = []
        s: list[int] = []
        count = run = 0
        for tok in [*tokens(line), "\n"]:
            if tok in ".!?。！？\n":
                if count >= 2:
                    total += count
                    s += (_RUN[min(run // 3, 6)], _LENGTH[min(count // 5, 12)], _STOP)
                    words.append(w)
                    lengths.append(n)
                    shape.append(s)
                w, n, s = [], [], []
                count = run = 0
                continue
            word, h, size, kind = _token(tok)
            count += word
            if h >= 0:
                w.append(h)
                n.append(size)
            if kind:
                s += (_RUN[min(run // 3, 6)], kind)
                run = 0
            else:
                run += 1
    return Streams(words, lengths, shape, total)


def _flat(sentences: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all sentences of all documents, the sentence of each token, the document of each sentence."""
    sizes = np.array([len(s) for d in sentences for s in d], np.int64)
    toks = np.fromiter(chain.from_iterable(chain.from_iterable(sentences)), np.uint64, int(sizes.sum()))
    docs = np.repeat(np.arange(len(sentences)), [len(d) for d in sentences])
    return toks, np.repeat(np.arange(len(sizes)), sizes), docs


def _slots(toks: np.ndarray, sent: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of each token, of it with the one before, of it with the two before, of the one before, and of the two before, within its sentence."""
    one, prev, prev2 = toks, np.zeros_like(toks), np.zeros_like(toks)
    if len(toks):
        same = np.r_[False, sent[1:] == sent[:-1]]
        prev[1:] = np.where(same[1:], toks[:-1], 1)
        prev2[1:] = np.where(same[1:], prev[:-1], 1)
        prev[0] = prev2[0] = 1
    p = np.uint64(0x9E3779B97F4A7C15)
    two = (prev * p) ^ (one + np.uint64(77))
    three = ((prev2 * p) ^ two) * p
    before = (prev2 * p) ^ (prev + np.uint64(77))
    mix = lambda x, n: (((x * p) >> np.uint64(40)) % np.uint64(n)).astype(np.int64)
    return mix(one, SLOTS[0]), mix(two, SLOTS[1]), mix(three, SLOTS[2]), mix(prev, SLOTS[0]), mix(before, SLOTS[1])


#: Rows of the tables of a model: one, two and three tokens, contexts of one and two tokens, word lengths.
TABLES = (*SLOTS, SLOTS[0], SLOTS[1], 16)


class Counts:
    """The sums over tokens, of the chances that their document is of each tier, that a model is made of."""

    def __init__(self):
        self.tables = [np.zeros((n, 4)) for n in TABLES]

    def add(self, slots: tuple[np.ndarray, ...], lengths: np.ndarray | None, share: np.ndarray) -> None:
        for t, at in zip(self.tables, slots if lengths is None else (*slots, lengths)):
            np.add.at(t, at, share)


class Interpolated:
    """An interpolated trigram model for each of the four tiers."""

    def __init__(self, tables: list[np.ndarray]):
        *self.c, self.ctx1, self.ctx2 = (t.astype(np.float32, copy=False) for t in tables[:5])
        self.total = tables[0].sum(0, dtype=np.float64) + 1e-6
        self.len = ((1 + tables[5]) / (1 + tables[5]).sum(0)).astype(np.float32)

    def logs(self, slots: tuple[np.ndarray, ...], lengths: np.ndarray | None) -> np.ndarray:
        """Log probabilities (the negated surprisals) of each token under each tier."""
        one, two, three, before1, before2 = slots
        if not len(one):
            return np.zeros((0, 4))
        uni = (self.c[0][one] + 0.02) / (self.total + 0.02 * 5000)
        bi = self.c[1][two] / (self.ctx1[before1] + 0.5)
        tri = self.c[2][three] / (self.ctx2[before2] + 0.5)
        size = self.len[lengths] / 500 if lengths is not None else 1e-4
        return np.log(MIX[0] * np.minimum(tri, 1) + MIX[1] * np.minimum(bi, 1) + MIX[2] * uni + MIX[3] * size)


def _per_sentence(values: np.ndarray, sent: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, 4))
    np.add.at(out, sent, values)
    return out


def _doc_scores(s: np.ndarray, docs: np.ndarray, n_docs: int) -> np.ndarray:
    """Evidence of each document for each tier: its sentences' surprisals, each clipped so that none decides alone."""
    s = np.maximum(s - s.max(1, keepdims=True), -6.0) if len(s) else s
    out = np.zeros((n_docs, 4))
    np.add.at(out, docs, s)
    return out


def contrasts(logs: np.ndarray, docs: np.ndarray, n_docs: int) -> np.ndarray:
    """For each document and each k of 1 to 3 the mean of the QUANTILES of its sentences' surprisal contrasts.

    The contrast of a sentence is its surprisal under the tiers up to k less that under the tiers above k, bounded to
    6 either way; a document without sentences has 0.
    """
    out = np.zeros((n_docs, 3))
    starts = np.searchsorted(docs, np.arange(n_docs + 1))
    size = np.diff(starts)
    some = np.flatnonzero(size)
    for k in range(3 if len(logs) else 0):
        c = np.logaddexp.reduce(logs[:, k + 1 :], axis=1) - np.log(3 - k) - np.logaddexp.reduce(logs[:, : k + 1], axis=1) + np.log(k + 1)
        c = np.clip(c, -6.0, 6.0)
        c = c[np.lexsort((c, docs))]  # sorted within each document
        for q in QUANTILES:
            at = starts[some] + (size[some] - 1) * q
            low = np.floor(at).astype(np.int64)
            high = np.minimum(low + 1, starts[some] + size[some] - 1)
            out[some, k] += (c[low] + (at - low) * (c[high] - c[low])) / len(QUANTILES)
    return out


def tier_pairs(level: int | None) -> np.ndarray:
    """Which pairs (words, structure) a level can stand for: the mean of the two, halves up."""
    w, s = np.meshgrid(np.arange(1, 5), np.arange(1, 5), indexing="ij")
    return np.ones((4, 4), bool) if level is None else np.floor((w + s) / 2 + 0.5) == level


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing values closest to y over ascending x."""
    blocks: list[list[float]] = []
    for v, w in zip(y, weight):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


def pooled(low: np.ndarray, high: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """The blocks (low, high, value, weight) of the isotonic values of y over ranges of x that ascend and don't overlap.

    Blocks of blocks are those of all rows at once, so rows can be pooled in parts first.
    """
    at = np.argsort(low, kind="stable")
    low, high, y, weight = low[at], high[at], y[at], weight[at]
    starts = np.flatnonzero(np.r_[True, low[1:] != low[:-1]]) if len(low) else np.zeros(0, int)  # equal x have one value
    total = np.add.reduceat(weight, starts) if len(low) else weight
    y = np.add.reduceat(y * weight, starts) / total if len(low) else y
    low, high = low[starts], np.maximum.reduceat(high, starts) if len(low) else high
    value = isotonic(low, y, total)
    first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]]) if len(low) else starts
    last = np.r_[first[1:], len(low)] - 1 if len(low) else first
    return low[first], high[last], value[first], np.add.reduceat(total, first) if len(low) else total


class MonotoneTier:
    """The tier (1 to 4) that a distribution of surprisals stands for: one isotonic map for each step between tiers."""

    def __init__(self, blocks: list[tuple[np.ndarray, ...]]):
        self.maps = []
        for low, high, value, _ in blocks:
            x, y = np.column_stack([low, high]).ravel(), np.repeat(value, 2)
            kept = np.r_[True, x[1:] != x[:-1]] if len(x) else np.zeros(0, bool)
            self.maps.append((x[kept], y[kept]))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1.0 + sum(np.interp(x[:, k], *m) if len(m[0]) else np.zeros(len(x)) + 0.5 for k, m in enumerate(self.maps))


def stored(p: Streams) -> tuple[bytes, ...]:
    """The streams of a document as bytes: words, their lengths, words a sentence, structure, its tokens a sentence."""
    flat = lambda x, kind: np.fromiter(chain.from_iterable(x), kind).tobytes()
    return flat(p.words, np.uint32), flat(p.lengths, np.uint8), np.array([len(s) for s in p.words], np.int32).tobytes(), flat(p.shape, np.uint32), np.array([len(s) for s in p.shape], np.int32).tobytes()


STORED = "grade double, w binary, n binary, ws binary, s binary, ss binary"


class Graded:
    """Some graded documents as arrays: grades, and for words and structure the slots, the sentence of each token and the document of each sentence."""

    def __init__(self, b: pa.RecordBatch):
        self.grades = b.column("grade").to_numpy()
        col = {c: b.column(c).to_pylist() for c in ("w", "n", "ws", "s", "ss")}
        self.lengths = np.frombuffer(b"".join(col["n"]), np.uint8).astype(np.int64)
        self.sides = []
        for t, z in (("w", "ws"), ("s", "ss")):
            sizes = np.frombuffer(b"".join(col[z]), np.int32)
            sent = np.repeat(np.arange(len(sizes)), sizes)
            docs = np.repeat(np.arange(b.num_rows), [len(x) // 4 for x in col[z]])
            self.sides.append((_slots(np.frombuffer(b"".join(col[t]), np.uint32).astype(np.uint64), sent), sent, docs))

    @staticmethod
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[Graded]:
        for b in batches:
            ends = np.cumsum([len(x) // 4 for x in b.column("w").to_pylist()])
            i = 0
            while i < b.num_rows:
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + TOKENS_A_STEP, "right")))
                yield Graded(b.slice(i, j - i))
                i = j


class Grader:
    """Tier models for words and structure, and the monotone maps from surprisal to tiers and from difficulty to level."""

    def _expected(self, g: Graded) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For documents with grades the chances of their tiers of words and structure, and the contrasts of both; without models only what the grade says."""
        n = len(g.grades)
        given = np.floor(g.grades + 0.5).astype(int)
        if self.words is None:
            p = np.eye(4)[given - 1]
            return p, p, np.zeros((n, 3)), np.zeros((n, 3))
        allowed = np.stack([self.allowed[y] for y in given])
        (slots_w, ws, wd), (slots_s, ss, sd) = g.sides
        lw, ls = _per_sentence(self.words.logs(slots_w, g.lengths), ws, len(wd)), _per_sentence(self.shape.logs(slots_s, None), ss, len(sd))
        joint = _doc_scores(lw, wd, n)[:, :, None] + _doc_scores(ls, sd, n)[:, None, :] + allowed
        post = _softmax(joint.reshape(n, 16)).reshape(n, 4, 4)
        return post.sum(2), post.sum(1), contrasts(lw, wd, n), contrasts(ls, sd, n)

    def fit(self, parts: DataFrame, grades: list[float]) -> Grader:
        """Fit to all documents of the table ``parts`` (STORED); ``grades`` are those that occur.

        Each round is a pass: tasks score their documents with the last models and add up the next ones' tables, whose
        size is fixed. For the isotonic maps documents are pooled in cells of the scale; blocks of blocks are exact.
        """
        spark = parts.sparkSession
        self.words = self.shape = None
        # a grader errs now and then: other pairs stay possible, at a cost
        self.allowed = {y: np.where(tier_pairs(y), 0.0, -12.0) for y in sorted({int(np.floor(y + 0.5)) for y in grades})}

        def counted(shared):
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                both = Counts(), Counts()
                for g in Graded.of(batches):
                    for side, (c, share) in enumerate(zip(both, shared.value._expected(g))):
                        slots, sent, docs = g.sides[side]
                        c.add(slots, g.lengths if side == 0 else None, share[docs[sent]])
                for side, c in enumerate(both):
                    for t, table in enumerate(c.tables):
                        for k in range(0, len(table), ROWS_A_GROUP):
                            if (x := table[k : k + ROWS_A_GROUP]).any():
                                yield pa.RecordBatch.from_arrays([pa.array([side]), pa.array([t]), pa.array([k]), pa.array([x.tobytes()])], names=["side", "t", "k", "v"])

            return run

        def add(rows: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x, np.float64) for x in rows.column("v").to_pylist())
            return rows.slice(0, 1).select(["side", "t", "k"]).append_column("v", pa.array([total.astype(np.float32).tobytes()]))

        schema = "side long, t long, k long, v binary"
        rows = parts.coalesce(spark.sparkContext.defaultParallelism)  # each task sends whole tables, however many documents it has
        for _ in range(ROUNDS if grades else 0):
            shared = spark.sparkContext.broadcast(self)
            self.words = self.shape = None  # one model at a time on the driver
            found = rows.mapInArrow(counted(shared), schema).groupBy("side", "t", "k").applyInArrow(add, schema).toArrow()
            shared.destroy()
            sides = [[np.zeros((n, 4), np.float32) for n in TABLES] for _ in range(2)]
            for side, t, k, v in zip(*(found.column(c) for c in ("side", "t", "k", "v"))):
                x = np.frombuffer(v.as_buffer(), np.float32).reshape(-1, 4)
                sides[side.as_py()][t.as_py()][k.as_py() : k.as_py() + len(x)] = x
            del found
            self.words, self.shape = map(Interpolated, sides)
        if not grades:
            self.words, self.shape = (Interpolated(Counts().tables) for _ in range(2))
        shared = spark.sparkContext.broadcast(self)
        names = [f"x{k}" for k in range(6)] + [f"y{k}" for k in range(6)]

        def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for g in Graded.of(batches):
                pw, ps, xw, xs = shared.value._expected(g)
                above = [p[:, k + 1 :].sum(1) for p in (pw, ps) for k in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (g.grades, *xw.T, *xs.T, *above)], names=["grade", *names])

        docs = materialize(parts.mapInArrow(described, "grade double, " + ", ".join(f"{c} double" for c in names)), "graded")
        shared.destroy()
        tall = docs.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y")) for k in range(6)])).alias("r")).select("r.*", F.floor(F.col("r.x") * (CELLS / 12)).alias("cell"))

        def pool(rows: pa.Table) -> pa.Table:
            x, y = rows.column("x").to_numpy(), rows.column("y").to_numpy()
            order = np.lexsort((y, x))
            blocks = pooled(x[order], x[order], y[order], np.ones(len(x)))
            return pa.table([pa.array(np.full(len(blocks[0]), rows.column("k")[0].as_py(), np.int32)), *map(pa.array, blocks)], names=["k", "low", "high", "y", "w"])

        rows = tall.groupBy("k", "cell").applyInArrow(pool, "k int, low double, high double, y double, w double").toArrow()
        k, *cols = (rows.column(c).to_numpy() for c in ("k", "low", "high", "y", "w"))
        maps = [pooled(*[c[k == i] for c in cols]) for i in range(6)]
        self.word_tier, self.shape_tier = MonotoneTier(maps[:3]), MonotoneTier(maps[3:])
        self.grid = self.fitted = np.linspace(1, 4, BINS)
        tiers = self.word_tier, self.shape_tier

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = np.column_stack([b.column(f"x{k}").to_numpy() for k in range(6)])
                x = (tiers[0](x[:, :3]) + tiers[1](x[:, 3:])) / 2
                at = np.clip(((x - 1) / 3 * (BINS - 1)).round().astype(np.int64), 0, BINS - 1)
                yield pa.RecordBatch.from_arrays([pa.array(at), b.column("grade")], names=["at", "grade"])

        if grades:
            count, mean = np.zeros(BINS), np.zeros(BINS)
            for r in docs.mapInArrow(placed, "at long, grade double").groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.sum("grade").alias("s")).collect():
                count[r["at"]], mean[r["at"]] = r["n"], r["s"]
            # a weak pull to the scale itself decides where no graded document lies
            self.fitted = isotonic(self.grid, (mean + 0.2 * self.grid) / (count + 0.2), count + 0.2)
        discard(docs)
        return self

    def difficulty(self, parts: list[Streams]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Difficulty (1 to 4), mean surprisal per word, and its upper decile over sentences, of each document."""
        wt, ws, wd = _flat([p.words for p in parts])
        st, ss, sd = _flat([p.shape for p in parts])
        n = len(parts)
        lens = np.fromiter(chain.from_iterable(s for p in parts for s in p.lengths), np.int64)
        logs = self.words.logs(_slots(wt, ws), lens)
        x = self.word_tier(contrasts(_per_sentence(logs, ws, len(wd)), wd, n))
        x = (x + self.shape_tier(contrasts(_per_sentence(self.shape.logs(_slots(st, ss), None), ss, len(sd)), sd, n))) / 2
        best = -logs.max(1) if len(logs) else np.zeros(0)
        total, count = np.bincount(ws, best, len(wd)), np.bincount(ws, minlength=len(wd))
        per = total / np.maximum(count, 1)
        docs_total, docs_count = np.bincount(wd, total, n), np.bincount(wd, count, n)
        high = np.zeros(n)
        starts = np.searchsorted(wd, np.arange(n + 1))
        some = np.flatnonzero(np.diff(starts))
        ranked = per[np.lexsort((per, wd))]
        high[some] = ranked[starts[some] + np.floor(0.9 * (np.diff(starts)[some] - 1)).astype(np.int64)]
        return x, docs_total / np.maximum(docs_count, 1), high

    def level(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(np.interp(x, self.grid, self.fitted) + 0.5), 1, 4).astype(np.int32)


def reading_levels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, reading_level, difficulty, mean_surprisal, high_surprisal, n_words) of each document with running text.

    Words and sentence structure each have interpolated n-gram models of four tiers, fitted together by expectation
    maximisation on all graded documents, in one pass over them for each round: a grade only says which pairs of tiers
    are possible. The surprisals of all sentences of a document form a distribution; its quantiles of
    the contrast between easier and harder tiers go through isotonic maps to the tier of its words and that of its
    structure, and their mean, the difficulty, through an isotonic map fitted to the grades to the level (halves up).

    Texts that are null, empty, or have fewer than LEAST_WORDS words of running text get no row; in scripts without
    blanks two letters count as a word. Several grades of a document count as their median. Without any grade every
    document has the middle of the scale. Repeated rows each get a row; nothing is shuffled but the graded texts and tables of fixed size.
    """
    docs = documents.select("doc_id", F.col("text").cast("string").alias("text")).where(f"text is not null and length(text) >= {LEAST_WORDS}")
    grades = labels.where("reading_level between 1 and 4").groupBy("doc_id").agg(F.median("reading_level").alias("grade"))
    # a text that is repeated counts once
    graded = docs.join(grades, "doc_id").groupBy("text").agg(F.min_by("grade", F.struct(F.xxhash64("doc_id"), "doc_id")).alias("grade"))

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(g, *stored(p)) for t, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if (p := streams(t)).n_words >= LEAST_WORDS]
            cols = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.float64()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=["grade", "w", "n", "ws", "s", "ss"])

    with shuffles_removed(documents.sparkSession):
        parts = materialize(spread(graded.select("text", "grade")).mapInArrow(parsed, STORED), "parsed")
        grader = Grader().fit(parts, [r["grade"] for r in parts.select("grade").distinct().orderBy("grade").collect()])
        discard(parts)
    shared = documents.sparkSession.sparkContext.broadcast(grader)  # count tables of fixed size

    schema = T.StructType([
        T.StructField("doc_id", documents.schema["doc_id"].dataType), T.StructField("reading_level", T.IntegerType()), T.StructField("difficulty", T.DoubleType()),
        T.StructField("mean_surprisal", T.DoubleType()), T.StructField("high_surprisal", T.DoubleType()), T.StructField("n_words", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        ids: list = []
        parts: list[Streams] = []
        size = 0

        def flush() -> pa.RecordBatch:
            x, mean, high = g.difficulty(parts)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(g.level(x)), pa.array(x), pa.array(mean), pa.array(high), pa.array([p.n_words for p in parts], pa.int64())], names=schema.fieldNames())

        for b in batches:
            for i, raw in zip(b.column(0).to_pylist(), b.column(1)):
                p = streams(raw.as_buffer().to_pybytes().decode("utf-8", "replace"))
                if p.n_words < LEAST_WORDS:
                    continue
                ids.append(i)
                parts.append(p)
                size += p.n_words
                if size > 100_000:
                    yield flush()
                    ids, parts, size = [], [], 0
        if ids:
            yield flush()

    return docs.mapInArrow(run, schema)
