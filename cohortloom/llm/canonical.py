"""Freely typed values to the entries of a reference list: a trie searched with a Levenshtein automaton."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.session import materialize, spread

#: Entries of one trie, which a worker holds whole. A longer list is cut into shards of about this size, each searched apart.
MAX_ENTRIES = 100_000
#: Distinct words searched against one shard in one group, about.
WORDS_A_GROUP = 200_000

#: fixed values: words around a product name that name no product
TYPES = r"(?:drug|biological|device|procedure|behavioral|behavioural|dietary supplement|combination product|combination|genetic|radiation|diagnostic test|other)"
FORMS = """mg mcg ug g kg ml iu unit units w v wv qd bid tid qid qod qw daily weekly once twice iv sc im po oral orally inhaled topical
intravenous subcutaneous intramuscular injection inj infusion tablet tablets tab tabs capsule capsules caps cap solution suspension
powder inhalation for film coated cream gel patch spray vial dose low high standard matching matched the of a an to in as
arm group treatment therapy care soc control active comparator extended release""".split()
SALTS = """mesylate citrate phosphate tosylate sodium maleate hydrochloride hcl mesy citr phos tosy sodi male hydr besylate sulfate
sulphate acetate potassium tartrate fumarate succinate""".split()
STOP = frozenset(FORMS + SALTS)
_PLACEBO = re.compile(r"\b(?:placebos?|plcb|sham|dummy|vehicle|mock)\b")
_SPLIT = re.compile(r"\+|&|/|;|,|\bplus\b|\bwith\b|\band\b|\bcombined\b")
_DOSE = re.compile(r"\d+(?:[.,]\d+)?\s*(?:%|(?:mg|mcg|ug|g|ml|iu|units?)\b)(?:\s*/\s*(?:m2|kg|ml|h|day|d|dose)\b)?(?:\s*w/v\b)?")
_CODE = re.compile(r"^([a-z]{1,4})0*(\d+)$")
_TYPED_CODE = re.compile(r"(?<![a-z0-9])([a-z]{2,3})[\s_\-\u2010-\u2015\u2212]*(\d{3,6})(?![a-z0-9])")


_MARK = re.compile(r"[®™©]|\((?:r|tm|c)\)", re.I)
_QUOTE = re.compile(r"[\"'`‘“”]")


def plain(value: str) -> str:
    """Lower case without accents, trade marks, quotes and typographic hyphens."""
    value = _MARK.sub(" ", value)
    if not value.isascii():
        value = unicodedata.normalize("NFKD", value.replace("’", "'"))
        value = "".join(c for c in value if not unicodedata.combining(c)).replace("µ", "u")
    return " ".join(_QUOTE.sub("", value.casefold().replace("µ", "u")).split())


def key_of(word: str) -> str:
    """A name without blanks and hyphens; a code as its letters and its number without leading zeros."""
    word = re.sub(r"[^a-z0-9]+", "", word)
    m = _CODE.match(word)
    return m.group(1) + m.group(2) if m else word


def allowed(entry: str, more: int = 0) -> int:
    """The distance allowed from an entry, by its length. Another digit means another thing, so codes must agree."""
    if any(c.isdigit() for c in entry):
        return 0
    n = len(entry) + more
    return 0 if n < 5 else 1 if n < 6 else 2 if n < 10 else 3


def reach(word: str) -> int:
    """The distance to which a word is searched: that of the longest entry it can stand for, three letters more."""
    return allowed(word, 3) if len(word) > 3 else 0


def components(value: str) -> list[list[list[str]]]:
    """The parts of a value joined by "plus", "/" and the like; each a list of word groups (parentheses apart)."""
    text = plain(value)
    while (short := re.sub(rf"^\s*{TYPES}\s*:\s*", "", text)) != text:
        text = short
    text = _TYPED_CODE.sub(lambda m: f" {m.group(1)}{int(m.group(2))} ", _DOSE.sub(" ", text))
    out = []
    for part in _SPLIT.split(text):
        if _PLACEBO.search(part):
            continue
        groups = []
        for piece in re.split(r"[()\[\]{}]", part):
            words = [w for w in re.findall(r"[a-z0-9]+", piece) if w not in STOP]
            if words:
                groups.append(words)
        if groups:
            out.append(groups)
    return out


def spans(words: list[str], longest: int) -> Iterator[tuple[int, int, str]]:
    """Neighbouring words joined, in however many pieces a name was typed, up to the longest entry and three letters."""
    for i in range(len(words)):
        size = 0
        for j in range(i + 1, len(words) + 1):
            size += len(words[j - 1])
            if size > longest + 3 and j > i + 1:
                break
            yield i, j, key_of("".join(words[i:j]))


class Trie:
    """Reference entries with their alias paths; searched for many words at once.

    A word's automaton is one machine word of states for each number of errors (bit i: i letters of the word are
    read), so a step along an edge of the trie is a few vector operations over all words that are still alive.
    """

    def __init__(self, entries: dict[str, tuple[str, ...]]):
        self.longest = max(map(len, entries), default=0)
        self.children: list[dict[str, int]] = [{}]
        self.entries: list[str | None] = [None]  # the key that ends here
        self.products = {}
        for key, names in sorted(entries.items()):
            node = 0
            for ch in key:
                nxt = self.children[node].get(ch)
                if nxt is None:
                    nxt = self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.entries.append(None)
                node = nxt
            self.entries[node] = key
            self.products[key] = names

    def search(self, words: list[str]) -> dict[str, list[tuple[int, str]]]:
        """All (distance, key) within the allowed distance of each word."""
        words = [w for w in words if 0 < len(w) <= self.longest + 3]
        out: dict[str, list[tuple[int, str]]] = {w: [] for w in words}
        for w in (w for w in words if len(w) > 60):  # too long for a machine word
            out[w] = self._search_long(w)
        words = [w for w in words if len(w) <= 60]
        if not words:
            return out
        one = np.uint64(1)
        k = np.array([reach(w) for w in words])
        top = int(k.max())
        length = np.array([len(w) for w in words], np.uint64)
        full = (one << (length + one)) - one
        letters = {c for w in words for c in w}
        masks = {c: np.array([sum(1 << i for i, x in enumerate(w) if x == c) for w in words], np.uint64) for c in letters}
        none = np.zeros(len(words), np.uint64)
        live_e = [np.where(k >= e, full, np.uint64(0)) for e in range(top + 1)]
        start = [np.where(k >= e, np.uint64((1 << (e + 1)) - 1) & full, np.uint64(0)) for e in range(top + 1)]
        stack = [(0, np.arange(len(words)), start)]
        while stack:
            node, idx, state = stack.pop()
            if self.entries[node] is not None:
                done = np.zeros(len(idx), bool)
                for e in range(top + 1):
                    hit = ((state[e] >> length[idx]) & one).astype(bool) & ~done
                    for i in idx[hit]:
                        if e <= allowed(self.entries[node]):
                            out[words[i]].append((e, self.entries[node]))
                    done |= hit
            for ch, child in self.children[node].items():
                m = masks.get(ch, none)[idx]
                new, alive = [], np.zeros(len(idx), np.uint64)
                for e in range(top + 1):
                    r = (state[e] & m) << one
                    if e:
                        r |= state[e - 1] | (state[e - 1] << one) | (new[e - 1] << one)
                    r &= live_e[e][idx]
                    new.append(r)
                    alive |= r
                keep = alive != 0
                if keep.any():
                    stack.append((child, idx[keep], [r[keep] for r in new]))
        return out


    def _search_long(self, word: str) -> list[tuple[int, str]]:
        """The same automaton for one word of any length, its states in integers without bound."""
        k, n = reach(word), len(word)
        full = (1 << (n + 1)) - 1
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << i
        found, stack = [], [(0, [(1 << (e + 1)) - 1 for e in range(k + 1)])]
        while stack:
            node, state = stack.pop()
            entry = self.entries[node]
            if entry is not None:
                d = next((e for e in range(k + 1) if state[e] >> n & 1), None)
                if d is not None and d <= allowed(entry):
                    found.append((d, entry))
            for ch, child in self.children[node].items():
                new: list[int] = []
                for e in range(k + 1):
                    r = (state[e] & masks.get(ch, 0)) << 1
                    if e:
                        r |= state[e - 1] | (state[e - 1] << 1) | (new[e - 1] << 1)
                    new.append(r & full)
                if any(new):
                    stack.append((child, new))
        return found


def swaps(a: str, b: str) -> int:
    """Edit distance in which exchanging two neighbouring letters is one step (optimal string alignment)."""
    prev2, prev = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            best = min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, prev2[j - 2] + 1)
            cur.append(best)
        prev2, prev = prev, cur
    return prev[-1]


def entry_keys(canonical: str | None, aliases: str | None) -> list[tuple[str, str, bool]]:
    """(key, canonical name, whether it is the name itself) of one row of the list; a row without a name has none."""
    if not canonical or not canonical.strip():
        return []
    try:
        names = [x for x in json.loads(aliases or "[]") if isinstance(x, str)]
    except (ValueError, TypeError):
        names = []
    out = [(key_of(plain(canonical)), canonical, True)]
    for name in names:
        words = [w for w in re.findall(r"[a-z0-9]+", plain(name)) if w not in STOP]
        out += [(key_of("".join(words)), canonical, False)] if words else []
    return [k for k in out if k[0]]


def reference_entries(rows: list[tuple[str | None, str | None]]) -> dict[str, tuple[str, ...]]:
    """key -> canonical names, over names and aliases; a name outweighs another's alias, an alias of several names means each of them."""
    own: dict[str, set[str]] = {}
    other: dict[str, set[str]] = {}
    for canonical, aliases in rows:
        for key, name, is_name in entry_keys(canonical, aliases):
            (own if is_name else other).setdefault(key, set()).add(name)
    return {k: tuple(sorted(v)) for k, v in {**other, **own}.items()}


def choose(groups: list[list[str]], found: dict[str, list[tuple[int, str]]], products: dict[str, tuple[str, ...]], longest: int) -> dict[str, tuple[int, str]]:
    """product -> (distance, matched key) of one component: the closest entries on spans that don't overlap."""
    result: dict[str, tuple[int, str]] = {}
    for words in groups:
        options = []
        for i, j, w in spans(words, longest):
            for d, key in found.get(w, ()):
                s = swaps(w, key) if d > 1 else d
                prefix = next((n for n, (x, y) in enumerate(zip(w, key)) if x != y), min(len(w), len(key)))
                options.append((s / len(key), d, -(j - i), -prefix, key, i, j))
        taken: set[int] = set()
        for _, d, _, _, key, i, j in sorted(options):
            if not taken & set(range(i, j)):
                taken |= set(range(i, j))
                for p in products[key]:
                    if p not in result or d < result[p][0]:
                        result[p] = (d, key)
    return result


MATCH = T.StructType([T.StructField("entered_value", T.StringType()), T.StructField("canonical_name", T.StringType()), T.StructField("matched_key", T.StringType()), T.StructField("distance", T.IntegerType())])
_ARROW = pa.schema([("entered_value", pa.string()), ("canonical_name", pa.string()), ("matched_key", pa.string()), ("distance", pa.int32())])


def _rows(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)


def _matches(value: str, parts: list, found: dict, products: dict, longest: int, every: bool) -> list[tuple]:
    """The rows of one value: the products it means, or with ``every`` all entries within the distance of any of its spans."""
    if every:
        near = {(p, key): d for groups in parts for g in groups for _, _, w in spans(g, longest) for d, key in sorted(found.get(w, ()), reverse=True) for p in products[key]}
        return [(value, p, key, d) for (p, key), d in sorted(near.items())]
    hits: dict[str, tuple[int, str]] = {}
    for groups in parts:
        for product, hit in choose(groups, found, products, longest).items():
            if product not in hits or hit < hits[product]:
                hits[product] = hit
    return [(value, product, key, d) for product, (d, key) in sorted(hits.items())] or [(value, "", None, None)]


def small_reference(reference: DataFrame) -> dict[str, tuple[str, ...]] | None:
    """The entries of a list of at most MAX_ENTRIES rows; None if it is longer."""
    rows = [tuple(r) for r in reference.select("canonical_name", "aliases").limit(MAX_ENTRIES + 1).collect()]
    return reference_entries(rows) if len(rows) <= MAX_ENTRIES else None


def listed(reference: DataFrame) -> DataFrame:
    """(key, products) of all entries of a list of any length, as ``reference_entries`` has them."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [k for c, a in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for k in entry_keys(c, a)]
            cols = list(zip(*rows)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.bool_())], names=["key", "product", "own"])

    entries = reference.select("canonical_name", "aliases").mapInArrow(keys, "key string, product string, own boolean").groupBy("key")
    entries = entries.agg(F.collect_set(F.when(F.col("own"), F.col("product"))).alias("o"), F.collect_set("product").alias("a")).select("key", F.array_sort(F.when(F.size("o") > 0, F.col("o")).otherwise(F.col("a"))).alias("products"))
    return materialize(entries, "entries")


def found_in_shards(words: DataFrame, reference: DataFrame, entries: DataFrame | None = None) -> DataFrame:
    """(word, distance, key, product) of every entry within the allowed distance, for lists too long for one trie.

    Entries (``listed``) are cut into shards by hash and words into groups; every group of words meets every shard in
    a task of its own, so neither side is ever whole in one place.
    """
    entries = listed(reference) if entries is None else entries
    distinct = materialize(words.select("word").distinct(), "words")
    shards, blocks = -(-entries.count() // MAX_ENTRIES) or 1, -(-distinct.count() // WORDS_A_GROUP) or 1
    e = entries.select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "key", "products")
    w = distinct.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.pmod(F.xxhash64("word"), F.lit(blocks)).alias("block"), "word")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        trie = Trie({k: tuple(p) for k, p in zip(right.column("key").to_pylist(), right.column("products").to_pylist())})
        rows = [(word, d, key, p) for word, hits in trie.search(sorted(left.column("word").to_pylist())).items() for d, key in hits for p in trie.products[key]]
        cols = list(zip(*rows)) or [[]] * 4
        return pa.table([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string())], names=["word", "distance", "key", "product"])

    return w.groupBy("shard", "block").cogroup(e.groupBy("shard", "block")).applyInArrow(search, "word string, distance int, key string, product string")


def match_values(values: DataFrame, reference: DataFrame, every: bool = False) -> DataFrame:
    """(entered_value, canonical_name, matched_key, distance) for each distinct non-blank ``value``.

    Null and blank values are no cases. A value that names two products gives a row for each; one that names none
    of the list, or a placebo, sham or dummy of a product, gives one row with an empty canonical_name. Of several
    entries within the allowed distance the closest counts (a swap of neighbours is one step; ties: the longer
    common beginning, then the smaller name); an alias that several products share gives a row for each. With
    ``every`` all entries within the distance of any part of a value come out, and unmatched values give no row. An
    empty reference leaves every value unmatched.

    Values are made distinct before anything else (combined map-side, so hot values cost nothing) and spread over
    all cores, as they cost much CPU for few bytes. A list of at most ``MAX_ENTRIES`` goes to every task as one trie;
    a longer one is searched in shards, and the hits of a value's words come back by joins.
    """
    distinct = values.select(F.col("value").cast("string").alias("value")).where(F.col("value").isNotNull() & F.col("value").rlike(r"[^\s\u00a0\u2007\u202f\u200b]")).distinct()
    entries = small_reference(reference)
    if entries is not None:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trie = Trie(entries)
            for batch in batches:
                typed = batch.column(0).to_pylist()
                parts = [components(v) for v in typed]
                found = trie.search(sorted({w for p in parts for groups in p for g in groups for _, _, w in spans(g, trie.longest)}))
                yield _rows([r for v, p in zip(typed, parts) for r in _matches(v, p, found, trie.products, trie.longest, every)])

        return spread(distinct).mapInArrow(run, MATCH)

    longest = reference.select(F.max(F.greatest(F.length("canonical_name"), F.coalesce(F.length("aliases"), F.lit(0))))).first()[0] or 0

    def typed_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(v, w) for v in batch.column(0).to_pylist() for w in sorted({w for groups in components(v) for g in groups for _, _, w in spans(g, longest)})]
            cols = list(zip(*rows)) or [[]] * 2
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string())], names=["value", "word"])

    distinct = materialize(distinct, "values")
    words = materialize(spread(distinct).mapInArrow(typed_words, "value string, word string"), "words")
    hits = words.join(found_in_shards(words, reference), "word").groupBy("value").agg(F.collect_list(F.struct("word", "distance", "key", "product")).alias("hits"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for v, near in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found: dict[str, set] = {}
                products: dict[str, set] = {}
                for h in near or []:
                    found.setdefault(h["word"], set()).add((h["distance"], h["key"]))
                    products.setdefault(h["key"], set()).add(h["product"])
                out += _matches(v, components(v), {w: sorted(x) for w, x in found.items()}, {k: tuple(sorted(x)) for k, x in products.items()}, longest, every)
            yield _rows(out)

    return distinct.join(hits, "value", "left").select("value", "hits").mapInArrow(pick, MATCH)


def typed_products(trials: DataFrame, queries: DataFrame, reference: DataFrame, every: bool = False) -> DataFrame:
    """(entered_value, canonical_name, matched_key, distance) of every name typed in trials' interventions or sent as a query."""
    values = trials.select(F.explode("intervention_names").alias("value")).unionByName(queries.select(F.col("query_name").alias("value")))
    return match_values(values, reference, every)
