"""Spellings of one organisation or person: weighted character n-grams, sparse cosine join, average linkage."""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.canonical import swaps
from cohortloom.llm.components import connected_groups
from cohortloom.session import materialize, spread

#: Length of the character n-grams.
NGRAM = 3
#: Least cosine of a candidate pair; the join is exact above it.
COSINE = 0.25
#: Least average cosine at which two clusters are joined; pairs that fail threshold or exact check count as 0.
LINKAGE = 0.2
#: A component of more edges is clustered in rounds over tables instead of in one task.
TASK_EDGES = 200_000
#: Weight of n-grams of words that name a kind of organisation or a given name, against 1 for the name itself.
COMMON_WEIGHT = 0.3

# fixed values: words in sponsor names and what they stand for
KINDS = {
    "university": "university", "univ": "university", "universitat": "university", "universitaet": "university", "universidad": "university",
    "universite": "university", "universita": "university", "hospital": "hospital", "hosp": "hospital", "hopital": "hospital", "klinik": "hospital",
    "clinic": "clinic", "institute": "institute", "inst": "institute", "institut": "institute", "instituto": "institute", "national": "national",
    "natl": "national", "lung": "lung", "heart": "heart", "cancer": "cancer", "rare": "rare", "disease": "disease", "cooperative": "cooperative",
    "coop": "cooperative", "oncology": "oncology", "respiratory": "respiratory", "research": "research", "trials": "trials", "group": "group",
    "grp": "group", "laboratories": "laboratories", "laboratory": "laboratories", "labs": "laboratories", "lab": "laboratories",
    "biosciences": "biosciences", "biosci": "biosciences", "bioscience": "biosciences", "pharmaceuticals": "pharmaceuticals",
    "pharmaceutical": "pharmaceuticals", "pharma": "pharmaceuticals", "therapeutics": "therapeutics", "tx": "therapeutics", "center": "center",
    "centre": "center", "foundation": "foundation", "college": "college", "school": "school", "society": "society", "network": "network",
}
WHOLE = {"universitatsklinikum": ("university", "hospital"), "universitaetsklinikum": ("university", "hospital"), "chu": ("university", "hospital"), "uniklinik": ("university", "hospital")}
COMPANY = frozenset(["laboratories", "biosciences", "pharmaceuticals", "therapeutics"])
LEGAL = frozenset("gmbh ag aktiengesellschaft ltd limited inc incorporated spa corp corporation co company llc plc sa sas bv nv kg".split())
SMALL = frozenset("the of de des du la le les der die das and und et y for di da del".split())
TITLES = frozenset("dr prof professor md phd mr mrs ms sir".split())
DEPARTMENT = frozenset("dept department division medicine medizin abteilung klinik".split())
NICKNAMES = {
    "kate": "katherine", "kathy": "katherine", "katie": "katherine", "dick": "richard", "rick": "richard", "ted": "theodore", "teddy": "theodore",
    "peggy": "margaret", "meg": "margaret", "maggie": "margaret", "beppe": "giuseppe", "peppe": "giuseppe", "liz": "elizabeth", "beth": "elizabeth",
    "betty": "elizabeth", "bill": "william", "will": "william", "billy": "william", "paco": "francisco", "pancho": "francisco", "sasha": "alexander",
    "alex": "alexander", "hans": "johannes", "sanna": "susanna", "sue": "susanna", "susi": "susanna", "bob": "robert", "rob": "robert", "bobby": "robert",
    "jim": "james", "tom": "thomas", "mike": "michael", "tony": "anthony", "joe": "joseph", "pepe": "jose", "nick": "nicholas", "kit": "christopher",
}
NOBODY = frozenset(["not specified", "unknown", "none", "n/a", "na"])

PARSED = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("spelling", "form", "name", "given", "kinds", "acronym", "bare_acronym")]
)


def _tokens(text: str) -> list[str]:
    text = unicodedata.normalize("NFKD", text)
    text = "".join(c for c in text if not unicodedata.combining(c)).casefold().replace("co-operative", "cooperative")
    text = re.sub(r"(?<=\w)\.(?=\w\.?)|\.", lambda m: "" if m.end() < len(text) and text[m.end() : m.end() + 1].isalnum() else " ", text)
    return re.findall(r"[^\W_]+", text)


def _kind(token: str) -> tuple[str, ...]:
    if token in KINDS:
        return (KINDS[token],)
    if token in WHOLE:
        return WHOLE[token]
    if len(token) >= 6:  # a mistyped word of a kind
        for word in KINDS:
            if len(word) >= 6 and abs(len(word) - len(token)) <= 1 and word[0] == token[0] and swaps(word, token) <= (1 if len(word) < 9 else 2):
                return (KINDS[word],)
    return ()


def parse(spelling: str) -> dict:
    """The parts of a name: proper name, given name or initials, kinds of organisation, acronym."""
    text = spelling.strip()
    acronym = ""
    if m := re.search(r"\(([A-ZÄÖÜ]{3,12})\)\s*$", text):
        acronym, text = m.group(1).lower(), text[: m.start()]
    if re.fullmatch(r"[A-Z]{3,12}", text):
        return {"form": "", "name": "", "given": "", "kinds": "", "acronym": "", "bare_acronym": text.lower(), "solo": text.lower()}
    text = re.sub(r",?\s*(?:M\.?D\.?|Ph\.?D\.?)\s*$", "", text)
    if m := re.fullmatch(r"[Uu]\.\s+(\w+)", text):
        text = f"University {m.group(1)}"
    if re.match(r"(?i)\s*(?:dept|department|division)\b", text) and "," in text:
        text = text.split(",", 1)[1]
    surname_first = bool(re.match(r"^[^,\s]+\s*,", text))
    tokens = [t for t in _tokens(text) if t not in SMALL and t not in TITLES]
    kinds: list[str] = []
    rest = []
    for t in tokens:
        if k := _kind(t):
            kinds += k
        elif t not in LEGAL:
            rest.append(t)
    initials = [t for t in tokens if t in LEGAL and len(t) == 2]
    if not kinds and len(rest) == 1 and initials and len(tokens) == 2:
        rest = tokens  # "Surname AG": initials, as companies without a word for their kind have no legal form either
    legal = len(rest) + len(kinds) < len(tokens)
    rest = rest or tokens
    short = [t for t in rest if len(t) <= 2]
    words = [t for t in rest if len(t) > 2]
    given = ""
    if not kinds and not legal and words and (short or len(words) > 1):
        if len(words) > 1:
            first = words[1] if surname_first else words[0]
            given = NICKNAMES.get(first, first)
            name = words[0] if surname_first else words[-1]
        else:
            name, given = words[0], short[0][0]
    else:
        name = " ".join(sorted(words or short)) or " ".join(spelling.casefold().split())
    return {"form": f"{name}|{given}|{' '.join(sorted(set(kinds)))}", "name": name, "given": given, "kinds": " ".join(sorted(set(kinds))), "acronym": acronym, "bare_acronym": ""}


def _close(a: str, b: str) -> bool:
    if a == b:
        return True
    n = min(len(a), len(b))
    return n >= 4 and abs(len(a) - len(b)) <= 2 and swaps(a, b) <= (1 if n < 7 else 2)


def same_entity(a: dict, b: dict) -> bool:
    """The exact check of a candidate pair: names, given names and kinds must be able to mean one entity."""
    ka, kb = set(a["kinds"].split()), set(b["kinds"].split())
    ga, gb = a["given"], b["given"]
    if ga or gb:  # a person
        if ka or kb or not (ga and gb) or not _close(a["name"], b["name"]):
            return False
        return ga[0] == gb[0] if min(len(ga), len(gb)) == 1 else _close(ga, gb)
    if ka != kb:
        if ka and kb and (ka ^ kb) != {"cooperative"}:
            return False
        if not (ka and kb) and not (ka or kb) & COMPANY:
            return False
    if _close(a["name"], b["name"]):
        return True
    short, long = sorted((a["name"], b["name"]), key=len)
    return len(short) >= 4 and bool(ka | kb) and ka == kb and bool(ka & COMPANY) and len(long) > len(short) + 1 and (long.startswith(short) or (len(short) > 4 and swaps(short, long[: len(short)]) <= 1))


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [{"spelling": s, **parse(s)} for s in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.string()) for c in PARSED.fieldNames()], names=PARSED.fieldNames())


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, gram, share): n-grams of the padded words of each form; common words weigh less."""
    for b in batches:
        ids, grams, weights = [], [], []
        for i, name, given, kinds in zip(*(c.to_pylist() for c in b.columns)):
            own: dict[str, float] = {}
            for words, w in ((name, 1.0), (given, COMMON_WEIGHT), (kinds, COMMON_WEIGHT)):
                for word in words.split():
                    padded = f"#{word}#"
                    for k in range(max(1, len(padded) - NGRAM + 1)):
                        g = padded[k : k + NGRAM]
                        own[g] = max(own.get(g, 0.0), w)
            ids += [i] * len(own)
            grams += own.keys()
            weights += own.values()
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(grams, pa.string()), pa.array(weights, pa.float64())], names=["id", "gram", "share"])


def similar_forms(forms: DataFrame) -> DataFrame:
    """(a, b, sim): pairs of forms whose n-gram cosine ``sim`` is at least COSINE and that pass the exact check; a < b.

    The join is exact: each vector is indexed under its rarest n-grams only, until the rest of it is too short to
    reach the threshold (prefix filter), so the n-grams that everybody has are never joined on. There is no top-n, as
    a cap would lose links.
    """
    # the n-grams are made by a narrow pass over distinct forms
    grams = materialize(forms.select("id", "name", "given", "kinds").mapInArrow(_grams, "id long, gram string, share double"), "grams")
    n = forms.count()
    df = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    weighed = grams.join(df, "gram").select("id", "gram", (F.col("share") * F.log1p(F.lit(float(n)) / F.col("df"))).alias("w"), "df")
    vectors = weighed.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "gram", "w"))).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x["w"] * x["w"]))
    vectors = vectors.select("id", F.transform("v", lambda x: F.struct(x["gram"].alias("g"), (x["w"] / norm).alias("w"))).alias("v"))
    vectors = materialize(vectors.join(forms.select("id", "name", "given", "kinds"), "id"), "vectors")
    # mass of the vector up to and including each n-gram; the prefix ends where the rest is below the threshold
    prefix = vectors.select("id", F.aggregate(
        "v", F.struct(F.lit(0.0).alias("m"), F.array().cast("array<string>").alias("g")),
        lambda s, x: F.struct((s["m"] + x["w"] * x["w"]).alias("m"), F.when(F.lit(1.0) - s["m"] >= COSINE * COSINE, F.array_append(s["g"], x["g"])).otherwise(s["g"]).alias("g")),
    )["g"].alias("gs")).select("id", F.explode("gs").alias("g"))
    pairs = prefix.select(F.col("id").alias("a"), "g").join(prefix.select(F.col("id").alias("b"), "g"), "g").where("a < b").select("a", "b").distinct()

    def side(x: str) -> DataFrame:
        return vectors.select(F.col("id").alias(x), F.col("v").alias("v" + x), *[F.col(k).alias(f"{k}_{x}") for k in ("name", "given", "kinds")])

    met = spread(pairs).join(side("a"), "a").join(side("b"), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            va, vb = batch.column(2), batch.column(3)
            (ga, wa, oa), (gb, wb, ob) = ((v.values.field("g").to_pylist(), v.values.field("w").to_pylist(), v.offsets.to_pylist()) for v in (va, vb))
            known: dict[tuple, dict[str, float]] = {}  # a vector occurs in many neighbouring pairs
            near = []
            for i, b in enumerate(batch.column(1).to_pylist()):
                if (of_b := known.get(b)) is None:
                    of_b = known[b] = dict(zip(gb[ob[i] : ob[i + 1]], wb[ob[i] : ob[i + 1]]))
                near.append(min(1.0, sum(w * of_b[g] for g, w in zip(ga[oa[i] : oa[i + 1]], wa[oa[i] : oa[i + 1]]) if g in of_b)))
            cols = [c.to_pylist() for c in batch.columns[4:]]
            ok = [s >= COSINE and same_entity({"name": na, "given": fa, "kinds": ka}, {"name": nb, "given": fb, "kinds": kb}) for s, na, fa, ka, nb, fb, kb in zip(near, *cols)]
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(near, pa.float64()).filter(keep)], names=["a", "b", "sim"])

    parts = [f"{k}_{x}" for x in ("a", "b") for k in ("name", "given", "kinds")]
    return met.select("a", "b", "va", "vb", *parts).mapInArrow(verify, "a long, b long, sim double")


def average_linkage(edges: list[tuple[int, int, float]], cut: float = LINKAGE) -> dict[int, int]:
    """id -> cluster of one component, joining the pair of clusters with the highest average similarity first.

    Works on the sparse graph: absent pairs count as 0, so memory grows with the edges, not with their square.
    """
    near: dict[int, dict[int, float]] = {}
    for a, b, s in edges:
        near.setdefault(a, {})[b] = s
        near.setdefault(b, {})[a] = s
    size = dict.fromkeys(near, 1)
    members = {i: [i] for i in near}
    heap = [(-s, a, b) for a, b, s in edges]
    heapq.heapify(heap)
    while heap:
        s, a, b = heapq.heappop(heap)
        if a not in near or b not in near or b not in near[a] or abs(near[a][b] / (size[a] * size[b]) + s) > 1e-12:
            continue
        if -s < cut:
            break
        if len(near[a]) < len(near[b]):
            a, b = b, a
        del near[a][b], near[b][a]
        for c, total in near.pop(b).items():
            near[a][c] = near[a].get(c, 0.0) + total
            near[c].pop(b)
        size[a] += size.pop(b)
        members[a] += members.pop(b)
        for c, total in near[a].items():
            near[c][a] = total
            heapq.heappush(heap, (-total / (size[a] * size[c]), min(a, c), max(a, c)))
    return {i: min(m) for m in members.values() for i in m}


def linkage_rounds(edges: DataFrame, cut: float = LINKAGE) -> DataFrame:
    """(id, cluster) by the same average linkage, over tables: in each round all clusters that are each other's nearest are joined.

    Joining two clusters brings neither nearer to a third than the nearer of them was, so reciprocal neighbours can
    be joined at once. Nothing is ever whole in one task. Ties go to the edge with the smaller ids.
    """
    links = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("sim").alias("total")), "links")
    sizes = materialize(links.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.lit(1).cast("long").alias("n")), "sizes")
    where = sizes.select("id", F.col("id").alias("cluster"))
    while True:
        m = links.join(sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("id").alias("b"), F.col("n").alias("nb")), "b")
        m = m.select("a", "b", F.struct((F.col("total") / (F.col("na") * F.col("nb"))).alias("s"), (-F.col("a")).alias("x"), (-F.col("b")).alias("y")).alias("k"))
        best = m.unionByName(m.select(F.col("b").alias("a"), F.col("a").alias("b"), "k")).groupBy("a").agg(F.max("k").alias("k"))
        pairs = best.groupBy("k").agg(F.count(F.lit(1)).alias("c")).where((F.col("c") == 2) & (F.col("k.s") >= cut)).select((-F.col("k.y")).alias("id"), (-F.col("k.x")).alias("into"))
        pairs = materialize(pairs, "joined")
        if pairs.isEmpty():
            return where
        to = lambda df, c: df.join(pairs.select(F.col("id").alias(c), "into"), c, "left").withColumn(c, F.coalesce("into", c)).drop("into")  # noqa: B023, E731
        where = materialize(to(where, "cluster"), "where")
        sizes = materialize(to(sizes, "id").groupBy("id").agg(F.sum("n").alias("n")), "sizes")
        moved = to(to(links, "a"), "b").where("a <> b")
        links = materialize(moved.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("total").alias("total")), "links")


def spelling_clusters(names: DataFrame) -> DataFrame:
    """(spelling, cluster) of each distinct ``name``; spellings of one entity share the cluster.

    Null, blank and placeholder names ("Not specified") name nobody: they are a cluster of their own each. Equal
    spellings are combined map-side first, then equal forms, so hot names cost nothing. An acronym in brackets is
    taken as defined, and a bare acronym belongs to the cluster that defines it; where several define it, to none of
    them. Components of more than TASK_EDGES edges are clustered in rounds over tables, smaller ones each in a task.
    An empty table gives no rows.
    """
    distinct = names.select(F.col("name").cast("string").alias("spelling")).where(F.col("spelling").isNotNull()).distinct()
    named = distinct.where((F.trim("spelling") != "") & ~F.lower(F.trim("spelling")).isin(*NOBODY))
    parsed = materialize(spread(named).mapInArrow(_parse_batches, PARSED).withColumn("id", F.xxhash64("form")), "parsed")
    full = parsed.where("bare_acronym = ''")
    forms = materialize(full.select("id", "name", "given", "kinds").distinct(), "forms")
    edges = materialize(similar_forms(forms), "similar")
    groups = connected_groups(forms.select("id"), edges.select("a", "b"))

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        found = average_linkage(list(zip(pdf.a.tolist(), pdf.b.tolist(), pdf.sim.tolist())))
        return pd.DataFrame(sorted(found.items()), columns=["id", "cluster"])

    placed = materialize(edges.join(groups.select(F.col("id").alias("a"), "group_id"), "a"), "placed")
    large = materialize(placed.groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > TASK_EDGES).select("group_id"), "large")
    clusters = placed.join(large, "group_id", "left_anti").groupBy("group_id").applyInPandas(link, "id long, cluster long")
    if not large.isEmpty():
        clusters = clusters.unionByName(linkage_rounds(placed.join(large, "group_id", "left_semi")))
    of_form = materialize(forms.select("id").join(clusters, "id", "left").select("id", F.coalesce("cluster", "id").alias("cluster")), "clusters")
    defined = full.where("acronym <> ''").join(of_form, "id").groupBy(F.col("acronym").alias("bare_acronym")).agg(F.min("cluster").alias("cluster"), F.max("cluster").alias("last")).where("cluster = last").drop("last")
    bare = parsed.where("bare_acronym <> ''").join(defined, "bare_acronym", "left").select("spelling", F.coalesce("cluster", F.xxhash64(F.concat(F.lit("acronym "), F.col("bare_acronym")))).alias("cluster"))
    return full.join(of_form, "id").select("spelling", "cluster").unionByName(bare)


def sponsor_pairs(trials: DataFrame) -> DataFrame:
    """(sponsor_a, sponsor_b): all pairs of distinct spellings in ``sponsor`` that name one entity, the smaller first."""
    c = materialize(spelling_clusters(trials.select(F.col("sponsor").alias("name"))), "clusters")
    pairs = c.select(F.col("spelling").alias("sponsor_a"), "cluster").join(c.select(F.col("spelling").alias("sponsor_b"), "cluster"), "cluster")
    return pairs.where("sponsor_a < sponsor_b").select("sponsor_a", "sponsor_b")
