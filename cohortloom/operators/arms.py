"""Treatment-arm labels to the group titles of the adverse-event module."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions import text as X
from cohortloom.operators.dedup import keep_last

#: score (0 to 100) from which a similar title is taken
FUZZY = 90.0


def _subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        left = 0
        for j, y in enumerate(b, 1):
            row[j], left = (left + 1 if x == y else max(row[j], row[j - 1])), row[j]
    return row[-1]


def label_score(a: str, b: str) -> float:
    """100 if two labels share a word; else how well the shorter (words sorted) fits into a stretch of the longer."""
    wa, wb = set(a.split()), set(b.split())
    if wa & wb:
        return 100.0
    short, long = sorted((" ".join(sorted(wa)), " ".join(sorted(wb))), key=len)
    if not short:
        return 0.0
    best = 0.0
    for i in range(max(1, len(long) - len(short) + 1)):
        part = long[i : i + len(short)]
        best = max(best, 200.0 * _subsequence(short, part) / (len(short) + len(part)))
    return best


def resolve_rest(labels: list[str], titles: list[str], taken: list[int], places: list[int], same: bool, score: Callable[[str, str], float] = label_score, least: float = FUZZY) -> list[tuple]:
    """(label number, title number, method, score, status) of labels without an equal title: the most similar free title, else the same place if the counts agree.

    ``labels`` are normal forms and ``places`` their numbers among all labels; ``titles`` are all normal forms and
    ``taken`` the numbers of those that equal labels have.
    """
    free = {j: t for j, t in enumerate(titles) if j not in set(taken)}
    out = []
    left = []
    for place, k in zip(places, labels):
        s, j = max(((score(k, t), -j) for j, t in free.items()), default=(0.0, 1))
        if j <= 0 and s >= least:
            out.append((place, -j, "fuzzy", s, "ok"))
            del free[-j]
        else:
            left.append(place)
    for place in left:
        if same and free.pop(place, None) is not None:
            out.append((place, place, "positional", None, "ok"))
        else:
            out.append((place, None, "unmatched", None, "ambiguous" if same else "count_mismatch"))
    return out


def _numbered(df: DataFrame, number: str, text: str) -> DataFrame:
    """A trial's rows with their place from 0 and their normal form, and which of those with the same form a row is."""
    place = Window.partitionBy("nct_id").orderBy(number)
    t = df.select("nct_id", F.coalesce(text, F.lit("")).alias("text"), (F.row_number().over(place) - 1).alias("place"), X.arm_key(F.col(text)).alias("key"))
    return t.withColumn("nth", F.row_number().over(Window.partitionBy("nct_id", "key").orderBy("place")))


def exact_arms(arms: DataFrame, titles: DataFrame) -> DataFrame:
    """(nct_id, place, arm_label, key, title_place, matched_to): each label with the title of equal normal form, if any; of equal ones the n-th with the n-th."""
    a, t = _numbered(arms, "arm_no", "arm_label"), _numbered(titles, "title_no", "title")
    t = t.select("nct_id", "key", "nth", F.col("place").alias("title_place"), F.col("text").alias("matched_to"))
    return a.join(t, ["nct_id", "key", "nth"], "left").select("nct_id", "place", F.col("text").alias("arm_label"), "key", "title_place", "matched_to")


def resolved_arms(arms: DataFrame, titles: DataFrame) -> DataFrame:
    """The match of every arm label of every trial: equal normal form (``exact_normalized``), else similar, else the same place.

    Normal forms and the exact pass are columns and a join; only the trials with labels left over reach Python, each
    as one row of an Arrow batch (a trial's arms are few). Of repeated labels the last match holds.
    """
    exact = exact_arms(arms, titles)
    per = exact.groupBy("nct_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("title_place").isNull(), F.struct("place", "key")))).alias("rest"), F.array_compact(F.collect_list("title_place")).alias("taken"), F.count(F.lit(1)).alias("n")
    )
    keys = _numbered(titles, "title_no", "title").groupBy("nct_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "key"))), lambda x: x["key"]).alias("titles"))

    def run(frames):
        for pdf in frames:
            out = []
            for n, rest, taken, count, ts in zip(pdf.nct_id, pdf.rest, pdf.taken, pdf.n, pdf.titles):
                ts = [] if ts is None else list(ts)
                out += [(n, *x) for x in resolve_rest([r["key"] for r in rest], ts, list(taken), [int(r["place"]) for r in rest], count == len(ts))]
            yield pd.DataFrame(out, columns=["nct_id", "place", "title_place", "match_method", "fuzzy_score", "arm_match_status"]).astype({"title_place": "Int64"})

    rest = per.where(F.size("rest") > 0).join(keys, "nct_id", "left").mapInPandas(run, "nct_id string, place int, title_place int, match_method string, fuzzy_score double, arm_match_status string")
    labels = exact.where("title_place is null").select("nct_id", "place", "arm_label")
    names = _numbered(titles, "title_no", "title").select("nct_id", F.col("place").alias("title_place"), F.col("text").alias("matched_to"))
    late = labels.join(rest, ["nct_id", "place"]).join(names, ["nct_id", "title_place"], "left")
    cols = ["nct_id", "place", "arm_label", "matched_to", "match_method", "fuzzy_score", "arm_match_status"]
    first = exact.where("title_place is not null").select("nct_id", "place", "arm_label", "matched_to", F.lit("exact_normalized").alias("match_method"), F.lit(None).cast("double").alias("fuzzy_score"), F.lit("ok").alias("arm_match_status"))
    return keep_last(first.unionByName(late.select(*cols)), ["nct_id", "arm_label"], ["place"]).drop("place")


def with_resolved_arms(arms: DataFrame, resolved: DataFrame) -> DataFrame:
    """The arms with matched_to, match_method, fuzzy_score and arm_match_status; an arm without a result keeps nulls."""
    return arms.join(resolved.select("nct_id", "arm_label", "matched_to", "match_method", "fuzzy_score", "arm_match_status"), ["nct_id", "arm_label"], "left")
