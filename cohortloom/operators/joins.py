"""Joins that need care: nulls that match, last-wins dimensions, keys on either side, containment, sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.dedup import keep_first

#: A dimension of at most so many bytes, by the optimiser's statistics, is broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 64 << 20


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint, but only if the plan's statistics bound the size; no job is run for it."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(size)) <= most else df


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join in which null keys match null keys; the right side's keys are dropped."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def lookup(facts: DataFrame, fact_key: Column, dim: DataFrame, dim_key: str, values: Sequence[str], order: str, last: bool = True) -> DataFrame:
    """A left join to a dimension with one row for each key: the last (or first) of repeats holds."""
    pick = F.max_by if last else F.min_by
    one = dim.where(F.col(dim_key).isNotNull()).groupBy(F.col(dim_key).alias("_dk")).agg(*[pick(v, order).alias(v) for v in values])
    return facts.join(small(one), fact_key == F.col("_dk"), "left").drop("_dk")


def suffixed(left: DataFrame, right: DataFrame, key: str, suffix: str, how: str = "left") -> DataFrame:
    """A join on one key in which the right side's clashing columns get a suffix."""
    r = right.select(key, *[F.col(c).alias(c + suffix if c in left.columns else c) for c in right.columns if c != key])
    return left.join(r, key, how)


def with_any_event(arms: DataFrame, summary: DataFrame) -> DataFrame:
    """Arms with has_any_ae: whether events were counted under the matched label, or the label itself without one."""
    a = arms.drop("has_any_ae")
    key = F.coalesce(F.col("matched_to"), F.col("arm_label")) if "matched_to" in a.columns else F.col("arm_label")
    s = summary.select(F.col("nct_id").alias("_n"), F.col("arm_label").alias("_a"), (F.coalesce("total_serious_affected", F.lit(0)) + F.coalesce("total_other_affected", F.lit(0))).alias("_t"))
    return a.join(s, (F.col("nct_id") == F.col("_n")) & key.eqNullSafe(F.col("_a")), "left").withColumn("has_any_ae", F.coalesce(F.col("_t"), F.lit(0)) > 0).drop("_n", "_a", "_t")


def by_any_key(queries: DataFrame, query_key: str, rows: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """Rows that match a query under any of several keys, each ``row_id`` once for a query: a union of equi-joins instead of an OR.

    Of rows with the same id and other values always the same one holds, whatever order they come in.
    """
    q = queries.select(F.col(query_key).alias("_q")).distinct()
    exploded = rows.select("*", F.explode(F.array_distinct(F.array_compact(F.array(*[F.lower(F.trim(k)) for k in keys])))).alias("_k"))
    met = exploded.join(q, F.col("_k") == F.col("_q")).withColumnRenamed("_q", query_key).drop("_k")
    return keep_first(met, [query_key, row_id], [F.xxhash64(*rows.columns), F.to_json(F.struct(*rows.columns))])


def names_of_same_id(names: DataFrame, name: str, code: str) -> DataFrame:
    """For each name: the sorted distinct names that share an id with it."""
    pairs = names.select(F.lower(F.trim(name)).alias("key"), F.col(code).alias("_c")).distinct()
    return pairs.join(names.select(F.col(code).alias("_c"), F.col(name).alias("_n")).distinct(), "_c").groupBy("key").agg(F.array_sort(F.collect_set("_n")).alias("names"))


#: Length of the character n-grams that candidates of a containment share.
GRAM = 3


def _pieces(c: Column) -> Column:
    """The distinct substrings of GRAM letters of a text; a shorter text is its own only one."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(c) - GRAM + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(c, i, F.lit(GRAM))))


def _all_pieces(c: Column) -> Column:
    """The distinct substrings of up to GRAM letters."""
    of = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1))), lambda i: F.substr(c, i, F.lit(n)))
    return F.array_distinct(F.flatten(F.array(*[of(n) for n in range(1, GRAM + 1)])))


def contained(short: DataFrame, s: str, long: DataFrame, l: str) -> DataFrame:
    """(s, l): the distinct non-empty texts of ``short`` and those of ``long`` that contain them, as substrings.

    Every n-gram of a contained text is one of the containing text, so a text is joined on its rarest n-gram only:
    no nested loop over both sides, and n-grams that everybody has are joined on only by texts that have no other.
    """
    long = long.select(F.col(l).alias("_l")).where("_l <> ''").distinct()
    index = long.select("_l", F.explode(_all_pieces(F.col("_l"))).alias("_g"))
    often = index.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    short = short.select(F.col(s).alias("_s")).where("_s <> ''").distinct().select("_s", F.explode(_pieces(F.col("_s"))).alias("_g"))
    anchor = short.join(often, "_g", "left").groupBy("_s").agg(F.min_by("_g", F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_g")).alias("_g"))
    return anchor.join(index, "_g").where(F.contains("_l", "_s")).select(F.col("_s").alias(s), F.col("_l").alias(l))


def contained_either_way(left: DataFrame, left_text: str, right: DataFrame, right_text: str) -> DataFrame:
    """(left text, right text), without case and trimmed: all pairs of which one contains the other."""
    clean = lambda df, c, a: df.select(F.lower(F.trim(c)).alias(a)).where(F.col(a) != "").distinct()
    a, b = clean(left, left_text, "_a"), clean(right, right_text, "_b")
    both = contained(b, "_b", a, "_a").select("_a", "_b").unionByName(contained(a, "_a", b, "_b").select("_a", "_b")).distinct()
    return both.select(F.col("_a").alias(left_text), F.col("_b").alias(right_text))


def matched_labels(queries: DataFrame, labels: DataFrame) -> DataFrame:
    """(query, label_id): labels with a name that contains the query or is contained in it, or with an application of it.

    ``queries`` has query and applications, ``labels`` has label_id, names and applications; lists may be null.
    Application numbers compare without blanks and case, and only on labels that have names; a label without names
    matches nothing.
    """
    named = labels.where(F.size("names") > 0)
    names = named.select("label_id", F.explode("names").alias("name")).select("label_id", F.lower(F.trim("name")).alias("name"))
    q = queries.select("query", F.lower(F.trim("query")).alias("_q")).distinct()
    by_name = contained_either_way(q, "_q", names, "name").join(names, "name").join(q, "_q").select("query", "label_id")
    code = lambda df, k: df.select(k, F.explode("applications").alias("a")).select(k, F.upper(F.replace("a", F.lit(" "))).alias("a")).where("a <> ''").distinct()
    return by_name.unionByName(code(queries, "query").join(code(named, "label_id"), "a").select("query", "label_id")).distinct()


def covered_sets(sets: DataFrame, set_id: str, elements: DataFrame, owner: str, element: str) -> DataFrame:
    """(set_id, owner): owners whose elements include all names of a set; ``sets`` has one row for each (set_id, name)."""
    s = sets.select(set_id, F.lower(F.trim("name")).alias("_n")).distinct()
    need = s.groupBy(set_id).agg(F.count(F.lit(1)).alias("_need"))
    e = elements.select(owner, F.lower(F.trim(element)).alias("_n")).distinct()
    return s.join(e, "_n").groupBy(set_id, owner).agg(F.count(F.lit(1)).alias("_have")).join(need, set_id).where("_have = _need").select(set_id, owner)


def cohort(arms: DataFrame, demographics: DataFrame, drugs: DataFrame, ae_long: DataFrame) -> DataFrame:
    """Arms with events and a matched drug, whose arm- or trial-level demographics pass, with drugs and events."""
    kept = arms.where("has_any_ae and has_lung_cancer_drug_match")
    demo = demographics.where("passes_diversity")
    arm_level = kept.join(demo.where("arm_label is not null"), ["nct_id", "arm_label"])
    trial_level = kept.join(demo.where("arm_label is null").drop("arm_label"), "nct_id")
    both = arm_level.unionByName(trial_level, allowMissingColumns=True)
    return both.join(drugs, ["nct_id", "arm_label"], "left").join(ae_long, ["nct_id", "arm_label"], "inner")
