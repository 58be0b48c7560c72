"""Aggregations of trials, arms, adverse events and harmonised drugs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.text import number


def ae_arm_summary(ae: DataFrame, keys: Sequence[str] = ("nct_id", "arm_label")) -> DataFrame:
    """Per arm: serious and other counts, largest number at risk, distinct terms, and two rates (0 if nobody was at risk).

    Counts that are no numbers count 0; rows with a null key are left out.
    """
    affected, risk = F.coalesce(F.col("affected_count").cast("double"), F.lit(0.0)), F.coalesce(F.col("at_risk_count").cast("double"), F.lit(0.0))
    serious, other = F.col("ae_category") == "SERIOUS", F.col("ae_category") == "OTHER"
    kept = ae
    for k in keys:
        kept = kept.where(F.col(k).isNotNull())
    out = kept.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(serious, affected)), F.lit(0.0)).alias("total_serious_affected"),
        F.coalesce(F.sum(F.when(other, affected)), F.lit(0.0)).alias("total_other_affected"),
        F.max(risk).alias("total_at_risk"),
        F.count_distinct(F.when(serious, F.col("meddra_term"))).alias("distinct_serious_terms"),
        F.count_distinct(F.when(other, F.col("meddra_term"))).alias("distinct_other_terms"),
    )
    at_risk = F.col("total_at_risk")
    return out.withColumn("serious_ae_rate", F.when(at_risk != 0, F.col("total_serious_affected") / at_risk).otherwise(0.0)).withColumn(
        "ae_events_per_participant", F.when(at_risk != 0, (F.col("total_serious_affected") + F.col("total_other_affected")) / at_risk).otherwise(0.0)
    )


def regimens(items: DataFrame, keys: Sequence[str], name: str, code: str) -> DataFrame:
    """Per key: the sorted codes (unknown:<name> without one, repeats kept) and the sorted distinct names, joined by |."""
    low = F.lower(F.coalesce(F.col(name), F.lit("")))
    part = F.when(F.coalesce(F.col(code), F.lit("")) != "", F.col(code)).otherwise(F.concat(F.lit("unknown:"), low))
    return items.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(part)), "|").alias("regimen_key"), F.array_join(F.array_sort(F.collect_set(low)), "|").alias("regimen_display"))


def listed(items: DataFrame, keys: Sequence[str], name: str, **when: Column) -> DataFrame:
    """Per key and condition: the sorted distinct names that meet it, joined by |; empty if none does."""
    return items.groupBy(*keys).agg(*[F.array_join(F.array_sort(F.collect_set(F.when(c, F.col(name)))), "|").alias(a) for a, c in when.items()])


def any_true(df: DataFrame, keys: Sequence[str], flag: Column, alias: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.coalesce(F.bool_or(flag), F.lit(False)).alias(alias))


def leading_share(df: DataFrame, keys: Sequence[str], category: str, value: str, order: str | Column, extra: Sequence[str] = ()) -> DataFrame:
    """Per key: the total, the category with the largest value (ties: first), and its share. Keys with a total of 0 or less are left out."""
    v = F.col(value)
    o = F.col(order) if isinstance(order, str) else order
    top = F.max_by(F.struct(category, *extra, o.alias("_o")), F.struct(v, -o))
    return df.where(v.isNotNull()).groupBy(*keys).agg(F.sum(v).alias("total"), top.alias("_t"), F.max(v).alias("_m")).where("total > 0").select(*keys, "total", *[F.col(f"_t.{c}").alias(c) for c in (category, *extra)], (F.col("_m") / F.col("total")).alias("share"))


def pooled_share(df: DataFrame, key: str, category: str, value: str) -> DataFrame:
    """The leading share per key after pooling equal categories over all groups; null categories and keys are dropped (ties: smaller name)."""
    pooled = df.where(F.col(key).isNotNull() & F.col(category).isNotNull()).groupBy(key, category).agg(F.sum(value).alias("_v"))
    out = pooled.groupBy(key).agg(F.sum("_v").alias("total"), F.max("_v").alias("_m"), F.min_by(category, F.struct(-F.col("_v"), F.col(category))).alias(category))
    return out.where("total > 0").select(key, "total", category, (F.col("_m") / F.col("total")).alias("share"))


def counts_by(df: DataFrame, column: str, missing: str | None = None) -> DataFrame:
    """Rows by value; null (and empty) under ``missing`` if that is given."""
    value = F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(missing)) if missing else F.col(column)
    return df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def enrollment_summary(df: DataFrame, column: str) -> DataFrame:
    """Sum, mean and number of the values that are neither null nor 0; 0 if there are none."""
    v = F.when(F.col(column) != 0, F.col(column))
    return df.agg(F.coalesce(F.sum(v), F.lit(0)).cast("long").alias("total"), F.coalesce(F.round(F.avg(v), 4), F.lit(0.0)).alias("average"), F.count(v).alias("n"))


def quality_issues(df: DataFrame, required: Sequence[str], key: str) -> DataFrame:
    """(key, issue) for each missing (null or blank) required column of each row."""
    issues = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(f"missing {c}")) for c in required]))
    return df.select(key, F.explode(issues).alias("issue"))


def source_confidence(sources: Column, *, rxcui: Column, brands: Column, generics: Column, codes: Column, substances: Column) -> Column:
    """0 to 100: ten a source, ten a kind of data, and fifteen twice if two sources agree."""
    n = F.size(sources)
    has = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    score = n * 10 + 10 * (has(rxcui) + has(brands) + has(generics) + has(substances)) + F.when(n >= 2, 15 * (has(generics) + has(codes | substances))).otherwise(0)
    return F.least(score.cast("double"), F.lit(100.0))


def weighted_confidence(sources: Column, critical: Sequence[tuple[Column, float]], additional: Sequence[Column], of: float = 4.0) -> Column:
    """0 to 1: sources 40 %, weighted critical fields 40 %, share of additional fields 20 %; two decimals."""
    has = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    crit = sum((has(c) * w for c, w in critical), F.lit(0.0)) / float(sum(w for _, w in critical))
    add = sum((has(c) for c in additional), F.lit(0.0)) / float(len(additional))
    return F.round(F.least(sources / F.lit(of) * 0.4 + crit * 0.4 + add * 0.2, F.lit(1.0)), 2)


def name_groups(names: DataFrame) -> DataFrame:
    """Groups of (name, synonym, nct_id, ord) by name without case: canonical name, synonyms and their trials, and how many.

    Of equal synonyms the first by ``ord`` holds; synonyms are sorted without case; the canonical name is the
    spelling seen first.
    """
    first = names.where(F.trim("synonym") != "").groupBy(F.lower(F.trim("name")).alias("k"), F.lower(F.trim("synonym")).alias("s")).agg(F.min_by(F.struct("synonym", "nct_id"), "ord").alias("v"))
    heads = names.groupBy(F.lower(F.trim("name")).alias("k")).agg(F.min_by("name", "ord").alias("canonical_name"))
    out = first.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("s", F.col("v.synonym").alias("synonym"), F.col("v.nct_id").alias("nct_id")))).alias("l"))
    return out.join(heads, "k").select("canonical_name", F.transform("l", lambda x: x["synonym"]).alias("synonyms"), F.transform("l", lambda x: x["nct_id"]).alias("nct_ids"), F.size("l").alias("synonym_count"))


def run_summary(trials: DataFrame, arms: DataFrame, flags: Sequence[str], distribution: str) -> DataFrame:
    """(measure, value): rows, distinct trials, set flags, and the distribution of one column (nulls not counted)."""
    counts = arms.agg(F.count(F.lit(1)).alias("arms"), F.count_distinct("nct_id").alias("arm_trials"), *[F.count_if(F.col(f)).alias(f) for f in flags])
    tall = None
    for one in (trials.agg(F.count(F.lit(1)).alias("trials")), counts):
        part = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("long").alias("value")) for c in one.columns])).alias("x")).select("x.*")
        tall = part if tall is None else tall.unionByName(part)
    return tall.unionByName(trials.where(F.col(distribution).isNotNull()).groupBy(F.concat(F.lit(f"{distribution}="), F.col(distribution)).alias("measure")).agg(F.count(F.lit(1)).alias("value")))


def number_column(df: DataFrame, *columns: str) -> DataFrame:
    """Columns as double; what is no number becomes null."""
    return df.withColumns({c: number(F.col(c).cast("string")) for c in columns})
