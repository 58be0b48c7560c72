"""Cohort demographics through a tiered cascade: reported baseline, text, location, registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.text import needs_model, population_mention
from cohortloom.functions.udfs import population_model
from cohortloom.operators.aggregates import leading_share, pooled_share
from cohortloom.operators.joins import small

#: share of one group from which a cohort counts as uniform
THRESHOLD = 0.95
# fixed values: measure titles, tiers, and the country behind a registry
RACE_TITLES = ("Race", "Race (NIH-OMB)", "Race/Ethnicity", "Race and Ethnicity", "Race and Ethnicity, Customized")
COUNTRY_TITLES = ("Country of Enrollment", "Region of Enrollment", "Country")
TIERS_REPORTED = ("A1", "A1-trial", "A2")
TIERS_INFERRED = ("B1", "B2", "C1", "C2", "C3", "D1", "D2")
REGISTRIES = [("CTRI", "India"), ("JRCT", "Japan"), ("CFDA", "China"), ("NMPA", "China"), ("ANZCTR", "Australia")]
COLUMNS = ("nct_id", "arm_label", "demog_tier", "demog_confidence", "inferred_population", "inferred_diversity_pct", "demog_source_evidence", "fallback_trial_level")

# fixed values: the reference's monoethnic_countries.csv (country, dominant ancestry, region, whether it is left out as diverse)
COUNTRIES = [
    ("Japan", "East Asian (Japanese)", "East Asia", False),
    ("South Korea", "East Asian (Korean)", "East Asia", False),
    ("China", "East Asian (Han)", "East Asia", False),
    ("Taiwan", "East Asian (Han)", "East Asia", False),
    ("Vietnam", "Southeast Asian (Kinh)", "Southeast Asia", False),
    ("Thailand", "Southeast Asian (Thai)", "Southeast Asia", False),
    ("Mongolia", "East Asian (Mongol)", "East Asia", False),
    ("India", "South Asian", "South Asia", False),
    ("Bangladesh", "South Asian (Bengali)", "South Asia", False),
    ("Pakistan", "South Asian", "South Asia", False),
    ("Iran", "Middle Eastern (Persian)", "Middle East", True),
    ("Saudi Arabia", "Middle Eastern (Arab)", "Middle East", False),
    ("Turkey", "Middle Eastern (Turkic)", "Middle East", False),
    ("Israel", "Mixed (Jewish majority)", "Middle East", True),
    ("Egypt", "North African (Arab)", "North Africa", False),
    ("Nigeria", "Sub-Saharan African", "West Africa", True),
    ("Ethiopia", "East African", "East Africa", True),
    ("South Africa", "Mixed", "Southern Africa", True),
    ("Poland", "European (Polish)", "Eastern Europe", False),
    ("Germany", "European (German)", "Western Europe", True),
    ("France", "European (French)", "Western Europe", True),
    ("Italy", "European (Italian)", "Southern Europe", False),
    ("Spain", "European (Spanish)", "Southern Europe", False),
    ("Netherlands", "European (Dutch)", "Western Europe", True),
    ("Sweden", "European (Nordic)", "Northern Europe", False),
    ("Finland", "European (Finnish)", "Northern Europe", False),
    ("Hungary", "European (Hungarian)", "Eastern Europe", False),
    ("Czech Republic", "European (Czech)", "Eastern Europe", False),
    ("Russia", "European (Russian)", "Eastern Europe", True),
    ("United States", "Mixed", "North America", True),
    ("Canada", "Mixed", "North America", True),
    ("Mexico", "Latin American (Mestizo)", "Central America", True),
    ("Brazil", "Mixed", "South America", True),
    ("Argentina", "European-descent Latin American", "South America", False),
    ("Chile", "Latin American (Mestizo)", "South America", False),
    ("Australia", "Mixed", "Oceania", True),
    ("New Zealand", "Mixed", "Oceania", True),
    ("United Kingdom", "Mixed", "Western Europe", True),
    ("Ireland", "European (Irish)", "Western Europe", False),
]


def _row(tier: Column | str, confidence: Column | str | None, population: Column, share: Column | None, evidence: Column, trial_level: bool, arm: Column | None = None) -> list[Column]:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x).cast("string")
    return [
        (arm if arm is not None else F.lit(None).cast("string")).alias("arm_label"), lit(tier).alias("demog_tier"), lit(confidence).alias("demog_confidence"), population.cast("string").alias("inferred_population"),
        (share if share is not None else F.lit(None)).cast("double").alias("inferred_diversity_pct"), evidence.alias("demog_source_evidence"), F.lit(trial_level).alias("fallback_trial_level"),
    ]


def reported_per_arm(baseline: DataFrame) -> DataFrame:
    """A1, or NONE where no group reaches the threshold: the leading race of each arm."""
    rows = baseline.where(F.col("measure_title").isin(*RACE_TITLES)).withColumn("_v", F.col("value").try_cast("double"))
    top = leading_share(rows, ["nct_id", "group_id"], "category", "_v", F.coalesce(F.col("ord"), F.lit(0)), ["measure_title", "group_title"])
    ok = F.col("share") >= THRESHOLD
    return top.select("nct_id", *_row(F.when(ok, "A1").otherwise("NONE"), F.when(ok, "high"), F.when(ok, F.col("category")), F.col("share"), F.col("measure_title"), False, F.col("group_title")))


def reported_per_trial(baseline: DataFrame) -> DataFrame:
    """A1-trial: the leading race after pooling a trial's arms; only where it reaches the threshold."""
    rows = baseline.where(F.col("measure_title").isin(*RACE_TITLES)).withColumn("_v", F.col("value").try_cast("double"))
    titles = rows.where("nct_id is not null").groupBy("nct_id").agg(F.min_by("measure_title", F.coalesce(F.col("ord"), F.lit(0))).alias("measure_title"))
    top = pooled_share(rows, "nct_id", "category", "_v").where(F.col("share") >= THRESHOLD).join(titles, "nct_id")
    return top.select("nct_id", *_row("A1-trial", "high", F.col("category"), F.col("share"), F.col("measure_title"), True))


def reported_country(baseline: DataFrame, countries: DataFrame) -> DataFrame:
    """A2: the leading country of each arm, where it reaches the threshold and is not on the exclusion list."""
    rows = baseline.where(F.col("measure_title").isin(*COUNTRY_TITLES)).withColumn("_v", F.col("value").try_cast("double"))
    top = leading_share(rows, ["nct_id", "group_id"], "category", "_v", F.coalesce(F.col("ord"), F.lit(0)), ["measure_title", "group_title"]).where(F.col("share") >= THRESHOLD)
    dim = countries.where("not in_diverse_exclusion_list").select(F.lower("country_name").alias("_c"), "dominant_ancestry")
    hit = top.join(small(dim), F.lower("category") == F.col("_c"))
    return hit.select("nct_id", *_row("A2", "high", F.col("dominant_ancestry"), F.col("share"), F.concat_ws(": ", "measure_title", "category"), False, F.col("group_title")))


def stated_in_text(trials: DataFrame) -> DataFrame:
    """B1: the first of brief title, official title and description that names a population."""
    hits = F.array_compact(F.array(*[
        F.when(population_mention(F.col(f)).isNotNull(), F.struct(F.lit(c).alias("confidence"), population_mention(F.col(f))["population"].alias("population"), population_mention(F.col(f))["span"].alias("span")))
        for f, c in (("brief_title", "high"), ("official_title", "high"), ("detailed_description", "medium"))
    ]))
    h = trials.select("nct_id", F.get(hits, 0).alias("h")).where("h is not null")
    return h.select("nct_id", *_row("B1", F.col("h.confidence"), F.col("h.population"), None, F.col("h.span"), True))


def stated_by_model(trials: DataFrame, model: Callable) -> DataFrame:
    """B2: an injected model over long eligibility texts of ``trials``, which no pattern has decided."""
    h = trials.where(needs_model(F.col("eligibility_criteria_text"))).select("nct_id", population_model(model)(F.col("eligibility_criteria_text")).alias("h"))
    h = h.where("h.has_population_restriction and h.is_inclusion_criterion")
    return h.select("nct_id", *_row("B2", "medium", F.col("h.population"), None, F.col("h.evidence_span"), True))


def by_location(trials: DataFrame, countries: DataFrame) -> DataFrame:
    """C1 one site country, C2 several of one region, C3 the sponsor's country where there are no sites. Countries on the exclusion list, or unknown, give none.

    Countries compare without case; of repeated ones the first by its values holds.
    """
    dim = countries.where("country_name is not null").groupBy(F.lower("country_name").alias("_k")).agg(F.min(F.struct("country_name", "dominant_ancestry", "region", "in_diverse_exclusion_list")).alias("_d"))
    sites = F.coalesce(F.col("site_countries"), F.array().cast("array<string>"))
    placed = trials.select("nct_id", F.posexplode(sites).alias("pos", "site")).join(small(dim), F.lower("site") == F.col("_k"), "left")
    placed = placed.groupBy("nct_id").agg(F.array_sort(F.collect_list(F.struct("pos", "site", "_d"))).alias("l"))
    t = trials.select("nct_id", "lead_sponsor_country").join(placed, "nct_id", "left").join(small(dim.select(F.col("_k").alias("_s"), F.col("_d").alias("sponsor"))), F.lower("lead_sponsor_country") == F.col("_s"), "left")
    t = t.withColumn("sites", F.coalesce(F.transform("l", lambda x: x["site"]), F.array().cast("array<string>"))).withColumn("found", F.transform("l", lambda x: x["_d"]))
    sites, found, sponsor = F.col("sites"), F.col("found"), F.col("sponsor")
    ok = F.forall(found, lambda d: d.isNotNull() & ~d["in_diverse_exclusion_list"])
    one, regions = F.get(found, 0), F.array_distinct(F.transform(found, lambda d: d["region"]))
    n = F.size(sites)
    hit = (
        F.when((n == 1) & ok, F.struct(F.lit("C1").alias("t"), F.lit("medium").alias("c"), one["dominant_ancestry"].alias("p"), F.concat(F.lit("site country: "), one["country_name"]).alias("e")))
        .when((n > 1) & ok & (F.size(regions) == 1), F.struct(F.lit("C2").alias("t"), F.lit("medium").alias("c"), F.get(regions, 0).alias("p"), F.concat(F.lit("sites: "), F.array_join(sites, ", ")).alias("e")))
        .when((n == 0) & sponsor.isNotNull() & ~sponsor["in_diverse_exclusion_list"], F.struct(F.lit("C3").alias("t"), F.lit("low").alias("c"), sponsor["dominant_ancestry"].alias("p"), F.concat(F.lit("sponsor country: "), F.col("lead_sponsor_country")).alias("e")))
    )
    return t.select("nct_id", hit.alias("h")).where("h is not null").select("nct_id", *_row(F.col("h.t"), F.col("h.c"), F.col("h.p"), None, F.col("h.e"), True))


def by_registry(trials: DataFrame, countries: DataFrame) -> DataFrame:
    """D1: the first secondary id whose domain names a national registry of a country that is not excluded."""
    dim = countries.where("not in_diverse_exclusion_list").select("country_name", "dominant_ancestry")
    ids = trials.select("nct_id", F.posexplode("secondary_ids").alias("pos", "s")).withColumn("_d", F.upper(F.coalesce("s.domain", "s.type")))
    rank = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(k).alias("key"), F.lit(c).alias("country")) for i, (k, c) in enumerate(REGISTRIES)]))
    hits = ids.select("nct_id", "pos", "s", "_d", rank.alias("r")).where(F.contains("_d", F.col("r.key"))).join(small(dim), F.col("r.country") == F.col("country_name"))
    first = hits.groupBy("nct_id").agg(F.min_by(F.struct("dominant_ancestry", F.concat(F.lit("secondary_id "), F.col("r.key"), F.lit(": "), F.col("s.id")).alias("e")), F.struct("pos", "r.i")).alias("h"))
    return first.select("nct_id", *_row("D1", "low", F.col("h.dominant_ancestry"), None, F.col("h.e"), True))


def cascade(trials: DataFrame, baseline: DataFrame, countries: DataFrame, model: Callable | None = None) -> DataFrame:
    """All tiers in order, the higher always winning: a trial with any reported row gets no lower tier; without any it is NONE."""
    reported = reported_per_arm(baseline).unionByName(reported_per_trial(baseline)).unionByName(reported_country(baseline, countries))
    rest = trials.join(reported.select("nct_id").distinct(), "nct_id", "left_anti")
    stated = stated_in_text(rest)
    # calls of a model are the dearest step: it sees only what no pattern has decided
    by_model = [stated_by_model(rest.join(stated.select("nct_id"), "nct_id", "left_anti"), model)] if model else []
    tiers = [stated, *by_model, by_location(rest, countries), by_registry(rest, countries)]
    ranked = None
    for i, t in enumerate(tiers):
        t = t.withColumn("_rank", F.lit(i))
        ranked = t if ranked is None else ranked.unionByName(t)
    best = ranked.groupBy("nct_id").agg(F.min_by(F.struct(*[c for c in COLUMNS if c != "nct_id"]), "_rank").alias("h")).select("nct_id", "h.*")
    none = rest.join(best.select("nct_id"), "nct_id", "left_anti").select("nct_id", *_row("NONE", None, F.lit(None), None, F.lit(None).cast("string"), False))
    return reported.select(*COLUMNS).unionByName(best.select(*COLUMNS)).unionByName(none.select(*COLUMNS))


def with_diversity_flag(demographics: DataFrame) -> DataFrame:
    """passes_diversity: reported tiers by their share, inferred tiers by having a population at all."""
    ok = F.when(F.col("demog_tier").isin(*TIERS_REPORTED), F.col("inferred_diversity_pct") >= THRESHOLD).when(F.col("demog_tier").isin(*TIERS_INFERRED), F.coalesce("inferred_population", F.lit("")) != "")
    return demographics.withColumn("passes_diversity", F.coalesce(ok, F.lit(False)))
