"""Scalar text functions of the trial and drug pipelines, as expressions inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: patterns and word lists that decide results
DASHES = r"[–—−]"
ARM_PREFIX = r"^(experimental|active\s+comparator|placebo(\s+comparator)?|arm\s+[a-z0-9]+|group\s+\d+|cohort\s+[a-z\d]+)\s*[:\-–]\s*"
ARM_DOSE = r"\b\d+(\.\d+)?\s*(mg/m2|mg/kg|mg|mcg|g|auc\d+|iu|units)\b"
ARM_FREQUENCY = r"\bq[dwm]\d*|q\d*[dwm]|qod|bid|tid|daily|weekly|monthly|once\b"
FORM_WORDS = r"\s+(tablet|capsule|injection|solution|oral|topical|cream|ointment)s?$"
DOSE = r"\s+\d+\s*(mg|mcg|g|ml|%)"
INTERVENTION_PREFIX = r"^(drug|biological|other|procedure|device|radiation|diagnostic\s+test|dietary\s+supplement|behavioral|combination\s+product|genetic)\s*:\s*"
ALIAS_NOISE = (
    r"\b\d+(\.\d+)?\s*(ml|mg|mcg|unt|iu|kg|g|%)\b|\b(auto-injector|prefilled syringe|injection|tablet|capsule|extended release|oral solution"
    r"|oral suspension|inhalation|patch|gel|cream|ointment|syrup|drops|lozenge|film|strip|powder)\b"
)
SALTS = (
    r"(\s+(mesylate|dimaleate|hydrochloride|phosphate|disodium|sodium|tartrate|hydrate|dimethyl\s+sulfoxide|sulfoxide|acetate|citrate|fumarate"
    r"|maleate|tosylate|besylate|succinate|sulfate|nitrate|bromide|chloride|gluconate|albumin-stabilized\s+nanoparticle\s+formulation))+\s*$"
)
COMBINATION = r"\s*(?:-|\+|\sand\s|\swith\s)\s*"
BRAND_GENERIC = r"^(.+?)\s*\((.+)\)\s*$"
AE_CODES = {
    "nausea": "10027159", "vomiting": "10042365", "diarrhea": "10017916", "diarrhoea": "10017916", "rash": "10021457", "fatigue": "10022855",
    "cough": "10021454", "dyspnea": "10041144", "dyspnoea": "10041144", "headache": "10019233", "dizziness": "10009388", "fever": "10017912",
}
SOC_RULES = [
    ("Respiratory, thoracic and mediastinal disorders", ["pulmonary", "respiratory", "lung", "breath", "cough", "dyspnoea"]),
    ("Gastrointestinal disorders", ["nausea", "diarrhoea", "vomiting", "abdominal", "gastro"]),
    ("Hepatobiliary disorders", ["liver", "hepatic", "transaminase", "bilirubin"]),
    ("Skin and subcutaneous tissue disorders", ["rash", "skin", "photosensitivity", "dermatitis"]),
    ("Investigations", ["test", "laboratory", "abnormal", "decreased", "increased"]),
    ("General disorders and administration site conditions", ["fatigue", "weight", "appetite", "fever", "pain"]),
]
BIOMARKERS = [
    (r"\begfr\b[^.\n]{0,60}?(mutation|positive|sensitizing)", "EGFR-selective → Asian-skewed"),
    (r"\balk\b[^.\n]{0,40}?(positive|rearrange|fusion)", "ALK-selective"),
    (r"\bkras\s*g12c\b", "KRAS G12C-selective"),
    (r"\bros1\b[^.\n]{0,40}?(positive|rearrange|fusion)", "ROS1-selective"),
    (r"\bbraf\s*v600[ek]?\b", "BRAF-V600-selective"),
    (r"\bmet\s*(exon\s*14|amplification)\b", "MET-selective"),
    (r"\bret\s*(fusion|rearrange)", "RET-selective"),
]
POPULATIONS = (
    r"japanese|korean|chinese|taiwanese|vietnamese|thai|filipino|indian|pakistani|bangladeshi|malay|indonesian|arab|persian|turkish|israeli|"
    r"black|african[\s-]american|african|hispanic|latino|caucasian|white|asian|south\s+asian|east\s+asian|southeast\s+asian|mena|"
    r"european|polish|german|french|italian|spanish|dutch|swedish|finnish|russian|american|brazilian|mexican|nigerian|ethiopian|"
    r"native\s+american|hawaiian|pacific\s+islander"
)
POPULATION_IN_CONTEXT = rf"(?i)(?<!excluding )(?<!without )(?<!non-)(?<!no )\b({POPULATIONS})\s+(patient|subject|population|participant|adult|volunteer|cohort)s?\b"


def title_key(c: Column) -> Column:
    """A title in lower case with single spaces."""
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def arm_key(c: Column) -> Column:
    """An arm label without dash variants, role prefix, dose and frequency; plus and slash stand apart."""
    s = F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), DASHES, "-")))
    for pattern in (ARM_PREFIX, ARM_DOSE, ARM_FREQUENCY):
        s = F.regexp_replace(s, pattern, "")
    s = F.regexp_replace(F.regexp_replace(s, r"\+", " + "), "/", " / ")
    return F.btrim(F.regexp_replace(s, r"\s+", " "), F.lit(" -:–—"))


def drug_key(c: Column) -> Column:
    """A drug name in lower case without one trailing form word and without doses."""
    return F.regexp_replace(F.regexp_replace(F.trim(F.lower(c)), FORM_WORDS, ""), DOSE, "")


def intervention_name(c: Column) -> Column:
    """An intervention without its type prefix."""
    return F.trim(F.regexp_replace(c, "(?i)" + INTERVENTION_PREFIX, ""))


def is_placebo_name(c: Column) -> Column:
    return F.coalesce(F.lower(c).rlike("placebo|sham"), F.lit(False))


def is_control_word(c: Column) -> Column:
    """Exactly the word placebo or control, or nothing at all."""
    return F.coalesce(F.lower(c).isin("placebo", "control", ""), F.lit(True))


def is_clean_alias(c: Column) -> Column:
    """A plausible name: not empty, at most 40 characters, no dose or form words."""
    return F.coalesce((c != "") & (F.length(c) <= 40) & ~F.lower(c).rlike(ALIAS_NOISE), F.lit(False))


def without_salts(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), SALTS, ""))


def brand_and_generic(c: Column) -> Column:
    """``Brand (Generic)`` as a struct; generic is null without parentheses."""
    pattern = BRAND_GENERIC
    return F.struct(F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1)).otherwise(c).alias("brand"), F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 2)).alias("generic"))


def combination_parts(c: Column) -> Column:
    return F.filter(F.split(c, COMBINATION), lambda x: x != "")


def first_integer(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"\d+", 0), F.lit("")).try_cast("int")


def number(c: Column) -> Column:
    return c.try_cast("double")


def soc_category(c: Column) -> Column:
    """The organ class of a term: the first rule any of whose words occurs in it."""
    out = None
    for name, words in SOC_RULES:
        hit = F.lower(c).rlike("|".join(words))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("Other")


def adverse_events(c: Column) -> Column:
    """The keywords that occur in a text, in list order, as (keyword, code) structs; none for null."""
    known = F.array(*[F.struct(F.lit(k).alias("keyword"), F.lit(v).alias("code")) for k, v in AE_CODES.items()])
    return F.filter(known, lambda x: F.coalesce(F.contains(F.lower(c), x["keyword"]), F.lit(False)))


def biomarker_signal(c: Column) -> Column:
    """The labels of the biomarker patterns that occur, joined in order; null if none does."""
    return F.nullif(F.concat_ws("; ", *[F.when(F.lower(c).rlike(p), label) for p, label in BIOMARKERS]), F.lit(""))


def population_mention(c: Column) -> Column:
    """(population, context, span): the first population that a text restricts itself to, with 30 characters around it."""
    at = F.regexp_instr(c, F.lit(POPULATION_IN_CONTEXT))
    whole = F.regexp_extract(c, POPULATION_IN_CONTEXT, 0)
    start = F.greatest(at - 30, F.lit(1))
    span = F.substr(c, start, F.length(whole) + 30 + (at - start))
    return F.when(at > 0, F.struct(F.regexp_extract(c, POPULATION_IN_CONTEXT, 1).alias("population"), F.regexp_extract(c, POPULATION_IN_CONTEXT, 2).alias("context"), span.alias("span")))


def needs_model(c: Column, hit: Column | None = None, context: Column | None = None) -> Column:
    """Whether a text is worth a model call.

    Without a pattern hit, if it is longer than 200 characters; with one, if the hit's ``context`` is ``exclusion`` or
    the text begins like an exclusion.
    """
    head = F.lower(F.substring(F.trim(c), 1, 60))
    excluding = F.coalesce(head.rlike("^(exclusion|excluding|stratification|sub-analysis|subanalysis|biomarker)"), F.lit(False))
    if context is not None:
        excluding = excluding | F.coalesce(context == "exclusion", F.lit(False))
    found = F.coalesce(hit, F.lit(False)) if hit is not None else F.lit(False)
    return F.when(found, excluding).otherwise(F.coalesce(F.length(c) > 200, F.lit(False)))


def regulatory_date(c: Column) -> Column:
    """A date in one of the forms that agencies use, as ``yyyy-MM-dd``; null if it is none. Two-digit years take the nearer century."""
    t = F.trim(c)
    two = F.try_to_timestamp(F.initcap(F.lower(t)), F.lit("dd-MMM-yy")).cast("date")
    limit = F.lit(2074)
    two = F.when(F.year(two) > limit, F.add_months(two, -1200)).otherwise(two)
    out = None
    for fmt, shape in (("yyyyMMdd", r"^\d{8}$"), ("MMM d, yyyy", r"^[A-Za-z]{3} \d{1,2}, \d{4}$"), ("yyyy-MM-dd", r"^\d{4}-\d{2}-\d{2}$"), ("MM/dd/yyyy", r"^\d{2}/\d{2}/\d{4}$")):
        value = F.try_to_timestamp(F.initcap(F.lower(t)) if "MMM" in fmt else t, F.lit(fmt)).cast("date")
        out = F.when(t.rlike(shape), value) if out is None else out.when(t.rlike(shape), value)
    return F.date_format(out.when(t.rlike(r"^\d{2}-[A-Za-z]{3}-\d{2}$"), two), "yyyy-MM-dd")


def any_of_query(names: Column) -> Column:
    """Names as one OR expression; those of several words are quoted."""
    return F.concat(F.lit("("), F.array_join(F.transform(names, lambda a: F.when(F.contains(a, F.lit(" ")), F.concat(F.lit('"'), a, F.lit('"'))).otherwise(a)), " OR "), F.lit(")"))


def budget_batches(names: Column, max_bytes: int) -> Column:
    """Names in order, cut greedily into batches whose OR expression stays within a number of bytes."""
    empty = F.array().cast("array<string>")
    start = F.struct(F.array().cast("array<array<string>>").alias("done"), empty.alias("cur"))

    def step(s: Column, a: Column) -> Column:
        trial = F.array_append(s["cur"], a)
        over = (F.octet_length(any_of_query(trial)) > max_bytes) & (F.size(s["cur"]) > 0)
        return F.struct(F.when(over, F.array_append(s["done"], s["cur"])).otherwise(s["done"]).alias("done"), F.when(over, F.array(a)).otherwise(trial).alias("cur"))

    return F.aggregate(names, start, step, lambda s: F.when(F.size(s["cur"]) > 0, F.array_append(s["done"], s["cur"])).otherwise(s["done"]))


def several_words(c: Column) -> Column:
    return F.size(F.split(F.trim(c), r"\s+")) > 1


def score_band(c: Column, high: float, medium: float) -> Column:
    return F.when(c >= high, "high").when(c >= medium, "medium").otherwise("low")


def mined_interventions(c: Column, known: list[str]) -> Column:
    """Known names that occur in a text, then capitalised words of more than three letters; one of each, without case."""
    low = F.lower(c)
    listed = F.filter(F.array(*[F.lit(k) for k in known]), lambda k: F.contains(low, k))
    caps = F.filter(F.regexp_extract_all(c, F.lit(r"\b([A-Z][a-z]+(?:[A-Z][a-z]+)*)\b"), 1), lambda w: F.length(w) > 3)
    return distinct_without_case(F.concat(listed, caps))


def distinct_without_case(c: Column) -> Column:
    """The first spelling of each value, trimmed and without case, in order; empty and null values are left out."""
    start = F.struct(F.array().cast("array<string>").alias("keys"), F.array().cast("array<string>").alias("values"))

    def step(s: Column, x: Column) -> Column:
        key = F.lower(F.trim(x))
        skip = F.coalesce(key == "", F.lit(True)) | F.array_contains(s["keys"], F.coalesce(key, F.lit("")))
        return F.when(skip, s).otherwise(F.struct(F.array_append(s["keys"], key).alias("keys"), F.array_append(s["values"], x).alias("values")))

    return F.aggregate(c, start, step, lambda s: s["values"])


def section(c: Column, name: str) -> Column:
    """The text behind a dashed header line of that name, up to the next dashed line."""
    return F.regexp_replace(F.regexp_extract(c, rf"(?is)-{{3,}}\s*{name}\s*-{{3,}}(.*?)(\n-{{3,}}|$)", 1), r"^\s+|\s+$", "")
