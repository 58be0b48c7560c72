"""Registry records to relational tables."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions.text import intervention_name
from cohortloom.operators.nested import _inside, read_record

STUDY = """
protocolSection struct<
  identificationModule: struct<nctId: string, briefTitle: string, officialTitle: string, secondaryIdInfos: array<struct<id: string, type: string, domain: string>>>,
  statusModule: struct<overallStatus: string, startDateStruct: struct<date: string>, completionDateStruct: struct<date: string>>,
  designModule: struct<studyType: string, phases: array<string>, enrollmentInfo: struct<count: string>>,
  descriptionModule: struct<briefSummary: string, detailedDescription: string>,
  eligibilityModule: struct<eligibilityCriteria: string, sex: string, minimumAge: string, maximumAge: string, healthyVolunteers: boolean>,
  sponsorCollaboratorsModule: struct<leadSponsor: struct<name: string, class: string>>,
  conditionsModule: struct<conditions: array<string>, keywords: array<string>>,
  contactsLocationsModule: struct<locations: array<struct<country: string>>>,
  armsInterventionsModule: struct<armGroups: array<struct<label: string, type: string, description: string, interventionNames: array<string>>>,
    interventions: array<struct<type: string, name: string, otherNames: array<string>>>>>,
resultsSection struct<
  baselineCharacteristicsModule: struct<groups: array<struct<id: string, title: string>>,
    measures: array<struct<title: string, unitOfMeasure: string, classes: array<struct<categories: array<struct<title: string,
      measurements: array<struct<groupId: string, value: string>>>>>>>>>,
  adverseEventsModule: struct<frequencyCriteria: string, eventGroups: array<struct<id: string, title: string>>,
    seriousEvents: array<struct<term: string, organSystem: string, stats: array<struct<groupId: string, numAffected: string, numAtRisk: string>>>>,
    otherEvents: array<struct<term: string, organSystem: string, stats: array<struct<groupId: string, numAffected: string, numAtRisk: string>>>>>>,
derivedSection struct<interventionBrowseModule: struct<browseLeaves: array<struct<id: string, name: string, asFound: string, relevance: string>>>>
"""
_ARRAYS = frozenset("secondaryIdInfos phases conditions keywords locations armGroups interventionNames interventions otherNames groups measures classes categories measurements eventGroups seriousEvents otherEvents stats browseLeaves".split())


def _regular(value: object, arrays: frozenset[str], key: str = "") -> object:
    """The record with bare values as arrays where the schema has arrays, and modules written as text decoded."""
    if isinstance(value, str) and value[:1] in "{[":
        value = _inside(value)
    if isinstance(value, dict):
        value = {k: _regular(v, arrays, k) for k, v in value.items()}
    elif isinstance(value, list):
        value = [_regular(v, arrays) for v in value]
    if key in arrays and value is not None and not isinstance(value, list):
        value = [value]
    return value


def regular_json(df: DataFrame, text: str, arrays: frozenset[str], *keep: str) -> DataFrame:
    """Columns to keep, and ``_json``: each readable record unwrapped, with arrays where the schema has them; a wrapper of several studies gives a row for each."""
    schema = T.StructType([*[df.schema[k] for k in keep], T.StructField("_json", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, out = [], []
            for i, t in enumerate(b.column(len(keep)).to_pylist()):
                rec = read_record(t)
                if rec is None:
                    continue
                found = [rec]
                if isinstance(rec.get("studies"), list):
                    found = [x for x in map(_inside, rec["studies"]) if isinstance(x, dict)]
                elif isinstance(rec.get("data"), dict):
                    found = [rec["data"]]
                rows += [i] * len(found)
                out += [json.dumps(_regular(x, arrays), ensure_ascii=False) for x in found]
            yield pa.RecordBatch.from_arrays([*[b.column(i).take(pa.array(rows, pa.int64())) for i in range(len(keep))], pa.array(out, pa.string())], names=[*keep, "_json"])

    return df.select(*keep, F.col(text).cast("string")).mapInArrow(run, schema)


def typed_studies(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """Columns to keep, and ``study``: the typed record of each readable JSON text, whatever form it is written in."""
    return regular_json(df, text, _ARRAYS, *keep).select(*keep, F.from_json("_json", STUDY.replace("\n", " ")).alias("study"))


def _p(path: str) -> Column:
    return F.col(f"study.protocolSection.{path}")


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def study_records(s: DataFrame) -> DataFrame:
    """The record of each study: first phase, conditions joined, countries in order of appearance, and the raw text if ``s`` keeps it as ``raw_study``."""
    countries = F.array_distinct(F.filter(F.transform(_p("contactsLocationsModule.locations"), lambda x: x["country"]), lambda c: c.isNotNull() & (c != "")))
    names = F.filter(F.transform(_p("armsInterventionsModule.interventions"), lambda x: x["name"]), lambda c: c.isNotNull() & (c != ""))
    nct = _text(_p("identificationModule.nctId"))
    return s.select(
        nct.alias("nct_id"), _text(F.coalesce(_p("identificationModule.officialTitle"), _p("identificationModule.briefTitle"))).alias("title"),
        _text(F.array_join(_p("conditionsModule.conditions"), ", ")).alias("condition"), _text(_p("statusModule.overallStatus")).alias("status"),
        F.get(_p("designModule.phases"), 0).alias("phase"), _text(_p("designModule.studyType")).alias("study_type"),
        _text(_p("sponsorCollaboratorsModule.leadSponsor.name")).alias("sponsor"), _text(_p("statusModule.startDateStruct.date")).alias("start_date"),
        _text(_p("statusModule.completionDateStruct.date")).alias("completion_date"), _p("designModule.enrollmentInfo.count").try_cast("int").alias("enrollment"),
        F.coalesce(names, F.array().cast("array<string>")).alias("intervention_names"), F.coalesce(countries, F.array().cast("array<string>")).alias("location_countries"),
        F.concat(F.lit("https://clinicaltrials.gov/study/"), nct).alias("url"), _text(_p("descriptionModule.briefSummary")).alias("description"),
        _text(_p("eligibilityModule.eligibilityCriteria")).alias("eligibility_criteria"), *([F.col("raw_study")] if "raw_study" in s.columns else []),
    )


def trial_rows(s: DataFrame) -> DataFrame:
    """One row per study: phases joined by a comma or null, countries sorted and distinct, lists as JSON text."""
    none = F.array().cast("array<string>")
    countries = F.array_sort(F.array_distinct(F.filter(F.transform(_p("contactsLocationsModule.locations"), lambda x: x["country"]), lambda c: c.isNotNull() & (c != ""))))
    return s.select(
        _p("identificationModule.nctId").alias("nct_id"), _p("identificationModule.briefTitle").alias("brief_title"), _p("identificationModule.officialTitle").alias("official_title"),
        _p("descriptionModule.detailedDescription").alias("detailed_description"), F.nullif(F.array_join(_p("designModule.phases"), ","), F.lit("")).alias("phase"),
        _p("statusModule.overallStatus").alias("overall_status"), _p("designModule.studyType").alias("study_type"), _p("statusModule.startDateStruct.date").alias("start_date"),
        _p("statusModule.completionDateStruct.date").alias("completion_date"), _p("designModule.enrollmentInfo.count").try_cast("int").alias("enrollment_actual"),
        _p("sponsorCollaboratorsModule.leadSponsor.name").alias("sponsor_name"), _p("sponsorCollaboratorsModule.leadSponsor.class").alias("sponsor_class"), F.lit(None).cast("string").alias("lead_sponsor_country"),
        F.to_json(F.coalesce(_p("conditionsModule.conditions"), none)).alias("conditions"), F.to_json(F.coalesce(_p("conditionsModule.keywords"), none)).alias("keywords"),
        F.to_json(F.coalesce(countries, none)).alias("countries"), F.coalesce(F.to_json(_p("identificationModule.secondaryIdInfos")), F.lit("[]")).alias("secondary_ids"),
        F.lit("[]").alias("lung_cancer_subtypes"), _p("eligibilityModule.eligibilityCriteria").alias("eligibility_criteria_text"), _p("eligibilityModule.sex").alias("gender"),
        _p("eligibilityModule.minimumAge").alias("minimum_age"), _p("eligibilityModule.maximumAge").alias("maximum_age"), _p("eligibilityModule.healthyVolunteers").alias("healthy_volunteers"),
    )


def arm_rows(s: DataFrame) -> DataFrame:
    """One row per arm; studies without arms have none."""
    g = s.select(_p("identificationModule.nctId").alias("nct_id"), F.posexplode(_p("armsInterventionsModule.armGroups")).alias("arm_no", "g"))
    return g.select("nct_id", "arm_no", F.col("g.label").alias("arm_label"), F.col("g.label").alias("raw_arm_label"), F.col("g.type").alias("arm_type"), F.col("g.description").alias("arm_description"))


def alias_codes(drugs: DataFrame) -> DataFrame:
    """(alias, rxcui): every alias in lower case; of repeats the last listed holds."""
    listed = drugs.where("rxcui is not null and rxcui <> ''").select("canonical_name", "rxcui", F.explode(F.from_json("aliases", "array<string>")).alias("a"))
    return listed.groupBy(F.lower("a").alias("alias")).agg(F.max_by("rxcui", "canonical_name").alias("rxcui"))


def arm_intervention_rows(s: DataFrame, drugs: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """One row per arm and intervention, with the intervention's type, its drug code by alias, and the code's class."""
    from cohortloom.operators.joins import small

    base = s.select(_p("identificationModule.nctId").alias("nct_id"), _p("armsInterventionsModule.interventions").alias("ivs"), F.explode(_p("armsInterventionsModule.armGroups")).alias("g"))
    rows = base.select("nct_id", "ivs", F.col("g.label").alias("arm_label"), F.explode("g.interventionNames").alias("intervention_name"))
    by_raw = lambda c: F.filter("ivs", lambda x: x["name"] == c)
    name = intervention_name(F.col("intervention_name"))
    hit = F.coalesce(F.try_element_at(by_raw(F.col("intervention_name")), F.lit(-1)), F.try_element_at(by_raw(name), F.lit(-1)))
    out = rows.select("nct_id", "arm_label", "intervention_name", hit["type"].alias("intervention_type"), F.lower(name).alias("_k"))
    out = out.join(small(alias_codes(drugs).withColumnRenamed("alias", "_k")), "_k", "left").drop("_k").withColumnRenamed("rxcui", "rxnorm_rxcui")
    out = out.withColumn("matched_lung_cancer_drug", F.col("rxnorm_rxcui").isNotNull()).withColumn("is_primary_oncology", F.col("rxnorm_rxcui").isNotNull())
    if classes is None:
        return out.withColumn("drug_class", F.lit(None).cast("string"))
    one = classes.where("rxcui is not null and rxcui <> ''").groupBy(F.col("rxcui").alias("rxnorm_rxcui")).agg(F.max("drug_class").alias("drug_class"))
    return out.join(small(one), "rxnorm_rxcui", "left")


def _titles(groups: Column, wanted: Column) -> Column:
    """The title of a group; of repeated ids the last holds."""
    return F.try_element_at(F.filter(groups, lambda g: g["id"] == wanted), F.lit(-1))["title"]


def baseline_rows(s: DataFrame) -> DataFrame:
    """One row per measurement of the baseline measures, four levels down, with its group's title."""
    b = s.select(_p("identificationModule.nctId").alias("nct_id"), F.col("study.resultsSection.baselineCharacteristicsModule").alias("b"))
    m = b.select("nct_id", F.col("b.groups").alias("groups"), F.explode("b.measures").alias("m"))
    c = m.select("nct_id", "groups", F.col("m.title").alias("measure_title"), F.col("m.unitOfMeasure").alias("source_units"), F.explode("m.classes").alias("c"))
    k = c.select("nct_id", "groups", "measure_title", "source_units", F.explode("c.categories").alias("k"))
    v = k.select("nct_id", "groups", "measure_title", "source_units", F.col("k.title").alias("category"), F.explode("k.measurements").alias("v"))
    return v.select("nct_id", F.col("v.groupId").alias("group_id"), _titles(F.col("groups"), F.col("v.groupId")).alias("group_title"), "measure_title", "category", F.col("v.value").alias("value"), "source_units")


def ae_rows(s: DataFrame) -> DataFrame:
    """One row per event and group, serious and other, with the group's title and numbers (null if they are none)."""
    a = s.select(_p("identificationModule.nctId").alias("nct_id"), F.col("study.resultsSection.adverseEventsModule").alias("a"))
    parts = []
    for field, tag in (("seriousEvents", "SERIOUS"), ("otherEvents", "OTHER")):
        e = a.select("nct_id", F.col("a.eventGroups").alias("groups"), F.col("a.frequencyCriteria").alias("f"), F.lit(tag).alias("ae_category"), F.explode(f"a.{field}").alias("e"))
        x = e.select("nct_id", "groups", "f", "ae_category", F.col("e.term").alias("meddra_term"), F.col("e.organSystem").alias("organ_system"), F.explode("e.stats").alias("x"))
        parts.append(x.select(
            "nct_id", F.col("x.groupId").alias("raw_group_id"), _titles(F.col("groups"), F.col("x.groupId")).alias("arm_label"), "ae_category", "meddra_term", "organ_system",
            F.col("x.numAffected").try_cast("double").alias("affected_count"), F.col("x.numAtRisk").try_cast("double").alias("at_risk_count"), F.trim(F.concat(F.lit("MedDRA "), _text(F.col("f")))).alias("source_vocab"),
        ))
    return parts[0].unionByName(parts[1])


def intervention_synonyms(s: DataFrame) -> DataFrame:
    """(nct_id, name, synonyms) of drugs and biologicals that are no placebo; their placebo synonyms are left out."""
    from cohortloom.functions.text import is_placebo_name

    i = s.select(_p("identificationModule.nctId").alias("nct_id"), F.explode(_p("armsInterventionsModule.interventions")).alias("i"))
    kept = i.where(F.upper("i.type").isin("DRUG", "BIOLOGICAL") & (F.trim("i.name") != "") & ~is_placebo_name(F.col("i.name")))
    return kept.select("nct_id", F.col("i.name").alias("name"), F.coalesce(F.filter("i.otherNames", lambda x: (F.trim(x) != "") & ~is_placebo_name(x)), F.array().cast("array<string>")).alias("synonyms"))


def mesh_pairs(s: DataFrame) -> DataFrame:
    """(nct_id, name, as_found) of highly relevant browse terms that differ without case and are no placebo."""
    from cohortloom.functions.text import is_placebo_name

    b = s.select(_p("identificationModule.nctId").alias("nct_id"), F.explode("study.derivedSection.interventionBrowseModule.browseLeaves").alias("b"))
    return b.where((F.col("b.relevance") == "HIGH") & (F.lower("b.name") != F.lower("b.asFound")) & ~is_placebo_name(F.col("b.name")) & ~is_placebo_name(F.col("b.asFound"))).select("nct_id", F.col("b.name").alias("name"), F.col("b.asFound").alias("as_found"))


def json_value(c: Column, path: str) -> Column:
    """The value under a dotted path of a JSON text; null if any part is missing."""
    return F.get_json_object(c, "$." + path)
