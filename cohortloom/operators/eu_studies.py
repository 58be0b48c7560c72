"""EU registry records, older US records, and the common record of both registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.text import adverse_events, distinct_without_case, first_integer, mined_interventions
from cohortloom.operators.studies import regular_json

# fixed values: phase codes and drug names to look for where a record lists none
PHASES = {"1": "Phase I", "2": "Phase II", "3": "Phase III", "4": "Phase IV", "5": "Phase I/II", "6": "Phase II/III"}
KNOWN_DRUGS = ["pirfenidone", "esbriet", "nintedanib", "ofev", "prednisone", "azathioprine", "cyclophosphamide", "mycophenolate", "n-acetylcysteine", "sildenafil"]

_NAMED = "struct<interventionName: string, name: string, description: string, productName: string>"
_PART = f"""struct<
  trialDetails: struct<clinicalTrialIdentifiers: struct<fullTitle: string, publicTitle: string, shortTitle: string>,
    trialInformation: struct<medicalCondition: struct<partIMedicalConditions: array<struct<medicalCondition: string>>>,
      trialCategory: struct<trialPhase: string, trialCategory: string>,
      trialObjective: struct<mainObjective: string, secondaryObjectives: array<struct<secondaryObjective: string, objective: string>>>,
      eligibilityCriteria: struct<principalInclusionCriteria: array<struct<principalInclusionCriteria: string>>, principalExclusionCriteria: array<struct<principalExclusionCriteria: string>>>>>,
  sponsors: array<struct<organisation: struct<organisationFullName: string, name: string, organisationName: string>, organization: struct<organisationFullName: string, name: string, organisationName: string>, organisationName: string, name: string>>,
  products: array<struct<productDictionaryInfo: struct<prodName: string, productName: string, activeSubstanceName: string, sponsorProductCode: string>, productName: string, name: string, tradeName: string>>,
  interventions: array<{_NAMED}>, trialInterventions: array<{_NAMED}>, studyInterventions: array<{_NAMED}>,
  treatmentArms: array<struct<armName: string, name: string, description: string>>, arms: array<struct<armName: string, name: string, description: string>>,
  rowCountriesInfo: array<struct<name: string>>, therapeuticAreas: array<string>, partOneTherapeuticAreas: array<string>, rowSubjectCount: string>"""
EU_RECORD = f"""ctNumber string, ctStatus string, decisionDate string, authorizedApplication struct<authorizedPartI: {_PART}, partI: {_PART}>, application struct<partI: {_PART}>""".replace("\n", " ")
EU_ARRAYS = frozenset("partIMedicalConditions secondaryObjectives principalInclusionCriteria principalExclusionCriteria sponsors products interventions trialInterventions studyInterventions treatmentArms arms rowCountriesInfo therapeuticAreas partOneTherapeuticAreas".split())
LEGACY = """
ProtocolSection struct<IdentificationModule: struct<NCTId: string, OfficialTitle: string>, StatusModule: struct<OverallStatus: string, StartDateStruct: struct<StartDate: string>, CompletionDateStruct: struct<CompletionDate: string>>,
  DesignModule: struct<StudyType: string, PhaseList: struct<Phase: array<string>>>, ConditionModule: struct<ConditionList: struct<Condition: array<string>>>,
  SponsorCollaboratorsModule: struct<LeadSponsor: struct<LeadSponsorName: string>>,
  ArmsInterventionsModule: struct<ArmGroupList: struct<ArmGroup: array<struct<InterventionList: struct<Intervention: array<struct<Name: string>>>>>>>,
  ContactsLocationsModule: struct<LocationList: struct<Location: array<struct<GeoPoint: struct<Country: string>>>>>>
""".replace("\n", " ")
LEGACY_ARRAYS = frozenset("Phase Condition ArmGroup Intervention Location".split())


def _some(*columns: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def _listed(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def eu_records(df: DataFrame, text: str) -> DataFrame:
    """The fields of each readable EU record, with the raw text as ``raw_trial``; alternative places are tried in order."""
    typed = regular_json(df.select(F.col(text).alias("raw_trial"), F.col(text).alias("_text")), "_text", EU_ARRAYS, "raw_trial").select("raw_trial", F.from_json("_json", EU_RECORD).alias("r"))
    p = F.coalesce("r.authorizedApplication.authorizedPartI", "r.authorizedApplication.partI", "r.application.partI")
    t = typed.select("raw_trial", "r.ctNumber", "r.ctStatus", "r.decisionDate", p.alias("p"))
    info = "p.trialDetails.trialInformation"
    ids = "p.trialDetails.clinicalTrialIdentifiers"
    sponsor = F.array_compact(F.transform("p.sponsors", lambda s: _some(s["organisation"]["organisationFullName"], s["organisation"]["name"], s["organisation"]["organisationName"], s["organization"]["organisationFullName"], s["organization"]["name"], s["organization"]["organisationName"], s["organisationName"], s["name"])))
    products = F.transform("p.products", lambda x: F.trim(_some(x["productDictionaryInfo"]["prodName"], x["productDictionaryInfo"]["productName"], x["productDictionaryInfo"]["activeSubstanceName"], x["productDictionaryInfo"]["sponsorProductCode"], x["productName"], x["name"], x["tradeName"])))
    named = F.transform(F.coalesce("p.interventions", "p.trialInterventions", "p.studyInterventions"), lambda x: F.trim(_some(x["interventionName"], x["name"], x["description"], x["productName"])))
    arm_words = F.flatten(F.transform(F.coalesce("p.treatmentArms", "p.arms"), lambda a: F.regexp_extract_all(F.coalesce(_some(a["armName"], a["name"], a["description"]), F.lit("")), F.lit(r"\b([A-Z][a-z]+(?:[A-Z][a-z]+)*)\b"), 1)))
    names = F.array_sort(F.array_distinct(F.filter(F.concat(_listed(products), _listed(named), _listed(arm_words)), lambda x: F.length(x) > 2)))
    main = F.coalesce(f"{info}.trialObjective.mainObjective", F.lit(""))
    second = F.array_join(F.filter(F.transform(f"{info}.trialObjective.secondaryObjectives", lambda o: _some(o["secondaryObjective"], o["objective"])), lambda x: x.isNotNull()), "; ")
    lines = lambda c, f: F.coalesce(F.array_join(F.filter(F.transform(c, lambda x: x[f]), lambda x: F.coalesce(x, F.lit("")) != ""), "\n"), F.lit(""))
    phase = F.create_map(*[F.lit(x) for kv in PHASES.items() for x in kv])
    return t.select(
        F.col("ctNumber").alias("eudract_number"), F.coalesce(_some(F.col(f"{ids}.fullTitle"), F.col(f"{ids}.publicTitle"), F.col(f"{ids}.shortTitle")), F.concat(F.lit("EU Clinical Trial "), F.col("ctNumber"))).alias("title"),
        F.coalesce(_some(F.get(f"{info}.medicalCondition.partIMedicalConditions", F.lit(0))["medicalCondition"]), F.lit("Not specified")).alias("medical_condition"), F.col("ctStatus").alias("trial_status"),
        F.try_element_at(phase, F.col(f"{info}.trialCategory.trialPhase")).alias("trial_phase"), F.when(F.col(f"{info}.trialCategory.trialCategory") == "2", "Interventional").otherwise("Observational").alias("trial_type"),
        F.coalesce(F.get(sponsor, 0), F.lit("Not specified")).alias("sponsor"), F.nullif(F.split_part("decisionDate", F.lit("T"), F.lit(1)), F.lit("")).alias("start_date"), F.lit(None).cast("string").alias("completion_date"),
        first_integer(F.col("p.rowSubjectCount")).alias("enrollment"), F.coalesce(F.get(F.coalesce("p.therapeuticAreas", "p.partOneTherapeuticAreas"), F.lit(0)), F.lit("")).alias("therapeutic_area"),
        _listed(F.filter(F.transform("p.rowCountriesInfo", lambda x: x["name"]), lambda x: F.coalesce(x, F.lit("")) != "")).alias("countries"),
        F.when(F.coalesce(second, F.lit("")) != "", F.concat(main, F.lit("; Secondary: "), second)).otherwise(main).alias("description"),
        lines(f"{info}.eligibilityCriteria.principalInclusionCriteria", "principalInclusionCriteria").alias("inclusion_criteria"),
        lines(f"{info}.eligibilityCriteria.principalExclusionCriteria", "principalExclusionCriteria").alias("exclusion_criteria"), names.alias("intervention_names"),
        F.concat(F.lit("https://euclinicaltrials.eu/ctis-public/view/"), "ctNumber").alias("url"), "raw_trial",
    )


def legacy_records(df: DataFrame, text: str) -> DataFrame:
    """Records of the older US form, interventions nested in arms."""
    t = regular_json(df, text, LEGACY_ARRAYS).select(F.from_json("_json", LEGACY).alias("r")).select("r.ProtocolSection.*")
    names = F.flatten(F.transform("ArmsInterventionsModule.ArmGroupList.ArmGroup", lambda g: F.coalesce(F.transform(g["InterventionList"]["Intervention"], lambda i: i["Name"]), F.array().cast("array<string>"))))
    countries = F.array_distinct(F.filter(F.transform("ContactsLocationsModule.LocationList.Location", lambda x: x["GeoPoint"]["Country"]), lambda c: F.coalesce(c, F.lit("")) != ""))
    e = lambda c: F.coalesce(F.col(c), F.lit(""))
    return t.select(
        e("IdentificationModule.NCTId").alias("nct_id"), e("IdentificationModule.OfficialTitle").alias("title"), F.coalesce(F.array_join("ConditionModule.ConditionList.Condition", ", "), F.lit("")).alias("condition"),
        e("StatusModule.OverallStatus").alias("status"), F.get("DesignModule.PhaseList.Phase", F.lit(0)).alias("phase"), e("DesignModule.StudyType").alias("study_type"), e("SponsorCollaboratorsModule.LeadSponsor.LeadSponsorName").alias("sponsor"),
        e("StatusModule.StartDateStruct.StartDate").alias("start_date"), e("StatusModule.CompletionDateStruct.CompletionDate").alias("completion_date"),
        _listed(F.filter(names, lambda x: F.coalesce(x, F.lit("")) != "")).alias("intervention_names"), _listed(countries).alias("location_countries"),
    )


def enriched(us: DataFrame, eu: DataFrame) -> DataFrame:
    """Trials of both registries as one table: eligibility joined, interventions mined from the description where none are listed, event codes from the texts."""
    codes = lambda *c: F.array_sort(F.array_distinct(F.transform(adverse_events(F.concat_ws(" ", *c)), lambda e: e["code"])))
    a = us.select(
        F.col("nct_id").alias("trial_id"), F.lit("us_registry").alias("source"), "title", "condition", "status", "phase", "study_type", "sponsor", "start_date", "completion_date", "enrollment", "url", "description", "eligibility_criteria",
        F.col("location_countries").alias("countries"), F.col("intervention_names").alias("interventions"), codes("description", "eligibility_criteria").alias("meddra_codes"),
    )
    criteria = F.concat(F.lit("Inclusion: "), F.coalesce("inclusion_criteria", F.lit("")), F.lit("\nExclusion: "), F.coalesce("exclusion_criteria", F.lit("")))
    listed = F.coalesce("intervention_names", F.array().cast("array<string>"))
    b = eu.select(
        F.col("eudract_number").alias("trial_id"), F.lit("eu_registry").alias("source"), "title", F.col("medical_condition").alias("condition"), F.col("trial_status").alias("status"), F.col("trial_phase").alias("phase"), F.col("trial_type").alias("study_type"),
        "sponsor", "start_date", "completion_date", "enrollment", "url", "description", criteria.alias("eligibility_criteria"), "countries",
        F.when(F.size(listed) == 0, mined_interventions(F.coalesce("description", F.lit("")), KNOWN_DRUGS)).otherwise(listed).alias("interventions"), codes("description", "inclusion_criteria", "exclusion_criteria").alias("meddra_codes"),
    )
    return a.unionByName(b)


def union_of_names(*columns: Column) -> Column:
    """Several lists as one, the first spelling of each name."""
    return distinct_without_case(F.flatten(F.array(*[_listed(c) for c in columns])))

