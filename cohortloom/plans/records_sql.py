"""The SQL of the queries over nested registry records: it reads the same JSON texts in every form they are written in."""

from __future__ import annotations


def _list(x: str) -> str:
    """An array; a bare value is an array of one, null and missing are empty."""
    return f"CASE coalesce(json_type({x}),'NULL') WHEN 'NULL' THEN CAST([] AS JSON[]) WHEN 'ARRAY' THEN CAST({x} AS JSON[]) ELSE [CAST({x} AS JSON)] END"


def _inner(x: str) -> str:
    """A value, or what it holds as JSON text."""
    return f"CASE WHEN json_type({x})='VARCHAR' AND json_valid({x}->>'$') THEN CAST({x}->>'$' AS JSON) ELSE CAST({x} AS JSON) END"


_J = "CASE WHEN json_valid(raw_study) THEN CAST(raw_study AS JSON) END"
#: one row for each readable study: its parts, with modules written as text decoded
BASE = f"""WITH a0 AS (SELECT row_id, {_J} AS j FROM clinical_trials), a1 AS (SELECT row_id, {_inner("j")} AS j FROM a0),
a2 AS (SELECT row_id, unnest(CASE WHEN json_type(j->'studies')='ARRAY' THEN CAST(j->'studies' AS JSON[]) ELSE [j] END) AS j FROM a1 WHERE json_type(j)='OBJECT'),
a3 AS (SELECT row_id, {_inner("j->'protocolSection'")} AS p, {_inner("j->'resultsSection'")} AS r, {_inner("j->'derivedSection'")} AS d FROM a2),
s AS (SELECT row_id, p, {_inner("p->'identificationModule'")} AS im, {_inner("p->'armsInterventionsModule'")} AS am, {_inner("r->'baselineCharacteristicsModule'")} AS bm, {_inner("r->'adverseEventsModule'")} AS em, {_inner("d->'interventionBrowseModule'")} AS xm FROM a3),
t AS (SELECT *, im->>'nctId' AS nct_id FROM s)"""
_COUNTRIES = "list_filter(list_transform(" + _list("p->'contactsLocationsModule'->'locations'") + ", lambda x: x->>'country'), lambda c: c IS NOT NULL AND c<>'')"
_TEXTS = lambda x: f"list_transform({_list(x)}, lambda c: c->>'$')"


def _distinct(x: str) -> str:
    """A list without repeats, in order of appearance."""
    return f"list_filter({x}, lambda c, i: list_position({x}, c)=i)"


STUDY_RECORDS = (
    BASE
    + f""" SELECT coalesce(nct_id,'') AS nct_id, coalesce(im->>'officialTitle', im->>'briefTitle','') AS title, array_to_string({_TEXTS("p->'conditionsModule'->'conditions'")},', ') AS condition,
coalesce(p->'statusModule'->>'overallStatus','') AS status, ({_TEXTS("p->'designModule'->'phases'")})[1] AS phase, coalesce(p->'designModule'->>'studyType','') AS study_type,
coalesce(p->'sponsorCollaboratorsModule'->'leadSponsor'->>'name','') AS sponsor, coalesce(p->'statusModule'->'startDateStruct'->>'date','') AS start_date, coalesce(p->'statusModule'->'completionDateStruct'->>'date','') AS completion_date,
TRY_CAST(p->'designModule'->'enrollmentInfo'->>'count' AS INT) AS enrollment, array_to_string(list_filter(list_transform({_list("am->'interventions'")}, lambda x: x->>'name'), lambda c: c IS NOT NULL AND c<>''),', ') AS intervention_names,
array_to_string({_distinct(_COUNTRIES)},', ') AS location_countries, 'https://clinicaltrials.gov/study/'||coalesce(nct_id,'') AS url, coalesce(p->'descriptionModule'->>'briefSummary','') AS description, coalesce(p->'eligibilityModule'->>'eligibilityCriteria','') AS eligibility_criteria FROM t"""
)
_IDS = "list_transform(" + _list("im->'secondaryIdInfos'") + """, lambda x: '{'||concat_ws(',', '"id":'||to_json(x->>'id')::VARCHAR, '"type":'||to_json(x->>'type')::VARCHAR, '"domain":'||to_json(x->>'domain')::VARCHAR)||'}')"""
TRIAL_ROWS = (
    BASE
    + f""" SELECT nct_id, im->>'briefTitle' AS brief_title, im->>'officialTitle' AS official_title, p->'descriptionModule'->>'detailedDescription' AS detailed_description,
nullif(array_to_string({_TEXTS("p->'designModule'->'phases'")},','),'') AS phase, p->'statusModule'->>'overallStatus' AS overall_status, p->'designModule'->>'studyType' AS study_type, p->'statusModule'->'startDateStruct'->>'date' AS start_date,
p->'statusModule'->'completionDateStruct'->>'date' AS completion_date, TRY_CAST(p->'designModule'->'enrollmentInfo'->>'count' AS INT) AS enrollment_actual, p->'sponsorCollaboratorsModule'->'leadSponsor'->>'name' AS sponsor_name,
p->'sponsorCollaboratorsModule'->'leadSponsor'->>'class' AS sponsor_class, CAST(NULL AS VARCHAR) AS lead_sponsor_country, to_json({_TEXTS("p->'conditionsModule'->'conditions'")})::VARCHAR AS conditions, to_json({_TEXTS("p->'conditionsModule'->'keywords'")})::VARCHAR AS keywords,
to_json(list_sort(list_distinct({_COUNTRIES})))::VARCHAR AS countries, '['||array_to_string({_IDS},',')||']' AS secondary_ids, '[]' AS lung_cancer_subtypes, p->'eligibilityModule'->>'eligibilityCriteria' AS eligibility_criteria_text,
p->'eligibilityModule'->>'sex' AS gender, p->'eligibilityModule'->>'minimumAge' AS minimum_age, p->'eligibilityModule'->>'maximumAge' AS maximum_age, TRY_CAST(p->'eligibilityModule'->>'healthyVolunteers' AS BOOLEAN) AS healthy_volunteers FROM t"""
)
_ARMS = f", g AS (SELECT nct_id, am, unnest({_list("am->'armGroups'")}) AS g, generate_subscripts({_list("am->'armGroups'")},1)-1 AS arm_no FROM t)"
ARM_ROWS = BASE + _ARMS + " SELECT nct_id, CAST(arm_no AS INT) AS arm_no, g->>'label' AS arm_label, g->>'label' AS raw_arm_label, g->>'type' AS arm_type, g->>'description' AS arm_description FROM g"
_PREFIX = "(?i)^(drug|biological|other|procedure|device|radiation|diagnostic\\s+test|dietary\\s+supplement|behavioral|combination\\s+product|genetic)\\s*:\\s*"
_TYPE = lambda name: f"list_filter({_list("am->'interventions'")}, lambda x: x->>'name'={name})[-1]"
ARM_INTERVENTIONS = (
    BASE
    + _ARMS
    + f""", n AS (SELECT nct_id, am, g->>'label' AS arm_label, unnest({_TEXTS("g->'interventionNames'")}) AS intervention_name FROM g), k AS (SELECT *, trim(regexp_replace(intervention_name,'{_PREFIX}',''),' ') AS bare FROM n),
a AS (SELECT k, max_by(rxcui, canonical_name) AS rxcui FROM (SELECT lower(unnest(CAST(aliases AS VARCHAR[]))) AS k, rxcui, canonical_name FROM drug_reference WHERE coalesce(rxcui,'')<>'') GROUP BY 1)
SELECT nct_id, arm_label, intervention_name, coalesce({_TYPE("intervention_name")}, {_TYPE("bare")})->>'type' AS intervention_type, a.rxcui AS rxnorm_rxcui, a.rxcui IS NOT NULL AS matched_lung_cancer_drug, a.rxcui IS NOT NULL AS is_primary_oncology, CAST(NULL AS VARCHAR) AS drug_class FROM k LEFT JOIN a ON lower(k.bare)=a.k"""
)
_GROUP = lambda groups, wanted: f"list_filter({_list(groups)}, lambda y: y->>'id'={wanted})[-1]->>'title'"
BASELINE = (
    BASE
    + f""", m AS (SELECT nct_id, bm->'groups' AS gs, unnest({_list("bm->'measures'")}) AS m FROM t), c AS (SELECT nct_id, gs, m, unnest({_list("m->'classes'")}) AS c FROM m), k AS (SELECT nct_id, gs, m, unnest({_list("c->'categories'")}) AS k FROM c),
v AS (SELECT nct_id, gs, m, k, unnest({_list("k->'measurements'")}) AS v FROM k)
SELECT nct_id, v->>'groupId' AS group_id, {_GROUP("gs", "(v->>'groupId')")} AS group_title, m->>'title' AS measure_title, k->>'title' AS category, v->>'value' AS value, m->>'unitOfMeasure' AS source_units FROM v"""
)
_EVENTS = " UNION ALL ".join(f"SELECT nct_id, em, '{tag}' AS ae_category, unnest({_list(f"em->'{name}'")}) AS e FROM t" for name, tag in (("seriousEvents", "SERIOUS"), ("otherEvents", "OTHER")))
EVENTS = (
    BASE
    + f""", e AS ({_EVENTS}), x AS (SELECT nct_id, em, ae_category, e, unnest({_list("e->'stats'")}) AS x FROM e)
SELECT nct_id, x->>'groupId' AS raw_group_id, {_GROUP("em->'eventGroups'", "(x->>'groupId')")} AS arm_label, ae_category, e->>'term' AS meddra_term, e->>'organSystem' AS organ_system, TRY_CAST(x->>'numAffected' AS DOUBLE) AS affected_count, TRY_CAST(x->>'numAtRisk' AS DOUBLE) AS at_risk_count,
trim('MedDRA '||coalesce(em->>'frequencyCriteria',''),' ') AS source_vocab FROM x"""
)
_NO_PLACEBO = lambda c: f"NOT regexp_matches(lower({c}),'placebo|sham')"
SYNONYMS = (
    BASE
    + f""", i AS (SELECT nct_id, unnest({_list("am->'interventions'")}) AS i FROM t)
SELECT nct_id, i->>'name' AS name, array_to_string(list_filter({_TEXTS("i->'otherNames'")}, lambda x: trim(x,' ')<>'' AND {_NO_PLACEBO("x")}),'|') AS synonyms FROM i WHERE upper(i->>'type') IN ('DRUG','BIOLOGICAL') AND trim(i->>'name',' ')<>'' AND {_NO_PLACEBO("i->>'name'")}"""
)
MESH_PAIRS = (
    BASE
    + f""", b AS (SELECT nct_id, unnest({_list("xm->'browseLeaves'")}) AS b FROM t)
SELECT nct_id, b->>'name' AS name, b->>'asFound' AS as_found FROM b WHERE b->>'relevance'='HIGH' AND lower(b->>'name')<>lower(b->>'asFound') AND {_NO_PLACEBO("b->>'name'")} AND {_NO_PLACEBO("b->>'asFound'")}"""
)
LEGACY = """SELECT coalesce(nct_id,'') AS nct_id, coalesce(title,'') AS title FROM clinical_trials"""
