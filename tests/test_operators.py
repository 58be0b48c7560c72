import json

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import text as X
from cohortloom.functions.udfs import HIT, batched_entities, compatible_lower, population_model, section_after, with_model_cache
from cohortloom.operators import aggregates as A
from cohortloom.operators import components, dedup, demographics, harmonize, joins, scd2, studies
from cohortloom.operators.arms import label_score, resolve_rest, resolved_arms, with_resolved_arms


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("r")).first().r


def test_arm_summary(spark):
    rows = [("N1", "A", "SERIOUS", "T1", 2.0, 100.0), ("N1", "A", "SERIOUS", "T2", 1.0, 100.0), ("N1", "A", "OTHER", "T3", 7.0, 100.0), ("N1", None, "OTHER", "T3", 7.0, 100.0), ("N2", "B", "OTHER", None, None, None)]
    df = spark.createDataFrame(rows, "nct_id string, arm_label string, ae_category string, meddra_term string, affected_count double, at_risk_count double")
    got = {r.nct_id: r for r in A.ae_arm_summary(df).collect()}
    a = got["N1"]
    assert len(got) == 2
    assert (a.total_serious_affected, a.total_other_affected, a.total_at_risk, a.distinct_serious_terms, a.distinct_other_terms) == (3, 7, 100, 2, 1)
    assert (a.serious_ae_rate, a.ae_events_per_participant) == (0.03, 0.1) and got["N2"].serious_ae_rate == 0
    assert A.ae_arm_summary(df.limit(0)).count() == 0


def test_scd2_sequence(spark):
    schema = "trial_id string, status string, enrollment int, title string"
    ts = lambda d: F.to_timestamp(F.lit(f"2024-01-{d:02d}"))
    history, stats = None, []
    for day, row in enumerate([("T", "RECRUITING", 50, "a"), ("T", "ACTIVE", 75, "a"), ("T", "COMPLETED", 100, "b"), ("T", "COMPLETED", 100, "other title")], 1):
        u = scd2.scd2_upsert(history, spark.createDataFrame([row, (None, "x", 1, "x")], schema), "trial_id", ["status", "enrollment"], ts(day))
        stats.append(tuple(u.stats.first()))
        history = spark.createDataFrame(u.history.collect(), u.history.schema)
    assert stats == [(1, 0, 0, 1), (0, 1, 0, 1), (0, 1, 0, 1), (0, 0, 1, 1)]
    rows = scd2.history_of(history, "trial_id", "T").collect()
    assert [(r.version, r.status, r.is_current, r.change_type, r.changed_columns) for r in rows] == [(3, "COMPLETED", True, "UPDATE", ["status", "enrollment"]), (2, "ACTIVE", False, "UPDATE", ["status", "enrollment"]), (1, "RECRUITING", False, "INSERT", None)]
    assert rows[1].valid_to == rows[0].valid_from and rows[0].valid_to is None
    assert scd2.as_of(history, ts(2)).first().status == "ACTIVE"
    assert scd2.current_versions(history, 10, status="COMPLETED").count() == 1


def test_scd2_repeated_key_in_one_batch(spark):
    df = spark.createDataFrame([("T", "a", 1), ("T", "a", 2), ("T", "b", 3), ("T", "a", 4)], "trial_id string, status string, no int")
    u = scd2.scd2_upsert(None, df, "trial_id", ["status"], F.to_timestamp(F.lit("2024-01-01")), "no")
    rows = u.history.orderBy("version").collect()
    assert [(r.version, r.status, r.is_current) for r in rows] == [(1, "a", False), (2, "b", False), (3, "a", True)]
    assert rows[0].valid_from == rows[0].valid_to
    assert tuple(u.stats.first()) == (1, 2, 1, 0) and u.log.count() == 3


def test_keep_first_last_and_duplicates(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), (None, 5, "n"), (None, 4, "m"), ("x", 1, None)], "k string, o int, v string")
    assert {(r.k, r.v) for r in dedup.keep_first(df, ["k"], ["o"]).collect()} == {("k", "a"), (None, "m"), ("x", None)}
    assert {(r.k, r.v) for r in dedup.keep_last(df, ["k"], ["o"]).collect()} == {("k", "b"), (None, "n"), ("x", None)}
    assert dedup.duplicate_members(df, ["k"]).count() == 4
    assert dedup.mode_first_seen(spark.createDataFrame([("k", "b", 1), ("k", "a", 2), ("k", "", 3), ("k", None, 4)], "k string, v string, o int"), ["k"], "v", "o").first().v == "b"
    assert dedup.numbered(df, ["k"], ["o"]).where("row_no = 1").count() == 3


LABELS = {"Experimental: Drug A 200 mg": "drug a", "Arm 1 - Placebo": "placebo", "ACTIVE COMPARATOR – Docetaxel + Cisplatin": "docetaxel + cisplatin", "Cohort 2: X/Y 10 mg/kg": "x / y", None: ""}


def test_arm_labels(spark):
    for raw, want in LABELS.items():
        assert one(spark, raw, X.arm_key) == want


def resolution(spark, labels, titles):
    a = spark.createDataFrame([("N", i, x) for i, x in enumerate(labels)], "nct_id string, arm_no int, arm_label string")
    t = spark.createDataFrame([("N", i, x) for i, x in enumerate(titles)], "nct_id string, title_no int, title string")
    found = {r.arm_label: (r.matched_to, r.match_method, r.fuzzy_score, r.arm_match_status) for r in resolved_arms(a, t).collect()}
    return [found[x or ""] for x in labels]


def test_arm_resolution(spark):
    assert resolution(spark, ["Arm A: Drug X", "Placebo"], ["drug x", "PLACEBO"]) == [("drug x", "exact_normalized", None, "ok"), ("PLACEBO", "exact_normalized", None, "ok")]
    (hit,) = resolution(spark, ["Pembrolizumab monotherapy"], ["Pembrolizumab 200"])
    assert hit[1] == "fuzzy" and hit[2] >= 90 and hit[3] == "ok"
    assert resolution(spark, ["alpha", "beta"], ["qqqq", "zzzz"]) == [("qqqq", "positional", None, "ok"), ("zzzz", "positional", None, "ok")]
    assert resolution(spark, ["alpha", "beta", "gamma"], ["qqqq", "zzzz"]) == [(None, "unmatched", None, "count_mismatch")] * 3
    assert resolution(spark, ["same", "Same", "other"], ["SAME", "zzz", "same"])[:2] == [("SAME", "exact_normalized", None, "ok"), ("same", "exact_normalized", None, "ok")]
    assert resolve_rest(["a", "b"], ["x"], [0], [0, 1], False) == [(0, None, "unmatched", None, "count_mismatch"), (1, None, "unmatched", None, "count_mismatch")]
    assert label_score("", "") == 0 and label_score("abc", "abd") > 60
    a = spark.createDataFrame([("N", 0, "Drug X"), ("N", 1, None), ("M", 0, "solo")], "nct_id string, arm_no int, arm_label string")
    t = spark.createDataFrame([("N", 0, "drug x")], "nct_id string, title_no int, title string")
    out = resolved_arms(a, t)
    assert {(r.nct_id, r.match_method) for r in out.collect()} == {("N", "exact_normalized"), ("N", "unmatched"), ("M", "unmatched")}
    assert {(r.nct_id, r.arm_no, r.matched_to) for r in with_resolved_arms(a, out).collect()} == {("N", 0, "drug x"), ("N", 1, None), ("M", 0, None)}


def test_text_functions(spark):
    assert one(spark, "Pembrolizumab Injection 100 mg", X.drug_key) == "pembrolizumab injection"
    assert one(spark, "Aspirin 100 mg tablets", X.drug_key) == "aspirin"
    assert one(spark, "Drug: Nivolumab", X.intervention_name) == "Nivolumab"
    assert one(spark, "osimertinib mesylate", X.without_salts) == "osimertinib"
    assert tuple(one(spark, "Keytruda (pembrolizumab)", X.brand_and_generic)) == ("Keytruda", "pembrolizumab")
    assert one(spark, "CARBOPLATIN-TAXOL and X", X.combination_parts) == ["CARBOPLATIN", "TAXOL", "X"]
    assert one(spark, "n = 120 (of 300)", X.first_integer) == 120 and one(spark, "none", X.first_integer) is None
    assert one(spark, "EGFR exon 19 mutation; ALK-rearranged", X.biomarker_signal) == "EGFR-selective → Asian-skewed; ALK-selective"
    assert one(spark, "healthy", X.biomarker_signal) is None
    hit = one(spark, "A study in Japanese patients with asthma", X.population_mention)
    assert (hit.population, hit.context) == ("Japanese", "patient") and "Japanese patients" in hit.span
    assert one(spark, "Excluding Japanese patients", X.population_mention) is None and one(spark, "non-japanese patients", X.population_mention) is None
    assert one(spark, "keytruda 25 MG injection", X.is_clean_alias) is False and one(spark, "keytruda", X.is_clean_alias) is True
    assert [one(spark, s, X.regulatory_date) for s in ("20230213", "20020522", "25-AUG-14", "Sep 28, 2023", "01-JAN-10", "31-DEC-98", "soon", None)] == ["2023-02-13", "2002-05-22", "2014-08-25", "2023-09-28", "2010-01-01", "1998-12-31", None, None]
    assert one(spark, ["Drug A", "a", "drug a ", None, ""], X.distinct_without_case, "array<string>") == ["Drug A", "a"]
    assert one(spark, "--- WARNINGS ---\nbad things\n---\nmore", lambda c: X.section(c, "WARNINGS")) == "bad things"
    assert one(spark, "ＡＢＣ  ﬁ", compatible_lower) == "abc fi"
    body = "It is used for this and that. " * 6
    assert one(spark, f"1 INDICATIONS AND USAGE\n{body}\n2 DOSAGE\nx", section_after("INDICATIONS AND USAGE")) == body.strip()


def test_budget_batches(spark):
    names = [f"alias number {i}" for i in range(1000)]
    got = one(spark, names, lambda c: X.budget_batches(c, 500), "array<string>")
    expr = lambda b: "(" + " OR ".join(f'"{a}"' for a in b) + ")"
    assert [a for b in got for a in b] == names and all(len(expr(b)) <= 500 for b in got)


def test_models_and_cache(spark):
    calls = lambda t: {"has_population_restriction": True, "population": "x"} if t == "hit" else (1 / 0 if t == "fail" else {})
    df = spark.createDataFrame([("1", "hit"), ("2", "fail"), ("3", None), ("4", "hit")], "nct_id string, text string")
    out = {r.nct_id: r.h for r in df.select("nct_id", population_model(calls)(F.col("text")).alias("h")).collect()}
    assert out["1"].population == "x" and not out["2"].has_population_restriction and not out["3"].has_population_restriction
    from pyspark.sql import types as T

    cache = spark.createDataFrame([("4", False, "cached", False, None, None)], T.StructType([T.StructField("nct_id", T.StringType()), *HIT.fields]))
    got = {r.nct_id: r.hit.population for r in with_model_cache(df, cache, calls).collect()}
    assert got == {"1": "x", "2": None, "3": None, "4": "cached"}
    names = spark.createDataFrame([("b a b",), ("c",)], "name string")
    assert {r.name: r.entities for r in batched_entities(names, lambda xs: [x.split() for x in xs], 1).collect()} == {"b a b": ["b", "a"], "c": ["c"]}


def test_synonym_groups(spark):
    pairs = spark.createDataFrame([("b", "a"), ("b", "c"), ("x", "y"), (None, "q"), ("c", "c")] + [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)], "a string, b string")
    got = {r.name: r.root for r in components.synonym_groups(pairs).collect()}
    assert got["c"] == "a" and got["y"] == "x" and got["n060"] == "n000" and "q" not in got


COUNTRIES = [("Japan", "East Asian", "East Asia", False), ("Korea", "Korean", "East Asia", False), ("China", "Han", "East Asia", False), ("United States", "mixed", "North America", True), ("India", "South Asian", "South Asia", False)]


def test_demographic_cascade(spark):
    dim = spark.createDataFrame(COUNTRIES, "country_name string, dominant_ancestry string, region string, in_diverse_exclusion_list boolean")
    schema = "nct_id string, brief_title string, official_title string, detailed_description string, eligibility_criteria_text string, site_countries array<string>, lead_sponsor_country string, secondary_ids array<struct<id: string, type: string, domain: string>>"
    t = lambda n, title=None, sites=None, sponsor=None, ids=None: (n, title, None, None, None, sites, sponsor, ids)
    trials = spark.createDataFrame([
        t("A1", "Study in Korean patients"), t("B1", "Study in Korean patients"), t("C1", sites=["Japan"]), t("C2", sites=["Japan", "Korea", "China"]), t("C3", sponsor="Korea"), t("US", sites=["United States"]),
        t("D1", ids=[("x", None, "CTRI (India)")]), t("NO"), t("MIX"), t("POOL"), t("A2"), t("MIXED", sites=["Japan", "India"]),
    ], schema)
    b = [("A1", "g", "arm", "Race", c, v, i) for i, (c, v) in enumerate([("Asian", "95"), ("White", "3"), ("Black", "2")])] + [("MIX", "g", "arm", "Race", c, v, i) for i, (c, v) in enumerate([("Asian", "60"), ("White", "40")])]
    b += [("POOL", g, g, "Race", c, v, i) for i, (g, c, v) in enumerate([("g1", "Asian", "47"), ("g1", "White", "3"), ("g2", "Asian", "48"), ("g2", "White", "2")])] + [("A2", "g", "arm", "Region of Enrollment", "Japan", "98", 0), ("A2", "g", "arm", "Region of Enrollment", "China", "NA", 1)]
    baseline = spark.createDataFrame(b, "nct_id string, group_id string, group_title string, measure_title string, category string, value string, ord int")
    out = demographics.with_diversity_flag(demographics.cascade(trials, baseline, dim)).collect()
    tiers = {}
    for r in out:
        tiers.setdefault(r.nct_id, set()).add((r.demog_tier, r.inferred_population, r.passes_diversity))
    assert tiers["A1"] == {("A1", "Asian", True), ("A1-trial", "Asian", True)}
    assert tiers["B1"] == {("B1", "Korean", True)} and tiers["C1"] == {("C1", "East Asian", True)} and tiers["C2"] == {("C2", "East Asia", True)} and tiers["C3"] == {("C3", "Korean", True)}
    assert tiers["US"] == {("NONE", None, False)} == tiers["NO"] == tiers["MIX"] == tiers["MIXED"]
    assert tiers["D1"] == {("D1", "South Asian", True)} and ("A1-trial", "Asian", True) in tiers["POOL"] and tiers["A2"] == {("A2", "East Asian", True)}


def test_study_parsers(spark):
    study = {"protocolSection": {"identificationModule": {"nctId": "N1", "briefTitle": "B"}, "designModule": {"phases": ["PHASE1", "PHASE2"], "enrollmentInfo": {"count": 7}}, "contactsLocationsModule": {"locations": [{"country": "X"}, {"country": "A"}, {"country": "X"}, {}]},
             "armsInterventionsModule": {"armGroups": [{"label": "Arm A", "interventionNames": ["Drug: Pembrolizumab", "Biological: Nivolumab"]}], "interventions": [{"type": "DRUG", "name": "Pembrolizumab", "otherNames": ["MK", "placebo"]}, {"type": "DRUG", "name": "Placebo"}]}},
             "resultsSection": {"adverseEventsModule": {"frequencyCriteria": "5", "eventGroups": [{"id": "E", "title": "first"}, {"id": "E", "title": "last"}], "seriousEvents": [{"term": "T", "stats": [{"groupId": "E", "numAffected": 2, "numAtRisk": "NA"}]}]}}}
    df = studies.typed_studies(spark.createDataFrame([(1, json.dumps(study)), (2, "{broken"), (3, None)], "row_id long, j string"), "j", "row_id")
    assert df.count() == 1
    r = studies.study_records(df).first()
    assert (r.title, r.phase, r.enrollment, r.location_countries) == ("B", "PHASE1", 7, ["X", "A"])
    assert studies.trial_rows(df).first().countries == '["A","X"]' and studies.trial_rows(df).first().phase == "PHASE1,PHASE2"
    drugs = spark.createDataFrame([("pembrolizumab", "11", '["Pembrolizumab", "Keytruda"]'), ("nivolumab", "22", '["nivolumab"]')], "canonical_name string, rxcui string, aliases string")
    ai = {r.intervention_name: r for r in studies.arm_intervention_rows(df, drugs, spark.createDataFrame([("11", "immunotherapy")], "rxcui string, drug_class string")).collect()}
    assert ai["Drug: Pembrolizumab"].rxnorm_rxcui == "11" and ai["Drug: Pembrolizumab"].intervention_type == "DRUG" and ai["Drug: Pembrolizumab"].drug_class == "immunotherapy" and ai["Biological: Nivolumab"].matched_lung_cancer_drug
    ae = studies.ae_rows(df).first()
    assert (ae.arm_label, ae.affected_count, ae.at_risk_count, ae.source_vocab) == ("last", 2.0, None, "MedDRA 5")
    assert [(r.name, r.synonyms) for r in studies.intervention_synonyms(df).collect()] == [("Pembrolizumab", ["MK"])]


def test_harmonisation(spark):
    apps = spark.createDataFrame([("NDA1", [("20200101", "ORIG", "1", None, [("Label", "http://x/a.pdf"), ("Letter", "http://x/b.pdf")]), ("20210101", "SUPPL", "2", "c", [("Label", "http://y/http/c.pdf"), ("Label", "http://y/d.pdf")]), ("20210101", "SUPPL", "2", "c", [])])],
        "application_number string, submissions array<struct<submission_status_date: string, submission_type: string, submission_number: string, submission_class_code: string, application_docs: array<struct<type: string, url: string>>>>")
    assert harmonize.application_events(apps).count() == 2
    assert tuple(harmonize.newest_labels(apps).first()) == ("NDA1", "20210101", "https://y/d.pdf")
    p = harmonize.ingredient_columns(spark.createDataFrame([("1", "2", "A; B", "TABLET;ORAL")], "Appl_No string, Product_No string, Ingredient string, `DF;Route` string"))
    assert (p.first().ingredients, p.first().route) == (["A", "B"], "ORAL")
    pat = spark.createDataFrame([("1", "2", "US1", "Sep 28, 2023"), ("1", "2", "US1", "Sep 28, 2023")], "Appl_No string, Product_No string, Patent_No string, Patent_Expire_Date string")
    exc = spark.createDataFrame([], "Appl_No string, Product_No string, Exclusivity_Code string, Exclusivity_Date string")
    assert len(harmonize.with_patents(p, pat, exc).first().patents) == 1
    keys = harmonize.lookup_keys(spark.createDataFrame([(1, ["Aspirin"], ["ASPIRIN", "Bayer"])], "id int, generic array<string>, brand array<string>"), "id", "generic", "brand")
    q = spark.createDataFrame([("Aspirin 100 mg",), ("none",), (None,)], "query string")
    assert [tuple(r) for r in harmonize.found_by_name(q, keys, "id").collect()] == [("Aspirin 100 mg", 1)]
    assert one(spark, "see NCT01234567 and NCT07654321", harmonize.trial_ids_in) == ["NCT01234567", "NCT07654321"]
    t = harmonize.typed_dates(spark.createDataFrame([("k", "20200101", None)], "k string, a string, b string"), "k", {"a": "first", "b": "second"})
    assert [tuple(r) for r in t.collect()] == [("k", "first", "2020-01-01")]


def test_agency_records(spark):
    ndc = spark.createDataFrame([("1", "B", "g", "L", [("1-1", "box")], [("A", "5 mg"), ("C", None)]), ("2", "B", "g", "L", None, None)], "product_ndc string, brand_name string, generic_name string, labeler_name string, packaging array<struct<package_ndc: string, description: string>>, active_ingredients array<struct<name: string, strength: string>>")
    assert {(r.product_ndc, r.package_ndc, r.ingredients) for r in harmonize.packages(ndc).collect()} == {("1", "1-1", "A 5 mg; C"), ("2", None, None)}
    bla = spark.createDataFrame([(" 1 ", "x", "A, B,", "351(k) Interchangeable"), ("2", "y", None, "351(a)"), ("3", "z", "", None), ("4", "w", "C", "351(k) Biosimilar")], "`BLA Number` string, `Proper Name` string, `Proprietary Name` string, `BLA Type` string")
    assert [(r.bla_number, r.brand_names, r.interchangeability) for r in harmonize.licences(bla).orderBy("bla_number").collect()] == [("1", ["A", "B"], "Interchangeable"), ("2", [], "Reference Product"), ("3", [], None), ("4", ["C"], "Biosimilar")]
    lab = spark.createDataFrame([("s", ["use it", "x"], None, ["1-1"], ["NCT01234567 and NCT01234567"])], "set_id string, indications_and_usage array<string>, mechanism_of_action array<string>, product_ndc array<string>, clinical_studies array<string>")
    assert tuple(harmonize.label_facts(lab).first()) == ("s", "use it", None, ["NDC: 1-1"], ["NCT01234567"])
    rows = spark.createDataFrame([(1, ["a", "B"]), (2, ["b"]), (3, ["c"]), (4, None)], "id int, names array<string>")
    assert {r.id: r.group for r in harmonize.merged_rows(rows, "id", "names").collect()} == {1: "1", 2: "1", 3: "3", 4: "4"}


def test_run_log(spark):
    from cohortloom.operators import runs

    at = lambda m: F.to_timestamp(F.lit(f"2024-01-01 00:{m:02d}:00"))
    log = runs.start_run(spark, runs.start_run(spark, None, "r1", at(0)), "r2", at(1))
    stats = spark.createDataFrame([(1, 2, 3, 4)], "inserted long, updated long, unchanged long, errors long")
    out = {r.run_id: r for r in runs.complete_run(log, "r1", stats, at(5)).collect()}
    assert (out["r1"].status, out["r1"].errors, out["r1"].duration_seconds, out["r2"].status) == ("completed", 4, 300.0, "running")
    assert runs.complete_run(log, "r2", stats, at(5), "boom").where("status = 'failed'").count() == 1
    assert runs.text_report(spark.createDataFrame([("b", 2), ("a", 1)], "measure string, value int"), "Report").split("\n") == ["Report", "======", "a: 1", "b: 2"]


def test_joins_with_nulls_and_flags(spark):
    a = spark.createDataFrame([("1", None), ("1", "x")], "nct_id string, arm_label string")
    b = spark.createDataFrame([("1", None, 5), ("1", "x", 6)], "nct_id string, arm_label string, v int")
    assert joins.null_safe_join(a, b, ["nct_id", "arm_label"]).count() == 2
    s = spark.createDataFrame([("1", "x", 0.0, 2.0)], "nct_id string, arm_label string, total_serious_affected double, total_other_affected double")
    assert {r.arm_label: r.has_any_ae for r in joins.with_any_event(joins.with_any_event(a, s), s).collect()} == {None: False, "x": True}
    left = spark.createDataFrame([("humira pen",), ("hum",), ("i",), ("zzz",), ("",), (None,)], "name string")
    right = spark.createDataFrame([("Humira",), ("",), ("An",)], "label string")
    assert {tuple(r) for r in joins.contained_either_way(left, "name", right, "label").collect()} == {("humira pen", "humira"), ("hum", "humira"), ("i", "humira")}


def test_containment_against_brute_force(spark):
    import random

    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("ab ") for _ in range(n))
    a, b = {word(rng.randint(1, 9)) for _ in range(120)}, {word(rng.randint(1, 9)) for _ in range(120)}
    got = {tuple(r) for r in joins.contained_either_way(spark.createDataFrame([(x,) for x in a], "x string"), "x", spark.createDataFrame([(x,) for x in b], "y string"), "y").collect()}
    clean = lambda v: {x.strip(" ") for x in v} - {""}
    assert got == {(x, y) for x in clean(a) for y in clean(b) if x in y or y in x}


def test_labels_by_name_or_application(spark):
    q = spark.createDataFrame([("Treprostinil", ["NDA 1"]), ("other", ["nda2"]), ("none", None)], "query string, applications array<string>")
    rows = [(1, ["Treprostinil Sodium"], None), (2, ["Remodulin"], ["NDA1"]), (3, None, ["NDA1"]), (4, ["x"], ["NDA 2"])]
    out = joins.matched_labels(q, spark.createDataFrame(rows, "label_id int, names array<string>, applications array<string>")).collect()
    assert {tuple(r) for r in out} == {("Treprostinil", 1), ("Treprostinil", 2), ("other", 4)}


def test_repeated_keys_of_a_batch_make_versions_in_order(spark):
    rows = [("k", "b", 2), ("k", "a", 1), ("k", "a", 3), ("k", "a", 4)]
    df = spark.createDataFrame(rows, "id string, v string, o int")
    up = scd2.scd2_upsert(None, df, "id", ["v"], F.lit("2024-01-01").cast("timestamp"), ["o"])
    assert [(r.version, r.v, r.is_current) for r in up.history.orderBy("version").collect()] == [(1, "a", False), (2, "b", False), (3, "a", True)]
    assert tuple(up.stats.first()) == (1, 2, 1, 0)
    arrived = scd2.scd2_upsert(None, df.drop("o").coalesce(1), "id", ["v"], F.lit("2024-01-01").cast("timestamp"))
    assert [r.v for r in arrived.history.orderBy("version").collect()] == ["b", "a"]


def test_model_is_asked_only_where_it_can_matter(spark):
    df = spark.createDataFrame([("x" * 201, False, None), ("x" * 201, True, None), ("x", True, "exclusion"), ("Excluding y", True, None), ("Excluding y", False, None), (None, False, None)], "t string, hit boolean, c string")
    assert [r.n for r in df.select(X.needs_model(F.col("t"), F.col("hit"), F.col("c")).alias("n")).collect()] == [True, False, True, True, False, False]


@pytest.mark.parametrize("value", [None, "", " ", "x" * 100_000, "\x00�"])
def test_text_functions_on_odd_values(spark, value):
    for fn in (X.title_key, X.arm_key, X.drug_key, X.intervention_name, X.without_salts, X.biomarker_signal, X.population_mention, X.adverse_events, X.soc_category, X.regulatory_date, X.first_integer, X.needs_model):
        one(spark, value, fn)


def test_cascade_query_knows_all_countries_of_the_reference_list(spark):
    import os

    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    found = {r.inferred_population for r in entry.queries()["ref_t26_cascade"](spark, folder).where("demog_tier like 'C%'").collect()}
    assert "European (Spanish)" in found and "East Asian (Japanese)" in found
    assert len(demographics.COUNTRIES) == len({c[0] for c in demographics.COUNTRIES}) == 39


def test_merged_rows_keep_long_ids_whole(spark):
    a, b = "x" * 1500 + "a", "x" * 1500 + "b"
    rows = spark.createDataFrame([(a, ["one"]), (b, ["One", "two"]), ("c", ["three"])], "id string, names array<string>")
    assert {r.id: r.group for r in harmonize.merged_rows(rows, "id", "names").collect()} == {a: a, b: a, "c": "c"}


def test_synonym_closure_in_one_task_and_in_rounds(spark, monkeypatch):
    from cohortloom.operators import components

    pairs = [("b", "a"), ("c", "b"), ("z", "é"), ("d", "d"), (None, "a"), ("x3", "x2"), ("x2", "x1"), ("x4", "x3"), ("c", "b")]
    df = spark.createDataFrame(pairs, "a string, b string")
    one = {tuple(r) for r in components.synonym_groups(df).collect()}
    monkeypatch.setattr(components, "TASK_PAIRS", 0)
    assert one == {tuple(r) for r in components.synonym_groups(df).collect()}
    assert one == {("a", "a"), ("b", "a"), ("c", "a"), ("z", "z"), ("é", "z"), ("d", "d"), *[(f"x{i}", "x1") for i in range(1, 5)]}
    assert components.synonym_groups(df.limit(0)).count() == 0
