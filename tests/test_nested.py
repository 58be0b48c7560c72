import datetime as dt
import json

from pyspark.sql import functions as F

from cohortloom.operators.nested import US_STUDY, flatten_elements, read_record, record_elements

US = "row_id long, nct_id string, raw_study string, fetched_at timestamp_ntz, RAW string"
EU = "row_id long, eudract_number string, raw_trial string, fetched_at timestamp_ntz"
DAY = [dt.datetime(2020, 1, i) for i in range(1, 9)]


def run(spark, us=(), eu=()):
    return sorted(tuple(r) for r in record_elements(spark.createDataFrame(list(us), US), spark.createDataFrame(list(eu), EU)).collect())


def study(**arms):
    return {"protocolSection": {"armsInterventionsModule": arms}}


def test_paths_parents_and_bare_values(spark):
    rec = study(armGroups=[{"label": "A", "interventionNames": ["x", None, "y"]}, {"label": None, "interventionNames": "z"}, {}], interventions={"name": "one", "otherNames": []})
    got = run(spark, [(1, "N1", json.dumps(rec), DAY[0], "")])
    assert got == [
        ("N1", "armGroups[0]", "", "A"), ("N1", "armGroups[0].interventionNames[0]", "armGroups[0]", "x"), ("N1", "armGroups[0].interventionNames[1]", "armGroups[0]", ""),
        ("N1", "armGroups[0].interventionNames[2]", "armGroups[0]", "y"), ("N1", "armGroups[1]", "", ""), ("N1", "armGroups[1].interventionNames[0]", "armGroups[1]", "z"),
        ("N1", "armGroups[2]", "", ""), ("N1", "interventions[0]", "", "one"),
    ]


def test_deep_levels_and_numbers_as_written(spark):
    rec = {"resultsSection": {"baselineCharacteristicsModule": {"measures": {"title": "M", "classes": {"categories": [{"title": 1.50, "measurements": [{"groupId": "B1"}, {"groupId": 7}]}]}}}}}
    text = json.dumps(rec).replace("1.5", "1.50")
    paths = {r[1]: r[3] for r in run(spark, [(1, "N", text, DAY[0], "")])}
    assert paths["measures[0].classes[0].categories[0]"] == "1.50"
    assert paths["measures[0].classes[0].categories[0].measurements[1]"] == "7"
    assert paths["measures[0].classes[0]"] == ""


def test_wrappers_and_text_modules_give_the_same_rows(spark):
    rec = study(armGroups=[{"label": "A", "interventionNames": ["x"]}])
    inner = {"protocolSection": {"armsInterventionsModule": json.dumps(rec["protocolSection"]["armsInterventionsModule"])}}
    forms = [json.dumps(rec), json.dumps(rec, indent=1), json.dumps(json.dumps(rec)), json.dumps({"totalCount": 1, "studies": [rec]}), json.dumps(inner)]
    got = run(spark, [(i, f"N{i}", t, DAY[0], "") for i, t in enumerate(forms)])
    assert len(got) == 2 * len(forms) and len({r[1:] for r in got}) == 2


def test_a_wrapper_of_several_studies_and_many_layers_of_text(spark):
    def one(nct, label):
        return {"protocolSection": {"identificationModule": {"nctId": nct}, "armsInterventionsModule": {"armGroups": [{"label": label}]}}}

    text = json.dumps({"studies": [one("N1", "a"), json.dumps(one("N2", "b"))]})
    layers = json.dumps(one("N4", "d"))
    for _ in range(6):
        layers = json.dumps(layers)
    got = run(spark, [(1, "N1", text, DAY[0], ""), (2, "N2", text, DAY[0], ""), (3, "N3", text, DAY[0], ""), (4, "N4", layers, DAY[0], "")])
    assert [(r[0], r[3]) for r in got] == [("N1", "a"), ("N2", "b"), ("N3", "a"), ("N4", "d")]


def test_newest_readable_record_holds(spark):
    one, two = json.dumps(study(armGroups=[{"label": "old"}])), json.dumps(study(armGroups=[{"label": "new"}]))
    us = [(1, "N", one, DAY[0], ""), (2, "N", two, DAY[1], ""), (3, "N", two[:-9], DAY[2], ""), (4, "N", None, DAY[3], ""), (5, "N", "", DAY[3], ""), (6, None, one, DAY[0], ""), (7, "", one, DAY[0], ""), (8, "M", "{broken", DAY[0], "")]
    assert run(spark, us) == [("N", "armGroups[0]", "", "new")]
    tie = [(1, "N", one, DAY[0], ""), (2, "N", two, DAY[0], "")]
    assert run(spark, tie) == [("N", "armGroups[0]", "", "new")]


def test_eu_names_from_whichever_field(spark):
    rec = {"data": {"application": {"partI": {"sponsors": [{"organisation": {"organisationFullName": None, "organisationName": "B"}}, {"organization": {"name": "C"}}], "products": {"productName": "P", "activeSubstances": {"substanceName": "S"}}, "rowCountriesInfo": [{"name": "Spain", "sites": {"siteName": "X"}}]}}}}
    got = {r[1]: r[3] for r in run(spark, eu=[(1, "E", json.dumps(rec), DAY[0])])}
    assert got == {"sponsors[0]": "B", "sponsors[1]": "C", "products[0]": "P", "products[0].activeSubstances[0]": "S", "rowCountriesInfo[0]": "Spain", "rowCountriesInfo[0].sites[0]": "X"}


def test_empty_tables_and_odd_records(spark):
    assert run(spark) == []
    assert run(spark, [(1, "N", t, DAY[0], "") for t in ("[]", "7", "null", '"text"', '{"error": "timeout"')]) == []
    assert read_record("[" * 100_000) is None


def test_very_long_arrays(spark):
    rec = study(armGroups=[{"label": str(i), "interventionNames": ["a", "b"]} for i in range(20_000)])
    df = spark.createDataFrame([("N", json.dumps(rec))], "k string, t string")
    out = flatten_elements(df, "k", "t", US_STUDY)
    assert out.count() == 60_000
    assert out.where(F.col("node_path") == "armGroups[19999].interventionNames[1]").first().parent_path == "armGroups[19999]"
