from pyspark.sql import functions as F

from cohortloom.operators import agencies as G


def test_facts_of_null_blank_repeated_and_keyless_records(spark):
    rows = [("k", ["b", "a", "", None]), ("k", ["a"]), ("n", None), (None, ["x"])]
    df = spark.createDataFrame(rows, "key string, v array<string>")
    out = {r.key: (r.v, r.w) for r in G.facts(df, "key", v=F.col("v"), w=F.array(F.lit("  "))).collect()}
    assert out == {"k": (["a", "b"], []), "n": ([], [])}
    assert G.facts(df.limit(0), "key", v=F.col("v")).count() == 0


def test_events_of_an_application_once_and_dated(spark):
    sub = "array<struct<submission_status_date: string, submission_type: string, submission_number: string, submission_status: string, submission_class_code: string, review_priority: string>>"
    rows = [("1", [("20230213", "ORIG", "1", "AP", "x", None), ("Feb 13, 2023", "ORIG", "1", "TA", "y", None), ("soon", "SUPPL", "2", "AP", None, None), (None, "SUPPL", "3", None, None, None)]), (None, [("20230213", "ORIG", "1", "AP", "x", None)]), ("2", None)]
    out = G.application_history(spark.createDataFrame(rows, f"application_number string, submissions {sub}")).collect()
    assert [(r.application_number, r.date, r.submission_status) for r in out] == [("1", "2023-02-13", "AP")]


def test_biologics(spark):
    names = ["BLA Number", "Proper Name", "Proprietary Name", "Applicant", "BLA Type", "Strength", "Dosage Form", "Route of Administration", "Product Presentation", "Marketing Status", "Licensure", "License Number", "Center", "Date of First Licensure", "Ref. Product Proper Name", "Ref. Product Proprietary Name", *G.EXCLUSIVITIES]
    one = {"BLA Number": "761", "Proprietary Name": "A, B ,", "BLA Type": "351(k) Biosimilar", "Ref. Product Proprietary Name": "Z", "Orphan Exclusivity Exp. Date": "2030-01-01"}
    df = spark.createDataFrame([("d", *[one.get(n) for n in names])], ", ".join(["key string", *[f"`{n}` string" for n in names]]))
    r = G.biologic_facts(df, "key").first()
    assert (r.brand_names, r.interchangeability, r.reference_product, r.strength) == (["A", "B"], ["Biosimilar (Not Interchangeable)"], ["Proprietary: Z"], [])
    assert [tuple(x) for x in G.exclusivities(df, "key").collect()] == [("d", "Orphan Exclusivity", "2030-01-01")]


def test_searches_with_nulls(spark):
    names = spark.createDataFrame([("Aspirin ",), (None,), ("",)], "query string")
    concepts = spark.createDataFrame([("1", "aspirin", None, None, None, None), ("1", "ASA", None, None, None, None), (None, "aspirin", None, None, None, None)], "rxcui string, name string, synonym string, tty string, language string, suppress string")
    assert [(r.rxcui, r.name, r.language) for r in G.concepts_of_names(names, concepts).collect()] == [("1", "ASA", "ENG")]
    relations = spark.createDataFrame([("1", "related", "BN", "Bayer"), ("1", "related", "IN", "aspirin"), ("1", "ndc", None, "00"), ("1", "related", "BN", None)], "rxcui string, kind string, tty string, value string")
    r = G.concept_details(concepts, relations).first()
    assert (r.brand_names, r.ingredients, r.synonyms, r.ndc_codes, r.atc_codes) == (["Bayer"], ["aspirin"], ["Bayer", "aspirin"], ["00"], [])
    register = spark.createDataFrame([("U", "x", ["aspirin"]), ("V", None, None)], "unii string, name string, synonyms array<string>")
    assert [tuple(r) for r in G.substances(names, register).collect()] == [("Aspirin ", "U")]
    reports = spark.createDataFrame([(["Aspirin"], None, ["nausea", "rash", ""]), (None, ["aspirin"], ["nausea"]), (None, None, ["nausea"])], "brand_name array<string>, generic_name array<string>, terms array<string>")
    assert [tuple(r) for r in G.event_counts(reports, "ASPIRIN", 1).collect()] == [("nausea", 2)]
