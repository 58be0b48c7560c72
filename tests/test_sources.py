import json
import os

import pytest
from pyspark.sql import functions as F

from cohortloom.operators.scd2 import current_versions
from cohortloom.sinks.writers import TableStore, flat_columns, summary_file, write_csv, write_json, write_tables
from cohortloom.sources import files, httpjson
from cohortloom.sources.pages import drug_names, page_drugs
from cohortloom.streaming.incremental import upsert_stream, windowed_counts


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_pages_and_first_of_each_study(spark, tmp_path):
    study = lambda n, t: {"protocolSection": {"identificationModule": {"nctId": n, "briefTitle": t}}}
    write(tmp_path / "a/page_000.json", json.dumps({"studies": [study("N1", "first"), study(None, "x")]}))
    write(tmp_path / "a/b/page_001.json", json.dumps({"studies": [study("N1", "second"), study("N2", "y")]}))
    write(tmp_path / "a/other.json", json.dumps({"studies": [study("N9", "z")]}))
    s = files.cached_pages(spark, str(tmp_path / "a"), "studies array<struct<protocolSection: struct<identificationModule: struct<nctId: string, briefTitle: string>>>>")
    assert s.count() == 4
    got = {r.nct_id: r.study.protocolSection.identificationModule.briefTitle for r in files.first_of_each_study(s).collect()}
    assert set(got) == {"N1", "N2"}


def test_delimited_files(spark, tmp_path):
    orange = write(tmp_path / "products.txt", 'Ingredient~Trade_Name~Appl_No\n A ~"B" x~001\nC\n\n')
    assert [tuple(r) for r in files.tilde_table(spark, orange, ["Ingredient", "Trade_Name", "Appl_No"]).collect()] == [("A", '"B" x', "001"), ("C", "", "")]
    purple = write(tmp_path / "purple.csv", 'one\n\ntwo, "more\nwords"\nthree\nBLA Number,Proper Name\n 1 ,"x,\ny"\n\n2, z\n')
    assert sorted(tuple(r) for r in files.csv_after_preamble(spark, purple, ["BLA Number", "Proper Name"]).collect()) == [("1", "x,\ny"), ("2", "z")]
    rrf = write(tmp_path / "RXNCONSO.RRF", "|".join(["11"] + ["x"] * 13 + ["Name", ""]) + "\n1|2|3\n")
    assert [tuple(r) for r in files.concept_names(spark, rrf).collect()] == [("11", "Name")]
    names = write(tmp_path / "drugs.txt", " a \n\nb\n")
    assert [r.name for r in files.name_list(spark, names).collect()] == ["a", "b"]
    c = write(tmp_path / "c.csv", "country_iso3,country_name,dominant_ancestry,homogeneity_score,continent,region,in_diverse_exclusion_list\nJPN,Japan,x,0.9,Asia,East,no\nUSA,US,x,0.1,A,N,Yes\nXXX,X,x,0.1,A,N,\n")
    assert [r.in_diverse_exclusion_list for r in files.country_reference(spark, c).collect()] == [False, True, False]
    k = write(tmp_path / "k.csv", "rxcui,generic_name,drug_class,biomarker_note\n0123,a,chemo,\n,b,chemo,\n")
    assert [r.rxcui for r in files.drug_classes(spark, k).collect()] == ["0123", None]
    log = write(tmp_path / "cache.jsonl", '{"nct_id": "N", "population": "old"}\n{"nct_id": "N", "population": "new"}\n\n')
    assert [tuple(r) for r in files.model_cache(spark, log, "nct_id string, population string").collect()] == [("N", "new")]
    bulk = write(tmp_path / "bulk.json", json.dumps({"results": [{"a": 1}, {"a": 2}]}))
    assert files.bulk_results(spark, bulk, "results array<struct<a: int>>").count() == 2


def test_paged_service_replay_and_resume(spark, tmp_path):
    base = tmp_path / "svc"
    write(base / "first.json", json.dumps({"studies": [{"n": 1}, {"n": 2}], "nextPageToken": "t2"}))
    write(base / "t2.json", json.dumps({"studies": [{"n": 3}], "nextPageToken": "t3"}))
    write(base / "t3.json", json.dumps({"studies": [{"n": 4}]}))
    httpjson.register(spark)
    df = spark.read.format("httpjson").option("url", f"file://{base}").option("queries", "[{}, {}]").load()
    assert df.count() == 8 and df.where(F.col("page") == 2).count() == 2
    assert spark.read.format("httpjson").option("url", f"file://{base}").option("maxPages", "1").load().count() == 2
    with pytest.raises(Exception, match="nowhere"):
        spark.read.format("httpjson").options(url="file:///nowhere", retries="1").load().count()
    folder = str(tmp_path / "cache")
    assert httpjson.cache_pages(spark, f"file://{base}", {}, folder, 2) == 2
    assert httpjson.cache_pages(spark, f"file://{base}", {}, folder) == 1
    assert httpjson.cache_pages(spark, f"file://{base}", {}, folder) == 0
    assert sorted(f for f in os.listdir(folder) if not f.startswith(".")) == ["page_000000.json", "page_000001.json", "page_002.json".replace("002", "000002")]
    assert httpjson.page_url("https://x/y", {"a": "b c"}, "t") == "https://x/y?a=b+c&pageToken=t"


def test_drug_page(spark):
    a = '<a href="/about-cancer/treatment/drugs/{0}">{1}</a>'
    html = f"""<h2 id="drugs-approved-for-non-small-cell-lung-cancer">x</h2><ul><li>{a.format("k", "Keytruda (Pembrolizumab)")}</li><li>{a.format("o", "Osi")}{a.format("o", "mertinib Mesylate")}</li><li>{a.format("o", "Osimertinib Mesylate")}</li></ul>
    <h2 id="drug-combinations-used-to-treat-non-small-cell-lung-cancer">y</h2><ul><li>{a.format("c", "CARBOPLATIN-TAXOL")}</li></ul><h2 id="other">z</h2>{a.format("n", "Not this")}"""
    want = [("keytruda", "brand"), ("pembrolizumab", "generic"), ("osimertinib", "generic"), ("carboplatin", "generic"), ("taxol", "generic")]
    assert drug_names(html) == want and drug_names(None) == []
    assert page_drugs(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")).count() == 5


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("t", ["a", "b"], {"k": 1}, 2)], "id string, names array<string>, extra map<string, int>, n int")
    flat = flat_columns(df, " | ", ("n",))
    assert flat.columns == ["n", "id", "names", "extra"] and tuple(flat.first()) == (2, "t", "a | b", '{"k":1}')
    write_csv(df, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).first().names == "a, b"
    write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first().names == ["a", "b"]
    write_tables({"x": df, "y": df}, str(tmp_path / "all"))
    assert sorted(os.listdir(tmp_path / "all")) == ["x", "y"]
    summary_file(spark.createDataFrame([("trials", 3)], "measure string, value long"), str(tmp_path / "s.json"))
    assert json.load(open(tmp_path / "s.json")) == {"trials": 3}


def test_incremental_upserts_equal_batches(spark, tmp_path):
    schema = "trial_id string, status string"
    store = TableStore(spark, str(tmp_path / "store"))
    assert store.read() is None
    args = (str(tmp_path / "in"), schema, store, str(tmp_path / "cp"), "trial_id", ["status"], lambda n: F.to_timestamp(F.lit(f"2024-01-{n + 1:02d}")))
    spark.createDataFrame([("A", "x"), ("B", "y")], schema).write.parquet(str(tmp_path / "in"))
    upsert_stream(spark, *args)
    upsert_stream(spark, *args)  # nothing new
    spark.createDataFrame([("A", "z")], schema).write.mode("append").parquet(str(tmp_path / "in"))
    upsert_stream(spark, *args)
    history = store.read()
    assert history.count() == 3 and {(r.trial_id, r.status) for r in current_versions(history).collect()} == {("A", "z"), ("B", "y")}


def test_windowed_counts(spark):
    e = spark.createDataFrame([("a", "2024-01-01 00:01:00"), ("a", "2024-01-01 00:09:00"), ("b", "2024-01-01 00:11:00")], "k string, t string").withColumn("t", F.to_timestamp("t"))
    assert sorted(r.n for r in windowed_counts(e, "t", "10 minutes", "1 hour", "k").collect()) == [1, 2]


def test_report_beyond_its_bound_is_refused(spark, tmp_path):
    from cohortloom.operators.runs import text_report

    many = spark.range(10_001).selectExpr("concat('m', id) as measure", "id as value")
    with pytest.raises(ValueError):
        summary_file(many, str(tmp_path / "s.json"))
    with pytest.raises(ValueError):
        text_report(many.limit(1001), "Report")
    assert not (tmp_path / "s.json").exists() and len(text_report(many.limit(1000), "Report").split("\n")) == 1002


def test_a_failed_page_fails_the_scan_and_waits_as_asked(spark, tmp_path, monkeypatch):
    import email.message
    import urllib.error

    httpjson.register(spark)
    write(tmp_path / "first.json", json.dumps({"studies": [1], "nextPageToken": "gone"}))
    scan = spark.read.format("httpjson").options(url=f"file://{tmp_path}", retries="1").load()
    with pytest.raises(Exception, match="FetchFailed|gone"):
        scan.collect()
    waits, answers = [], []

    def answer(request, timeout):
        headers = email.message.Message()
        headers["Retry-After"] = "7"
        answers.append(request.data)
        raise urllib.error.HTTPError(request.full_url, 429 if len(answers) < 3 else 404, "no", headers, None)

    monkeypatch.setattr(httpjson.urllib.request, "urlopen", answer)
    with pytest.raises(httpjson.FetchFailed):
        httpjson.fetch("https://x/y", 5, body={"a": 1}, sleep=waits.append)
    assert waits == [7.0, 7.0] and answers == [b'{"a": 1}'] * 3


def test_post_search_with_details(spark, tmp_path):
    search, retrieve = tmp_path / "search", tmp_path / "retrieve"
    search.mkdir(), retrieve.mkdir()
    write(search / "1.json", json.dumps({"data": [{"ctNumber": "2020-1"}, {"x": 1}], "pagination": {"nextPage": True}}))
    write(search / "2.json", json.dumps({"data": [{"ctNumber": "2020-2"}, {"ctNumber": "2020-1"}, {"ctNumber": "2020-3"}], "pagination": {"nextPage": False}}))
    write(search / "3.json", json.dumps({"data": [{"ctNumber": "2020-4"}], "pagination": {"nextPage": False}}))
    for n in ("2020-1", "2020-2", "2020-4"):
        write(retrieve / f"{n}.json", json.dumps({"ctNumber": n}))
    got = httpjson.eu_trials(spark, f"file://{search}", f"file://{retrieve}", {"medicalCondition": "x"}, retries=1).collect()
    assert sorted(r.number for r in got) == ["2020-1", "2020-2"] and all(r.number in r.raw_trial for r in got)
    assert httpjson.eu_trials(spark, f"file://{search}", f"file://{retrieve}", {}, max_pages=1, retries=1).count() == 1
    write(retrieve / "first.json", json.dumps({"nctId": "N1"}))
    assert json.loads(httpjson.one_study(spark, f"file://{retrieve}", 1).first().item) == {"nctId": "N1"}


def test_pages_are_in_the_order_of_their_numbers(spark, tmp_path):
    for n in (9, 10, 1000):
        write(tmp_path / f"page_{n}.json", json.dumps({"studies": [{"n": n}], "nextPageToken": None if n == 1000 else "t"}))
    pages = files.cached_pages(spark, str(tmp_path), "studies array<struct<n: int>>")
    assert [r.study.n for r in pages.orderBy("page", "pos").collect()] == [9, 10, 1000]
    assert httpjson.cache_pages(spark, f"file://{tmp_path}", {}, str(tmp_path)) == 0


def test_store_and_migration(spark):
    from cohortloom.sinks import exports

    exports.create_store(spark, "loomtest", "trial_id STRING, status STRING")
    exports.create_store(spark, "loomtest", "trial_id STRING, status STRING")
    try:
        spark.sql("INSERT INTO loomtest.trials_scd2 VALUES ('a', 'x', timestamp'2020-01-01', null, 1, 'h', 'INSERT', null, true), ('a', 'y', timestamp'2019-01-01', timestamp'2020-01-01', 1, 'h', 'INSERT', null, false)")
        assert [r.status for r in spark.table("loomtest.trials_current").collect()] == ["x"]
        assert {(r.name, r.is_view) for r in exports.tables_of(spark, "loomtest").collect()} == {("trials_scd2", False), ("pipeline_runs", False), ("trial_change_log", False), ("trials_current", True)}
    finally:
        spark.sql("DROP DATABASE loomtest CASCADE")
    old = spark.createDataFrame([('["a", null]', "broken"), (None, '{"k": 1}'), ("[1, 2", "")], "countries string, interventions string")
    assert [(r.countries, r.interventions) for r in exports.migrated(old).collect()] == [(["a", None], []), ([], []), ([], [])]


def test_exports_with_nulls(spark):
    from cohortloom.sinks import exports

    drugs = spark.createDataFrame([("q", ["a", None, ""], None, 0.5), (None, None, None, None)], "query_name string, route array<string>, extra string, confidence_score double")
    rows = exports.harmonized_rows(drugs).collect()
    assert len(rows[0]) == 21 and (rows[0].route, rows[0].confidence_score, rows[1].query_name, rows[1].ndc_codes) == ("a", "0.5", "", "")
    odd = spark.createDataFrame([([1, None], {"x": 1}, "q")], "b array<int>, a map<string, int>, query_name string")
    assert exports.converted(odd).columns == ["query_name", "a", "b"] and tuple(exports.converted(odd).first()) == ("q", '{"x":1}', "1")
    groups = spark.createDataFrame([("c", ["a", "b"], None, 2)], "canonical_name string, synonyms array<string>, nct_ids array<string>, synonym_count int")
    assert tuple(exports.name_group_rows(groups).first()) == ("c", "a | b", "", 2)
