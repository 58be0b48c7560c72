"""Queries over agency-like records, nested from the flat tables, with SQL that computes the same from the flat tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.operators import agencies as G
from cohortloom.plans.reference import query
from cohortloom.session import table
from cohortloom.sinks import exports

_NO = "array<string>"


def _openfda(**given):
    names = ["generic_name", "brand_name", "substance_name", "unii", "rxcui", "spl_set_id", "product_ndc", "pharm_class_epc", "pharm_class_cs", "pharm_class_moa", "pharm_class_pe", "route", "manufacturer_name", "application_number", "dosage_form"]
    return F.struct(*[given.get(n, F.lit(None).cast(_NO)).alias(n) for n in names]).alias("openfda")


def _applications(s, d):
    """Orders as applications: their lines are the products and the submissions."""
    ing = F.array(F.struct(F.concat(F.lit("i"), F.col("l_partkey") % 50).alias("name"), F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.col("l_quantity").cast("int"), F.lit(" mg"))).alias("strength")))
    product = F.struct(F.concat(F.lit("b"), F.col("l_partkey") % 7).alias("brand_name"), F.col("l_linestatus").alias("route"), F.col("l_returnflag").alias("dosage_form"), F.lit("").alias("marketing_status"), F.lit(None).cast("string").alias("reference_drug"), F.lit(None).cast("string").alias("te_code"), ing.alias("active_ingredients"))
    date = F.when(F.col("l_linenumber") % 3 == 0, "soon").otherwise(F.date_format("l_shipdate", "yyyyMMdd"))
    sub = F.struct(F.col("l_linenumber").alias("pos"), date.alias("submission_status_date"), F.col("l_returnflag").alias("submission_type"), (F.col("l_linenumber") % 2).cast("string").alias("submission_number"), F.col("l_linestatus").alias("submission_status"), F.col("l_returnflag").alias("submission_class_code"), F.lit(None).cast("string").alias("review_priority"))
    lines = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(product).alias("products"), F.array_sort(F.collect_list(sub)).alias("submissions"))
    o = table(s, d, "orders").join(lines, "o_orderkey")
    return o.select("o_custkey", F.col("o_orderkey").cast("string").alias("application_number"), F.col("o_orderpriority").alias("sponsor_name"), _openfda(generic_name=F.array(F.lower("o_orderstatus"), F.lit(""))), "products", "submissions")


_LIST = lambda c, where="true": f"coalesce(string_agg(DISTINCT {c}, '|' ORDER BY {c}) FILTER ({where}), '')"


@query("ref_j17_application_facts", f"""
SELECT o_custkey, {_LIST("CAST(o_orderkey AS VARCHAR)")} AS application_numbers, {_LIST("o_orderpriority")} AS sponsor_name, {_LIST("lower(o_orderstatus)")} AS generic_names, {_LIST("'b'||(l_partkey%7)")} AS brand_names, {_LIST("l_linestatus")} AS route, {_LIST("l_returnflag")} AS dosage_form,
{_LIST("'i'||(l_partkey%50)||CASE WHEN l_linenumber%2=0 THEN ' ('||CAST(l_quantity AS INT)||' mg)' ELSE '' END")} AS active_ingredients, {_LIST("CAST(l_quantity AS INT)||' mg'", "l_linenumber%2=0")} AS strength, {_LIST("l_returnflag")} AS application_type, '' AS marketing_status
FROM orders JOIN lineitem ON l_orderkey=o_orderkey WHERE o_custkey IS NOT NULL GROUP BY 1""")
def _(s, d):
    f = G.application_facts(_applications(s, d), "o_custkey")
    cols = ["application_numbers", "sponsor_name", "generic_names", "brand_names", "route", "dosage_form", "active_ingredients", "strength", "application_type", "marketing_status"]
    return f.select("o_custkey", *[F.array_join(c, "|").alias(c) for c in cols])


@query("ref_j17_application_history", """
SELECT CAST(l_orderkey AS VARCHAR) AS application_number, strftime(l_shipdate,'%Y-%m-%d') AS date, l_returnflag AS submission_type, CAST(l_linenumber%2 AS VARCHAR) AS submission_number, arg_min(l_linestatus, l_linenumber) AS submission_status
FROM lineitem JOIN orders ON l_orderkey=o_orderkey WHERE l_linenumber%3<>0 GROUP BY 1,2,3,4""")
def _(s, d):
    return G.application_history(_applications(s, d)).select("application_number", "date", "submission_type", "submission_number", "submission_status")


def _products(s, d):
    """Parts as product listings, with two packages each."""
    p = table(s, d, "part")
    pack = lambda n: F.struct(F.concat(F.col("p_partkey"), F.lit(f"-{n}")).alias("package_ndc"), F.concat(F.col("p_size"), F.lit(f" in {n}")).alias("description"))
    return p.select(
        "p_brand", F.col("p_partkey").cast("string").alias("product_ndc"), F.when(F.col("p_partkey") % 4 == 0, "").otherwise(F.col("p_name")).alias("brand_name"), F.col("p_type").alias("generic_name"), F.lit(None).cast("string").alias("substance_name"),
        F.col("p_brand").alias("labeler_name"), F.when(F.col("p_size") % 2 == 0, "TABLET").otherwise("").alias("dosage_form"), F.lit(None).cast("string").alias("dea_schedule"), F.lit("HUMAN").alias("product_type"), F.lit("NDA").alias("marketing_category"), (F.col("p_size") > 25).alias("finished"),
        F.lit(None).cast("string").alias("listing_expiration_date"), F.array(pack(1), pack(2)).alias("packaging"), F.array(F.struct(F.col("p_type").alias("name"), F.col("p_size").cast("string").alias("strength"))).alias("active_ingredients"),
        _openfda(brand_name=F.array(F.concat(F.lit("open "), F.col("p_brand"))), dosage_form=F.array(F.lit("CAPSULE")), application_number=F.array(F.concat(F.lit("A"), F.col("p_size")))).alias("openfda"),
    )


@query("ref_j18_product_facts", f"""
SELECT p_brand, {_LIST("CAST(p_partkey AS VARCHAR)")} AS ndc_codes, (SELECT string_agg(DISTINCT x, '|' ORDER BY x) FROM (SELECT unnest([CAST(q.p_partkey AS VARCHAR)||'-1', CAST(q.p_partkey AS VARCHAR)||'-2']) AS x FROM part q WHERE q.p_brand=part.p_brand)) AS ndc_package_codes,
coalesce((SELECT string_agg(DISTINCT x, '|' ORDER BY x) FROM (SELECT unnest(['open '||q.p_brand, CASE WHEN q.p_partkey%4<>0 THEN q.p_name END]) AS x FROM part q WHERE q.p_brand=part.p_brand) WHERE x IS NOT NULL),'') AS brand_names,
{_LIST("p_type")} AS generic_names, {_LIST("CASE WHEN p_size%2=0 THEN 'TABLET' END")} AS dosage_form, {_LIST("CASE WHEN p_size>25 THEN 'true' ELSE 'false' END")} AS finished_status, {_LIST("p_type||' ('||p_size||')'")} AS active_ingredients FROM part GROUP BY p_brand""")
def _(s, d):
    f = G.product_facts(_products(s, d), "p_brand")
    return f.select("p_brand", *[F.array_join(c, "|").alias(c) for c in ("ndc_codes", "ndc_package_codes", "brand_names", "generic_names", "dosage_form", "finished_status", "active_ingredients")])


@query("ref_s08_parsed_products", "SELECT CAST(p_partkey AS VARCHAR) AS product_ndc, 'A'||p_size AS application_number, CASE WHEN p_partkey%4=0 THEN 'open '||p_brand ELSE p_name END AS brand_name, p_type AS generic_name, CASE WHEN p_size%2=0 THEN 'TABLET' ELSE 'CAPSULE' END AS dosage_form FROM part")
def _(s, d):
    return G.parsed_products(_products(s, d)).select("product_ndc", "application_number", "brand_name", "generic_name", "dosage_form")


@query("ref_s08_products_of_names", "WITH q AS (SELECT DISTINCT p_type AS query FROM part UNION SELECT p_name FROM part WHERE p_partkey%10=0), m AS (SELECT DISTINCT query, CAST(p_partkey AS VARCHAR) AS product_ndc FROM q JOIN part ON lower(p_type)=lower(query) OR lower(p_name)=lower(query)) SELECT query, product_ndc FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY product_ndc) AS n FROM m) WHERE n<=10")
def _(s, d):
    p = table(s, d, "part")
    names = p.select(F.col("p_type").alias("query")).unionByName(p.where("p_partkey % 10 = 0").select(F.col("p_name").alias("query"))).distinct()
    return G.products_of_names(names, p.select(F.col("p_partkey").cast("string").alias("product_ndc"), F.col("p_name").alias("brand_name"), F.col("p_type").alias("generic_name")))


@query("ref_s11_product_by_code", "SELECT CAST(p_partkey AS VARCHAR) AS product_ndc, p_type AS generic_name FROM part WHERE p_partkey=17")
def _(s, d):
    return G.parsed_products(_products(s, d).where("product_ndc = '17'")).select("product_ndc", "generic_name")


def _biologics(s, d):
    """Suppliers as biologics."""
    t = table(s, d, "supplier")
    k = F.col("s_suppkey")
    text = lambda c: F.coalesce(c, F.lit(""))
    named = {
        "BLA Number": k.cast("string"), "Proper Name": F.lower("s_name"), "Proprietary Name": F.concat(F.lit("One"), k % 3, F.lit(" , Two"), k % 2, F.lit(",")), "Applicant": F.col("s_name"), "BLA Type": F.when(k % 3 == 0, "351(k) Interchangeable").when(k % 3 == 1, "351(k) Biosimilar").otherwise("351(a)"),
        "First Interchangeable Exclusivity Exp. Date": text(F.when(k % 5 == 0, "2030-01-01")), "Exclusivity Expiration Date": text(F.when(k % 2 == 0, "2029-01-01")), "Ref. Product Exclusivity Exp. Date": F.lit(None).cast("string"), "Orphan Exclusivity Exp. Date": text(F.when(k % 7 == 0, "2031-01-01")),
        "Ref. Product Proper Name": text(F.when(k % 4 == 0, "proper")), "Ref. Product Proprietary Name": text(F.when(k % 8 == 0, "Brand")),
    }
    rest = ["Strength", "Dosage Form", "Route of Administration", "Product Presentation", "Marketing Status", "Licensure", "License Number", "Center", "Date of First Licensure"]
    return t.select("s_nationkey", *[c.alias(n) for n, c in named.items()], *[F.lit("").alias(n) for n in rest])


@query("ref_j20_biologic_facts", f"""
WITH b AS (SELECT s_nationkey, s_suppkey AS k, s_name FROM supplier WHERE s_nationkey IS NOT NULL), n AS (SELECT s_nationkey, unnest(['One'||(k%3), 'Two'||(k%2)]) AS x FROM b), i AS (SELECT s_nationkey, unnest([CASE WHEN k%3=0 THEN 'Interchangeable' WHEN k%3=1 THEN 'Biosimilar (Not Interchangeable)' END, CASE WHEN k%5=0 THEN 'First Interchangeable' END]) AS x FROM b)
SELECT s_nationkey, {_LIST("CAST(k AS VARCHAR)")} AS bla_numbers, (SELECT string_agg(DISTINCT x,'|' ORDER BY x) FROM n WHERE n.s_nationkey=b.s_nationkey) AS brand_names, coalesce((SELECT string_agg(DISTINCT x,'|' ORDER BY x) FROM i WHERE i.s_nationkey=b.s_nationkey AND x IS NOT NULL),'') AS interchangeability,
{_LIST("CASE WHEN k%8=0 THEN 'Proper: proper, Proprietary: Brand' WHEN k%4=0 THEN 'Proper: proper' END")} AS reference_product, '' AS strength FROM b GROUP BY s_nationkey""")
def _(s, d):
    f = G.biologic_facts(_biologics(s, d), "s_nationkey")
    return f.select("s_nationkey", *[F.array_join(c, "|").alias(c) for c in ("bla_numbers", "brand_names", "interchangeability", "reference_product", "strength")])


@query("ref_j20_exclusivities", """
SELECT CAST(s_suppkey AS VARCHAR) AS bla, 'General Exclusivity' AS type, '2029-01-01' AS expiration_date FROM supplier WHERE s_suppkey%2=0 UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'First Interchangeable Exclusivity', '2030-01-01' FROM supplier WHERE s_suppkey%5=0 UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'Orphan Exclusivity', '2031-01-01' FROM supplier WHERE s_suppkey%7=0""")
def _(s, d):
    return G.exclusivities(_biologics(s, d).withColumnRenamed("BLA Number", "bla"), "bla")


def _concepts(s, d):
    r = table(s, d, "drug_reference")
    return r.select("rxcui", F.col("canonical_name").alias("name"), F.get(F.from_json("aliases", _NO), 0).alias("synonym"), F.lit("IN").alias("tty"), F.lit(None).cast("string").alias("language"), F.lit("N").alias("suppress"))


@query("ref_s06_concepts_of_names", "SELECT DISTINCT query_name AS query, rxcui, canonical_name AS name, coalesce(CAST(aliases AS VARCHAR[])[1],'') AS synonym, 'IN' AS tty, 'ENG' AS language, 'N' AS suppress FROM harmonized_drug_queries JOIN drug_reference ON lower(trim(query_name,' '))=lower(trim(canonical_name,' ')) WHERE rxcui IS NOT NULL AND trim(query_name,' ')<>''")
def _(s, d):
    return G.concepts_of_names(table(s, d, "harmonized_drug_queries").select(F.col("query_name").alias("query")), _concepts(s, d))


@query("ref_s07_concept_details", """
SELECT rxcui, canonical_name AS name, coalesce(array_to_string(list_sort(list_distinct(list_filter(CAST(aliases AS VARCHAR[]), lambda x: trim(x)<>''))),'|'),'') AS brand_names, canonical_name AS ingredients,
array_to_string(list_sort(list_distinct(list_append(list_filter(CAST(aliases AS VARCHAR[]), lambda x: trim(x)<>''), canonical_name))),'|') AS synonyms, 'L01'||rxcui AS atc_codes, '' AS ndc_codes FROM drug_reference WHERE rxcui IS NOT NULL""")
def _(s, d):
    r = table(s, d, "drug_reference").where("rxcui is not null")
    row = lambda kind, tty, value: (F.lit(kind).alias("kind"), F.lit(tty).cast("string").alias("tty"), value.alias("value"))
    rel = r.select("rxcui", *row("related", "BN", F.explode(F.from_json("aliases", _NO)))).unionByName(r.select("rxcui", *row("related", "IN", F.col("canonical_name")))).unionByName(r.select("rxcui", *row("ATC", None, F.concat(F.lit("L01"), F.col("rxcui")))))
    out = G.concept_details(_concepts(s, d), rel)
    return out.select("rxcui", "name", *[F.array_join(c, "|").alias(c) for c in ("brand_names", "ingredients", "synonyms", "atc_codes", "ndc_codes")])


@query("ref_s10_event_counts", "SELECT l_shipmode AS term, count(*) AS n FROM (SELECT CASE WHEN l_linenumber%2=0 THEN l_returnflag||l_linestatus ELSE l_linestatus END AS l_shipmode FROM lineitem WHERE l_suppkey%10 IN (3)) GROUP BY 1 ORDER BY n DESC, term LIMIT 3")
def _(s, d):
    l = table(s, d, "lineitem")
    r = l.select(F.array(F.concat(F.lit("Drug"), F.col("l_suppkey") % 10)).alias("brand_name"), F.lit(None).cast(_NO).alias("generic_name"), F.array(F.when(F.col("l_linenumber") % 2 == 0, F.concat("l_returnflag", "l_linestatus")).otherwise(F.col("l_linestatus")), F.lit("")).alias("terms"))
    return G.event_counts(r, "DRUG3", 3)


@query("ref_s12_substances", "SELECT DISTINCT query_name AS query, canonical_name AS unii FROM harmonized_drug_queries JOIN (SELECT canonical_name, lower(trim(unnest(list_append(CAST(aliases AS VARCHAR[]), canonical_name)),' ')) AS k FROM drug_reference) ON lower(trim(query_name,' '))=k WHERE k<>''")
def _(s, d):
    r = table(s, d, "drug_reference").select(F.col("canonical_name").alias("unii"), F.col("canonical_name").alias("name"), F.from_json("aliases", _NO).alias("synonyms"))
    return G.substances(table(s, d, "harmonized_drug_queries").select(F.col("query_name").alias("query")), r)


def _labels(s, d):
    t = table(s, d, "clinical_trials")
    return t.select(F.col("row_id").alias("label_id"), F.array("nct_id").alias("names"), "intervention_names").withColumnRenamed("intervention_names", "terms")


@query("ref_s13_terms_with", "SELECT term, count(*) AS n FROM (SELECT DISTINCT row_id, unnest(intervention_names) AS term FROM clinical_trials) WHERE contains(lower(term),'mab') GROUP BY 1")
def _(s, d):
    return G.terms_with(_labels(s, d), "MAB")


@query("ref_s14_terms_of_drug", "SELECT DISTINCT term FROM (SELECT nct_id, unnest(intervention_names) AS term FROM clinical_trials) WHERE lower(nct_id)=(SELECT lower(min(nct_id)) FROM clinical_trials) AND term<>''")
def _(s, d):
    first = table(s, d, "clinical_trials").agg(F.min("nct_id")).first()[0] or ""
    return G.terms_of_drug(_labels(s, d), first)


# ---------------------------------------------------------------- exports


@query("ref_w09_stored_trials", """SELECT trial_id, source, title, condition, status, phase, study_type, sponsor, start_date, completion_date, enrollment, url, coalesce(array_to_string(countries,'; '),'') AS countries, coalesce(array_to_string(interventions,'; '),'') AS interventions,
CAST(0 AS INT) AS adverse_event_count, '' AS meddra_codes, data_collection_date FROM enriched_trials WHERE source='us_registry'""")
def _(s, d):
    return exports.stored_trials(table(s, d, "enriched_trials"), source="us_registry")


@query("ref_w08_raw_records", "SELECT nct_id AS trial_id, raw_study AS raw FROM clinical_trials WHERE raw_study IS NOT NULL")
def _(s, d):
    return exports.raw_records(table(s, d, "clinical_trials").select(F.col("nct_id").alias("trial_id"), "raw_study", F.lit("us_registry").alias("source")), "raw_study", "us_registry")


@query("ref_w07_harmonized_documents", """
WITH i AS (SELECT nct_id, intervention_name AS n, min(ord) AS o FROM trial_interventions WHERE nct_id IS NOT NULL AND intervention_name IS NOT NULL GROUP BY 1,2)
SELECT nct_id AS trial_id, '{"trial_title":'||to_json('T'||nct_id)::VARCHAR||',"source":"us_registry","drugs":{'||string_agg(to_json(n)::VARCHAR||':{"ndc_codes":["1","2","3","4","5"]}', ',' ORDER BY n)||'}}' AS document FROM i GROUP BY 1""")
def _(s, d):
    codes = F.array(*[F.lit(str(i)) for i in range(1, 8)])
    i = table(s, d, "trial_interventions").select(F.col("nct_id").alias("trial_id"), F.concat(F.lit("T"), "nct_id").alias("title"), F.lit("us_registry").alias("source"), F.col("intervention_name").alias("drug_name"), codes.alias("ndc_codes"))
    return exports.harmonized_documents(i)


@query("ref_w13_harmonized_rows", "SELECT query_name, '' AS harmonized_drug_name, array_to_string(list_filter(sources_used, lambda x: x<>''),'; ') AS sources_used, CAST(CAST(confidence_score AS DECIMAL(10,2)) AS VARCHAR) AS confidence_score FROM (SELECT coalesce(query_name,'') AS query_name, coalesce(sources_used,CAST([] AS VARCHAR[])) AS sources_used, coalesce(confidence_score,0) AS confidence_score FROM harmonized_drug_queries)")
def _(s, d):
    t = table(s, d, "harmonized_drug_queries").select("query_name", "sources_used", F.coalesce("confidence_score", F.lit(0.0)).cast("decimal(10,2)").alias("confidence_score"))
    return exports.harmonized_rows(t).select("query_name", "harmonized_drug_name", "sources_used", "confidence_score")


@query("ref_w14_converted", "SELECT canonical_name AS query_name, array_to_string(CAST(aliases AS VARCHAR[]),' | ') AS aliases, source FROM drug_reference")
def _(s, d):
    return exports.converted(table(s, d, "drug_reference").select("source", F.from_json("aliases", _NO).alias("aliases"), F.col("canonical_name").alias("query_name")))


@query("ref_s26_migrated", "SELECT canonical_name, CASE WHEN trim(aliases) LIKE '[%' THEN array_to_string(CAST(aliases AS VARCHAR[]),'|') ELSE '' END AS aliases, '' AS source FROM drug_reference")
def _(s, d):
    out = exports.migrated(table(s, d, "drug_reference").select("canonical_name", "aliases", "source"), ("aliases", "source"))
    return out.select("canonical_name", F.array_join("aliases", "|").alias("aliases"), F.array_join("source", "|").alias("source"))
