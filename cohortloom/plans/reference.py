"""Queries of the trial and drug pipelines' own operators, over the tables of a data folder, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions import text as X
from cohortloom.functions.sections import section_under
from cohortloom.functions.udfs import batched_entities, compatible_lower, population_model, with_model_cache
from cohortloom.operators import aggregates as A
from cohortloom.operators import arms, components, dedup, demographics, eu_studies, harmonize, joins, runs, scd2, studies
from cohortloom.plans import records_sql
from cohortloom.plans import sql_literals as L
from cohortloom.session import materialize, table
from cohortloom.sinks.writers import flat_columns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


def NOW(text: str = "2024-01-31 00:00:00"):
    return F.to_timestamp(F.lit(text))


# ---------------------------------------------------------------- aggregations


def _ae(s, d):
    return table(s, d, "lineitem").select(
        F.col("l_suppkey").alias("nct_id"), F.col("l_linestatus").alias("arm_label"), F.when(F.col("l_returnflag") == "R", "SERIOUS").otherwise("OTHER").alias("ae_category"),
        F.col("l_partkey").alias("meddra_term"), F.col("l_quantity").alias("affected_count"), F.col("l_extendedprice").alias("at_risk_count"),
    )


@query("ref_a01_ae_arm_summary", """
SELECT l_suppkey AS nct_id, l_linestatus AS arm_label,
  coalesce(sum(CASE WHEN l_returnflag='R' THEN l_quantity END),0) AS total_serious_affected, coalesce(sum(CASE WHEN l_returnflag<>'R' THEN l_quantity END),0) AS total_other_affected,
  max(l_extendedprice) AS total_at_risk, count(DISTINCT CASE WHEN l_returnflag='R' THEN l_partkey END) AS distinct_serious_terms, count(DISTINCT CASE WHEN l_returnflag<>'R' THEN l_partkey END) AS distinct_other_terms,
  round(coalesce(sum(CASE WHEN l_returnflag='R' THEN l_quantity END),0)/max(l_extendedprice),9) AS serious_ae_rate, round(sum(l_quantity)/max(l_extendedprice),9) AS ae_events_per_participant
FROM lineitem WHERE l_suppkey IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY 1,2""")
def _(s, d):
    out = A.ae_arm_summary(_ae(s, d))
    return out.withColumns({c: F.round(c, 9) for c in ("serious_ae_rate", "ae_events_per_participant")})


@query("ref_a02_any_per_key", "SELECT l_orderkey, bool_or(l_returnflag='R') AS any_returned FROM lineitem GROUP BY 1")
def _(s, d):
    return A.any_true(table(s, d, "lineitem"), ["l_orderkey"], F.col("l_returnflag") == "R", "any_returned")


@query("ref_a03_regimen_key", """
SELECT nct_id, string_agg(k,'|' ORDER BY k) AS regimen_key, (SELECT string_agg(n,'|' ORDER BY n) FROM (SELECT DISTINCT lower(coalesce(i2.intervention_name,'')) AS n FROM trial_interventions i2 WHERE i2.nct_id = t.nct_id)) AS regimen_display
FROM (SELECT i.nct_id, CASE WHEN coalesce(r.rxcui,'')<>'' THEN r.rxcui ELSE 'unknown:'||lower(coalesce(i.intervention_name,'')) END AS k FROM trial_interventions i LEFT JOIN drug_reference r ON lower(i.intervention_name)=r.canonical_name) t GROUP BY nct_id""")
def _(s, d):
    dim = table(s, d, "drug_reference").select(F.col("canonical_name").alias("_c"), "rxcui")
    items = table(s, d, "trial_interventions")
    return A.regimens(items.join(joins.small(dim), F.lower("intervention_name") == F.col("_c"), "left"), ["nct_id"], "intervention_name", "rxcui")


@query("ref_a04_drug_lists", """
SELECT l_orderkey, coalesce((string_agg(DISTINCT l_linestatus,'|' ORDER BY l_linestatus) FILTER (l_returnflag='R')),'') AS returned, coalesce((string_agg(DISTINCT l_linestatus,'|' ORDER BY l_linestatus) FILTER (l_quantity>25)),'') AS large FROM lineitem GROUP BY 1""")
def _(s, d):
    return A.listed(table(s, d, "lineitem"), ["l_orderkey"], "l_linestatus", returned=F.col("l_returnflag") == "R", large=F.col("l_quantity") > 25)


def _segments(s, d):
    c = table(s, d, "customer").join(joins.small(table(s, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.groupBy("c_mktsegment", "n_name", "n_nationkey").agg(F.count(F.lit(1)).cast("double").alias("v"))


@query("ref_a05_leading_share", """
WITH v AS (SELECT c_mktsegment, n_name, n_nationkey, CAST(count(*) AS DOUBLE) AS v FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1,2,3)
SELECT c_mktsegment, sum(v) AS total, arg_max(n_name, v*1000 - n_nationkey) AS n_name, round(max(v)/sum(v),9) AS share FROM v GROUP BY 1""")
def _(s, d):
    return A.leading_share(_segments(s, d), ["c_mktsegment"], "n_name", "v", "n_nationkey").withColumn("share", F.round("share", 9))


@query("ref_a06_pooled_share", """
WITH v AS (SELECT n_regionkey, c_mktsegment, CAST(count(*) AS DOUBLE) AS v FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1,2),
r AS (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY v DESC, c_mktsegment) AS rn, sum(v) OVER (PARTITION BY n_regionkey) AS total FROM v)
SELECT n_regionkey, total, c_mktsegment, round(v/total,9) AS share FROM r WHERE rn=1""")
def _(s, d):
    c = table(s, d, "customer").join(joins.small(table(s, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    per_arm = c.groupBy("n_regionkey", "c_mktsegment", "n_name").agg(F.count(F.lit(1)).cast("double").alias("v"))
    return A.pooled_share(per_arm, "n_regionkey", "c_mktsegment", "v").withColumn("share", F.round("share", 9))


@query("ref_a07_country_share", """
WITH v AS (SELECT o_orderpriority, n_name, n_nationkey, CAST(count(*) AS DOUBLE) AS v FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey GROUP BY 1,2,3),
t AS (SELECT o_orderpriority, arg_max(n_name, v*1000 - n_nationkey) AS n_name, max(v)/sum(v) AS share FROM v GROUP BY 1)
SELECT o_orderpriority, t.n_name, r_name, round(share,9) AS share FROM t JOIN nation USING (n_name) JOIN region ON n_regionkey=r_regionkey""")
def _(s, d):
    dim = table(s, d, "nation").join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")
    o = table(s, d, "orders").join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(joins.small(table(s, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    v = o.groupBy("o_orderpriority", "n_name", "n_nationkey").agg(F.count(F.lit(1)).cast("double").alias("v"))
    return A.leading_share(v, ["o_orderpriority"], "n_name", "v", "n_nationkey").join(joins.small(dim), "n_name").select("o_orderpriority", "n_name", "r_name", F.round("share", 9).alias("share"))


@query("ref_a08_counts", """
SELECT 'phase' AS by, coalesce(nullif(phase,''),'Unknown') AS value, count(*) AS n FROM enriched_trials GROUP BY 2 UNION ALL SELECT 'status', status, count(*) FROM enriched_trials GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM enriched_trials GROUP BY 2""")
def _(s, d):
    t = table(s, d, "enriched_trials")
    parts = [A.counts_by(t, c, m).select(F.lit(c).alias("by"), "value", "n") for c, m in (("phase", "Unknown"), ("status", None), ("source", None))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("ref_a09_top_countries", """
WITH c AS (SELECT trial_id, unnest(countries) AS country FROM enriched_trials)
SELECT country, count(*) AS n FROM c WHERE country IS NOT NULL GROUP BY 1 ORDER BY n DESC, min(trial_id) LIMIT 10""")
def _(s, d):
    return dedup.top_counts(table(s, d, "enriched_trials").select("trial_id", F.explode("countries").alias("country")), "country", "trial_id", 10)


@query("ref_a10_enrollment", "SELECT CAST(coalesce(sum(enrollment),0) AS BIGINT) AS total, coalesce(round(avg(enrollment),4),0) AS average, count(enrollment) AS n FROM enriched_trials WHERE enrollment <> 0")
def _(s, d):
    return A.enrollment_summary(table(s, d, "enriched_trials"), "enrollment")


_SOC = "CASE WHEN regexp_matches(lower(k),'pulmonary|respiratory|lung|breath|cough|dyspnoea') THEN 'Respiratory, thoracic and mediastinal disorders' WHEN regexp_matches(lower(k),'nausea|diarrhoea|vomiting|abdominal|gastro') THEN 'Gastrointestinal disorders' WHEN regexp_matches(lower(k),'liver|hepatic|transaminase|bilirubin') THEN 'Hepatobiliary disorders' WHEN regexp_matches(lower(k),'rash|skin|photosensitivity|dermatitis') THEN 'Skin and subcutaneous tissue disorders' WHEN regexp_matches(lower(k),'test|laboratory|abnormal|decreased|increased') THEN 'Investigations' WHEN regexp_matches(lower(k),'fatigue|weight|appetite|fever|pain') THEN 'General disorders and administration site conditions' ELSE 'Other' END"
_KEYWORDS = ", ".join(f"('{k}')" for k in L.AE_CODES)


@query("ref_a11_event_patterns", f"""
WITH k(k) AS (VALUES {_KEYWORDS}) SELECT k AS keyword, {_SOC} AS soc, count(*) AS n FROM clinical_trials JOIN k ON contains(lower(raw_study), k) GROUP BY 1,2""")
def _(s, d):
    e = table(s, d, "clinical_trials").select(F.explode(X.adverse_events(F.col("raw_study"))).alias("e"))
    return e.groupBy(F.col("e.keyword").alias("keyword"), X.soc_category(F.col("e.keyword")).alias("soc")).agg(F.count(F.lit(1)).alias("n"))


@query("ref_a11_top_terms", f"""
WITH k(k) AS (VALUES {_KEYWORDS}), c AS (SELECT k AS keyword, count(*) AS n FROM clinical_trials JOIN k ON contains(lower(raw_study), k) GROUP BY 1) SELECT keyword, n, CAST((SELECT sum(n) FROM c) AS BIGINT) AS total FROM c ORDER BY n DESC, keyword LIMIT 10""")
def _(s, d):
    e = table(s, d, "clinical_trials").select(F.explode(X.adverse_events(F.col("raw_study"))).alias("e")).select(F.col("e.keyword").alias("keyword"))
    counts = e.groupBy("keyword").agg(F.count(F.lit(1)).alias("n"))  # at most one row for each keyword
    return dedup.top_counts(e, "keyword", "keyword", 10).join(joins.small(counts.agg(F.sum("n").alias("total"))), F.lit(True))


@query("ref_a12_count", "SELECT count(*) AS n FROM enriched_trials")
def _(s, d):
    return table(s, d, "enriched_trials").agg(F.count(F.lit(1)).alias("n"))


def _event_history(s, d):
    e = table(s, d, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    h = scd2.versions_from_events(e.withColumn("at", F.struct("ts", "event_id")), "user_id", "at", ["event_type", "value"])
    return h.select("user_id", F.col("valid_from.ts").alias("valid_from"), F.col("valid_to.ts").alias("valid_to"), "version", F.when(F.col("version") == 1, "INSERT").otherwise("UPDATE").alias("change_type"), "event_type", "value")


_EH = """WITH h AS (SELECT user_id, ts AS valid_from, lead(ts) OVER w AS valid_to, row_number() OVER w AS version, CASE WHEN row_number() OVER w = 1 THEN 'INSERT' ELSE 'UPDATE' END AS change_type, event_type, value FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""


@query("ref_a13_change_summary", _EH + " SELECT change_type, count(*) AS n FROM h WHERE valid_from >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY GROUP BY 1")
def _(s, d):
    return scd2.change_counts(_event_history(s, d), NOW(), 7)


@query("ref_a13_most_changed", _EH + " SELECT user_id, count(*) AS n FROM h WHERE valid_from >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY GROUP BY 1 HAVING count(*)>1 ORDER BY n DESC, user_id LIMIT 10")
def _(s, d):
    return scd2.most_changed(_event_history(s, d), NOW(), 7, "user_id", 10)


@query("ref_a14_run_summary", """
SELECT 'trials' AS measure, count(*) AS value FROM (SELECT DISTINCT trial_id FROM enriched_trials WHERE trial_id IS NOT NULL) UNION ALL SELECT 'arms', count(*) FROM trial_interventions UNION ALL SELECT 'arm_trials', count(DISTINCT nct_id) FROM trial_interventions
UNION ALL SELECT 'is_control', count(*) FROM trial_interventions WHERE regexp_matches(lower(intervention_name),'placebo|sham')
UNION ALL SELECT 'source='||source, count(*) FROM (SELECT trial_id, min(source) AS source FROM enriched_trials WHERE trial_id IS NOT NULL GROUP BY 1) GROUP BY 1""")
def _(s, d):
    t = table(s, d, "enriched_trials").where("trial_id is not null").groupBy("trial_id").agg(F.min("source").alias("source"))
    a = table(s, d, "trial_interventions").withColumn("is_control", X.is_placebo_name(F.col("intervention_name")))
    return A.run_summary(t, a, ["is_control"], "source")


@query("ref_a15_quality_report", """
SELECT issue, count(*) AS n FROM (SELECT 'missing title' AS issue FROM enriched_trials WHERE trim(coalesce(title,''))='' UNION ALL SELECT 'missing sponsor' FROM enriched_trials WHERE trim(coalesce(sponsor,''))='' UNION ALL SELECT 'missing start_date' FROM enriched_trials WHERE trim(coalesce(start_date,''))='') GROUP BY 1""")
def _(s, d):
    return A.quality_issues(table(s, d, "enriched_trials"), ["title", "sponsor", "start_date"], "trial_id").groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


@query("ref_a15_first_issues", """
SELECT trial_id, issue FROM (SELECT trial_id, 'missing title' AS issue FROM enriched_trials WHERE trim(coalesce(title,''))='' UNION ALL SELECT trial_id, 'missing sponsor' FROM enriched_trials WHERE trim(coalesce(sponsor,''))='' UNION ALL SELECT trial_id, 'missing start_date' FROM enriched_trials WHERE trim(coalesce(start_date,''))='') ORDER BY trial_id NULLS FIRST, issue LIMIT 50""")
def _(s, d):
    return A.quality_issues(table(s, d, "enriched_trials"), ["title", "sponsor", "start_date"], "trial_id").orderBy("trial_id", "issue").limit(50)


@query("ref_a16_mode_first_seen", """
WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS f FROM orders WHERE o_orderpriority<>'' GROUP BY 1,2)
SELECT o_custkey, o_orderpriority, n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, f) AS rn FROM c) WHERE rn=1""")
def _(s, d):
    return dedup.mode_first_seen(table(s, d, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


@query("ref_a17_harmonization_stats", """
SELECT count(*) AS n, round(avg(confidence_score),6) AS average, count(*) FILTER (confidence_score>=70) AS high, count(*) FILTER (confidence_score>=40 AND confidence_score<70) AS medium, count(*) FILTER (coalesce(confidence_score,0)<40) AS low, count(*) FILTER (len(sources_used)>1) AS several_sources FROM harmonized_drug_queries""")
def _(s, d):
    band = X.score_band(F.coalesce("confidence_score", F.lit(0.0)), 70, 40)
    return table(s, d, "harmonized_drug_queries").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence_score"), 6).alias("average"), F.count_if(band == "high").alias("high"), F.count_if(band == "medium").alias("medium"),
        F.count_if(band == "low").alias("low"), F.count_if(F.size("sources_used") > 1).alias("several_sources"),
    )


@query("ref_a17_source_coverage", "SELECT source, count(*) AS n FROM (SELECT unnest(sources_used) AS source FROM harmonized_drug_queries) GROUP BY 1")
def _(s, d):
    return table(s, d, "harmonized_drug_queries").select(F.explode("sources_used").alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("ref_a18_most_synonyms", "SELECT canonical_name, CAST(json_array_length(aliases) AS INT) AS synonym_count FROM drug_reference ORDER BY 2 DESC, 1 LIMIT 5")
def _(s, d):
    return table(s, d, "drug_reference").select("canonical_name", F.json_array_length("aliases").alias("synonym_count")).orderBy(F.desc("synonym_count"), "canonical_name").limit(5)


@query("ref_a19_name_groups", """
WITH f AS (SELECT lower(trim(nct_id)) AS k, lower(trim(intervention_name)) AS syn, arg_min(intervention_name, name_id) AS v FROM trial_interventions WHERE trim(intervention_name)<>'' AND nct_id IS NOT NULL GROUP BY 1,2),
h AS (SELECT lower(trim(nct_id)) AS k, arg_min(nct_id, name_id) AS canonical_name FROM trial_interventions WHERE nct_id IS NOT NULL GROUP BY 1)
SELECT canonical_name, string_agg(v,'|' ORDER BY syn) AS synonyms, CAST(count(*) AS INT) AS synonym_count FROM f JOIN h USING (k) GROUP BY 1""")
def _(s, d):
    n = table(s, d, "trial_interventions").where("nct_id is not null").select(F.col("nct_id").alias("name"), F.col("intervention_name").alias("synonym"), "nct_id", F.col("name_id").alias("ord"))
    return A.name_groups(n).select("canonical_name", F.array_join("synonyms", "|").alias("synonyms"), "synonym_count")


@query("ref_a20_confidence", """
SELECT canonical_name, least(20.0 + 10*(CAST(coalesce(rxcui,'')<>'' AS INT)+CAST(json_array_length(aliases)>0 AS INT)+1+CAST(json_array_length(subtypes)>0 AS INT)) + 15*(1+CAST((coalesce(rxcui,'')<>'' OR json_array_length(subtypes)>0) AS INT)), 100.0)::DOUBLE AS score FROM drug_reference""")
def _(s, d):
    has = lambda c: F.json_array_length(c) > 0
    code = F.coalesce("rxcui", F.lit("")) != ""
    score = A.source_confidence(F.array(F.lit("list"), F.lit("registry")), rxcui=code, brands=has("aliases"), generics=F.col("canonical_name").isNotNull(), codes=code, substances=has("subtypes"))
    return table(s, d, "drug_reference").select("canonical_name", score.alias("score"))


@query("ref_a20_weighted_confidence", """
SELECT canonical_name, round(least(0.2 + 0.4*((CASE WHEN coalesce(rxcui,'')<>'' THEN 10.0 ELSE 0 END + 7.0)/17.0) + 0.2*((CASE WHEN json_array_length(aliases)>0 THEN 1.0 ELSE 0 END + CASE WHEN json_array_length(subtypes)>0 THEN 1.0 ELSE 0 END)/2.0), 1.0)::DOUBLE, 2) AS score FROM drug_reference""")
def _(s, d):
    score = A.weighted_confidence(F.lit(2.0), [(F.coalesce("rxcui", F.lit("")) != "", 10), (F.col("canonical_name").isNotNull(), 7)], [F.json_array_length("aliases") > 0, F.json_array_length("subtypes") > 0])
    return table(s, d, "drug_reference").select("canonical_name", score.alias("score"))


@query("ref_a21_consolidated_names", """
WITH a AS (SELECT nct_id, list(intervention_name ORDER BY name_id) AS l FROM trial_interventions WHERE intervention_name IS NOT NULL AND nct_id IS NOT NULL GROUP BY 1), u AS (SELECT nct_id, unnest(l) AS v, generate_subscripts(l,1) AS i FROM a),
f AS (SELECT nct_id, lower(trim(v)) AS k, arg_min(v,i) AS v, min(i) AS i FROM u WHERE trim(v)<>'' GROUP BY 1,2) SELECT nct_id, string_agg(v,'|' ORDER BY i) AS names, min(v) AS primary_name FROM f GROUP BY 1""")
def _(s, d):
    from cohortloom.operators.harmonize import consolidated, primary_name

    l = table(s, d, "trial_interventions").where("intervention_name is not null and nct_id is not null").groupBy("nct_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("name_id", "intervention_name"))), lambda x: x["intervention_name"]).alias("l"))
    names = l.select("nct_id", consolidated(F.col("l")).alias("n")).where(F.size("n") > 0)
    return names.select("nct_id", F.array_join("n", "|").alias("names"), primary_name(F.col("n")).alias("primary_name"))


@query("ref_a22_distinct_codes", "SELECT l_orderkey, string_agg(DISTINCT l_returnflag,',' ORDER BY l_returnflag) AS codes FROM lineitem WHERE l_returnflag<>'' GROUP BY 1")
def _(s, d):
    return table(s, d, "lineitem").where("l_returnflag <> ''").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("codes"))


@query("ref_a23_first_date", "SELECT l_suppkey, strftime(min(l_shipdate),'%Y-%m-%d') AS first_date FROM lineitem GROUP BY 1")
def _(s, d):
    return table(s, d, "lineitem").groupBy("l_suppkey").agg(F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("first_date"))


@query("ref_a24_newest_per_key", "SELECT trial_id, title, status FROM (SELECT *, row_number() OVER (PARTITION BY trial_id ORDER BY data_collection_date DESC, processing_timestamp DESC, snapshot_id DESC) AS rn FROM trials_scd2_snapshots) WHERE rn=1")
def _(s, d):
    t = table(s, d, "trials_scd2_snapshots").select("trial_id", "title", "status", "data_collection_date", "processing_timestamp", "snapshot_id")
    return dedup.keep_last(t, ["trial_id"], ["data_collection_date", "processing_timestamp", "snapshot_id"]).select("trial_id", "title", "status")


@query("ref_a25_batch_stats", "SELECT count(*) AS n, count(*) FILTER (confidence_score>0) AS found, round(100.0*count(*) FILTER (confidence_score>0)/count(*),4) AS percent, round(avg(confidence_score),6) AS average FROM harmonized_drug_queries")
def _(s, d):
    found = F.count_if(F.col("confidence_score") > 0)
    return table(s, d, "harmonized_drug_queries").agg(F.count(F.lit(1)).alias("n"), found.alias("found"), F.round(100.0 * found / F.count(F.lit(1)), 4).alias("percent"), F.round(F.avg("confidence_score"), 6).alias("average"))


# ---------------------------------------------------------------- history


_ORDER = ["data_collection_date", "processing_timestamp", "snapshot_id"]
_TRACKED = ["status", "enrollment"]


def _upserts(s, d):
    """All observations in two batches, both with several states of a key; the second goes on where the first ended."""
    t = table(s, d, "trials_scd2_snapshots").select("trial_id", "status", "enrollment", "title", *_ORDER)
    late = F.col("data_collection_date") >= F.lit("2018-01-01").cast("timestamp_ntz")
    first = scd2.scd2_upsert(None, t.where(~F.coalesce(late, F.lit(False))), "trial_id", _TRACKED, NOW("2018-01-01 00:00:00"), _ORDER)
    return scd2.scd2_upsert(materialize(first.history, "history"), t.where(late), "trial_id", _TRACKED, NOW("2026-01-01 00:00:00"), _ORDER)


_CHANGES = """WITH r AS (SELECT *, lag(status) OVER w AS ls, lag(enrollment) OVER w AS le, row_number() OVER w AS rn FROM trials_scd2_snapshots WHERE trim(trial_id)<>''
  WINDOW w AS (PARTITION BY trial_id ORDER BY data_collection_date NULLS FIRST, processing_timestamp NULLS FIRST, snapshot_id)),
c AS (SELECT *, row_number() OVER (PARTITION BY trial_id ORDER BY rn) AS v, count(*) OVER (PARTITION BY trial_id) AS n FROM r WHERE rn=1 OR status IS DISTINCT FROM ls OR enrollment IS DISTINCT FROM le)"""


@query("ref_w03_scd2_upsert", _CHANGES + """
SELECT trial_id, status, enrollment, title, CAST(v AS INT) AS version, v=n AS is_current, CASE WHEN v=1 THEN 'INSERT' ELSE 'UPDATE' END AS change_type,
  CASE WHEN v=1 THEN '' ELSE concat_ws(',', CASE WHEN status IS DISTINCT FROM ls THEN 'status' END, CASE WHEN enrollment IS DISTINCT FROM le THEN 'enrollment' END) END AS changed FROM c""")
def _(s, d):
    return _upserts(s, d).history.select("trial_id", "status", "enrollment", "title", "version", "is_current", "change_type", F.coalesce(F.array_join("changed_columns", ","), F.lit("")).alias("changed"))


@query("ref_w03_upsert_stats", _CHANGES + """, late AS (SELECT * FROM trials_scd2_snapshots WHERE data_collection_date >= TIMESTAMP '2018-01-01'), l AS (SELECT * FROM c WHERE data_collection_date >= TIMESTAMP '2018-01-01')
SELECT (SELECT count(*) FROM l WHERE v=1) AS inserted, (SELECT count(*) FROM l WHERE v>1) AS updated, (SELECT count(*) FROM late WHERE trim(trial_id)<>'') - (SELECT count(*) FROM l) AS unchanged, (SELECT count(*) FROM late WHERE coalesce(trim(trial_id),'')='') AS errors""")
def _(s, d):
    return _upserts(s, d).stats


@query("ref_w01_replace_rows", "SELECT trial_id, status, snapshot_id FROM (SELECT *, row_number() OVER (PARTITION BY trial_id ORDER BY snapshot_id DESC) AS rn FROM trials_scd2_snapshots WHERE trial_id IS NOT NULL) WHERE rn=1")
def _(s, d):
    t = table(s, d, "trials_scd2_snapshots").where("trial_id is not null").select("trial_id", "status", "snapshot_id")
    return dedup.replace_rows(dedup.keep_first(t, ["trial_id"], ["snapshot_id"]), t, "trial_id", "snapshot_id")


@query("ref_p03_current", _EH + " SELECT user_id, event_type, CAST(version AS INT) AS version FROM h WHERE valid_to IS NULL ORDER BY user_id LIMIT 1000")
def _(s, d):
    return scd2.current_versions(_event_history(s, d).withColumn("is_current", F.col("valid_to").isNull()), 1000, "user_id").select("user_id", "event_type", "version")


@query("ref_p04_history", _EH + " SELECT user_id, CAST(version AS INT) AS version, event_type FROM h WHERE user_id=(SELECT min(user_id) FROM events)")
def _(s, d):
    first = table(s, d, "events").agg(F.min("user_id").alias("u"))
    return _event_history(s, d).join(F.broadcast(first), F.col("user_id") == F.col("u"), "left_semi").orderBy(F.desc("version")).select("user_id", "version", "event_type")


@query("ref_p05_as_of", _EH + " SELECT user_id, event_type, CAST(version AS INT) AS version FROM h WHERE valid_from <= TIMESTAMP '2024-01-15' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2024-01-15')")
def _(s, d):
    return scd2.as_of(_event_history(s, d), NOW("2024-01-15 00:00:00")).select("user_id", "event_type", "version")


@query("ref_p06_recently_changed", _EH + " SELECT user_id, CAST(version AS INT) AS version FROM h WHERE change_type='UPDATE' AND valid_from >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY")
def _(s, d):
    return scd2.recently_changed(_event_history(s, d), NOW(), 7).select("user_id", "version")


@query("ref_p07_recent_runs", "SELECT event_id, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
def _(s, d):
    return table(s, d, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(10).select("event_id", "user_id")


@query("ref_r01_as_of_join", _EH + """, f AS (SELECT o_orderkey, o_custkey AS user_id, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * (o_orderkey % 700) AS at FROM orders)
SELECT o_orderkey, f.user_id, h.event_type AS v_event_type, CAST(h.version AS INT) AS v_version FROM f JOIN h ON f.user_id=h.user_id AND h.valid_from<=f.at AND (h.valid_to IS NULL OR h.valid_to>f.at)""")
def _(s, d):
    facts = table(s, d, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), (NOW("2024-01-01 00:00:00") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 700).cast("int"))).alias("at"))
    return scd2.as_of_join(facts, _event_history(s, d), "user_id", "at").select("o_orderkey", "user_id", "v_event_type", "v_version")


# ---------------------------------------------------------------- filters, sorts, sets


@query("ref_p01_search", "SELECT trial_id, title FROM enriched_trials WHERE source='us_registry' AND phase='PHASE2' AND condition ILIKE '%lung%'")
def _(s, d):
    t = table(s, d, "enriched_trials")
    return t.where((F.col("source") == "us_registry") & (F.col("phase") == "PHASE2") & F.col("condition").ilike("%lung%")).select("trial_id", "title")


@query("ref_p02_point_lookup", "SELECT trial_id, title FROM (SELECT *, row_number() OVER (PARTITION BY trial_id ORDER BY processing_timestamp DESC, title) AS rn FROM enriched_trials WHERE trial_id='NCT90000017') WHERE rn=1")
def _(s, d):
    t = table(s, d, "enriched_trials").where(F.col("trial_id") == "NCT90000017").select("trial_id", "title", "processing_timestamp")
    return t.orderBy(F.desc("processing_timestamp"), "title").limit(1).select("trial_id", "title")


@query("ref_p08_no_controls", "SELECT name_id, intervention_name FROM trial_interventions WHERE lower(intervention_name) NOT IN ('placebo','control','')")
def _(s, d):
    return table(s, d, "trial_interventions").where(~X.is_control_word(F.col("intervention_name"))).select("name_id", "intervention_name")


@query("ref_p09_placebo", "SELECT name_id FROM trial_interventions WHERE regexp_matches(lower(trim(intervention_name)),'placebo|sham')")
def _(s, d):
    return table(s, d, "trial_interventions").where(X.is_placebo_name(F.trim("intervention_name"))).select("name_id")


@query("ref_p10_clean_alias", f"SELECT name_id FROM trial_interventions WHERE intervention_name<>'' AND length(intervention_name)<=40 AND NOT regexp_matches(lower(intervention_name), '{L.ALIAS_NOISE}')")
def _(s, d):
    return table(s, d, "trial_interventions").where(X.is_clean_alias(F.col("intervention_name"))).select("name_id")


@query("ref_p11_interventional", "SELECT row_id FROM clinical_trials WHERE upper(study_type)='INTERVENTIONAL'")
def _(s, d):
    return table(s, d, "clinical_trials").where(F.upper("study_type") == "INTERVENTIONAL").select("row_id")


@query("ref_p14_contains_either", "SELECT trial_id, title FROM enriched_trials WHERE coalesce(title ILIKE '%asthma%',false) OR coalesce(condition ILIKE '%asthma%',false)")
def _(s, d):
    has = lambda c: F.coalesce(F.col(c).ilike("%asthma%"), F.lit(False))
    return table(s, d, "enriched_trials").where(has("title") | has("condition")).select("trial_id", "title")


@query("ref_p15_null_split", "SELECT sponsor IS NULL AS missing, count(*) AS n FROM enriched_trials GROUP BY 1")
def _(s, d):
    return table(s, d, "enriched_trials").groupBy(F.col("sponsor").isNull().alias("missing")).agg(F.count(F.lit(1)).alias("n"))


@query("ref_p16_in_list", "SELECT trial_id FROM enriched_trials WHERE phase IN ('PHASE1','PHASE2')")
def _(s, d):
    return table(s, d, "enriched_trials").where(F.col("phase").isin("PHASE1", "PHASE2")).select("trial_id")


@query("ref_p18_quality_issues", "SELECT trial_id, 'missing sponsor' AS issue FROM enriched_trials WHERE trim(coalesce(sponsor,''))='' UNION ALL SELECT trial_id, 'missing start_date' FROM enriched_trials WHERE trim(coalesce(start_date,''))=''")
def _(s, d):
    return A.quality_issues(table(s, d, "enriched_trials"), ["sponsor", "start_date"], "trial_id")


@query("ref_p19_soc", f"SELECT doc_id, {_SOC.replace('lower(k)', 'lower(text)')} AS soc FROM documents")
def _(s, d):
    return table(s, d, "documents").select("doc_id", X.soc_category(F.col("text")).alias("soc"))


@query("ref_p20_bands", "SELECT query_id, CASE WHEN confidence_score>=0.8 THEN 'high' WHEN confidence_score>=0.5 THEN 'medium' ELSE 'low' END AS band FROM harmonized_drug_queries")
def _(s, d):
    return table(s, d, "harmonized_drug_queries").select("query_id", X.score_band(F.col("confidence_score"), 0.8, 0.5).alias("band"))


@query("ref_d01_merged_by_title", r"""
SELECT trial_id, title FROM (SELECT *, row_number() OVER (PARTITION BY trim(regexp_replace(lower(title),'\s+',' ','g')) ORDER BY CASE WHEN source='us_registry' THEN 0 ELSE 1 END, trial_id, processing_timestamp, title) AS rn FROM enriched_trials) WHERE rn=1""")
def _(s, d):
    t = table(s, d, "enriched_trials").select("trial_id", "source", "title", "processing_timestamp")
    return dedup.merged_by_title(t.where("source = 'us_registry'"), t.where("source <> 'us_registry'"), "title", ["trial_id", "processing_timestamp", "title"]).select("trial_id", "title")


@query("ref_d02_first_per_id", "SELECT nct_id, min(row_id) AS row_id FROM clinical_trials WHERE nct_id IS NOT NULL GROUP BY 1")
def _(s, d):
    return dedup.keep_first(table(s, d, "clinical_trials").where("nct_id is not null").select("nct_id", "row_id"), ["nct_id"], ["row_id"])


@query("ref_d04_distinct_without_case", """
WITH u AS (SELECT row_id, unnest(intervention_names) AS v, generate_subscripts(intervention_names,1) AS i FROM clinical_trials), f AS (SELECT row_id, lower(trim(v,' ')) AS k, arg_min(v,i) AS v, min(i) AS i FROM u WHERE trim(v,' ')<>'' GROUP BY 1,2)
SELECT row_id, string_agg(v,'|' ORDER BY i) AS names FROM f GROUP BY 1""")
def _(s, d):
    t = table(s, d, "clinical_trials").select("row_id", X.distinct_without_case(F.col("intervention_names")).alias("n"))
    return t.where(F.size("n") > 0).select("row_id", F.array_join("n", "|").alias("names"))


@query("ref_d05_event_dedupe", "SELECT user_id, event_type, strftime(ts,'%Y-%m-%d') AS day, min(event_id) AS event_id FROM events GROUP BY 1,2,3")
def _(s, d):
    e = table(s, d, "events").select("user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id")
    return dedup.keep_first(e, ["user_id", "event_type", "day"], ["event_id"])


@query("ref_d06_distinct_pairs", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def _(s, d):
    return table(s, d, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("ref_d08_duplicate_members", "SELECT name_id, nct_id, ord FROM trial_interventions WHERE name_id IN (SELECT name_id FROM trial_interventions GROUP BY 1 HAVING count(*)>1)")
def _(s, d):
    return dedup.duplicate_members(table(s, d, "trial_interventions"), ["name_id"]).select("name_id", "nct_id", "ord")


@query("ref_d09_synonym_closure", """
WITH RECURSIVE e AS (SELECT lower(i.intervention_name) AS a, i.nct_id AS b FROM trial_interventions i WHERE i.intervention_name IS NOT NULL AND i.nct_id IS NOT NULL), y AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS name, a AS o FROM y UNION SELECT r.name, y.b FROM r JOIN y ON r.o=y.a) SELECT name, min(o) AS root FROM r GROUP BY 1""")
def _(s, d):
    i = table(s, d, "trial_interventions").where("intervention_name is not null and nct_id is not null")
    return components.synonym_groups(i.select(F.lower("intervention_name").alias("a"), F.col("nct_id").alias("b")))


@query("ref_o01_order_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey LIMIT 100")
def _(s, d):
    return table(s, d, "orders").orderBy(F.desc_nulls_first("o_totalprice"), "o_orderkey").limit(100).select("o_orderkey", "o_totalprice")


@query("ref_o05_sorted_list", "SELECT l_orderkey, string_agg(strftime(l_shipdate,'%Y-%m-%d'),',' ORDER BY l_shipdate DESC) AS dates FROM lineitem GROUP BY 1")
def _(s, d):
    return table(s, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_list(F.date_format("l_shipdate", "yyyy-MM-dd")), asc=False), ",").alias("dates"))


@query("ref_o07_head_slice", "SELECT row_id, array_to_string(intervention_names[1:2],'|') AS head FROM clinical_trials WHERE len(list_filter(intervention_names, lambda x: x IS NULL))=0")
def _(s, d):
    t = table(s, d, "clinical_trials").where(F.size(F.filter("intervention_names", lambda x: x.isNull())) == 0)
    return t.select("row_id", F.array_join(F.slice("intervention_names", 1, 2), "|").alias("head"))


@query("ref_u01_union_branches", "SELECT c_custkey, 'rich' AS branch FROM customer WHERE c_acctbal>5000 UNION ALL SELECT c_custkey, 'auto' FROM customer WHERE c_mktsegment='AUTOMOBILE'")
def _(s, d):
    c = table(s, d, "customer")
    return c.where("c_acctbal > 5000").select("c_custkey", F.lit("rich").alias("branch")).unionByName(c.where("c_mktsegment = 'AUTOMOBILE'").select("c_custkey", F.lit("auto").alias("branch")), allowMissingColumns=True)


@query("ref_u04_set_operations", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus='F') AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus='P')")
def _(s, d):
    o = table(s, d, "orders")
    ids = lambda st: o.where(F.col("o_orderstatus") == st).select(F.col("o_custkey").alias("c_custkey"))
    return table(s, d, "customer").select("c_custkey").join(ids("F"), "c_custkey", "left_semi").join(ids("P"), "c_custkey", "left_anti")


@query("ref_u05_name_union", "SELECT lower(trim(intervention_name)) AS name FROM trial_interventions WHERE intervention_name IS NOT NULL UNION SELECT lower(trim(query_name)) FROM harmonized_drug_queries WHERE query_name IS NOT NULL")
def _(s, d):
    a = table(s, d, "trial_interventions").select(F.lower(F.trim("intervention_name")).alias("name"))
    return a.unionByName(table(s, d, "harmonized_drug_queries").select(F.lower(F.trim("query_name")).alias("name"))).where("name is not null").distinct()


# ---------------------------------------------------------------- joins


@query("ref_r02_inner_composite", "SELECT l.l_orderkey, l.l_linenumber, o.o_orderstatus FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey AND l.l_linestatus=o.o_orderstatus")
def _(s, d):
    l, o = table(s, d, "lineitem"), table(s, d, "orders")
    o = o.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("l_linestatus"), "o_orderstatus")
    return l.join(o, ["l_orderkey", "l_linestatus"]).select("l_orderkey", "l_linenumber", "o_orderstatus")


@query("ref_r05_suffixed_left", "SELECT c.row_id, c.title, e.title AS title_trial FROM clinical_trials c LEFT JOIN (SELECT trial_id, max(title) AS title FROM enriched_trials GROUP BY 1) e ON c.nct_id=e.trial_id")
def _(s, d):
    e = table(s, d, "enriched_trials").groupBy(F.col("trial_id").alias("nct_id")).agg(F.max("title").alias("title"))
    return joins.suffixed(table(s, d, "clinical_trials").select("row_id", "nct_id", "title"), e, "nct_id", "_trial").select("row_id", "title", "title_trial")


@query("ref_r07_any_event", """
SELECT a.nct_id, a.arm_label, coalesce(x.t,0)>0 AS has_any_ae FROM (SELECT DISTINCT o_custkey AS nct_id, o_orderstatus AS arm_label FROM orders) a LEFT JOIN (SELECT l_suppkey AS nct_id, l_linestatus AS arm_label, sum(l_quantity) AS t FROM lineitem GROUP BY 1,2) x ON a.nct_id=x.nct_id AND a.arm_label=x.arm_label""")
def _(s, d):
    a = table(s, d, "orders").select(F.col("o_custkey").alias("nct_id"), F.col("o_orderstatus").alias("arm_label")).distinct()
    return joins.with_any_event(a, A.ae_arm_summary(_ae(s, d)))


@query("ref_r08_left_any", "SELECT o_orderkey, coalesce(b.f,false) AS any_returned FROM orders LEFT JOIN (SELECT l_orderkey, bool_or(l_returnflag='R') AS f FROM lineitem WHERE l_quantity>40 GROUP BY 1) b ON o_orderkey=l_orderkey")
def _(s, d):
    f = A.any_true(table(s, d, "lineitem").where("l_quantity > 40"), ["l_orderkey"], F.col("l_returnflag") == "R", "any_returned")
    return table(s, d, "orders").select("o_orderkey").join(f, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce("any_returned", F.lit(False)).alias("any_returned"))


@query("ref_r11_last_wins_lookup", """
SELECT i.name_id, a.rxcui FROM trial_interventions i LEFT JOIN (SELECT k, max_by(rxcui, canonical_name) AS rxcui FROM (SELECT lower(unnest(CAST(aliases AS VARCHAR[]))) AS k, rxcui, canonical_name FROM drug_reference WHERE coalesce(rxcui,'')<>'') GROUP BY 1) a ON lower(trim(i.intervention_name))=a.k""")
def _(s, d):
    return table(s, d, "trial_interventions").withColumn("alias", F.lower(F.trim("intervention_name"))).join(joins.small(studies.alias_codes(table(s, d, "drug_reference"))), "alias", "left").select("name_id", "rxcui")


@query("ref_r12_country_lookup", "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey=n_nationkey LEFT JOIN region ON n_regionkey=r_regionkey")
def _(s, d):
    c = table(s, d, "customer").join(joins.small(table(s, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return joins.lookup(c, F.col("n_regionkey"), table(s, d, "region"), "r_regionkey", ["r_name"], "r_name").select("c_custkey", "n_name", "r_name")


@query("ref_r13_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey=c_custkey)")
def _(s, d):
    return table(s, d, "customer").join(table(s, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("ref_r14_any_key", """
WITH q AS (SELECT DISTINCT lower(trim(query_name)) AS q FROM harmonized_drug_queries WHERE query_name IS NOT NULL)
SELECT DISTINCT q.q AS query, canonical_name FROM q JOIN (SELECT canonical_name, lower(canonical_name) AS k FROM drug_reference UNION ALL SELECT canonical_name, lower(CAST(aliases AS VARCHAR[])[1]) FROM drug_reference) r ON q.q=r.k""")
def _(s, d):
    r = table(s, d, "drug_reference").withColumn("brand", F.get(F.from_json("aliases", "array<string>"), 0))
    q = table(s, d, "harmonized_drug_queries").select(F.lower(F.trim("query_name")).alias("query"))
    return joins.by_any_key(q, "query", r, ["canonical_name", "brand"], "canonical_name").select("query", "canonical_name")


@query("ref_r15_names_of_same_id", """
WITH p AS (SELECT DISTINCT lower(trim(intervention_name)) AS k, nct_id AS c, intervention_name AS n FROM trial_interventions WHERE intervention_name IS NOT NULL AND nct_id IS NOT NULL)
SELECT a.k AS key, string_agg(DISTINCT b.n,'|' ORDER BY b.n) AS names FROM (SELECT DISTINCT k,c FROM p) a JOIN p b ON a.c=b.c GROUP BY 1""")
def _(s, d):
    n = table(s, d, "trial_interventions").where("intervention_name is not null and nct_id is not null")
    return joins.names_of_same_id(n, "intervention_name", "nct_id").select("key", F.array_join("names", "|").alias("names"))


@query("ref_r16_containment", r"""
SELECT DISTINCT lower(trim(query_name)) AS query_name, lower(trim(canonical_name)) AS canonical_name FROM harmonized_drug_queries, drug_reference
WHERE trim(query_name)<>'' AND trim(canonical_name)<>'' AND (contains(lower(trim(query_name)), lower(trim(canonical_name))) OR contains(lower(trim(canonical_name)), lower(trim(query_name))))""")
def _(s, d):
    return joins.contained_either_way(table(s, d, "harmonized_drug_queries"), "query_name", table(s, d, "drug_reference"), "canonical_name")


@query("ref_r16_matched_labels", r"""
WITH n AS (SELECT canonical_name AS label_id, unnest(list_concat([canonical_name], CAST(aliases AS VARCHAR[]))) AS name, rxcui FROM drug_reference),
q AS (SELECT DISTINCT query_name AS query, (SELECT min(rxcui) FROM drug_reference WHERE lower(canonical_name)=lower(trim(query_name))) AS app FROM harmonized_drug_queries WHERE trim(query_name)<>'')
SELECT DISTINCT query, label_id FROM q JOIN n ON (trim(name)<>'' AND (contains(lower(trim(query)), lower(trim(name))) OR contains(lower(trim(name)), lower(trim(query))))) OR upper(replace(rxcui,' ',''))=upper(replace(app,' ',''))""")
def _(s, d):
    r = table(s, d, "drug_reference")
    labels = r.select(F.col("canonical_name").alias("label_id"), F.concat(F.array("canonical_name"), F.from_json("aliases", "array<string>")).alias("names"), F.array_compact(F.array("rxcui")).alias("applications"))
    apps = r.groupBy(F.lower("canonical_name").alias("k")).agg(F.array_compact(F.array(F.min("rxcui"))).alias("applications"))
    q = table(s, d, "harmonized_drug_queries").where("trim(query_name) <> ''").select(F.col("query_name").alias("query")).distinct().join(apps, F.lower(F.trim("query")) == F.col("k"), "left").select("query", "applications")
    return joins.matched_labels(q, labels)


@query("ref_r17_patents_by_composite", "SELECT o_orderkey, o_orderstatus, (SELECT string_agg(DISTINCT CAST(l_linenumber AS VARCHAR),',' ORDER BY CAST(l_linenumber AS VARCHAR)) FROM lineitem WHERE l_orderkey=o_orderkey AND l_linestatus=o_orderstatus) AS lines FROM orders")
def _(s, d):
    l = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus")).agg(F.array_join(F.array_sort(F.collect_set(F.col("l_linenumber").cast("string"))), ",").alias("lines"))
    return table(s, d, "orders").select("o_orderkey", "o_orderstatus").join(l, ["o_orderkey", "o_orderstatus"], "left")


@query("ref_r19_covered_sets", """
WITH s AS (SELECT DISTINCT nct_id AS k, lower(trim(intervention_name)) AS n FROM trial_interventions WHERE nct_id IS NOT NULL AND trim(intervention_name)<>''), need AS (SELECT k, count(*) AS c FROM s GROUP BY 1)
SELECT s.k AS set_id, e.k AS owner FROM s JOIN s e USING (n) JOIN need ON need.k=s.k GROUP BY s.k, e.k, need.c HAVING count(*)=need.c""")
def _(s, d):
    i = table(s, d, "trial_interventions").where("nct_id is not null and trim(intervention_name) <> ''")
    return joins.covered_sets(i.select(F.col("nct_id").alias("set_id"), F.col("intervention_name").alias("name")), "set_id", i.select(F.col("nct_id").alias("owner"), "intervention_name"), "owner", "intervention_name")


@query("ref_r22_null_safe", "SELECT a.trial_id, a.n AS n_a, b.n AS n_b FROM (SELECT trial_id, sponsor, count(*) AS n FROM enriched_trials GROUP BY 1,2) a JOIN (SELECT trial_id, sponsor, count(*) AS n FROM enriched_trials WHERE source='us_registry' GROUP BY 1,2) b ON a.trial_id=b.trial_id AND a.sponsor IS NOT DISTINCT FROM b.sponsor")
def _(s, d):
    g = lambda t, a: t.groupBy("trial_id", "sponsor").agg(F.count(F.lit(1)).alias(a))
    t = table(s, d, "enriched_trials")
    return joins.null_safe_join(g(t, "n_a"), g(t.where("source = 'us_registry'"), "n_b"), ["trial_id", "sponsor"]).select("trial_id", "n_a", "n_b")


@query("ref_r06_cohort", """
WITH a AS (SELECT DISTINCT o_custkey AS nct_id, o_orderstatus AS arm_label FROM orders), dm AS (SELECT c_custkey AS nct_id, CASE WHEN c_custkey%2=0 THEN 'F' END AS arm_label, c_mktsegment AS pop FROM customer WHERE c_acctbal>0),
k AS (SELECT a.*, dm.pop FROM a JOIN dm ON a.nct_id=dm.nct_id AND a.arm_label=dm.arm_label UNION ALL SELECT a.*, dm.pop FROM a JOIN dm ON a.nct_id=dm.nct_id WHERE dm.arm_label IS NULL),
g AS (SELECT DISTINCT o_custkey AS nct_id, o_orderstatus AS arm_label, 'x' AS drugs FROM orders WHERE o_totalprice>150000), e AS (SELECT l_suppkey AS nct_id, l_linestatus AS arm_label, sum(l_quantity) AS q FROM lineitem GROUP BY 1,2)
SELECT k.nct_id, k.arm_label, k.pop, g.drugs, e.q FROM k LEFT JOIN g USING (nct_id, arm_label) JOIN e USING (nct_id, arm_label)""")
def _(s, d):
    o = table(s, d, "orders")
    a = o.select(F.col("o_custkey").alias("nct_id"), F.col("o_orderstatus").alias("arm_label")).distinct().withColumn("has_any_ae", F.lit(True)).withColumn("has_lung_cancer_drug_match", F.lit(True))
    dm = table(s, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("nct_id"), F.when(F.col("c_custkey") % 2 == 0, "F").alias("arm_label"), F.col("c_mktsegment").alias("pop"), F.lit(True).alias("passes_diversity"))
    g = o.where("o_totalprice > 150000").select(F.col("o_custkey").alias("nct_id"), F.col("o_orderstatus").alias("arm_label"), F.lit("x").alias("drugs")).distinct()
    e = table(s, d, "lineitem").groupBy(F.col("l_suppkey").alias("nct_id"), F.col("l_linestatus").alias("arm_label")).agg(F.sum("l_quantity").alias("q"))
    return joins.cohort(a, dm, g, e).select("nct_id", "arm_label", "pop", "drugs", "q")


# ---------------------------------------------------------------- scalar functions


@query("ref_t01_title_key", r"SELECT trial_id, trim(regexp_replace(lower(title),'[ \t\n\x0B\f\r]+',' ','g')) AS k FROM enriched_trials")
def _(s, d):
    return table(s, d, "enriched_trials").select("trial_id", X.title_key(F.col("title")).alias("k"))


_ARM = "lower(trim(regexp_replace(coalesce(intervention_name,''),'[–—−]','-','g'),' '))"
for _pattern in (L.ARM_PREFIX, L.ARM_DOSE, L.ARM_FREQUENCY):
    _ARM = f"regexp_replace({_ARM},'{_pattern}','','g')"


@query("ref_t02_arm_key", rf"SELECT name_id, trim(regexp_replace(replace(replace({_ARM},'+',' + '),'/',' / '),'[ \t\n\x0B\f\r]+',' ','g'),' -:–—') AS k FROM trial_interventions")
def _(s, d):
    return table(s, d, "trial_interventions").select("name_id", X.arm_key(F.col("intervention_name")).alias("k"))


_ARM_KEY = rf"trim(regexp_replace(replace(replace({_ARM},'+',' + '),'/',' / '),'[ \t\n\x0B\f\r]+',' ','g'),' -:–—')"


@query("ref_r21_exact_arms", rf"""
WITH t0 AS (SELECT nct_id, 'Experimental: '||coalesce(intervention_name,'') AS intervention_name, ord, name_id FROM trial_interventions WHERE ord%2=0),
a AS (SELECT nct_id, intervention_name AS label, row_number() OVER (PARTITION BY nct_id ORDER BY ord, name_id)-1 AS place, {_ARM_KEY} AS k FROM trial_interventions), t AS (SELECT nct_id, intervention_name AS title, row_number() OVER (PARTITION BY nct_id ORDER BY -ord, name_id)-1 AS place, {_ARM_KEY} AS k FROM t0),
an AS (SELECT *, row_number() OVER (PARTITION BY nct_id, k ORDER BY place) AS nth FROM a), tn AS (SELECT *, row_number() OVER (PARTITION BY nct_id, k ORDER BY place) AS nth FROM t)
SELECT an.nct_id, CAST(an.place AS INT) AS place, coalesce(an.label,'') AS arm_label, CAST(tn.place AS INT) AS title_place, tn.title AS matched_to FROM an LEFT JOIN tn ON an.nct_id=tn.nct_id AND an.k=tn.k AND an.nth=tn.nth""")
def _(s, d):
    i = table(s, d, "trial_interventions")
    a = i.select("nct_id", F.struct("ord", "name_id").alias("arm_no"), F.col("intervention_name").alias("arm_label"))
    t = i.where("ord % 2 = 0").select("nct_id", F.struct(-F.col("ord"), "name_id").alias("title_no"), F.concat(F.lit("Experimental: "), F.coalesce("intervention_name", F.lit(""))).alias("title"))
    return arms.exact_arms(a, t).select("nct_id", "place", "arm_label", "title_place", "matched_to")


@query("ref_t03_drug_key", f"SELECT name_id, regexp_replace(regexp_replace(trim(lower(intervention_name),' '),'{L.FORM_WORDS}','','g'),'{L.DOSE}','','g') AS k FROM trial_interventions")
def _(s, d):
    return table(s, d, "trial_interventions").select("name_id", X.drug_key(F.col("intervention_name")).alias("k"))


@query("ref_t04_prefix_strip", f"SELECT name_id, trim(regexp_replace(intervention_name,'(?i){L.INTERVENTION_PREFIX}',''),' ') AS k FROM trial_interventions")
def _(s, d):
    return table(s, d, "trial_interventions").select("name_id", X.intervention_name(F.col("intervention_name")).alias("k"))


@query("ref_t05_event_keywords", f"WITH k(k) AS (VALUES {_KEYWORDS}) SELECT row_id, k AS keyword FROM clinical_trials JOIN k ON contains(lower(raw_study), k)")
def _(s, d):
    return table(s, d, "clinical_trials").select("row_id", F.explode(X.adverse_events(F.col("raw_study"))).alias("e")).select("row_id", F.col("e.keyword").alias("keyword"))


@query("ref_t07_mined_interventions")
def _(s, d):
    return table(s, d, "documents").select("doc_id", F.array_join(X.mined_interventions(F.col("text"), eu_studies.KNOWN_DRUGS), "|").alias("names"))


@query("ref_t08_population_mention")
def _(s, d):
    return table(s, d, "documents").select("doc_id", X.population_mention(F.col("text")).alias("m")).where("m is not null").select("doc_id", "m.*")


@query("ref_t07_mined_cases", "SELECT p_partkey, CASE WHEN p_partkey%2=0 THEN 'esbriet|ofev|Brand|Given|TwoPart' ELSE 'ofev|Brand|Given|TwoPart' END AS names FROM part")
def _(s, d):
    text = F.concat(F.split_part("p_brand", F.lit("#"), F.lit(1)), F.lit(" Ofev, Given TwoPart abc Xyz"), F.when(F.col("p_partkey") % 2 == 0, " ESBRIET Given").otherwise(""))
    return table(s, d, "part").select("p_partkey", F.array_join(X.mined_interventions(text, eu_studies.KNOWN_DRUGS), "|").alias("names"))


_MENTIONS = ["A study in Japanese patients", "Excluding Japanese patients", "In non-Korean subjects", "White men, then East Asian adults", "Without Chinese participants", "No restriction"]


@query("ref_t08_population_cases", "SELECT c_custkey, CASE c_custkey%6 WHEN 0 THEN 'Japanese' ELSE 'East Asian' END AS population, CASE c_custkey%6 WHEN 0 THEN 'patient' ELSE 'adult' END AS context FROM customer WHERE c_custkey%6 IN (0, 3)")
def _(s, d):
    text = F.get(F.array(*[F.lit(t) for t in _MENTIONS]), (F.col("c_custkey") % 6).cast("int"))
    return table(s, d, "customer").select("c_custkey", X.population_mention(text).alias("m")).where("m is not null").select("c_custkey", "m.population", "m.context")


@query("ref_t11_compatible_cases", "SELECT c_custkey, 'abc fi '||lower(c_name)||' 2' AS k FROM customer")
def _(s, d):
    return table(s, d, "customer").select("c_custkey", compatible_lower(F.concat(F.lit("  ＡＢＣ\u00a0ﬁ \t"), "c_name", F.lit(" ² "))).alias("k"))


@query("ref_t09_biomarkers", "SELECT doc_id, nullif(concat_ws('; ', " + ", ".join(f"CASE WHEN regexp_matches(lower(text), '{p}') THEN '{l}' END" for p, l in L.BIOMARKERS) + "),'') AS signal FROM documents")
def _(s, d):
    return table(s, d, "documents").select("doc_id", X.biomarker_signal(F.col("text")).alias("signal"))


@query("ref_t10_needs_model", r"""
SELECT doc_id, CASE WHEN coalesce(regexp_matches(text, '(?i)\bjapanese\b'), false) THEN coalesce(regexp_matches(lower(substr(trim(text,' '),1,60)),'^(exclusion|excluding|stratification|sub-analysis|subanalysis|biomarker)'),false) OR source='us_registry' ELSE coalesce(length(text)>200,false) END AS needed FROM documents""")
def _(s, d):
    hit, context = F.col("text").rlike(r"(?i)\bjapanese\b"), F.when(F.col("source") == "us_registry", "exclusion")
    return table(s, d, "documents").select("doc_id", X.needs_model(F.col("text"), hit, context).alias("needed"))


@query("ref_t11_compatible_form")
def _(s, d):
    return table(s, d, "trial_interventions").select("name_id", compatible_lower("intervention_name").alias("k"))


@query("ref_t12_without_salts", "SELECT name_id, trim(regexp_replace(lower(intervention_name),'" + L.SALTS + "',''),' ') AS k FROM trial_interventions")
def _(s, d):
    return table(s, d, "trial_interventions").select("name_id", X.without_salts(F.col("intervention_name")).alias("k"))


@query("ref_t13_brand_generic", r"SELECT name_id, CASE WHEN regexp_matches(intervention_name,'^(.+?)\s*\((.+)\)\s*$') THEN regexp_extract(intervention_name,'^(.+?)\s*\((.+)\)\s*$',1) ELSE intervention_name END AS brand, CASE WHEN regexp_matches(intervention_name,'^(.+?)\s*\((.+)\)\s*$') THEN regexp_extract(intervention_name,'^(.+?)\s*\((.+)\)\s*$',2) END AS generic FROM trial_interventions")
def _(s, d):
    return table(s, d, "trial_interventions").select("name_id", X.brand_and_generic(F.col("intervention_name")).alias("b")).select("name_id", "b.*")


@query("ref_t16_dates", "SELECT o_orderkey, strftime(o_orderdate,'%Y-%m-%d') AS a, strftime(o_orderdate,'%Y-%m-%d') AS b, strftime(o_orderdate,'%Y-%m-%d') AS c FROM orders")
def _(s, d):
    o = table(s, d, "orders")
    return o.select("o_orderkey", *[X.regulatory_date(F.date_format("o_orderdate", f)).alias(a) for a, f in (("a", "yyyyMMdd"), ("b", "MMM d, yyyy"), ("c", "dd-MMM-yy"))])


@query("ref_t17_or_expression", """SELECT canonical_name, '('||array_to_string(list_transform(CAST(aliases AS VARCHAR[]), lambda a: CASE WHEN contains(a,' ') THEN '"'||a||'"' ELSE a END),' OR ')||')' AS expr FROM drug_reference""")
def _(s, d):
    return table(s, d, "drug_reference").select("canonical_name", X.any_of_query(F.from_json("aliases", "array<string>")).alias("expr"))


@query("ref_t18_budget_batches", """
WITH RECURSIVE n AS (SELECT canonical_name AS name, row_number() OVER (ORDER BY canonical_name) AS i, strlen(CASE WHEN contains(canonical_name,' ') THEN '"'||canonical_name||'"' ELSE canonical_name END) AS q FROM drug_reference),
r AS (SELECT i, name, 0 AS batch, q AS len FROM n WHERE i=1 UNION ALL SELECT n.i, n.name, CASE WHEN r.len+4+n.q+2>500 THEN r.batch+1 ELSE r.batch END, CASE WHEN r.len+4+n.q+2>500 THEN n.q ELSE r.len+4+n.q END FROM r JOIN n ON n.i=r.i+1)
SELECT CAST(batch AS INT) AS batch, string_agg(name,'|' ORDER BY i) AS names FROM r GROUP BY 1""")
def _(s, d):
    names = table(s, d, "drug_reference").agg(F.array_sort(F.collect_list("canonical_name")).alias("n"))  # a fixed list of a few hundred names
    return names.select(F.posexplode(X.budget_batches(F.col("n"), 500)).alias("batch", "names")).select("batch", F.array_join("names", "|").alias("names"))


@query("ref_t19_change_detection", "SELECT trial_id, count(DISTINCT coalesce(status,'~')||'|'||coalesce(CAST(enrollment AS VARCHAR),'~')||'|'||coalesce(completion_date,'~')) AS states FROM trials_scd2_snapshots GROUP BY 1")
def _(s, d):
    t = table(s, d, "trials_scd2_snapshots").select("trial_id", "status", "enrollment", "completion_date")
    return t.withColumn("h", scd2.record_hash(t, ["status", "enrollment", "completion_date"])).groupBy("trial_id").agg(F.count_distinct("h").alias("states"))


@query("ref_t20_changed_columns", "SELECT a.o_orderkey, concat_ws(',', CASE WHEN a.o_orderstatus IS DISTINCT FROM b.l_linestatus THEN 'st' END, CASE WHEN a.o_custkey IS DISTINCT FROM b.l_suppkey THEN 'id' END) AS changed FROM orders a JOIN lineitem b ON a.o_orderkey=b.l_orderkey AND b.l_linenumber=1")
def _(s, d):
    a = table(s, d, "orders").select("o_orderkey", F.struct(F.col("o_orderstatus").alias("st"), F.col("o_custkey").alias("id")).alias("old"))
    b = table(s, d, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"), F.struct(F.col("l_linestatus").alias("st"), F.col("l_suppkey").alias("id")).alias("new"))
    return a.join(b, "o_orderkey").select("o_orderkey", F.array_join(scd2.changed_columns("old", "new", ["st", "id"]), ",").alias("changed"))


@query("ref_t23_numbers", "SELECT name_id, TRY_CAST(regexp_extract(intervention_name,'[0-9]+') AS DOUBLE) AS v FROM trial_interventions")
def _(s, d):
    return table(s, d, "trial_interventions").select("name_id", X.number(F.nullif(F.regexp_extract("intervention_name", "[0-9]+", 0), F.lit(""))).alias("v"))


@query("ref_t31_several_words", r"SELECT name_id, len(string_split_regex(trim(intervention_name,' '),'[ \t\n\x0B\f\r]+'))>1 AS several FROM trial_interventions")
def _(s, d):
    return table(s, d, "trial_interventions").select("name_id", X.several_words(F.col("intervention_name")).alias("several"))


@query("ref_j05_first_integer", r"SELECT name_id, TRY_CAST(nullif(regexp_extract(intervention_name,'\d+'),'') AS INT) AS v FROM trial_interventions")
def _(s, d):
    return table(s, d, "trial_interventions").select("name_id", X.first_integer(F.col("intervention_name")).alias("v"))


@query("ref_j13_json_path", "SELECT event_id, json_extract_string(props,'$.k') AS v FROM events")
def _(s, d):
    return table(s, d, "events").select("event_id", studies.json_value(F.col("props"), "k").alias("v"))


@query("ref_j14_raw_newest", "SELECT row_id, CAST(length(raw_study) AS INT) AS size FROM clinical_trials WHERE raw_study IS NOT NULL ORDER BY fetched_at DESC, row_id DESC LIMIT 10")
def _(s, d):
    return table(s, d, "clinical_trials").where("raw_study is not null").orderBy(F.desc("fetched_at"), F.desc("row_id")).limit(10).select("row_id", F.length("raw_study").alias("size"))


_CODES = "(SELECT string_agg(DISTINCT c,',' ORDER BY c) FROM (VALUES " + ", ".join(f"('{k}','{c}')" for k, c in L.AE_CODES.items()) + ") v(k,c) WHERE contains(lower(%s), k))"


@query("ref_t29_enriched", f"""
SELECT nct_id AS trial_id, 'us_registry' AS source, status, eligibility_criteria, coalesce({_CODES % "concat_ws(' ', description, eligibility_criteria)"},'') AS codes FROM clinical_trials
UNION ALL SELECT eudract_number, 'eu_registry', trial_status, 'Inclusion: '||coalesce(inclusion_criteria,'')||chr(10)||'Exclusion: '||coalesce(exclusion_criteria,''), coalesce({_CODES % "concat_ws(' ', description, inclusion_criteria, exclusion_criteria)"},'') FROM eu_clinical_trials""")
def _(s, d):
    e = eu_studies.enriched(table(s, d, "clinical_trials"), table(s, d, "eu_clinical_trials"))
    return e.select("trial_id", "source", "status", "eligibility_criteria", F.array_join("meddra_codes", ",").alias("codes"))


@query("ref_w05_flat_export", "SELECT trial_id, array_to_string(countries,', ') AS countries, CAST(len(interventions) AS INT) AS n FROM enriched_trials WHERE countries IS NOT NULL AND interventions IS NOT NULL")
def _(s, d):
    t = table(s, d, "enriched_trials").where("countries is not null and interventions is not null").select("trial_id", "countries", F.size("interventions").alias("n"))
    return flat_columns(t)


# ---------------------------------------------------------------- records


def _studies(s, d):
    return studies.typed_studies(table(s, d, "clinical_trials"), "raw_study", "row_id")


@query("ref_j01_study_records", records_sql.STUDY_RECORDS)
def _(s, d):
    r = studies.study_records(_studies(s, d))
    return flat_columns(r)


@query("ref_j02_legacy_records", """
SELECT coalesce(nct_id,'') AS nct_id, coalesce(title,'') AS title, '' AS condition, '' AS status, CAST(NULL AS VARCHAR) AS phase, '' AS study_type, '' AS sponsor, '' AS start_date, '' AS completion_date,
coalesce(array_to_string(list_filter(intervention_names, lambda x: x<>''),'|'),'') AS intervention_names, coalesce(array_to_string(list_filter(location_countries, lambda c, i: c<>'' AND list_position(location_countries, c)=i),'|'),'') AS location_countries FROM clinical_trials""")
def _(s, d):
    t = table(s, d, "clinical_trials")
    loc = F.transform("location_countries", lambda c: F.struct(F.struct(c.alias("Country")).alias("GeoPoint")))
    arm = F.array(F.struct(F.struct(F.transform("intervention_names", lambda n: F.struct(n.alias("Name"))).alias("Intervention")).alias("InterventionList")))
    sec = F.struct(F.struct(F.col("nct_id").alias("NCTId"), F.col("title").alias("OfficialTitle")).alias("IdentificationModule"), F.struct(F.struct(arm.alias("ArmGroup")).alias("ArmGroupList")).alias("ArmsInterventionsModule"), F.struct(F.struct(loc.alias("Location")).alias("LocationList")).alias("ContactsLocationsModule"))
    return flat_columns(eu_studies.legacy_records(t.select(F.to_json(F.struct(sec.alias("ProtocolSection"))).alias("j")), "j"), "|")


@query("ref_j03_eu_records")
def _(s, d):
    return flat_columns(eu_studies.eu_records(table(s, d, "eu_clinical_trials"), "raw_trial").drop("raw_trial"), "|")


@query("ref_j04_eu_interventions")
def _(s, d):
    r = eu_studies.eu_records(table(s, d, "eu_clinical_trials"), "raw_trial")
    return r.select("eudract_number", F.explode("intervention_names").alias("name"))


@query("ref_j06_trial_rows", records_sql.TRIAL_ROWS)
def _(s, d):
    return studies.trial_rows(_studies(s, d))


@query("ref_j07_arm_rows", records_sql.ARM_ROWS)
def _(s, d):
    return studies.arm_rows(_studies(s, d))


@query("ref_j08_arm_interventions", records_sql.ARM_INTERVENTIONS)
def _(s, d):
    return studies.arm_intervention_rows(_studies(s, d), table(s, d, "drug_reference"))


@query("ref_j09_baseline_rows", records_sql.BASELINE)
def _(s, d):
    return studies.baseline_rows(_studies(s, d))


@query("ref_j10_ae_rows", records_sql.EVENTS)
def _(s, d):
    return studies.ae_rows(_studies(s, d))


@query("ref_j11_intervention_synonyms", records_sql.SYNONYMS)
def _(s, d):
    return studies.intervention_synonyms(_studies(s, d)).select("nct_id", "name", F.array_join("synonyms", "|").alias("synonyms"))


@query("ref_j12_mesh_pairs", records_sql.MESH_PAIRS)
def _(s, d):
    return studies.mesh_pairs(_studies(s, d))


@query("ref_r21_arm_resolver")
def _(s, d):
    st = _studies(s, d)
    a = studies.arm_rows(st).where("nct_id is not null").select("nct_id", "arm_no", "arm_label")
    groups = st.select(F.col("study.protocolSection.identificationModule.nctId").alias("nct_id"), F.posexplode("study.resultsSection.adverseEventsModule.eventGroups").alias("title_no", "g")).select("nct_id", "title_no", F.col("g.title").alias("title"))
    return arms.resolved_arms(a, groups)


@query("ref_t26_cascade")
def _(s, d):
    st = _studies(s, d)
    t = studies.trial_rows(st).where("nct_id is not null")
    t = dedup.keep_first(t, ["nct_id"], [F.to_json(F.struct(*t.columns))])
    t = t.withColumn("site_countries", F.from_json("countries", "array<string>")).withColumn("secondary_ids", F.from_json("secondary_ids", "array<struct<id: string, type: string, domain: string>>"))
    b = studies.baseline_rows(st).withColumn("ord", F.xxhash64("category", "value"))
    dim = s.createDataFrame(demographics.COUNTRIES, "country_name string, dominant_ancestry string, region string, in_diverse_exclusion_list boolean")
    return demographics.with_diversity_flag(demographics.cascade(t, b, dim))


def _names_japanese(text):
    found = "japanese" in (text or "").lower()
    return {"has_population_restriction": found, "population": "Japanese" if found else None}


@query("ref_x01_model_cache", """
SELECT CAST(doc_id AS VARCHAR) AS nct_id, CASE WHEN doc_id%3=0 THEN 'cached' WHEN contains(lower(text),'japanese') THEN 'Japanese' END AS population, CASE WHEN doc_id%3=0 THEN true ELSE contains(lower(text),'japanese') END AS restricted FROM documents WHERE text IS NOT NULL""")
def _(s, d):
    docs = table(s, d, "documents").where("text is not null")
    hits = docs.where("doc_id % 3 = 0").select(F.col("doc_id").cast("string").alias("nct_id"), F.lit(True).alias("has_population_restriction"), F.lit("cached").alias("population"), F.lit(True).alias("is_inclusion_criterion"), F.lit(None).cast("string").alias("evidence_span"), F.lit(None).cast("string").alias("reasoning"))
    out = with_model_cache(docs.select(F.col("doc_id").cast("string").alias("nct_id"), "text"), hits, _names_japanese)
    return out.select("nct_id", "hit.population", F.col("hit.has_population_restriction").alias("restricted"))


@query("ref_x02_batched_entities", r"""
SELECT name, array_to_string(list_filter(l, lambda x, i: list_position(l, x)=i),'|') AS entities FROM (SELECT DISTINCT intervention_name AS name, regexp_extract_all(lower(intervention_name),'[a-z]{4,}') AS l FROM trial_interventions WHERE intervention_name IS NOT NULL)""")
def _(s, d):
    import re

    n = table(s, d, "trial_interventions").where("intervention_name is not null").select(F.col("intervention_name").alias("name")).distinct()
    return batched_entities(n, lambda xs: [re.findall(r"[a-z]{4,}", x.lower()) for x in xs]).select("name", F.array_join("entities", "|").alias("entities"))


@query("ref_x01_model_struct", "SELECT trial_id, coalesce(contains(lower(eligibility_criteria),'japanese'),false) AS restricted, CASE WHEN contains(lower(eligibility_criteria),'japanese') THEN 'Japanese' END AS population FROM enriched_trials")
def _(s, d):
    t = table(s, d, "enriched_trials").select("trial_id", population_model(_names_japanese)(F.col("eligibility_criteria")).alias("h"))
    return t.select("trial_id", F.col("h.has_population_restriction").alias("restricted"), "h.population")


# ---------------------------------------------------------------- further filters, joins and exports


@query("ref_p12_flag_filter", "SELECT name_id FROM trial_interventions WHERE regexp_matches(lower(intervention_name),'placebo|sham') AND ord > 0")
def _(s, d):
    t = table(s, d, "trial_interventions").withColumn("a", X.is_placebo_name(F.col("intervention_name"))).withColumn("b", F.col("ord") > 0)
    return t.where("a and b").select("name_id")


@query("ref_p13_diversity", """
SELECT c_custkey, CASE WHEN t IN ('A1','A2') THEN coalesce(c_acctbal/10000 >= 0.95, false) WHEN t='B1' THEN coalesce(c_mktsegment,'')<>'' ELSE false END AS passes_diversity
FROM (SELECT *, CASE WHEN c_nationkey<8 THEN 'A1' WHEN c_nationkey<12 THEN 'A2' WHEN c_nationkey<20 THEN 'B1' ELSE 'NONE' END AS t FROM customer)""")
def _(s, d):
    n = F.col("c_nationkey")
    c = table(s, d, "customer").select("c_custkey", F.when(n < 8, "A1").when(n < 12, "A2").when(n < 20, "B1").otherwise("NONE").alias("demog_tier"), (F.col("c_acctbal") / 10000).alias("inferred_diversity_pct"), F.col("c_mktsegment").alias("inferred_population"))
    return demographics.with_diversity_flag(c).select("c_custkey", "passes_diversity")


@query("ref_p17_document_addresses", "SELECT trial_id, regexp_replace(url,'^http:','https:') AS url FROM enriched_trials WHERE url LIKE 'http%' AND length(url)-length(replace(url,'http',''))<=4")
def _(s, d):
    t = table(s, d, "enriched_trials").where(F.col("url").startswith("http") & (F.regexp_count("url", F.lit("http")) <= 1))
    return t.select("trial_id", F.regexp_replace("url", "^http:", "https:").alias("url"))


@query("ref_r03_trial_level_join", "SELECT i.name_id, c.source FROM trial_interventions i JOIN (SELECT trial_id, min(source) AS source FROM enriched_trials GROUP BY 1) c ON i.nct_id=c.trial_id")
def _(s, d):
    c = table(s, d, "enriched_trials").groupBy(F.col("trial_id").alias("nct_id")).agg(F.min("source").alias("source"))
    return table(s, d, "trial_interventions").join(c, "nct_id").select("name_id", "source")


@query("ref_r10_mapped_signal", """SELECT i.name_id, s.signal FROM trial_interventions i LEFT JOIN (SELECT trial_id, max(CASE WHEN regexp_matches(lower(title),'asthma') THEN 'asthma' END) AS signal FROM enriched_trials GROUP BY 1) s ON i.nct_id=s.trial_id""")
def _(s, d):
    m = table(s, d, "enriched_trials").groupBy(F.col("trial_id").alias("nct_id")).agg(F.max(F.when(F.lower("title").contains("asthma"), "asthma")).alias("signal"))
    return table(s, d, "trial_interventions").join(m, "nct_id", "left").select("name_id", "signal")


@query("ref_r18_cross_names", """
WITH a AS (SELECT nct_id, list_sort(list_distinct(list(intervention_name))) AS names FROM trial_interventions WHERE trim(intervention_name)<>'' AND nct_id IS NOT NULL GROUP BY 1)
SELECT nct_id, CAST(len(list_distinct(list_transform(list_concat([nct_id], names), lambda x: lower(trim(x))))) AS INT) AS n FROM a""")
def _(s, d):
    i = table(s, d, "trial_interventions").where("trim(intervention_name) <> '' and nct_id is not null")
    other = i.select("nct_id", F.array("intervention_name").alias("names"))
    rows = i.select("nct_id").distinct().withColumn("names", F.array("nct_id"))
    return harmonize.with_cross_names(rows, other, "nct_id", "names").select("nct_id", F.size("names").alias("n"))


@query("ref_r20_merged_rows", """
WITH RECURSIVE u AS (SELECT canonical_name AS r, lower(trim(unnest(CAST(subtypes AS VARCHAR[])))) AS n FROM drug_reference), p AS (SELECT DISTINCT a.r AS x, b.r AS y FROM (SELECT r, n, min(r) OVER (PARTITION BY n) AS m FROM u) a JOIN u b ON a.n=b.n AND b.r=a.m UNION SELECT b.r, a.r FROM (SELECT r, n, min(r) OVER (PARTITION BY n) AS m FROM u) a JOIN u b ON a.n=b.n AND b.r=a.m),
c AS (SELECT canonical_name AS r, canonical_name AS o FROM drug_reference UNION SELECT c.r, p.y FROM c JOIN p ON c.o=p.x) SELECT r AS canonical_name, min(o) AS "group" FROM c GROUP BY 1""")
def _(s, d):
    r = table(s, d, "drug_reference").select("canonical_name", F.from_json("subtypes", "array<string>").alias("names"))
    return harmonize.merged_rows(r, "canonical_name", "names")


@query("ref_r23_coded_terms", "SELECT i.name_id, lower(coalesce(r.rxcui, i.intervention_name)) AS code FROM trial_interventions i LEFT JOIN drug_reference r ON lower(trim(i.intervention_name,' '))=lower(trim(r.canonical_name,' ')) AND r.rxcui IS NOT NULL")
def _(s, d):
    return harmonize.coded(table(s, d, "trial_interventions").select("name_id", "intervention_name"), "intervention_name", table(s, d, "drug_reference").where("rxcui is not null"), "canonical_name", "rxcui").select("name_id", F.lower("code").alias("code"))


@query("ref_r25_membership_flags", """SELECT canonical_name, list_contains(CAST(subtypes AS VARCHAR[]),'NSCLC') AS nsclc, list_contains(CAST(subtypes AS VARCHAR[]),'SCLC') AS sclc FROM drug_reference""")
def _(s, d):
    t = table(s, d, "drug_reference").select("canonical_name", F.explode_outer(F.from_json("subtypes", "array<string>")).alias("v"))
    return t.groupBy("canonical_name").agg(F.coalesce(F.bool_or(F.col("v") == "NSCLC"), F.lit(False)).alias("nsclc"), F.coalesce(F.bool_or(F.col("v") == "SCLC"), F.lit(False)).alias("sclc"))


@query("ref_d03_first_kind", "SELECT l_partkey, arg_min(l_returnflag, l_orderkey*10+l_linenumber) AS l_returnflag FROM lineitem GROUP BY 1")
def _(s, d):
    return dedup.keep_first(table(s, d, "lineitem").select("l_partkey", "l_returnflag", "l_orderkey", "l_linenumber"), ["l_partkey"], ["l_orderkey", "l_linenumber"]).select("l_partkey", "l_returnflag")


@query("ref_d07_first_product", "SELECT p_name, min(p_partkey) AS p_partkey FROM part GROUP BY 1")
def _(s, d):
    return dedup.keep_first(table(s, d, "part").select("p_name", "p_partkey"), ["p_name"], ["p_partkey"])


@query("ref_o03_top_values", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, min(p_partkey) LIMIT 10")
def _(s, d):
    return dedup.top_counts(table(s, d, "part"), "p_brand", "p_partkey", 10)


@query("ref_o04_order_without_case", "SELECT canonical_name, row_number() OVER (ORDER BY lower(canonical_name)) AS place FROM drug_reference")
def _(s, d):
    r = table(s, d, "drug_reference").agg(F.array_sort(F.collect_list(F.struct(F.lower("canonical_name").alias("k"), "canonical_name"))).alias("l"))  # a fixed list of a few hundred names
    return r.select(F.posexplode("l").alias("place", "x")).select("x.canonical_name", (F.col("place") + 1).cast("long").alias("place"))


@query("ref_u03_tiers_in_order", "SELECT c_custkey, CASE WHEN c_acctbal>5000 THEN 'A' WHEN c_mktsegment='AUTOMOBILE' THEN 'B' ELSE 'NONE' END AS tier FROM customer")
def _(s, d):
    c = table(s, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    a = c.where("c_acctbal > 5000").select("c_custkey", F.lit("A").alias("tier"))
    b = c.join(a, "c_custkey", "left_anti").where("c_mktsegment = 'AUTOMOBILE'").select("c_custkey", F.lit("B").alias("tier"))
    return a.unionByName(b).unionByName(c.join(a.unionByName(b), "c_custkey", "left_anti").select("c_custkey", F.lit("NONE").alias("tier")))


@query("ref_t06_event_codes", f"WITH k(k, c) AS (VALUES {', '.join(f"('{k}','{c}')" for k, c in L.AE_CODES.items())}) SELECT row_id, string_agg(DISTINCT c,',' ORDER BY c) AS codes FROM clinical_trials JOIN k ON contains(lower(raw_study), k) GROUP BY 1")
def _(s, d):
    t = table(s, d, "clinical_trials").select("row_id", F.array_sort(F.array_distinct(F.transform(X.adverse_events(F.col("raw_study")), lambda e: e["code"]))).alias("c"))
    return t.where(F.size("c") > 0).select("row_id", F.array_join("c", ",").alias("codes"))


@query("ref_t14_label_section", """
SELECT doc_id, CASE WHEN length(w) > 100 THEN w END AS section FROM (SELECT doc_id, trim(regexp_replace(CASE WHEN doc_id%2=0 THEN 'Use '||repeat('it well. ', CAST(doc_id%40 AS INT)) ELSE 'See '||repeat('the rest. ', CAST(doc_id%40 AS INT)) END,'\\s+',' ','g'),' ') AS w FROM documents)""")
def _(s, d):
    t = table(s, d, "documents")
    n = (F.col("doc_id") % 40).cast("int")
    even = F.concat(F.lit("HIGHLIGHTS\n1 INDICATIONS AND USAGE\nUse "), F.repeat(F.lit("it well.\n"), n), F.lit("2 DOSAGE AND ADMINISTRATION\nmore"))
    odd = F.concat(F.lit("----\nIndications and Usage\n----\nSee "), F.repeat(F.lit("the rest.\n"), n), F.lit("------\nOTHER\nno"))
    return t.select("doc_id", section_under()(F.when(F.col("doc_id") % 2 == 0, even).otherwise(odd)).alias("section"))


@query("ref_t15_dashed_section", r"SELECT * FROM (SELECT doc_id, regexp_replace(regexp_extract(text,'(?is)-{3,}\\s*INDICATIONS\\s*-{3,}(.*?)(\\n-{3,}|$)',1),'^[ \\t\\n\\x0B\\f\\r]+|[ \\t\\n\\x0B\\f\\r]+$','','g') AS section FROM documents) WHERE section <> ''")
def _(s, d):
    return table(s, d, "documents").select("doc_id", X.section(F.col("text"), "INDICATIONS").alias("section")).where("section <> ''")


@query("ref_t22_json_round_trip", "SELECT canonical_name, array_to_string(CAST(aliases AS VARCHAR[]),'|') AS aliases FROM drug_reference")
def _(s, d):
    t = table(s, d, "drug_reference").withColumn("j", F.to_json(F.from_json("aliases", "array<string>")))
    return t.select("canonical_name", F.array_join(F.from_json("j", "array<string>"), "|").alias("aliases"))


@query("ref_t27_drug_rows", f"""
SELECT canonical_name, rxcui, to_json(list_sort(list_distinct(list_filter(list_concat([canonical_name], CAST(aliases AS VARCHAR[])), lambda a: a<>'' AND length(a)<=40 AND NOT regexp_matches(lower(a), '{L.ALIAS_NOISE}')))))::VARCHAR AS aliases FROM drug_reference""")
def _(s, d):
    g = table(s, d, "drug_reference").select(F.col("canonical_name").alias("generic_name"), "rxcui", F.from_json("aliases", "array<string>").alias("brand_names"), F.lit(None).cast("array<string>").alias("synonyms"))
    return harmonize.drug_rows(g)


@query("ref_t28_list_display", "SELECT row_id, array_to_string(location_countries,' | ') AS countries FROM clinical_trials WHERE location_countries IS NOT NULL")
def _(s, d):
    return table(s, d, "clinical_trials").where("location_countries is not null").select("row_id", F.array_join("location_countries", " | ").alias("countries"))


@query("ref_w04_run_log", "SELECT 'r1' AS run_id, 'completed' AS status, CAST(count(*) AS BIGINT) AS inserted, 60.0::DOUBLE AS duration_seconds FROM (SELECT DISTINCT trial_id FROM enriched_trials WHERE trim(trial_id)<>'')")
def _(s, d):
    t = table(s, d, "enriched_trials").where("trial_id is not null").groupBy("trial_id").agg(F.min("status").alias("status"))
    stats = scd2.scd2_upsert(None, t, "trial_id", ["status"], NOW()).stats
    log = runs.complete_run(runs.start_run(s, None, "r1", NOW("2024-01-31 00:00:00")), "r1", stats, NOW("2024-01-31 00:01:00"))
    return log.select("run_id", "status", "inserted", "duration_seconds")


@query("ref_w16_last_label", "SELECT o_custkey, strftime(o_orderdate,'%Y-%m-%d') AS day, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1,2")
def _(s, d):
    o = table(s, d, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderkey")
    return dedup.keep_last(o, ["o_custkey", "day"], ["o_orderkey"])
