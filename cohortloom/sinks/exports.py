"""What the pipelines export, as DataFrames in the shape of the files; the writers of this package write them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: fixed values: the columns of the trial and drug exports, in their order
STORED = ["trial_id", "source", "title", "condition", "status", "phase", "study_type", "sponsor", "start_date", "completion_date", "enrollment", "url"]
HARMONIZED = """query_name harmonized_drug_name harmonized_generic_name harmonized_brand_name strength route dosage_form ndc_codes application_numbers bla_numbers unii_codes
manufacturers pharmacological_class marketing_status therapeutic_equivalence dea_schedule bla_type licensure_status interchangeability confidence_score sources_used""".split()
FIRST = ["query_name", "harmonized_drug_name", "harmonized_generic_name", "harmonized_brand_name"]
#: Codes of a drug that an exported document lists at most, as a feature of that format.
LISTED_CODES = 5


def _joined(c: str, sep: str = "; ") -> Column:
    return F.array_join(F.coalesce(F.col(c), F.array().cast("array<string>")), sep)


def stored_trials(trials: DataFrame, **equal: object) -> DataFrame:
    """The flat trial table, optionally where columns equal given values: lists joined by ``; ``, events counted; null lists are empty."""
    kept = trials
    for c, v in equal.items():
        kept = kept.where(F.col(c) == v)
    events = F.greatest(F.size(F.coalesce(F.col("adverse_events"), F.array().cast(trials.schema["adverse_events"].dataType))), F.lit(0)) if "adverse_events" in trials.columns else F.lit(0)
    codes = _joined("meddra_codes") if "meddra_codes" in trials.columns else F.lit("")
    return kept.select(*STORED, _joined("countries").alias("countries"), _joined("interventions").alias("interventions"), events.alias("adverse_event_count"), codes.alias("meddra_codes"), "data_collection_date")


def raw_records(trials: DataFrame, raw: str, source: str | None = None) -> DataFrame:
    """(trial_id, raw): the raw records there are, optionally of one source."""
    kept = trials.where(F.col(raw).isNotNull())
    return (kept.where(F.col("source") == source) if source else kept).select("trial_id", F.col(raw).alias("raw"))


def harmonized_documents(drugs: DataFrame) -> DataFrame:
    """(trial_id, document): one JSON document for each trial with drugs: its title, source and drugs by name.

    ``drugs`` has trial_id, title, source, drug_name and the drug's fields; of a drug's codes the first LISTED_CODES
    are listed. Of repeated drug names of a trial the first by its values holds; drugs are in the order of names.
    """
    fields = [c for c in drugs.columns if c not in ("trial_id", "title", "source", "drug_name")]
    body = F.struct(*[(F.slice(F.coalesce(c, F.array().cast("array<string>")), 1, LISTED_CODES) if c == "ndc_codes" else F.col(c)).alias(c) for c in fields])
    one = drugs.where("trial_id is not null and drug_name is not null").groupBy("trial_id", "title", "source", "drug_name").agg(F.min_by(body, F.to_json(body)).alias("b"))
    per = one.groupBy("trial_id").agg(F.min(F.struct("title", "source")).alias("t"), F.array_sort(F.collect_list(F.struct("drug_name", "b"))).alias("l"))
    entry = F.map_from_entries(F.transform(F.array_distinct(F.transform("l", lambda x: x["drug_name"])), lambda n: F.struct(n, F.filter("l", lambda x: x["drug_name"] == n)[0]["b"])))
    return per.select("trial_id", F.to_json(F.struct(F.col("t.title").alias("trial_title"), F.col("t.source").alias("source"), entry.alias("drugs"))).alias("document"))


def harmonized_rows(drugs: DataFrame) -> DataFrame:
    """The 21 columns of harmonised drugs as text: lists joined by ``; `` without empty parts; what is missing is empty."""
    out = []
    for c in HARMONIZED:
        if c not in drugs.columns:
            out.append(F.lit("").alias(c))
        elif isinstance(drugs.schema[c].dataType, T.ArrayType):
            out.append(F.array_join(F.filter(F.coalesce(F.col(c).cast("array<string>"), F.array().cast("array<string>")), lambda x: x != ""), "; ").alias(c))
        else:
            out.append(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c))
    return drugs.select(*out)


def converted(records: DataFrame) -> DataFrame:
    """Records of any shape as flat columns: four columns first, the others by name; lists of plain values joined by `` | ``, anything nested as JSON."""
    order = [c for c in FIRST if c in records.columns] + sorted(c for c in records.columns if c not in FIRST)
    out = []
    for c in order:
        kind = records.schema[c].dataType
        if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.ArrayType, T.StructType, T.MapType)):
            out.append(F.array_join(F.col(c).cast("array<string>"), " | ").alias(c))
        elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            out.append(F.to_json(c).alias(c))
        else:
            out.append(F.col(c))
    return records.select(*out)


def name_group_rows(groups: DataFrame) -> DataFrame:
    """Groups of names as flat rows: canonical name, synonyms and trials joined by `` | ``, how many."""
    return groups.select("canonical_name", _joined("synonyms", " | ").alias("synonyms"), _joined("nct_ids", " | ").alias("nct_ids"), "synonym_count")


def migrated(stored: DataFrame, lists: tuple[str, ...] = ("countries", "interventions")) -> DataFrame:
    """Rows of an older store with JSON text in the given columns as typed lists; text that is no JSON list gives an empty one."""
    parse = lambda c: F.coalesce(F.from_json(F.when(F.trim(c).startswith("["), F.col(c)), "array<string>"), F.array().cast("array<string>"))
    return stored.withColumns({c: parse(c) for c in lists})


def create_store(spark: SparkSession, database: str, columns: str, key: str = "trial_id") -> None:
    """The tables of the history store, where they are missing, and the view of its current rows.

    Current and closed versions are partitions of their own, which is what a partial index on current rows is for.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.trials_scd2 ({columns}, valid_from TIMESTAMP, valid_to TIMESTAMP, version INT, record_hash STRING, change_type STRING, changed_columns ARRAY<STRING>, is_current BOOLEAN) USING parquet PARTITIONED BY (is_current)")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.pipeline_runs (run_id STRING, started_at TIMESTAMP, completed_at TIMESTAMP, status STRING, inserted BIGINT, updated BIGINT, unchanged BIGINT, errors BIGINT, duration_seconds DOUBLE, error STRING) USING parquet")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.trial_change_log (run_id STRING, {key} STRING, version INT, change_type STRING, changed_columns ARRAY<STRING>, changed_at TIMESTAMP) USING parquet")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.trials_current AS SELECT * FROM {database}.trials_scd2 WHERE is_current")


def tables_of(spark: SparkSession, database: str) -> DataFrame:
    """(name, is_view) of the tables of a database."""
    return spark.createDataFrame([(t.name, t.tableType == "VIEW") for t in spark.catalog.listTables(database)], "name string, is_view boolean")
