"""Files that agencies and registries publish, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cached_pages(spark: SparkSession, folder: str, schema: str | T.StructType) -> DataFrame:
    """Studies of all ``page_*.json`` files below a folder, with page number, file and position, which give the page order."""
    pages = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "page_*.json").option("multiLine", True).json(folder)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)", 1).cast("long")
    return pages.select(number.alias("page"), F.col("_metadata.file_path").alias("file"), F.posexplode("studies").alias("pos", "study"))


def first_of_each_study(studies: DataFrame) -> DataFrame:
    """One row per study id, the first in page order; studies without id are left out."""
    nct = F.col("study.protocolSection.identificationModule.nctId")
    return studies.where(nct.isNotNull()).groupBy(nct.alias("nct_id")).agg(F.min_by("study", F.struct("page", "file", "pos")).alias("study"))


def bulk_results(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The elements of the ``results`` array of bulk JSON files."""
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.inline("results"))


def tilde_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A ``~``-delimited table with a header: values trimmed, short rows padded with empty values, blank lines skipped."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.csv(path, schema=schema, sep="~", header=True, quote="", enforceSchema=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return raw.select(*[F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in columns]).where(F.concat(*[F.col(f"`{c}`") for c in columns]) != "")


def csv_after_preamble(spark: SparkSession, path: str, columns: list[str], preamble: int = 3) -> DataFrame:
    """A CSV whose first lines are no data: all rows behind the header, which names the first column; keys and values are trimmed.

    A file without such a row loses its first ``preamble`` rows and one more. Quoted values may hold line breaks, so a
    file is read by one task, row by row.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.schema(schema).option("multiLine", True).option("escape", '"').option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    placed = raw.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_no"))
    is_header = F.trim(F.col(f"`{columns[0]}`")) == columns[0]
    start = placed.groupBy(F.col("_file").alias("_f")).agg(F.coalesce(F.min(F.when(is_header, F.col("_no"))), F.min("_no") + preamble).alias("_start"))
    kept = placed.join(start, (F.col("_file") == F.col("_f")) & (F.col("_no") > F.col("_start")))
    return kept.select(*[F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in columns]).where(F.concat(*[F.col(f"`{c}`") for c in columns]) != "")


def concept_names(spark: SparkSession, path: str) -> DataFrame:
    """(rxcui, name) of a pipe-delimited concept file: fields 0 and 14 of lines with at least 15."""
    parts = spark.read.text(path).select(F.split("value", r"\|").alias("p")).where(F.size("p") >= 15)
    return parts.select(F.trim(F.get("p", 0)).alias("rxcui"), F.trim(F.get("p", 14)).alias("name")).where("rxcui <> '' and name <> ''")


def name_list(spark: SparkSession, path: str) -> DataFrame:
    """Names of a text file, one a line, trimmed, blank lines dropped."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name <> ''")


def country_reference(spark: SparkSession, path: str) -> DataFrame:
    """The country list; ``true``, ``1`` and ``yes`` are true."""
    schema = "country_iso3 string, country_name string, dominant_ancestry string, homogeneity_score double, continent string, region string, in_diverse_exclusion_list string"
    raw = spark.read.csv(path, schema=schema, header=True)
    return raw.withColumn("in_diverse_exclusion_list", F.coalesce(F.lower(F.trim("in_diverse_exclusion_list")).isin("true", "1", "yes"), F.lit(False)))


def drug_classes(spark: SparkSession, path: str) -> DataFrame:
    """The drug classes; codes are text, blank ones null."""
    raw = spark.read.csv(path, schema="rxcui string, generic_name string, drug_class string, biomarker_note string", header=True)
    return raw.withColumn("rxcui", F.nullif(F.trim("rxcui"), F.lit("")))


def model_cache(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log of model results, one JSON object a line; the last line of each nct_id holds (of several files that of the last by name).

    The log is split like any text; a line's place is its file, its split's first byte, and its number in the split.
    """
    place = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("n"))
    lines = spark.read.text(path).select(place.alias("at"), "value").where(F.trim("value") != "")
    rows = lines.select("at", F.from_json("value", schema).alias("r")).where("r.nct_id is not null")
    return rows.groupBy(F.col("r.nct_id").alias("nct_id")).agg(F.max_by("r", "at").alias("r")).select("nct_id", *[F.col(f"r.{f}") for f in T._parse_datatype_string(schema).fieldNames() if f != "nct_id"])
