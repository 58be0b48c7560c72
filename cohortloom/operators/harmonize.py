"""Drug records of several agencies brought together: extraction, lookups, patents, consolidation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.text import distinct_without_case, drug_key, regulatory_date


def split_list(c: Column, sep: str) -> Column:
    """The trimmed non-empty parts of a delimited text."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), sep), lambda x: F.trim(x)), lambda x: x != "")


def lookup_keys(rows: DataFrame, row_id: str, *names: str) -> DataFrame:
    """(key, row id) for every name of every row, in lower case."""
    return rows.select(F.explode(F.array_distinct(F.filter(F.transform(F.flatten(F.array(*[F.col(n) for n in names])), lambda x: F.lower(F.trim(x))), lambda x: x != ""))).alias("key"), row_id)


def found_by_name(queries: DataFrame, keys: DataFrame, row_id: str) -> DataFrame:
    """(query, row id): rows under the normalised query, each once."""
    q = queries.select("query", drug_key(F.col("query")).alias("key")).where("key <> ''")
    return q.join(keys, "key").select("query", row_id).distinct()


def application_events(applications: DataFrame) -> DataFrame:
    """One row per distinct (date, type, number) of an application's submissions, with ISO dates."""
    e = applications.select("application_number", F.explode("submissions").alias("s"))
    return e.select("application_number", regulatory_date(F.col("s.submission_status_date")).alias("date"), F.col("s.submission_type").alias("type"), F.col("s.submission_number").alias("number"), F.col("s.submission_class_code").alias("class_code")).groupBy("application_number", "date", "type", "number").agg(F.min("class_code").alias("class_code"))


def newest_labels(applications: DataFrame) -> DataFrame:
    """Per application the newest label document: a PDF of type Label with one address; http becomes https."""
    d = applications.select("application_number", F.explode("submissions").alias("s")).select("application_number", F.col("s.submission_status_date").alias("date"), F.posexplode("s.application_docs").alias("no", "d"))
    ok = (F.col("d.type") == "Label") & F.lower("d.url").endswith(".pdf") & (F.regexp_count("d.url", F.lit("http")) <= 1)
    best = d.where(ok).groupBy("application_number").agg(F.max_by(F.struct("date", "d.url"), F.struct(F.coalesce("date", F.lit("0000-00-00")), -F.col("no"))).alias("b"))
    return best.select("application_number", F.col("b.date").alias("date"), F.regexp_replace("b.url", "^http:", "https:").alias("url"))


def ingredient_columns(products: DataFrame) -> DataFrame:
    """Orange-book products with ingredients as a list and dosage form and route apart."""
    form = F.split(F.col("`DF;Route`"), ";")
    return products.select("*", split_list(F.col("Ingredient"), ";").alias("ingredients"), F.trim(F.get(form, 0)).alias("dosage_form"), F.trim(F.get(form, 1)).alias("route"))


def with_patents(products: DataFrame, patents: DataFrame, exclusivities: DataFrame) -> DataFrame:
    """Products with their patents and exclusivities as arrays, by application and product number."""
    keys = ["Appl_No", "Product_No"]
    p = patents.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct("Patent_No", regulatory_date(F.col("Patent_Expire_Date")).alias("expires")))).alias("patents"))
    e = exclusivities.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct("Exclusivity_Code", regulatory_date(F.col("Exclusivity_Date")).alias("expires")))).alias("exclusivities"))
    return products.join(p, keys, "left").join(e, keys, "left")


def typed_dates(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Several date columns as rows (key, kind, date); nulls are left out."""
    items = F.array(*[F.struct(F.lit(kind).alias("kind"), regulatory_date(F.col(c)).alias("date")) for c, kind in columns.items()])
    return df.select(key, F.inline(F.filter(items, lambda x: x["date"].isNotNull())))


def trial_ids_in(c: Column) -> Column:
    """All registry ids in a text."""
    return F.regexp_extract_all(c, F.lit(r"(NCT\d{8})"), 1)


def consolidated(*lists: Column) -> Column:
    """The union of lists, first spelling of each value, in order of the lists."""
    return distinct_without_case(F.flatten(F.array(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists])))


def primary_name(*preferred: Column) -> Column:
    """The alphabetically first name of the first list that has any."""
    return F.coalesce(*[F.array_min(F.filter(x, lambda v: v != "")) for x in preferred])


def first_date(dates: Column) -> Column:
    """The earliest date of nested lists of dates."""
    return F.array_min(F.filter(F.flatten(dates), lambda d: d.isNotNull()))


def packages(products: DataFrame) -> DataFrame:
    """One row per package of NDC products, with names, labeller and active ingredients as text."""
    p = products.select("product_ndc", "brand_name", "generic_name", "labeler_name", F.explode_outer("packaging").alias("k"), "active_ingredients")
    strength = F.transform("active_ingredients", lambda a: F.concat_ws(" ", a["name"], a["strength"]))
    return p.select("product_ndc", "brand_name", "generic_name", "labeler_name", F.col("k.package_ndc").alias("package_ndc"), F.col("k.description").alias("description"), F.array_join(strength, "; ").alias("ingredients"))


def licences(products: DataFrame) -> DataFrame:
    """Purple-book products: proprietary names as a list, and what a product may be exchanged for."""
    kind = F.lower(F.coalesce("BLA Type", F.lit("")))
    return products.select(
        F.trim("BLA Number").alias("bla_number"), F.trim("Proper Name").alias("proper_name"), split_list(F.col("Proprietary Name"), ",").alias("brand_names"), F.col("BLA Type").alias("bla_type"),
        F.when(kind.contains("interchangeable"), "Interchangeable").when(kind.contains("biosimilar") | kind.contains("351(k)"), "Biosimilar").when(kind == "", None).otherwise("Reference Product").alias("interchangeability"),
    )


def label_facts(labels: DataFrame) -> DataFrame:
    """The first text of each section of a label, its product codes with a prefix, and all registry ids in its studies."""
    first = lambda c: F.get(F.col(c), 0)
    return labels.select(
        "set_id", first("indications_and_usage").alias("indications"), first("mechanism_of_action").alias("mechanism"),
        F.transform("product_ndc", lambda x: F.concat(F.lit("NDC: "), x)).alias("products"), F.array_distinct(trial_ids_in(F.coalesce(F.array_join("clinical_studies", " "), F.lit("")))).alias("nct_ids"),
    )


def with_cross_names(rows: DataFrame, other: DataFrame, key: str, names: str) -> DataFrame:
    """Rows whose list of names also has those of the other source under the same number; only missing names are added."""
    one = other.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(names)))).alias("_more"))
    return rows.join(one, key, "left").withColumn(names, F.when(F.col("_more").isNull(), F.col(names)).otherwise(distinct_without_case(F.concat(names, "_more")))).drop("_more")


def coded(terms: DataFrame, term: str, codes: DataFrame, name: str, code: str) -> DataFrame:
    """Terms with the code of the dictionary entry of that name, else the term itself in title case."""
    one = codes.groupBy(F.lower(F.trim(name)).alias("_k")).agg(F.min(code).alias("code"))
    return terms.join(one, F.lower(F.trim(term)) == F.col("_k"), "left").select(*terms.columns, F.coalesce("code", F.initcap(F.col(term))).alias("code"))


def merged_rows(rows: DataFrame, row_id: str, names: str) -> DataFrame:
    """(row id, group): rows that share a name, directly or through others, have one group, their smallest row id as text."""
    from cohortloom.operators.components import synonym_groups

    exploded = rows.select(F.col(row_id).cast("string").alias("r"), F.explode(names).alias("n")).where(F.trim("n") != "")
    groups = synonym_groups(exploded.select(F.concat(F.lit("row "), "r").alias("a"), F.concat(F.lit("zname "), F.lower(F.trim("n"))).alias("b")))
    found = groups.where(F.col("name").startswith("row ")).select(F.expr("substring(name, 5)").alias("_r"), F.expr("substring(root, 5)").alias("group"))
    return rows.select(F.col(row_id), F.col(row_id).cast("string").alias("_r")).join(found, "_r", "left").select(row_id, F.coalesce("group", "_r").alias("group"))


def drug_rows(generics: DataFrame) -> DataFrame:
    """Drug-table rows from harmonised generics: clean aliases, sorted and distinct, as JSON text."""
    from cohortloom.functions.text import is_clean_alias

    pool = F.filter(F.flatten(F.array(F.array("generic_name"), F.coalesce("brand_names", F.array().cast("array<string>")), F.coalesce("synonyms", F.array().cast("array<string>")))), lambda a: is_clean_alias(a))
    return generics.select(F.lower("generic_name").alias("canonical_name"), "rxcui", F.to_json(F.array_sort(F.array_distinct(pool))).alias("aliases"))
