"""Facts from the records of drug agencies and vocabularies: applications, products, biologics, concepts, labels, events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.text import regulatory_date
from cohortloom.operators.dedup import keep_first
from cohortloom.operators.harmonize import split_list

_TEXTS = "array<string>"


def _none() -> Column:
    return F.array().cast(_TEXTS)


def _one(c: str | Column) -> Column:
    """A value as a list of at most one; null and empty values are none."""
    return F.array((F.col(c) if isinstance(c, str) else c).cast("string"))


def _of(items: str, field: str) -> Column:
    return F.transform(F.col(items), lambda x: x[field].cast("string"))


def facts(records: DataFrame, key: str, **fields: Column) -> DataFrame:
    """One row for each key, with the distinct non-empty values of each field over all its records, sorted.

    Values are made distinct before they meet, so a key with very many records is combined map-side; a record
    without key is left out, and a key without any value keeps empty lists.
    """

    def named(n: str, c: Column) -> Column:
        kept = F.filter(F.coalesce(c, _none()), lambda x: F.coalesce(F.trim(x) != "", F.lit(False)))
        return F.transform(kept, lambda x: F.struct(F.lit(n).alias("n"), x.alias("v")))

    values = [named(n, c) for n, c in fields.items()]
    empty = F.array(F.struct(F.lit(None).cast("string").alias("n"), F.lit(None).cast("string").alias("v")))
    tall = records.where(F.col(key).isNotNull()).select(key, F.explode(F.concat(empty, *values)).alias("x")).select(key, "x.n", "x.v").distinct()
    return tall.groupBy(key).agg(*[F.array_sort(F.collect_list(F.when(F.col("n") == n, F.col("v")))).alias(n) for n in fields])


def _with_strength(items: Column) -> Column:
    return F.transform(F.filter(items, lambda i: F.coalesce(i["name"] != "", F.lit(False))), lambda i: F.concat(i["name"], F.when(F.coalesce(i["strength"], F.lit("")) != "", F.concat(F.lit(" ("), i["strength"], F.lit(")"))).otherwise("")))


def application_facts(applications: DataFrame, key: str) -> DataFrame:
    """The names, identifiers, classes, products and ingredients of the applications of each key."""
    o = lambda f: F.col(f"openfda.{f}").cast(_TEXTS)
    ingredients = F.flatten(F.transform("products", lambda p: F.coalesce(p["active_ingredients"], F.array().cast("array<struct<name:string,strength:string>>"))))
    return facts(
        applications, key,
        application_numbers=_one("application_number"), sponsor_name=_one("sponsor_name"), generic_names=o("generic_name"),
        brand_names=F.concat(F.coalesce(o("brand_name"), _none()), F.coalesce(_of("products", "brand_name"), _none())), substance_names=o("substance_name"), unii_codes=o("unii"), rxcui_codes=o("rxcui"),
        spl_set_ids=o("spl_set_id"), ndc_codes=o("product_ndc"), pharmacological_class=F.concat(F.coalesce(o("pharm_class_epc"), _none()), F.coalesce(o("pharm_class_cs"), _none())),
        mechanism_of_action=o("pharm_class_moa"), physiologic_effect=o("pharm_class_pe"), route=F.concat(F.coalesce(o("route"), _none()), F.coalesce(_of("products", "route"), _none())), manufacturers=o("manufacturer_name"),
        active_ingredients=_with_strength(ingredients), strength=F.transform(ingredients, lambda i: i["strength"]), dosage_form=_of("products", "dosage_form"), marketing_status=_of("products", "marketing_status"),
        reference_listed_drug=_of("products", "reference_drug"), therapeutic_equivalence=_of("products", "te_code"), application_type=_of("submissions", "submission_class_code"),
    )


def application_history(applications: DataFrame) -> DataFrame:
    """One row for each event (date, type, number) of an application, its dates in ISO form; undated submissions are none.

    Of repeats that differ in the rest the first by its values holds.
    """
    s = applications.where("application_number is not null").select("application_number", F.posexplode("submissions").alias("pos", "s"))
    events = s.select("application_number", regulatory_date(F.col("s.submission_status_date")).alias("date"), F.col("s.submission_type").alias("submission_type"), F.col("s.submission_number").alias("submission_number"), F.col("s.submission_status").alias("submission_status"), F.col("s.submission_class_code").alias("submission_class_code"), F.col("s.review_priority").alias("review_priority"), "pos")
    return keep_first(events.where("date is not null"), ["application_number", "date", "submission_type", "submission_number"], ["pos", "submission_status", "submission_class_code", "review_priority"]).drop("pos")


def product_facts(products: DataFrame, key: str) -> DataFrame:
    """The codes, packages, names, makers and ingredients of the product listings of each key."""
    o = lambda f: F.coalesce(F.col(f"openfda.{f}").cast(_TEXTS), _none())
    return facts(
        products, key,
        ndc_codes=F.concat(_one("product_ndc"), o("product_ndc")), ndc_package_codes=_of("packaging", "package_ndc"), packaging_info=_of("packaging", "description"),
        generic_names=F.concat(o("generic_name"), _one("generic_name")), brand_names=F.concat(o("brand_name"), _one("brand_name")), substance_names=_one("substance_name"), labelers=_one("labeler_name"),
        manufacturers=o("manufacturer_name"), dosage_form=_one("dosage_form"), route=o("route"), unii_codes=o("unii"), rxcui_codes=o("rxcui"), spl_set_ids=o("spl_set_id"), dea_schedule=_one("dea_schedule"),
        product_type=_one("product_type"), application_type=_one("marketing_category"), finished_status=_one("finished"), listing_expiration_dates=_one("listing_expiration_date"),
        active_ingredients=_with_strength(F.col("active_ingredients")), strength=_of("active_ingredients", "strength"),
        pharmacological_class=F.concat(o("pharm_class_epc"), o("pharm_class_cs")), mechanism_of_action=o("pharm_class_moa"), physiologic_effect=o("pharm_class_pe"),
    )


#: fixed values: the four exclusivity columns of a biologic and what each is called
EXCLUSIVITIES = {
    "Exclusivity Expiration Date": "General Exclusivity", "First Interchangeable Exclusivity Exp. Date": "First Interchangeable Exclusivity",
    "Ref. Product Exclusivity Exp. Date": "Reference Product Exclusivity", "Orphan Exclusivity Exp. Date": "Orphan Exclusivity",
}


def biologic_facts(biologics: DataFrame, key: str) -> DataFrame:
    """The numbers, names, forms, states and reference products of the biologics of each key."""
    c = lambda n: F.col(f"`{n}`")
    kind = F.coalesce(c("BLA Type"), F.lit(""))
    reference = F.concat_ws(", ", F.when(c("Ref. Product Proper Name") != "", F.concat(F.lit("Proper: "), c("Ref. Product Proper Name"))), F.when(c("Ref. Product Proprietary Name") != "", F.concat(F.lit("Proprietary: "), c("Ref. Product Proprietary Name"))))
    similar = F.when(F.contains(kind, F.lit("351(k) Interchangeable")), "Interchangeable").when(F.contains(kind, F.lit("351(k) Biosimilar")), "Biosimilar (Not Interchangeable)")
    first = F.when(F.coalesce(c("First Interchangeable Exclusivity Exp. Date"), F.lit("")) != "", "First Interchangeable")
    return facts(
        biologics, key,
        bla_numbers=_one(c("BLA Number")), generic_names=_one(c("Proper Name")), brand_names=split_list(c("Proprietary Name"), ","), applicants=_one(c("Applicant")), bla_type=_one(c("BLA Type")), application_type=_one(c("BLA Type")),
        strength=_one(c("Strength")), dosage_form=_one(c("Dosage Form")), route=_one(c("Route of Administration")), packaging_info=_one(c("Product Presentation")), marketing_status=_one(c("Marketing Status")),
        licensure_status=_one(c("Licensure")), reference_product=_one(reference), license_number=_one(c("License Number")), center=_one(c("Center")), date_of_first_licensure=_one(c("Date of First Licensure")),
        interchangeability=F.array(similar, first),
    )


def exclusivities(biologics: DataFrame, key: str) -> DataFrame:
    """(key, type, expiration_date): the exclusivity dates of each biologic as rows; empty ones give none."""
    rows = F.array(*[F.struct(F.lit(name).alias("type"), F.col(f"`{column}`").alias("expiration_date")) for column, name in EXCLUSIVITIES.items()])
    return biologics.select(key, F.explode(rows).alias("x")).select(key, "x.*").where("expiration_date is not null and expiration_date <> ''").distinct()


# ---------------------------------------------------------------- vocabularies and searches


def concepts_of_names(names: DataFrame, concepts: DataFrame) -> DataFrame:
    """(query, rxcui, name, synonym, tty, language, suppress): the concepts under each name without case, with their properties.

    ``concepts`` has rxcui, name, synonym, tty, language and suppress. A property that is missing has its default;
    of repeated rows of a concept the preferred term is the first by its values.
    """
    q = names.select("query", F.lower(F.trim("query")).alias("_k")).where("_k <> ''").distinct()
    ids = concepts.select(F.lower(F.trim("name")).alias("_k"), "rxcui").where("rxcui is not null").distinct()
    text = lambda c, d="": F.coalesce(F.col(c), F.lit(d)).alias(c)
    cols = ["name", "synonym", "tty", "language", "suppress"]
    one = keep_first(concepts.where("rxcui is not null").select("rxcui", *cols), ["rxcui"], cols)
    return q.join(ids, "_k").join(one, "rxcui").select("query", "rxcui", text("name"), text("synonym"), text("tty"), text("language", "ENG"), text("suppress", "N"))


#: fixed values: the term types of brands and of ingredients
BRAND_TYPES, INGREDIENT_TYPES = ("BN", "SBD", "BPCK"), ("IN",)


def concept_details(concepts: DataFrame, relations: DataFrame) -> DataFrame:
    """rxcui, name, brand_names, ingredients, synonyms, ndc_codes and atc_codes of each concept.

    ``relations`` has rxcui, kind (related, ndc or ATC), tty and value. Brands and ingredients are related values of
    their term types, synonyms all related values; lists are distinct and sorted, empty where there is nothing.
    """
    kind, tty, value = F.col("kind"), F.col("tty"), F.col("value")
    pick = lambda cond: F.array(F.when(cond, value))
    found = facts(
        relations, "rxcui", brand_names=pick((kind == "related") & tty.isin(*BRAND_TYPES)), ingredients=pick((kind == "related") & tty.isin(*INGREDIENT_TYPES)), synonyms=pick(kind == "related"), ndc_codes=pick(kind == "ndc"), atc_codes=pick(kind == "ATC")
    )
    one = keep_first(concepts.where("rxcui is not null").select("rxcui", "name"), ["rxcui"], ["name"])
    lists = ["brand_names", "ingredients", "synonyms", "ndc_codes", "atc_codes"]
    return one.join(found, "rxcui", "left").select("rxcui", "name", *[F.coalesce(c, _none()).alias(c) for c in lists])


def parsed_products(products: DataFrame) -> DataFrame:
    """The listing of each product_ndc (the first by its values), its own fields first and those of ``openfda`` where they are empty."""
    first = lambda f: F.try_element_at(F.col(f"openfda.{f}").cast(_TEXTS), F.lit(1))
    own = lambda f: F.coalesce(F.nullif(F.col(f), F.lit("")), first(f), F.lit("")).alias(f)
    out = products.where("product_ndc is not null and product_ndc <> ''").select("product_ndc", first("application_number").alias("application_number"), own("brand_name"), own("generic_name"), first("manufacturer_name").alias("manufacturer_name"), own("dosage_form"))
    return keep_first(out, ["product_ndc"], [c for c in out.columns if c != "product_ndc"])


def products_of_names(names: DataFrame, products: DataFrame, limit: int = 10) -> DataFrame:
    """(query, product_ndc): listings whose brand or generic name is the query without case, each once, the first ``limit`` by code."""
    q = names.select("query", F.lower(F.trim("query")).alias("_k")).where("_k <> ''").distinct()
    p = products.select("product_ndc", F.explode(F.array_distinct(F.array(F.lower(F.trim("brand_name")), F.lower(F.trim("generic_name"))))).alias("_k")).where("_k <> ''")
    met = q.join(p, "_k").groupBy("query").agg(F.slice(F.array_sort(F.collect_set("product_ndc")), 1, limit).alias("l"))
    return met.select("query", F.explode("l").alias("product_ndc"))


def event_counts(reports: DataFrame, drug: str, limit: int = 100) -> DataFrame:
    """(term, n): the most frequent event terms of the reports that name a drug as brand or generic, without case."""
    named = F.exists(F.concat(F.coalesce("brand_name", _none()), F.coalesce("generic_name", _none())), lambda x: F.lower(x) == drug.lower())
    terms = reports.where(named).select(F.explode("terms").alias("term")).where("term <> ''")
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "term").limit(limit)


def substances(names: DataFrame, register: DataFrame) -> DataFrame:
    """(query, unii): substances whose name or synonym is the query without case."""
    q = names.select("query", F.lower(F.trim("query")).alias("_k")).where("_k <> ''").distinct()
    r = register.select("unii", F.explode(F.concat(F.array("name"), F.coalesce("synonyms", _none()))).alias("s")).select("unii", F.lower(F.trim("s")).alias("_k")).where("_k <> ''")
    return q.join(r, "_k").select("query", "unii").distinct()


def terms_with(labels: DataFrame, text: str) -> DataFrame:
    """(term, n): the event terms of labels that contain a text without case, with the number of labels that have them."""
    t = labels.select("label_id", F.explode("terms").alias("term")).where(F.contains(F.lower("term"), F.lit(text.lower())))
    return t.distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def terms_of_drug(labels: DataFrame, drug: str) -> DataFrame:
    """The distinct event terms of the labels that name a drug without case."""
    return labels.where(F.exists("names", lambda x: F.lower(x) == drug.lower())).select(F.explode("terms").alias("term")).where("term <> ''").distinct()


