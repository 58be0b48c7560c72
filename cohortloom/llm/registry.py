"""Queries of the subpackage, by name, with their SQL where one exists."""

from __future__ import annotations

from cohortloom.llm import canonical, components, linkage, packing, reading, tokens, variants
from cohortloom.session import table

QUERIES = {
    "p3_found": lambda spark, d: canonical.typed_products(table(spark, d, "clinical_trials"), table(spark, d, "harmonized_drug_queries"), table(spark, d, "drug_reference")).select("entered_value", "canonical_name"),
    "p3_candidates": lambda spark, d: canonical.typed_products(table(spark, d, "clinical_trials"), table(spark, d, "harmonized_drug_queries"), table(spark, d, "drug_reference"), every=True),
    "p4_found": lambda spark, d: linkage.matched_pairs(table(spark, d, "enriched_trials"), table(spark, d, "drug_reference"), calibrate=False).select("trial_id_a", "trial_id_b"),
    "p4_confidence": lambda spark, d: linkage.matched_pairs(table(spark, d, "enriched_trials"), table(spark, d, "drug_reference")),
    "p5_found": lambda spark, d: variants.sponsor_pairs(table(spark, d, "enriched_trials")),
    "p6_found": lambda spark, d: components.mention_groups(table(spark, d, "trial_interventions"), table(spark, d, "intervention_links")),
    "p7_ids": lambda spark, d: tokens.token_ids(table(spark, d, "documents")),
    "p8_windows": lambda spark, d: packing.packed_windows(table(spark, d, "documents"), table(spark, d, "context_windows")),
    "p8_fill": lambda spark, d: packing.fill_report(packing.packed_windows(table(spark, d, "documents"), table(spark, d, "context_windows")), table(spark, d, "context_windows")),
    "p9_found": lambda spark, d: reading.reading_levels(table(spark, d, "documents"), table(spark, d, "reading_labels")).select("doc_id", "reading_level"),
    "p9_profile": lambda spark, d: reading.reading_levels(table(spark, d, "documents"), table(spark, d, "reading_labels")),
}

SQL = {
    "p6_found": """
WITH RECURSIVE l AS (SELECT name_id_a AS a, name_id_b AS b FROM intervention_links WHERE is_match),
ids AS (SELECT name_id AS id FROM trial_interventions WHERE name_id IS NOT NULL UNION SELECT a FROM l WHERE a IS NOT NULL UNION SELECT b FROM l WHERE b IS NOT NULL),
e AS (SELECT a, b FROM l WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM l WHERE a IS NOT NULL AND b IS NOT NULL),
r AS (SELECT id, id AS other FROM ids UNION SELECT r.id, e.b FROM r JOIN e ON r.other = e.a)
SELECT id AS name_id, min(other) AS group_id FROM r GROUP BY id""",
}
