"""All queries of the core, by name, with their SQL where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortloom.plans import agency_queries, data_processing, reference  # noqa: F401 - agency_queries adds to reference's tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**data_processing.QUERIES, **reference.QUERIES}
SQL: dict[str, str] = {**data_processing.SQL, **reference.SQL}
