"""Arrow-batched functions for what no built-in expresses: Unicode forms, section headers, injected models."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HIT = T.StructType(
    [
        T.StructField("has_population_restriction", T.BooleanType()), T.StructField("population", T.StringType()), T.StructField("is_inclusion_criterion", T.BooleanType()),
        T.StructField("evidence_span", T.StringType()), T.StructField("reasoning", T.StringType()),
    ]
)
_HEADER = re.compile(r"^\s*(?:\d+(?:\.\d+)*\s+)?[A-Z][A-Z /&,()'-]{3,}\s*:?\s*$")


@F.pandas_udf(T.StringType())
def compatible_lower(s: pd.Series) -> pd.Series:
    """Unicode compatibility form (NFKC), lower case, single spaces; null stays null."""
    return s.map(lambda x: None if x is None else re.sub(r"\s+", " ", unicodedata.normalize("NFKC", x).strip().lower()))


@F.pandas_udf(T.StringType())
def compatible_decomposed(s: pd.Series) -> pd.Series:
    """Compatibility decomposition (NFKD) in lower case with single spaces."""
    return s.map(lambda x: None if x is None else re.sub(r"\s+", " ", unicodedata.normalize("NFKD", x).strip().lower()))


def section_after(name: str, least: int = 100) -> Callable[[Column], Column]:
    """The longest section (more than ``least`` characters) under a header line with that name."""
    wanted = re.compile(rf"^\s*(?:\d+(?:\.\d+)*\s+)?{re.escape(name)}\b.*$", re.I)

    def longest(text: str | None) -> str | None:
        if not text:
            return None
        lines, best = text.split("\n"), ""
        for i, line in enumerate(lines):
            if not wanted.match(line):
                continue
            body = []
            for x in lines[i + 1 :]:
                if _HEADER.match(x) or re.match(r"^-{3,}", x):
                    break
                body.append(x)
            found = re.sub(r"\s+", " ", " ".join(body)).strip()
            best = max(best, found, key=len)
        return best if len(best) > least else None

    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(longest)

    return run


def no_restriction(text: str | None) -> dict:
    """The default model: nothing is found."""
    return {"has_population_restriction": False, "population": None, "is_inclusion_criterion": False, "evidence_span": None, "reasoning": None}


def population_model(model: Callable[[str | None], dict] = no_restriction) -> Callable[[Column], Column]:
    """An injected model over texts; a call that fails counts as nothing found."""

    def call(text: str | None) -> dict:
        try:
            return {**no_restriction(text), **model(text)}
        except Exception:  # noqa: BLE001 - any failure of the injected model is a negative hit
            return no_restriction(text)

    @F.pandas_udf(HIT)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([call(x) for x in s], columns=list(no_restriction(None)))

    return run


def with_model_cache(texts: DataFrame, cache: DataFrame, model: Callable[[str | None], dict] = no_restriction) -> DataFrame:
    """(nct_id, hit): cached results where there are any, the model only for the rest."""
    hit = F.struct(*HIT.fieldNames()).alias("hit")
    known = texts.select("nct_id").join(cache, "nct_id").select("nct_id", hit)
    missing = texts.join(cache.select("nct_id"), "nct_id", "left_anti").select("nct_id", population_model(model)(F.col("text")).alias("hit"))
    return known.unionByName(missing)


def batched_entities(names: DataFrame, infer: Callable[[list[str]], list[list[str]]], batch: int = 256) -> DataFrame:
    """(name, entities): a batch model over names, entities in order without repeats."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out: list[list[str]] = []
            for i in range(0, len(pdf), batch):
                out += [list(dict.fromkeys(e)) for e in infer(pdf.name.iloc[i : i + batch].tolist())]
            yield pd.DataFrame({"name": pdf.name.to_numpy(), "entities": out})

    return names.select("name").mapInPandas(run, "name string, entities array<string>")
