"""Sections of drug labels, by rules on their lines."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the headings of a label that end a section
HEADINGS = [
    "FULL PRESCRIBING INFORMATION",
    "WARNING: SERIOUS INFECTIONS AND MALIGNANCY",
    "BOXED WARNING",
    "INDICATIONS AND USAGE",
    "DOSAGE AND ADMINISTRATION",
    "DOSAGE FORMS AND STRENGTHS",
    "CONTRAINDICATIONS",
    "WARNINGS AND PRECAUTIONS",
    "ADVERSE REACTIONS",
    "DRUG INTERACTIONS",
    "USE IN SPECIFIC POPULATIONS",
    "OVERDOSAGE",
    "DESCRIPTION",
    "CLINICAL PHARMACOLOGY",
    "NONCLINICAL TOXICOLOGY",
    "CLINICAL STUDIES",
    "REFERENCES",
    "HOW SUPPLIED/STORAGE AND HANDLING",
    "PATIENT COUNSELING INFORMATION",
]
#: Words in capitals behind a heading that are no name of a drug.
NO_NAMES = frozenset(["INDICATIONS", "USAGE", "DOSAGE", "ADMINISTRATION", "WARNINGS"])
#: Characters on each side of a heading in which a rule of repeated signs counts; signs behind it that only underline it.
NEAR, UNDERLINE = 50, 10
_RULE = re.compile(r"([-*=~_])\1{2,}")


def ends_section(line: str, numbered: bool, drug: str | None) -> bool:
    """Whether a line is a heading that ends a section: a known one, a numbered one of the top level, or, where the section itself has no number, a short line in capitals without the drug's name."""
    bare = line.strip()
    if re.sub(r"^[\d.\s]+", "", bare).upper().startswith(tuple(HEADINGS)):
        return True
    if re.match(r"\d+\.?\s+[A-Z]", bare):
        return "." not in bare.split()[0].rstrip(".")
    letters = re.sub(r"[\d.\s]", "", bare)
    return not numbered and letters.isupper() and 4 < len(letters) and len(bare) < 60 and not (drug and drug in bare)


def label_section(text: str | None, name: str = "INDICATIONS AND USAGE", least: int = 100) -> str | None:
    """The section under a heading, as one line; null if none has more than ``least`` characters.

    A heading beside a rule of repeated signs is closed by the next such rule; any other by the next line that
    ``ends_section``. Of several the first under a numbered heading holds, else the longest.
    """
    if not text:
        return None
    text = unicodedata.normalize("NFKD", text).replace("\r", "\n").replace("­", "").replace("•", "")
    best = ""
    for m in re.finditer(rf"(?:^|\n)[ \t]*(\d+\.?[ \t]*)?{re.escape(name)}", text, re.IGNORECASE):
        numbered, body = bool(m.group(1)), text[m.end() :]
        end = None
        if rule := _RULE.search(text[max(0, m.start() - NEAR) : m.end() + NEAR]):
            end = next((x.start() for x in re.finditer(re.escape(rule.group(1)) + "{3,}", body) if x.start() > UNDERLINE), None)
        if end is None:
            found = re.search(r"\b[A-Z]{3,}\b", body[:200])
            drug = found.group(0) if found and found.group(0) not in NO_NAMES else None
            lines, end = body.split("\n"), len(body)
            at = len(lines[0]) + 1
            for line in lines[1:]:
                if line.strip() and ends_section(line, numbered, drug):
                    end = at
                    break
                at += len(line) + 1
        section = " ".join(_RULE.sub(" ", body[:end]).split())
        if len(section) > least:
            if numbered:
                return section
            best = max(best, section, key=len)
    return best or None


def section_under(name: str = "INDICATIONS AND USAGE", least: int = 100) -> Callable[[Column], Column]:
    """``label_section`` as a function of a column, in Arrow batches."""

    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: label_section(x, name, least))

    return run
