"""Drug names from HTML pages."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

_HEADING = re.compile(r"^drugs-approved-for-|^drug-combinations-")
_LINK = "/about-cancer/treatment/drugs/"


class _Anchors(HTMLParser):
    """(section id, link text) of the drug links below matching headings; neighbouring anchors of one link are joined."""

    def __init__(self) -> None:
        super().__init__()
        self.section, self.link, self.out, self.open = "", None, [], False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        if tag == "h2":
            self.section = a.get("id", "") if _HEADING.search(a.get("id") or "") else ""
            self.link = None
        elif tag == "a" and self.section and _LINK in (a.get("href") or ""):
            if a["href"] != self.link or not self.out:
                self.out.append([self.section, ""])
            self.link, self.open = a["href"], True
        elif tag in ("li", "p", "br"):
            self.link = None

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.open = False

    def handle_data(self, data: str) -> None:
        if self.open and self.out:
            self.out[-1][1] += data


def drug_names(html: str | None) -> list[tuple[str, str]]:
    """(name, kind) of a page in order, each once: brand or generic; combinations are split into generic names without salts."""
    from cohortloom.functions.text import BRAND_GENERIC, COMBINATION, SALTS

    parser = _Anchors()
    parser.feed(html or "")
    found: dict[tuple[str, str], None] = {}
    for section, raw in parser.out:
        text = re.sub(r"\s+", " ", unicodedata.normalize("NFKC", raw)).strip()
        if not re.search(r"[A-Za-z]", text):
            continue
        if section.startswith("drug-combinations"):
            for part in re.split(COMBINATION, text.lower()):
                if name := re.sub(SALTS, "", part).strip():
                    found.setdefault((name, "generic"))
            continue
        m = re.match(BRAND_GENERIC, text)
        names = [(m.group(1), "brand"), (m.group(2), "generic")] if m else [(text, "generic")]
        for name, kind in names:
            name = re.sub(SALTS, "", name.lower()).strip() if kind == "generic" else name.lower().strip()
            found.setdefault((name, kind))
    return list(found)


def page_drugs(pages: DataFrame) -> DataFrame:
    """(page_id, name, kind) for pages with ``page_id`` and ``html``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(i, n, k) for i, h in zip(pdf.page_id, pdf.html) for n, k in drug_names(h)]
            yield pd.DataFrame(rows, columns=["page_id", "name", "kind"])

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, name string, kind string")
