"""Job postings in the structured data of web pages: JSON-LD blocks, `@id` references, field rules."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from tidemark.runtime import spread

BLOCK = re.compile(r"<script[^>]+type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>", re.I | re.S)
CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")
MAX_HOPS = 5
FIELDS = "found boolean, title string, description string, company string, location string, applicant_location string, is_remote boolean, date_posted string, valid_through string, employment_type string, salary_min double, salary_max double, salary_currency string, industry string"


def blocks(page: str) -> list:
    """The parsed JSON-LD blocks of a page; control characters are tolerated, blocks that can't be read are skipped."""
    out = []
    for raw in BLOCK.findall(page or ""):
        for text in (raw, CONTROL.sub(" ", raw)):
            try:
                out.append(json.loads(text.strip(), strict=False))
                break
            except ValueError:
                continue
    return out


def nodes(value) -> Iterator[dict]:
    """All objects, outer before inner, in document order."""
    stack = [value]
    while stack:
        v = stack.pop()
        if isinstance(v, dict):
            yield v
            stack.extend(reversed(list(v.values())))
        elif isinstance(v, list):
            stack.extend(reversed(v))


def as_list(v) -> list:
    return v if isinstance(v, list) else [] if v is None else [v]


class Graph:
    """The objects of a page by `@id`; the first full definition of an id wins, bare references define nothing."""

    def __init__(self, parsed: list):
        self.all = list(nodes(parsed))
        self.by_id: dict[str, dict] = {}
        for n in self.all:
            if isinstance(n.get("@id"), str) and len(n) > 1:
                self.by_id.setdefault(n["@id"], n)

    def resolve(self, v):
        """What a reference stands for, after at most MAX_HOPS steps, so cycles end."""
        for _ in range(MAX_HOPS):
            if not (isinstance(v, dict) and set(v) == {"@id"} and v["@id"] in self.by_id):
                return v
            v = self.by_id[v["@id"]]
        return v

    def posting(self) -> dict | None:
        return next((n for n in self.all if "JobPosting" in as_list(n.get("@type"))), None)


def text_of(v) -> str | None:
    v = v.get("name") if isinstance(v, dict) else v
    return str(v).strip() or None if isinstance(v, (str, int, float)) and not isinstance(v, bool) else None


def organization(g: Graph, v) -> str | None:
    v = g.resolve(as_list(v)[0]) if as_list(v) else None
    return text_of(v) or (text_of(v.get("legalName")) if isinstance(v, dict) else None)


def place_text(g: Graph, v) -> str | None:
    """Locality, region and country of one or several places, each part once whatever its case."""
    parts: dict[str, str] = {}
    for p in map(g.resolve, as_list(v)):
        address = g.resolve(p.get("address")) if isinstance(p, dict) else p
        found = [address] if isinstance(address, str) else [text_of(g.resolve(address.get(k))) for k in ("addressLocality", "addressRegion", "addressCountry")] if isinstance(address, dict) else []
        for x in [f for f in found if f] or [text_of(p)]:
            if x:
                parts.setdefault(x.strip().lower(), x.strip())
    return ", ".join(parts.values()) or None


def amount(v) -> float | None:
    try:
        return float(str(v).replace(",", "")) or None if v is not None else None
    except ValueError:
        return None


def pay(g: Graph, v) -> tuple[float | None, float | None, str | None]:
    v = g.resolve(v)
    if not isinstance(v, dict):
        return None, None, None
    value = g.resolve(v.get("value"))
    inner = value if isinstance(value, dict) else {"value": value}
    exact = amount(inner.get("value"))
    low, high = amount(inner.get("minValue")), amount(inner.get("maxValue"))
    return low if low is not None else exact, high if high is not None else exact, text_of(v.get("currency")) or text_of(inner.get("currency"))


def parse_page(page: str | None) -> tuple:
    g = Graph(blocks(page or ""))
    p = g.posting()
    if p is None:
        return (False, *[None] * 13)
    remote = any("TELECOMMUTE" in str(x).upper() for x in as_list(p.get("jobLocationType")))
    where = place_text(g, p.get("jobLocation"))
    low, high, currency = pay(g, p.get("baseSalary"))
    first = lambda v: text_of(g.resolve(as_list(v)[0])) if as_list(v) else None
    return (
        True, first(p.get("title")), first(p.get("description")), organization(g, p.get("hiringOrganization")), where, place_text(g, p.get("applicantLocationRequirements")),
        True if remote else False if p.get("jobLocation") else None, first(p.get("datePosted")), first(p.get("validThrough")), first(p.get("employmentType")), low, high, currency, first(p.get("industry")),
    )


def parse_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The columns of `pages` without the page itself, and the posting's fields; `found` tells pages with one.

    The recursion over objects of any depth runs in Arrow batches; whatever a page holds, it gives one
    row. Null pages count as pages without posting.
    """
    kept = [c for c in pages.columns if c != html_col]
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = pd.DataFrame([parse_page(x if isinstance(x, str) else None) for x in pdf[html_col]], columns=names, index=pdf.index).astype({"is_remote": object})
            yield pd.concat([pdf[kept], got], axis=1)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name != html_col)
    return spread(pages).mapInPandas(run, f"{kinds}, {FIELDS}")
