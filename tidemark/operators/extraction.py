"""Taxonomy terms in text: regex-guarded, vetoed sentence by sentence."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.runtime import spread

PLAIN = re.compile(r"\\b((?:[a-z0-9 +#./-]|\\[+#./-])+?)(?:\\b)?", re.I)
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
FIELDS = "skill string, canonical_name string, category string, track string, n_mentions int, matched_in string, evidence array<string>, confirmed boolean"


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of skill, canonical_name, category, track, match_pattern, negative_context, is_diffusion_baseline, notes.

    Rows without skill or pattern are skipped; the canonical name is the skill unless given, in lower
    case; a pattern that doesn't compile raises an error with its line.
    """
    rows = spark.read.csv(path, header=True, escape='"', multiLine=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    rows = rows.where("skill <> '' and match_pattern <> ''")
    check_patterns(rows, path)
    flag = F.lower(F.coalesce("is_diffusion_baseline", F.lit(""))).isin("1", "true", "yes")
    return rows.withColumn("canonical_name", F.lower(F.coalesce("canonical_name", "skill"))).withColumn("is_diffusion_baseline", flag)


def check_patterns(taxonomy: DataFrame, where: str = "taxonomy") -> list:
    """The rows of a taxonomy, a curated table of some hundred terms, with their patterns checked."""
    rows = taxonomy.collect()
    for i, r in enumerate(rows, 2):
        for p in (r.match_pattern, r.negative_context):
            try:
                re.compile(p or "")
            except re.error as e:
                raise ValueError(f"{where}:{i}: pattern {p!r} of {r.skill}: {e}") from e
    return rows


class Term:
    """One term of the taxonomy with its compiled patterns."""

    def __init__(self, row):
        self.row = tuple(row[c] for c in ("skill", "canonical_name", "category", "track"))
        self.match = re.compile(row.match_pattern, re.I)
        self.veto = re.compile(row.negative_context, re.I) if row.negative_context else None
        plain = PLAIN.fullmatch(row.match_pattern)
        #: A word that any match contains; texts without it need no search.
        self.own = re.compile(rf"(?<!\w){re.escape(row.skill.split('(')[0].strip())}(?!\w)", re.I)
        self.word = plain.group(1).replace("\\", "").lower() if plain else ""

    def count(self, text: str, lower: str, cut) -> tuple[int, list[str]]:
        """Matches in the sentences without veto, and those sentences; none if the whole text has no match."""
        if self.word not in lower or not self.match.search(text):
            return 0, []
        n, seen = 0, []
        for s in cut():
            if self.veto and self.veto.search(s):
                continue
            k = sum(1 for _ in self.match.finditer(s))
            if k:
                n += k
                seen.append(s.strip()[:200])
        return n, seen


def terms_in(terms: list[Term], title: str | None, body: str | None) -> list[tuple]:
    out, cuts = [], {}

    def cut(text: str):
        if text not in cuts:
            cuts[text] = [s.strip() for s in SENTENCE.split(text) if s.strip()]
        return cuts[text]

    title, body = title or "", body or ""
    low_title, low_body = title.lower(), body.lower()
    for t in terms:
        a, ea = t.count(title, low_title, lambda: cut(title))
        b, eb = t.count(body, low_body, lambda: cut(body))
        if a + b:
            out.append((*t.row, a + b, "both" if a and b else "title" if a else "description", (ea + eb)[:3], bool(t.own.search(f"{title} {body}"))))
    return out


def extract_terms(docs: DataFrame, taxonomy: DataFrame, id_col: str, title_col: str | None, body_col: str) -> DataFrame:
    """(id, skill, canonical_name, category, track, n_mentions, matched_in, evidence, confirmed): the terms of each document.

    One pass over whole texts in Arrow batches; the taxonomy, a curated table, goes to the tasks. A
    term counts in a field if the whole field matches and sentences without veto do; null and empty
    fields hold none. `confirmed` says whether title and whole text name the term itself as a word of its own. A document without terms gives no row.
    """
    rows = check_patterns(taxonomy)
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = [Term(r) for r in rows]
        names = [id_col, *[f.split()[0] for f in FIELDS.split(", ")]]
        for pdf in batches:
            titles = pdf["title"] if title_col else [None] * len(pdf)
            yield pd.DataFrame([(i, *x) for i, t, b in zip(pdf[id_col], titles, pdf["body"], strict=True) for x in terms_in(terms, t, b)], columns=names)

    chosen = docs.select(id_col, *([F.col(title_col).alias("title")] if title_col else []), F.col(body_col).alias("body"))
    return spread(chosen).mapInPandas(run, f"{id_col} {kind}, {FIELDS}")


def extraction_stats(docs: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """(jobs, jobs_with_skills, matches, coverage): coverage is 0 for no documents."""
    a = docs.agg(F.count("*").alias("jobs"))
    b = found.agg(F.countDistinct(id_col).alias("jobs_with_skills"), F.count("*").alias("matches"))
    return a.crossJoin(F.broadcast(b)).withColumn("coverage", F.round(F.coalesce(F.try_divide("jobs_with_skills", "jobs"), F.lit(0.0)), 4))


def precision_gate(found: DataFrame, segment: str, gate: float = 0.90) -> DataFrame:
    """By segment: matches, those whose document names the term as a word of its own, that lower bound of precision, and whether it passes."""
    by = found.groupBy(segment).agg(F.count("*").alias("matches"), F.count_if("confirmed").alias("confirmed"))
    return by.withColumn("precision", F.try_divide("confirmed", "matches")).withColumn("passes", F.col("precision") >= gate).orderBy(segment)


def suspects(found: DataFrame, segment: str, n: int = 8) -> DataFrame:
    """(segment, place, skill, n): the terms with most unconfirmed matches in each segment; a report of `n` rows a segment."""
    by = found.where(~F.col("confirmed")).groupBy(segment, "skill").agg(F.count("*").alias("n"))
    placed = by.withColumn("place", F.row_number().over(W.partitionBy(segment).orderBy(F.desc("n"), "skill")))
    return placed.where(F.col("place") <= n).select(segment, "place", "skill", "n").orderBy(segment, "place")


def read_diffusion(spark: SparkSession, path: str) -> DataFrame:
    """An exported diffusion frame, read again with its types."""
    schema = "skill string, track string, category string, lead_share_now double, follow_share_now double, diffusion_gap double, calibrated_gap double, gap_rank double, lead_trend_12m double, follow_trend_12m double, estimated_lag_months double, status string, confidence string, is_calibration_baseline boolean, months_observed bigint, cell_usable boolean"
    return spark.read.schema(schema).csv(path, header=True, escape='"', multiLine=True)
