"""Text, HTML and URL column functions, all native expressions."""

from __future__ import annotations

from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tags whose boundaries are line breaks.
BLOCK_TAGS = "p div br li ul ol tr td th table h1 h2 h3 h4 h5 h6 section article header footer blockquote pre hr".split()
# What says that work is remote, and that it isn't.
REMOTE = r"(?iU)\b(?:fully[- ]remote|100% remote|work from home|remote[- ]first|remote \(|remote,|remote$|anywhere in the world|distributed team)\b"
ONSITE = r"(?iU)\b(?:on[- ]?site|in[- ]office|hybrid)\b"
# Marks of seniority in titles, tried in this order.
SENIORITY = (
    ("intern", r"(?iuU)\b(?:intern|internship|graduate trainee|attach[eé])\b"),
    ("junior", r"(?iuU)\b(?:junior|jr\.?|entry[- ]level|associate|graduate|trainee)\b"),
    ("lead", r"(?iuU)\b(?:lead|principal|staff|head of|director|vp|chief|architect)\b"),
    ("senior", r"(?iuU)\b(?:senior|snr\.?|sr\.?|experienced)\b"),
)


def unescape(text: Column) -> Column:
    """Entities written out once: all numeric ones, and the named ones of HTML 4 with `apos`; what is none stays."""
    names = F.create_map(*[F.lit(x) for n, c in sorted({**name2codepoint, "apos": 39}.items()) for x in (n, c)])
    digits = lambda p: F.regexp_extract(p, r"^#(\d{1,7});", 1)
    hexes = lambda p: F.regexp_extract(p, r"^#[xX]([0-9a-fA-F]{1,6});", 1)
    name = lambda p: F.regexp_extract(p, r"^([A-Za-z][A-Za-z0-9]{1,9});", 1)
    code = lambda p: F.coalesce(F.nullif(digits(p), F.lit("")).cast("int"), F.conv(F.nullif(hexes(p), F.lit("")), 16, 10).cast("int"), F.try_element_at(names, name(p)))
    real = lambda c: F.when(c.between(1, 0x10FFFF) & ~c.between(0xD800, 0xDFFF), c)
    sign = lambda c: F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32")
    put = lambda p: F.coalesce(F.concat(sign(real(code(p))), F.substring(p, F.instr(p, ";") + 1, F.length(p))), F.concat(F.lit("&"), p))
    parts = F.split(text, "&")
    return F.when(text.contains("&"), F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), put), ""))).otherwise(text)


def html_to_text(markup: Column) -> Column:
    """Readable text: escaped markup is unescaped first, scripts fall away, block tags break lines.

    Null and empty give the empty string; runs of blanks become one, of blank lines at most one.
    """
    m = F.coalesce(markup, F.lit(""))
    real = F.when(m.contains("&lt;") & ~m.contains("<"), unescape(m)).otherwise(m)
    seen = F.regexp_replace(real, r"(?is)<(script|style|noscript)\b[^>]*>.*?</\1\s*>|<!--.*?-->", "")
    broken = F.regexp_replace(seen, rf"(?i)</?(?:{'|'.join(BLOCK_TAGS)})\b[^>]*>", "\n")
    bare = unescape(F.regexp_replace(broken, r"<[a-zA-Z/!][^>]*>", ""))
    bare = F.regexp_replace(bare, "[​﻿]", "")
    lines = F.regexp_replace(F.regexp_replace(bare, "[ \\t\\x{A0}]+", " "), r"(?m)^ +| +$", "")
    return F.regexp_replace(F.regexp_replace(lines, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def sentences(text: Column) -> Column:
    """The sentences of a text: cut behind . ! ? with white space, and at line breaks; blank ones fall away."""
    parts = F.split(F.coalesce(text, F.lit("")), r"(?U)(?<=[.!?])\s+|\n+")
    return F.filter(F.transform(parts, lambda s: F.regexp_replace(s, r"(?U)^\s+|\s+$", "")), lambda s: s != "")


def infer_remote(*fields: Column) -> Column:
    """True, false or, where nothing is said, null."""
    said = F.concat_ws(" ", *[F.when(f != "", f) for f in fields])
    return F.when(F.trim(said) == "", None).when(said.rlike(REMOTE), True).when(said.rlike(ONSITE), False)


def infer_seniority(title: Column) -> Column:
    return reduce(lambda c, s: c.when(title.rlike(s[1]), s[0]), SENIORITY, F.when(title.isNull() | (title == ""), None))


def job_id(source: Column, native_id: Column) -> Column:
    """The first 16 hex digits of the sha1 of `source:native_id`."""
    return F.substring(F.sha1(F.concat(source, F.lit(":"), native_id)), 1, 16)


def dedupe_key(title: Column, company: Column) -> Column:
    """Title and company reduced to plain letters and digits, for finding copies across boards."""
    words = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), "[^a-z0-9 ]", " "), " +", " "))
    return F.concat(words, F.lit("|"), F.regexp_replace(F.lower(F.coalesce(company, F.lit(""))), "[^a-z0-9]", ""))


def url_domain(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))


def url_page(url: Column) -> Column:
    """The page a listing's address names, 1 where it names none."""
    n = F.regexp_extract(url, r"[?&]page=(\d{1,9})", 1)
    return F.when(n == "", 1).otherwise(F.when(n != "", n).cast("int"))


def url_canonical(url: Column) -> Column:
    """Without query, fragment and closing slash."""
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/+$", "")


def url_last_segment(url: Column) -> Column:
    return F.element_at(F.split(url_canonical(url), "/"), -1)


def first_of(value: Column) -> Column:
    """The first entry of a JSON text that is a list or a scalar."""
    entry = F.get(F.from_json(value, "array<string>"), F.lit(0))
    return F.when(value.startswith("["), entry).otherwise(value)


def as_amount(value: Column) -> Column:
    """A number; empty, zero and unreadable values are null."""
    return F.expr("1D") * F.nullif(value.try_cast("double"), F.lit(0.0))


def confirms(text: Column, name: str) -> Column:
    """Whether a text names a term as a word of its own; what stands in brackets in the name doesn't count."""
    import re

    bare = name.split("(")[0].strip()
    return text.rlike(rf"(?iuU)(?<!\w){re.escape(bare)}(?!\w)")
