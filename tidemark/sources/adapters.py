"""Payloads of job boards to postings: one projection a payload shape, in a registry.

A payload is a row of url, source, segment, body (JSON text), fetched_at. Each adapter gives rows of
POSTING. Malformed bodies give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.sources import jsonld

POSTING = "source segment native_id url title description_html company location is_remote date_posted valid_through employment_type salary_min salary_max salary_currency industry department fetched_at is_historical extra".split()
REGISTRY: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {}
MIN_COMMENT = 80


def register(name: str, segment: str):
    """Put an adapter into the registry under its board's name."""

    def add(f):
        REGISTRY[name] = (segment, f)
        return f

    return add


def names(segment: str | None = None) -> list[str]:
    """The registered boards, of one segment whatever its case, or all."""
    return sorted(n for n, (s, _) in REGISTRY.items() if segment is None or s.lower() == segment.lower())


def resolve(asked: str, enabled: set[str] | None = None) -> list[str]:
    """Boards for a list of names or segments (ke, kenya, global, region) between commas; unknown ones are an error."""
    out: list[str] = []
    for part in filter(None, (p.strip().lower() for p in asked.split(","))):
        segment = {"ke": "KE", "kenya": "KE", "global": "GLOBAL", "region": "REGION"}.get(part)
        found = names(segment) if segment else [part] if part in REGISTRY else None
        if found is None:
            raise ValueError(f"unknown source {part!r}")
        out += [n for n in found if enabled is None or n in enabled]
    return list(dict.fromkeys(out))


def posting(df: DataFrame, **columns: Column) -> DataFrame:
    """Rows of POSTING; columns not given are null. Rows without native id or title are dropped."""
    null = {"is_remote": "boolean", "salary_min": "double", "salary_max": "double", "is_historical": "boolean", "fetched_at": "timestamp"}
    base = {"source": F.col("source"), "segment": F.col("segment"), "fetched_at": F.col("fetched_at"), "is_historical": F.lit(False), "url": F.col("url")} | columns
    out = df.select(*[(base[c] if c in base else F.lit(None).cast(null.get(c, "string"))).alias(c) for c in POSTING])
    return out.where("native_id is not null and native_id <> '' and title is not null and title <> ''")


def entries(payloads: DataFrame, schema: str, key: str = "jobs") -> DataFrame:
    """One row an entry `j` of the payload's list, which is the body itself or stands under `key`."""
    many = f"array<struct<{schema}>>"
    bare = F.from_json("body", many, {"mode": "PERMISSIVE"})
    under = F.get(F.from_json("body", f"struct<`{key}`: {many}>", {"mode": "PERMISSIVE"})[key], F.lit(0))
    is_list = F.ltrim(F.col("body")).startswith("[")
    rows = F.when(is_list, bare).when(under.isNotNull(), F.from_json("body", f"struct<`{key}`: {many}>", {"mode": "PERMISSIVE"})[key])
    return payloads.withColumn("j", F.explode(rows)).where("j is not null")


def j(path: str) -> Column:
    return F.col(f"j.{path}")


def nonempty(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


@register("leafboard", "GLOBAL")
def ats_board_a(payloads: DataFrame) -> DataFrame:
    """A board API with nested offices and departments; the first date wins over the update, the name over the slug."""
    schema = "id: string, title: string, absolute_url: string, location: struct<name: string>, content: string, first_published: string, updated_at: string, company_name: string, departments: array<struct<name: string>>, offices: array<struct<name: string>>"
    rows = entries(payloads, schema)
    slug = F.regexp_extract("url", r"/boards/([^/?]+)", 1)
    departments = F.filter(F.transform(F.coalesce(j("departments"), F.array().cast("array<struct<name:string>>")), lambda d: nonempty(d["name"])), lambda d: d.isNotNull())
    return posting(
        rows, native_id=j("id"), url=F.coalesce(j("absolute_url"), F.col("url")), title=F.trim(j("title")), description_html=F.coalesce(j("content"), F.lit("")), company=F.coalesce(nonempty(j("company_name")), nonempty(slug)),
        location=j("location.name"), is_remote=T.infer_remote(j("location.name"), j("title")), date_posted=F.coalesce(j("first_published"), j("updated_at")), department=F.get(departments, F.lit(0)),
        extra=F.to_json(F.struct(slug.alias("slug"), departments.alias("departments"), F.transform(j("offices"), lambda o: o["name"]).alias("offices"), j("updated_at").alias("updated_at"))),
    )


@register("stackhire", "GLOBAL")
def ats_board_b(payloads: DataFrame) -> DataFrame:
    """A board API with flags: only an explicit `isListed: false` hides a posting, `isRemote` wins over what the text says."""
    schema = "id: string, title: string, location: string, isRemote: boolean, isListed: boolean, workplaceType: string, publishedAt: string, employmentType: string, department: string, team: string, jobUrl: string, descriptionHtml: string, descriptionPlain: string"
    rows = entries(payloads, schema).where("not (j.isListed <=> false)")
    return posting(
        rows, native_id=j("id"), url=F.coalesce(j("jobUrl"), F.col("url")), title=F.trim(j("title")), description_html=F.coalesce(j("descriptionHtml"), j("descriptionPlain"), F.lit("")), company=nonempty(F.regexp_extract("url", r"/board/([^/?]+)", 1)),
        location=j("location"), is_remote=F.coalesce(j("isRemote"), T.infer_remote(j("location"), j("workplaceType"), j("title"))), date_posted=j("publishedAt"), employment_type=j("employmentType"), department=F.coalesce(j("department"), j("team")),
    )


def header_parts(header: Column) -> tuple[Column, Column, Column, Column]:
    """(company, title, location, employment type) of a header line with fields between bars; null where it has no bar.

    A field is taken as the employment type if it is the first that looks like one, else as the
    location if it is the first that does.
    """
    barred = header.contains("|")
    parts = F.transform(F.split(header, r"\|"), lambda p: F.trim(p))
    rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    bad = lambda c, n: (c == "") | (F.length(c) > n) | F.lower(c).startswith("http")
    company, title = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    job, place = r"(?i)\b(full[- ]?time|part[- ]?time|contract|intern|freelance)\b", r"(?i)\b(remote|onsite|on-site|hybrid)\b|,\s*[A-Z]{2}\b"
    found = F.aggregate(
        rest, F.struct(F.lit(None).cast("string").alias("job"), F.lit(None).cast("string").alias("place")),
        lambda a, p: F.when(a["job"].isNull() & p.rlike(job), F.struct(p.alias("job"), a["place"].alias("place"))).when(a["place"].isNull() & p.rlike(place), F.struct(a["job"].alias("job"), p.alias("place"))).otherwise(a),
    )
    on = lambda c: F.when(barred, c)
    return on(F.when(~bad(company, 80), company)), on(F.when(~bad(title, 120), title)), on(found["place"]), on(found["job"])


# Titles of threads in which firms hire, and of those in which people offer themselves.
HIRING, OFFERING = r"(?i)who\s+is\s+hiring", r"(?i)wants?\s+to\s+be\s+hired|freelancer"


def is_hiring_thread(title: Column) -> Column:
    return title.rlike(HIRING) & ~title.rlike(OFFERING)


def thread_urls(search: DataFrame, since: str) -> DataFrame:
    """(url, month) of the monthly hiring threads from `since` (YYYY-MM) on, in order; rows of id, title, created_at."""
    month = F.substring("created_at", 1, 7)
    return search.where(is_hiring_thread(F.col("title")) & (month >= since)).select(F.concat(F.lit("items/"), "id").alias("url"), month.alias("month")).distinct().orderBy("month", "url")


@register("threadwork", "GLOBAL")
def monthly_threads(payloads: DataFrame) -> DataFrame:
    """A thread with one comment a posting, unless people offer themselves in it: top-level comments of at least MIN_COMMENT characters, their first line a header."""
    schema = "struct<id: string, title: string, created_at: string, children: array<struct<id: string, author: string, created_at: string, created_at_i: bigint, text: string>>>"
    rows = payloads.withColumn("t", F.from_json("body", schema)).where(~F.coalesce(F.col("t.title").rlike(OFFERING), F.lit(False))).withColumn("j", F.explode("t.children"))
    rows = rows.withColumn("plain", T.html_to_text(j("text"))).where(F.length("plain") >= MIN_COMMENT).withColumn("header", F.substring_index("plain", "\n", 1))
    company, title, place, job = header_parts(F.col("header"))
    said = F.concat_ws(" ", "header", place)
    remote = F.when(said.rlike(r"(?i)\bremote\b"), True).otherwise(F.coalesce(T.infer_remote(F.col("header"), place), F.when(said.rlike(r"(?i)\b(onsite|on-site|in[- ]office)\b"), False)))
    return posting(
        rows, native_id=j("id"), title=F.coalesce(title, company, F.lit("Unspecified role")), description_html=j("text"), company=company, location=place, is_remote=remote, date_posted=F.coalesce(j("created_at"), j("created_at_i").cast("string"), F.col("t.created_at")), employment_type=job,
        extra=F.to_json(F.struct(F.substring("t.created_at", 1, 7).alias("thread_month"), j("author").alias("author"), F.substring("header", 1, 300).alias("header"))),
    )


#: Remote boards: list key and the payload's name of each field; a name with * is a list or scalar, of which the first counts.
REMOTE_BOARDS = {
    "farposts": ("jobs", {"native_id": "id", "url": "url", "title": "title", "description_html": "description", "company": "company_name", "location": "candidate_required_location", "date_posted": "publication_date", "employment_type": "job_type", "industry": "category"}),
    "isleroles": ("data", {"native_id": "slug", "url": "url", "title": "title", "description_html": "description", "company": "company_name", "location": "location", "date_posted": "created_at", "employment_type": "job_types*", "is_remote": "remote"}),
    "reefjobs": ("jobs", {"native_id": "id", "url": "url", "title": "jobTitle", "description_html": "jobDescription", "company": "companyName", "location": "jobGeo", "date_posted": "pubDate", "employment_type": "jobType*", "industry": "jobIndustry*", "salary_min": "salaryMin", "salary_max": "salaryMax", "salary_currency": "salaryCurrency"}),
    "lagoonwork": ("jobs", {"native_id": "guid", "url": "applicationLink", "title": "title", "description_html": "description", "company": "companyName", "location": "locationRestrictions+", "date_posted": "pubDate", "valid_through": "expiryDate", "employment_type": "employmentType", "salary_min": "minSalary", "salary_max": "maxSalary", "salary_currency": "currency"}),
}


#: What else a remote board sends: our name and the payload's.
REMOTE_EXTRA = {"farposts": {"tags": "tags", "salary_text": "salary"}, "isleroles": {"tags": "tags", "job_types": "job_types"}, "reefjobs": {"job_level": "jobLevel", "salary_period": "salaryPeriod"}, "lagoonwork": {"seniority": "seniority"}}
#: Where a board's text lies if its own field is empty.
EXCERPTS = {"reefjobs": "jobExcerpt"}


def attribution(config: dict, name: str) -> str | None:
    """The credit line that a board's configuration asks reports to carry."""
    return (config.get(name) or {}).get("attribution")


def remote_board(name: str) -> Callable[[DataFrame], DataFrame]:
    """The adapter of a remote board: everything on it is remote unless it has a flag of its own; empty and zero pay is null."""
    (key, fields), more, excerpt = REMOTE_BOARDS[name], REMOTE_EXTRA[name], EXCERPTS.get(name)

    def run(payloads: DataFrame) -> DataFrame:
        rows = entries(payloads, ", ".join(f"`{f.rstrip('*+')}`: string" for f in dict.fromkeys([*(f.rstrip("*+") for f in fields.values()), *more.values(), *([excerpt] if excerpt else [])])), key)
        columns = {}
        for column, field in fields.items():
            raw = j(f"`{field.rstrip('*+')}`")
            if field.endswith("*"):
                raw = T.first_of(raw)
            elif field.endswith("+"):
                raw = nonempty(F.array_join(F.from_json(raw, "array<string>"), ", "))
            columns[column] = T.as_amount(raw) if column.startswith("salary_m") else raw.cast("boolean") if column == "is_remote" else F.trim(raw) if column in ("title", "native_id") else F.coalesce(nonempty(raw), *([j(f"`{excerpt}`")] if excerpt else []), F.lit("")) if column == "description_html" else raw
        columns["extra"] = F.to_json(F.struct(*[j(f"`{f}`").alias(n) for n, f in more.items()]))
        return posting(rows, **({"is_remote": F.lit(True)} | columns))

    return run


for _name in REMOTE_BOARDS:
    REGISTRY[_name] = ("REGION" if _name == "lagoonwork" else "GLOBAL", remote_board(_name))


def next_cursor(payloads: DataFrame, max_pages: int = 60) -> DataFrame:
    """(url): the next page of a board with cursors, while there is one and `max_pages` isn't reached."""
    cursor = F.get_json_object("body", "$.nextCursor")
    base = F.regexp_replace("url", r"&cursor=.*$", "")
    page = T.url_page(F.col("url"))
    return payloads.where(cursor.isNotNull() & (cursor != "") & (page < max_pages)).select(F.concat(base, F.lit("&cursor="), F.url_encode(cursor), F.lit("&page="), (page + 1).cast("string")).alias("url"))


def html_board(pages: DataFrame, detail: str | None = None) -> DataFrame:
    """Detail pages with structured data to postings: at most one a page, none without a title.

    Where `detail` says what detail pages' addresses look like, all other pages give none, whatever they embed.
    The native id is the last part of the path; the place falls back on where applicants may live, the
    remote flag on what place and title say.
    """
    pages = pages.where(F.col("url").rlike(detail)) if detail else pages
    got = jsonld.parse_pages(pages.withColumnRenamed("body", "html").select("url", "source", "segment", "fetched_at", "html")).where("found")
    place = F.coalesce("location", "applicant_location")
    return posting(
        got, native_id=T.url_last_segment(F.col("url")), title=F.trim("title"), description_html=F.coalesce("description", F.lit("")), company=F.col("company"), location=place, is_remote=F.coalesce("is_remote", T.infer_remote(place, F.col("title"))),
        date_posted=F.col("date_posted"), valid_through=F.col("valid_through"), employment_type=F.col("employment_type"), salary_min=F.col("salary_min"), salary_max=F.col("salary_max"), salary_currency=F.col("salary_currency"), industry=F.col("industry"),
    )


for _name in ("kazinjema", "mtaaroles", "savannalist"):
    REGISTRY[_name] = ("KE", html_board)


def detail_links(pages: DataFrame, pattern: str, detail: str | None = None) -> DataFrame:
    """(url, link): the distinct detail links of listing pages, in order; `pattern` has the link as its first group.

    Pages whose own address looks like a `detail` page yield none.
    """
    pages = pages.where(~F.col("url").rlike(detail)) if detail else pages
    links = F.array_sort(F.array_distinct(F.regexp_extract_all("body", F.lit(pattern), F.lit(1))))
    return pages.select("url", F.explode(links).alias("link"))


def item_list_links(pages: DataFrame, within: str = "", hrefs: str | None = None, base: str = "") -> DataFrame:
    """(url, link): addresses in the ItemList of a page's structured data that hold `within`, and those that the pattern `hrefs` finds, put behind `base`; in order, once each."""
    raw = F.regexp_extract_all("body", F.lit(r"(?is)<script[^>]+application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    items = F.flatten(F.transform(F.filter(raw, lambda b: b.contains("ItemList")), lambda b: F.regexp_extract_all(b, F.lit(r'"url"\s*:\s*"([^"]+)"'), F.lit(1))))
    links = F.filter(items, lambda u: u.contains(within))
    if hrefs:
        links = F.concat(links, F.transform(F.regexp_extract_all("body", F.lit(hrefs), F.lit(1)), lambda h: F.concat(F.lit(base), h)))
    return pages.select("url", F.explode(F.array_sort(F.array_distinct(links))).alias("link"))


def category_links(pages: DataFrame, landing: str, pattern: str, base: str, others: set[str]) -> DataFrame:
    """(url, link): the categories that landing pages lead to; `others` are last parts of addresses of the same shape that are none."""
    found = F.array_distinct(F.regexp_extract_all("body", F.lit(pattern), F.lit(1)))
    kept = F.filter(found, lambda h: ~F.substring_index(h, "/", -1).isin(sorted(others))) if others else found
    return pages.where(F.col("url").rlike(landing)).select("url", F.explode(F.array_sort(F.transform(kept, lambda h: F.concat(F.lit(base), h)))).alias("link"))


def next_listing(pages: DataFrame, links: DataFrame, style: str, cap: int, index: str | None = None) -> DataFrame:
    """(url, next): the following page of each listing that led to postings (`links`), or whose address looks like an `index` page, up to the cap."""
    fruitful = pages.join(links.select("url").distinct(), "url", "left_semi").select("url")
    if index:
        fruitful = fruitful.union(pages.where(F.col("url").rlike(index)).select("url")).distinct()
    return fruitful.select("url", next_page(F.col("url"), style, cap).alias("next")).where("next is not null")


def country_of_url(url: Column, pattern: str, codes: dict[str, str], default: str) -> Column:
    """The country code for what the first group of `pattern` finds in an address."""
    named = F.create_map(*[F.lit(x) for c in codes.items() for x in c])
    return F.coalesce(F.try_element_at(named, F.regexp_extract(url, pattern, 1)), F.lit(default))


def next_page(url: Column, style: str, cap: int) -> Column:
    """The following listing page: `query` (?page=n), `zero` (the same, the first being 0, so that `cap` is their number), `path` (/n) or `page` (/page/n/); null at the cap."""
    pattern, put = {"query": (r"[?&]page=(\d+)", "?page="), "zero": (r"[?&]page=(\d+)", "?page="), "path": (r"/(\d+)/?$", "/"), "page": (r"/page/(\d+)/?$", "/page/")}[style]
    now = F.coalesce(F.regexp_extract(url, pattern, 1).try_cast("int"), F.lit(0 if style == "zero" else 1))
    base = F.regexp_replace(F.regexp_replace(url, pattern, ""), "/$", "")
    return F.when(now + 1 < cap if style == "zero" else now < cap, F.concat(base, F.lit(put), (now + 1).cast("string"), F.lit("/" if style == "page" else "")))


def archive_captures(index: DataFrame, detail: str, total: int, years: list[int]) -> DataFrame:
    """(board, year, original, ts): the captures to replay, each address without query once, a budget for each board and year.

    `index` has board, original, ts (digits). Only detail pages count; of addresses that differ in
    their query the first wins. The budget is total / years, at least 1.
    """
    from pyspark.sql import Window as W

    rows = index.where(F.col("original").rlike(detail)).withColumn("canonical", T.url_canonical(F.col("original"))).withColumn("year", F.substring("ts", 1, 4).cast("int")).where(F.col("year").isin(years))
    first = rows.groupBy("board", "canonical").agg(F.min(F.struct("ts", "original", "year")).alias("r")).select("board", "canonical", "r.*")
    place = F.row_number().over(W.partitionBy("board", "year").orderBy("ts", "original"))
    return first.withColumn("place", place).where(F.col("place") <= max(1, total // max(1, len(years)))).select("board", "year", F.col("canonical").alias("original"), "ts")


def replayed(pages: DataFrame, boards: DataFrame) -> DataFrame:
    """Archived pages (url of the archive) to postings of `wayback_<board>`; the date comes from the page, not the archive.

    `boards` has host and board; pages whose original address belongs to none are dropped.
    """
    original = F.regexp_extract("url", r"/web/\d+(?:[a-z_]+)?/(https?://.*)$", 1)
    rows = pages.withColumn("archive", F.col("url")).withColumn("url", original).withColumn("host", T.url_domain(F.col("url"))).join(boards, "host").withColumn("source", F.concat(F.lit("wayback_"), "board"))
    live = html_board(rows.select("url", "source", "segment", "fetched_at", "body"))
    told = rows.groupBy("url", "source").agg(F.min("archive").alias("archive"))
    told = told.select("url", "source", F.to_json(F.struct(F.expr("substring(source, 9)").alias("replayed_board"), F.regexp_extract("archive", r"/web/(\d+)", 1).alias("archive_timestamp"), F.col("archive").alias("archive_url"))).alias("extra"))
    return live.drop("extra").join(told, ["url", "source"], "left").withColumn("is_historical", F.lit(True)).select(*live.columns)


def segment_of(rows: DataFrame, companies: DataFrame, slug: str = "slug") -> DataFrame:
    """`rows` with the segment of their board in the company list, by lower-case slug; of several the first by name."""
    one = companies.where("slug is not null").groupBy(F.lower("slug").alias("_slug")).agg(F.min("segment").alias("segment"))
    return rows.drop("segment").withColumn("_slug", F.lower(slug)).join(one, "_slug", "left").drop("_slug")


def confirmed_boards(probes: DataFrame, known: DataFrame, min_open: int = 1) -> DataFrame:
    """Probed boards with open postings that aren't known yet, most postings first."""
    return probes.where(F.col("open_jobs") >= min_open).join(known.select("slug"), "slug", "left_anti").orderBy(F.desc("open_jobs"), "slug")


def segment_of_url(url: Column, home: str = "kenya", segment: str = "KE", other: str = "REGION") -> Column:
    """The segment of a board that covers several countries, from the country in its addresses."""
    return F.when(F.lower(url).contains(f"/{home}/"), segment).otherwise(other)


def seeds(candidates: DataFrame) -> DataFrame:
    """(slug, segment): candidate boards once each, whatever their case; of several segments the first by `batch` wins."""
    first = F.min_by(F.struct("slug", "segment"), F.struct("batch", "slug", "segment")).alias("r")
    return candidates.where("slug is not null").groupBy(F.lower("slug").alias("k")).agg(first).select("r.*")
