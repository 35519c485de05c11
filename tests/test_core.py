"""Store, shares, diffusion, text, sources and streams on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import briefs, diffusion, extraction, shares, store
from tidemark.settings import DiffusionSettings
from tidemark.sources import adapters, jsonld, sinks
from tidemark.sources.politeness import Robots, TokenBucket
from tidemark.streaming import ingest

D = DiffusionSettings()


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def value(spark, column, **cells):
    schema = ", ".join(f"{k} string" for k in cells)
    return spark.createDataFrame([tuple(cells.values())], schema).select(column.alias("v")).first().v


# ------------------------------------------------------------- store


def test_upsert_is_idempotent_and_last_wins(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, n int, v string")
    new = spark.createDataFrame([("a", 2, "z"), (None, 1, "n")], "k string, n int, v string")
    once = store.upsert(old, new, ["k"], ["n"])
    assert once.count() == 3 and rows(once.where("k = 'a'")) == [("a", 2, "z")]
    assert once.exceptAll(store.upsert(once, new, ["k"], ["n"])).count() == 0


def test_queue(spark):
    q = spark.createDataFrame([("u", "s", "pending", 0, 1, None, None), ("u", "s", "failed", 1, 1, 2, "x"), ("w", "s", "done", 1, 1, 3, None)], "url string, source string, state string, attempts int, queued_at int, updated_at int, note string")
    assert rows(store.latest_state(q), "url", "state", "attempts") == [("u", "failed", 1), ("w", "done", 1)]
    assert rows(store.requeue_failed(store.latest_state(q), 2), "url", "state") == [("u", "pending"), ("w", "done")]
    assert rows(store.insert_ignore(q.where("url = 'w'"), q, "url", ["queued_at"]), "url") == [("u",)]
    assert store.replace_keys(q, q.where("state = 'failed'"), "url").count() == 2


def test_history_readings_differ(spark):
    df = spark.createDataFrame([("hn_x",), ("hn",), ("wayback_b",), ("waybackfill",), (None,)], "source string")
    names = ("hn", "wayback")
    assert rows(df.where(store.history_mask(F.col("source"), names))) == [("hn",), ("wayback_b",)]
    assert rows(df.where(store.history_predicate(F.col("source"), names))) == [("hn",), ("hn_x",), ("wayback_b",)]
    assert df.where(store.history_mask(F.col("source"), ())).count() == 0


# ------------------------------------------------------------- shares and diffusion

DOC = "job_id string, source string, native_id string, segment string, year int, month string"
TAG = "job_id string, skill string, track string, category string"


def test_share_counts_three_denominators(spark):
    docs = spark.createDataFrame([(f"d{i}", "s", str(i), "KE", 2024, "2024-01") for i in range(8)] + [("g1", "s", "g", "GLOBAL", None, None), ("n", "s", "n", None, 2024, None)], DOC)
    tags = spark.createDataFrame([("d0", "SQL", "t", "c"), ("d0", "SQL", "t", "c"), ("d1", "Git", "t", "c"), ("zz", "SQL", "t", "c")], TAG)
    got = {r.skill: r for r in shares.build_share(docs, tags, ["segment"], 2).collect()}
    assert (got["SQL"].pct_of_all, got["SQL"].pct_of_tech, got["SQL"].n_slots, got["SQL"].usable) == (1 / 8, 1 / 2, 3, True)
    assert shares.build_share(docs, tags, ["segment", "year"], 3).where("usable").count() == 0
    assert shares.build_share(docs.limit(0), tags, ["segment"], 1).count() == 0


def test_replays_yield_to_live_rows(spark):
    docs = spark.createDataFrame([("a", "board", "1", "KE", 1, "m"), ("b", "wayback_board", "1", "KE", 1, "m"), ("c", "wayback_board", "2", "KE", 1, "m"), ("d", None, None, "KE", 1, "m")], DOC)
    assert rows(shares.drop_replays(docs), "job_id") == [("a",), ("c",), ("d",)]


SHARE = "skill string, track string, category string, segment string, pct_share double, usable boolean"
BASE = [(s, "t", "c", g, 0.2, True) for s in ("SQL", "Git", "Java") for g in ("GLOBAL", "KE")]


def classified(spark, cells, months=(), follow_months=12, s=D):
    current = spark.createDataFrame(BASE + cells, SHARE)
    monthly = spark.createDataFrame([(k, "GLOBAL", m, v) for k, m, v in months], "skill string, segment string, month string, pct_share double")
    yearly = spark.createDataFrame([], SHARE + ", year int")
    docs = spark.createDataFrame([("x", "s", "1", "KE", 2024, f"2024-{i + 1:02d}") for i in range(follow_months)], DOC)
    return {r.skill: r for r in diffusion.build_diffusion(current, monthly, yearly, docs, s).collect()}


def series(skill, before, after):
    return [(skill, f"2024-{i + 1:02d}", before if i < 6 else after) for i in range(12)]


@pytest.mark.parametrize(
    ("lead", "follow", "before", "after", "status", "level"),
    [
        (0.2, 0.005, 0.05, 0.20, "teach_ahead", "medium"), (0.05, 0.02, 0.10, 0.11, "teach_ahead", "medium"), (0.13, 0.005, 0.13, 0.13, "global_only", "low"), (0.2, 0.005, 0.2, 0.1, "declining_both", "low"),
        (0.001, 0.15, 0.0, 0.0, "kenya_specific", "medium"), (0.004, 0.001, 0.0, 0.0, "low_demand", "medium"), (0.2, 0.1, 0.1, 0.2, "arriving", "medium"), (0.2, 0.1, 0.2, 0.2, "established_both", "medium"), (0.03, 0.025, 0.0, 0.0, "established_both", "low"), (0.02, 0.03, 0.0, 0.0, "established_both", "low"),
    ],
)
def test_status_rules(spark, lead, follow, before, after, status, level):
    got = classified(spark, [("X", "t", "c", "GLOBAL", lead, True), ("X", "t", "c", "KE", follow, True)], series("X", before, after))["X"]
    assert (got.status, got.confidence) == (status, level)


def test_offset_needs_three_baselines(spark):
    cells = [("X", "t", "c", "GLOBAL", 0.15, True), ("X", "t", "c", "KE", 0.01, True)]
    shifted = spark.createDataFrame([("SQL", "t", "c", "GLOBAL", 0.3, True), ("SQL", "t", "c", "KE", 0.2, True), ("Git", "t", "c", "GLOBAL", 0.25, True), ("Git", "t", "c", "KE", 0.15, True), ("Java", "t", "c", "GLOBAL", 0.2, True), ("Java", "t", "c", "KE", 0.1, True), *cells], SHARE)
    assert round(diffusion.calibration(diffusion.segment_pivot(shifted)).first().offset, 9) == 0.1
    few = diffusion.calibration(diffusion.segment_pivot(shifted.where("skill <> 'Java'"))).first()
    assert (few.offset, few.offset_applied) == (0.0, False)


def test_thin_short_and_provisional(spark):
    x = [("X", "t", "c", "GLOBAL", 0.2, False)]
    current = spark.createDataFrame([(a, b, c, d, e, False) for a, b, c, d, e, _ in BASE] + x, SHARE)
    empty = spark.createDataFrame([], "skill string, segment string, month string, pct_share double")
    docs = spark.createDataFrame([], DOC)
    got = {r.skill: r for r in diffusion.build_diffusion(current, empty, spark.createDataFrame([], SHARE + ", year int"), docs).collect()}
    assert (got["X"].status, got["X"].follow_share_now, got["X"].lead_trend_12m) == ("insufficient_data", 0.0, None)
    prov = classified(spark, [("X", "t", "c", "GLOBAL", 0.2, True)], series("X", 0.05, 0.2), follow_months=5)["X"]
    assert (prov.status, prov.confidence, prov.gap_rank) == ("teach_ahead", "provisional", 1.0)
    assert diffusion.lead_trend(spark.createDataFrame([("X", "GLOBAL", f"2024-0{i}", 0.1) for i in range(1, 6)], "skill string, segment string, month string, pct_share double")).count() == 0


def test_backtest(spark):
    cells = []
    for i in range(12):
        up = 0.02 if i < 6 else 0.0
        cells += [(f"k{i}", "t", "c", g, 0.1 + (up if y == 2025 else 0) * (1 if g == "GLOBAL" or i < 4 else -1), True, y) for g in ("GLOBAL", "KE") for y in (2024, 2025)]
    yearly = spark.createDataFrame(cells, SHARE + ", year int")
    r = diffusion.backtest(yearly).first()
    assert (r.n_comparable, r.n_risers, r.n_hits, r.hit_rate, r.base_rate, r.lift, r.error) == (12, 6, 4, 0.667, 0.333, 0.333, None)
    assert diffusion.backtest(yearly.where("year = 2024")).first().error


def test_briefs(spark):
    frame = classified(spark, [("X", "t2", "c", "GLOBAL", 0.2, True)])
    df = spark.createDataFrame([(r.skill, r.track, r.status, r.calibrated_gap, r.lead_share_now, r.follow_share_now, r.lead_trend_12m, None, r.confidence) for r in frame.values()], "skill string, track string, status string, calibrated_gap double, lead_share_now double, follow_share_now double, lead_trend_12m double, follow_trend_12m double, confidence string")
    tops = briefs.top_by_action(df, 2)
    assert tops.groupBy("track", "action").count().agg(F.max("count")).first()[0] <= 2
    coverage = spark.createDataFrame([("t", 0.5, 0.25)], "track string, lead_coverage double, follow_coverage double")
    made = {r.track: r for r in briefs.build_briefs(df, coverage).collect()}
    assert list(made) == ["t", "t2"] and made["t2"].lead_coverage == 0.0 and made["t"].follow_coverage == 0.25
    assert made["t"].n_skills == sum(len(x) for x in made["t"].actions.values()) and set(made["t"].actions) <= set(briefs.ACTIONS.values())
    assert all(x.calibrated_gap >= y.calibrated_gap for m in made.values() for skills in m.actions.values() for x, y in zip(skills, skills[1:], strict=False))
    text = briefs.to_markdown(briefs.build_briefs(df, coverage))
    assert "## t" in text and "Coverage: lead 50.0%, follow 25.0%" in text
    odd = spark.createDataFrame([("established_both",), ("kenya_specific",), ("low_demand",), ("insufficient_data",), ("arriving",), ("else",), (None,)], "status string")
    assert [r.a for r in odd.select(briefs.action_of(F.col("status")).alias("a")).collect()] == ["hold", "hold", "minor", "unknown", "expand", "unknown", "unknown"]


# ------------------------------------------------------------- text


@pytest.mark.parametrize(
    ("markup", "want"),
    [("<ul><li>a</li><li>b</li></ul>", "a\n\nb"), ("&lt;p&gt;x &amp;amp; y&lt;/p&gt;", "x & y"), ("<script>if (a<b) {}</script><p>z</p>", "z"), (None, ""), ("", ""), ("a&nbsp;&nbsp;b​", "a b"), ("<p>1</p><p></p><p></p><p>2</p>", "1\n\n2"), ("5 < 6", "5 < 6"), ("&#8211;&#233;&#xE9;&euro;&copy;&Eacute;", "–éé€©É"), ("a &amp;lt; b &unknown; c & d; &#0; &#xD800; &#1114112;", "a &lt; b &unknown; c & d; &#0; &#xD800; &#1114112;"), ("&#128512;x&#39;", "😀x'")],
)
def test_html_to_text(spark, markup, want):
    assert value(spark, T.html_to_text(F.col("x")), x=markup) == want


def test_sentences_remote_seniority(spark):
    assert value(spark, T.sentences(F.col("x")), x="One. Two!\nThree? \n\n four.five") == ["One.", "Two!", "Three?", "four.five"]
    for a, b, want in (("Remote (Work From Home)", "", True), ("Nairobi", "Hybrid", False), ("Nairobi", "Clerk", None), (None, None, None), ("x remote", None, True), ("Remote, X", "", None)):
        assert value(spark, T.infer_remote(F.col("a"), F.col("b")), a=a, b=b) == want
    for title, want in (("Senior Staff Engineer", "lead"), ("Jr. Clerk", "junior"), ("Internship", "intern"), ("Snr Dev", "senior"), ("Clerk", None), ("", None)):
        assert value(spark, T.infer_seniority(F.col("x")), x=title) == want


def test_confirms(spark):
    assert value(spark, T.confirms(F.col("x"), "Go (language)"), x="uses Go.") and not value(spark, T.confirms(F.col("x"), "Java"), x="JavaScript")


# ------------------------------------------------------------- extraction

TAX = "skill string, canonical_name string, category string, track string, match_pattern string, negative_context string"


def test_extract_terms(spark):
    tax = spark.createDataFrame([("Go", "go", "l", "t", r"\bgo\b", "go to market|go live"), ("Java", "java", "l", "t", r"\bjava\b(?!script)", None), ("C#", "c#", "l", "t", r"\bc\#", None)], TAX)
    docs = spark.createDataFrame([(1, "Go dev", "We go live. Use Go, go!\nJava and JavaScript; C#"), (2, None, None), (3, "", "nothing"), (4, "java", None)], "id bigint, title string, body string")
    got = extraction.extract_terms(docs, tax, "id", "title", "body")
    assert rows(got, "id", "skill", "n_mentions", "matched_in") == [(1, "C#", 1, "description"), (1, "Go", 3, "both"), (1, "Java", 1, "description"), (4, "Java", 1, "title")]
    assert extraction.extraction_stats(docs, got, "id").first().coverage == 0.5
    assert extraction.extraction_stats(docs.limit(0), got.limit(0), "id").first().coverage == 0.0
    gate = extraction.precision_gate(got.withColumn("segment", F.lit("KE")), "segment").first()
    assert gate.matches == 4 and gate.confirmed == 4
    with pytest.raises(ValueError, match="pattern"):
        extraction.check_patterns(spark.createDataFrame([("Bad", "bad", "l", "t", "(", None)], TAX))


def test_taxonomy_csv(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text('skill,canonical_name,category,track,match_pattern,negative_context,is_diffusion_baseline,notes\n SQL ,,l,t,"\\bsql\\b",,Yes,"a ""b"", c"\n,x,l,t,y,,,\nNo,x,l,t,,,,\n')
    assert rows(extraction.read_taxonomy(spark, str(p)), "skill", "canonical_name", "is_diffusion_baseline") == [("SQL", "sql", True)]


# ------------------------------------------------------------- sources


def payload(spark, source, body, url="https://x.example/boards/acme"):
    return spark.createDataFrame([(url, source, "GLOBAL", body)], "url string, source string, segment string, body string").withColumn("fetched_at", F.lit(None).cast("timestamp"))


def test_board_a(spark):
    body = json.dumps({"jobs": [{"id": 7, "title": " Dev ", "location": {"name": "Remote (X"}, "first_published": None, "updated_at": "2024-01-02", "departments": [{"name": ""}, {"name": "Eng"}]}, {"id": None, "title": "y"}]})
    r = adapters.ats_board_a(payload(spark, "leafboard", body)).collect()
    assert [(x.native_id, x.title, x.company, x.department, x.date_posted, x.is_remote) for x in r] == [("7", "Dev", "acme", "Eng", "2024-01-02", True)]
    assert adapters.ats_board_a(payload(spark, "leafboard", "not json")).count() == 0


def test_board_b_and_remote_boards(spark):
    body = json.dumps({"jobs": [{"id": "a", "title": "x", "isListed": False}, {"id": "b", "title": "y", "isRemote": False, "location": "remote"}, {"id": "c", "title": "z", "location": "On-site"}]})
    assert rows(adapters.ats_board_b(payload(spark, "stackhire", body)), "native_id", "is_remote") == [("b", False), ("c", False)]
    flat = json.dumps([{"id": "1", "jobTitle": "t", "jobType": ["full", "part"], "jobIndustry": "it", "salaryMin": "0", "salaryMax": "12.5"}])
    r = adapters.REGISTRY["reefjobs"][1](payload(spark, "reefjobs", flat)).first()
    assert (r.employment_type, r.industry, r.salary_min, r.salary_max, r.is_remote) == ("full", "it", None, 12.5, True)
    guid = json.dumps({"jobs": [{"guid": "g", "title": "t", "locationRestrictions": ["KE", "UG"]}], "nextCursor": "a b"})
    p = payload(spark, "lagoonwork", guid, "https://h.example/api?limit=100")
    assert adapters.REGISTRY["lagoonwork"][1](p).first().location == "KE, UG"
    assert adapters.next_cursor(p).first().url == "https://h.example/api?limit=100&cursor=a+b&page=2"


def test_threads(spark):
    long = "Acme | Dev | Remote or Nairobi, KE | Full-time\n" + "We write software. " * 6
    body = json.dumps({"id": "9", "title": "Ask: Who is hiring? (May 2024)", "created_at": "2024-05-01T00:00:00Z", "children": [{"id": "1", "text": long}, {"id": "2", "text": "short"}, {"id": "3", "text": None}, {"id": "4", "text": "no header line here " * 8}]})
    got = {r.native_id: r for r in adapters.monthly_threads(payload(spark, "threadwork", body)).collect()}
    assert set(got) == {"1", "4"}
    assert (got["1"].company, got["1"].title, got["1"].location, got["1"].employment_type, got["1"].is_remote) == ("Acme", "Dev", "Remote or Nairobi, KE", "Full-time", True)
    assert got["4"].title == "Unspecified role"
    search = spark.createDataFrame([("1", "Who is hiring? (May 2024)", "2024-05-01"), ("2", "Who wants to be hired?", "2024-05-01"), ("3", "Who is hiring?", "2023-01-01")], "id string, title string, created_at string")
    assert rows(adapters.thread_urls(search, "2024-01"), "url") == [("items/1",)]


PAGE = """<script type="application/ld+json">{"broken": </script><script type='application/ld+json'>{"@graph": [{"@id": "#o", "@type": "Organization", "name": "Acme"},
{"@type": ["JobPosting"], "title": "Dev", "description": "a\nb", "hiringOrganization": {"@id": "#o"}, "jobLocationType": "TELECOMMUTE", "jobLocation": [{"address": {"addressLocality": "Nairobi", "addressCountry": {"name": "Kenya"}}}, {"address": "nairobi"}],
"baseSalary": {"currency": "KES", "value": {"minValue": "1,000", "maxValue": 2000}}, "employmentType": ["FULL_TIME", "X"]}]}</script>"""


def test_jsonld(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>none</p>"), (3, None), (4, '<script type="application/ld+json">{"@id": "a", "x": {"@id": "a"}, "@type": "JobPosting", "hiringOrganization": {"@id": "a"}}</script>')], "id int, html string")
    got = {r.id: r for r in jsonld.parse_pages(pages).collect()}
    r = got[1]
    assert (r.title, r.company, r.location, r.is_remote, r.salary_min, r.salary_max, r.salary_currency, r.employment_type) == ("Dev", "Acme", "Nairobi, Kenya", True, 1000.0, 2000.0, "KES", "FULL_TIME")
    assert [got[i].found for i in (1, 2, 3, 4)] == [True, False, False, True] and got[4].company is None
    assert adapters.html_board(spark.createDataFrame([("https://k.example/jobs/dev-1?x=1", "kazinjema", "KE", PAGE)], "url string, source string, segment string, body string").withColumn("fetched_at", F.lit(None).cast("timestamp"))).first().native_id == "dev-1"


def test_links_and_archive(spark):
    page = spark.createDataFrame([("u", '<a href="/jobs/b"> <a href="/jobs/a"> <a href="/jobs/b">')], "url string, body string")
    assert [r.link for r in adapters.detail_links(page, 'href="(/jobs/[^"]+)"').collect()] == ["/jobs/a", "/jobs/b"]
    for url, style, want in (("https://x/l", "query", "https://x/l?page=2"), ("https://x/l?page=2", "query", None), ("https://x/l/page/1/", "page", "https://x/l/page/2/")):
        assert value(spark, adapters.next_page(F.col("u"), style, 2), u=url) == want
    index = spark.createDataFrame([("b", "https://h/jobs/1?a", "20240101"), ("b", "https://h/jobs/1", "20240201"), ("b", "https://h/about", "20240101"), ("b", "https://h/jobs/2", "20250101")], "board string, original string, ts string")
    assert rows(adapters.archive_captures(index, "/jobs/", 2, [2024, 2025]), "original") == [("https://h/jobs/1",), ("https://h/jobs/2",)]
    pages = spark.createDataFrame([("https://web.archive.example/web/20240101/https://h.example/jobs/1", "KE", PAGE)], "url string, segment string, body string").withColumn("fetched_at", F.lit(None).cast("timestamp"))
    r = adapters.replayed(pages, spark.createDataFrame([("h.example", "b")], "host string, board string")).first()
    assert (r.source, r.native_id, r.is_historical) == ("wayback_b", "1", True)


def test_registry():
    assert adapters.resolve("ke, leafboard") == ["kazinjema", "mtaaroles", "savannalist", "leafboard"] and adapters.resolve("") == []
    with pytest.raises(ValueError, match="unknown"):
        adapters.resolve("nope")


def test_politeness():
    now = [0.0]
    bucket = TokenBucket(2.0, burst=1, jitter=0, clock=lambda: now[0])
    assert [bucket.wait(), bucket.wait(), bucket.wait()] == [0.0, 0.5, 1.0]
    r = Robots("User-agent: *\nDisallow: /private\nAllow: /private/ok*\nCrawl-delay: 2\nSitemap: https://x/s.xml", "me")
    assert r.allows("/a") and not r.allows("/private/x") and r.allows("/private/ok1") and r.delay == 2 and r.sitemaps == ["https://x/s.xml"]
    assert Robots("", "me").allows("/x")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert list(sinks.export({"one": df, "none": df.limit(0)}, str(tmp_path))) == ["one"]
    assert spark.read.parquet(str(tmp_path / "one.parquet")).count() == 1
    sinks.append(df, str(tmp_path / "log"))
    sinks.append(df, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


# ------------------------------------------------------------- streams


def test_streams_equal_batches(spark, tmp_path):
    land = tmp_path / "land"
    for i in range(3):
        spark.createDataFrame([(f"k{i % 2}", i, "s")], "k string, n int, source string").write.mode("append").parquet(str(land))
    batch = spark.read.parquet(str(land))
    got = ingest.stream_upsert(ingest.landed(spark, str(land), 1), str(tmp_path / "store"), ["k"], ["n"], str(tmp_path / "c1"))
    assert rows(got) == rows(store.keep_last(batch, ["k"], ["n"]))
    assert rows(ingest.stream_counts(ingest.landed(spark, str(land), 1), ["source"], str(tmp_path / "counts"), str(tmp_path / "c2"))) == [("s", 3)]
    again = ingest.stream_upsert(ingest.landed(spark, str(land), 1), str(tmp_path / "store"), ["k"], ["n"], str(tmp_path / "c1"))
    assert rows(again) == rows(got)  # nothing new
    spark.createDataFrame([("k0", 7, "s"), ("k9", 8, "t")], "k string, n int, source string").write.mode("append").parquet(str(land))
    more = ingest.stream_upsert(ingest.landed(spark, str(land), 1), str(tmp_path / "store"), ["k"], ["n"], str(tmp_path / "c1"))
    kept = rows(more)
    assert kept == rows(store.keep_last(spark.read.parquet(str(land)), ["k"], ["n"])) and len(kept) == 3
    assert len(list((tmp_path / "store" / "manifest").glob("*.json"))) == 2
    # the last batch once more, as after a lost commit: the same store
    last = max((tmp_path / "c1" / "commits").iterdir(), key=lambda f: int(f.name) if f.name.isdigit() else -1)
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink()
    assert rows(ingest.stream_upsert(ingest.landed(spark, str(land), 1), str(tmp_path / "store"), ["k"], ["n"], str(tmp_path / "c1"))) == kept
    assert rows(ingest.stream_counts(ingest.landed(spark, str(land), 1), ["source"], str(tmp_path / "counts"), str(tmp_path / "c2"))) == [("s", 4), ("t", 1)]
    empty = tmp_path / "empty"
    spark.createDataFrame([], "k string, n int, source string").write.parquet(str(empty))
    assert rows(ingest.stream_upsert(ingest.landed(spark, str(empty), 1), str(tmp_path / "e"), ["k"], ["n"], str(tmp_path / "c4"))) == []
    ingest.dead_letters(ingest.landed(spark, str(land), 9), lambda b: b.where("n > 0"), str(tmp_path / "good"), str(tmp_path / "bad"), "n", str(tmp_path / "c3"))
    assert rows(spark.read.parquet(str(tmp_path / "bad")), "n") == [(0,)]


def entry_without(monkeypatch, missing: str):
    """The entry module as it loads where `missing` can't be imported."""
    import builtins
    import importlib

    import __spark_entry__ as e

    real = builtins.__import__

    def absent(name, globals=None, locals=None, fromlist=(), level=0):  # noqa: A002
        if name == missing or f"{name}.{(fromlist or ('',))[0]}" == missing:
            raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)
        return real(name, globals, locals, fromlist, level)

    with monkeypatch.context() as m:
        m.setattr(builtins, "__import__", absent)
        got = importlib.reload(e)
        return set(got.queries()), set(got.oracle_sql())


def test_entry_without_llm(monkeypatch):
    names, sql = entry_without(monkeypatch, "tidemark.llm")
    assert sql <= names and len(names) > 50 and "p1_found" in names and not [n for n in names if n.startswith("p") and n.endswith("_found") and n != "p1_found"]


def test_entry_doesnt_hide_what_else_is_missing(monkeypatch):
    import sys

    for name in [m for m in sys.modules if m.startswith("tidemark.llm")]:
        monkeypatch.delitem(sys.modules, name)
    try:
        import tidemark.llm  # noqa: F401
    except ModuleNotFoundError:
        pytest.skip("the subpackage is not there")
    with pytest.raises(ModuleNotFoundError):
        entry_without(monkeypatch, "xxhash")


def test_audit_dates_and_seeds(spark):
    from tidemark.functions import instants
    from tidemark.operators import audit

    docs = spark.createDataFrame([(f"d{i}", "KE", "x" * 500) for i in range(9)] + [("s", "KE", "x"), ("g", "GLOBAL", "x" * 500), ("n", "KE", None)], "job_id string, segment string, description_html string")
    a, b = (rows(audit.audit_sample(docs, "KE", 4, 1), "job_id") for _ in range(2))
    assert a == b and len(a) == 4 and set(a) <= {(f"d{i}",) for i in range(9)}
    assert audit.in_track(spark.createDataFrame([("Data Path",), (None,)], "track string"), "data").count() == 1
    for raw, want in (("2026-01-02T03:04:05.678901Z", "2026-01-02 03:04:05.678901"), ("2026-03-01T00:30:00+03:00", "2026-02-28 21:30:00"), ("1757000000", "2025-09-04 15:33:20"), ("Sep 6, 2026", "2026-09-06 00:00:00"), ("1999-01-01", None), ("2031-01-01", None), ("0", None), ("", None), (None, None), ("garbage", None)):
        got = value(spark, instants.parse_datetime(F.col("x")).cast("timestamp_ntz").cast("string"), x=raw)
        assert got == want
    assert value(spark, instants.year_month(instants.parse_datetime(F.col("x"))), x="2026-03-01T00:30:00+03:00") == "2026-02"
    boards = spark.createDataFrame([("Acme", "KE", 1), ("acme", "GLOBAL", 0), (None, "KE", 0)], "slug string, segment string, batch int")
    assert rows(adapters.seeds(boards)) == [("acme", "GLOBAL")]
    assert value(spark, adapters.segment_of_url(F.col("u")), u="https://x/kenya/jobs/1") == "KE"


# ------------------------------------------------------------- queries that read every row


def test_every_value_of_the_time_columns_is_read(spark, tmp_path):
    from tidemark.plans.queries import QUERIES

    cells = [(1, "Sep 6, 2026", "20260407", "1757000000"), (2, None, "garbage", "2026-01-02T03:04:05Z")]
    spark.createDataFrame(cells, "row_id bigint, date_posted string, valid_through string, fetched_at string").write.parquet(str(tmp_path / "jobs.parquet"))
    got = rows(QUERIES["parse_datetime_columns"](spark, str(tmp_path)).select("row_id", "field_name", F.col("at_utc").cast("string"), "month"))
    assert got == [
        (1, "date_posted", "2026-09-06 00:00:00", "2026-09"), (1, "fetched_at", "2025-09-04 15:33:20", "2025-09"), (1, "valid_through", "2026-04-07 00:00:00", "2026-04"),
        (2, "fetched_at", "2026-01-02 03:04:05", "2026-01"), (2, "valid_through", None, None),
    ]


def test_all_remote_boards_come_out(spark, tmp_path):
    from tidemark.plans.queries import QUERIES

    schema = "row_id bigint, source string, segment string, native_id string, url string, title string, description_html string, company string, location string, is_remote boolean, date_posted string, valid_through string, employment_type string, salary_min double, salary_max double, salary_currency string, industry string"
    cell = lambda i, source, **kw: {"row_id": i, "source": source, "segment": "GLOBAL", "native_id": f" n{i} ", "title": "t", "location": "KE, UG", "is_remote": False, "valid_through": "v", "employment_type": "full", "industry": "it", "salary_min": 0.0, "salary_max": 9.5, "salary_currency": "KES"} | kw
    cells = [cell(1, "farposts"), cell(2, "isleroles"), cell(3, "isleroles", is_remote=None), cell(4, "reefjobs"), cell(5, "reefjobs", industry="Sea"), cell(6, "lagoonwork", location=" "), cell(7, "stackhire"), cell(8, "isleroles", employment_type=None)]
    spark.createDataFrame(cells, schema).write.parquet(str(tmp_path / "jobs.parquet"))
    got = rows(QUERIES["adapter_remote_boards"](spark, str(tmp_path)), "native_id", "source", "location", "is_remote", "description_html", "valid_through", "employment_type", "industry", "salary_min", "salary_max")
    assert got == [
        ("n1", "farposts", "KE, UG", True, "", None, "full", "it", None, None), ("n2", "isleroles", "KE, UG", False, "", None, "full", None, None, None), ("n3", "isleroles", "KE, UG", None, "", None, "full", None, None, None),
        ("n4", "reefjobs", "KE, UG", True, "", None, "full", "it", None, 9.5), ("n5", "reefjobs", "KE, UG", True, "", None, "full", "Sea", None, 9.5), ("n6", "lagoonwork", None, True, "", "v", "full", None, None, 9.5), ("n8", "isleroles", "KE, UG", False, "", None, None, None, None, None),
    ]


def test_pages_of_all_rows_are_read(spark, tmp_path):
    from tidemark.plans.queries import QUERIES

    schema = "row_id bigint, source string, segment string, native_id string, url string, title string, description_html string, company string, location string, country string, is_remote boolean, date_posted string, valid_through string, employment_type string, salary_min double, salary_max double, salary_currency string, industry string"
    cell = lambda i, **kw: {"row_id": i, "source": "mtaaroles", "segment": "KE", "url": f"https://m.example/view/{i}?a=1", "title": " t ", "description_html": "a<script>x</script>b", "company": "Acme", "location": "Nairobi", "employment_type": "full"} | kw
    cells = [cell(1), cell(2), cell(3, company=None, location=None, country="KE", title="Dev, fully remote", employment_type=None), cell(4, company=None, location=None, is_remote=True, salary_min=0.0, salary_max=5.5, salary_currency="KES"), cell(5, title=None, source="leafboard", date_posted=" d", valid_through="v", industry="it")]
    spark.createDataFrame(cells, schema).write.parquet(str(tmp_path / "jobs.parquet"))
    text = "a<script>x</script>b"
    assert rows(QUERIES["jsonld_pages"](spark, str(tmp_path)), "row_id", "title", "description", "company", "location", "applicant_location", "is_remote", "date_posted", "valid_through", "employment_type", "salary_min", "salary_max", "salary_currency", "industry") == [
        (1, "t", text, "Acme", "Nairobi", None, False, None, None, "full", None, None, None, None), (2, "t", text, "Acme", "Nairobi", None, False, None, None, "full", None, None, None, None),
        (3, "Dev, fully remote", text, None, None, "KE", None, None, None, None, None, None, None, None), (4, "t", text, None, None, None, True, None, None, "full", None, 5.5, "KES", None), (5, None, text, "Acme", "Nairobi", None, False, "d", "v", "full", None, None, None, "it"),
    ]
    got = rows(QUERIES["html_boards"](spark, str(tmp_path)), "native_id", "title", "location", "is_remote", "salary_max")
    assert got == [("1", "t", "Nairobi", False, None), ("2", "t", "Nairobi", False, None), ("3", "Dev, fully remote", "KE", True, None), ("4", "t", None, True, 5.5)]


def test_item_list_links(spark):
    page = spark.createDataFrame([("u", '<script type="application/ld+json">{"@type": "ItemList", "itemListElement": [{"url": "/jobs/b"}, {"url": "/jobs/a"}, {"url": "/jobs/b"}]}</script><script type="application/ld+json">{"url": "/x"}</script>')], "url string, body string")
    assert rows(adapters.item_list_links(page), "link") == [("/jobs/a",), ("/jobs/b",)]


# ------------------------------------------------------------- fetching


def test_fetcher_asks_cache_rules_and_clock_in_turn():
    import random

    from tidemark.sources import politeness as P

    now, asked = [0.0], []
    answers = {"https://a.example/robots.txt": [P.Page(200, {}, "User-agent: *\nDisallow: /private\nCrawl-delay: 10")], "https://a.example/x": [P.Page(503, {}, ""), P.Page(429, {"Retry-After": "7"}, ""), P.Page(200, {}, "x")], "https://a.example/gone": [P.Page(404, {}, "")], "https://b.example/y": [OSError("no"), P.Page(200, {}, "y")], "https://c.example/z": [P.Page(500, {}, "")] * 9}

    def transport(url):
        asked.append(url)
        got = answers[url].pop(0) if url in answers else None
        if got is None or isinstance(got, Exception):
            raise got or OSError("no rules")
        return got

    def sleep(s):
        now[0] += s

    f = P.Fetcher(transport, "tester", cache={}, rates={"b.example": 2.0}, clock=lambda: now[0], sleep=sleep, rng=random.Random(1))
    assert f.get("https://a.example/x").body == "x" and f.get("https://a.example/x").body == "x"
    assert asked.count("https://a.example/x") == 3 and asked.count("https://a.example/robots.txt") == 1 and f.counters.cached == 1
    assert now[0] >= 14  # two more requests at one in ten seconds, jittered
    with pytest.raises(P.Refused):
        f.get("https://a.example/private/1")
    with pytest.raises(P.Failed):
        f.get("https://a.example/gone")
    assert asked.count("https://a.example/gone") == 1  # not tried again
    assert f.get("https://b.example/y").body == "y"  # no rules to be had: allowed
    with pytest.raises(P.Failed):
        f.get("https://c.example/z")
    assert asked.count("https://c.example/z") == 4
    assert dict(f.counters.fetched) == {"a.example": 1, "b.example": 1} and (f.counters.refused, f.counters.failed) == (1, 2)
    assert P.pause(2, "7", random.Random(1)) == 7.0 and 3 <= P.pause(2, "Wed, 21 Oct", random.Random(1)) <= 5


def test_one_bad_address_stops_nothing():
    from tidemark.sources import politeness as P

    marks = {}

    def get(url):
        if url == "b":
            raise P.Failed("b: 404")
        return P.Page(200, {}, url)

    got = P.drain_addresses(iter("abcde"), get, lambda url, page: 1 / 0 if url == "c" else len(page.body) if url == "a" else 0, lambda u, state, note: marks.update({u: (state, note)}), 4)
    assert got == {"addresses": 2, "postings": 1, "failed": 2} and list(marks) == list("abcd")
    assert marks["a"] == ("done", "") and marks["d"] == ("done", "no postings") and marks["b"] == ("failed", "Failed: b: 404") and marks["c"][0] == "failed"


def test_clear_and_order(spark, tmp_path):
    df = spark.createDataFrame([("b", "s", "KE"), ("a", "s", "GLOBAL"), ("c", "t", "KE")], "job_id string, source string, segment string")
    assert [r.job_id for r in store.in_order(df).collect()] == ["a", "b", "c"]
    assert [r.job_id for r in store.in_order(df, "s", "KE").collect()] == ["b"]
    df.write.parquet(str(tmp_path / "t"))
    assert store.clear(spark, str(tmp_path / "t")) == 3 and store.clear(spark, str(tmp_path / "t")) == 0
    assert spark.read.parquet(str(tmp_path / "t")).columns == df.columns


# ------------------------------------------------------------- listing pages


def test_listing_pages(spark):
    page = lambda url, body: (url, "s", "KE", body)
    job = '<script type="application/ld+json">{"@type": "JobPosting", "title": "Dev"}</script>'
    listing = '<a href="/kenya/jobs/dev-ops-1234"></a><a href="/kenya/job/it"></a><a href="/kenya/job/senior"></a><script type="application/ld+json">{"@type": "ItemList", "itemListElement": [{"url": "https://h/kenya/jobs/aa-bb-cc-1"}, {"url": "https://h/about"}]}</script>'
    pages = spark.createDataFrame([page("https://h/kenya/jobs/dev-1", job), page("https://h/kenya/job/it", listing + job), page("https://h/kenya/job", listing), page("https://h/kenya/job/empty", "")], "url string, source string, segment string, body string").withColumn("fetched_at", F.lit(None).cast("timestamp"))
    detail = "/[a-z]+/jobs/"
    assert rows(adapters.html_board(pages, detail), "native_id") == [("dev-1",)]
    links = adapters.item_list_links(pages, "/jobs/", r'href="(/[a-z]+/jobs/[a-z0-9-]{8,})"', "https://h")
    assert rows(links.where("url = 'https://h/kenya/job/it'"), "link") == [("https://h/kenya/jobs/aa-bb-cc-1",), ("https://h/kenya/jobs/dev-ops-1234",)]
    assert rows(adapters.detail_links(pages, r'href="(/[a-z]+/jobs/[a-z0-9-]+)"', detail), "url") == [("https://h/kenya/job",), ("https://h/kenya/job/it",)]
    assert rows(adapters.category_links(pages, "/[a-z]+/job/?$", r'href="(/[a-z]+/job/[a-z0-9-]+)"', "https://h", {"senior"})) == [("https://h/kenya/job", "https://h/kenya/job/it")]
    following = adapters.next_listing(pages, links.where("url like '%/it'"), "zero", 5, "/[a-z]+/job/?$")
    assert rows(following) == [("https://h/kenya/job", "https://h/kenya/job?page=1"), ("https://h/kenya/job/it", "https://h/kenya/job/it?page=1")]
    assert value(spark, adapters.next_page(F.col("u"), "zero", 5), u="https://h/x?page=3") == "https://h/x?page=4" and value(spark, adapters.next_page(F.col("u"), "zero", 5), u="https://h/x?page=4") is None
    for url, want in (("https://h.com/uganda/jobs/1", "UG"), ("https://h.com/jobs/1", "KE")):
        assert value(spark, adapters.country_of_url(F.col("u"), r"h\.com/([a-z]+)/", {"kenya": "KE", "uganda": "UG", "nigeria": "NG"}, "KE"), u=url) == want


def test_settings_from_a_mapping():
    from tidemark.settings import DiffusionSettings

    s = DiffusionSettings.from_mapping({"min_cell": "50", "baselines": ["SQL"], "lead_share_min": 0.1})
    assert (s.min_cell, s.baselines, s.lead_share_min, s.trend_min) == (50, ("SQL",), 0.1, 0.01) and not s.enable_lag_estimate
    with pytest.raises(ValueError, match="unknown"):
        DiffusionSettings.from_mapping({"min_cells": 1})


def test_remote_board_extras(spark):
    import json

    body = json.dumps({"jobs": [{"id": 1, "jobTitle": "t", "jobDescription": "", "jobExcerpt": "short", "jobLevel": "Senior", "salaryPeriod": "yearly"}]})
    r = adapters.REGISTRY["reefjobs"][1](payload(spark, "reefjobs", body)).first()
    assert r.description_html == "short" and json.loads(r.extra) == {"job_level": "Senior", "salary_period": "yearly"}
    assert adapters.attribution({"reefjobs": {"attribution": "by Reef"}}, "reefjobs") == "by Reef" and adapters.attribution({}, "x") is None
