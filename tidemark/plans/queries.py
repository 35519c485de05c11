"""The core's named queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import instants
from tidemark.functions import text as T
from tidemark.operators import audit, briefs, diffusion, extraction, shares, store
from tidemark.operators.timestamps import estimate_zones, local_pairs, normalise_timestamps, not_canonical
from tidemark.runtime import checkpoint, shared_folder, table
from tidemark.settings import HISTORY_SOURCES, DiffusionSettings
from tidemark.sources import adapters, jsonld
from tidemark.streaming import ingest

FLAGSHIP = "share_year"
SETTINGS = replace(DiffusionSettings(), min_cell=30)
#: For what the few dated postings of the following segment leave empty: every source counts as dated, cells may be thin.
WIDE = replace(SETTINGS, min_cell=3, lead_share_min=0.015, trend_min=0.002, min_history_months=3)
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the DuckDB SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query()
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs, config = table(spark, sf_dir, "jobs"), table(spark, sf_dir, "source_config")
    found = normalise_timestamps(jobs, config, ["date_posted", "valid_through", "fetched_at"])
    return not_canonical(found).select("row_id", "field_name", "utc_us")


@query()
def p1_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ingestion times say about each source's zone, whatever the configuration states; `zone` stands for its history of offsets."""
    config = table(spark, sf_dir, "source_config").groupBy("source").agg(F.min("day_first").alias("day_first"))
    rows = table(spark, sf_dir, "jobs").where("source is not null").select("source", "date_posted", "fetched_at").join(config, "source", "left")
    return estimate_zones(local_pairs(rows, ["date_posted"], "fetched_at"))


# ---------------------------------------------------------------- documents, tags and shares


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current postings' keys: the texts don't travel through the upsert's shuffle."""
    return shares.current_postings(table(spark, sf_dir, "jobs").select("job_id", "row_id", "source", "native_id", "segment", "year", "month"))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares.drop_replays(postings(spark, sf_dir))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "job_skills")


def history_of(spark: SparkSession, sf_dir: str, s: DiffusionSettings) -> tuple[str, ...]:
    """The sources that count as dated; for WIDE all that are configured, a table of some dozen rows."""
    return tuple(sorted(r.source for r in table(spark, sf_dir, "source_config").select("source").collect())) if s is WIDE else HISTORY_SOURCES


def frames(spark: SparkSession, sf_dir: str, s: DiffusionSettings = SETTINGS) -> dict[str, DataFrame]:
    return shares.share_frames(docs(spark, sf_dir), tags(spark, sf_dir), history_of(spark, sf_dir, s), s.min_cell)


def compared(spark: SparkSession, sf_dir: str, s: DiffusionSettings = SETTINGS) -> DataFrame:
    """The diffusion frame; the documents and the folded tags under its three share frames are made once."""
    known = checkpoint(docs(spark, sf_dir).select("job_id", "source", "segment", "year", "month"))
    history = history_of(spark, sf_dir, s)
    folded = checkpoint(shares.fold_tags(known, tags(spark, sf_dir), history))
    f = shares.share_frames(known, folded, history, s.min_cell, folded=True)
    return diffusion.build_diffusion(f["current"], f["month"], f["year"], known, s)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


LAST = """last AS (SELECT * REPLACE (CASE WHEN year BETWEEN 2015 AND 2030 THEN year END AS year, CASE WHEN year BETWEEN 2015 AND 2030 THEN month END AS month)
    FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY row_id DESC) AS rn FROM jobs) WHERE rn = 1)"""
DOCS = f"""{LAST}, docs AS (SELECT * FROM last l WHERE NOT coalesce(starts_with(source, 'wayback_'), false) OR NOT EXISTS (
    SELECT 1 FROM last k WHERE NOT coalesce(starts_with(k.source, 'wayback_'), false) AND k.source = substring(l.source, 9) AND k.native_id = l.native_id))"""
DATED = "(source IN ('threadwork', 'wayback') OR starts_with(source, 'wayback_'))"


ANY_SOURCE = "source IN (SELECT source FROM source_config)"


def share_ctes(name: str, keys: str, where: str = "true", s: DiffusionSettings = SETTINGS) -> str:
    """CTEs of one share frame called `name` over `docs`."""
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
    on = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys.split(", "))
    d = f"(SELECT * FROM docs WHERE {where} AND {known})"
    dk = ", ".join(f"d.{k}" for k in keys.split(", "))
    return f"""{name}_t AS (SELECT {keys}, count(*) AS n_jobs_total FROM {d} GROUP BY {keys}),
    {name}_g AS (SELECT {dk}, count(DISTINCT s.job_id) AS n_tech_jobs, count(*) AS n_slots FROM job_skills s JOIN {d} d ON s.job_id = d.job_id GROUP BY {dk}),
    {name}_m AS (SELECT {dk}, s.skill, s.track, s.category, count(DISTINCT s.job_id) AS n_mentions FROM job_skills s JOIN {d} d ON s.job_id = d.job_id
        WHERE s.skill IS NOT NULL AND s.track IS NOT NULL AND s.category IS NOT NULL GROUP BY {dk}, s.skill, s.track, s.category),
    {name} AS (SELECT m.*, t.n_jobs_total, g.n_tech_jobs, g.n_slots, n_mentions / n_jobs_total AS pct_of_all, n_mentions / n_tech_jobs AS pct_of_tech, n_mentions / n_slots AS share_of_mentions,
        n_mentions / n_tech_jobs AS pct_share, coalesce(n_tech_jobs, 0) >= {s.min_cell} AS usable FROM {name}_m m JOIN {name}_t t ON {on("m", "t")} LEFT JOIN {name}_g g ON {on("m", "g")})"""


CURRENT, YEAR, MONTH = share_ctes("cur", "segment"), share_ctes("yr", "segment, year", DATED), share_ctes("mon", "segment, month", DATED)


@query(f"WITH {DOCS}, {CURRENT} SELECT * FROM cur")
def share_current(spark, sf_dir):
    return frames(spark, sf_dir)["current"]


@query(f"WITH {DOCS}, {YEAR} SELECT * FROM yr")
def share_year(spark, sf_dir):
    return frames(spark, sf_dir)["year"]


@query(f"WITH {DOCS}, {MONTH} SELECT * FROM mon")
def share_month(spark, sf_dir):
    return frames(spark, sf_dir)["month"]


@query(f"WITH {DOCS} SELECT job_id, source, native_id, segment, year, month FROM docs")
def replay_dedupe(spark, sf_dir):
    return docs(spark, sf_dir).select("job_id", "source", "native_id", "segment", "year", "month")


@query(f"WITH {DOCS} SELECT s.job_id, s.skill, s.track, d.source, d.segment, d.year FROM job_skills s JOIN docs d ON s.job_id = d.job_id")
def slots_semi(spark, sf_dir):
    return shares.slots(tags(spark, sf_dir), docs(spark, sf_dir), ["source", "segment", "year"]).select("job_id", "skill", "track", "source", "segment", "year")


# ---------------------------------------------------------------- diffusion

PIVOT = """piv AS (SELECT skill, track, category, coalesce(max(CASE WHEN segment = 'GLOBAL' THEN pct_share END), 0) AS lead_share_now, coalesce(max(CASE WHEN segment = 'KE' THEN pct_share END), 0) AS follow_share_now FROM cur GROUP BY skill, track, category)"""
CALIBRATION = f"""cal AS (SELECT CASE WHEN count(*) >= 3 THEN median(lead_share_now - follow_share_now) ELSE 0 END AS "offset", count(*) >= 3 AS offset_applied FROM piv WHERE skill IN ({", ".join(f"'{b}'" for b in SETTINGS.baselines)}))"""
TREND = """ms AS (SELECT month, row_number() OVER (ORDER BY month DESC) AS r FROM (SELECT DISTINCT month FROM mon WHERE segment = 'GLOBAL')),
    sz AS (SELECT count(*) FILTER (r <= 6) AS recent, count(*) FILTER (r BETWEEN 7 AND 12) AS prior FROM ms),
    tr AS (SELECT skill, coalesce(sum(pct_share) FILTER (r <= 6), 0) / any_value(recent) - coalesce(sum(pct_share) FILTER (r BETWEEN 7 AND 12), 0) / any_value(prior) AS lead_trend, count(DISTINCT mon.month) AS months_observed
        FROM mon JOIN ms ON mon.month = ms.month CROSS JOIN sz WHERE segment = 'GLOBAL' AND prior > 0 GROUP BY skill)"""


def yoy_cte(name: str, segment: str) -> str:
    return f"""{name} AS (SELECT skill, coalesce(max(pct_share) FILTER (year = 2024), 0) AS share_from, coalesce(max(pct_share) FILTER (year = 2025), 0) AS share_to, share_to - share_from AS change
        FROM yr WHERE segment = '{segment}' AND usable AND (SELECT count(DISTINCT year) FROM yr WHERE segment = '{segment}' AND usable AND year IN (2024, 2025)) = 2 GROUP BY skill)"""


YOY_LEAD, YOY_FOLLOW = yoy_cte("ya", "GLOBAL"), yoy_cte("yb", "KE")
def diffusion_ctes(s: DiffusionSettings, dated: str) -> str:
    """All CTEs of the diffusion frame `dif`."""
    current, year, month = share_ctes("cur", "segment", s=s), share_ctes("yr", "segment, year", dated, s), share_ctes("mon", "segment, month", dated, s)
    return f"""{DOCS}, {current}, {year}, {month}, {PIVOT}, {CALIBRATION}, {TREND}, {YOY_FOLLOW},
    us AS (SELECT coalesce(bool_or(CASE WHEN segment = 'GLOBAL' THEN usable END), true) AND coalesce(bool_or(CASE WHEN segment = 'KE' THEN usable END), true) AS cell_usable FROM cur),
    hi AS (SELECT count(DISTINCT month) >= {s.min_history_months} AS history FROM docs WHERE segment = 'KE'),
    x AS (SELECT piv.*, lead_share_now - follow_share_now AS diffusion_gap, lead_share_now - follow_share_now - "offset" AS calibrated_gap, tr.lead_trend AS lead_trend_12m, CASE WHEN history THEN yb.change END AS follow_trend_12m, coalesce(tr.months_observed, 0) AS months_observed, cell_usable, history
        FROM piv CROSS JOIN cal CROSS JOIN us CROSS JOIN hi LEFT JOIN tr ON piv.skill = tr.skill LEFT JOIN yb ON piv.skill = yb.skill),
    dif AS (SELECT *, CAST(rank() OVER (ORDER BY calibrated_gap DESC) AS DOUBLE) AS gap_rank,
        CASE WHEN NOT cell_usable THEN 'insufficient_data' WHEN calibrated_gap < {s.gap_floor} THEN 'kenya_specific'
             WHEN lead_share_now >= {s.lead_share_min} AND follow_share_now <= {s.follow_share_max} THEN CASE WHEN lead_trend_12m >= {s.trend_min} THEN 'teach_ahead' WHEN lead_trend_12m <= {-s.trend_min} THEN 'declining_both' ELSE 'global_only' END
             WHEN lead_share_now >= {s.lead_share_min} THEN CASE WHEN lead_trend_12m >= {s.trend_min} THEN 'arriving' ELSE 'established_both' END
             WHEN follow_share_now > {s.follow_share_max} THEN 'established_both' ELSE 'low_demand' END AS status FROM x)"""


DIFFUSION, WIDE_DIFFUSION = diffusion_ctes(SETTINGS, DATED), diffusion_ctes(WIDE, ANY_SOURCE)
WIDE_YEAR = share_ctes("yr", "segment, year", ANY_SOURCE, WIDE)
BASE = ", ".join(f"'{b}'" for b in SETTINGS.baselines)


@query(f"WITH {DOCS}, {CURRENT}, {PIVOT} SELECT * FROM piv")
def segment_pivot(spark, sf_dir):
    return diffusion.segment_pivot(frames(spark, sf_dir)["current"], SETTINGS)


@query(f'WITH {DOCS}, {CURRENT}, {PIVOT}, {CALIBRATION} SELECT round("offset", 9) AS "offset", offset_applied FROM cal')
def calibration_offset(spark, sf_dir):
    return rounded(diffusion.calibration(diffusion.segment_pivot(frames(spark, sf_dir)["current"], SETTINGS), SETTINGS), "offset")


@query(f"WITH {DOCS}, {MONTH}, {TREND} SELECT skill, round(lead_trend, 9) AS lead_trend, months_observed FROM tr")
def lead_trend(spark, sf_dir):
    return rounded(diffusion.lead_trend(frames(spark, sf_dir)["month"], SETTINGS), "lead_trend")


@query(f"WITH {DOCS}, {YEAR}, {YOY_LEAD} SELECT * FROM ya")
def yoy_lead(spark, sf_dir):
    return diffusion.year_over_year(frames(spark, sf_dir)["year"], "GLOBAL", 2024, 2025)


@query(f"WITH {DOCS}, {WIDE_YEAR}, {YOY_FOLLOW} SELECT * FROM yb")
def yoy_follow(spark, sf_dir):
    return diffusion.year_over_year(frames(spark, sf_dir, WIDE)["year"], "KE", 2024, 2025)


@query(f"""WITH {DIFFUSION} SELECT skill, track, category, round(lead_share_now, 9) AS lead_share_now, round(follow_share_now, 9) AS follow_share_now, round(diffusion_gap, 9) AS diffusion_gap, round(calibrated_gap, 9) AS calibrated_gap, gap_rank,
    round(lead_trend_12m, 9) AS lead_trend_12m, round(follow_trend_12m, 9) AS follow_trend_12m, CAST(NULL AS DOUBLE) AS estimated_lag_months, status,
    CASE status WHEN 'insufficient_data' THEN 'none' WHEN 'kenya_specific' THEN 'medium' WHEN 'teach_ahead' THEN CASE WHEN history THEN 'medium' ELSE 'provisional' END WHEN 'declining_both' THEN 'low'
        WHEN 'global_only' THEN CASE WHEN history THEN 'low' ELSE 'provisional' END WHEN 'established_both' THEN CASE WHEN lead_share_now >= 0.05 THEN 'medium' ELSE 'low' END ELSE 'medium' END AS confidence,
    skill IN ({BASE}) AS is_calibration_baseline, months_observed, cell_usable FROM dif""")  # fmt: skip
def diffusion_frame(spark, sf_dir):
    return rounded(compared(spark, sf_dir), "lead_share_now", "follow_share_now", "diffusion_gap", "calibrated_gap", "lead_trend_12m", "follow_trend_12m")


@query(f"WITH {WIDE_DIFFUSION} SELECT skill, track, round(calibrated_gap, 9) AS calibrated_gap, round(lead_trend_12m, 9) AS lead_trend_12m FROM dif WHERE status = 'teach_ahead' ORDER BY dif.calibrated_gap DESC, dif.lead_trend_12m DESC NULLS LAST, skill LIMIT 25")
def watchlist(spark, sf_dir):
    return rounded(diffusion.watchlist(compared(spark, sf_dir, WIDE)), "calibrated_gap", "lead_trend_12m").select("skill", "track", "calibrated_gap", "lead_trend_12m")


@query(f"WITH {DIFFUSION} SELECT skill, track, round(calibrated_gap, 9) AS calibrated_gap FROM dif WHERE status = 'kenya_specific' ORDER BY dif.calibrated_gap, skill LIMIT 10")
def own_demand(spark, sf_dir):
    return rounded(diffusion.own_demand(compared(spark, sf_dir)), "calibrated_gap").select("skill", "track", "calibrated_gap")


@query(f"""WITH {DIFFUSION} SELECT track, count(*) AS skills, count(*) FILTER (status = 'teach_ahead') AS teach_ahead, count(*) FILTER (status = 'established_both') AS established_both, count(*) FILTER (status = 'kenya_specific') AS kenya_specific,
    count(*) FILTER (status = 'global_only') AS global_only, count(*) FILTER (status = 'low_demand') AS low_demand, round(avg(lead_share_now), 9) AS mean_lead_share, round(avg(follow_share_now), 9) AS mean_follow_share FROM dif GROUP BY track""")  # fmt: skip
def track_summary(spark, sf_dir):
    return rounded(diffusion.track_summary(compared(spark, sf_dir)), "mean_lead_share", "mean_follow_share")


@query(f"WITH {DIFFUSION} SELECT status, count(*) AS skills, (SELECT round(avg(CAST(diffusion_gap > 0 AS INT)), 3) FROM dif) AS positive_gap_share FROM dif GROUP BY status")
def status_counts(spark, sf_dir):
    return diffusion.diagnostics(compared(spark, sf_dir))


@query(f"WITH {WIDE_DIFFUSION} SELECT status, count(*) AS skills, (SELECT round(avg(CAST(diffusion_gap > 0 AS INT)), 3) FROM dif) AS positive_gap_share FROM dif GROUP BY status")
def status_counts_wide(spark, sf_dir):
    return diffusion.diagnostics(compared(spark, sf_dir, WIDE))


MOVERS = """WITH {d}, both_t AS (SELECT skill, {c} AS t FROM dif WHERE lead_trend_12m IS NOT NULL AND follow_trend_12m IS NOT NULL)
    SELECT 'rise' AS direction, skill, round(t * 100, 2) AS points FROM (SELECT * FROM both_t ORDER BY t DESC, skill LIMIT 10) UNION ALL SELECT 'fall', skill, round(t * 100, 2) FROM (SELECT * FROM both_t ORDER BY t, skill LIMIT 10)"""


@query(MOVERS.format(d=WIDE_DIFFUSION, c="lead_trend_12m"))
def movers_lead(spark, sf_dir):
    return diffusion.movers(compared(spark, sf_dir, WIDE), "lead_trend_12m")


@query(MOVERS.format(d=WIDE_DIFFUSION, c="follow_trend_12m"))
def movers_follow(spark, sf_dir):
    return diffusion.movers(compared(spark, sf_dir, WIDE), "follow_trend_12m")


@query(f"""WITH {DOCS}, {WIDE_YEAR}, {YOY_LEAD}, {YOY_FOLLOW}, j AS (SELECT ya.skill, ya.change AS a, yb.change AS b FROM ya JOIN yb ON ya.skill = yb.skill WHERE ya.share_to >= 0.01 OR yb.share_to >= 0.01),
    g AS (SELECT count(*) AS n, count(*) FILTER (a >= 0.005) AS risers, count(*) FILTER (a >= 0.005 AND b > 0) AS hit, count(*) FILTER (b > 0) AS up, corr(a, b) AS r,
        string_agg(skill, ', ' ORDER BY skill) FILTER (a >= 0.005 AND b > 0) AS hits, string_agg(skill, ', ' ORDER BY skill) FILTER (a >= 0.005 AND NOT b > 0) AS misses FROM j)
    SELECT n AS n_comparable, risers AS n_risers, hit AS n_hits, CASE WHEN n >= 10 AND risers > 0 THEN round(hit / risers, 3) END AS hit_rate, CASE WHEN n >= 10 THEN round(up / n, 3) END AS base_rate,
        CASE WHEN n >= 10 AND risers > 0 THEN round(hit / risers - up / n, 3) END AS lift, CASE WHEN n >= 10 THEN round(r, 3) END AS corr, coalesce(hits, '') AS hits, coalesce(misses, '') AS misses,
        CASE WHEN n < 10 THEN 'too few comparable skills' END AS error FROM g""")  # fmt: skip
def backtest(spark, sf_dir):
    return diffusion.backtest(frames(spark, sf_dir, WIDE)["year"], WIDE)


# ---------------------------------------------------------------- briefs and counts

COVERAGE = """cov AS (SELECT track, coalesce(max(CASE WHEN segment = 'GLOBAL' THEN c END), 0) AS lead_coverage, coalesce(max(CASE WHEN segment = 'KE' THEN c END), 0) AS follow_coverage FROM (
    SELECT d.segment, s.track, count(DISTINCT s.job_id) / any_value(n) AS c FROM job_skills s JOIN docs d ON s.job_id = d.job_id
    JOIN (SELECT d.segment, count(DISTINCT s.job_id) AS n FROM job_skills s JOIN docs d ON s.job_id = d.job_id GROUP BY d.segment) t ON t.segment = d.segment
    WHERE d.segment IN ('GLOBAL', 'KE') GROUP BY d.segment, s.track) GROUP BY track)"""


@query(f"WITH {DOCS}, {COVERAGE} SELECT * FROM cov")
def track_coverage(spark, sf_dir):
    return briefs.track_coverage(tags(spark, sf_dir), docs(spark, sf_dir), SETTINGS)


@query(f"""WITH {DIFFUSION}, a AS (SELECT *, CASE status WHEN 'teach_ahead' THEN 'add' WHEN 'arriving' THEN 'expand' WHEN 'established_both' THEN 'hold' WHEN 'kenya_specific' THEN 'hold' WHEN 'global_only' THEN 'watch' WHEN 'declining_both' THEN 'retire' WHEN 'low_demand' THEN 'minor' ELSE 'unknown' END AS action FROM dif)
    SELECT track, action, place, skill, round(calibrated_gap, 9) AS calibrated_gap FROM (SELECT *, row_number() OVER (PARTITION BY track, action ORDER BY calibrated_gap DESC, skill) AS place FROM a) WHERE place <= 6""")  # fmt: skip
def briefs_topn(spark, sf_dir):
    return rounded(briefs.top_by_action(compared(spark, sf_dir)), "calibrated_gap")


@query(f"""WITH {DIFFUSION}, {COVERAGE}, a AS (SELECT *, CASE status WHEN 'teach_ahead' THEN 'add' WHEN 'arriving' THEN 'expand' WHEN 'established_both' THEN 'hold' WHEN 'kenya_specific' THEN 'hold' WHEN 'global_only' THEN 'watch' WHEN 'declining_both' THEN 'retire' WHEN 'low_demand' THEN 'minor' ELSE 'unknown' END AS action FROM dif)
    SELECT a.track, any_value(coalesce(lead_coverage, 0)) AS lead_coverage, any_value(coalesce(follow_coverage, 0)) AS follow_coverage, any_value(n_skills) AS n_skills, action, string_agg(skill, ', ' ORDER BY calibrated_gap DESC, skill) AS skills
    FROM a JOIN (SELECT track, count(*) AS n_skills FROM dif GROUP BY track) n ON n.track = a.track LEFT JOIN cov ON cov.track = a.track GROUP BY a.track, action""")  # fmt: skip
def track_briefs(spark, sf_dir):
    b = briefs.build_briefs(compared(spark, sf_dir), briefs.track_coverage(tags(spark, sf_dir), docs(spark, sf_dir), SETTINGS))
    each = b.select("track", "lead_coverage", "follow_coverage", F.col("n_skills").cast("bigint").alias("n_skills"), F.explode("actions").alias("action", "x"))
    return each.select("track", "lead_coverage", "follow_coverage", "n_skills", "action", F.array_join(F.col("x.skill"), ", ").alias("skills"))


@query(f"WITH {DOCS}, {CURRENT}, {PIVOT} SELECT track, row_number() OVER (PARTITION BY track ORDER BY lead_share_now DESC, skill) AS place, skill, lead_share_now FROM piv")
def role_view(spark, sf_dir):
    return briefs.role_view(diffusion.segment_pivot(frames(spark, sf_dir)["current"], SETTINGS))


@query(f"WITH {DOCS} SELECT s.skill, s.track, count(DISTINCT s.job_id) AS n FROM job_skills s JOIN docs d ON s.job_id = d.job_id GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 20")
def top_terms(spark, sf_dir):
    one = shares.slots(tags(spark, sf_dir), docs(spark, sf_dir), []).groupBy("skill", "track", "job_id").agg(F.lit(1).alias("x"))
    return store.counts(one, "skill", "track").limit(20)


@query("SELECT source, count(*) AS n FROM jobs GROUP BY source")
def counts_by_source(spark, sf_dir):
    return store.counts(table(spark, sf_dir, "jobs"), "source")


@query(f"WITH {LAST} SELECT segment, year, count(*) AS n FROM last WHERE year IS NOT NULL GROUP BY 1, 2")
def counts_by_group_year(spark, sf_dir):
    return store.counts(postings(spark, sf_dir).where("year is not null"), "segment", "year")


@query(f"WITH {LAST} SELECT segment, year, count(*) AS n FROM last WHERE year IS NOT NULL AND (source = 'threadwork' OR starts_with(source, 'threadwork_') OR source = 'wayback' OR starts_with(source, 'wayback_')) GROUP BY 1, 2")
def history_counts(spark, sf_dir):
    rows = postings(spark, sf_dir)
    return store.counts(rows.where("year is not null").where(store.history_predicate(F.col("source"), HISTORY_SOURCES)), "segment", "year")


@query(f"WITH {LAST} SELECT segment, {DATED} AS dated, count(*) AS n FROM last GROUP BY 1, 2")
def history_mask(spark, sf_dir):
    rows = postings(spark, sf_dir)
    return store.counts(rows.withColumn("dated", store.history_mask(F.col("source"), HISTORY_SOURCES)), "segment", "dated")


@query("SELECT (SELECT count(DISTINCT job_id) FROM jobs) AS jobs, (SELECT count(*) FROM job_skills) AS skill_matches, (SELECT count(DISTINCT job_id) FROM job_skills) AS jobs_with_skills, (SELECT count(*) FROM crawl_queue WHERE state = 'failed') AS failures")
def store_counts(spark, sf_dir):
    a = table(spark, sf_dir, "jobs").agg(F.countDistinct("job_id").alias("jobs"))
    b = tags(spark, sf_dir).agg(F.count("*").alias("skill_matches"), F.countDistinct("job_id").alias("jobs_with_skills"))
    c = table(spark, sf_dir, "crawl_queue").agg(F.count_if(F.col("state") == "failed").alias("failures"))
    return a.crossJoin(F.broadcast(b)).crossJoin(F.broadcast(c))  # three one-row frames


@query("SELECT state, count(*) AS n FROM crawl_queue GROUP BY state")
def queue_stats(spark, sf_dir):
    return store.counts(table(spark, sf_dir, "crawl_queue"), "state")


@query("SELECT stage, count(*) AS runs, count(ended_at) AS ended, CAST(sum(CAST(stats->>'$.rows' AS BIGINT)) AS BIGINT) AS handled FROM run_log GROUP BY stage")
def run_report(spark, sf_dir):
    handled = F.get_json_object("stats", "$.rows").cast("bigint")
    return table(spark, sf_dir, "run_log").groupBy("stage").agg(F.count("*").alias("runs"), F.count("ended_at").alias("ended"), F.sum(handled).alias("handled"))


# ---------------------------------------------------------------- store operators


@query("SELECT job_id, row_id, batch_no, title, company FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY row_id DESC) AS rn FROM jobs) WHERE rn = 1")
def upsert_last_wins(spark, sf_dir):
    jobs = table(spark, sf_dir, "jobs").select("job_id", "row_id", "batch_no", "title", "company")
    old, new = jobs.where("batch_no <= 3"), jobs.where("batch_no > 3 or batch_no is null")
    return store.upsert(old, new, ["job_id"], ["row_id"])


@query("SELECT url, min(queued_at) AS queued_at FROM crawl_queue WHERE kind = 'listing' AND url NOT IN (SELECT url FROM crawl_queue WHERE kind = 'detail') GROUP BY url")
def insert_ignore(spark, sf_dir):
    q = table(spark, sf_dir, "crawl_queue")
    return store.insert_ignore(q.where("kind = 'detail'"), q.where("kind = 'listing'"), "url", ["queued_at"]).select("url", "queued_at")


@query("""SELECT url, source, state, attempts, note FROM (SELECT url, source, state, note, sum(attempts) OVER (PARTITION BY url)::BIGINT AS attempts,
    row_number() OVER (PARTITION BY url ORDER BY coalesce(updated_at, queued_at) DESC, CASE state WHEN 'pending' THEN 0 WHEN 'failed' THEN 1 ELSE 2 END DESC, coalesce(note, '') DESC) AS rn FROM crawl_queue) WHERE rn = 1""")
def queue_latest_state(spark, sf_dir):
    return store.latest_state(table(spark, sf_dir, "crawl_queue"))


@query("SELECT CASE WHEN state = 'failed' AND attempts < 3 THEN 'pending' ELSE state END AS state, count(*) AS n FROM crawl_queue GROUP BY 1")
def requeue(spark, sf_dir):
    return store.counts(store.requeue_failed(table(spark, sf_dir, "crawl_queue"), 3), "state")


@query("SELECT url, queued_at FROM crawl_queue WHERE state = 'pending' ORDER BY queued_at, url LIMIT 100")
def queue_head(spark, sf_dir):
    return store.next_pending(table(spark, sf_dir, "crawl_queue"), 100).select("url", "queued_at")


@query("SELECT job_id, skill, n_mentions FROM job_skills WHERE matched_in <> 'both' AND job_id NOT IN (SELECT job_id FROM job_skills WHERE matched_in = 'both') UNION ALL SELECT job_id, skill, n_mentions FROM job_skills WHERE matched_in = 'both'")
def replace_skills(spark, sf_dir):
    t = tags(spark, sf_dir).select("job_id", "skill", "n_mentions", "matched_in")
    return store.replace_keys(t.where("matched_in <> 'both'"), t.where("matched_in = 'both'"), "job_id").drop("matched_in")


@query("SELECT count(*) AS entries, CAST(coalesce(sum(octet_length(encode(body))), 0) AS BIGINT) AS bytes FROM (SELECT url, arg_max(body, (fetched_at, row_id)) AS body FROM (SELECT url, row_id, description_html AS body, batch_no AS fetched_at FROM jobs WHERE url IS NOT NULL AND description_html IS NOT NULL AND batch_no >= 3) GROUP BY url)")
def response_cache(spark, sf_dir):
    rows = table(spark, sf_dir, "jobs").where("url is not null and description_html is not null").select("url", "row_id", F.encode("description_html", "UTF-8").alias("body"), F.timestamp_seconds("batch_no").alias("fetched_at"))
    newest = store.cache_lookup(rows.withColumn("fetched_at", F.col("fetched_at")), F.timestamp_seconds(F.lit(103)), 100.0)
    return store.cache_stats(store.keep_last(rows.where(F.unix_seconds("fetched_at") >= 3), ["url"], ["fetched_at", "row_id"]).join(newest.select("url"), "url", "left_semi"))


# ---------------------------------------------------------------- functions


@query("SELECT row_id, substring(sha1(source || ':' || native_id), 1, 16) AS derived, substring(sha1(source || ':' || native_id), 1, 16) = job_id AS agrees FROM jobs WHERE native_id IS NOT NULL")
def job_identity(spark, sf_dir):
    d = T.job_id(F.col("source"), F.col("native_id"))
    return table(spark, sf_dir, "jobs").where("native_id is not null").select("row_id", d.alias("derived"), (d == F.col("job_id")).alias("agrees"))


@query(r"SELECT row_id, trim(regexp_replace(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) || '|' || regexp_replace(lower(coalesce(company, '')), '[^a-z0-9]', '', 'g') AS dedupe_key FROM jobs")
def dedupe_key(spark, sf_dir):
    return table(spark, sf_dir, "jobs").select("row_id", T.dedupe_key(F.col("title"), F.col("company")).alias("dedupe_key"))


@query(r"""SELECT row_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)) AS domain, CASE WHEN regexp_extract(url, '[?&]page=(\d{1,9})', 1) = '' THEN 1 ELSE TRY_CAST(regexp_extract(url, '[?&]page=(\d{1,9})', 1) AS INT) END AS page,
    regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS canonical, split_part(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '/', -1) AS last_segment FROM jobs WHERE url IS NOT NULL""")
def url_parts(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "jobs").where("url is not null").select("row_id", T.url_domain(u).alias("domain"), T.url_page(u).alias("page"), T.url_canonical(u).alias("canonical"), T.url_last_segment(u).alias("last_segment"))


@query(r"""SELECT row_id, CASE WHEN trim(t) = '' THEN NULL WHEN regexp_matches(t, '(?i)\b(?:fully[- ]remote|100% remote|work from home|remote[- ]first|remote \(|remote,|remote$|anywhere in the world|distributed team)\b') THEN true
    WHEN regexp_matches(t, '(?i)\b(?:on[- ]?site|in[- ]office|hybrid)\b') THEN false END AS remote FROM (SELECT row_id, concat_ws(' ', nullif(location, ''), nullif(title, '')) AS t FROM jobs)""")
def remote_flag(spark, sf_dir):
    return table(spark, sf_dir, "jobs").select("row_id", T.infer_remote(F.col("location"), F.col("title")).alias("remote"))


@query(r"""SELECT row_id, CASE WHEN title IS NULL OR title = '' THEN NULL WHEN regexp_matches(title, '(?i)\b(?:intern|internship|graduate trainee|attach[eé])\b') THEN 'intern' WHEN regexp_matches(title, '(?i)\b(?:junior|jr\.?|entry[- ]level|associate|graduate|trainee)\b') THEN 'junior'
    WHEN regexp_matches(title, '(?i)\b(?:lead|principal|staff|head of|director|vp|chief|architect)\b') THEN 'lead' WHEN regexp_matches(title, '(?i)\b(?:senior|snr\.?|sr\.?|experienced)\b') THEN 'senior' END AS seniority FROM jobs""")
def seniority(spark, sf_dir):
    return table(spark, sf_dir, "jobs").select("row_id", T.infer_seniority(F.col("title")).alias("seniority"))


SENTENCES = r"string_split_regex(regexp_replace(coalesce(text, ''), '([.!?])\s+', '\1' || chr(10), 'g'), '\n+')"


@query(rf"SELECT doc_id, len(list_filter({SENTENCES}, lambda s: trim(s) <> '')) AS n FROM documents")
def sentences_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(T.sentences(F.col("text"))).cast("bigint").alias("n"))


@query()
def html_text(spark, sf_dir):
    return table(spark, sf_dir, "jobs").select("row_id", T.html_to_text(F.col("description_html")).alias("text"))


@query("SELECT row_id, extra->>'$.feed' AS feed, TRY_CAST(extra->>'$.page' AS DOUBLE) AS page FROM jobs WHERE extra IS NOT NULL")
def json_props(spark, sf_dir):
    return table(spark, sf_dir, "jobs").where("extra is not null").select("row_id", F.get_json_object("extra", "$.feed").alias("feed"), F.get_json_object("extra", "$.page").try_cast("double").alias("page"))


# ---------------------------------------------------------------- extraction

# the patterns' word boundaries know ASCII letters only there, so marked letters lose their marks first
EXTRACT = rf"""sents AS (SELECT doc_id, unnest({SENTENCES.replace("text", "replace(strip_accents(text), 'ß', 'ss')")}) AS s FROM documents), hits AS (
    SELECT doc_id, skill, track, len(regexp_extract_all(s, '(?i)' || match_pattern)) AS k FROM sents CROSS JOIN taxonomy
    WHERE regexp_matches(s, '(?i)' || match_pattern) AND (negative_context IS NULL OR NOT regexp_matches(s, '(?i)' || negative_context))),
    ext AS (SELECT doc_id, skill, track, CAST(sum(k) AS BIGINT) AS n_mentions FROM hits GROUP BY ALL)"""


def extracted(spark, sf_dir):
    return extraction.extract_terms(table(spark, sf_dir, "documents"), table(spark, sf_dir, "taxonomy"), "doc_id", None, "text")


@query(f"WITH {EXTRACT} SELECT * FROM ext")
def term_extract(spark, sf_dir):
    return extracted(spark, sf_dir).select("doc_id", "skill", "track", F.col("n_mentions").cast("bigint").alias("n_mentions"))


@query(f"WITH {EXTRACT} SELECT (SELECT count(*) FROM documents) AS jobs, count(DISTINCT doc_id) AS jobs_with_skills, count(*) AS matches, round(count(DISTINCT doc_id) / (SELECT count(*) FROM documents), 4) AS coverage FROM ext")
def extraction_stats(spark, sf_dir):
    return extraction.extraction_stats(table(spark, sf_dir, "documents"), extracted(spark, sf_dir), "doc_id")


@query()
def posting_terms(spark, sf_dir):
    rows = table(spark, sf_dir, "jobs").select("row_id", "title", T.html_to_text(F.col("description_html")).alias("text"))
    return extraction.extract_terms(rows, table(spark, sf_dir, "taxonomy"), "row_id", "title", "text")


CONFIRMED = rf"""{EXTRACT}, judged AS (SELECT ext.*, d.segment, regexp_matches(strip_accents(coalesce(d.text, '')), '(?i)(^|[^a-z0-9_])' || regexp_escape(trim(split_part(skill, '(', 1))) || '([^a-z0-9_]|$)') AS ok FROM ext JOIN documents d USING (doc_id))"""


def judged(spark, sf_dir):
    return extracted(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "segment"), "doc_id")


@query(f"WITH {CONFIRMED} SELECT segment, count(*) AS matches, count(*) FILTER (ok) AS confirmed, count(*) FILTER (ok) / count(*) AS precision, count(*) FILTER (ok) / count(*) >= 0.9 AS passes FROM judged GROUP BY segment")
def precision_gate(spark, sf_dir):
    return extraction.precision_gate(judged(spark, sf_dir), "segment")


@query(f"WITH {CONFIRMED} SELECT segment, place, skill, n FROM (SELECT segment, skill, count(*) AS n, row_number() OVER (PARTITION BY segment ORDER BY count(*) DESC, skill) AS place FROM judged WHERE NOT ok GROUP BY segment, skill) WHERE place <= 8")
def suspects(spark, sf_dir):
    return extraction.suspects(judged(spark, sf_dir), "segment")


# ---------------------------------------------------------------- sources


def payloads(rows: DataFrame, body, board: str, key: str = "jobs") -> DataFrame:
    """Postings as the payloads their board would send: pages of about 50 rows, listed under `key`."""
    page = F.floor(F.col("row_id") / 50).alias("page")
    listed = rows.groupBy(page).agg(F.collect_list(body).alias(key), F.min("segment").alias("segment"))
    return listed.select(F.concat(F.lit("https://x.example/boards/"), F.lit(board)).alias("url"), F.lit(board).alias("source"), "segment", F.to_json(F.struct(key)).alias("body"), F.lit(None).cast("timestamp").alias("fetched_at"))


ADAPTED = "SELECT source, native_id, title, coalesce(description_html, '') AS description_html, {company} AS company, location, is_remote, date_posted FROM jobs WHERE source = '{source}' AND native_id <> '' AND trim(title) <> ''"
COLUMNS = ("source", "native_id", "title", "description_html", "company", "location", "is_remote", "date_posted")


@query(ADAPTED.format(source="stackhire", company="CAST(NULL AS VARCHAR)").replace("is_remote,", "coalesce(is_remote, false) AS is_remote,").replace("title,", "trim(title) AS title,"))
def adapter_board_b(spark, sf_dir):
    rows = table(spark, sf_dir, "jobs").where("source = 'stackhire'").withColumn("is_remote", F.coalesce("is_remote", F.lit(False)))
    body = F.struct(F.col("native_id").alias("id"), "title", "location", F.col("is_remote").alias("isRemote"), F.lit(True).alias("isListed"), F.col("date_posted").alias("publishedAt"), F.col("description_html").alias("descriptionHtml"))
    return adapters.ats_board_b(payloads(rows, body, "stackhire")).select(*COLUMNS)


@query(ADAPTED.format(source="farposts", company="company").replace("is_remote,", "true AS is_remote,").replace("native_id,", "trim(native_id) AS native_id,").replace("title,", "trim(title) AS title,"))
def adapter_remote_board(spark, sf_dir):
    rows = table(spark, sf_dir, "jobs").where("source = 'farposts'")
    body = F.struct(F.col("native_id").alias("id"), "title", F.col("location").alias("candidate_required_location"), F.col("company").alias("company_name"), F.col("date_posted").alias("publication_date"), F.col("description_html").alias("description"))
    return adapters.REGISTRY["farposts"][1](payloads(rows, body, "farposts")).select(*COLUMNS)


def remote_fields(name: str):
    """A posting as the remote board `name` would list it: its own field names, a list or by turns a scalar where it may send either."""

    def sent(c: str, f: str):
        if f.endswith("*"):
            return F.when(F.col("row_id") % 2 == 0, F.to_variant_object(F.array(c, F.lit("other")))).otherwise(F.col(c).cast("variant"))
        return F.split(c, ", ") if f.endswith("+") else F.col(c)

    return F.struct(*[sent(c, f).alias(f.rstrip("*+")) for c, f in adapters.REMOTE_BOARDS[name][1].items()])


@query("""SELECT source, trim(native_id) AS native_id, trim(title) AS title, coalesce(description_html, '') AS description_html, company, CASE WHEN source = 'lagoonwork' THEN nullif(trim(location), '') ELSE location END AS location,
    CASE WHEN source = 'isleroles' THEN is_remote ELSE true END AS is_remote, date_posted, CASE WHEN source = 'lagoonwork' THEN valid_through END AS valid_through, employment_type, CASE WHEN source IN ('farposts', 'reefjobs') THEN industry END AS industry,
    CASE WHEN source IN ('reefjobs', 'lagoonwork') AND salary_min <> 0 THEN salary_min END AS salary_min, CASE WHEN source IN ('reefjobs', 'lagoonwork') AND salary_max <> 0 THEN salary_max END AS salary_max, CASE WHEN source IN ('reefjobs', 'lagoonwork') THEN salary_currency END AS salary_currency
    FROM jobs WHERE source IN ('farposts', 'isleroles', 'reefjobs', 'lagoonwork') AND trim(native_id) <> '' AND trim(title) <> ''""")
def adapter_remote_boards(spark, sf_dir):
    jobs = table(spark, sf_dir, "jobs")
    boards = [adapters.REGISTRY[n][1](payloads(jobs.where(F.col("source") == n), remote_fields(n), n, adapters.REMOTE_BOARDS[n][0])) for n in adapters.REMOTE_BOARDS]
    return reduce(DataFrame.unionByName, boards).select(*COLUMNS, "valid_through", "employment_type", "industry", "salary_min", "salary_max", "salary_currency")


@query()
def adapter_board_a(spark, sf_dir):
    rows = table(spark, sf_dir, "jobs").where("source = 'leafboard'")
    body = F.struct(F.col("native_id").alias("id"), "title", F.struct(F.col("location").alias("name")).alias("location"), F.col("date_posted").alias("first_published"), F.col("description_html").alias("content"), F.col("company").alias("company_name"))
    return adapters.ats_board_a(payloads(rows, body, "leafboard")).select(*COLUMNS)


@query()
def adapter_threads(spark, sf_dir):
    rows = table(spark, sf_dir, "jobs").where("source = 'threadwork'")
    text = F.concat_ws(" ", F.concat_ws(" | ", "company", "title", "location"), F.lit("\n"), "description_html")
    thread = rows.groupBy(F.floor(F.col("row_id") / 50).alias("id")).agg(F.collect_list(F.struct(F.col("native_id").alias("id"), F.lit("someone").alias("author"), F.col("date_posted").alias("created_at"), text.alias("text"))).alias("children"))
    body = F.to_json(F.struct("id", F.lit("Who is hiring?").alias("title"), F.lit("2024-05-01").alias("created_at"), "children"))
    return adapters.monthly_threads(thread.select(F.lit("items/1").alias("url"), F.lit("threadwork").alias("source"), F.lit("GLOBAL").alias("segment"), body.alias("body"), F.lit(None).cast("timestamp").alias("fetched_at"))).select(*COLUMNS)


def pages(rows: DataFrame) -> DataFrame:
    """`rows` with the page `html` of each posting: a graph with references or, by turns, one nested object after a block that can't be read."""
    org = lambda *more: F.struct(*more, F.lit("Organization").alias("@type"), F.col("company").alias("name"))
    pay = F.struct(F.col("salary_currency").alias("currency"), F.struct(F.col("salary_min").alias("minValue"), F.col("salary_max").alias("maxValue")).alias("value"))
    job = lambda company, kind: F.struct(
        F.lit("JobPosting").alias("@type"), "title", F.col("description_html").alias("description"), company.alias("hiringOrganization"), F.when(F.col("location").isNotNull(), F.struct(F.col("location").alias("address"))).alias("jobLocation"),
        F.when(F.col("country").isNotNull(), F.struct(F.col("country").alias("name"))).alias("applicantLocationRequirements"), F.when(F.col("is_remote"), "TELECOMMUTE").alias("jobLocationType"), F.col("date_posted").alias("datePosted"), F.col("valid_through").alias("validThrough"),
        kind.alias("employmentType"), pay.alias("baseSalary"), "industry",
    )
    graph = F.to_json(F.struct(F.struct(org(F.lit("#org").alias("@id")).alias("org"), job(F.struct(F.lit("#org").alias("@id")), F.col("employment_type")).alias("job")).alias("@graph")))
    nested = F.to_json(job(org(), F.array("employment_type", F.lit("OTHER"))))
    block = lambda c: F.concat(F.lit('<script type="application/ld+json">'), c, F.lit("</script>"))
    body = F.when(F.col("row_id") % 2 == 0, block(F.replace(graph, F.lit("</"), F.lit("<\\/")))).otherwise(F.concat(block(F.lit('{"broken": ')), block(F.replace(nested, F.lit("</"), F.lit("<\\/")))))
    return rows.withColumn("html", F.concat(F.lit("<html>"), body, F.lit("</html>")))


STRIPPED = r"nullif(regexp_replace({0}, '^[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+|[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+$', '', 'g'), '') AS {1}"
PAGE_FIELDS = {"title": "title", "description_html": "description", "company": "company", "location": "location", "country": "applicant_location", "date_posted": "date_posted", "valid_through": "valid_through", "employment_type": "employment_type", "salary_currency": "salary_currency", "industry": "industry"}


@query(f"SELECT row_id, true AS found, {', '.join(STRIPPED.format(c, f) for c, f in PAGE_FIELDS.items())}, CASE WHEN is_remote THEN true WHEN location IS NOT NULL THEN false END AS is_remote, nullif(salary_min, 0) AS salary_min, nullif(salary_max, 0) AS salary_max FROM jobs")
def jsonld_pages(spark, sf_dir):
    return jsonld.parse_pages(pages(table(spark, sf_dir, "jobs")).select("row_id", "html")).select("row_id", "found", *PAGE_FIELDS.values(), "is_remote", "salary_min", "salary_max")


@query()
def html_boards(spark, sf_dir):
    """The detail pages of all boards that `html_board` reads."""
    boards = [n for n in adapters.names() if adapters.REGISTRY[n][1] is adapters.html_board]
    shown = pages(table(spark, sf_dir, "jobs").where(F.col("source").isin(boards)).withColumn("fetched_at", F.lit(None).cast("timestamp")))
    return adapters.html_board(shown.withColumnRenamed("html", "body")).select("url", *COLUMNS, "valid_through", "employment_type", "industry", "salary_min", "salary_max", "salary_currency")


@query("SELECT source, segment, count(*) AS n FROM jobs GROUP BY source, segment")
def stream_counts(spark, sf_dir):
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    return ingest.stream_counts(ingest.landed(spark, f"{sf_dir}/jobs.parquet", 1), ["source", "segment"], f"{folder}/counts", f"{folder}/state")


def landing(spark, sf_dir, columns: list[str], files: int = 4) -> tuple[DataFrame, str]:
    """The postings as a stream of several files, a micro-batch each, and a folder for what the stream keeps."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    table(spark, sf_dir, "jobs").select(*columns).repartition(files, "row_id").write.parquet(f"{folder}/landing")
    return ingest.landed(spark, f"{folder}/landing", 1), folder


@query("SELECT job_id, row_id, title FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY row_id DESC) AS rn FROM jobs) WHERE rn = 1")
def stream_upsert(spark, sf_dir):
    rows, folder = landing(spark, sf_dir, ["job_id", "row_id", "title"])
    return ingest.stream_upsert(rows, f"{folder}/store", ["job_id"], ["row_id"], f"{folder}/state")


@query("SELECT month, segment, skill, count(*) AS n FROM jobs JOIN job_skills USING (job_id) GROUP BY month, segment, skill")
def stream_monthly(spark, sf_dir):
    rows, folder = landing(spark, sf_dir, ["job_id", "row_id", "month", "segment"])
    tagged = rows.join(tags(spark, sf_dir).select("job_id", "skill"), "job_id")
    return ingest.stream_counts(tagged, ["month", "segment", "skill"], f"{folder}/counts", f"{folder}/state")


@query("SELECT slug, ats, segment, open_jobs FROM companies WHERE open_jobs >= 5 AND slug NOT IN (SELECT board_slug FROM documents WHERE board_slug IS NOT NULL)")
def new_boards(spark, sf_dir):
    known = table(spark, sf_dir, "documents").where("board_slug is not null").select(F.col("board_slug").alias("slug")).distinct()
    return adapters.confirmed_boards(table(spark, sf_dir, "companies"), known, 5)


@query("SELECT d.doc_id, c.segment FROM documents d LEFT JOIN companies c ON lower(d.board_slug) = lower(c.slug)")
def board_segment(spark, sf_dir):
    return adapters.segment_of(table(spark, sf_dir, "documents").select("doc_id", F.col("board_slug").alias("slug")), table(spark, sf_dir, "companies")).select("doc_id", "segment")


# ---------------------------------------------------------------- audits and dates


@query(f"WITH {LAST} SELECT segment, year, count(*) AS n, count(*) >= 30 AS usable FROM last WHERE year IS NOT NULL AND (source = 'threadwork' OR starts_with(source, 'threadwork_') OR source = 'wayback' OR starts_with(source, 'wayback_')) GROUP BY 1, 2")
def trend_usability(spark, sf_dir):
    return audit.trend_usability(postings(spark, sf_dir), HISTORY_SOURCES, SETTINGS.min_cell)


@query("SELECT job_id, skill, track FROM job_skills WHERE regexp_matches(track, '(?i)data')")
def track_filter(spark, sf_dir):
    return audit.in_track(tags(spark, sf_dir), "data").select("job_id", "skill", "track")


@query()
def audit_sample(spark, sf_dir):
    return audit.audit_sample(table(spark, sf_dir, "jobs"), "KE", 50, 7).select("job_id", "row_id", "title")


@query()
def parse_datetime_columns(spark, sf_dir):
    """Every value of the three time columns, whatever its shape; SQL can't read free-form text."""
    fields = ("date_posted", "valid_through", "fetched_at")
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("raw")) for f in fields])).alias("v")
    rows = table(spark, sf_dir, "jobs").select("row_id", values).select("row_id", "v.*").where("raw is not null")
    rows = rows.select("row_id", "field_name", instants.parse_datetime(F.col("raw")).alias("at"))
    return rows.select("row_id", "field_name", F.col("at").cast("timestamp_ntz").alias("at_utc"), instants.year_month(F.col("at")).alias("month"))


@query("SELECT any_value(slug) AS slug, any_value(segment) AS segment FROM companies GROUP BY lower(slug)")
def board_seeds(spark, sf_dir):
    return adapters.seeds(table(spark, sf_dir, "companies").withColumn("batch", F.lit(0)))
