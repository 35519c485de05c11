"""How a following segment differs from a leading one: gaps, trends, classes, backtest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.settings import DiffusionSettings

D = DiffusionSettings()


def segment_pivot(current: DataFrame, s: DiffusionSettings = D) -> DataFrame:
    """(skill, track, category, lead_share_now, follow_share_now): 0 where a segment was searched and has none."""
    at = lambda segment: F.coalesce(F.max(F.when(F.col("segment") == segment, F.col("pct_share"))), F.lit(0.0))
    return current.groupBy("skill", "track", "category").agg(at(s.lead).alias("lead_share_now"), at(s.follow).alias("follow_share_now"))


def calibration(pivot: DataFrame, s: DiffusionSettings = D) -> DataFrame:
    """One row: the exact median gap of the baseline skills, 0 with fewer than `min_baselines` of them."""
    base = F.col("skill").isin(list(s.baselines))
    gap = F.when(base, F.col("lead_share_now") - F.col("follow_share_now"))
    return pivot.agg(F.when(F.count(gap) >= s.min_baselines, F.median(gap)).otherwise(0.0).alias("offset"), (F.count(gap) >= s.min_baselines).alias("offset_applied"))


def lead_trend(monthly: DataFrame, s: DiffusionSettings = D) -> DataFrame:
    """(skill, lead_trend, months_observed): mean of the last months less that of the ones before.

    The windows are the segment's own last months; a month without the skill counts as 0. With no
    months before the last window nothing can be compared and the result is empty.
    """
    lead = monthly.where((F.col("segment") == s.lead) & F.col("month").isNotNull())
    months = lead.select("month").distinct().withColumn("r", F.row_number().over(W.orderBy(F.desc("month"))))  # as many rows as months
    sizes = months.agg(F.count_if(F.col("r") <= s.window).alias("recent"), F.count_if(F.col("r").between(s.window + 1, 2 * s.window)).alias("prior"))
    by = lead.join(months, "month").groupBy("skill").agg(
        F.sum(F.when(F.col("r") <= s.window, F.col("pct_share")).otherwise(0.0)).alias("a"),
        F.sum(F.when(F.col("r").between(s.window + 1, 2 * s.window), F.col("pct_share")).otherwise(0.0)).alias("b"),
        F.countDistinct("month").alias("months_observed"),
    )
    return by.crossJoin(F.broadcast(sizes)).where("prior > 0").select("skill", (F.col("a") / F.col("recent") - F.col("b") / F.col("prior")).alias("lead_trend"), "months_observed")


def year_over_year(yearly: DataFrame, segment: str, year_from: int, year_to: int) -> DataFrame:
    """(skill, share_from, share_to, change) over usable cells; empty unless both years are there."""
    rows = yearly.where((F.col("segment") == segment) & F.col("usable"))
    at = lambda y: F.coalesce(F.max(F.when(F.col("year") == y, F.col("pct_share"))), F.lit(0.0))
    both = rows.where(F.col("year").isin(year_from, year_to)).agg(F.countDistinct("year").alias("years"))
    by = rows.groupBy("skill").agg(at(year_from).alias("share_from"), at(year_to).alias("share_to"))
    return by.crossJoin(F.broadcast(both)).where("years = 2").select("skill", "share_from", "share_to", (F.col("share_to") - F.col("share_from")).alias("change"))


def classify(g: Column, k: Column, c: Column, t: Column, usable: Column, history: Column, s: DiffusionSettings = D) -> tuple[Column, Column]:
    """(status, confidence) by the first rule that holds; bounds belong to the rule that names them."""
    high, low = g >= s.lead_share_min, k <= s.follow_share_max
    up, down = F.coalesce(t >= s.trend_min, F.lit(False)), F.coalesce(t <= -s.trend_min, F.lit(False))
    rules = [
        (g.isNull() | k.isNull() | ~usable, "insufficient_data", F.lit("none")), (c < s.gap_floor, "kenya_specific", F.lit("medium")),
        (high & low & up, "teach_ahead", F.when(history, "medium").otherwise("provisional")), (high & low & down, "declining_both", F.lit("low")),
        (high & low, "global_only", F.when(history, "low").otherwise("provisional")), (high & up, "arriving", F.lit("medium")), (high, "established_both", F.lit("medium")),
        (k > s.follow_share_max, "established_both", F.lit("low")),
    ]
    status, confidence = F.when(rules[0][0], rules[0][1]), F.when(rules[0][0], rules[0][2])
    for test, name, level in rules[1:]:
        status, confidence = status.when(test, name), confidence.when(test, level)
    return status.otherwise("low_demand"), confidence.otherwise("medium")


def build_diffusion(current: DataFrame, monthly: DataFrame, yearly: DataFrame, docs: DataFrame, s: DiffusionSettings = D) -> DataFrame:
    """One row a skill: shares, gap, calibrated gap and its rank, trends, status, confidence.

    All scalars (offset, usability, months of history) are one-row joins, so the frame stays one lazy
    plan. The follow trend is null with fewer than `min_history_months` months of follow documents.
    """
    pivot = segment_pivot(current, s)
    use = lambda segment: F.coalesce(F.bool_or(F.when(F.col("segment") == segment, F.col("usable"))), F.lit(True))
    usable = current.agg((use(s.lead) & use(s.follow)).alias("cell_usable"))
    months = docs.where(F.col("segment") == s.follow).agg(F.countDistinct("month").alias("months_follow"))
    joined = (
        pivot.crossJoin(F.broadcast(calibration(pivot, s))).crossJoin(F.broadcast(usable)).crossJoin(F.broadcast(months))
        .join(lead_trend(monthly, s), "skill", "left")
        .join(year_over_year(yearly, s.follow, s.year_from, s.year_to).select("skill", F.col("change").alias("follow_change")), "skill", "left")
    )
    history = F.col("months_follow") >= s.min_history_months
    gap = F.col("lead_share_now") - F.col("follow_share_now")
    frame = joined.withColumn("diffusion_gap", gap).withColumn("calibrated_gap", gap - F.col("offset"))
    status, confidence = classify(F.col("lead_share_now"), F.col("follow_share_now"), F.col("calibrated_gap"), F.col("lead_trend"), F.col("cell_usable"), history, s)
    ranked = F.when(F.col("calibrated_gap").isNotNull(), F.rank().over(W.orderBy(F.desc_nulls_last("calibrated_gap"))).cast("double"))  # as many rows as skills
    return frame.select(
        "skill", "track", "category", "lead_share_now", "follow_share_now", "diffusion_gap", "calibrated_gap", ranked.alias("gap_rank"), F.col("lead_trend").alias("lead_trend_12m"),
        F.when(history, F.col("follow_change")).alias("follow_trend_12m"), F.lit(None).cast("double").alias("estimated_lag_months"), status.alias("status"), confidence.alias("confidence"),
        F.col("skill").isin(list(s.baselines)).alias("is_calibration_baseline"), F.coalesce("months_observed", F.lit(0)).cast("bigint").alias("months_observed"), "cell_usable",
    ).orderBy(F.desc_nulls_last("calibrated_gap"), "skill")


def watchlist(diffusion: DataFrame, limit: int = 25) -> DataFrame:
    """Skills to teach ahead, the widest gaps first; a report of `limit` rows."""
    return diffusion.where("status = 'teach_ahead'").orderBy(F.desc("calibrated_gap"), F.desc_nulls_last("lead_trend_12m"), "skill").limit(limit)


def own_demand(diffusion: DataFrame, limit: int = 10) -> DataFrame:
    """What the following segment asks for by itself, the widest gaps first; a report of `limit` rows."""
    return diffusion.where("status = 'kenya_specific'").orderBy("calibrated_gap", "skill").limit(limit)


def track_summary(diffusion: DataFrame) -> DataFrame:
    n = lambda status: F.count_if(F.col("status") == status).alias(status)
    return diffusion.groupBy("track").agg(
        F.count("*").alias("skills"), n("teach_ahead"), n("established_both"), n("kenya_specific"), n("global_only"), n("low_demand"), F.avg("lead_share_now").alias("mean_lead_share"), F.avg("follow_share_now").alias("mean_follow_share")
    ).orderBy(F.desc("teach_ahead"), "track")


def diagnostics(diffusion: DataFrame) -> DataFrame:
    """(status, skills, positive_gap_share): counts by status, and over all skills the share with a positive raw gap."""
    every = diffusion.agg(F.round(F.avg((F.col("diffusion_gap") > 0).cast("int")), 3).alias("positive_gap_share"))
    return diffusion.groupBy("status").agg(F.count("*").alias("skills")).crossJoin(F.broadcast(every)).orderBy("status")


def movers(diffusion: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The skills that rise and fall most, in percentage points, of those with both trends; a report of 2n rows."""
    both = diffusion.where("lead_trend_12m is not null and follow_trend_12m is not null").select("skill", F.col(column).alias("t"))
    up, down = both.orderBy(F.desc("t"), "skill").limit(n).withColumn("direction", F.lit("rise")), both.orderBy("t", "skill").limit(n).withColumn("direction", F.lit("fall"))
    return up.unionByName(down).select("direction", "skill", F.round(F.col("t") * 100, 2).alias("points"))


def backtest(yearly: DataFrame, s: DiffusionSettings = D, min_share: float = 0.01, min_rise: float = 0.005, min_rows: int = 10) -> DataFrame:
    """One row: of the skills that rose in the lead segment, how many rose in the follow segment, against all.

    Skills count with at least `min_share` in either segment at the end; with fewer than `min_rows` of
    them `error` says so and the figures are null. `corr` is Pearson's.
    """
    a = year_over_year(yearly, s.lead, s.year_from, s.year_to).select("skill", F.col("share_to").alias("lead_to"), F.col("change").alias("lead_change"))
    b = year_over_year(yearly, s.follow, s.year_from, s.year_to).select("skill", F.col("share_to").alias("follow_to"), F.col("change").alias("follow_change"))
    rows = a.join(b, "skill").where((F.col("lead_to") >= min_share) | (F.col("follow_to") >= min_share))
    riser, hit = F.col("lead_change") >= min_rise, F.col("follow_change") > 0
    x, y = F.col("lead_change"), F.col("follow_change")
    got = rows.agg(
        F.count("*").alias("n_comparable"), F.count_if(riser).alias("n_risers"), F.count_if(riser & hit).alias("n_hits"), F.count_if(hit).alias("n_up"), F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias("corr"),
        F.array_sort(F.collect_list(F.when(riser & hit, F.col("skill")))).alias("hits"), F.array_sort(F.collect_list(F.when(riser & ~hit, F.col("skill")))).alias("misses"),
    )
    rate = lambda p, q: F.round(F.when(F.col("n_comparable") >= min_rows, F.try_divide(F.col(p), F.col(q))), 3)
    out = got.withColumn("hit_rate", rate("n_hits", "n_risers")).withColumn("base_rate", rate("n_up", "n_comparable"))
    raw = F.try_divide(F.col("n_hits"), F.col("n_risers")) - F.try_divide(F.col("n_up"), F.col("n_comparable"))
    few = F.col("n_comparable") < min_rows
    return out.select(
        "n_comparable", "n_risers", "n_hits", "hit_rate", "base_rate", F.round(F.when(~few, raw), 3).alias("lift"), F.round(F.when(~few, F.col("corr")), 3).alias("corr"),
        F.array_join("hits", ", ").alias("hits"), F.array_join("misses", ", ").alias("misses"), F.when(few, "too few comparable skills").alias("error"),
    )
