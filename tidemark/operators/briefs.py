"""Per-track coverage, top skills by action, and their rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.settings import DiffusionSettings

D = DiffusionSettings()
# What to do about a skill of each status.
ACTIONS = {"teach_ahead": "add", "arriving": "expand", "established_both": "hold", "kenya_specific": "hold", "global_only": "watch", "declining_both": "retire", "low_demand": "minor", "insufficient_data": "unknown"}


def track_coverage(tags: DataFrame, docs: DataFrame, s: DiffusionSettings = D) -> DataFrame:
    """(track, lead_coverage, follow_coverage): documents with a skill of the track among the segment's tagged ones, 0 for none."""
    one = tags.join(docs.select("job_id", "segment"), "job_id").where(F.col("segment").isin(s.lead, s.follow)).groupBy("segment", "track", "job_id").agg(F.lit(1).alias("x"))
    tagged = one.select("segment", "job_id").distinct().groupBy("segment").agg(F.count("*").alias("n"))
    share = one.groupBy("segment", "track").agg(F.count("*").alias("m")).join(tagged, "segment").withColumn("c", F.col("m") / F.col("n"))
    at = lambda segment: F.coalesce(F.max(F.when(F.col("segment") == segment, F.col("c"))), F.lit(0.0))
    return share.groupBy("track").agg(at(s.lead).alias("lead_coverage"), at(s.follow).alias("follow_coverage")).orderBy(F.desc("follow_coverage"), "track")


def top_by_action(diffusion: DataFrame, n: int = 6) -> DataFrame:
    """(track, action, place, skill, calibrated_gap): the n widest gaps of each track and action."""
    placed = diffusion.withColumn("action", action_of(F.col("status"))).withColumn("place", F.row_number().over(W.partitionBy("track", "action").orderBy(F.desc_nulls_last("calibrated_gap"), "skill")))
    return placed.where(F.col("place") <= n).select("track", "action", "place", "skill", "calibrated_gap").orderBy("track", "action", "place")


def action_of(status):
    """The action for a status column; `unknown` for a status that has none."""
    named = F.create_map(*[F.lit(x) for a in ACTIONS.items() for x in a])
    return F.coalesce(F.try_element_at(named, status), F.lit("unknown"))


def build_briefs(diffusion: DataFrame, coverage: DataFrame) -> DataFrame:
    """(track, lead_coverage, follow_coverage, n_skills, actions): one brief a track, the largest following market first.

    `actions` maps an action to its skills with their shares, calibrated gap, trends, status and
    confidence, the widest gap first. A track without coverage has zeros.
    """
    skill = F.struct("skill", "lead_share_now", "follow_share_now", "calibrated_gap", "lead_trend_12m", "follow_trend_12m", "status", "confidence")
    ranked = F.struct((-F.col("calibrated_gap")).alias("o"), F.col("skill").alias("s"), skill.alias("x"))
    lists = diffusion.withColumn("action", action_of(F.col("status"))).groupBy("track", "action").agg(F.transform(F.array_sort(F.collect_list(ranked)), lambda r: r.x).alias("skills"))  # as many as the taxonomy has terms
    briefs = lists.groupBy("track").agg(F.sum(F.size("skills")).alias("n_skills"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("action", "skills")))).alias("actions"))
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    return briefs.join(coverage, "track", "left").select("track", zero("lead_coverage"), zero("follow_coverage"), "n_skills", "actions").orderBy(F.desc("follow_coverage"), "track")


def role_view(diffusion: DataFrame) -> DataFrame:
    """(track, place, skill, lead_share_now): each track's skills, most asked for first."""
    return diffusion.withColumn("place", F.row_number().over(W.partitionBy("track").orderBy(F.desc("lead_share_now"), "skill"))).select("track", "place", "skill", "lead_share_now")


def to_markdown(briefs: DataFrame, n: int = 6) -> str:
    """The briefs as Markdown, the first `n` skills of each action; one row a track comes to the driver."""
    trend = lambda t: "" if t is None else f", trend {t:+.1%}"
    lines = ["# Track briefs", ""]
    for r in briefs.collect():
        lines += [f"## {r.track}", "", f"Coverage: lead {r.lead_coverage:.1%}, follow {r.follow_coverage:.1%}; {r.n_skills} skills", ""]
        for action in dict.fromkeys(ACTIONS.values()):
            if skills := r.actions.get(action):
                lines.append(f"- {action}: " + "; ".join(f"{x.skill} ({x.lead_share_now:.1%} / {x.follow_share_now:.1%}, gap {x.calibrated_gap:+.1%}{trend(x.lead_trend_12m)}, {x.confidence})" for x in skills[:n]))
        lines.append("")
    return "\n".join(lines)
