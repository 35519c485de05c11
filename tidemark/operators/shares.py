"""Shares of terms in cells of documents, on three denominators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.store import history_mask, keep_last

REPLAYED = "wayback_"


def current_postings(jobs: DataFrame) -> DataFrame:
    """The last collected row of each job_id; implausible years and their months are null."""
    last = keep_last(jobs, ["job_id"], ["row_id"])
    real = F.col("year").between(2015, 2030)
    return last.withColumn("month", F.when(real, F.col("month"))).withColumn("year", F.when(real, F.col("year")))


def drop_replays(docs: DataFrame) -> DataFrame:
    """Replayed rows go where a live row has the same board and native id; live rows all stay."""
    replayed = F.coalesce(F.col("source").startswith(REPLAYED), F.lit(False))
    live = docs.where(~replayed)
    keys = live.where("native_id is not null and source is not null").select(F.col("source").alias("board"), "native_id").distinct()
    only = docs.where(replayed).withColumn("board", F.expr(f"substring(source, {len(REPLAYED) + 1})")).join(keys, ["board", "native_id"], "left_anti")
    return live.unionByName(only.select(*docs.columns))


def slots(tags: DataFrame, docs: DataFrame, columns: list[str]) -> DataFrame:
    """Each tag row with columns of its document; tags of unknown documents fall away."""
    return tags.join(docs.select("job_id", *columns), "job_id")


def fold_tags(docs: DataFrame, tags: DataFrame, history: tuple[str, ...]) -> DataFrame:
    """Tags folded to (term, document) with what the cells of all share frames need, and `rows`, how many tag rows that was."""
    dated = history_mask(F.col("source"), history).alias("dated")
    known = slots(tags, docs.select("job_id", "segment", "year", "month", dated), ["segment", "year", "month", "dated"])
    return known.groupBy("segment", "year", "month", "dated", "skill", "track", "category", "job_id").agg(F.count("*").alias("rows"))


def build_share(docs: DataFrame, tags: DataFrame, keys: list[str], min_cell: int, folded: bool = False) -> DataFrame:
    """For each cell of `keys` and term: mentions, the cell's documents, tagged documents and slots, three shares, usable.

    Rows with a null key are in no cell. Mentions and tagged documents count a document once, slots
    every tag row; pct_of_all divides mentions by all documents, pct_of_tech (the usual share) by
    tagged ones, share_of_mentions by slots. A cell is usable with at least `min_cell` tagged
    documents; thin cells are flagged, not dropped. Tags are folded to (cell, term, document) once,
    and everything else is counted from that; `folded` tags (`fold_tags`) are so already.
    """
    known = docs.dropna(subset=keys)
    totals = known.groupBy(*keys).agg(F.count("*").alias("n_jobs_total"))
    one = tags.dropna(subset=keys) if folded else slots(tags, known, keys).groupBy(*keys, "skill", "track", "category", "job_id").agg(F.count("*").alias("rows"))
    mentions = one.dropna(subset=["skill", "track", "category"]).groupBy(*keys, "skill", "track", "category").agg(F.count("*").alias("n_mentions"))
    tagged = one.groupBy(*keys, "job_id").agg(F.sum("rows").alias("rows")).groupBy(*keys).agg(F.count("*").alias("n_tech_jobs"), F.sum("rows").alias("n_slots"))
    cells = totals.join(tagged, keys, "left")
    out = mentions.join(cells, keys, "left")
    per = lambda n: F.try_divide(F.col("n_mentions"), F.col(n))
    return out.select(
        *keys, "skill", "track", "category", "n_mentions", "n_jobs_total", "n_tech_jobs", "n_slots", per("n_jobs_total").alias("pct_of_all"), per("n_tech_jobs").alias("pct_of_tech"), per("n_slots").alias("share_of_mentions"),
        per("n_tech_jobs").alias("pct_share"), (F.coalesce("n_tech_jobs", F.lit(0)) >= min_cell).alias("usable"),
    ).orderBy(*keys, F.desc("pct_share"), "skill")


def share_frames(docs: DataFrame, tags: DataFrame, history: tuple[str, ...], min_cell: int, folded: bool = False) -> dict[str, DataFrame]:
    """current over all sources by segment; year and month over sources that keep original dates."""
    dated = docs.where(history_mask(F.col("source"), history))
    dated_tags = tags.where("dated") if folded else tags
    return {
        "current": build_share(docs, tags, ["segment"], min_cell, folded),
        "year": build_share(dated, dated_tags, ["segment", "year"], min_cell, folded),
        "month": build_share(dated, dated_tags, ["segment", "month"], min_cell, folded),
    }
