"""The posting store as tables: keyed upserts, the crawl queue, the response cache, counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_last(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row a key, the last by `order`: an upsert in which the last write wins.

    A partial maximum of structs, so a hot key is folded before the shuffle. Rows with a null key are
    one key of their own, like any other.
    """
    rest = [c for c in rows.columns if c not in key]
    ranked = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order])).alias("r") if rest else F.max(ranked).alias("r"))
    return best.select(*[F.col(c) if c in key else F.col(f"r.{c}").alias(c) for c in rows.columns])


def upsert(existing: DataFrame, incoming: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """`existing` with `incoming` written over it; running it twice changes nothing."""
    return keep_last(existing.unionByName(incoming), key, order)


def insert_ignore(existing: DataFrame, incoming: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows of `incoming` that are new, the first of each key: what an insert that skips known keys adds."""
    firsts = [F.col(c) for c in incoming.columns if c != key]
    fresh = incoming.groupBy(key).agg(F.min_by(F.struct(*firsts), F.struct(*[F.col(c) for c in order])).alias("r"))
    return fresh.select(*[F.col(c) if c == key else F.col(f"r.{c}").alias(c) for c in incoming.columns]).join(existing.select(key), key, "left_anti")


def replace_keys(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """All rows of the keys in `incoming` are replaced, also by fewer rows."""
    return existing.join(incoming.select(key).distinct(), key, "left_anti").unionByName(incoming)


def clear(spark, path: str) -> int:
    """Empties a Parquet table and tells how many rows it had; its columns stay."""
    rows = spark.read.parquet(path)
    n, schema = rows.count(), rows.schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return n


def in_order(docs: DataFrame, source: str | None = None, segment: str | None = None) -> DataFrame:
    """The documents of a source and segment, where given, by job_id: what a job that goes through all of them reads."""
    for column, asked in (("source", source), ("segment", segment)):
        docs = docs.where(F.col(column) == asked) if asked else docs
    return docs.orderBy("job_id")


def latest_state(events: DataFrame, key: str = "url") -> DataFrame:
    """(url, source, state, attempts, note): the queue after all marks; each mark that isn't `pending` was an attempt.

    Of equal times the more advanced state wins.
    """
    at = F.coalesce("updated_at", "queued_at")
    rank = F.when(F.col("state") == "pending", 0).when(F.col("state") == "failed", 1).otherwise(2)
    last = F.max_by(F.struct("source", "state", "note"), F.struct(at, rank, F.coalesce("note", F.lit("")))).alias("r")
    return events.groupBy(key).agg(last, F.sum("attempts").alias("attempts")).select(key, "r.source", "r.state", "attempts", "r.note")


def requeue_failed(queue: DataFrame, max_attempts: int = 6, source: str | None = None) -> DataFrame:
    """Failed rows with fewer than `max_attempts` attempts are pending again."""
    again = (F.col("state") == "failed") & (F.col("attempts") < max_attempts)
    if source:
        again = again & (F.col("source") == source)
    return queue.withColumn("state", F.when(again, "pending").otherwise(F.col("state")))


def next_pending(queue: DataFrame, limit: int) -> DataFrame:
    """The oldest pending rows, in a fixed order."""
    return queue.where("state = 'pending'").orderBy("queued_at", "url").limit(limit)


def history_mask(source: Column, names: tuple[str, ...]) -> Column:
    """Whether a source keeps original dates: named, or replayed where `wayback` is named; a null source doesn't."""
    named = source.isin(list(names)) if names else F.lit(False)
    return F.coalesce(named | (source.startswith("wayback_") if "wayback" in names else F.lit(False)), F.lit(False))


def history_predicate(source: Column, names: tuple[str, ...]) -> Column:
    """The store's wider reading: each name itself or with anything behind an underscore."""
    return F.coalesce(reduce(lambda c, n: c | (source == n) | source.startswith(n + "_"), names, F.lit(False)), F.lit(False))


def cache_lookup(cache: DataFrame, now: Column, ttl_seconds: float) -> DataFrame:
    """The newest entry of each url that isn't older than the time to live."""
    return keep_last(cache_purge(cache, now, ttl_seconds), ["url"], ["fetched_at"])


def cache_purge(cache: DataFrame, now: Column, ttl_seconds: float) -> DataFrame:
    """The entries that are still alive; what falls away is the difference of the counts."""
    return cache.where(F.col("fetched_at") >= now - F.make_dt_interval(secs=F.lit(float(ttl_seconds))))


def cache_stats(cache: DataFrame) -> DataFrame:
    """(entries, bytes), zeros for an empty cache."""
    return cache.agg(F.count("*").alias("entries"), F.coalesce(F.sum(F.length("body")), F.lit(0)).alias("bytes"))


def counts(rows: DataFrame, *by: str, name: str = "n") -> DataFrame:
    """Rows by the given columns, most first, ties by the columns."""
    return rows.groupBy(*by).agg(F.count("*").alias(name)).orderBy(F.desc(name), *by)
