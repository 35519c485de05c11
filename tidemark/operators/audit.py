"""What a person looks at to judge a run: samples, filters, which years carry a trend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.store import history_predicate


def audit_sample(docs: DataFrame, segment: str, n: int, seed: int = 0, min_length: int = 400) -> DataFrame:
    """`n` documents of a segment with more than `min_length` characters of text, the same for the same seed; a sampling operator."""
    long = docs.where((F.col("segment") == segment) & (F.length("description_html") > min_length))
    return long.orderBy(F.xxhash64("job_id", F.lit(seed)), "job_id").limit(n)


def in_track(frame: DataFrame, pattern: str) -> DataFrame:
    """Rows whose track holds the pattern, whatever its case; a null track doesn't."""
    return frame.where(F.coalesce(F.col("track").rlike(f"(?iuU){pattern}"), F.lit(False)))


def trend_usability(docs: DataFrame, history: tuple[str, ...], min_cell: int) -> DataFrame:
    """(segment, year, n, usable) over the sources that keep original dates: which cells are thick enough for a trend."""
    dated = docs.where(F.col("year").isNotNull() & history_predicate(F.col("source"), history))
    return dated.groupBy("segment", "year").agg(F.count("*").alias("n")).withColumn("usable", F.col("n") >= min_cell)
