"""Writers: exports, audit rows, the partitioned posting table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export(frames: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Each non-empty frame as CSV (one file, for people) and Parquet; name -> CSV folder. Frames are reports of some hundred rows."""
    out = {}
    for name, df in frames.items():
        if df.isEmpty():
            continue
        out[name] = f"{folder}/{name}.csv"
        df.coalesce(1).write.mode("overwrite").csv(out[name], header=True)
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return out


def append(rows: DataFrame, path: str) -> None:
    """Audit rows (failures, runs) behind those already there."""
    rows.write.mode("append").parquet(path)


def write_postings(rows: DataFrame, path: str) -> None:
    """The posting table by segment and year; files of a partition are spread by job_id, so a hot one has several."""
    salted = rows.repartition("segment", "year", F.pmod(F.hash("job_id"), F.lit(16)))
    salted.write.mode("overwrite").partitionBy("segment", "year").parquet(path)


def audit_sheet(found: DataFrame, path: str) -> None:
    """One row a match with its evidence and an empty column for a verdict."""
    found.withColumn("evidence", F.array_join("evidence", " / ")).withColumn("verdict", F.lit("")).write.mode("overwrite").csv(path, header=True)
