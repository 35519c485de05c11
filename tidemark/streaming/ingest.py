"""Structured Streaming over landed files: idempotent upserts and incremental counts, drained by `availableNow`."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.operators.store import upsert
from tidemark.runtime import SharedFiles


def landed(spark: SparkSession, path: str, files_per_batch: int = 64) -> DataFrame:
    """A stream over the Parquet files at `path`, a folder or one file."""
    batch = spark.read.parquet(path)
    files = batch.inputFiles()
    reader = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", files_per_batch)
    if len(files) == 1 and files[0].rstrip("/").endswith(path.rstrip("/").rsplit("/", 1)[-1]):
        return reader.option("pathGlobFilter", path.rsplit("/", 1)[-1]).parquet(path.rsplit("/", 1)[0])
    return reader.parquet(path)


def drain(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run `each` over everything that is there, once; a restart goes on where the checkpoint says."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def stream_upsert(stream: DataFrame, store: str, key: list[str], order: list[str], checkpoint: str, buckets: int = 16) -> DataFrame:
    """The store after the stream: the last write of each key wins.

    The store lies in buckets by the hash of the key. A micro-batch rewrites the buckets it touches,
    under its own number, and then a small manifest that names each bucket's version; all other buckets
    stay where they are. A batch that is run again starts from the manifest before its own, so it
    writes the same again; a restart with nothing new reads the last one. Versions that neither of the last two manifests names
    are removed. Late rows lose against newer ones by `order`, none is dropped by a watermark. A store without any batch is empty.
    """
    spark, files = stream.sparkSession, SharedFiles(stream.sparkSession, store)
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")

    def manifests() -> list[int]:
        return [int(n.removesuffix(".json")) for n in files.names("manifest") if n.endswith(".json")]

    def read(number: int) -> dict[str, int]:
        return json.loads(files.read(f"manifest/{number:010d}.json"))

    def rows_of(held: dict[str, int]) -> DataFrame:
        paths = [f"{store}/v={v}/bucket={b}" for b, v in sorted(held.items())]
        return spark.read.schema(stream.schema).parquet(*paths) if paths else spark.createDataFrame([], stream.schema)

    def each(batch: DataFrame, number: int) -> None:
        before = [n for n in manifests() if n < number]
        held = read(before[-1]) if before else {}
        rows = batch.withColumn("bucket", bucket)
        touched = [str(r.bucket) for r in rows.select("bucket").distinct().collect()]  # bucket numbers
        merged = upsert(rows_of({b: held[b] for b in touched if b in held}), batch, key, order).withColumn("bucket", bucket)
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{store}/v={number}")
        files.write(f"manifest/{number:010d}.json", json.dumps({**held, **dict.fromkeys(touched, number)}))
        for old in manifests()[:-2]:
            files.remove(f"manifest/{old:010d}.json")
        kept = {(str(v), b) for n in manifests() for b, v in read(n).items()}
        for name in files.names():
            if name.startswith("v="):
                here = [b for b in files.names(name) if b.startswith("bucket=")]
                for b in here:
                    if (name.removeprefix("v="), b.removeprefix("bucket=")) not in kept:
                        files.remove(f"{name}/{b}")

    drain(stream, each, checkpoint)
    done = manifests()
    return rows_of(read(done[-1]) if done else {})


def stream_counts(stream: DataFrame, by: list[str], folder: str, checkpoint: str) -> DataFrame:
    """Rows by the given columns: each micro-batch adds its partial counts under its number, the sum is read at the end.

    Its counts are all that a batch leaves, so the sum costs as many rows as groups and batches. A
    restart with nothing new gives the same again, a stream without rows an empty result.
    """
    spark = stream.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        batch.groupBy(*by).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    drain(stream, each, checkpoint)
    partial = spark.read.schema(StructType([*[stream.schema[c] for c in by], StructField("n", LongType())]))
    there = [n for n in SharedFiles(spark, folder).names() if n.startswith("batch=")]
    rows = partial.parquet(*[f"{folder}/{n}" for n in there]) if there else spark.createDataFrame([], StructType([*[stream.schema[c] for c in by], StructField("n", LongType())]))
    return rows.groupBy(*by).agg(F.sum("n").alias("n"))


def dead_letters(stream: DataFrame, parse: Callable[[DataFrame], DataFrame], good: str, bad: str, key: str, checkpoint: str) -> None:
    """Payloads through `parse`; those that give no row go to `bad`, the drain never stops for one."""

    def each(batch: DataFrame, number: int) -> None:
        rows = parse(batch)
        rows.write.mode("overwrite").parquet(f"{good}/batch={number}")
        done = batch.sparkSession.read.parquet(f"{good}/batch={number}")
        batch.join(done.select(key).distinct(), key, "left_anti").write.mode("overwrite").parquet(f"{bad}/batch={number}")

    drain(stream, each, checkpoint)
