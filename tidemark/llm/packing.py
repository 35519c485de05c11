"""Texts into containers of fixed capacity: sum-of-squares packing in bounded shards."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import checkpoint, spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How many full bins one task packs, so that its memory doesn't grow with the data.
BINS_PER_SHARD = 4_000
ROUNDS = 2
#: Fixed value: how the public byte-level vocabularies cut text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(4)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("tidemark", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens) of each non-null text; an empty text has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(vocabulary)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf.doc_id, "n_tokens": [len(enc.encode_ordinary(t)) for t in pdf.text]})

    return spread(docs.where("text is not null and doc_id is not null").select("doc_id", "text")).mapInPandas(run, "doc_id bigint, n_tokens int")


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin number of each item, placed one by one where the sum over all gaps of the squared
    number of open bins with that gap becomes smallest.

    Only the bin's gap counts: an item of size s moves a bin from gap g to g - s (full bins don't
    count), or opens one. Of equal choices the smallest gap wins.
    """
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    out = np.empty(len(sizes), np.int64)
    bins = 0
    for i, s in enumerate(sizes.tolist()):
        best, gap = 2 * count[capacity - s] + 1 if s < capacity else 0, -1
        gaps = np.flatnonzero(count[s:]) + s
        if s and len(gaps):
            after = np.where(gaps == s, 0, 2 * count[gaps - s] + 1)  # gap 0 is no open bin
            delta = after - 2 * count[gaps] + 1
            k = int(np.argmin(delta))
            if delta[k] <= best:
                gap = int(gaps[k])
        if gap < 0:
            b, gap, bins = bins, capacity, bins + 1
        else:
            b = open_bins[gap].pop()
            count[gap] -= 1
        out[i] = b
        if gap - s:
            open_bins[gap - s].append(b)
            count[gap - s] += 1
    return out


def pack(docs: DataFrame, bins: DataFrame, vocabulary: str = VOCABULARY, bins_per_shard: int = BINS_PER_SHARD, rounds: int = ROUNDS) -> DataFrame:
    """(bin_kind, bin_id, doc_id, piece, token_start, token_end): where each text, or piece of one, lies.

    One packing per bin kind. A text longer than the capacity is cut into full pieces and a rest;
    all others stay whole. The sizes are dealt at random (by hash) into shards of about
    `bins_per_shard` bins, each packed on its own; in each further round the bins that aren't full
    are items themselves, dealt anew, so that what one shard leaves open another can fill. Each
    shard is one bounded task, whatever the amount of data.

    Null texts and ids are left out, texts without tokens too (they need no space). Repeated ids are
    packed once a row. Kinds with null or non-positive capacity are passed over; empty tables give
    an empty result.
    """
    kinds = bins.where("bin_kind is not null and capacity_tokens > 0").groupBy("bin_kind").agg(F.max("capacity_tokens").cast("int").alias("capacity"))
    # texts of one id and size are interchangeable: they are counted, and numbered from their count, so names don't depend on partitions
    sized = checkpoint(token_counts(docs, vocabulary).where("n_tokens > 0").groupBy("doc_id", "n_tokens").agg(F.count("*").alias("copies")))
    cap = F.col("capacity")
    start = F.explode(F.sequence(F.lit(0), F.col("n_tokens") - 1, cap))
    # one row of kinds each meets all texts: there are as many as container kinds, counted here
    rows = kinds.collect()
    if not rows:
        return docs.sparkSession.createDataFrame([], "bin_kind string, bin_id string, doc_id bigint, piece int, token_start int, token_end int")
    each = F.explode(F.array(*[F.struct(F.lit(r.bin_kind).alias("bin_kind"), F.lit(r.capacity).alias("capacity")) for r in rows]))
    pieces = sized.select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("doc_id", "n_tokens", F.concat_ws("_", "doc_id", "n_tokens", "copy").alias("row"), each.alias("k")).select("doc_id", "row", "n_tokens", "k.*").withColumn("token_start", start)
    pieces = pieces.withColumn("token_end", F.least(F.col("token_start") + cap, F.col("n_tokens"))).withColumn("size", F.col("token_end") - F.col("token_start"))
    pieces = pieces.withColumn("unit", F.concat_ws("-", "row", (F.col("token_start") / cap).cast("int")))
    full = pieces.where("size = capacity").withColumn("bin_id", F.concat(F.lit("f"), F.col("unit")))
    open_ = pieces.where("size < capacity")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("unit")
        name = f"{pdf['round'].iloc[0]}-{pdf['shard'].iloc[0]}-"
        return pd.DataFrame({"bin_kind": pdf.bin_kind, "unit": pdf.unit, "bin_id": [name + str(b) for b in sum_of_squares(pdf["size"].to_numpy(), int(pdf.capacity.iloc[0]))]})

    where = None
    units = open_.select("bin_kind", "capacity", "unit", "size")
    done = None
    for r in range(rounds):
        totals = {x.bin_kind: x.total for x in units.groupBy("bin_kind").agg(F.sum("size").alias("total")).collect()}
        count = F.create_map(*[F.lit(v) for x in rows for v in (x.bin_kind, max(1, -(-totals.get(x.bin_kind, 0) // (x.capacity * bins_per_shard))))])
        dealt = units.withColumn("round", F.lit(r)).withColumn("shard", F.pmod(F.xxhash64("unit", F.lit(r)), count[F.col("bin_kind")]).cast("int"))
        placed = checkpoint(dealt.groupBy("bin_kind", "shard").applyInPandas(run, "bin_kind string, unit string, bin_id string"))
        where = placed if where is None else where.join(placed.select("bin_kind", F.col("unit").alias("bin_id"), F.col("bin_id").alias("next")), ["bin_kind", "bin_id"], "left").select("bin_kind", "unit", F.coalesce("next", "bin_id").alias("bin_id"))
        if r + 1 < rounds:
            fill = units.join(placed, ["bin_kind", "unit"]).groupBy("bin_kind", "bin_id").agg(F.first("capacity").alias("capacity"), F.sum("size").cast("int").alias("size"))
            units = fill.where("size < capacity").select("bin_kind", "capacity", F.col("bin_id").alias("unit"), "size")
    done = open_.join(where, ["bin_kind", "unit"]).unionByName(full)
    return done.select("bin_kind", "bin_id", "doc_id", (F.col("token_start") / cap).cast("int").alias("piece"), "token_start", "token_end")


def fill_report(packed: DataFrame, bins: DataFrame) -> DataFrame:
    """(bin_kind, n_bins, n_pieces, tokens, fill): how full the containers are."""
    per = packed.groupBy("bin_kind").agg(F.countDistinct("bin_id").alias("n_bins"), F.count("*").alias("n_pieces"), F.sum(F.col("token_end") - F.col("token_start")).alias("tokens"))
    return per.join(bins, "bin_kind").select("bin_kind", "n_bins", "n_pieces", "tokens", (F.col("tokens") / (F.col("n_bins") * F.col("capacity_tokens"))).alias("fill"))
