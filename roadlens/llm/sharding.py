"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, range partitions.

Records are ordered by a 64-bit hash of their text, so equal texts are neighbours.
A size-weighted sample of keys gives the quantile boundaries of many more ranges
than shards; ranges that turn out overfull are subdivided - by further hash bits of
the key where they hold several keys, by document where one text alone is overfull
- and whole ranges are dealt to the shards so that their bytes are near equal.
Equal texts share a shard unless their group alone exceeds ``split_share`` of a shard.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.ranking import rank_in_groups, salt_digits
from roadlens.session import materialize

#: Ranges for each shard, and sampled keys for each range: the driver holds at most their product times the shards.
RANGES_PER_SHARD = 128
SAMPLES_PER_RANGE = 16


def text_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, key): size is the UTF-8 bytes plus 1; null text has none."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(raw).cast("long").alias("text_crc32"),
        F.xxhash64(raw).alias("key"),
    )


def shard_by_size(
    docs: DataFrame,
    n_shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    split_share: float = 1.0,
) -> DataFrame:
    """Range-partitions every document into ``n_shards`` shards of near equal bytes.

    Returns doc_id, size, text_crc32, shard and slot (gapless from 0 in its shard).
    Null text counts as empty; repeated rows each get a slot; an empty table gives
    no rows; null ids are kept and ordered last among ties; other columns are ignored.
    """
    spark = docs.sparkSession
    # Rows without an id, or that share one, are told apart by their text's key: they have no common digest.
    slim = materialize(text_sizes(docs, id_col, text_col).withColumn("digest", F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("key").cast("string")))).withColumn("row", F.monotonically_increasing_id()))
    total, n_rows = slim.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not n_rows:
        return slim.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))

    n_ranges = n_shards * RANGES_PER_SHARD
    wanted = n_ranges * SAMPLES_PER_RANGE
    # Poisson sampling: a row is drawn with a chance in proportion to its size, by a hash of its id and text: the same on every run.
    # The chances add up to ``wanted`` at most, so that is what the driver gets, give or take its square root; equal rows are drawn as one.
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(wanted / total))
    draw = F.pmod(F.xxhash64("doc_id", "key", F.lit("draw")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    weight = F.col("size") / chance
    sample = slim.where(draw < chance).groupBy("key").agg(F.sum(weight).alias("w")).orderBy("key").collect()

    bounds, gone, step = [], 0.0, sum(r["w"] for r in sample) / n_ranges
    for r in sample:
        gone += r["w"]
        if gone >= step * (len(bounds) + 1):
            bounds.append(r["key"])
            while gone >= step * (len(bounds) + 1):  # a key over several quantiles: its range holds it alone
                bounds.append(r["key"])
    bounds = sorted(set(bounds))
    heavy = [r["key"] for r in sample if r["w"] >= step]
    cuts = sorted({*bounds, *(k - 1 for k in heavy if k > -(1 << 63))})

    ranged = materialize(_search(slim, cuts))
    per = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect()

    ideal = total / n_shards
    parts, cells = {}, {}
    for r in per:
        one = r["lo"] == r["hi"]
        limit = ideal * split_share if one else 2 * total / n_ranges
        parts[r["range"]] = (-(-int(r["bytes"] * (2 if one else 1)) // max(1, int(limit))) if r["bytes"] > limit else 1, one)
    table = spark.createDataFrame([(k, int(m), one) for k, (m, one) in parts.items()], "range int, parts int, one boolean")
    celled = ranged.join(F.broadcast(table), "range").withColumn(
        "part",
        F.when(F.col("parts") <= 1, F.lit(0)).otherwise(F.pmod(F.when(F.col("one"), F.xxhash64("doc_id", F.lit("part"))).otherwise(F.xxhash64("key", F.lit("part"))), F.col("parts")).cast("int")),
    ).drop("parts", "one")
    # At most n_ranges ranges and a few parts for each overfull one.
    sized = celled.groupBy("range", "part").agg(F.sum("size").alias("bytes")).collect()
    load = [(0, s) for s in range(n_shards)]
    for r in sorted(sized, key=lambda r: (-r["bytes"], r["range"], r["part"])):
        b, s = heapq.heappop(load)
        cells[r["range"], r["part"]] = s
        heapq.heappush(load, (b + r["bytes"], s))
    dealt = spark.createDataFrame([(a, b, s) for (a, b), s in cells.items()], "range int, part int, shard int")
    placed = celled.join(F.broadcast(dealt), ["range", "part"])
    ranked = rank_in_groups(placed.select("doc_id", "size", "text_crc32", "shard", "digest", "row"), ["shard"], "digest", ["doc_id", "text_crc32"], "slot", salt_digits(n_rows), "row")
    return ranked.select("doc_id", "size", "text_crc32", "shard", "slot")


def _search(df: DataFrame, cuts: list[int]) -> DataFrame:
    """Adds ``range``: how many cuts lie below the key. There are at most 2 * n_ranges cuts, a parameter."""
    edges = np.array(cuts, dtype=np.int64)

    @F.pandas_udf("int")
    def below(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, key.to_numpy(), side="left").astype(np.int32))

    return df.withColumn("range", below("key"))
