"""An index of fingerprints that grows by batches: new ones are matched without moving the old.

The keys of the known fingerprints, each a choice of bands with its value, are kept in a
table that is bucketed by key. A batch is dealt to the same buckets and joined with the
table where its files lie; then its own keys are appended to them. Many small batches
leave many small files, which ``compact`` writes anew.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions.fingerprint import hamming
from roadlens.operators.similarity import band_keys, first_choice
from roadlens.session import discard, materialize

#: Columns of the index: the bucketing key, what the key stands for, and the item.
COLUMNS = "key long, bands int, value long, fp long, id long"


@dataclass
class NearIndex:
    """A bucketed table of keys: its name in the catalog, its folder, the threshold that it answers, bands of a key, buckets."""

    spark: SparkSession
    table: str
    path: str
    threshold: int = 6
    together: int = 2
    buckets: int = 64

    def create(self) -> NearIndex:
        """The index over what its folder holds, which may be nothing yet."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        columns = COLUMNS.replace(",", ",\n")
        self.spark.sql(f"CREATE TABLE {self.table} ({columns}) USING parquet CLUSTERED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        return self

    def keys(self, items: DataFrame) -> DataFrame:
        """The index's rows of items (id, fp): one for each choice of bands. Items without a fingerprint have none."""
        each = band_keys(items.where("fp IS NOT NULL").select("id", "fp"), self.threshold, self.together)
        return each.select(F.xxhash64("bands", "value").alias("key"), F.col("bands").cast("int").alias("bands"), "value", "fp", "id", "below")

    def match(self, batch: DataFrame) -> DataFrame:
        """(id_a, id_b, distance): the batch's items a against known items b within the threshold, a pair in its first common choice of bands only.

        The known side is read bucket by bucket where it lies: only the batch is shuffled.
        An item that is known already matches itself and its copies at distance 0, unless
        their ids are equal.
        """
        # Equality of what the key stands for is written so that it isn't taken for a join key: the buckets are of the key alone.
        known = self.spark.table(self.table).select("key", F.col("bands").alias("kb"), F.col("value").alias("kv"), F.col("fp").alias("fb"), F.col("id").alias("id_b"))
        pairs = self.keys(batch).join(known.hint("merge"), "key").where((F.col("bands").bitwiseXOR(F.col("kb")) == 0) & (F.col("value").bitwiseXOR(F.col("kv")) == 0) & (F.col("id") != F.col("id_b")))
        near = pairs.where((hamming(F.col("fp"), F.col("fb")) <= self.threshold) & first_choice(F.col("fp"), F.col("fb"), F.col("below"), self.threshold, self.together))
        return near.select(F.col("id").alias("id_a"), "id_b", hamming(F.col("fp"), F.col("fb")).alias("distance"))

    def append(self, batch: DataFrame) -> None:
        """Adds the items of a batch; a bucket gets one file more, if the batch has keys for it."""
        rows = self.keys(batch).drop("below")
        rows.repartition(self.buckets, "key").write.mode("append").insertInto(self.table)

    def ingest(self, batch: DataFrame) -> DataFrame:
        """(id_a, id_b, distance) with id_a < id_b: the batch's pairs among themselves and with what was known; the batch is known from then on."""
        from roadlens.operators.similarity import near_pairs

        old = self.match(batch).select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "distance").distinct()
        found = materialize(old.unionByName(near_pairs(batch.select("id", "fp"), self.threshold)))
        self.append(batch)
        return found

    def files(self) -> int:
        return self.spark.table(self.table).select(F.input_file_name().alias("f")).distinct().count()

    def compact(self, path: str) -> NearIndex:
        """The same index in another folder, one sorted file a bucket at most; the old folder is left to its owner."""
        held = materialize(self.spark.table(self.table))
        out = NearIndex(self.spark, self.table, path, self.threshold, self.together, self.buckets).create()
        held.repartition(self.buckets, "key").sortWithinPartitions("key").write.mode("append").insertInto(out.table)
        discard(held)
        return out
