"""Label text files and sequence manifests."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource

from roadlens.functions.text import sequence_of, stripped_lines, tokens
from roadlens.sources.folders import Files, FolderReader


class LabelReader(FolderReader):
    suffixes = (".txt",)

    def read(self, partition: Files) -> Iterator[tuple]:
        for split, path, length, f in self.opened_files(partition):
            name = path.rpartition("/")[2]
            yield path, split, name[: name.rindex(".")] or name, f.read(length).decode("utf-8", "replace")


class LabelTexts(DataSource):
    """Label files, empty ones too, which Spark's own readers pass over: an empty label is a background, none is an error."""

    @classmethod
    def name(cls) -> str:
        return "label_texts"

    def schema(self) -> str:
        return "path string, split string, stem string, body string"

    def reader(self, schema) -> LabelReader:
        reader = LabelReader(self.options["path"], flat="suffix" in self.options)
        reader.suffixes = (self.options.get("suffix", ".txt"),)
        return reader


def read_texts(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """(path, split, stem, body) of whole text files with a suffix anywhere below ``root``, empty ones too; split is empty."""
    spark.dataSource.register(LabelTexts)
    return spark.read.format("label_texts").option("suffix", suffix).load(root)


def read_labels(spark: SparkSession, root: str) -> DataFrame:
    """(path, split, stem, body) of root/<split>/*.txt, ``root`` being the labels folder; filters on split are pushed down.

    Empty files have an empty body. The folder is in a store that pyarrow opens by its URI.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LabelTexts)
    return spark.read.format("label_texts").load(root)


def boxes(labels: DataFrame) -> DataFrame:
    """Exploded lines of five tokens with class 0 forced: line_no and the tokens as text; others are dropped silently."""
    each = labels.select("*", F.posexplode(stripped_lines(F.col("body"))).alias("pos", "line")).withColumn("tok", tokens(F.col("line"))).where(F.size("tok") == 5)
    return each.select(*[c for c in labels.columns if c != "body"], (F.col("pos") + 1).alias("line_no"), F.concat(F.array(F.lit("0")), F.slice("tok", 2, 4)).alias("tokens"))


def first_class_ids(labels: DataFrame) -> DataFrame:
    """Adds class_ids: the distinct first tokens that are integers; lines may hold polygons."""
    firsts = F.transform(F.filter(stripped_lines(F.col("body")), lambda x: tokens(x)[0].rlike(r"^[+-]?\d+$")), lambda x: tokens(x)[0].cast("int"))
    return labels.withColumn("class_ids", F.array_sort(F.array_distinct(firsts)))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(filename, sequence_id, place): place is where a row stands, by file, block and line, whatever the tasks."""
    rows = spark.read.csv(path, header=True, schema="filename string, sequence_id string")
    return rows.select("filename", "sequence_id", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line")).alias("place"))


def with_sequence(images: DataFrame, manifest: DataFrame | None, tag: str) -> DataFrame:
    """Adds seq_id: the manifest's, or else what the name tells, behind the source's tag.

    Of several rows of a file the last by ``place`` counts, or without one the greatest sequence_id.
    """
    guess = F.concat(F.lit(f"{tag}_"), sequence_of(F.col("stem")))
    if manifest is None:
        return images.withColumn("seq_id", guess)
    numbered = manifest.select(F.col("filename").alias("file_name"), F.struct(*["place"] * ("place" in manifest.columns), "sequence_id").alias("s"))
    last = numbered.groupBy("file_name").agg(F.max("s")["sequence_id"].alias("__seq"))
    return images.join(last, "file_name", "left").withColumn("seq_id", F.coalesce(F.concat(F.lit(f"{tag}_"), "__seq"), guess)).drop("__seq")
