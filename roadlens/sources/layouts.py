"""Source collectors: annotated sets, label sets, and the three layouts that negatives are mined from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions.text import sequence_of
from roadlens.operators import negatives
from roadlens.operators.sampling import seeded_fraction
from roadlens.sources import voc, yolo
from roadlens.sources.images import list_images

ITEM = ["source", "path", "file_name", "stem", "lines", "seq_id"]


def annotated_set(images: DataFrame, xmls: DataFrame, tag: str, keep_negatives_frac: float = 0.0, seed: int = 42) -> DataFrame:
    """Items of images with an annotation XML (stem, xml): all with target boxes, and a share of those without.

    The share is of the images without a box. Images without XML are left out.
    """
    boxes = voc.boxes(xmls, "stem", strict=True).groupBy("stem").agg(F.sort_array(F.collect_list(voc.yolo_line(*[F.col(c) for c in ("xc", "yc", "w", "h")]))).alias("lines"))
    known = images.join(xmls.select("stem").distinct(), "stem").join(boxes, "stem", "left").withColumn("lines", F.coalesce("lines", F.array().cast("array<string>")))
    known = known.withColumn("source", F.lit(tag)).withColumn("seq_id", F.concat(F.lit(f"{tag}_"), sequence_of(F.col("stem"))))
    positives, empty = known.where(F.size("lines") > 0), known.where(F.size("lines") == 0)
    return positives.select(*ITEM).unionByName(seeded_fraction(empty, keep_negatives_frac, "file_name", seed).select(*ITEM))


def labelled_set(images: DataFrame, labels: DataFrame, tag: str, manifest: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(items, one row with missing_labels and duplicate_labels) of images joined with label texts (stem, body) by stem.

    Of several labels of a stem the one of the smallest path stays, or without paths of the smallest text.
    """
    order = F.col("path" if "path" in labels.columns else "body")
    own = labels.groupBy("stem").agg(F.min_by("body", F.struct(order, "body")).alias("body"), F.count(F.lit(1)).alias("__n"))
    dropped = own.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_labels"))
    own = own.drop("__n")
    each = yolo.boxes(own).groupBy("stem").agg(F.transform(F.sort_array(F.collect_list(F.struct("line_no", F.array_join("tokens", " ").alias("l")))), lambda s: s["l"]).alias("lines"))
    joined = images.join(own.select("stem"), "stem").join(each, "stem", "left").withColumn("lines", F.coalesce("lines", F.array().cast("array<string>")))
    items = yolo.with_sequence(joined, manifest, tag).withColumn("source", F.lit(tag)).select(*ITEM)
    missing = images.join(own, "stem", "left_anti").agg(F.count(F.lit(1)).alias("missing_labels"))
    return items, missing.join(dropped)  # a row each


def mined_negatives(os_v1: DataFrame | None = None, ws_v1: DataFrame | None = None, ws_v2: DataFrame | None = None) -> DataFrame:
    """(file_name, subrepo, category, classes_present) of the layouts that are there.

    os_v1: images alone; ws_v1: images with label texts (``body``) of 16 classes;
    ws_v2: images with ``xml``, malformed ones left out.
    """
    parts = []
    cols = ["file_name", "subrepo", "category", "classes_present"]
    if os_v1 is not None:
        parts.append(negatives.unlabelled(os_v1.withColumn("subrepo", F.lit("OS_V1"))).select(*cols))
    if ws_v1 is not None:
        parts.append(negatives.classify_ids(yolo.first_class_ids(ws_v1).withColumn("subrepo", F.lit("WS_V1"))).select(*cols))
    if ws_v2 is not None:
        names = voc.class_names(ws_v2, "file_name")
        parts.append(negatives.classify_names(names.withColumn("subrepo", F.lit("WS_V2"))).select(*cols))
    if not parts:
        raise ValueError("no layout given")
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def read_texts(spark: SparkSession, root: str, suffix: str, column: str) -> DataFrame:
    """(path, stem, column) of whole text files with a suffix below a folder; an empty file is a label without a line."""
    return yolo.read_texts(spark, root, suffix).select("path", "stem", F.col("body").alias(column))


#: The folders of the three layouts.
OS_V1, WS_V1, WS_V2 = "Attain_SMP_OS_V1.0", "Attain_SMP_WS_V1.0", "Attain_SMP_WS_V2.0"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store it is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_layouts(spark: SparkSession, root: str) -> DataFrame:
    """The negatives mined from the layouts below ``root``; layouts that aren't there are skipped.

    Images without a label text or annotation are left out where the layout has these.
    """
    found: dict[str, DataFrame] = {}
    for name, folder, suffix, column in (("os_v1", OS_V1, None, None), ("ws_v1", WS_V1, ".txt", "body"), ("ws_v2", WS_V2, ".xml", "xml")):
        if exists(spark, f"{root}/{folder}"):
            found[name] = list_images(spark, f"{root}/{folder}/Images").select("file_name", "stem")
            if suffix:
                found[name] = found[name].join(read_texts(spark, f"{root}/{folder}/Labels", suffix, column).select("stem", column), "stem")
    return mined_negatives(**found)
