"""Negative mining from class sets of three source layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The names of the 16-class source in id order, the classes that exclude an image and those that make it a priority.
CLASS_NAMES = [
    "Alligator crack - High", "Alligator crack - Low", "Alligator crack - low", "Block crack - Low",
    "Faded marking - High", "Faded marking - Low", "Linear crack - High", "Linear crack - Low",
    "Manhole - High", "Manhole - Low", "Patch - Low", "Pothole - High",
    "Pothole - Low", "Raveling - Low", "Weathering - High", "Weathering - Low",
]
EXCLUDED = ["Pothole - High", "Pothole - Low"]
PRIORITY = ["Faded marking - High", "Faded marking - Low", "Patch - Low"]
PRIORITY_NAMED = ["Faded marking - High", "Faded marking - Low", "Patch and utility cut- High", "Patch and utility cut- Low"]


def class_names(ids: Column) -> Column:
    """Names of class ids; null for an id beyond the list."""
    names = F.array(*[F.lit(n) for n in CLASS_NAMES])
    return F.transform(ids, lambda i: F.when((i >= 0) & (i < len(CLASS_NAMES)), F.get(names, i.cast("int"))))


def category(names: Column, excluded: list[str], priority: list[str]) -> Column:
    """excluded, priority or generic."""
    has = lambda wanted: F.coalesce(F.arrays_overlap(names, F.array(*[F.lit(n) for n in wanted])), F.lit(False))
    return F.when(has(excluded), "excluded").when(has(priority), "priority").otherwise("generic")


def present(names: Column) -> Column:
    """The names in order, "; " between them, or "(empty)"."""
    return F.coalesce(F.nullif(F.array_join(F.array_sort(F.array_compact(names)), "; "), F.lit("")), F.lit("(empty)"))


def classify_ids(images: DataFrame) -> DataFrame:
    """Adds category and classes_present to rows with ``class_ids`` of the 16-class source."""
    names = class_names(F.col("class_ids"))
    return images.withColumn("category", category(names, EXCLUDED, PRIORITY)).withColumn("classes_present", present(names))


def classify_names(images: DataFrame) -> DataFrame:
    """The same for rows with ``class_names`` of the free-text source; names are compared exactly."""
    return images.withColumn("category", category(F.col("class_names"), EXCLUDED, PRIORITY_NAMED)).withColumn("classes_present", present(F.col("class_names")))


def unlabelled(images: DataFrame) -> DataFrame:
    """The layout without labels: all of it is generic."""
    return images.withColumn("category", F.lit("generic")).withColumn("classes_present", F.lit("(empty)"))


def manifest(classified: DataFrame) -> DataFrame:
    """(filename, category, source_classes_present, source_subrepo) of what isn't excluded."""
    return classified.where("category <> 'excluded'").select(F.concat(F.lit("attain_"), "file_name").alias("filename"), "category", F.col("classes_present").alias("source_classes_present"), F.col("subrepo").alias("source_subrepo"))
