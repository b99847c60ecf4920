"""Pascal-VOC annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions.geometry import corners_to_centre

SCHEMA = "size struct<width:double,height:double>, object array<struct<name:string,bndbox:struct<xmin:double,ymin:double,xmax:double,ymax:double>>>"


def parse(docs: DataFrame, column: str = "xml", strict: bool = False) -> DataFrame:
    """Adds ``voc``: null for malformed XML, or with ``strict`` an error."""
    return docs.withColumn("voc", F.from_xml(column, SCHEMA, {"mode": "FAILFAST" if strict else "PERMISSIVE", "ignoreSurroundingSpaces": "false", "rowTag": "annotation"}))


def boxes(docs: DataFrame, key: str, target: str = "D40", strict: bool = False) -> DataFrame:
    """(key, class_id, xc, yc, w, h): objects of the target class, names compared as written; null for an image without extent."""
    o = parse(docs, strict=strict).select(key, "voc.size", F.explode("voc.object").alias("o")).where(F.col("o.name") == target)
    b = [F.col(f"o.bndbox.{n}") for n in ("xmin", "ymin", "xmax", "ymax")]
    return o.select(key, F.lit(0).alias("class_id"), *corners_to_centre(*b, F.col("size.width"), F.col("size.height")))


def yolo_line(xc, yc, w, h):
    """The label line of a relative box, six digits each."""
    return F.format_string("0 %.6f %.6f %.6f %.6f", xc, yc, w, h)


def class_names(docs: DataFrame, key: str) -> DataFrame:
    """(key, class_names): distinct stripped object names; malformed documents are left out."""
    parsed = parse(docs).where("voc IS NOT NULL AND (voc.size IS NOT NULL OR voc.object IS NOT NULL)")
    names = F.transform(F.coalesce("voc.object", F.array().cast("array<struct<name:string,bndbox:struct<xmin:double,ymin:double,xmax:double,ymax:double>>>")), lambda o: F.trim(F.regexp_replace(o["name"], r"^\s+|\s+$", "")))
    return parsed.select(key, F.array_sort(F.array_distinct(F.array_compact(names))).alias("class_names"))
