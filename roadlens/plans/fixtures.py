"""Derived relations that give the operators rows to work on, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.session import shuffled, table

#: A total order of line items.
LK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
LK_SQL = ", ".join(LK)


def images(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS image_id",
        "concat('seq', o_custkey) AS seq_id",
        "concat('seq', o_custkey, '_', o_orderkey) AS stem",
        "element_at(array('.jpg', '.png', '.jpeg', '.JPG'), cast(o_orderkey % 4 as int) + 1) AS ext",
        "320 + 320 * (o_orderkey % 4) AS width",
        "240 + 240 * (o_orderkey % 3) AS height",
        "CASE WHEN o_custkey % 10 = 0 THEN 'test' WHEN o_custkey % 10 <= 2 THEN 'val' ELSE 'train' END AS split",
        "o_orderstatus AS source",
    ).withColumn("file_name", F.concat("stem", "ext"))


IMAGES_SQL = """fx_images AS (
  SELECT o_orderkey AS image_id, 'seq' || o_custkey AS seq_id, 'seq' || o_custkey || '_' || o_orderkey AS stem,
    ['.jpg', '.png', '.jpeg', '.JPG'][o_orderkey % 4 + 1] AS ext, 320 + 320 * (o_orderkey % 4) AS width, 240 + 240 * (o_orderkey % 3) AS height,
    CASE WHEN o_custkey % 10 = 0 THEN 'test' WHEN o_custkey % 10 <= 2 THEN 'val' ELSE 'train' END AS split, o_orderstatus AS source,
    'seq' || o_custkey || '_' || o_orderkey || ['.jpg', '.png', '.jpeg', '.JPG'][o_orderkey % 4 + 1] AS file_name
  FROM orders)"""


def detections(spark: SparkSession, sf: str, nms: bool = False) -> DataFrame:
    """Boxes of line items in a 640 x 480 frame; ``nms`` gives the larger, overlapping ones."""
    w = "6 * l_quantity + 40" if nms else "2 * l_quantity + 8"
    h = "4000 * l_tax + 60" if nms else "1000 * l_tax + 8"
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS image_id",
        *LK,
        "cast(l_partkey % 577 as double) AS x1",
        "cast((l_suppkey * 37) % 431 as double) AS y1",
        f"least(cast(l_partkey % 577 as double) + {w}, 640D) AS x2",
        f"least(cast((l_suppkey * 37) % 431 as double) + {h}, 480D) AS y2",
        "10 * l_discount AS confidence",
        "640D AS width",
        "480D AS height",
    )


def _det_sql(name: str, w: str, h: str) -> str:
    return f"""{name} AS (
  SELECT l_orderkey AS image_id, {LK_SQL}, (l_partkey % 577)::double AS x1, ((l_suppkey * 37) % 431)::double AS y1,
    least((l_partkey % 577)::double + {w}, 640::double) AS x2, least(((l_suppkey * 37) % 431)::double + {h}, 480::double) AS y2,
    10 * l_discount AS confidence, 640::double AS width, 480::double AS height
  FROM lineitem)"""


DETECTIONS_SQL = _det_sql("fx_detections", "2 * l_quantity + 8", "1000 * l_tax + 8")
NMS_SQL = _det_sql("fx_nms", "6 * l_quantity + 40", "4000 * l_tax + 60")

#: Planted label lines by (l_partkey + l_suppkey + l_linenumber) % 23.
PLANTED = [
    "0 0.5 0.5 0.2", "0 abc 0.5 0.2 0.2", "7 0.5 0.5 0.2 0.2", "0 1.2 0.5 0.2 0.2", "0 0.5 0.5 0.01 0.01", "0 0.95 0.5 0.2 0.2",
    "0 nan 0.5 0.1 0.1", "", "0.0 0.5 0.5 0.2 0.2", "1d 0.5 0.5 0.2 0.2", "0 -0.1 1.5 2 0.2",
]
USUAL = "0 0.5 0.5 0.2 0.2"


def labels(spark: SparkSession, sf: str) -> DataFrame:
    """(split, stem, body): one label text per image that has one, and 50 orphans."""
    residue = (F.col("l_partkey") + F.col("l_suppkey") + F.col("l_linenumber")) % 23
    line = F.coalesce(F.get(F.array(*[F.lit(x) for x in PLANTED]), residue.cast("int")), F.lit(USUAL))
    lines = table(spark, sf, "lineitem").select(*LK, line.alias("line"))
    bodies = lines.groupBy("l_orderkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*LK[1:], "line"))), lambda s: s["line"]), "\n").alias("body"))
    own = images(spark, sf).where("image_id % 29 <> 0").join(shuffled(bodies), F.col("image_id") == F.col("l_orderkey"), "left").select("split", "stem", F.coalesce("body", F.lit("")).alias("body"))
    orphans = spark.range(50).select(F.lit("train").alias("split"), F.concat(F.lit("orphan_"), "id").alias("stem"), F.lit(USUAL).alias("body"))
    return own.unionByName(orphans)


_CASES = " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(PLANTED))
LABELS_SQL = f"""fx_bodies AS (
  SELECT l_orderkey, string_agg(CASE (l_partkey + l_suppkey + l_linenumber) % 23 {_CASES} ELSE '{USUAL}' END, chr(10) ORDER BY {LK_SQL}) AS body
  FROM lineitem GROUP BY l_orderkey),
fx_labels AS (
  SELECT split, stem, coalesce(body, '') AS body FROM fx_images LEFT JOIN fx_bodies ON image_id = l_orderkey WHERE image_id % 29 <> 0
  UNION ALL SELECT 'train', 'orphan_' || i, '{USUAL}' FROM range(50) t(i))"""


def hashed_files(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").selectExpr(
        "concat(source, '/', doc_id) AS path", "cast(doc_id as string) AS name", "md5(text) AS md5", "source", "doc_id",
        "CASE WHEN doc_id % 10 = 0 THEN 'test' WHEN doc_id % 10 <= 2 THEN 'val' ELSE 'train' END AS split",
    )


FILES_SQL = """fx_files AS (
  SELECT source || '/' || doc_id AS path, doc_id::varchar AS name, md5(text) AS md5, source, doc_id,
    CASE WHEN doc_id % 10 = 0 THEN 'test' WHEN doc_id % 10 <= 2 THEN 'val' ELSE 'train' END AS split
  FROM documents)"""


#: Bits that differ from the first of eight documents' fingerprint: equal ones, and distances of 5, 6 and 7, spread and far ones.
PRINT_MASKS = [0, 31, 63, 127, 0, 31 << 20, 1023, 2147483647]


def fingerprinted(spark: SparkSession, sf: str) -> DataFrame:
    masks = ", ".join(f"{m}L" for m in PRINT_MASKS)
    return table(spark, sf, "documents").selectExpr(
        "doc_id AS id",
        f"conv(substr(md5(cast(doc_id div 8 as string)), 1, 15), 16, 10)::bigint ^ element_at(array({masks}), cast(doc_id % 8 as int) + 1) AS fp",
        "CASE WHEN doc_id % 10 = 0 THEN 'test' WHEN doc_id % 10 <= 2 THEN 'val' ELSE 'train' END AS split",
    )


FP_SQL = f"""fx_fp AS (
  SELECT doc_id AS id, xor(('0x' || substr(md5((doc_id // 8)::varchar), 1, 15))::bigint, {PRINT_MASKS}[doc_id % 8 + 1]::bigint) AS fp,
    CASE WHEN doc_id % 10 = 0 THEN 'test' WHEN doc_id % 10 <= 2 THEN 'val' ELSE 'train' END AS split
  FROM documents)"""


def hashed_prints(spark: SparkSession, sf: str) -> DataFrame:
    """``hashed_files`` with the fingerprint of each file next to its md5."""
    return hashed_files(spark, sf).join(shuffled(fingerprinted(spark, sf).select(F.col("id").alias("doc_id"), "fp")), "doc_id")


def class_sets(spark: SparkSession, sf: str) -> DataFrame:
    """(image_id, class_ids): up to three of 16 classes."""
    return table(spark, sf, "part").selectExpr(
        "p_partkey AS image_id",
        "CASE WHEN p_partkey % 17 = 0 THEN cast(array() as array<int>) ELSE array_sort(array_distinct(array(p_size % 16, (p_size * 7) % 16, cast((p_partkey * 3) % 16 as int)))) END AS class_ids",
    )


CLASSES_SQL = """fx_classes AS (
  SELECT p_partkey AS image_id, CASE WHEN p_partkey % 17 = 0 THEN []::bigint[] ELSE list_sort(list_distinct([p_size % 16, (p_size * 7) % 16, (p_partkey * 3) % 16]))::bigint[] END AS class_ids
  FROM part)"""


def negatives(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr("concat('bg', user_id, '_', event_id) AS stem", "concat('bg', user_id, '_', event_id, '.jpg') AS file_name")


NEGATIVES_SQL = """fx_negatives AS (
  SELECT 'bg' || user_id || '_' || event_id AS stem, 'bg' || user_id || '_' || event_id || '.jpg' AS file_name FROM events)"""


def requests(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_id", "value / 20 AS size_mb", "CASE event_id % 5 WHEN 0 THEN 'image/gif' WHEN 1 THEN 'image/png' ELSE 'image/jpeg' END AS content_type",
        "event_id % 11 <> 0 AS decodable", "value * 100 AS elapsed_ms", "true AS model_loaded",
    )


REQUESTS_SQL = """fx_requests AS (
  SELECT event_id, value / 20 AS size_mb, CASE event_id % 5 WHEN 0 THEN 'image/gif' WHEN 1 THEN 'image/png' ELSE 'image/jpeg' END AS content_type,
    event_id % 11 <> 0 AS decodable, value * 100 AS elapsed_ms, true AS model_loaded
  FROM events)"""


def picture_files(spark: SparkSession, sf: str) -> DataFrame:
    """(image_id, split, file_name, content): the file headers of the images, PNG or JPEG as the suffix says.

    JPEGs hold an EXIF orientation of 1 to 8; of every 17th image the end is missing.
    """
    own = images(spark, sf)
    word = lambda c, n: F.lpad(F.hex(F.col(c)), n, "0")
    ihdr = F.concat(F.lit("49484452"), word("width", 8), word("height", 8), F.lit("0802000000"))
    check = F.lpad(F.hex(F.crc32(F.unhex(ihdr))), 8, "0")
    end = lambda x: F.when(F.col("image_id") % 17 == 0, "").otherwise(x)
    as_png = F.concat(F.lit("89504E470D0A1A0A0000000D"), ihdr, check, F.lit("0000000049444154"), F.lit("35AF061E"), end("0000000049454E44AE426082"))
    exif = F.concat(F.lit("FFE10022457869660000" + "4D4D002A00000008" + "0001" + "0112000300000001"), F.lpad(F.hex(F.col("image_id") % 8 + 1), 4, "0"), F.lit("0000" + "00000000"))
    frame = F.concat(F.lit("FFC0001108"), word("height", 4), word("width", 4), F.lit("03011100021101031101"))
    as_jpeg = F.concat(F.lit("FFD8"), exif, frame, F.lit("FFDA0002"), end("FFD9"))
    return own.select("image_id", "split", "file_name", F.unhex(F.when(F.col("ext") == ".png", as_png).otherwise(as_jpeg)).alias("content"))


PICTURES_SQL = """fx_pictures AS (
  SELECT *, image_id % 17 <> 0 AS readable, CASE WHEN ext = '.png' OR image_id % 17 = 0 THEN 1 ELSE image_id % 8 + 1 END AS orientation FROM fx_images)"""


def annotations(spark: SparkSession, sf: str) -> DataFrame:
    """(image_id, file_name, stem, xml): the class sets as annotation documents, D40 where the id is a multiple of 4; names are padded, and every 19th document is cut off."""
    one = lambda i: F.concat(
        F.lit("<object><name> D"), F.when(i % 4 == 0, "40").otherwise(i.cast("string")), F.lit("</name><bndbox><xmin>"), (i * 10).cast("string"), F.lit("</xmin><ymin>"), (i * 5).cast("string"),
        F.lit("</ymin><xmax>"), (i * 10 + 64).cast("string"), F.lit("</xmax><ymax>"), (i * 5 + 48).cast("string"), F.lit("</ymax></bndbox></object>"),
    )
    whole = F.concat(F.lit("<annotation><size><width>640</width><height>480</height></size>"), F.array_join(F.transform("class_ids", one), ""), F.lit("</annotation>"))
    cut = F.when(F.col("image_id") % 19 == 0, F.lit("<annotation><object><name>D40")).otherwise(whole)
    return class_sets(spark, sf).select("image_id", F.concat(F.lit("road"), F.col("image_id") % 50, F.lit("_"), "image_id", F.lit(".jpg")).alias("file_name"), F.concat(F.lit("road"), F.col("image_id") % 50, F.lit("_"), "image_id").alias("stem"), cut.alias("xml"))


ANNOTATIONS_SQL = """fx_annotated AS (
  SELECT image_id, class_ids, 'road' || image_id % 50 || '_' || image_id AS stem, 'road' || image_id % 50 || '_' || image_id || '.jpg' AS file_name FROM fx_classes)"""


def tensors(spark: SparkSession, sf: str) -> DataFrame:
    """(image_id, output): line items as a detector's raw output of five rows by anchor, in the order of ``LK``."""
    own = table(spark, sf, "lineitem").selectExpr("l_orderkey AS image_id", *LK, "cast(l_partkey % 577 as double) AS cx", "cast((l_suppkey * 37) % 431 as double) AS cy", "2 * l_quantity + 8 AS w", "1000 * l_tax + 8 AS h", "10 * l_discount AS score")
    rows = own.groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct(*LK, "cx", "cy", "w", "h", "score"))).alias("a"))
    of = lambda n: F.col(f"a.{n}")  # noqa: E731  a field of an array of rows is an array
    return rows.select("image_id", F.array(*map(of, ("cx", "cy", "w", "h", "score"))).alias("output"))


TENSORS_SQL = f"""fx_anchors AS (
  SELECT l_orderkey AS image_id, (row_number() OVER (PARTITION BY l_orderkey ORDER BY {LK_SQL}) - 1)::int AS anchor_id,
    (l_partkey % 577)::double AS cx, ((l_suppkey * 37) % 431)::double AS cy, 2 * l_quantity + 8 AS w, 1000 * l_tax + 8 AS h, 10 * l_discount AS score
  FROM lineitem)"""
