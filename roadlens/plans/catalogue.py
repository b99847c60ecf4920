"""All queries over the driver's tables, with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions.severity import SeverityScorer, score_frames
from roadlens.functions.text import sequence_of
from roadlens.operators import augment, chains, dedupe, detect, evaluate, forest, near_index, negatives, sampling, similarity, split, stats, validate
from roadlens.plans import fixtures as fx
from roadlens.session import materialize, scratch_dir, shuffled
from roadlens.sources import file_tree, headers, layouts, voc, yolo

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


# Severity -------------------------------------------------------------------------------------------------------------

_AREA = "greatest(0::double, x2 - x1) * greatest(0::double, y2 - y1) / (width * height)"
_VPOS = "least(1::double, greatest(0::double, (y1 + y2) / 2 / height))"
SCORED_SQL = f"""{fx.DETECTIONS_SQL},
fx_area AS (SELECT *, count(*) OVER (PARTITION BY image_id) AS n_in_frame, {_AREA} AS area_frac, {_VPOS} AS vpos FROM fx_detections),
fx_score AS (SELECT *, least(1::double, area_frac * 10 + 0.08::double * (n_in_frame - 1) + 0.15::double * vpos) AS severity_score FROM fx_area),
fx_scored AS (SELECT *, CASE WHEN area_frac < 0.01::double AND severity_score < 0.3::double THEN 'minor' WHEN area_frac < 0.04::double AND severity_score < 0.6::double THEN 'moderate' ELSE 'severe' END AS severity FROM fx_score)"""


@query(f"WITH {SCORED_SQL} SELECT {fx.LK_SQL}, n_in_frame, area_frac, vpos, severity_score, severity FROM fx_scored")
def severity_scores(spark, sf):
    return score_frames(fx.detections(spark, sf)).select(*fx.LK, "n_in_frame", "area_frac", "vpos", "severity_score", "severity")


@query(f"WITH {SCORED_SQL} SELECT severity, count(*) AS n, max(n_in_frame) AS most_in_frame FROM fx_scored GROUP BY severity")
def severity_label_counts(spark, sf):
    return score_frames(fx.detections(spark, sf)).groupBy("severity").agg(F.count(F.lit(1)).alias("n"), F.max("n_in_frame").alias("most_in_frame"))


@query(f"WITH {SCORED_SQL} SELECT {fx.LK_SQL}, 1 + (n_in_frame > 1)::int + (0.15::double * vpos > 0.01::double)::int AS n_reasons, n_in_frame > 1 AS several FROM fx_scored")
def severity_reasons(spark, sf):
    reasons = SeverityScorer().reasons(F.col("area_frac"), F.col("vpos"), F.col("n_in_frame"))
    return score_frames(fx.detections(spark, sf)).select(*fx.LK, F.size(reasons).alias("n_reasons"), F.exists(reasons, lambda r: r.contains("same frame")).alias("several"))


@query()
def scoring_responses(spark, sf):
    """The service's JSON answer of every frame after suppression; its texts hold formatted numbers."""
    kept = detect.suppress(fx.detections(spark, sf, nms=True), detect.IOU, ties=fx.LK)
    return detect.responses(score_frames(kept), F.lit("stub"), frames=fx.images(spark, sf).select("image_id"))


# Statistics -----------------------------------------------------------------------------------------------------------

_STRIPPED = r"regexp_replace(body, '^\s+|\s+$', '', 'g')"
_BOXES = rf"CASE WHEN {_STRIPPED} = '' THEN 0 ELSE len(string_split({_STRIPPED}, chr(10))) END"
_STATS = f"""WITH {fx.IMAGES_SQL}, {fx.LABELS_SQL},
r AS (SELECT split, 1 AS image, 0 AS label, 0 AS boxes, 0 AS empty FROM fx_images UNION ALL SELECT split, 0, 1, {_BOXES}, ({_BOXES} = 0)::int FROM fx_labels)
SELECT split, sum(image)::bigint AS images, sum(label)::bigint AS labels, sum(boxes)::bigint AS boxes, sum(empty)::bigint AS empty_labels,
  (sum(image) - sum(label))::bigint AS missing_labels, sum(boxes)::double / nullif(sum(image), 0) AS boxes_per_image FROM r GROUP BY """


@query(_STATS + "split")
def stats_per_split(spark, sf):
    return stats.per_split(fx.images(spark, sf), fx.labels(spark, sf))


@query(_STATS + "ROLLUP (split)")
def stats_rollup(spark, sf):
    return stats.per_split(fx.images(spark, sf), fx.labels(spark, sf), total=True)


@query(f"WITH {fx.IMAGES_SQL} SELECT ext, count(*) AS n FROM fx_images GROUP BY ext")
def ext_histogram(spark, sf):
    return stats.extension_histogram(fx.images(spark, sf))


@query(
    f"""WITH {fx.IMAGES_SQL}, h AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY file_name, image_id) AS rn FROM fx_images),
g AS (SELECT split, width, height, count(*) AS n FROM h WHERE rn <= 100 GROUP BY ALL) SELECT *, count(*) OVER (PARTITION BY split) > 1 AS mixed FROM g"""
)
def resolution_histogram(spark, sf):
    return stats.resolution_histogram(fx.images(spark, sf))


@query(f"WITH {fx.IMAGES_SQL}, g AS (SELECT split, width, height, count(*) AS n FROM fx_images GROUP BY ALL) SELECT *, count(*) OVER (PARTITION BY split) > 1 AS mixed FROM g")
def resolution_histogram_all(spark, sf):
    return stats.resolution_histogram(fx.images(spark, sf), first=None)


@query(f"WITH {fx.IMAGES_SQL}, g AS (SELECT split, count(*) AS n FROM fx_images GROUP BY split) SELECT split, n, n::double / (sum(n) OVER ())::bigint AS ratio FROM g")
def split_ratio(spark, sf):
    return stats.split_ratio(fx.images(spark, sf))


@query(f"WITH {fx.IMAGES_SQL} SELECT split, count(*) AS n FROM fx_images WHERE ext IN ('.jpg', '.png', '.jpeg') GROUP BY split")
def files_per_split(spark, sf):
    return stats.files_per_split(fx.images(spark, sf))


# Validation -----------------------------------------------------------------------------------------------------------

PAIRS_SQL = f"{fx.FP_SQL}, p AS (SELECT a.id AS id_a, b.id AS id_b, bit_count(xor(a.fp, b.fp))::int AS distance, a.split AS sa, b.split AS sb FROM fx_fp a JOIN fx_fp b ON a.id < b.id WHERE bit_count(xor(a.fp, b.fp)) <= 6)"
_NUM = r"^[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)$"
FINDINGS_SQL = rf"""{fx.IMAGES_SQL}, {fx.LABELS_SQL}, {fx.FILES_SQL}, {PAIRS_SQL},
s AS (SELECT split, stem, {_STRIPPED} AS b FROM fx_labels WHERE (split, stem) IN (SELECT (split, stem) FROM fx_images)),
l AS (SELECT split, stem, unnest(string_split(b, chr(10))) AS line, generate_subscripts(string_split(b, chr(10)), 1) AS line_no FROM s WHERE b <> ''),
t AS (SELECT *, CASE WHEN trim(line) = '' THEN [] ELSE regexp_split_to_array(regexp_replace(line, '^\s+|\s+$', '', 'g'), '\s+') END AS tok FROM l),
u AS (SELECT *, len(tok) = 5 AS five, len(tok) = 5 AND regexp_full_match(coalesce(tok[1], ''), '[+-]?\d+')
    AND regexp_matches(lower(coalesce(tok[2], '')), '{_NUM}') AND regexp_matches(lower(coalesce(tok[3], '')), '{_NUM}')
    AND regexp_matches(lower(coalesce(tok[4], '')), '{_NUM}') AND regexp_matches(lower(coalesce(tok[5], '')), '{_NUM}') AS num FROM t),
v AS (SELECT *, CASE WHEN num THEN try_cast(tok[1] AS bigint) END AS cls, CASE WHEN num THEN try_cast(tok[2] AS double) END AS xc, CASE WHEN num THEN try_cast(tok[3] AS double) END AS yc,
    CASE WHEN num THEN try_cast(tok[4] AS double) END AS bw, CASE WHEN num THEN try_cast(tok[5] AS double) END AS bh FROM u),
f AS (
  SELECT 'W' AS level, 'V4' AS rule, split, stem || '.txt' AS file, NULL::int AS line_no, '{validate.EMPTY}' AS message FROM s WHERE b = ''
  UNION ALL SELECT 'E', 'V5', split, stem || '.txt', line_no, '{validate.NOT_FIVE}' || len(tok) FROM v WHERE NOT five
  UNION ALL SELECT 'E', 'V6', split, stem || '.txt', line_no, '{validate.NOT_NUMERIC}' FROM v WHERE five AND NOT num
  UNION ALL SELECT 'E', 'V7', split, stem || '.txt', line_no, 'invalid class_id ' || tok[1] || ' (expected 0)' FROM v WHERE num AND cls <> 0
  UNION ALL SELECT 'E', 'V8', split, stem || '.txt', line_no, 'x_center outside [0,1]' FROM v WHERE num AND NOT (xc >= 0 AND xc <= 1)
  UNION ALL SELECT 'E', 'V8', split, stem || '.txt', line_no, 'y_center outside [0,1]' FROM v WHERE num AND NOT (yc >= 0 AND yc <= 1)
  UNION ALL SELECT 'E', 'V8', split, stem || '.txt', line_no, 'width outside [0,1]' FROM v WHERE num AND NOT (bw >= 0 AND bw <= 1)
  UNION ALL SELECT 'E', 'V8', split, stem || '.txt', line_no, 'height outside [0,1]' FROM v WHERE num AND NOT (bh >= 0 AND bh <= 1)
  UNION ALL SELECT 'W', 'V9', split, stem || '.txt', line_no, '{validate.SMALL}' FROM v WHERE num AND bw * bh < 0.0005::double
  UNION ALL SELECT 'E', 'V10', split, stem || '.txt', line_no, '{validate.BEYOND}' FROM v WHERE num AND
    (xc - bw / 2 < -1e-6::double OR yc - bh / 2 < -1e-6::double OR (xc + bw / 2 > 1 + 1e-6::double AND NOT isnan(xc + bw / 2)) OR (yc + bh / 2 > 1 + 1e-6::double AND NOT isnan(yc + bh / 2)))
  UNION ALL SELECT 'E', 'V3', i.split, i.file_name, NULL, '{validate.NO_LABEL}' FROM fx_images i ANTI JOIN fx_labels l USING (split, stem)
  UNION ALL SELECT 'E', 'V11', l.split, l.stem || '.txt', NULL, '{validate.ORPHAN}' FROM fx_labels l ANTI JOIN fx_images i USING (split, stem)
  UNION ALL SELECT 'E', 'V1', 'holdout', NULL, NULL, '{validate.MISSING_PART}'
  UNION ALL SELECT 'E', 'V12', split, NULL, NULL, '{validate.DUPLICATE}' || substr(md5, 1, 8) || '): ' || string_agg(path, ', ' ORDER BY path) FROM fx_files GROUP BY split, md5 HAVING count(*) > 1
  UNION ALL SELECT 'W', 'V13', NULL, NULL, NULL, '{validate.LEAKAGE}' || least(a.path, b.path) || ' (' || CASE WHEN a.path < b.path THEN sa ELSE sb END || ') ~= '
    || greatest(a.path, b.path) || ' (' || CASE WHEN a.path < b.path THEN sb ELSE sa END || ') (phash distance ' || distance || ')'
    FROM p JOIN fx_files a ON a.doc_id = id_a JOIN fx_files b ON b.doc_id = id_b WHERE sa <> sb)"""


def _findings(spark, sf, leaks: bool = True):
    files = fx.hashed_prints(spark, sf) if leaks else fx.hashed_files(spark, sf)
    return validate.validate(fx.images(spark, sf), fx.labels(spark, sf), files=files, splits=(*validate.SPLITS, "holdout"))


@query(f"WITH {FINDINGS_SQL} SELECT level, rule, split, file, line_no::int AS line_no, message FROM f")
def validate_findings(spark, sf):
    return _findings(spark, sf)


@query(f"WITH {FINDINGS_SQL} SELECT level, rule, split, count(*) AS n FROM f GROUP BY level, rule, split")
def validate_summary(spark, sf):
    return validate.summary(_findings(spark, sf, leaks=False), validate.leaked_classes(fx.hashed_prints(spark, sf)))


@query(f"WITH {FINDINGS_SQL} SELECT count(*) FILTER (WHERE level = 'E') AS errors, count(*) FILTER (WHERE level = 'W') AS warnings, count(*) FILTER (WHERE level = 'E') = 0 AS passed FROM f")
def validate_verdict(spark, sf):
    return validate.verdict(_findings(spark, sf, leaks=False), validate.leaked_classes(fx.hashed_prints(spark, sf)))


@query(
    f"""WITH {PAIRS_SQL}, d AS (SELECT fp, split, count(*) AS n, min(id) AS first FROM fx_fp GROUP BY fp, split)
SELECT a.fp AS fp_a, b.fp AS fp_b, bit_count(xor(a.fp, b.fp))::int AS distance, a.split AS split_a, b.split AS split_b, a.n AS n_a, b.n AS n_b, a.first AS path_a, b.first AS path_b
FROM d a JOIN d b ON a.split <> b.split AND (a.fp < b.fp OR (a.fp = b.fp AND a.split < b.split)) WHERE bit_count(xor(a.fp, b.fp)) <= 6"""
)
def leakage_classes(spark, sf):
    """Leakage across splits by classes of equal fingerprints, with their counts."""
    return validate.leaked_classes(fx.fingerprinted(spark, sf).withColumnRenamed("id", "path"))


@query(f"WITH {fx.IMAGES_SQL}, {fx.LABELS_SQL} SELECT split, file_name AS file FROM fx_images ANTI JOIN fx_labels USING (split, stem)")
def missing_labels(spark, sf):
    return validate.missing_labels(fx.images(spark, sf), fx.labels(spark, sf)).select("split", "file")


@query(f"WITH {fx.IMAGES_SQL}, {fx.LABELS_SQL} SELECT split, stem || '.txt' AS file FROM fx_labels ANTI JOIN fx_images USING (split, stem)")
def orphan_labels(spark, sf):
    return validate.orphan_labels(fx.images(spark, sf), fx.labels(spark, sf)).select("split", "file")


@query(
    f"""WITH {fx.FILES_SQL} SELECT split, '{validate.DUPLICATE}' || substr(md5, 1, 8) || '): ' || string_agg(path, ', ' ORDER BY path) AS message
FROM fx_files GROUP BY split, md5 HAVING count(*) > 1"""
)
def duplicate_findings(spark, sf):
    return validate.duplicate_images(fx.hashed_files(spark, sf)).select("split", "message")


# Duplicates -----------------------------------------------------------------------------------------------------------


@query(f"WITH {fx.FILES_SQL} SELECT md5, count(*) AS n, min(path) AS first_path FROM fx_files GROUP BY md5 HAVING count(*) > 1")
def exact_duplicate_groups(spark, sf):
    return dedupe.exact_groups(fx.hashed_files(spark, sf))


_PRIO = "CASE split WHEN 'test' THEN 0 WHEN 'val' THEN 1 ELSE 2 END"
KEEP_SQL = f"""{fx.FILES_SQL}, c AS (SELECT *, min(path) OVER (PARTITION BY md5) AS cluster FROM fx_files),
k AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY {_PRIO}, name, path) AS rank FROM c)"""


def _clustered(spark, sf):
    files = fx.hashed_files(spark, sf)
    return files.join(dedupe.clusters(files, "path", exact_only=True), "path")


@query(f"WITH {KEEP_SQL} SELECT cluster, path, split, rank FROM k")
def dedupe_keepers(spark, sf):
    return dedupe.keepers(_clustered(spark, sf)).select("cluster", "path", "split", "rank")


@query(f"WITH {KEEP_SQL} SELECT cluster, path FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY name, source, path) AS r2 FROM k) WHERE r2 = 1")
def merge_keepers(spark, sf):
    return dedupe.kept_members(_clustered(spark, sf), dedupe.merge_order()).select("cluster", "path")


@query(f"WITH {KEEP_SQL} SELECT split, count(*) AS before, count(*) FILTER (WHERE rank > 1) AS removed, count(*) FILTER (WHERE rank = 1) AS after FROM k GROUP BY split")
def dedupe_removals(spark, sf):
    files = fx.hashed_files(spark, sf)
    return dedupe.removal_summary(files, dedupe.removals(dedupe.lost_members(_clustered(spark, sf))))


@query(f"WITH {PAIRS_SQL} SELECT id_a, id_b, distance FROM p")
def near_duplicate_pairs(spark, sf):
    return similarity.near_pairs(fx.fingerprinted(spark, sf))


@query(f"WITH {PAIRS_SQL} SELECT id_a, id_b, distance FROM p WHERE sa <> sb")
def cross_split_leakage(spark, sf):
    return similarity.near_pairs(fx.fingerprinted(spark, sf), across="split").select("id_a", "id_b", "distance")


CLUSTERS_SQL = (
    PAIRS_SQL.replace("WITH ", "")
    + """, e AS (SELECT id_a AS x, id_b AS y FROM p UNION ALL SELECT id_b, id_a FROM p),
reach(id, r) AS (SELECT id, id FROM fx_fp UNION SELECT reach.id, e.y FROM reach JOIN e ON e.x = reach.r),
m AS (SELECT id, min(r) AS cluster FROM reach GROUP BY id)"""
)


@query(f"WITH RECURSIVE {CLUSTERS_SQL} SELECT id, cluster FROM m")
def duplicate_clusters(spark, sf):
    return dedupe.clusters(fx.fingerprinted(spark, sf))


@query(f"WITH RECURSIVE {CLUSTERS_SQL} SELECT size, count(*) AS clusters FROM (SELECT cluster, count(*) AS size FROM m GROUP BY cluster HAVING count(*) > 1) GROUP BY size")
def cluster_size_histogram(spark, sf):
    return dedupe.size_histogram(dedupe.clusters(fx.fingerprinted(spark, sf)))


@query(f"WITH RECURSIVE {CLUSTERS_SQL} SELECT cluster, count(*) AS size FROM m GROUP BY cluster HAVING count(*) > 1 ORDER BY size DESC, cluster LIMIT 20")
def largest_clusters(spark, sf):
    return dedupe.largest_clusters(dedupe.clusters(fx.fingerprinted(spark, sf)))


@query(
    f"""WITH RECURSIVE {CLUSTERS_SQL}, z AS (SELECT cluster, count(*) AS size FROM m GROUP BY cluster HAVING count(*) > 1),
d AS (SELECT cluster FROM (SELECT cluster FROM z ORDER BY md5('42:' || cluster), cluster LIMIT 15) UNION SELECT cluster FROM (SELECT cluster FROM z ORDER BY size DESC, cluster LIMIT 5))
SELECT cluster, id AS member, row_number() OVER (PARTITION BY cluster ORDER BY id)::int AS position FROM m JOIN d USING (cluster) QUALIFY position <= 8"""
)
def cluster_montage(spark, sf):
    return dedupe.montage(dedupe.clusters(fx.fingerprinted(spark, sf)))


#: Clusters over equal content and near fingerprints together, the reference's default; KEEP_SQL is its exact-only option.
COMBINED_SQL = f"""{fx.FILES_SQL}, {PAIRS_SQL},
f AS (SELECT path, CASE WHEN md5 IS NULL THEN path ELSE min(path) OVER (PARTITION BY md5) END AS first FROM fx_files),
e AS (SELECT a.path AS x, b.path AS y FROM p JOIN fx_files a ON a.doc_id = id_a JOIN fx_files b ON b.doc_id = id_b UNION ALL SELECT first, path FROM f WHERE first <> path),
b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach(path, r) AS (SELECT path, path FROM fx_files UNION SELECT reach.path, b.y FROM reach JOIN b ON b.x = reach.r),
m AS (SELECT path, min(r) AS cluster FROM reach GROUP BY path),
k AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY {_PRIO}, name, path) AS rank FROM fx_files JOIN m USING (path))"""


def _clustered_combined(spark, sf):
    files = fx.hashed_prints(spark, sf)
    return files.join(shuffled(dedupe.clusters(files, "path")), "path")


@query(f"WITH RECURSIVE {COMBINED_SQL} SELECT cluster, path, split, rank FROM k")
def dedupe_keepers_combined(spark, sf):
    return dedupe.keepers(_clustered_combined(spark, sf)).select("cluster", "path", "split", "rank")


@query(f"WITH RECURSIVE {COMBINED_SQL} SELECT cluster, path FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY name, source, path) AS r2 FROM k) WHERE r2 = 1")
def merge_keepers_combined(spark, sf):
    return dedupe.kept_members(_clustered_combined(spark, sf), dedupe.merge_order()).select("cluster", "path")


@query(f"WITH RECURSIVE {COMBINED_SQL} SELECT split, count(*) AS before, count(*) FILTER (WHERE rank > 1) AS removed, count(*) FILTER (WHERE rank = 1) AS after FROM k GROUP BY split")
def dedupe_removals_combined(spark, sf):
    files = fx.hashed_prints(spark, sf)
    return dedupe.removal_summary(files, dedupe.removals(dedupe.lost_members(_clustered_combined(spark, sf))))


# Splits, backgrounds and samples --------------------------------------------------------------------------------------


def split_sql(source: str, key: str, train: str, val: str) -> str:
    """Window form of the greedy split over a relation (key, n)."""
    o = f"ORDER BY md5('42:' || {key}), {key}"
    return f"""SELECT {key}, n, CASE WHEN t THEN 'train' WHEN ex - (sum(CASE WHEN t THEN n ELSE 0 END) OVER ()) < total * {val} THEN 'val' ELSE 'test' END AS split FROM (
  SELECT *, ex < total * {train} AS t FROM (
    SELECT {key}, n, coalesce(sum(n) OVER ({o} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::double AS ex, (sum(n) OVER ())::double AS total FROM {source}))"""


GROUPS_SQL = f"{fx.IMAGES_SQL}, g AS (SELECT seq_id, count(*) AS n FROM fx_images GROUP BY seq_id), a AS ({split_sql('g', 'seq_id', '0.7::double', '0.2::double')})"


@query(f"WITH {GROUPS_SQL} SELECT seq_id, n, split FROM a")
def group_split(spark, sf):
    groups = fx.images(spark, sf).groupBy("seq_id").agg(F.count(F.lit(1)).alias("n"))
    return split.assign_groups(groups)


@query(f"WITH {GROUPS_SQL} SELECT split, sum(n)::bigint AS images, count(*) AS sequences FROM a GROUP BY split")
def split_summary(spark, sf):
    return split.split_summary(split.split_by_sequence(fx.images(spark, sf)))


@query(
    f"""WITH {fx.IMAGES_SQL}, {fx.NEGATIVES_SQL}, r AS (SELECT split, count(*)::double / (SELECT count(*) FROM fx_images) AS ratio FROM fx_images GROUP BY split),
c AS (SELECT file_name, 'bg_' || regexp_replace(stem, '_[^_]*$', '') AS group_id FROM (SELECT * FROM fx_negatives ORDER BY md5('42:' || file_name), file_name LIMIT (SELECT floor(count(*) * 0.2::double)::bigint FROM fx_images))),
g AS (SELECT group_id, count(*) AS n FROM c GROUP BY group_id),
a AS ({split_sql("g", "group_id", "(SELECT ratio FROM r WHERE split = 'train')", "(SELECT ratio FROM r WHERE split = 'val')")})
SELECT file_name, group_id, split, 'bg__' || file_name AS target_name FROM c JOIN a USING (group_id)"""
)
def background_injection(spark, sf):
    return split.inject_backgrounds(fx.images(spark, sf), fx.negatives(spark, sf))


@query(f"WITH {fx.IMAGES_SQL} SELECT image_id, file_name FROM fx_images ORDER BY md5('42:' || file_name), file_name LIMIT 30")
def seeded_sample(spark, sf):
    return sampling.seeded_sample(fx.images(spark, sf), 30, "file_name").select("image_id", "file_name")


@query(f"WITH {fx.NEGATIVES_SQL} SELECT file_name FROM fx_negatives ORDER BY md5('42:' || file_name), file_name LIMIT (SELECT floor(count(*) * 0.3::double)::bigint FROM fx_negatives)")
def negative_fraction(spark, sf):
    return sampling.seeded_fraction(fx.negatives(spark, sf), 0.3, "file_name").select("file_name")


@query(f"WITH {fx.IMAGES_SQL} SELECT image_id, file_name FROM fx_images WHERE ext = '.jpg' ORDER BY file_name LIMIT 50")
def latency_sample(spark, sf):
    return sampling.first_of_kinds(fx.images(spark, sf)).select("image_id", "file_name")


MANIFEST_SQL = f"{fx.IMAGES_SQL}, q AS (SELECT file_name, 'drive' || (image_id % 7) AS sequence_id FROM fx_images WHERE image_id % 3 = 0)"


@query(f"WITH {MANIFEST_SQL} SELECT i.image_id, coalesce('custom_' || q.sequence_id, 'custom_' || regexp_replace(i.stem, '_[^_]*$', '')) AS seq FROM fx_images i LEFT JOIN q USING (file_name)")
def manifest_sequence_lookup(spark, sf):
    from roadlens.sources.yolo import with_sequence

    images = fx.images(spark, sf)
    manifest = images.where("image_id % 3 = 0").select(F.col("file_name").alias("filename"), F.concat(F.lit("drive"), F.col("image_id") % 7).alias("sequence_id"))
    return with_sequence(images.drop("seq_id"), manifest, "custom").select("image_id", F.col("seq_id").alias("seq"))


@query(f"WITH {fx.IMAGES_SQL} SELECT image_id, seq_id || '__' || file_name AS target_name, regexp_replace(stem, '_[^_]*$', '') = seq_id AS same FROM fx_images")
def provenance_names(spark, sf):
    return fx.images(spark, sf).select("image_id", F.concat("seq_id", F.lit("__"), "file_name").alias("target_name"), (sequence_of(F.col("stem")) == F.col("seq_id")).alias("same"))


# Negatives ------------------------------------------------------------------------------------------------------------

_NAMES = "[" + ", ".join(f"'{n}'" for n in negatives.CLASS_NAMES) + "]"
_LIST = lambda names: "[" + ", ".join(f"'{n}'" for n in names) + "]"
CATEGORY_SQL = f"""{fx.CLASSES_SQL}, n AS (SELECT image_id, list_transform(class_ids, lambda i: {_NAMES}[i + 1]) AS names FROM fx_classes),
k AS (SELECT image_id, CASE WHEN list_has_any(names, {_LIST(negatives.EXCLUDED)}) THEN 'excluded' WHEN list_has_any(names, {_LIST(negatives.PRIORITY)}) THEN 'priority' ELSE 'generic' END AS category,
  coalesce(nullif(array_to_string(list_sort(names), '; '), ''), '(empty)') AS classes_present FROM n)"""


@query(f"WITH {CATEGORY_SQL} SELECT category, count(*) AS n, count(*) FILTER (WHERE classes_present = '(empty)') AS empties FROM k GROUP BY category")
def negative_categories(spark, sf):
    return negatives.classify_ids(fx.class_sets(spark, sf)).groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("classes_present") == "(empty)").alias("empties"))


@query(f"WITH {CATEGORY_SQL} SELECT 'attain_part' || image_id || '.jpg' AS filename, category, classes_present AS source_classes_present, 'WS_V1' AS source_subrepo FROM k WHERE category <> 'excluded'")
def negative_manifest(spark, sf):
    named = fx.class_sets(spark, sf).withColumn("file_name", F.concat(F.lit("part"), "image_id", F.lit(".jpg"))).withColumn("subrepo", F.lit("WS_V1"))
    return negatives.manifest(negatives.classify_ids(named))


VOC_SQL = f"""{fx.CLASSES_SQL}, o AS (SELECT image_id, unnest(class_ids) AS c FROM fx_classes)
SELECT image_id, 0 AS class_id, ((c * 10 + (c * 10 + 64))::double / 2) / 640::double AS xc, ((c * 5 + (c * 5 + 48))::double / 2) / 480::double AS yc, 64 / 640::double AS w, 48 / 480::double AS h FROM o WHERE c % 4 = 0"""


@query("WITH " + VOC_SQL)
def voc_to_yolo(spark, sf):
    """Annotation XML of the class sets, class D40 where the id is a multiple of 4, read back as relative boxes."""
    one = lambda i: F.concat(
        F.lit("<object><name>D"), F.when(i % 4 == 0, "40").otherwise("00"), F.lit("</name><bndbox><xmin>"), (i * 10).cast("string"), F.lit("</xmin><ymin>"), (i * 5).cast("string"),
        F.lit("</ymin><xmax>"), (i * 10 + 64).cast("string"), F.lit("</xmax><ymax>"), (i * 5 + 48).cast("string"), F.lit("</ymax></bndbox></object>"),
    )
    xml = F.concat(F.lit("<annotation><size><width>640</width><height>480</height></size>"), F.array_join(F.transform("class_ids", one), ""), F.lit("</annotation>"))
    return voc.boxes(fx.class_sets(spark, sf).select("image_id", xml.alias("xml")), "image_id", target="D40")


# Scoring --------------------------------------------------------------------------------------------------------------

BOX_SQL = f"""{fx.IMAGES_SQL}, b AS (SELECT *, least(640::double / height, 640::double / width) AS scale FROM fx_images),
lb AS (SELECT image_id, width, height, scale, round_even(width * scale, 0)::int AS new_w, round_even(height * scale, 0)::int AS new_h FROM b),
lp AS (SELECT *, ((640 - new_w) // 2)::int AS pad_left, ((640 - new_h) // 2)::int AS pad_top FROM lb)"""


@query(f"WITH {BOX_SQL} SELECT * FROM lp")
def letterbox_geometry(spark, sf):
    return detect.letterboxed(fx.images(spark, sf).select("image_id", "width", "height"))


@query(
    f"""WITH {BOX_SQL}, {fx.DETECTIONS_SQL} SELECT {fx.LK_SQL}, {", ".join(f"greatest(0::double, least(lp.{e}::double, (d.{k} - {p}) / scale)) AS {k}" for k, p, e in (("x1", "pad_left", "width"), ("y1", "pad_top", "height"), ("x2", "pad_left", "width"), ("y2", "pad_top", "height")))}
FROM fx_detections d JOIN lp USING (image_id)"""
)
def unletterbox_boxes(spark, sf):
    geometry = detect.letterboxed(fx.images(spark, sf).select("image_id", "width", "height"))
    return detect.to_image_pixels(fx.detections(spark, sf).drop("width", "height").join(geometry, "image_id")).select(*fx.LK, "x1", "y1", "x2", "y2")


@query(f"WITH {fx.DETECTIONS_SQL} SELECT {fx.LK_SQL}, confidence FROM fx_detections WHERE confidence >= 0.35::double")
def confidence_filter(spark, sf):
    return detect.confident(fx.detections(spark, sf)).select(*fx.LK, "confidence")


def iou_sql(a: str, b: str) -> str:
    w = f"greatest(0::double, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1))"
    h = f"greatest(0::double, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))"
    area = lambda s: f"({s}.x2 - {s}.x1) * ({s}.y2 - {s}.y1)"
    union = f"({area(a)} + {area(b)} - {w} * {h})"
    return f"(CASE WHEN {union} > 0 THEN {w} * {h} / {union} ELSE 0::double END)"


_BOX = "{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'rn': rn}"


NMS_KEPT_SQL = f"""{fx.NMS_SQL}, q AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY confidence DESC, x1, y1, x2, y2, {fx.LK_SQL}) AS rn FROM fx_nms WHERE confidence > 0.35::double),
b AS (SELECT image_id, rn, {_BOX} AS box FROM q),
st AS (SELECT image_id, rn, [box] AS kept FROM b WHERE rn = 1
  UNION ALL SELECT b.image_id, b.rn, CASE WHEN len(list_filter(st.kept, lambda k: {iou_sql("k", "b.box")} > 0.45::double)) > 0 THEN st.kept ELSE list_append(st.kept, b.box) END
  FROM st JOIN b ON b.image_id = st.image_id AND b.rn = st.rn + 1),
fin AS (SELECT image_id, unnest(list_transform(kept, lambda k: k.rn)) AS rn FROM st QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY st.rn DESC) = 1),
kept AS (SELECT q.* FROM fin JOIN q USING (image_id, rn))"""


@query(f"WITH RECURSIVE {NMS_KEPT_SQL} SELECT image_id, {fx.LK_SQL}, confidence FROM kept")
def nms_kept(spark, sf):
    return detect.suppress(fx.detections(spark, sf, nms=True), detect.IOU, ties=fx.LK).select("image_id", *fx.LK, "confidence")


ANSWER_SQL = f"""{fx.IMAGES_SQL}, {NMS_KEPT_SQL},
ka AS (SELECT *, count(*) OVER (PARTITION BY image_id) AS n_in_frame, {_AREA} AS area_frac, {_VPOS} AS vpos FROM kept),
ks AS (SELECT *, least(1::double, area_frac * 10 + 0.08::double * (n_in_frame - 1) + 0.15::double * vpos) AS severity_score FROM ka),
kl AS (SELECT *, CASE WHEN area_frac < 0.01::double AND severity_score < 0.3::double THEN 'minor' WHEN area_frac < 0.04::double AND severity_score < 0.6::double THEN 'moderate' ELSE 'severe' END AS severity FROM ks),
kg AS (SELECT image_id, count(*) AS n, string_agg(severity, ',' ORDER BY confidence DESC, x1, y1, x2, y2, {fx.LK_SQL}) AS severities, round(sum(round(x1, 1) + round(y2, 1)), 1) AS corners FROM kl GROUP BY image_id)"""


@query(f"WITH RECURSIVE {ANSWER_SQL} SELECT i.image_id, true AS success, coalesce(n, 0)::int AS n_detections, coalesce(severities, '') AS severities, coalesce(corners, 0) AS corners, 'stub' AS model_version FROM fx_images i LEFT JOIN kg USING (image_id)")
def scoring_response_fields(spark, sf):
    """The fields of every frame's answer that hold no formatted text, read back from its JSON."""
    found = "success boolean, detections array<struct<confidence:double,bbox:struct<x1:double,y1:double,x2:double,y2:double>,severity:struct<label:string,score:double>>>, model_version string"
    read = scoring_responses(spark, sf).select("image_id", F.from_json("response", found).alias("r"))
    corners = F.aggregate("r.detections", F.lit(0.0), lambda s, d: s + d["bbox"]["x1"] + d["bbox"]["y2"])
    return read.select(
        "image_id", "r.success", F.size("r.detections").alias("n_detections"), F.array_join(F.transform("r.detections", lambda d: d["severity"]["label"]), ",").alias("severities"),
        F.round(corners, 1).alias("corners"), "r.model_version",
    )


def backend_two(spark, sf) -> DataFrame:
    d, shift = fx.detections(spark, sf), F.lit(0.25) * (F.col("l_linenumber") % 5)
    return d.withColumns({c: F.col(c) + shift for c in ("x1", "y1", "x2", "y2")}).withColumn("confidence", F.col("confidence") + F.lit(0.001) * (F.col("l_linenumber") % 3))


_RANK = f"row_number() OVER (PARTITION BY image_id ORDER BY confidence DESC, x1, y1, x2, y2, {fx.LK_SQL}) AS rank, count(*) OVER (PARTITION BY image_id) AS n"
_SHIFT = "0.25::double * (l_linenumber % 5)"


@query(
    f"""WITH {fx.DETECTIONS_SQL}, two AS (SELECT * REPLACE (x1 + {_SHIFT} AS x1, y1 + {_SHIFT} AS y1, x2 + {_SHIFT} AS x2, y2 + {_SHIFT} AS y2, confidence + 0.001::double * (l_linenumber % 3) AS confidence) FROM fx_detections),
a AS (SELECT *, {_RANK} FROM fx_detections), b AS (SELECT *, {_RANK} FROM two),
j AS (SELECT image_id, a.n AS n_a, b.n AS n_b, abs(a.confidence - b.confidence) AS cd, greatest(abs(a.x1 - b.x1), abs(a.y1 - b.y1), abs(a.x2 - b.x2), abs(a.y2 - b.y2)) AS bd,
  greatest(1::double, least(a.x2 - a.x1, a.y2 - a.y1)) AS side FROM a FULL JOIN b USING (image_id, rank))
SELECT image_id, coalesce(max(n_a), 0) AS n_a, coalesce(max(n_b), 0) AS n_b, coalesce(max(CASE WHEN n_a = n_b THEN cd END), 0) AS conf_diff, coalesce(max(CASE WHEN n_a = n_b THEN bd END), 0) AS box_diff,
  coalesce(max(CASE WHEN n_a = n_b THEN bd / side END), 0) AS rel_diff,
  coalesce(max(n_a), 0) = coalesce(max(n_b), 0) AND coalesce(max(CASE WHEN n_a = n_b THEN bd / side END), 0) <= 0.03::double AND coalesce(max(CASE WHEN n_a = n_b THEN cd END), 0) <= 0.05::double AS ok
FROM j GROUP BY image_id"""
)
def backend_parity(spark, sf):
    return evaluate.parity(fx.detections(spark, sf), backend_two(spark, sf), fx.LK)


@query(
    f"""WITH {fx.IMAGES_SQL}, {fx.LABELS_SQL}, {fx.DETECTIONS_SQL}, g AS (SELECT i.image_id, {_BOXES} AS n_gt FROM fx_labels l JOIN fx_images i USING (split, stem)),
p AS (SELECT image_id, count(*) AS n_pred FROM fx_detections WHERE confidence >= 0.35::double GROUP BY image_id)
SELECT i.image_id, coalesce(n_gt, 0) AS n_gt, coalesce(n_pred, 0) AS n_pred, CASE WHEN coalesce(n_pred, 0) < coalesce(n_gt, 0) THEN '_LIKELY_FN' WHEN coalesce(n_pred, 0) > coalesce(n_gt, 0) THEN '_LIKELY_FP' ELSE '' END AS tag
FROM fx_images i LEFT JOIN g USING (image_id) LEFT JOIN p USING (image_id)"""
)
def gt_pred_tags(spark, sf):
    from roadlens.functions.text import stripped_lines

    images = fx.images(spark, sf)
    truth = fx.labels(spark, sf).join(images.select("split", "stem", "image_id"), ["split", "stem"]).select("image_id", F.explode(stripped_lines(F.col("body"))).alias("line"))
    return evaluate.count_tags(images, truth, detect.confident(fx.detections(spark, sf)))


_TAGS = f"""{fx.IMAGES_SQL}, {fx.LABELS_SQL}, {fx.DETECTIONS_SQL}, g AS (SELECT i.image_id, {_BOXES} AS n_gt FROM fx_labels l JOIN fx_images i USING (split, stem)),
p AS (SELECT image_id, count(*) AS n_pred FROM fx_detections WHERE confidence >= 0.35::double GROUP BY image_id),
k AS (SELECT i.*, CASE WHEN coalesce(n_pred, 0) < coalesce(n_gt, 0) THEN '_LIKELY_FN' WHEN coalesce(n_pred, 0) > coalesce(n_gt, 0) THEN '_LIKELY_FP' ELSE '' END AS tag FROM fx_images i LEFT JOIN g USING (image_id) LEFT JOIN p USING (image_id))"""


@query(f"WITH {_TAGS} SELECT tag, count(*) AS images FROM k GROUP BY tag")
def tag_summary(spark, sf):
    return evaluate.tag_summary(gt_pred_tags(spark, sf))


@query(f"WITH {_TAGS} SELECT tag, file_name, stem || tag || '.jpg' AS drawn_name FROM k WHERE tag <> ''")
def flagged_images(spark, sf):
    """Images with fewer or more predictions than truth: the lists to look through."""
    return evaluate.flagged(gt_pred_tags(spark, sf), fx.images(spark, sf))


_NUMBER = r"^[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)$"
DRAW_SQL = rf"""{fx.IMAGES_SQL}, {fx.LABELS_SQL}, {fx.DETECTIONS_SQL},
ch AS (SELECT image_id, file_name FROM fx_images ORDER BY md5('42:' || file_name), file_name LIMIT 25),
ln AS (SELECT image_id, width, height, regexp_split_to_array(trim(unnest(string_split({_STRIPPED}, chr(10)))), '\s+') AS tok FROM fx_labels JOIN fx_images USING (split, stem)),
bx AS (SELECT image_id, width, height, try_cast(tok[2] AS double) AS xc, try_cast(tok[3] AS double) AS yc, try_cast(tok[4] AS double) AS w, try_cast(tok[5] AS double) AS h FROM ln
  WHERE len(tok) = 5 AND regexp_matches(lower(tok[2]), '{_NUMBER}') AND regexp_matches(lower(tok[3]), '{_NUMBER}') AND regexp_matches(lower(tok[4]), '{_NUMBER}') AND regexp_matches(lower(tok[5]), '{_NUMBER}')),
px AS (SELECT image_id, (xc - w / 2) * width AS x1, (yc - h / 2) * height AS y1, (xc + w / 2) * width AS x2, (yc + h / 2) * height AS y2 FROM bx),
tr AS (SELECT image_id, 'truth' AS kind, trunc(x1)::int AS x1, trunc(y1)::int AS y1, trunc(x2)::int AS x2, trunc(y2)::int AS y2, '' AS caption FROM px WHERE isfinite(x1 + y1 + x2 + y2)),
pd AS (SELECT image_id, 'predicted' AS kind, trunc(x1)::int AS x1, trunc(y1)::int AS y1, trunc(x2)::int AS x2, trunc(y2)::int AS y2, format('{{:.2f}}', confidence) AS caption FROM fx_detections WHERE confidence >= 0.35::double)"""


@query(f"WITH {DRAW_SQL} SELECT tr.*, file_name FROM tr JOIN ch USING (image_id)")
def overlay_boxes(spark, sf):
    """Truth boxes to draw on a seeded sample of images."""
    images = fx.images(spark, sf)
    return evaluate.draw_list(images, evaluate.truth_boxes(images, fx.labels(spark, sf)))


@query(f"WITH {DRAW_SQL} SELECT b.*, file_name FROM (SELECT * FROM tr UNION ALL SELECT * FROM pd) b JOIN ch USING (image_id)")
def comparison_boxes(spark, sf):
    """Truth and predicted boxes to draw side by side."""
    images = fx.images(spark, sf)
    return evaluate.draw_list(images, evaluate.truth_boxes(images, fx.labels(spark, sf)), evaluate.predicted_boxes(detect.confident(fx.detections(spark, sf))))


def _matched(spark, sf, thresholds, by=evaluate.match):
    det = fx.detections(spark, sf)
    truth = det.where("l_linenumber % 2 = 0").withColumn("gt_id", F.struct(*fx.LK))
    return by(truth, backend_two(spark, sf), thresholds, fx.LK), truth.count()


def match_sql(thresholds: str) -> str:
    """Greedy matching at each of the thresholds, a list in SQL."""
    return f"""{fx.DETECTIONS_SQL}, g0 AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY {fx.LK_SQL}) AS rn FROM fx_detections WHERE l_linenumber % 2 = 0),
g AS (SELECT image_id, list({_BOX} ORDER BY rn) AS gs FROM g0 GROUP BY image_id),
two AS (SELECT * REPLACE (x1 + {_SHIFT} AS x1, y1 + {_SHIFT} AS y1, x2 + {_SHIFT} AS x2, y2 + {_SHIFT} AS y2, confidence + 0.001::double * (l_linenumber % 3) AS confidence) FROM fx_detections),
b AS (SELECT image_id, confidence, {fx.LK_SQL}, {_BOX} AS box, rn FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY confidence DESC, x1, y1, x2, y2, {fx.LK_SQL}) AS rn FROM two)),
th AS (SELECT unnest({thresholds}) AS threshold),
st AS (SELECT threshold, image_id, 0::bigint AS rn, []::bigint[] AS used, 0::bigint AS hit FROM b, th WHERE rn = 1
  UNION ALL SELECT threshold, image_id, rn, CASE WHEN best.o >= threshold THEN list_append(used, best.i) ELSE used END, (best.o >= threshold)::bigint FROM (
    SELECT st.threshold, b.image_id, b.rn, st.used, list_sort(list_transform(coalesce(g.gs, []), lambda k: {{'o': CASE WHEN list_contains(st.used, k.rn) THEN -1::double ELSE {iou_sql("b.box", "k")} END, 'ni': -k.rn, 'i': k.rn}}), 'DESC')[1] AS best
    FROM st JOIN b ON b.image_id = st.image_id AND b.rn = st.rn + 1 LEFT JOIN g ON g.image_id = b.image_id)),
tp AS (SELECT threshold, b.*, coalesce(st.hit, 0) AS tp FROM st JOIN b USING (image_id, rn) WHERE st.rn > 0)"""


MATCH_SQL = match_sql("[0.5::double]")
GRID_SQL = match_sql("list_transform(range(10), lambda i: 0.5::double + 0.05::double * i)")
AP_SQL = """s AS (SELECT threshold, confidence, count(*) AS n, sum(tp)::bigint AS t FROM tp GROUP BY threshold, confidence),
c AS (SELECT threshold, sum(t) OVER w::double / sum(n) OVER w AS precision, floor(sum(t) OVER w * 100 / (SELECT count(*) FROM g0)::double)::int AS reach FROM s WINDOW w AS (PARTITION BY threshold ORDER BY confidence DESC)),
r AS (SELECT threshold, i, coalesce((SELECT max(precision) FROM c WHERE c.threshold = th.threshold AND reach >= i), 0) AS p FROM th, range(101) t(i))"""


@query(f"WITH RECURSIVE {MATCH_SQL} SELECT 0.5::double AS threshold, count(*) AS predictions, sum(tp)::bigint AS tp, sum(tp)::double / count(*) AS precision, sum(tp)::double / (SELECT count(*) FROM g0) AS recall FROM tp")
def precision_recall(spark, sf):
    matched, n = _matched(spark, sf, [0.5])
    return evaluate.precision_recall(matched, n)


@query(f"WITH RECURSIVE {MATCH_SQL}, {AP_SQL} SELECT threshold, round(sum(p) / 101, 6) AS ap FROM r GROUP BY threshold")
def average_precision(spark, sf):
    matched, n = _matched(spark, sf, [0.5], evaluate.match_steps)
    return evaluate.average_precision(matched, n).select("threshold", F.round("ap", 6).alias("ap"))


@query(f"WITH RECURSIVE {GRID_SQL}, {AP_SQL} SELECT threshold, round(sum(p) / 101, 6) AS ap FROM r GROUP BY threshold")
def mean_average_precision(spark, sf):
    """AP at ten overlaps from 0.50 to 0.95; their mean is the averaged metric."""
    matched, n = _matched(spark, sf, evaluate.IOU_GRID, evaluate.match_steps)
    return evaluate.average_precision(matched, n).select("threshold", F.round("ap", 6).alias("ap"))


@query(
    f"""WITH RECURSIVE {GRID_SQL}, {AP_SQL}, {fx.REQUESTS_SQL},
aps AS (SELECT threshold, sum(p) / 101 AS ap FROM r GROUP BY threshold),
pr AS (SELECT sum(tp)::double / count(*) AS precision, sum(tp)::double / (SELECT count(*) FROM g0) AS recall FROM tp WHERE threshold = 0.5::double AND confidence >= 0.35::double),
la AS (SELECT count(*) AS latency_sample, round(avg(elapsed_ms), 6) AS avg_ms, round(1000 / avg(elapsed_ms), 6) AS fps FROM fx_requests)
SELECT 0.35::double AS confidence_threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, (SELECT round(max(ap) FILTER (WHERE threshold = 0.5::double), 6) FROM aps) AS map50,
  (SELECT round(avg(ap), 6) FROM aps) AS map50_95, latency_sample, avg_ms, fps FROM pr, la"""
)
def evaluation_report(spark, sf):
    matched, n = _matched(spark, sf, evaluate.IOU_GRID, evaluate.match_steps)
    row = evaluate.report(matched, n, fx.requests(spark, sf))
    return row.select("confidence_threshold", "latency_sample", *[F.round(x, 6).alias(x) for x in ("precision", "recall", "map50", "map50_95", "avg_ms", "fps")])


@query(f"WITH {fx.REQUESTS_SQL} SELECT count(*) AS n, round(avg(elapsed_ms), 6) AS avg_ms, round(1000 / avg(elapsed_ms), 6) AS fps FROM fx_requests")
def latency_summary(spark, sf):
    return evaluate.latency(fx.requests(spark, sf)).select("n", F.round("avg_ms", 6).alias("avg_ms"), F.round("fps", 6).alias("fps"))


@query(
    f"""WITH {fx.REQUESTS_SQL}, s AS (SELECT *, CASE WHEN NOT model_loaded THEN 503 WHEN content_type NOT IN ('image/jpeg', 'image/png') THEN 415 WHEN size_mb > 10 THEN 413 WHEN NOT decodable THEN 400 ELSE 200 END AS status_code FROM fx_requests)
SELECT event_id, status_code, status_code = 200 AND elapsed_ms > 30000 AS slow FROM s"""
)
def upload_gates(spark, sf):
    return detect.gates(fx.requests(spark, sf)).select("event_id", "status_code", "slow")


def _hash_int(v: str, lo: int, hi: int, name: str) -> str:
    return f"{lo} + (('0x' || substr(md5('42:{name}:' || file_name || ':' || {v}), 1, 8))::bigint % {hi - lo + 1})"


@query(
    f"""WITH {fx.IMAGES_SQL} SELECT file_name, v::int AS variant, 'aug' || v || '_' || file_name AS target_name, ({_hash_int("v", 25, 55, "brightness")})::int AS brightness, ({_hash_int("v", 3, 10, "warmth")})::int AS warmth
FROM fx_images, range(3) t(v)"""
)
def augmentation_plan(spark, sf):
    return augment.plan(fx.images(spark, sf).select("file_name"))


# Headers, layouts -----------------------------------------------------------------------------------------------------


@query(
    f"""WITH {fx.IMAGES_SQL}, {fx.PICTURES_SQL} SELECT image_id, CASE WHEN ext = '.png' THEN 'png' ELSE 'jpeg' END AS format, CASE WHEN readable THEN width ELSE -1 END::int AS width,
CASE WHEN readable THEN height ELSE -1 END::int AS height, orientation::int AS orientation, readable, CASE WHEN NOT readable THEN -1 WHEN orientation >= 5 THEN height ELSE width END::int AS shown_width,
CASE WHEN NOT readable THEN -1 WHEN orientation >= 5 THEN width ELSE height END::int AS shown_height FROM fx_pictures"""
)
def image_headers(spark, sf):
    """Size and EXIF orientation of every image by its header alone."""
    return headers.shown_size(headers.probe_contents(fx.picture_files(spark, sf), "image_id")).drop("bytes_read")


@query(f"WITH {fx.IMAGES_SQL}, {fx.PICTURES_SQL} SELECT split, file_name AS file FROM fx_pictures WHERE NOT readable")
def unreadable_images(spark, sf):
    files = fx.picture_files(spark, sf)
    return validate.unreadable_images(files.select("image_id", "split", "file_name").join(headers.probe_contents(files, "image_id"), "image_id")).select("split", "file")


LAYOUT_SQL = f"""{fx.IMAGES_SQL}, {fx.LABELS_SQL}, i AS (SELECT split, seq_id || '__' || file_name AS target_name, seq_id || '__' || stem AS t, octet_length(body::blob) AS n FROM fx_images JOIN fx_labels USING (split, stem)),
w AS (SELECT 'images/' || split || '/' || target_name AS target, NULL::bigint AS bytes FROM i UNION ALL SELECT 'labels/' || split || '/' || t || '.txt', n + (n > 0)::int FROM i)"""


@query(f"WITH {LAYOUT_SQL} SELECT target, bytes FROM w")
def layout_plan(spark, sf):
    """The files that writing the labelled images as a layout would give, with the bytes of the label texts."""
    own = fx.images(spark, sf).join(fx.labels(spark, sf), ["split", "stem"])
    text = F.col("body")
    items = own.select("split", F.concat("seq_id", F.lit("__"), "file_name").alias("target_name"), F.lit(b"").alias("content"), F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n")).alias("lines"))
    files = file_tree.layout_files(items)
    return files.select("target", F.when(F.col("target").startswith("labels/"), F.octet_length("content").cast("long")).alias("bytes"))


# Chains, and clusters and pairs by batches ---------------------------------------------------------------------------

#: A pair is a link of the forest where no path of smaller pairs (by distance, then ids) joins its ends.
FOREST_SQL = (
    CLUSTERS_SQL
    + """, o AS (SELECT *, row_number() OVER (ORDER BY distance, id_a, id_b) AS nth FROM p),
way(nth, id) AS (SELECT nth, id_a FROM o UNION SELECT way.nth, CASE WHEN o.id_a = way.id THEN o.id_b ELSE o.id_a END FROM way JOIN o ON o.nth < way.nth AND (o.id_a = way.id OR o.id_b = way.id)),
link AS (SELECT cluster, id_a, id_b, distance FROM o JOIN m ON m.id = id_a WHERE (nth, id_b) NOT IN (SELECT (nth, id) FROM way))"""
)


@query(f"WITH RECURSIVE {FOREST_SQL} SELECT cluster, id_a, id_b, distance FROM link")
def chain_links(spark, sf):
    """The links that hold every cluster of near duplicates together: the minimum spanning forest of the pairs."""
    prints = fx.fingerprinted(spark, sf)
    return chains.cluster_links(chains.spanning_forest(similarity.near_pairs(prints)), dedupe.clusters(prints))


CUT = 5


@query(
    f"""WITH RECURSIVE {FOREST_SQL}, c AS (SELECT id_a AS x, id_b AS y FROM link WHERE distance <= {CUT} UNION ALL SELECT id_b, id_a FROM link WHERE distance <= {CUT}),
held(id, r) AS (SELECT id, id FROM fx_fp UNION SELECT held.id, c.y FROM held JOIN c ON c.x = held.r),
q AS (SELECT cluster, piece, count(*) AS n FROM (SELECT id, min(r) AS piece FROM held GROUP BY id) JOIN m USING (id) GROUP BY ALL),
z AS (SELECT cluster, sum(n)::bigint AS size, count(*) AS pieces, max(n) AS largest_piece FROM q GROUP BY cluster),
t AS (SELECT cluster, count(*) AS links, max(distance) AS weakest, count(*) FILTER (WHERE distance > {CUT}) AS weak_links FROM link GROUP BY cluster)
SELECT cluster, size, links, weakest, weak_links, pieces, largest_piece FROM z JOIN t USING (cluster)"""
)
def chain_inspection(spark, sf):
    prints = fx.fingerprinted(spark, sf)
    return chains.inspect_chains(chains.spanning_forest(similarity.near_pairs(prints)), dedupe.clusters(prints), CUT)


@query(f"WITH RECURSIVE {CLUSTERS_SQL} SELECT id, cluster FROM m")
def incremental_clusters(spark, sf):
    """The clusters again, from a forest that meets the pairs in three batches."""
    prints = fx.fingerprinted(spark, sf)
    edges = materialize(similarity.near_edges(prints).withColumn("batch", F.pmod(F.xxhash64("id_a", "id_b"), F.lit(3))))
    kept = forest.forest_of(prints, "id")
    for k in range(3):
        kept = forest.merged(kept, edges.where(F.col("batch") == k), "id_a", "id_b")
    return kept.labels().select(F.col("node").alias("id"), F.col("component").alias("cluster"))


@query(f"WITH {PAIRS_SQL} SELECT id_a, id_b, distance FROM p")
def incremental_pairs(spark, sf):
    """All near pairs again, found as two halves of the documents are put into a bucketed index one after the other."""
    prints = fx.fingerprinted(spark, sf).select("id", "fp")
    name = f"near_{uuid.uuid4().hex}"
    index = near_index.NearIndex(spark, name, f"{scratch_dir(spark)}/roadlens/{spark.sparkContext.applicationId}/{name}", buckets=16).create()
    halves = [prints.where(F.pmod(F.xxhash64("id"), F.lit(2)) == k) for k in range(2)]  # together the whole table
    first, second = (index.ingest(h) for h in halves)
    spark.sql(f"DROP TABLE {name}")
    return first.unionByName(second)


# Collectors, label lines, tensors ------------------------------------------------------------------------------------

LINES_SQL = rf"""{fx.IMAGES_SQL}, {fx.LABELS_SQL}, s AS (SELECT split, stem, {_STRIPPED} AS b FROM fx_labels),
l AS (SELECT split, stem, unnest(string_split(b, chr(10))) AS line, generate_subscripts(string_split(b, chr(10)), 1)::int AS line_no FROM s WHERE b <> ''),
t AS (SELECT *, regexp_split_to_array(regexp_replace(line, '^\s+|\s+$', '', 'g'), '\s+') AS tok FROM l)"""


@query(f"WITH {LINES_SQL} SELECT split, stem, line_no, '0 ' || array_to_string(tok[2:5], ' ') AS line FROM t WHERE len(tok) = 5")
def merged_label_lines(spark, sf):
    """Label lines as sources are merged: five tokens, class 0 forced, others dropped."""
    return yolo.boxes(fx.labels(spark, sf)).select("split", "stem", "line_no", F.array_join("tokens", " ").alias("line"))


@query(f"WITH {fx.TENSORS_SQL} SELECT image_id, anchor_id, score AS confidence, cx - w / 2 AS x1, cy - h / 2 AS y1, cx + w / 2 AS x2, cy + h / 2 AS y2 FROM fx_anchors WHERE score >= 0.35::double")
def decoded_tensors(spark, sf):
    return detect.decode_tensor(fx.tensors(spark, sf)).select("image_id", "anchor_id", "confidence", "x1", "y1", "x2", "y2")


@query(
    f"""WITH {fx.CLASSES_SQL}, {fx.ANNOTATIONS_SQL} SELECT image_id, array_to_string(list_sort(list_distinct(list_transform(class_ids, lambda i: 'D' || CASE WHEN i % 4 = 0 THEN '40' ELSE i::varchar END))), ';') AS names
FROM fx_annotated WHERE image_id % 19 <> 0"""
)
def voc_class_names(spark, sf):
    """The distinct stripped class names of every annotation that can be parsed."""
    return voc.class_names(fx.annotations(spark, sf), "image_id").select("image_id", F.array_join("class_names", ";").alias("names"))


_LINE_SQL = "list_sort(list_transform(list_filter(class_ids, lambda i: i % 4 = 0), lambda i: printf('0 %.6f %.6f %.6f %.6f', ((i * 10 + (i * 10 + 64))::double / 2) / 640, ((i * 5 + (i * 5 + 48))::double / 2) / 480, 64 / 640::double, 48 / 480::double)))"


@query(
    f"""WITH {fx.CLASSES_SQL}, {fx.ANNOTATIONS_SQL}, k AS (SELECT file_name, stem, {_LINE_SQL} AS lines FROM fx_annotated WHERE image_id % 19 <> 0),
e AS (SELECT * FROM k WHERE len(lines) = 0 ORDER BY md5('42:' || file_name), file_name LIMIT (SELECT floor(count(*) * 0.3::double)::bigint FROM k WHERE len(lines) = 0))
SELECT 'rdd' AS source, file_name, 'rdd_' || regexp_replace(stem, '_[^_]*$', '') AS seq_id, array_to_string(lines, chr(10)) AS lines FROM (SELECT * FROM k WHERE len(lines) > 0 UNION ALL SELECT * FROM e)"""
)
def annotated_items(spark, sf):
    """Items of an annotated source: all with a target box, three tenths of the others in seeded order."""
    xmls = fx.annotations(spark, sf).where("image_id % 19 <> 0").select("stem", F.regexp_replace("xml", "<name> D", "<name>D").alias("xml"))
    shown = fx.annotations(spark, sf).select("stem", "file_name", F.col("file_name").alias("path"))
    return layouts.annotated_set(shown, xmls, "rdd", 0.3).select("source", "file_name", "seq_id", F.array_join("lines", "\n").alias("lines"))


SOURCE_SQL = f"""{LINES_SQL}, b AS (SELECT stem, min(b) AS body, count(*) AS n FROM fx_labels JOIN s USING (split, stem) GROUP BY stem)"""


@query(f"WITH {SOURCE_SQL} SELECT (SELECT count(*) FROM fx_images ANTI JOIN fx_labels USING (stem)) AS missing_labels, (SELECT sum(n - 1)::bigint FROM b) AS duplicate_labels")
def source_counts(spark, sf):
    """What the collector of a labelled source drops: images without a label, further labels of a stem."""
    return layouts.labelled_set(fx.images(spark, sf).withColumn("path", F.col("file_name")), fx.labels(spark, sf), "own")[1]


@query(
    f"""WITH {LINES_SQL}, g AS (SELECT stem, string_agg('0 ' || array_to_string(tok[2:5], ' '), chr(10) ORDER BY line_no) AS lines FROM t WHERE len(tok) = 5 GROUP BY stem)
SELECT i.file_name, 'own_' || regexp_replace(i.stem, '_[^_]*$', '') AS seq_id, coalesce(g.lines, '') AS lines FROM fx_images i JOIN (SELECT DISTINCT stem FROM fx_labels) USING (stem) LEFT JOIN g USING (stem)"""
)
def source_items(spark, sf):
    """Items of a labelled source with the lines that survive."""
    items, _ = layouts.labelled_set(fx.images(spark, sf).withColumn("path", F.col("file_name")), fx.labels(spark, sf), "own")
    return items.select("file_name", "seq_id", F.array_join("lines", "\n").alias("lines"))


@query(
    f"""WITH {KEEP_SQL}, bad AS (SELECT split, path FROM fx_files WHERE doc_id % 13 = 0)
SELECT split, path, 'corrupted' AS reason FROM bad UNION ALL SELECT split, path, 'duplicate' FROM k WHERE rank > 1 AND path NOT IN (SELECT path FROM bad)"""
)
def removed_files(spark, sf):
    """Losers of clusters and corrupted files together, each once."""
    bad = fx.hashed_files(spark, sf).where("doc_id % 13 = 0")
    return dedupe.removals(dedupe.lost_members(_clustered(spark, sf)), bad)


@query(
    f"""WITH {CATEGORY_SQL}, {fx.NEGATIVES_SQL} SELECT file_name, 'OS_V1' AS subrepo, 'generic' AS category FROM fx_negatives
UNION ALL SELECT 'part' || image_id || '.jpg', 'WS_V1', category FROM k WHERE category <> 'excluded'"""
)
def mined_layouts(spark, sf):
    """Negatives of an unlabelled and of a labelled layout in one list."""
    body = F.array_join(F.transform("class_ids", lambda i: F.concat(i.cast("string"), F.lit(" 0.5 0.5 0.1 0.1 0.2 0.2"))), "\n")
    labelled = fx.class_sets(spark, sf).select(F.concat(F.lit("part"), "image_id", F.lit(".jpg")).alias("file_name"), body.alias("body"))
    return layouts.mined_negatives(os_v1=fx.negatives(spark, sf), ws_v1=labelled).where("category <> 'excluded'").select("file_name", "subrepo", "category")
