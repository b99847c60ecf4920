"""Annotation checks: every violated rule is a row (level, rule, split, file, line_no, message)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions.text import is_float, is_integer, stripped_lines, to_float, tokens
from roadlens.operators.similarity import near_pairs, near_prints
from roadlens.session import materialize, shuffled

FINDING = ["level", "rule", "split", "file", "line_no", "message"]
SPLITS = ("train", "val", "test")
EPSILON = 1e-6
#: Paths that one finding of equal content names; more copies give further findings.
NAMED_PATHS = 1000
#: The messages of the rules.
MISSING_PART = "missing images/ or labels/ directory"
UNREADABLE = "corrupted/unreadable image"
NO_LABEL = "missing label for image"
EMPTY = "empty annotation file (background image?)"
NOT_FIVE = "expected 5 tokens, got "
NOT_NUMERIC = "non-numeric value"
SMALL = "very small bbox"
BEYOND = "bbox extends outside image"
ORPHAN = "orphan label with no matching image"
DUPLICATE = "exact duplicate images (md5 "
LEAKAGE = "possible cross-split leakage: "


def _finding(level: str, rule: str, message: Column | str) -> Column:
    return F.struct(F.lit(level).alias("level"), F.lit(rule).alias("rule"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def missing_split_parts(splits: list[str], found: DataFrame) -> DataFrame:
    """V1: splits without images or labels; ``found`` has (split, part), part being images or labels."""
    spark = found.sparkSession
    wanted = spark.createDataFrame([(s, p) for s in splits for p in ("images", "labels")], "split string, part string")
    gone = wanted.join(found.select("split", "part").distinct(), ["split", "part"], "left_anti").select("split").distinct()
    return _pairless(gone, F.lit(None).cast("string"), "E", "V1", MISSING_PART)


def _with_numbers(units: DataFrame) -> DataFrame:
    """Adds the tokens and numbers of lines, step by step: what several rules read is worked out once."""
    out = units.withColumn("tok", F.when(F.col("kind") == "line", tokens(F.col("line")))).withColumn("five", F.size("tok") == 5)
    # get() gives null beyond the end: lines of fewer tokens are caught by V5 before their numbers matter.
    out = out.withColumn("numeric", F.col("five") & is_integer(F.get("tok", F.lit(0))) & F.forall(F.slice("tok", 2, 4), is_float))
    value = lambda i: F.when(F.col("numeric"), to_float(F.get("tok", F.lit(i))))
    return out.select("*", F.when(F.col("numeric"), F.get("tok", F.lit(0)).try_cast("bigint")).alias("cls"), *[value(i + 1).alias(n) for i, n in enumerate(("xc", "yc", "bw", "bh"))])


def _line_rules(min_box_frac: float) -> list[Column]:
    """V5 to V10 of a line with its numbers; null where a rule holds.

    A line that has not five tokens (V5) or holds a non-number (V6) is not checked
    further; the other rules are independent. NaN lies outside [0, 1] and violates no
    other rule.
    """
    tok, five, numeric, cls, xc, yc, bw, bh = (F.col(n) for n in ("tok", "five", "numeric", "cls", "xc", "yc", "bw", "bh"))
    within = lambda x: (x >= 0.0) & (x <= 1.0) & ~F.isnan(x)
    less = lambda x, y: (x < y) & ~F.isnan(x)
    more = lambda x, y: (x > y) & ~F.isnan(x)
    beyond = less(xc - bw / 2, -EPSILON) | less(yc - bh / 2, -EPSILON) | more(xc + bw / 2, 1 + EPSILON) | more(yc + bh / 2, 1 + EPSILON)
    return [
        F.when(~five, _finding("E", "V5", F.concat(F.lit(NOT_FIVE), F.size(tok)))),
        F.when(five & ~numeric, _finding("E", "V6", NOT_NUMERIC)),
        F.when(numeric & ((cls != 0) | cls.isNull()), _finding("E", "V7", F.concat(F.lit("invalid class_id "), F.get(tok, F.lit(0)), F.lit(" (expected 0)")))),
        *(F.when(numeric & ~within(x), _finding("E", "V8", f"{name} outside [0,1]")) for x, name in ((xc, "x_center"), (yc, "y_center"), (bw, "width"), (bh, "height"))),
        F.when(numeric & less(bw * bh, F.lit(float(min_box_frac))), _finding("W", "V9", SMALL)),
        F.when(numeric & beyond, _finding("E", "V10", BEYOND)),
    ]


def _units(kind: str, files: Column) -> Column:
    """An array of what is to be looked at: (kind, line_no, file, line)."""
    return F.transform(files, lambda f: F.struct(F.lit(kind).alias("kind"), F.lit(None).cast("int").alias("line_no"), f.alias("file"), F.lit("").alias("line")))


def _looked_at(lines: Column, file: Column) -> Column:
    """The lines of a label, or the label itself where it has none."""
    each = F.transform(lines, lambda x, i: F.struct(F.lit("line").alias("kind"), (i + 1).cast("int").alias("line_no"), file.alias("file"), x.alias("line")))
    return F.when(F.size(lines) == 0, _units("empty", F.array(file))).otherwise(each)


def _told(units: DataFrame, min_box_frac: float) -> DataFrame:
    """Findings of (split, unit): all rules of a unit are evaluated where it stands, in one pass."""
    c = F.col
    u = units.select("split", c("unit.kind").alias("kind"), c("unit.line_no").alias("line_no"), c("unit.file").alias("file"), c("unit.line").alias("line"))
    whole = {"empty": ("W", "V4", EMPTY), "missing": ("E", "V3", NO_LABEL), "orphan": ("E", "V11", ORPHAN), "unreadable": ("E", "V2", UNREADABLE)}
    rules = [F.when(c("kind") == kind, _finding(*what)) for kind, what in whole.items()]
    lines = F.when(c("kind") == "line", F.array_compact(F.array(*_line_rules(min_box_frac)))).otherwise(F.array_compact(F.array(*rules)))
    found = _with_numbers(u).select("split", "file", "line_no", F.explode(lines).alias("f"))
    return found.select("f.level", "f.rule", "split", "file", "line_no", "f.message")


def check_lines(labels: DataFrame, min_box_frac: float = 0.0005) -> DataFrame:
    """V4 to V10 over (split, stem, body); an empty body is V4."""
    lines = labels.select("split", "stem", stripped_lines(F.col("body")).alias("lines"))
    return _told(lines.select("split", F.explode(_looked_at(F.col("lines"), F.concat("stem", F.lit(".txt")))).alias("unit")), min_box_frac)


def _pairless(df: DataFrame, file: Column, level: str, rule: str, message: str) -> DataFrame:
    return df.select(F.lit(level).alias("level"), F.lit(rule).alias("rule"), "split", file.alias("file"), F.lit(None).cast("int").alias("line_no"), F.lit(message).alias("message"))


def unreadable_images(images: DataFrame) -> DataFrame:
    """V2: images that can't be decoded; ``images`` has a boolean ``readable``."""
    return _pairless(images.where(~F.col("readable")), F.col("file_name"), "E", "V2", UNREADABLE)


def missing_labels(images: DataFrame, labels: DataFrame) -> DataFrame:
    """V3: readable images without a label."""
    readable = images.where("readable") if "readable" in images.columns else images
    return _pairless(readable.join(labels, ["split", "stem"], "left_anti"), F.col("file_name"), "E", "V3", NO_LABEL)


def orphan_labels(images: DataFrame, labels: DataFrame) -> DataFrame:
    """V11: labels without an image, readable or not."""
    return _pairless(labels.join(images, ["split", "stem"], "left_anti"), F.concat("stem", F.lit(".txt")), "E", "V11", ORPHAN)


def duplicate_images(files: DataFrame, scope: str = "split") -> DataFrame:
    """V12: equal content within a split; ``scope`` "dataset" also tells of copies across splits.

    A finding names NAMED_PATHS paths on average at most: more copies are told in
    several findings, so that no row grows without bound.
    """
    keys = ["split", "md5"] if scope == "split" else ["md5"]
    held = materialize(files.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    own = files.join(shuffled(held), keys).withColumn("part", F.pmod(F.xxhash64("path"), F.ceil(F.col("n") / NAMED_PATHS)))
    groups = own.repartition(*keys, "part").groupBy(*keys, "part").agg(F.array_sort(F.collect_set("path")).alias("paths"))
    split = F.col("split") if scope == "split" else F.lit(None).cast("string").alias("split")
    message = F.concat(F.lit(DUPLICATE), F.substring("md5", 1, 8), F.lit("): "), F.array_join("paths", ", "))
    return groups.select(F.lit("E").alias("level"), F.lit("V12").alias("rule"), split, F.lit(None).cast("string").alias("file"), F.lit(None).cast("int").alias("line_no"), message.alias("message"))


def leaked_images(files: DataFrame, threshold: int = 6) -> DataFrame:
    """V13: images of different splits with near fingerprints; ``files`` has split, path and fp."""
    pairs = near_pairs(files.select(F.col("path").alias("id"), "fp", "split"), threshold, across="split")
    part = lambda side: F.concat(F.col(f"id_{side}"), F.lit(" ("), F.col(f"split_{side}"), F.lit(")"))
    message = F.concat(F.lit(LEAKAGE), part("a"), F.lit(" ~= "), part("b"), F.lit(" (phash distance "), F.col("distance"), F.lit(")"))
    none = F.lit(None).cast("string")
    return pairs.select(F.lit("W").alias("level"), F.lit("V13").alias("rule"), none.alias("split"), none.alias("file"), F.lit(None).cast("int").alias("line_no"), message.alias("message"))


def leaked_classes(files: DataFrame, threshold: int = 6) -> DataFrame:
    """V13 without its pairs: one row per pair of near or equal fingerprints and of different splits they are found in.

    fp_a, fp_b, distance, split_a, split_b (split_a < split_b where the fingerprints are
    equal), n_a, n_b (images of that fingerprint and split), path_a, path_b (the smallest
    of each). Their products are the pairs that ``leaked_images`` would list: one blank
    frame copied a million times is a row for each two splits.
    """
    held = materialize(files.where("fp IS NOT NULL").groupBy("fp", "split").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("path")))
    distinct = materialize(held.select("fp").distinct())
    near = near_prints(distinct, threshold).unionByName(distinct.select(F.col("fp").alias("fa"), F.col("fp").alias("fb"), F.lit(0).alias("distance")))
    side = lambda s: held.select(F.col("fp").alias(f"f{s}"), *[F.col(c).alias(f"{c}_{s}") for c in ("split", "n", "path")])
    both = near.join(shuffled(side("a")), "fa").join(shuffled(side("b")), "fb").where((F.col("split_a") != F.col("split_b")) & ((F.col("fa") != F.col("fb")) | (F.col("split_a") < F.col("split_b"))))
    return both.select(F.col("fa").alias("fp_a"), F.col("fb").alias("fp_b"), "distance", "split_a", "split_b", "n_a", "n_b", "path_a", "path_b")


def leak_counts(classes: DataFrame) -> DataFrame:
    """The row of ``summary`` that V13 has, from ``leaked_classes``; no row without leaks."""
    n = classes.agg(F.sum(F.col("n_a") * F.col("n_b")).cast("long").alias("n")).where("n > 0")
    return n.select(F.lit("W").alias("level"), F.lit("V13").alias("rule"), F.lit(None).cast("string").alias("split"), "n")


def validate(images: DataFrame, labels: DataFrame, min_box_frac: float = 0.0005, files: DataFrame | None = None, splits: tuple | None = None, threshold: int = 6) -> DataFrame:
    """V2 to V11 in one pass over images and labels, with V1 where ``splits`` names those wanted.

    ``files`` (split, path, md5 and, where near copies count, fp) adds V12 and V13.
    Labels of unreadable images are not looked into, but aren't orphans. A split that
    lacks its images or labels is told once, and its files are not looked into.
    """
    c = F.col
    readable = c("readable") if "readable" in images.columns else F.lit(True)
    own = images.groupBy("split", "stem").agg(F.collect_list(F.struct("file_name", readable.alias("readable"))).alias("__files"))  # the few suffixes of a stem
    both = own.join(labels.select("split", "stem", stripped_lines(F.col("body")).alias("lines")), ["split", "stem"], "full")
    names = lambda want: F.transform(F.filter("__files", lambda f: f["readable"] == want), lambda f: f["file_name"])
    file = F.concat("stem", F.lit(".txt"))
    some = F.size(names(True)) > 0
    units = F.concat(
        F.when(c("__files").isNull(), _units("orphan", F.array(file))).otherwise(_units("unreadable", names(False))),
        F.when(c("__files").isNull() | ~some, _units("missing", F.array().cast("array<string>"))).when(c("lines").isNull(), _units("missing", names(True))).otherwise(_looked_at(c("lines"), file)),
    )
    out = None
    if splits is not None:
        # From the splits' names alone: neither side's texts are read for it.
        parts = [df.select("split").distinct().withColumn("part", F.lit(name)) for df, name in ((images, "images"), (labels, "labels"))]
        out = materialize(missing_split_parts(list(splits), parts[0].unionByName(parts[1])))
        both = both.join(F.broadcast(out.select("split")), "split", "left_anti")  # a row for each of ``splits`` at most
    told = _told(both.select("split", F.explode(units).alias("unit")), min_box_frac)
    out = told if out is None else told.unionByName(out)
    if files is not None:
        out = out.unionByName(duplicate_images(files))
        if "fp" in files.columns:
            out = out.unionByName(leaked_images(files, threshold))
    return out


def summary(findings: DataFrame, leaks: DataFrame | None = None) -> DataFrame:
    """Findings by level, rule and split. ``leaks``, of ``leaked_classes``, adds V13's number where findings don't list its pairs."""
    out = findings.groupBy("level", "rule", "split").agg(F.count(F.lit(1)).alias("n"))
    return out if leaks is None else out.unionByName(leak_counts(leaks))


def verdict(findings: DataFrame, leaks: DataFrame | None = None) -> DataFrame:
    """V14: errors, warnings and whether the dataset passes; warnings never fail it. ``leaks`` as for ``summary``."""
    of = lambda level: F.coalesce(F.sum(F.when(F.col("level") == level, F.col("n"))), F.lit(0)).cast("long")
    return summary(findings, leaks).agg(of("E").alias("errors"), of("W").alias("warnings")).withColumn("passed", F.col("errors") == 0)
