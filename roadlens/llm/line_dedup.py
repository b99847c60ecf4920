"""Line deduplication by range-partitioned line hashes, with DataFrame functions only.

Every line's key is hashed where its text is read; no text crosses a shuffle for that.
Hashes are range-partitioned and sorted by document and position, and each run of one
hash is streamed: the first occurrence in each document counts it, and if it is found in
too many, every occurrence returns its position. The positions of a document become a
bitmap of the lines that stay, 64 lines a word, which is all that the operator returns;
``kept_lines`` puts bitmaps on texts, of which only those that may lose a line are moved.

A line found in a third of all documents would be one run in one task. Hashes that a
bounded sample shows to be that frequent are counted exactly beforehand, with map-side
combining, and decided where they stand.
"""

from __future__ import annotations

import string
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.bounded import maybe_among
from roadlens.session import materialize

#: A line is dropped when its key has LEAST_POINTS code points and is found in LEAST_DOCS documents.
LEAST_DOCS, LEAST_POINTS = 10, 1
#: Lines drawn to find frequent hashes, and draws that make one: at most their quotient, 2,048, are broadcast.
SAMPLE, HEAVY_DRAWS = 1 << 14, 8
_SPACES = " \t\n\x0b\f\r"
_ALL = (1 << 64) - 1


def line_keys(lines: Column) -> Column:
    """The lines without ASCII white space at their ends, with A-Z in lower case; other letters stay as they are.

    Each step is a transform of its own, so that a line's key is worked out once.
    """
    padded = lambda x: reduce(or_, [f(x, F.lit(c)) for c in _SPACES for f in (F.startswith, F.endswith)])
    bare = F.transform(lines, lambda x: F.when(padded(x), F.btrim(x, F.lit(_SPACES))).otherwise(x))
    plain = lambda x: F.octet_length(x) == F.char_length(x)  # noqa: E731  lower() is quick, but would change other letters too
    return F.transform(bare, lambda x: F.when(plain(x), F.lower(x)).otherwise(F.translate(x, string.ascii_uppercase, string.ascii_lowercase)))


def lines_of(text: Column) -> Column:
    """The lines between line feeds; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def content(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes, lower-case hex; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _hashed(keys: Column, least_points: int) -> Column:
    """128 bits of each key as two longs; null where the key is too short."""
    return F.transform(keys, lambda x: F.when(F.char_length(x) >= least_points, F.struct(F.xxhash64(x).alias("h"), F.xxhash64(F.lit("line"), x).alias("g"))))


def _frequent(occurrences: DataFrame, n_lines: int, sample: int) -> DataFrame:
    """(h, g, n_docs) of the hashes that a sample shows to be frequent, counted over all documents.

    Lines are drawn by a hash of document and position, ``sample`` of them on average, so
    that about ``sample / HEAVY_DRAWS`` hashes at most come back, however many lines there are.
    """
    draw = F.pmod(F.xxhash64("row", "pos", F.lit("draw")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = occurrences.where(draw < F.lit(min(1.0, sample / max(1, n_lines))))
    heavy = F.broadcast(materialize(drawn.groupBy("h", "g").agg(F.count(F.lit(1)).alias("draws")).where(F.col("draws") >= HEAVY_DRAWS).select("h", "g")))
    return materialize(occurrences.join(heavy, ["h", "g"], "left_semi").groupBy("h", "g").agg(F.count_distinct("row").alias("n_docs")))


def _words(dropped: DataFrame, n_lines: DataFrame) -> DataFrame:
    """(row, n_dropped, keep) from (row, pos) of the lines that go and (row, n_lines) of their documents."""
    bits = dropped.select("row", (F.col("pos") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, pos % 64)").alias("bit"), F.lit(1).cast("long").alias("one"))
    words = n_lines.select("row", F.explode(F.sequence(F.lit(0), ((F.col("n_lines") - 1) / 64).cast("int"))).alias("word"), F.lit(0).cast("long").alias("bit"), F.lit(0).cast("long").alias("one"))
    # Dealt by document once: words first, then documents, are put together where they are.
    dealt = bits.unionByName(words).repartition("row")
    per_word = dealt.groupBy("row", "word").agg(F.bit_or("bit").alias("gone"), F.sum("one").alias("n"))
    held = F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("stays"))))  # a bit for each line of one document
    return per_word.groupBy("row").agg(F.sum("n").alias("n_dropped"), F.transform(held, lambda w: w["stays"]).alias("keep"))


def keep_bitmaps(docs: DataFrame, least_docs: int = LEAST_DOCS, least_points: int = LEAST_POINTS, text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row per distinct text that loses a line: text_sha256, n_lines, n_dropped, keep.

    Bit ``pos % 64`` of ``keep[pos / 64]`` tells whether line ``pos`` stays. Equal texts
    lose the same lines, so that their bitmap is found by the text's SHA-256; a text that
    isn't there keeps all. Every row counts as a document, also one that repeats another
    or has no id. Null and empty texts are one empty line, whose key has no code points.
    ``sample`` changes only where a frequent line is decided. Other columns are ignored.
    """
    text = docs[f"`{text_col}`"].cast("string")
    slim = materialize(docs.select(F.monotonically_increasing_id().alias("row"), content(text).alias("text_sha256"), _hashed(line_keys(lines_of(text)), least_points).alias("keys")))
    n_lines = slim.agg(F.sum(F.size("keys"))).first()[0] or 0
    every = slim.select("row", F.posexplode("keys").alias("pos", "k")).where("k IS NOT NULL").select("row", "pos", "k.h", "k.g")

    frequent = _frequent(every, n_lines, sample)
    told = every.join(F.broadcast(frequent), ["h", "g"], "left")  # sample / HEAVY_DRAWS rows
    sure = told.where(F.col("n_docs") >= least_docs).select("row", "pos")

    ranges = told.where("n_docs IS NULL").select("h", "g", "row", "pos").repartitionByRange("h").sortWithinPartitions("h", "g", "row", "pos")
    run = Window.partitionBy("h", "g").orderBy("row", "pos")
    first = ranges.withColumn("first", F.coalesce(F.lag("row").over(run) != F.col("row"), F.lit(True)).cast("int"))
    streamed = first.withColumn("n_docs", F.sum("first").over(Window.partitionBy("h", "g"))).where(F.col("n_docs") >= least_docs).select("row", "pos")

    dropped = materialize(sure.unionByName(streamed))
    touched = slim.select("row", "text_sha256", F.size("keys").alias("n_lines")).join(dropped.select("row").distinct(), "row", "left_semi")
    touched = materialize(touched)
    bitmaps = _words(dropped, touched).join(touched, "row")
    return bitmaps.groupBy("text_sha256").agg(*[F.first(c).alias(c) for c in ("n_lines", "n_dropped", "keep")]).select("text_sha256", F.col("n_lines").cast("long").alias("n_lines"), "n_dropped", "keep")


def kept_lines(docs: DataFrame, bitmaps: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_lines, n_dropped, kept_sha256 and kept_text after its columns; null text has an empty kept_text.

    A bitmap of the texts that lose lines, 16 MB at most, is looked up where a text is
    read: others stay there. Columns of these names in ``docs`` give way.
    """
    ids = bitmaps.select(F.xxhash64("text_sha256").alias("id")).distinct()
    added = ("n_lines", "n_dropped", "kept_sha256", "kept_text")
    own = [c for c in docs.columns if c.lower() not in added]
    names = [f"c{i}" for i in range(len(own))]
    plain = docs.select(*[docs[f"`{c}`"].alias(n) for c, n in zip(own, names, strict=True)], F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"))
    marked = maybe_among(plain.withColumn("sha", content(F.col("text"))), F.xxhash64("sha"), ids)
    n_lines = F.size(lines_of(F.col("text"))).cast("long")

    whole = marked.where("NOT maybe").select(*names, n_lines, F.lit(0).cast("long"), "sha", "text")
    found = marked.where("maybe").join(bitmaps.select("text_sha256", F.col("n_dropped").alias("gone"), "keep"), F.col("sha") == F.col("text_sha256"), "left")
    stays = F.filter(lines_of(F.col("text")), lambda x, i: F.getbit(F.get("keep", F.floor(i / 64).cast("int")), i % 64) == 1)
    found = found.withColumn("kept", F.when(F.col("keep").isNotNull(), F.array_join(stays, "\n")).otherwise(F.col("text")))
    doubtful = found.select(*names, n_lines, F.coalesce("gone", F.lit(0)).cast("long"), content(F.col("kept")), "kept")
    return whole.toDF(*own, *added).unionByName(doubtful.toDF(*own, *added))


def drop_common_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, least_points: int = LEAST_POINTS, text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """Every document without the lines that ``least_docs`` documents share: its columns, n_lines, n_dropped, kept_sha256, kept_text.

    A document that loses all its lines has an empty kept_text. Keys are compared by 128
    bits. An empty table gives no rows.
    """
    return kept_lines(docs, materialize(keep_bitmaps(docs, least_docs, least_points, text_col, sample)), text_col)
