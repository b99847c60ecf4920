"""A corpus pipeline: language ID, exact and near dedup, mixing and packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns a DataFrame, written as Parquet and reread as the next one's docs. All but
the last return the columns of documents. Rows without a doc_id, or that share one,
are documents of their own. Extra columns pass through, whatever their names; an empty
table stays empty.

Texts are shuffled in one place only, where mixing repeats them: language ID adds its
prediction as it reads, and the dedups send only the rows that a bitmap of dropped ones
can't rule out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm.bounded import maybe_among
from roadlens.llm.exact_dedup import exact_groups
from roadlens.llm.langid import UNKNOWN, with_language
from roadlens.llm.minhash import near_groups
from roadlens.llm.mixing import mix_sources
from roadlens.llm.packing import pack_documents
from roadlens.llm.queries import tokenizer_path
from roadlens.session import materialize, table


#: The columns of documents that stages read.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _any_names(stage: Stage) -> Stage:
    """The stage with other columns renamed by position while it works, so that names with dots, quotes or in another case are nothing to it."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        return stage(spark, docs.toDF(*[c if c in KNOWN else f"extra_{i}" for i, c in enumerate(names)]), sf_dir).toDF(*names)

    return run


def _free(docs: DataFrame, name: str) -> str:
    """``name``, with as many marks added as it takes to be no column of ``docs``."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def _apart(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with column names that ``docs`` has not, whatever else that carries."""
    mark = "_"
    while any(f"{mark}{c}" in docs.columns for c in found.columns):
        mark += "_"
    return found.toDF(*[f"{mark}{c}" for c in found.columns])


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` and the name of a new column that tells its rows apart.

    That is doc_id where every row has its own. Otherwise one row of an id has it for
    its number, and other rows, and those without an id, have numbers above all ids.
    """
    row = _free(docs, "_row")
    odd = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL")
    if odd.isEmpty():
        return docs.withColumn(row, F.col("doc_id")), row
    placed = materialize(docs.withColumn(row, F.monotonically_increasing_id()))
    top = max(placed.agg(F.max("doc_id")).head()[0] or 0, 0)
    if top >= 1 << 62:  # no room above the ids
        return placed, row
    first = _apart(placed, placed.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(row).alias("first")))
    joined = placed.join(first, (placed["doc_id"] == first[0]) & (placed[row] == first[1]), "left")
    number = F.when(first[0].isNotNull(), placed["doc_id"]).otherwise(placed[row] + F.lit(top + 1))
    return materialize(joined.select(*[placed[c] for c in docs.columns], number.alias(row))), row


def _by_row(rows: DataFrame, row: str) -> DataFrame:
    """``rows`` as operators get them, with the rows' numbers for doc_id."""
    return rows.select(*[rows[row].alias(c) if c == "doc_id" else rows[c] for c in rows.columns if c != row])


def _keep(docs: DataFrame, groups) -> DataFrame:
    """The rows of ``docs`` that ``groups`` keeps, each by its own decision.

    Rows that no dropped one's bit stands for stay where they are; the others are joined
    with the dropped ones by number.
    """
    rows, row = _numbered(docs)
    dropped = materialize(groups(_by_row(rows, row)).where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct())
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = rows.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)], F.col(row).alias("row"))
    marked = maybe_among(plain, F.col("row"), dropped)
    doubtful = marked.where("maybe").join(dropped, F.col("row") == F.col("gone"), "left_anti")
    return marked.where("NOT maybe").select(*names).unionByName(doubtful.select(*names)).toDF(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what has no letter; the other documents stay, whatever language they are in.

    A null lang is filled with the prediction, if any language could be learned. Null and empty texts have no letter;
    repeated rows are predicted alike.
    """
    found = _free(docs, "_lang")
    named = with_language(docs, found).where(~F.col(found).eqNullSafe(UNKNOWN))
    return named.select(*[F.coalesce(F.col(c), F.col(found)).alias(c) if c == "lang" else F.col(c) for c in docs.columns])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space the one of most code points stays, then of the smallest doc_id.

    Null and empty texts are equal. Of rows that are wholly alike one stays; of equal
    texts without a doc_id one stays, and after those that have one.
    """
    return _keep(docs, exact_groups)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest doc_id stays.

    Texts without a word are in no group and stay. Documents without a doc_id are
    numbered above all ids, so that they go first.
    """
    return _keep(docs, near_groups)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice.

    A null source is a source of its own; texts without a word take no part and go.
    """
    rows, row = _numbered(docs)
    copies = _apart(rows, mix_sources(_by_row(rows, row)).where("copies > 0").select("doc_id", F.sequence(F.lit(1), F.col("copies").cast("int")).alias("copies")))
    joined = rows.join(copies, rows[row] == copies[0])
    return joined.select(*[rows[c] for c in docs.columns], F.explode(copies[1]).alias(f"{copies.columns[1]}_")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence of 2,048 tokens; a null or empty text is its end id alone. Repeats are packed each."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("language_id", _any_names(language_id)), ("exact_dedup", _any_names(exact_dedup)), ("near_dedup", _any_names(near_dedup)), ("mixing", _any_names(mixing)), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language ID, ProbMinHash and tokenizer ids are beyond SQL: tests/llm holds run() against plain Python.
ORACLE_SQL = None
