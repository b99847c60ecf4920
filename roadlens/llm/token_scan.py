"""Token counts by separator scan over flat, unindexed token files.

A token file is a run of fixed-width ids in which every document ends with the
end-of-document id; nothing says where documents lie. Files are read in blocks; each
block is searched at once for the id, and summarised by its tokens, its separators,
what stands before the first and after the last. A prefix scan over the summaries -
within runs of blocks, then over the runs - gives every block the number of documents
before it and the tokens that an unfinished document carries into it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlens.llm.bounded import bound_batches, stretches
from roadlens.session import materialize

#: Tokens of a block, and blocks of a run (the unit of the scan's first level).
BLOCK_TOKENS, RUN_BLOCKS = 1 << 20, 4096
#: Bytes of a file up to which Spark's reader gives it as a row; longer ones are read by ranges of about so many.
WHOLE_FILE = 64 << 20


def flat_blocks(docs: DataFrame, ranks_path: str, eod_id: int, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Encodes documents end to end to one flat file a partition: (file, block, tokens, doc_ids).

    Blocks are cut at a fixed number of tokens, wherever documents lie. ``doc_ids`` is
    the manifest: the documents put in the file since the last block, in order.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        coder = tiktoken.Encoding("flat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        name, block, held, size, put = f"part-{TaskContext.get().partitionId():06d}", 0, [], 0, []

        def row(tokens: np.ndarray, block: int, put: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array([name]), pa.array([block], pa.int64()), pa.array([tokens.tobytes()], pa.binary()), pa.array([put], pa.list_(pa.int64()))], names=["file", "block", "tokens", "doc_ids"])

        def documents() -> Iterator[tuple[int | None, str | None]]:
            for batch in batches:
                for b, texts in stretches(batch.column(1)):
                    yield from zip(batch.column(0).slice(b, len(texts)).to_pylist(), texts, strict=True)

        for doc_id, text in documents():
            ids = np.array([*coder.encode_ordinary(text or ""), eod_id], dtype=dtype)
            held.append(ids)
            size += len(ids)
            put.append(doc_id)
            if size >= block_tokens:
                flat = np.concatenate(held)
                while len(flat) >= block_tokens:
                    yield row(flat[:block_tokens], block, put)
                    flat, block, put = flat[block_tokens:], block + 1, []
                held, size = [flat], len(flat)
        if size or put:
            yield row(np.concatenate(held), block, put)

    bound_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(encode, "file string, block long, tokens binary, doc_ids array<long>")


def read_flat_files(spark: SparkSession, path: str, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS, whole_file: int = WHOLE_FILE) -> DataFrame:
    """(file, block, tokens) of the flat token files of a folder, or of one file.

    Files of up to ``whole_file`` bytes come from Spark's binary reader, in any store that
    it reads. Longer ones are cut in ranges of whole blocks, a row each, which tasks read
    by themselves, however long a file is, from any store that pyarrow opens by its URI.
    """
    bound_batches(spark)
    width = np.dtype(dtype).itemsize * block_tokens
    span = max(1, whole_file // width) * width
    files = spark.read.format("binaryFile").load(path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                whole = memoryview(body.as_buffer())
                for k in range(0, len(whole), width):
                    yield pa.record_batch([pa.array([name]), pa.array([k // width], pa.int64()), pa.array([bytes(whole[k : k + width])], pa.binary())], names=["file", "block", "tokens"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for name, begin, end in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                store, where = fs.FileSystem.from_uri(name)
                with store.open_input_file(where) as f:
                    for k in range(begin, end, width):
                        yield pa.record_batch([pa.array([name]), pa.array([k // width], pa.int64()), pa.array([f.read_at(min(width, end - k), k)], pa.binary())], names=["file", "block", "tokens"])

    kind = "file string, block long, tokens binary"
    small = files.where(F.col("length") <= whole_file).select("path", "content").mapInArrow(cut, kind)
    begins = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(span).cast("long")))
    ranges = files.where(F.col("length") > whole_file).select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"), begins.alias("begin"), "length")
    ranges = ranges.select("path", "begin", F.least(F.col("begin") + span, "length").alias("end")).repartition("path", "begin")
    return small.unionByName(ranges.mapInArrow(read, kind))


def _summaries(eod_id: int, dtype: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {"n": [], "seps": [], "head": [], "tail": [], "inner": []}
            for body in batch.column(2):
                ids = np.frombuffer(body.as_buffer(), dtype=dtype) if body.is_valid else np.zeros(0, dtype)
                at = np.flatnonzero(ids == eod_id)
                rows["n"].append(len(ids))
                rows["seps"].append(len(at))
                rows["head"].append(int(at[0]) if len(at) else len(ids))
                rows["tail"].append(len(ids) - int(at[-1]) - 1 if len(at) else len(ids))
                rows["inner"].append(np.diff(at) - 1)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), *(pa.array(rows[k], pa.int64()) for k in ("n", "seps", "head", "tail")), pa.array(rows["inner"], pa.list_(pa.int64()))],
                names=["file", "block", "n", "seps", "head", "tail", "inner"],
            )

    return scan


def count_tokens(blocks: DataFrame, eod_id: int, dtype: str = "<u2", run_blocks: int = RUN_BLOCKS) -> DataFrame:
    """(file, ordinal, n_tokens, closed): the tokens of every document of every file, its separator not counted.

    ``blocks`` has file, block (0, 1, ...) and tokens. A file's last document may lack
    its separator: it is returned with closed false, if it has tokens. Null or empty
    blocks hold no tokens; two separators in a row enclose a document of 0 tokens.
    """
    scanned = blocks.select("file", "block", "tokens").mapInArrow(_summaries(eod_id, dtype), "file string, block long, n long, seps long, head long, tail long, inner array<long>")
    scanned = materialize(scanned).withColumn("run", F.floor(F.col("block") / run_blocks))
    w = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    local = scanned.withColumn("at", zero(F.sum("n").over(w)))
    # Where the last separator before the block ends, from the start of the run; null if the run has none so far.
    local = local.withColumn("ended", F.when(F.col("seps") > 0, F.col("at") + F.col("n") - F.col("tail")))
    local = local.withColumn("before", zero(F.sum("seps").over(w))).withColumn("last", F.max("ended").over(w))
    runs = local.groupBy("file", "run").agg(F.sum("n").alias("run_n"), F.sum("seps").alias("run_seps"), F.max("ended").alias("run_ended"))
    v = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("run_at", zero(F.sum("run_n").over(v))).withColumn("run_before", zero(F.sum("run_seps").over(v)))
    runs = runs.withColumn("run_last", zero(F.max(F.col("run_at") + F.col("run_ended")).over(v))).withColumn("final", F.row_number().over(Window.partitionBy("file").orderBy(F.col("run").desc())) == 1)
    runs = runs.select(F.col("file").alias("rf"), F.col("run").alias("rr"), "run_at", "run_before", "run_last", "final", "run_n", "run_seps", "run_ended")
    placed = local.join(runs, (F.col("file") == F.col("rf")) & (F.col("run") == F.col("rr")))
    placed = placed.withColumn("carry", F.col("run_at") + F.col("at") - F.coalesce(F.col("run_at") + F.col("last"), F.col("run_last"))).withColumn("base", F.col("run_before") + F.col("before"))
    closed = (
        placed.where("seps > 0")
        .select("file", "base", F.posexplode(F.concat(F.array(F.col("carry") + F.col("head")), F.col("inner"))).alias("nth", "n_tokens"))
        .select("file", (F.col("base") + F.col("nth")).alias("ordinal"), "n_tokens", F.lit(True).alias("closed"))
    )
    left = F.col("run_at") + F.col("run_n") - F.coalesce(F.col("run_at") + F.col("run_ended"), F.col("run_last"))
    unclosed = runs.where("final").select(F.col("rf").alias("file"), (F.col("run_before") + F.col("run_seps")).alias("ordinal"), left.alias("n_tokens"), F.lit(False).alias("closed")).where("n_tokens > 0")
    return closed.unionByName(unclosed)


def document_token_counts(docs: DataFrame, ranks_path: str, eod_id: int) -> DataFrame:
    """(doc_id, n_tokens, file, ordinal): writes the documents' flat token files, scans them, and names what was found.

    Null text is a document of 0 tokens; repeated rows are counted each; an empty
    table gives no rows; other columns are ignored.
    """
    files = materialize(flat_blocks(docs, ranks_path, eod_id))
    manifest = files.select("file", "block", "doc_ids", F.size("doc_ids").cast("long").alias("put"))
    w = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    manifest = manifest.withColumn("base", F.coalesce(F.sum("put").over(w), F.lit(0))).select("file", "base", F.posexplode("doc_ids").alias("nth", "doc_id"))
    manifest = manifest.select("file", (F.col("base") + F.col("nth")).alias("ordinal"), "doc_id")
    return count_tokens(files, eod_id).join(manifest, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal")
