"""A data source writer for trees of files: a dataset in the folders that training tools read, or nothing.

A task writes its files under a name of its own and moves them into the job's folder
once it has written them all, with a part of the manifest. The job's folder stands beside
the target and becomes it by one rename when all tasks are done: a reader sees the whole
dataset or none of it. Executors write to any store that pyarrow opens by its URI and
that all of them share.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from roadlens.functions.text import stem

FORMAT = "file_tree"
MANIFEST = "manifest"
#: Files up to which a commit counts what is there: the driver lists them for it.
RECOUNT = 1_000_000
#: Fixed value: what a finding of several files of one name says.
COLLISION = "several files would be written as "


def opened(path: str):
    """(the store that holds a path or URI, the path in it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


def _is_there(store, path: str) -> bool:
    from pyarrow import fs

    return store.get_file_info(path).type != fs.FileType.NotFound


def checked(target: str | None) -> str:
    """The target, if it is a plain path below the dataset; else an error."""
    parts = (target or "").split("/")
    if not target or target.startswith("/") or any(p in ("", ".", "..") for p in parts) or parts[0] in (MANIFEST, "_attempts"):
        raise ValueError(f"not a path below the dataset: {target!r}")
    return target


@dataclass
class Written(WriterCommitMessage):
    files: int
    bytes: int


class FileTreeWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite
        head, _, name = self.path.rpartition("/")
        self.job = f"{head}/.{name}-{uuid.uuid4().hex}"
        store, job = opened(self.job)
        store.create_dir(f"{job}/_attempts")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, job = opened(self.job)
        own = f"{job}/_attempts/{uuid.uuid4().hex}"
        store.create_dir(own, recursive=False)  # fails once the job is given up
        staged: list[str] = []
        size = 0
        with store.open_output_stream(f"{own}/{MANIFEST}") as manifest:
            for batch in iterator:
                at = [batch.schema.get_field_index(c) for c in ("target", "content")]
                for target, content in zip(batch.column(at[0]).to_pylist(), batch.column(at[1]), strict=True):
                    data = content.as_buffer().to_pybytes() if content.is_valid else b""
                    with store.open_output_stream(f"{own}/{len(staged)}") as f:
                        f.write(data)
                    staged.append(checked(target))
                    size += len(data)
                    manifest.write(json.dumps({"target": target, "bytes": len(data), "md5": hashlib.md5(data).hexdigest()}).encode() + b"\n")
        made = set()
        for k, target in enumerate(staged):
            folder = f"{job}/{target}".rpartition("/")[0]
            if folder not in made:
                store.create_dir(folder)
                made.add(folder)
            self._placed(store, f"{own}/{k}", f"{job}/{target}")
        store.create_dir(f"{job}/{MANIFEST}")
        store.move(f"{own}/{MANIFEST}", f"{job}/{MANIFEST}/part-{TaskContext.get().partitionId():06d}.json")
        store.delete_dir(own)
        return Written(len(staged), size)

    @staticmethod
    def _placed(store, own: str, target: str) -> None:
        """Moves a file to its name. What stands there already must be the same, as a lost attempt of this task has left it."""
        there = store.get_file_info(target)
        if there.is_file:
            with store.open_input_file(target) as old, store.open_input_file(own) as new:
                if there.size != new.size() or old.read() != new.read():
                    raise ValueError(f"several files have the name {target}")
        store.move(own, target)

    def commit(self, messages: list[Written | None]) -> None:
        """Publishes the job's folder, if it holds as many files as tasks have told: two of one name, or one left by a lost task, would show.

        Beyond RECOUNT files the tasks' own look at each name is what is left of that.
        """
        from pyarrow import fs

        store, job = opened(self.job)
        _, path = opened(self.path)
        store.create_dir(f"{job}/{MANIFEST}")
        if _is_there(store, f"{job}/_attempts"):
            store.delete_dir(f"{job}/_attempts")
        told = sum(m.files for m in messages if m)
        if told <= RECOUNT:
            found = sum(i.type == fs.FileType.File for i in store.get_file_info(fs.FileSelector(job, recursive=True)))
            parts = sum(i.type == fs.FileType.File for i in store.get_file_info(fs.FileSelector(f"{job}/{MANIFEST}")))
            if found - parts != told:
                raise ValueError(f"{told} files were written, {found - parts} are there: several have one name")
        old = f"{job}-old"
        if _is_there(store, path):
            if not self.overwrite:
                raise FileExistsError(path)
            store.move(path, old)
        store.move(job, path)
        if _is_there(store, old):
            store.delete_dir(old)

    def abort(self, messages: list[Written | None]) -> None:
        store, job = opened(self.job)
        if _is_there(store, job):
            store.delete_dir(job)


class FileTree(DataSource):
    """Rows (target string, content binary) as files below the path that is saved to."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "target string, content binary"

    def writer(self, schema, overwrite: bool) -> FileTreeWriter:
        if not {"target", "content"} <= set(schema.names):
            raise ValueError("a tree of files is written from target and content")
        return FileTreeWriter(self.options["path"], overwrite)


def write_tree(files: DataFrame, path: str, overwrite: bool = False) -> None:
    """Writes (target, content) below ``path``, which mustn't exist unless ``overwrite``; null content is an empty file."""
    spark = files.sparkSession
    store, where = opened(path)
    if not overwrite and _is_there(store, where):
        raise FileExistsError(path)
    spark.dataSource.register(FileTree)
    files.select("target", F.col("content").cast("binary").alias("content")).write.format(FORMAT).mode("overwrite" if overwrite else "append").save(path)


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    """(target, bytes, md5) of the files of a dataset, as its manifest lists them."""
    return spark.read.schema("target string, bytes long, md5 string").json(f"{path}/{MANIFEST}")


def layout_files(items: DataFrame) -> DataFrame:
    """(target, content): images/<split>/<name> and labels/<split>/<stem>.txt of items (split, target_name, content, lines).

    Label text ends in a newline only if it has lines; null lines are no label file, no
    lines an empty one. Null content is no image file: labels alone may be written.
    """
    image = F.when(F.col("content").isNotNull(), F.struct(F.concat(F.lit("images/"), "split", F.lit("/"), "target_name").alias("target"), F.col("content").cast("binary").alias("content")))
    text = F.when(F.size("lines") > 0, F.concat(F.array_join("lines", "\n"), F.lit("\n"))).otherwise("")
    label = F.when(F.col("lines").isNotNull(), F.struct(F.concat(F.lit("labels/"), "split", F.lit("/"), stem(F.col("target_name")), F.lit(".txt")).alias("target"), F.encode(text, "UTF-8").alias("content")))
    return items.select(F.explode(F.array_compact(F.array(image, label))).alias("f")).select("f.target", "f.content")


def collisions(files: DataFrame) -> DataFrame:
    """Findings of targets that several files have: images of one name, or of one stem, whose label would be the other's."""
    held = files.groupBy("target").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    split = F.regexp_extract("target", r"^(?:images|labels)/([^/]+)/", 1)
    message = F.concat(F.lit(COLLISION), "target")
    return held.select(F.lit("E").alias("level"), F.lit("T16").alias("rule"), split.alias("split"), F.regexp_extract("target", r"([^/]*)$", 1).alias("file"), F.lit(None).cast("int").alias("line_no"), message.alias("message"))


def write_layout(items: DataFrame, path: str, overwrite: bool = False, dry_run: bool = False) -> DataFrame:
    """Writes items as ``layout_files`` and returns (target, bytes) of what is or would be written; collisions are an error."""
    files = layout_files(items)
    if several := collisions(files).head(5):
        raise ValueError("; ".join(r["message"] for r in several))
    if not dry_run:
        write_tree(files, path, overwrite)
        return read_tree(items.sparkSession, path).select("target", "bytes")
    return files.select("target", F.octet_length("content").cast("long").alias("bytes"))


def merged_items(items: DataFrame, backgrounds: DataFrame) -> DataFrame:
    """Items, and backgrounds as ``bg__<name>`` with an empty label, as ``write_layout`` takes them.

    Items are named ``<seq_id>__<name>`` unless they have a target_name.
    """
    named = items if "target_name" in items.columns else items.withColumn("target_name", F.concat("seq_id", F.lit("__"), "file_name"))
    empty = backgrounds.select("split", F.concat(F.lit("bg__"), "file_name").alias("target_name"), "content", F.array().cast("array<string>").alias("lines"))
    return named.select("split", "target_name", "content", "lines").unionByName(empty)


def write_negatives(mined: DataFrame, path: str, overwrite: bool = False) -> DataFrame:
    """Copies mined images to <category>/attain_<name>; (target, bytes) of them. ``mined`` has category, file_name and content."""
    kept = mined.where("category IN ('priority', 'generic')").select(F.concat("category", F.lit("/attain_"), "file_name").alias("target"), "content")
    if several := collisions(kept).head(5):
        raise ValueError("; ".join(r["message"] for r in several))
    write_tree(kept, path, overwrite)
    return read_tree(mined.sparkSession, path).select("target", "bytes")
