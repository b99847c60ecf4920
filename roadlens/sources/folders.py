"""What data source readers of <root>/<split>/ folders share: listing, pushed filters on split, partitions planned by bytes.

A dataset that ``file_tree`` wrote isn't listed: its manifest's parts are the partitions,
however many files there are. Other folders are listed by the driver, which holds a name
and a length for each file.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSourceReader, EqualTo, In, InputPartition, IsNotNull

from roadlens.sources.file_tree import MANIFEST, opened

#: Bytes that a partition reads, about; what opening a file is worth.
PART_BYTES, OPEN_COST = 32 << 20, 16 << 10


@dataclass
class Files(InputPartition):
    """Files of one split, each with its length, or those that a part of a manifest names."""

    split: str
    files: list[tuple[str, int]]
    part: str | None = None


class FolderReader(DataSourceReader):
    """Files with one of ``suffixes``, in any letter case, below the folders of ``root``; folders that a filter on split rules out aren't listed."""

    suffixes: tuple[str, ...] = ()

    def __init__(self, root: str, part_bytes: int = PART_BYTES, flat: bool = False):
        """With ``flat`` all files below ``root`` are of the split ""."""
        self.root, self.part_bytes, self.flat = root.rstrip("/"), part_bytes, flat
        self.splits: set[str] | None = None

    def cost(self, length: int) -> int:
        """Bytes of a file that will be read."""
        return length

    def pushFilters(self, filters):
        """Takes equality and lists on split; what else there is is left to Spark."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("split",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.splits = wanted if self.splits is None else self.splits & wanted
            elif not (isinstance(f, IsNotNull) and f.attribute == ("split",)):  # a split is never null
                yield f

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        store, root = opened(self.root)
        manifest = f"{root.rpartition('/')[0]}/{MANIFEST}"
        if not self.flat and store.get_file_info(manifest).type == fs.FileType.Directory:
            return [Files("", [], i.path) for i in store.get_file_info(fs.FileSelector(manifest)) if i.type == fs.FileType.File] or [Files("", [])]
        folders = [""] if self.flat else [i.base_name for i in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if i.type == fs.FileType.Directory]
        out = []
        for split in sorted(folders):
            if self.splits is not None and split not in self.splits:
                continue
            own, room = [], 0
            for i in store.get_file_info(fs.FileSelector(f"{root}/{split}".rstrip("/"), recursive=True)):
                if i.type != fs.FileType.File or not i.base_name.lower().endswith(self.suffixes):
                    continue
                own.append((i.path, i.size))
                room += OPEN_COST + self.cost(i.size)
                if room >= self.part_bytes:
                    out.append(Files(split, own))
                    own, room = [], 0
            if own:
                out.append(Files(split, own))
        return out or [Files("", [])]

    def _named(self, store, root: str, part: str) -> Iterator[tuple[str, str, int]]:
        """(split, path, length) of the files of this folder that a part of the manifest names and filters leave."""
        head, _, folder = root.rpartition("/")
        with store.open_input_stream(part) as f:
            for line in f.read().splitlines():
                told = json.loads(line)
                top, split, *rest = told["target"].split("/")
                if top == folder and rest and (self.splits is None or split in self.splits) and rest[-1].lower().endswith(self.suffixes):
                    yield split, f"{head}/{told['target']}", told["bytes"]

    def opened_files(self, partition: Files) -> Iterator[tuple[str, str, int, object]]:
        """(split, path, length, open file) of each file of a partition, one at a time."""
        store, root = opened(self.root)
        listed = ((partition.split, path, length) for path, length in partition.files)
        for split, path, length in listed if partition.part is None else self._named(store, root, partition.part):
            with store.open_input_file(path) as f:
                yield split, path, length, f
