"""Listing of files by tasks, empty files included.

Spark's own scans leave out files of length 0 and list on the driver. Here a folder is a
row, and a task lists it through Arrow's file systems. With subfolders, each level of the
tree is one job over the folders that the level above has found, which are staged; so a
tree is listed by as many tasks as it has folders, and the driver learns how many folders a
level has and nothing else. One folder's names are held by one task.

Names are taken as Spark's scans take them: those that begin with a dot, or with an
underscore and hold no equals sign, are hidden, files and folders alike.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.shared import write_stage
from docloom.sources.named import opened

#: Folders that one task lists, where there are many.
FOLDERS = 64
#: Names in a batch.
BATCH = 10_000

_LISTED = "below string, is_folder boolean, length long"


def reaches(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is one folder that Arrow's file systems reach.

    A path without a scheme is one in local mode only: elsewhere the cluster's settings say
    which file system it means.
    """
    if re.search(r"[*?\[{,]", path):
        return False
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return bool(re.match(r"local(\[|$)", spark.sparkContext.master)) and os.path.isdir(path)
    try:
        system, top = opened(path)
        return system.get_file_info(top or "/").type == fs.FileType.Directory
    except (pa.ArrowException, OSError):  # a store or a service that Arrow doesn't reach
        return False


def name_pattern(glob: str) -> str:
    """The regular expression, for whole names, of a path filter as Spark's scans take it."""
    out, at, depth = [], 0, 0
    while at < len(glob):
        c = glob[at]
        if c == "\\" and at + 1 < len(glob):
            at += 1
            out.append(re.escape(glob[at]))
        elif c == "[" and (end := glob.find("]", at + 2)) > 0:
            inside = glob[at + 1 : end].replace("\\", "\\\\").replace("[", "\\[")
            out.append(f"[^{inside[1:]}]" if inside[0] in "!^" else f"[{inside}]")
            at = end
        elif c == "{":
            depth += 1
            out.append("(?:")
        elif c == "}" and depth:
            depth -= 1
            out.append(")")
        elif c == "," and depth:
            out.append("|")
        else:
            out.append({"*": ".*", "?": "."}.get(c) or re.escape(c))
        at += 1
    return "".join(out)


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _lister(path: str, pattern: str):
    wanted = re.compile(pattern, re.DOTALL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(path)
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                at = fs.FileSelector(f"{top}/{folder}".rstrip("/") or "/", allow_not_found=True)
                rows = []
                for info in system.get_file_info(at):
                    is_folder = info.type == fs.FileType.Directory
                    if not _hidden(info.base_name) and (is_folder or wanted.fullmatch(info.base_name)):
                        rows.append((f"{folder}/{info.base_name}".lstrip("/"), is_folder, info.size))
                for begin in range(0, len(rows), BATCH):
                    below, kinds, sizes = zip(*rows[begin : begin + BATCH])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(below), pa.array(kinds), pa.array(sizes, pa.int64())],
                        names=["below", "is_folder", "length"],
                    )

    return run


def list_files(spark: SparkSession, path: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """(below, length) of the files of a folder whose names match ``glob``.

    ``below`` is the path below the folder. With ``recursive`` the folders of the tree are
    listed at once, level by level; otherwise nothing runs before the table is read.
    """
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        path = os.path.abspath(path)
    lister = _lister(path, name_pattern(glob))
    level = spark.createDataFrame([("",)], "folder string").coalesce(1)
    if not recursive:
        return level.mapInArrow(lister, _LISTED).where("not is_folder").select("below", "length")
    files = None
    while True:
        found = write_stage(level.mapInArrow(lister, _LISTED), "listing")
        own = found.where("not is_folder").select("below", "length")
        files = own if files is None else files.union(own)
        folders = found.where("is_folder").select(F.col("below").alias("folder"))
        count = folders.count()
        if not count:
            return files
        tasks = max(spark.sparkContext.defaultParallelism, -(-count // FOLDERS))
        level = folders.repartition(min(count, tasks))
