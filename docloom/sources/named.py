"""One file per row, under the name that the row gives: a Spark data source for writing.

    spark.dataSource.register(NamedFiles)
    files.write.format("named_files").mode("append").save(path)   # (output_name, text)

Each task writes its files to a folder of the job that readers don't look into. Only when
all tasks have succeeded, and no name came twice or is taken, do the files move to their
names; a job that fails deletes the folder and leaves nothing. A task that is tried again
writes to a folder of its own, of which only the successful one's files move.

Files are reached through Arrow's file systems: local or mounted folders, HDFS, S3 and other
object stores, by the scheme of the path.
"""

from __future__ import annotations

import posixpath
import re
import time
import uuid
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

# Files that move to their names at the same time.
MOVERS = 16
# How often the folder of a job that failed is tried to be deleted.
CLEARINGS = 20


@dataclass
class Written(WriterCommitMessage):
    """Names of the files that a task wrote below a folder of its own."""

    folder: str
    names: list[str]


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path; a scheme with a single slash, as Spark writes it, is one too."""
    path = re.sub(r"^(\w[\w+.-]*):/(?!/)", r"\1:///", path)
    if "://" not in path:
        path = f"file://{posixpath.abspath(path)}"
    system, inside = fs.FileSystem.from_uri(path)
    return system, inside.rstrip("/")


def checked_name(name: str | None) -> str:
    """A relative path that stays below its folder, and that readers look at."""
    parts = (name or "").split("/")
    if any(p in ("", ".", "..") or p[0] in "._" or "\0" in p for p in parts):
        raise ValueError(f"not a file name: {name!r}")
    return name


class NamedFiles(DataSource):
    """Write (output_name, text) as files of these names; ``mode("overwrite")`` replaces files
    of the same names and leaves others alone, ``mode("append")`` refuses taken names."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema: T.StructType, overwrite: bool) -> NamedFilesWriter:
        found = {f.name: f.dataType for f in schema.fields}
        if found != {"output_name": T.StringType(), "text": T.StringType()}:
            raise AnalysisException(f"named_files takes (output_name string, text string), not {schema.simpleString()}")
        return NamedFilesWriter(self.options["path"], overwrite)


class NamedFilesWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite = path, overwrite
        self.job = f"_writing-{uuid.uuid4().hex}"
        system, top = opened(path)
        system.create_dir(f"{top}/{self.job}", recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, top = opened(self.path)
        folder = f"{self.job}/{uuid.uuid4().hex}"
        made, names = {f"{top}/{self.job}"}, []

        def make(below: str) -> None:
            """Never the job's own folder: a task that outlives its job finds it gone and fails."""
            if below not in made:
                make(posixpath.dirname(below))
                system.create_dir(below, recursive=False)
                made.add(below)

        for batch in iterator:
            for name, text in zip(batch.column("output_name"), batch.column("text")):
                name = checked_name(name.as_py())
                at = f"{top}/{folder}/{name}"
                make(posixpath.dirname(at))
                with system.open_output_stream(at) as out:
                    if text.is_valid:
                        out.write(text.as_buffer())
                names.append(name)
        return Written(folder, names)

    def commit(self, messages: list[Written | None]) -> None:
        system, top = opened(self.path)
        moves = [(m.folder, name) for m in messages if m for name in m.names]
        try:
            self._check(system, top, [name for _, name in moves])
        except Exception:
            self.abort(messages)
            raise
        for folder in {posixpath.dirname(name) for _, name in moves}:
            system.create_dir(f"{top}/{folder}".rstrip("/"), recursive=True)
        with ThreadPoolExecutor(MOVERS) as pool:
            done = [pool.submit(system.move, f"{top}/{folder}/{name}", f"{top}/{name}") for folder, name in moves]
            for move in done:
                move.result()
        system.create_dir(top, recursive=True)
        self._clear(system, top)

    def _check(self, system: fs.FileSystem, top: str, names: list[str]) -> None:
        repeated = [n for n, count in Counter(names).items() if count > 1]
        if repeated:
            raise ValueError(f"names that come more than once: {sorted(repeated)[:5]}")
        if not self.overwrite:
            taken = [n for n in names if system.get_file_info(f"{top}/{n}").type != fs.FileType.NotFound]
            if taken:
                raise ValueError(f"names that are taken: {sorted(taken)[:5]}")

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*opened(self.path))

    def _clear(self, system: fs.FileSystem, top: str) -> None:
        at = f"{top}/{self.job}"
        for left in range(CLEARINGS - 1, -1, -1):
            if system.get_file_info(at).type == fs.FileType.NotFound:
                return
            try:
                system.delete_dir(at)
            except OSError:  # a task that is being stopped has just written
                if not left:
                    raise
                time.sleep(0.2)
