"""A sink of text files: rows of (path, text) become root/<path>, written by the tasks.

    spark.dataSource.register(TextFiles)
    rows.write.format("text_files").mode("append").save(root)

A task writes into a folder of its own below root/_staged. When all tasks are done the files are renamed into place, over files that are there; when the job fails
the staged files go, so a failed or repeated task leaves none (an executor that is cut off at that moment may leave some below root/_staged in an object store). Null texts are empty files. A path that is blank, absolute or leaves the root fails, and so does one that several rows have.
"""

from __future__ import annotations

import posixpath
import time
import uuid
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tessella.sources.shared import open_store


@dataclass
class Staged(WriterCommitMessage):
    folder: str
    names: list[str]


class TextFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "text_files"

    def schema(self) -> str:
        return "path string, text string"

    def writer(self, schema, overwrite):
        if overwrite or set(schema.names) != {"path", "text"}:
            raise ValueError("text_files takes columns path and text in append mode")
        return TextFileWriter(self.options["path"])


class TextFileWriter(DataSourceWriter):
    def __init__(self, root: str):
        self.root, self.job = root.rstrip("/"), f"_staged/{uuid.uuid4().hex}"
        store, place = open_store(self.root)
        store.create_dir(f"{place}/{self.job}", recursive=True)

    def write(self, iterator) -> Staged:
        folder = f"{self.job}/{uuid.uuid4().hex}"
        store, root = open_store(self.root)
        names, made = set(), set()
        # Level by level: where the job has been ended meanwhile, its folder is gone and a late task fails here.
        store.create_dir(f"{root}/{folder}", recursive=False)
        for row in iterator:
            name = row["path"]
            if not name or name.startswith("/") or posixpath.normpath(name) != name or name.split("/")[0] in ("..", "_staged"):
                raise ValueError(f"unsafe path {name!r}")
            if name in names:
                raise ValueError(f"several rows for {name}")
            names.add(name)
            levels = name.split("/")[:-1]
            for k in range(len(levels)):
                if (above := "/".join(levels[: k + 1])) not in made:
                    store.create_dir(f"{root}/{folder}/{above}", recursive=False)
                    made.add(above)
            with store.open_output_stream(f"{root}/{folder}/{name}", compression=None) as out:
                out.write((row["text"] or "").encode())
        return Staged(folder, sorted(names))

    def commit(self, messages: list[Staged | None]) -> None:
        store, root = open_store(self.root)
        done = [m for m in messages if m is not None]
        names = [n for m in done for n in m.names]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError("several rows for one path")
        for above in sorted({posixpath.dirname(f"{root}/{n}") for n in names}):
            store.create_dir(above, recursive=True)
        for message in done:
            for name in message.names:
                store.move(f"{root}/{message.folder}/{name}", f"{root}/{name}")
        self._clear(store, root)

    def abort(self, messages: list[Staged | None]) -> None:
        self._clear(*open_store(self.root))

    def _clear(self, store, root: str) -> None:
        from pyarrow.fs import FileSelector, FileType

        for attempt in range(20):  # a task that still writes can hold a folder open for a moment
            if store.get_file_info(f"{root}/{self.job}").type == FileType.NotFound:
                break
            try:
                store.delete_dir(f"{root}/{self.job}")
            except OSError:
                if attempt == 19:
                    raise
                time.sleep(0.1)
        staged = f"{root}/_staged"
        if store.get_file_info(staged).type == FileType.Directory and not store.get_file_info(FileSelector(staged)):
            store.delete_dir(staged)
