"""A Spark data source that writes rows as files: the counterpart of the ``binaryFile`` reader, which has no writer."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage


class FolderWriter(DataSourceArrowWriter):
    """Each task writes its rows' files below ``path``, a folder that all executors reach, by its URI."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        import uuid

        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path.removeprefix("file:"))
        made = set()
        for batch in iterator:
            for name, content in zip(batch["name"], batch["content"]):
                target = f"{root.rstrip('/')}/{name.as_py()}"
                above = target.rpartition("/")[0]
                if above not in made:
                    store.create_dir(above, recursive=True)
                    made.add(above)
                # a file is whole from its first moment on, and a task that runs again puts the same file in its place
                beside = f"{above}/.{uuid.uuid4().hex}"
                with store.open_output_stream(beside) as out:
                    out.write(content.as_py() or b"")
                store.move(beside, target)
        return WriterCommitMessage()


class FileFolder(DataSource):
    """Options: ``path``. Rows: ``name`` (a relative path) and ``content`` (bytes)."""

    @classmethod
    def name(cls) -> str:
        return "file_folder"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> FolderWriter:
        if not self.options.get("path"):
            raise ValueError("give the folder as option path")
        return FolderWriter(self.options["path"])


def write_files(df: DataFrame, path: str, name: str = "name", content: str = "content") -> None:
    """One file per row: ``content`` (bytes or text, NULL for an empty file) at ``path``/``name``.

    A name given twice keeps one of its rows. Spark's own readers leave out files without a byte.
    """
    df.sparkSession.dataSource.register(FileFolder)
    rows = df.select(df[name].cast("string").alias("name"), df[content].cast("binary").alias("content"))
    rows.write.format("file_folder").mode("append").option("path", path).save()
