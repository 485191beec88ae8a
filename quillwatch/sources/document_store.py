"""Collections of JSON documents that are replaced as a whole, as a data source named ``documents``.

    document_store.register(spark)
    table.write.format("documents").option("collection", "metrics").mode("overwrite").save(folder)
    spark.read.format("documents").option("collection", "metrics").load(folder)

A collection is a folder with data folders and numbered manifests; the manifest with the highest number names the
files that make up the collection and how many documents each holds. Every task writes a file of its own into a new data
folder and tells its name and count. When all tasks have ended, the next manifest is put in place by one
rename: readers see the old collection before it and the new one after it. If a task fails for good, the data folder is
deleted and nothing else has changed. Files of tasks that were repeated are in no manifest. Data that neither the newest manifest nor
the one before it names is deleted, so that a reader that has begun can end.

The folder has to be reachable under the same name from the driver and all executors: a shared mount, or a scheme that
pyarrow knows. One writer at a time may write to a collection.
"""

from __future__ import annotations

import io
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "documents"
SCHEMA = "value STRING"
_MANIFEST = re.compile(r"manifest-(\d+)\.json")
_ROWS = 1000


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _manifests(files: pafs.FileSystem, folder: str) -> list[tuple[int, str]]:
    """Number and path of the manifests, newest first."""
    held = files.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return sorted(((int(m[1]), f.path) for f in held if (m := _MANIFEST.fullmatch(f.base_name))), reverse=True)


def _read(files: pafs.FileSystem, path: str) -> list[dict]:
    with files.open_input_stream(path) as stream:
        return json.loads(stream.read())["files"]


def stored(path: str, collection: str) -> list[dict]:
    """Files of the collection as it is now: name, documents. Empty if there is none."""
    files, folder = _open(path)
    manifests = _manifests(files, f"{folder}/{collection}")
    return _read(files, manifests[0][1]) if manifests else []


def count(path: str, collection: str) -> int:
    return sum(f["documents"] for f in stored(path, collection))


@dataclass
class FileWritten(WriterCommitMessage):
    name: str
    documents: int


@dataclass
class StoredFile(InputPartition):
    name: str


class DocumentWriter(DataSourceArrowWriter):
    def __init__(self, path: str, collection: str, overwrite: bool):
        self.path, self.collection, self.overwrite = path, collection, overwrite
        self.data = f"data-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> FileWritten:
        files, folder = _open(self.path)
        name, documents = f"{self.data}/part-{uuid.uuid4().hex}.json", 0
        files.create_dir(f"{folder}/{self.collection}/{self.data}", recursive=True)
        with files.open_output_stream(f"{folder}/{self.collection}/{name}", compression=None) as out:
            for batch in iterator:
                for document in batch.column(0):
                    out.write((document.as_py() + "\n").encode())
                documents += batch.num_rows
        return FileWritten(name, documents)

    def commit(self, messages: list[FileWritten | None]) -> None:
        files, folder = _open(self.path)
        folder = f"{folder}/{self.collection}"
        manifests = _manifests(files, folder)
        before = _read(files, manifests[0][1]) if manifests else []
        written = [{"name": m.name, "documents": m.documents} for m in messages if m is not None]
        now = written if self.overwrite else before + written
        number = manifests[0][0] + 1 if manifests else 1
        files.create_dir(folder, recursive=True)
        draft = f"{folder}/draft-{uuid.uuid4().hex}"
        with files.open_output_stream(draft, compression=None) as out:
            out.write(json.dumps({"files": now}).encode())
        files.move(draft, f"{folder}/manifest-{number:010}.json")
        self._clean(files, folder, manifests, now + before)

    def _clean(self, files: pafs.FileSystem, folder: str, manifests: list[tuple[int, str]], needed: list[dict]) -> None:
        for _, path in manifests[1:]:
            files.delete_file(path)
        keep = {f["name"].split("/")[0] for f in needed}
        for f in files.get_file_info(pafs.FileSelector(folder)):
            if f.base_name.startswith("data-") and f.base_name not in keep:
                files.delete_dir(f.path)

    def abort(self, messages: list[FileWritten | None]) -> None:
        files, folder = _open(self.path)
        data = f"{folder}/{self.collection}/{self.data}"
        if files.get_file_info(data).type == pafs.FileType.Directory:
            files.delete_dir(data)


class DocumentReader(DataSourceReader):
    def __init__(self, path: str, collection: str):
        self.path, self.collection = path, collection

    def partitions(self) -> list[StoredFile]:
        return [StoredFile(f["name"]) for f in stored(self.path, self.collection) if f["documents"]]

    def read(self, partition: StoredFile) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, StoredFile):  # an empty collection is read as one part without a file
            return
        files, folder = _open(self.path)
        held: list[str] = []
        with files.open_input_file(f"{folder}/{self.collection}/{partition.name}") as stream:
            for line in io.BufferedReader(stream):
                held.append(line[:-1].decode())
                if len(held) == _ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])


class DocumentSource(DataSource):
    """Reads and writes one column, ``value``, of JSON texts."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def _place(self) -> tuple[str, str]:
        if not self.options.get("path") or not self.options.get("collection"):
            raise ValueError("documents need a path and a collection")
        return self.options["path"].rstrip("/"), self.options["collection"]

    def reader(self, schema: StructType) -> DocumentReader:
        return DocumentReader(*self._place())

    def writer(self, schema: StructType, overwrite: bool) -> DocumentWriter:
        if [f.dataType.typeName() for f in schema.fields] != ["string"]:
            raise ValueError("documents are one column of texts")
        return DocumentWriter(*self._place(), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DocumentSource)
