"""Where intermediate tables live."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDER: list[str] = []
# Paths handed out inside each ``scratch`` that this thread has open.
_OPEN: ContextVar[tuple[list[str], ...]] = ContextVar("open", default=())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a folder on this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if not _LOCAL_FOLDER:
        _LOCAL_FOLDER.append(tempfile.mkdtemp(prefix="quillwatch-"))
    return _LOCAL_FOLDER[0]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has written to yet."""
    path = f"{shared_folder(spark)}/quillwatch/{name}-{uuid.uuid4().hex}"
    for paths in _OPEN.get():
        paths.append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    files, jvm_path = _file_system(spark, path)
    return files.exists(jvm_path)


def delete(spark: SparkSession, path: str) -> None:
    files, jvm_path = _file_system(spark, path)
    files.delete(jvm_path, True)


def replace_folder(spark: SparkSession, staged: str, target: str) -> None:
    """Put a written folder in the place of another. Between two renames the old one stands beside its place, from where
    the next call takes it back if this one was ended there."""
    files, to = _file_system(spark, target)
    _, new = _file_system(spark, staged)
    _, old = _file_system(spark, f"{to.getParent()}/.{to.getName()}-before")
    if files.exists(old):
        if files.exists(to):
            files.delete(old, True)
        else:
            files.rename(old, to)
    if files.exists(to) and not files.rename(to, old):
        raise OSError(f"{target} cannot be replaced")
    if not files.rename(new, to):
        files.rename(old, to)
        raise OSError(f"{staged} cannot take the place of {target}")
    files.delete(old, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside the block are deleted at its end. What is needed
    later has to be written elsewhere before that."""
    paths: list[str] = []
    before = _OPEN.set((*_OPEN.get(), paths))
    try:
        yield
    finally:
        _OPEN.reset(before)
        for path in paths:
            delete(spark, path)


def write(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet; the shuffle files of this job go with its end, not when the driver happens to collect its garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(key, before)


def materialize(df: DataFrame, name: str, drop_shuffles: bool = False) -> DataFrame:
    """Write ``df`` once and read it back: several readers then share one computation,
    the plan is cut, and a lost executor costs nothing that was already computed."""
    path = fresh_path(df.sparkSession, name)
    if drop_shuffles:
        write(df, path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
