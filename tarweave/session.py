"""Session helpers: package shipping, the shared work folder, file systems."""

from __future__ import annotations

import io
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as pafs
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tarweave", cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def split_uri(path: str) -> tuple[FileSystem, str]:
    """The pyarrow file system of ``path`` and the path inside it.

    Accepts plain paths, Hadoop's ``file:/x`` and ``s3a://``.
    """
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return LocalFileSystem(), os.path.abspath(path)
    return FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def make_dir(path: str) -> None:
    fs, inner = split_uri(path)
    fs.create_dir(inner, recursive=True)


def is_dir(path: str) -> bool:
    fs, inner = split_uri(path)
    return fs.get_file_info(inner).type == pafs.FileType.Directory


#: Folders made under the shared folder by the jobs that are running, innermost last.
_scratch: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Only a master in this one process may leave that setting out; it then gets a
    folder of its own for the lifetime of the session. On a cluster a plain path
    is one of the default file system, as it is to Spark.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    alone = re.fullmatch(r"local(\[.*\])?", sc.master)
    if not base:
        if not alone:
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="tarweave-")
        sc.setCheckpointDir(base)
    if not alone and not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", base):
        home = sc._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
        base = home.rstrip("/") + os.path.abspath(base)
    return base.rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the folder that all executors share."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    make_dir(path)
    if _scratch:
        _scratch[-1].append(path)
    return path


def remove_dir(path: str) -> None:
    fs, inner = split_uri(path)
    if fs.get_file_info(inner).type == pafs.FileType.Directory:
        fs.delete_dir(inner)


@contextmanager
def scratch() -> Iterator[list[str]]:
    """Delete the work folders made inside once it ends, whatever happens.

    Tables that the caller still holds are taken off the list it is given.
    """
    made: list[str] = []
    _scratch.append(made)
    try:
        yield made
    finally:
        _scratch.remove(made)
        for path in made:
            remove_dir(path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared work folder and read back: cuts the lineage for good."""
    path = work_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def keep(made: list[str], staged: DataFrame) -> DataFrame:
    """Leave a staged table to the caller of a job: it is not deleted with the job's ``scratch``."""
    made.remove(staged._staged_at)
    return staged


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_tarweave_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    # Not a job's scratch: the application needs it as long as it runs.
    folder = f"{shared_folder(spark)}/package-{uuid.uuid4().hex}"
    make_dir(folder)
    target = f"{folder}/tarweave.zip"
    fs, inner = split_uri(target)
    with fs.open_output_stream(inner) as out:
        out.write(buffer.getvalue())
    sc.addPyFile(target)
    sc._tarweave_shipped = True
