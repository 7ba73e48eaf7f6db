"""Shared storage for cutting lineage."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session may go without it; then a temporary folder stands in.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="daybook-"))
    return context.getCheckpointDir()


def scratch_dir(spark: SparkSession) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/daybook-{uuid.uuid4().hex}"


def settled(frame: DataFrame) -> DataFrame:
    """Compute ``frame`` once and keep it in the shared folder, lineage cut.

    Later steps read the stored rows; a lost executor does not lose them.
    """
    spark = frame.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return frame.checkpoint()


def _located(spark: SparkSession, path: str):
    """A path and the file system it is in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or one that fits the pattern, exists."""
    path, system = _located(spark, pattern)
    return bool(system.globStatus(path))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if there is no such folder."""
    folder, system = _located(spark, path)
    return [status.getPath().getName() for status in system.listStatus(folder)] if system.exists(folder) else []


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    file, system = _located(spark, path)
    stream = system.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> None:
    """Makes a small file appear with its whole text; fails if it exists, unless it may be replaced."""
    jvm = spark._jvm
    file, system = _located(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(file.getParent(), f"_draft-{uuid.uuid4().hex}")
    stream = system.create(draft, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE if replace else kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(system.makeQualified(draft), system.makeQualified(file), options)
    except Py4JJavaError as problem:
        system.delete(draft, False)
        if system.exists(file) and not replace:
            raise FileExistsError(path) from problem
        raise


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder with all it holds, or a file, if it exists."""
    folder, system = _located(spark, path)
    system.delete(folder, True)


def empty_folder(spark: SparkSession, path: str) -> None:
    """Leaves a folder without files."""
    folder, system = _located(spark, path)
    system.delete(folder, True)
    system.mkdirs(folder)
