"""Scratch tables in the folder the cluster shares, and file-system calls through Spark's own Hadoop client."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_session_folders: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only for an unset value in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="giftledger-")
    return _local_folders[app]


def session_folder(spark: SparkSession) -> str:
    """The folder for scratch tables of this application, which Spark's file-system client deletes when the driver ends.

    Results that read scratch tables are lazy, so the tables have to stay while the session may still read them.
    """
    folder = f"{shared_folder(spark)}/giftledger-{spark.sparkContext.applicationId}"
    if folder not in _session_folders:
        fs, hadoop_path = _file_system(spark, folder)
        fs.mkdirs(hadoop_path)
        fs.deleteOnExit(hadoop_path)
        _session_folders.add(folder)
    return folder


def release_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables of this application now; for a session that goes on after its results are written."""
    folder = session_folder(spark)
    _session_folders.discard(folder)
    delete_path(spark, folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path for a scratch table."""
    return f"{session_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return hadoop_path.getFileSystem(conf), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none where it does not exist."""
    fs, hadoop_path = _file_system(spark, path)
    return sorted(item.getPath().getName() for item in fs.listStatus(hadoop_path)) if fs.exists(hadoop_path) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create one small file, whole or not at all; False where it exists already.

    The text is written beside and renamed to the name, which does not replace a file.
    """
    folder, name = path.rsplit("/", 1)
    fs, beside = _file_system(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    jvm = spark._jvm.org.apache.hadoop.fs
    context = jvm.FileContext.getFileContext(fs.getUri(), fs.getConf())
    no_options = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0)
    try:
        context.rename(beside, jvm.Path(path), no_options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        fs.delete(beside, False)
        return False
    return True


@contextmanager
def materialized(df: DataFrame, label: str):
    """Evaluate ``df`` once into a scratch table and drop the table afterwards.

    The table lives in shared storage, so losing an executor costs neither the rows nor their lineage, and later
    passes read only the columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)
