"""What lies in a folder, and small files, by way of the file system without a Spark job."""

from __future__ import annotations

from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _names(spark: SparkSession, glob: str) -> Iterator[str]:
    path, system = _located(spark, glob)
    for status in system.globStatus(path) or []:
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            yield name


def matching(spark: SparkSession, glob: str) -> list[str]:
    """Names of the entries a Hadoop glob matches, hidden ones (``_``, ``.``) left out."""
    return list(_names(spark, glob))


def any_matching(spark: SparkSession, glob: str) -> bool:
    return next(_names(spark, glob), None) is not None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds anything finished; writes in progress are hidden."""
    return any_matching(spark, f"{path}/*")


def read_text(spark: SparkSession, path: str) -> str:
    where, system = _located(spark, path)
    stream = system.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not be there yet; False if it is."""
    where, system = _located(spark, path)
    try:
        stream = system.create(where, False)
    except Py4JJavaError as error:
        if "AlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()
    return True


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, if it is there."""
    where, system = _located(spark, path)
    system.delete(where, True)


def _located(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return where, where.getFileSystem(conf)
