"""Files as Spark lists them, and the few file operations that no DataFrame writer offers.

Everything goes through the file system of the path, so any store that Spark reads will do.
"""

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILES = "path string, length long, modified long"
DELETES_AT_ONCE = 16


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, length, modified in microseconds) of the files a reader of `path` would read.

    Only the listing is used: no file is opened.
    """
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.unix_micros("modificationTime").alias("modified"))


def read_if_there(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet table, or an empty one if nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def stamp(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Files, bytes and last change of a file or folder (not of folders below it), from its listing."""
    files, place = _file_system(spark, path)
    found = files.listStatus(place)
    return len(found), sum(f.getLen() for f in found), max((f.getModificationTime() for f in found), default=0)


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder with those above it; one that is there stays as it is."""
    files, place = _file_system(spark, path)
    files.mkdirs(place)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all it holds; false if there was none."""
    files, place = _file_system(spark, path)
    return files.delete(place, True)


def delete_folders(spark: SparkSession, root: str, names: list[str]) -> None:
    """Delete the folders `names` of `root`, several at a time, as far as they are there."""
    if not names:
        return
    files, place = _file_system(spark, root)
    with ThreadPoolExecutor(DELETES_AT_ONCE) as threads:
        list(threads.map(lambda name: files.delete(spark._jvm.org.apache.hadoop.fs.Path(place, name), True), names))


def move_into_place(spark: SparkSession, staged: str, path: str) -> None:
    """Let the finished folder `staged` take the place of `path`.

    Two operations on names: between them the table is absent, never half written.
    """
    files, place = _file_system(spark, path)
    files.mkdirs(place.getParent())
    files.delete(place, True)
    if not files.rename(spark._jvm.org.apache.hadoop.fs.Path(staged), place):
        raise OSError(f"could not move {staged} to {path}")
