"""The first lines of a log, found by counting leading files and cut by tasks.

Files are counted within a budget of bytes that grows until it holds enough lines, so the
number of jobs is the logarithm of the bytes needed, whatever the number of files. Files
before the one that holds the last line wanted are read as they are. That one is read as a
single split with a limit, so one task reads on only to that line, however large the file and
whatever its codec. Lines never come to the driver; it sees paths and a count per round.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberlog.operators.sampling import number_lines
from emberlog.session import shared_path
from emberlog.sources.bronze import read_lines

BYTES_PER_LINE, LEAST_BYTES, GROWTH = 32, 1 << 22, 4
ANY_SIZE = str(1 << 60)


def _files(spark: SparkSession, path) -> DataFrame:
    """(path, file, before, upto): the files in order and the bytes up to where each begins and ends."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("_metadata.file_path").alias("file"), "length")
    upto = F.sum("length").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, 0))
    return files.where("length > 0").withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("length"))


def _one_split(spark: SparkSession, path: str) -> DataFrame:
    """The lines of one file as a single split. How files are cut is a setting of the session, so another one reads it."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", ANY_SIZE)
    session.conf.set("spark.sql.files.openCostInBytes", ANY_SIZE)
    return read_lines(session, path)


def _counted(spark: SparkSession, files: DataFrame, budget: int) -> DataFrame:
    """(file, path, rows, first) of the files within the budget: how many lines each has and how many are before it."""
    paths = [r["path"] for r in files.where(F.col("upto") <= budget).select("path").collect()]
    stored = shared_path(spark, "line-counts")
    if paths:
        lines = read_lines(spark, paths).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
    else:
        lines = spark.createDataFrame([], "file string, rows long")
    known = files.where(F.col("upto") <= budget).select("file", "path")
    before = F.sum("rows").over(Window.orderBy("file")) - F.col("rows")
    lines.join(known, "file").withColumn("first", before).write.parquet(stored)
    return spark.read.parquet(stored)


def leading_lines(spark: SparkSession, path, n: int) -> DataFrame:
    """(line_no, value): the first `n` lines over all files of `path` in path order, numbered from 0.

    All lines if there are fewer.
    """
    files = _files(spark, path)
    if n <= 0:
        return spark.createDataFrame([], "line_no long, value string")
    budget = max(LEAST_BYTES, n * BYTES_PER_LINE)
    while True:
        counts = _counted(spark, files, budget)
        total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        if total >= n:
            last = counts.where((F.col("first") < n) & (F.col("first") + F.col("rows") >= n)).first()
            break
        # The budget ends in this file: it may hold the rest.
        edge = files.where((F.col("before") <= budget) & (F.col("upto") > budget)).select("file", "path").first()
        if edge is None:
            last = None
            break
        wanted = n - total
        if _one_split(spark, edge["path"]).limit(wanted).count() == wanted:
            last = {"file": edge["file"], "path": edge["path"], "first": total}
            break
        budget *= GROWTH  # counting anew costs a third more in all, and nothing is kept between rounds
    whole = counts if last is None else counts.where(F.col("file") < last["file"])
    parts = []
    paths = [r["path"] for r in whole.where("rows > 0").select("path").collect()]
    if paths:
        parts.append(number_lines(read_lines(spark, paths)))
    if last:
        # The one task of the one split numbers its lines from 0.
        number = F.monotonically_increasing_id() + last["first"]
        parts.append(_one_split(spark, last["path"]).select(number.alias("line_no"), "value").limit(n - last["first"]))
    if not parts:
        return spark.createDataFrame([], "line_no long, value string")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
