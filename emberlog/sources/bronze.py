"""Raw logs: headerless CSV text, compressed with bzip2 or gzip (Spark picks the codec by suffix).

A bzip2 file is split over many tasks; a gzip file is one task. Land gzip logs
as many moderate files, or spread the rows at the silver write.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog import schemas
from emberlog.session import shared_path

REJECT_COLUMN = "_rejected_line"


def read_log(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """CSV under a declared schema: bad cells become NULL, rows are kept."""
    return spark.read.schema(schema).csv(path, header=False, mode="PERMISSIVE")


def read_flagged_log(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """`read_log` with the raw line of malformed rows in REJECT_COLUMN, for readers of all columns.

    The reader fills it from the columns it is asked for, so a query that leaves some out sees
    fewer lines flagged; `flag_malformed` doesn't depend on that, at the price of a second parse.
    """
    with_line = T.StructType([*schema.fields, T.StructField(REJECT_COLUMN, T.StringType())])
    return spark.read.schema(with_line).csv(
        path, header=False, mode="PERMISSIVE", columnNameOfCorruptRecord=REJECT_COLUMN
    )


def read_auth(spark: SparkSession, path) -> DataFrame:
    return read_log(spark, path, schemas.AUTH)


def read_dns(spark: SparkSession, path) -> DataFrame:
    return read_log(spark, path, schemas.DNS)


def read_flows(spark: SparkSession, path) -> DataFrame:
    return read_log(spark, path, schemas.FLOWS)


def read_proc(spark: SparkSession, path) -> DataFrame:
    return read_log(spark, path, schemas.PROC)


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Raw text, one row (`value`) per line."""
    return spark.read.text(path)


def normalise_dns(dns: DataFrame) -> DataFrame:
    """DNS columns in the snake case of the other logs."""
    return dns.withColumnsRenamed(
        {"SourceComputer": "source_computer", "ComputerResolved": "computer_resolved"}
    )


def flag_malformed(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Rows under `schema` with the raw line of malformed ones in REJECT_COLUMN.

    Bad cells, short rows and long rows are malformed; blank lines are no rows. Each line
    is parsed under the whole schema whatever columns a query asks for, so the flag doesn't
    depend on the projection.
    """
    with_line = T.StructType([*schema.fields, T.StructField(REJECT_COLUMN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECT_COLUMN}
    lines = spark.read.text(path).where(F.length(F.btrim("value")) > 0)
    return lines.select(F.from_csv("value", with_line.toDDL(), options).alias("row")).select("row.*")


def split_malformed(
    spark: SparkSession, path, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, rejected lines with what could be read of them).

    The raw file is parsed once; the flagged rows are stored and both sides read them.
    """
    stored = shared_path(spark, "flagged")
    flagged = flag_malformed(spark, path, schema)
    flagged.write.parquet(stored)
    kept = spark.read.schema(flagged.schema).parquet(stored)
    good = kept.where(F.col(REJECT_COLUMN).isNull()).drop(REJECT_COLUMN)
    return good, kept.where(F.col(REJECT_COLUMN).isNotNull())
