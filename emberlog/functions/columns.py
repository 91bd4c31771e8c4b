"""Column expressions. All are Spark built-ins, so they stay inside generated code."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Results depend on them.
HOST_PATTERN = r"https?://([^/]+)"
BUCKET_SECONDS = 3600


def url_host(url: Column) -> Column:
    """Authority part of a URL, port included; '' when the text is no http(s) URL."""
    return F.regexp_extract(url, HOST_PATTERN, 1)


def hit_flag(threat: Column) -> Column:
    """1 where a threat is known, otherwise 0."""
    return F.when(threat.isNotNull(), 1).otherwise(0)


def time_bucket(seconds: Column, width: int = BUCKET_SECONDS) -> Column:
    """Start of the bucket, truncated toward zero."""
    return (seconds / width).cast("long") * width


def numeric_columns(df: DataFrame) -> DataFrame:
    """Only the numeric columns, in their order."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.select(*(df[f"`{name}`"] for name in names))
