"""Line samples of raw logs."""

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from emberlog.operators.leading import leading_lines
from emberlog.operators.sampling import DEFAULT_SAMPLE, DEFAULT_SEED, number_lines, sample_n
from emberlog.sinks import write_sample
from emberlog.sources import read_lines


def sample_lines(
    spark: SparkSession, path: str, n: int = DEFAULT_SAMPLE, random: bool = False,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """(line_no, value): the first `n` lines, or `n` random ones, each with its place in the file."""
    if not random:
        return leading_lines(spark, path, n)
    return sample_n(number_lines(read_lines(spark, path)), n, "line_no", seed)


def write_samples(
    spark: SparkSession,
    logs: dict[str, str],
    target: str,
    n: int = DEFAULT_SAMPLE,
    random: bool = False,
    compress: bool = False,
    seed: int = DEFAULT_SEED,
) -> dict[str, str]:
    """Write a sample of each log below `target`, in line order, and return the paths.

    An absent log is skipped with a warning.
    """
    written = {}
    for name, path in logs.items():
        try:
            sample = sample_lines(spark, path, n, random, seed)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            warnings.warn(f"no sample of {name}: {path} does not exist", stacklevel=2)
            continue
        written[name] = f"{target}/{name}_sample"
        write_sample(sample.orderBy("line_no").select("value"), written[name], compress)
    return written
