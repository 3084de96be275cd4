"""Split of a job's output by ``_error``."""

from pyspark.sql import DataFrame, functions as F


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, rows that did not). Both are lazy views over the same plan."""
    return df.filter(F.col("_error").isNull()).drop("_error"), df.filter(F.col("_error").isNotNull())
