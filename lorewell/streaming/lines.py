"""Records of files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def stream_lines(spark: SparkSession, folder: str, parse: Callable[[DataFrame], DataFrame], max_files: int = 100) -> DataFrame:
    """Records of files as they arrive in a folder: any line parser works on the stream."""
    return parse(spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", max_files).text(folder))
