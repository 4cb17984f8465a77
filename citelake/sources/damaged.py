"""Finding the files that cannot be read, such as gzip files that end too early."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

_UNREADABLE = "FAILED_READ_FILE"
_GONE = f"{_UNREADABLE}.FILE_NOT_EXIST"


def unreadable(error: Exception) -> bool:
    """Whether a job failed over the content of a file."""
    text = str(error)
    return _UNREADABLE in text and _GONE not in text


def damaged_files(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """The paths that cannot be read to their end, each with its error.

    A list that fails is halved until single files fail, so a few damaged files among many cost a few
    passes over the list, in which files are decompressed and nothing else. No file is read by halves:
    what can be read is found good.
    """
    if not paths:
        return {}
    try:
        # the lines are only counted; a reader that needs no column would not open the files
        spark.read.text(list(paths)).filter("length(value) >= 0").count()
    except (Py4JJavaError, PySparkException) as error:
        if not unreadable(error):
            raise
        if len(paths) == 1:
            return {paths[0]: _cause(error)}
        half = len(paths) // 2
        return {**damaged_files(spark, paths[:half]), **damaged_files(spark, paths[half:])}
    return {}


def _cause(error: Exception) -> str:
    """The innermost cause that the error names, without its trace."""
    causes = [
        line.split("Caused by: ", 1)[1].strip() for line in str(error).splitlines() if "Caused by: " in line
    ]
    return causes[-1] if causes else str(error).splitlines()[0]
